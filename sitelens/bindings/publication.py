"""Anonymisation, renaming and the pass/fail gate on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitelens.bindings import checks as ck
from sitelens.bindings import processing as pp
from sitelens.bindings.registry import query
from sitelens.bindings.views import BY_REGION
from sitelens.operators.sets import union_all
from sitelens.plans import gate, process, publish
from sitelens.session import shared_folder
from sitelens.sources.store import Store

SALT = "a-fixed-salt"

LABELS_SQL = f"""labels_ AS (
  SELECT site, 'site_' || row_number() OVER (ORDER BY sha256('{SALT}' || site), site) AS label
  FROM (SELECT DISTINCT site FROM mf))"""


@query(
    "an_01",
    f"""{BY_REGION}, {pp.mf_pp_sql()}, {pp.uc_pp_sql()}, {LABELS_SQL}
    SELECT 'mf' AS source, CASE WHEN t.site = 'total' THEN 'total' ELSE l.label END AS site,
           t.check_name, t.total_rows
    FROM mf_pp t LEFT JOIN labels_ l USING (site)
    UNION ALL
    SELECT 'uc', CASE WHEN t.site = 'total' THEN 'total' ELSE l.label END, t.check_name, t.total_rows
    FROM uc_pp t LEFT JOIN labels_ l USING (site)""",
)
def anonymise(spark, folder):
    """The labels come from one result; both processed results are stored with them."""
    store = Store(spark, f"{shared_folder(spark)}/results-{uuid.uuid4().hex}")
    missing = store.write(ck.mf(spark, folder), "mf_output")
    tables = {
        "mf": process.process_missing_visits(missing),
        "uc": process.process_unmapped(ck.uc(spark, folder)),
    }
    store.write_all(publish.anonymise(tables, missing, SALT))
    return union_all(
        store.read(name).select(F.lit(name).alias("source"), "site", "check_name", "total_rows")
        for name in tables
    )


NEW_NAMES = [("uc_condsall", "uc_conditions"), ("uc_procsall", "uc_procedures")]


@query(
    "rn_01",
    f"""{BY_REGION} SELECT u.* EXCLUDE (check_name),
      coalesce(n.new_name, u.check_name) AS check_name, n.new_name
    FROM ({ck.uc_sql()}) u LEFT JOIN (VALUES {", ".join(map(str, NEW_NAMES))})
      AS n(check_name, new_name) ON u.check_name = n.check_name""",
)
def rename_checks(spark, folder):
    names = spark.createDataFrame(NEW_NAMES, "check_name string, new_name string")
    legacy = ck.uc(spark, folder).withColumn("old_check_name", F.col("check_name"))
    tables = {"uc_output": legacy, "visits": ck.v.visits(spark, folder)}
    renamed = publish.rename_checks(tables, names)
    return publish.drop_old_names(renamed)["uc_output"]


# --- gate --------------------------------------------------------------------------------

# The names of the checks that each gate judges, and its thresholds. The comparison
# SQL states them apart from the code.


def _gate_sql(prefix, value, direction, threshold, verdict, source):
    return f"""SELECT site, check_name, '{prefix} - ' || check_description AS check_description,
      CAST({value} AS DOUBLE) AS value, {direction} AS direction,
      CAST({threshold} AS DOUBLE) AS threshold,
      CASE WHEN {verdict} THEN 'PASS' ELSE 'FAIL' END AS pass_fail FROM {source}"""


GT_01 = _gate_sql(
    "BMC",
    "best_row_prop",
    "'>'",
    0.7,
    "bool_or(best_row_prop > 0.7) OVER (PARTITION BY site, CASE WHEN check_name IN"
    " ('bmc_csop', 'bmc_provop') THEN 'bmc_specop' ELSE check_name END)",
    f"bmc_pp WHERE site <> 'total' AND best_notbest = 1 AND check_name IN ('bmc_demog-race', 'bmc_demog-eth',"
    " 'bmc_drugsip-rxnorm', 'bmc_drugspresc-rxnorm', 'bmc_csop', 'bmc_provop')",
)


@query("gt_01", f"{BY_REGION}, {pp.bmc_pp_sql()} {GT_01}")
def best_mapped_gate(spark, folder):
    return gate.best_mapped_gate(pp.bmc_pp(spark, folder))


@query(
    "gt_02",
    f"{BY_REGION}, {pp.dc_pp_sql()} "
    + _gate_sql(
        "DCC",
        "prop_total_change",
        "CASE WHEN prop_total_change < 0 THEN '>' WHEN prop_total_change >= 0 THEN '<' END",
        "CASE WHEN prop_total_change < 0 THEN -0.5 WHEN prop_total_change >= 0 THEN 1 END",
        "NOT coalesce(prop_total_change < -0.5 OR prop_total_change > 1, FALSE)",
        "dc_pp WHERE site <> 'total' AND application = 'rows'",
    ),
)
def cycle_gate(spark, folder):
    return gate.cycle_gate(pp.dc_pp(spark, folder))


GT_03 = _gate_sql(
    "VC",
    "viol_prop",
    "'<'",
    0.3,
    "NOT (NOT accepted_value AND viol_prop > 0.3)",
    f"""(SELECT p.*, coalesce(v.tot_prop, 0) AS viol_prop FROM vc_pp p
      LEFT JOIN (SELECT site, check_name, tot_prop FROM vc_viol) v USING (site, check_name)
      WHERE p.site <> 'total' AND p.check_name IN
        ('vc_condsall-cid', 'vc_drugsall-cid', 'vc_labsall-cid'))""",
)


@query("gt_03", f"{BY_REGION}, {pp.VC} {GT_03}")
def vocabulary_gate(spark, folder):
    result = process.process_conformance(ck.vc(spark, folder), "vocabulary_id")
    return gate.vocabulary_gate(result)


GT_04 = _gate_sql(
    "UC",
    "unmapped_prop",
    "'<'",
    "CASE WHEN check_name = 'uc_procsall' THEN 0.5 ELSE 0.3 END",
    "unmapped_prop < CASE WHEN check_name = 'uc_procsall' THEN 0.5 ELSE 0.3 END",
    f"({ck.uc_sql()}) WHERE check_name IN"
    " ('uc_condsall', 'uc_drugsall', 'uc_procsall', 'uc_labsall')",
)


@query("gt_04", f"{BY_REGION} {GT_04}")
def unmapped_gate(spark, folder):
    return gate.unmapped_gate(ck.uc(spark, folder))


GT_05 = _gate_sql(
    "MF-VISITID",
    "prop_missing_visits_total",
    "'<'",
    0.3,
    "prop_missing_visits_total < 0.3",
    f"mf_pp WHERE site <> 'total' AND check_name NOT IN"
    " ('mf_visitid_drugspresc-visitid', 'mf_visitid_immsall-visitid')",
)


@query("gt_05", f"{BY_REGION}, {pp.mf_pp_sql()} {GT_05}")
def missing_visit_gate(spark, folder):
    return gate.missing_visit_gate(process.process_missing_visits(ck.mf(spark, folder)))


GT_06 = _gate_sql(
    "ECP",
    "prop_with_concept",
    "'>'",
    "CASE WHEN check_name IN ('ecp_ht', 'ecp_wt') THEN 0.75 ELSE 0.7 END",
    "prop_with_concept > CASE WHEN check_name IN ('ecp_ht', 'ecp_wt') THEN 0.75 ELSE 0.7 END",
    f"({ck.ecp_sql()}) WHERE check_name IN"
    " ('ecp_ht', 'ecp_wt', 'ecp_tract-2020', 'ecp_blgr-2020')",
)


@query("gt_06", f"{BY_REGION} {GT_06}")
def expected_gate(spark, folder):
    return gate.expected_gate(ck.ecp(spark, folder))


GT_07 = _gate_sql(
    "DP",
    "prop_implausible",
    "'<'",
    0.3,
    "prop_implausible < 0.3",
    f"({ck.dp_sql()}) WHERE regexp_matches(check_name, 'drugsall|condsall|procsall|labsall')",
)


@query("gt_07", f"{BY_REGION} {GT_07}")
def date_gate(spark, folder):
    return gate.date_gate(ck.dp(spark, folder))


@query(
    "gt_08",
    f"""{BY_REGION}, {pp.mf_pp_sql()}
    SELECT * FROM ({GT_04} UNION {GT_05} UNION {GT_06} UNION {GT_07}) WHERE pass_fail = 'FAIL'""",
)
def failures(spark, folder):
    return gate.failures(
        [
            gate.unmapped_gate(ck.uc(spark, folder)),
            gate.missing_visit_gate(process.process_missing_visits(ck.mf(spark, folder))),
            gate.expected_gate(ck.ecp(spark, folder)),
            gate.date_gate(ck.dp(spark, folder)),
        ]
    )
