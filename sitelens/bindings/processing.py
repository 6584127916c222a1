"""Post-processing, outliers and cross-site summaries on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitelens.bindings import checks as ck
from sitelens.bindings.registry import SQL, query
from sitelens.bindings.views import BY_NATION, BY_REGION
from sitelens.operators.groups import without_totals
from sitelens.operators.sets import union_all
from sitelens.plans import checks, outliers, process, summary
from sitelens.session import shared_folder
from sitelens.sources.store import Store

# --- post-processing ---------------------------------------------------------------------

NAMED = "check_name, check_description, check_type, database_version"


def total_sql(source: str, keys: str, sums: str) -> str:
    """Sums per site and key, plus the same over all sites."""
    columns = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in sums.split(", "))
    return (
        f"SELECT site, {keys}, {columns} FROM {source} GROUP BY site, {keys}"
        f" UNION ALL SELECT 'total', {keys}, {columns} FROM {source} GROUP BY {keys}"
    )


DC_KEYS = "check_name, check_type, database_version, previous_version, domain, application"
DESCRIBED = ", ".join(f"('dc_{s.check_id}', '{s.check_description}')" for s in ck.CYCLE)


def dc_pp_sql(site: str = "region") -> str:
    return f"""{ck.dc_sql(site)}, dc_pp AS (
      SELECT t.*, CAST(current_ct - previous_ct AS DOUBLE) / nullif(previous_ct, 0)
               AS prop_total_change, check_name || '_' || application AS check_name_app,
             m.check_description
      FROM ({total_sql('dc', DC_KEYS, 'current_ct, previous_ct')}) t
      JOIN (VALUES {DESCRIBED}) AS m(check_name, check_description) USING (check_name))"""


def dc_pp(spark, folder, site="region"):
    return process.process_cycle(
        ck.dc(spark, folder, site), checks.cycle_metadata(spark, ck.CYCLE)
    )


@query("pp_dc", f"{BY_REGION}, {dc_pp_sql()} SELECT * FROM dc_pp")
def process_cycle(spark, folder):
    return dc_pp(spark, folder)


CONFORMANCE_KEYS = f"{NAMED}, table_application, measurement_column"


def conformance_sql(counts: str, value: str, name: str) -> str:
    """Defines <name>_pp and <name>_viol."""
    return f"""{name} AS ({counts}),
    {name}_sums AS (SELECT *,
        CASE WHEN coalesce(accepted_value, TRUE) THEN tot_ct ELSE 0 END AS accepted_ct,
        CASE WHEN coalesce(accepted_value, TRUE) THEN 0 ELSE tot_ct END AS viol_ct FROM {name}),
    {name}_pp AS (
      SELECT *, accepted_ct + viol_ct AS total_denom_ct, viol_ct = 0 AS accepted_value,
             CAST(accepted_ct AS DOUBLE) / nullif(accepted_ct + viol_ct, 0) AS prop_accepted,
             CAST(viol_ct AS DOUBLE) / nullif(accepted_ct + viol_ct, 0) AS prop_viol
      FROM ({total_sql(f'{name}_sums', CONFORMANCE_KEYS, 'accepted_ct, viol_ct')})),
    {name}_viol AS (
      SELECT r.*, p.total_denom_ct, FALSE AS accepted_value,
             CAST(r.tot_ct AS DOUBLE) / p.total_denom_ct AS tot_prop
      FROM ({total_sql(f"(SELECT * FROM {name} WHERE NOT accepted_value)",
                       f"{CONFORMANCE_KEYS}, {value}", "tot_ct")}) r
      JOIN (SELECT site, check_name, total_denom_ct FROM {name}_pp) p USING (site, check_name))"""


def zero_sql(name: str, value: str) -> str:
    return f"""SELECT p.site, p.table_application, p.measurement_column, p.check_type, p.check_name,
      p.total_denom_ct, p.check_description, v.database_version, v.{value},
      coalesce(v.tot_ct, 0) AS tot_ct, v.accepted_value, coalesce(v.tot_prop, 0) AS tot_prop,
      p.check_name || '_rows' AS check_name_app
    FROM {name}_pp p LEFT JOIN {name}_viol v USING (site, check_name)"""


VC = conformance_sql(ck.vc_sql(), "vocabulary_id", "vc")
VS = conformance_sql(ck.vs_sql(), "concept_id", "vs")


@query("pp_vc", f"{BY_REGION}, {VC} SELECT * FROM vc_pp")
def process_vocabulary(spark, folder):
    return process.process_conformance(ck.vc(spark, folder), "vocabulary_id").processed


@query("pp_vc_violations", f"{BY_REGION}, {VC} SELECT * FROM vc_viol")
def vocabulary_violations(spark, folder):
    return process.process_conformance(ck.vc(spark, folder), "vocabulary_id").violations


@query("pp_vs", f"{BY_REGION}, {VS} SELECT * FROM vs_pp")
def process_value_sets(spark, folder):
    return process.process_conformance(ck.vs(spark, folder), "concept_id").processed


@query(
    "pp_zero",
    f"""{BY_REGION}, {conformance_sql(ck.vs_sql() + " UNION ALL " + ck.vs_sql().split("UNION ALL")[1].replace(
        "'vs_line'", "'vs_clean'").replace("IN ('1', '2', '3', '4')", "IS NOT NULL"),
        "concept_id", "vs")} {zero_sql('vs', 'concept_id')}""",
)
def zero_rows(spark, folder):
    """A third check, whose value set holds every line number, has no violations."""
    lines = ck.VALUE_SETS[1]
    clean = ck.ValueSetSpec(
        check_id="clean",
        check_description=lines.check_description,
        table="fact",
        concept_field="line_number",
        valueset_name="all_lines",
        filter_logic=lines.filter_logic,
    )
    every = {"all_lines": spark.range(1, 8).toDF("concept_id")}
    counts = ck.vs(spark, folder, extra=[clean], sets=every)
    return process.with_zero_rows(process.process_conformance(counts, "concept_id"))


def uc_pp_sql() -> str:
    return f"""uc AS ({ck.uc_sql()}), uc_pp AS (
      SELECT *, CAST(unmapped_rows AS DOUBLE) / nullif(total_rows, 0) AS unmapped_prop
      FROM ({total_sql('uc', NAMED, 'total_rows, unmapped_rows')}))"""


def uc_year_pp_sql() -> str:
    return f"""ucy AS ({ck.uc_year_sql()}), ucy_pp AS (
      SELECT *, CAST(unmapped_rows AS DOUBLE) / nullif(total_rows, 0) AS prop_total
      FROM ({total_sql('ucy', NAMED + ', year_date', 'total_rows, unmapped_rows')}))"""


@query("pp_uc", f"{BY_REGION}, {uc_pp_sql()} SELECT * FROM uc_pp")
def process_unmapped(spark, folder):
    return process.process_unmapped(ck.uc(spark, folder))


@query("pp_uc_year", f"{BY_REGION}, {uc_year_pp_sql()} SELECT * FROM ucy_pp")
def process_unmapped_by_year(spark, folder):
    return process.process_unmapped(ck.uc_year(spark, folder))


def mf_pp_sql() -> str:
    return f"""mf AS ({ck.mf_sql()}), mf_pp AS (
      SELECT *, CAST(null_visit_rows + unknown_visit_rows AS DOUBLE) / total_rows
               AS prop_missing_visits_total, check_name || '_rows' AS check_name_app
      FROM ({total_sql('mf', NAMED + ', domain',
                       'total_rows, null_visit_rows, unknown_visit_rows')}))"""


@query("pp_mf", f"{BY_REGION}, {mf_pp_sql()} SELECT * FROM mf_pp")
def process_missing(spark, folder):
    return process.process_missing_visits(ck.mf(spark, folder))


def bmc_pp_sql() -> str:
    return f"""bmc AS ({ck.bmc_sql()}), bmc_sums AS (
      {total_sql('bmc', NAMED + ', best_notbest', 'row_cts')}),
    bmc_pp AS (
      SELECT *, CAST(sum(row_cts) OVER w AS BIGINT) AS total_rows,
             CAST(row_cts AS DOUBLE) / sum(row_cts) OVER w AS best_row_prop,
             check_name || '_rows' AS check_name_app
      FROM bmc_sums WINDOW w AS (PARTITION BY site, check_name))"""


def bmc_pp(spark, folder, site="region"):
    return process.process_best_mapped(ck.bmc(spark, folder, site))


@query("pp_bmc", f"{BY_REGION}, {bmc_pp_sql()} SELECT * FROM bmc_pp")
def process_best(spark, folder):
    return bmc_pp(spark, folder)


CATEGORIES = [("ecp_ht", "Anthropometrics"), ("ecp_tract-2020", "Geocodes")]


def ecp_pp_sql() -> str:
    values = ", ".join(f"('{a}', '{b}')" for a, b in CATEGORIES)
    keys = f"{NAMED}, cohort_definition, concept_group"
    return f"""ecp AS ({ck.ecp_sql()}), ecp_pp AS (
      SELECT t.*, CAST(pts_with_concept AS DOUBLE) / total_pts AS prop_with_concept,
             check_name || '_person' AS check_name_app, k.check_cat
      FROM ({total_sql('ecp', keys, 'total_pts, pts_with_concept')}) t
      LEFT JOIN (VALUES {values}) AS k(check_name, check_cat) USING (check_name))"""


def ecp_pp(spark, folder, site="region"):
    categories = spark.createDataFrame(CATEGORIES, "check_name string, check_cat string")
    return process.process_expected(ck.ecp(spark, folder, site), categories)


@query("pp_ecp", f"{BY_REGION}, {ecp_pp_sql()} SELECT * FROM ecp_pp")
def process_expected(spark, folder):
    return ecp_pp(spark, folder)


def cfd_pp_sql() -> str:
    sums = "total_visits, fact_visits, total_pts, fact_pts"
    return f"""cfd AS ({ck.cfd_sql()}), cfd_pp AS (
      SELECT *, CAST(fact_visits AS DOUBLE) / nullif(total_visits, 0) AS fact_visits_prop,
             CAST(fact_pts AS DOUBLE) / nullif(total_pts, 0) AS fact_pts_prop
      FROM ({total_sql('cfd', NAMED + ', visit_type', sums)}))"""


def cfd_pp(spark, folder, site="region"):
    return process.process_documentation(ck.cfd(spark, folder, site))


@query("pp_cfd", f"{BY_REGION}, {cfd_pp_sql()} SELECT * FROM cfd_pp")
def process_documentation(spark, folder):
    return cfd_pp(spark, folder)


def dcon_pp_sql() -> str:
    return f"""dcon AS ({ck.dcon_sql(ck.BY_PERSON, 'person_id')}), dcon_pp AS (
      SELECT *, CAST(value AS DOUBLE) / nullif(total_ct, 0) AS prop
      FROM ({total_sql('dcon', NAMED + ', cohort', 'value, total_ct')}))"""


@query("pp_dcon", f"{BY_REGION}, {dcon_pp_sql()} SELECT * FROM dcon_pp")
def process_concordance(spark, folder):
    return process.process_concordance(ck.dcon(spark, folder))


def dp_pp_sql() -> str:
    return f"""dp AS ({ck.dp_sql()}), dp_pp AS (
      SELECT *, CAST(implausible_row AS DOUBLE) / total_rows AS prop_implausible,
             check_name || '_rows' AS check_name_app
      FROM ({total_sql('dp', NAMED + ', implausible_type', 'total_rows, implausible_row')}))"""


def dp_pp(spark, folder, site="region"):
    return process.process_dates(ck.dp(spark, folder, site))


@query("pp_dp", f"{BY_REGION}, {dp_pp_sql()} SELECT * FROM dp_pp")
def process_dates(spark, folder):
    return dp_pp(spark, folder)


TIMELINE_SQL = f"""{BY_REGION}, {ck.fot_sql()}, {ck.FOTD_SQL}, heuristic AS (
  SELECT site, check_name, database_version, check_description, check_type, time_start, time_end,
         row_cts, CAST(row_cts AS DOUBLE) / nullif((lag(row_cts) OVER w + lead(row_cts) OVER w) / 2.0, 0) - 1
           AS "check"
  FROM fot WINDOW w AS (PARTITION BY site, check_name, database_version ORDER BY time_start))"""


def timeline(spark, folder):
    counted = checks.attach_denominators(ck.fot(spark, folder))
    return process.process_timeline(counted)


@query("pp_fot", f"{TIMELINE_SQL} SELECT * FROM heuristic")
def timeline_heuristic(spark, folder):
    return timeline(spark, folder).heuristic


@query(
    "pp_fot_summary",
    TIMELINE_SQL + """ SELECT site, check_name, database_version, check_description, check_type,
      round(avg("check"), 9) AS mean_val, round(median("check"), 9) AS median_val,
      round(stddev_samp("check"), 9) AS sd_val,
      min("check") AS min_val, max("check") AS max_val
    FROM heuristic GROUP BY ALL""",
)
def timeline_summary(spark, folder):
    rows = timeline(spark, folder).summary
    return rounded(rows, 9, "mean_val", "median_val", "sd_val")


@query(
    "pp_fot_ratios",
    TIMELINE_SQL + """ SELECT site, check_name, database_version, check_description, check_type,
      time_start, time_end, row_cts, row_cts * 10000.0::DOUBLE / nullif(total_row, 0) AS ratio_row,
      row_cts * 10000.0::DOUBLE / nullif(total_visit, 0) AS ratio_visit,
      row_cts * 10000.0::DOUBLE / nullif(total_pt, 0) AS ratio_pt FROM fotd""",
)
def timeline_ratios(spark, folder):
    return timeline(spark, folder).ratios


@query(
    "pp_fot_versions",
    f"""{BY_REGION}, {ck.fot_sql()}, two AS (
      SELECT site, check_name, database_version, check_description, check_type, time_start,
             time_end, row_cts FROM fot
      UNION ALL
      SELECT site, check_name, 'earlier', check_description, check_type, time_start,
             time_end, row_visits FROM fot)
    SELECT *, CAST(row_cts AS DOUBLE)
           / nullif((lag(row_cts) OVER w + lead(row_cts) OVER w) / 2.0, 0) - 1 AS "check"
    FROM two
    WINDOW w AS (PARTITION BY site, check_name, database_version ORDER BY time_start)""",
)
def timeline_versions(spark, folder):
    """Two stored data versions; in the earlier one, visits are counted in place of rows."""
    now = ck.fot(spark, folder)
    earlier = now.withColumns({"database_version": F.lit("earlier"), "row_cts": F.col("row_visits")})
    return process.process_timeline(checks.attach_denominators(now.unionByName(earlier))).heuristic


# --- outliers ----------------------------------------------------------------------------


def rounded(df, places: int, *columns: str):
    """Engines add floating point numbers in any order; compare at some places."""
    return df.withColumns({name: ck.F.round(name, places) for name in columns})


def distribution_sql(source: str, group: str, value: str, name: str) -> str:
    """Defines <name>: rows of source with the statistics of their group."""
    keys = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in group.split(", "))
    return f"""{name}_1 AS (
      SELECT t.*, s.* EXCLUDE ({group}) FROM {source} t JOIN (
        SELECT {group}, avg({value}) AS mean_val, median({value}) AS median_val,
               stddev_samp({value}) AS sd_val, min({value}) AS min_val, max({value}) AS max_val,
               count({value}) AS n
        FROM {source} GROUP BY {group}) s ON {keys}),
    {name} AS (
      SELECT t.* EXCLUDE (n), s.mad_val,
             CASE WHEN n >= 3 AND min_val < max_val THEN 'yes' ELSE 'no' END AS analysis_eligible
      FROM {name}_1 t JOIN (SELECT {group}, median(abs({value} - median_val)) AS mad_val
                            FROM {name}_1 GROUP BY {group}) s ON {keys})"""


def outlier_sql(source: str, value: str, name: str) -> str:
    """Defines <name>: rows of source with tails and flag."""
    z = outliers.NormalDist().inv_cdf(0.95)
    return f"""{name} AS (
      SELECT *, CASE WHEN analysis_eligible <> 'yes' THEN 'not eligible'
                     WHEN {value} < lower_tail OR {value} > upper_tail THEN 'outlier'
                     ELSE 'not outlier' END AS anomaly_yn
      FROM (SELECT *, CASE WHEN analysis_eligible = 'yes' THEN mean_val - {z}::DOUBLE * sd_val END AS lower_tail,
                   CASE WHEN analysis_eligible = 'yes' THEN mean_val + {z}::DOUBLE * sd_val END AS upper_tail
            FROM {source}))"""


INEXACT = ("mean_val", "sd_val", "lower_tail", "upper_tail")
ROUNDED = ", ".join(f"round({n}, 9) AS {n}" for n in INEXACT)

DC_OUTLIERS = f"""{BY_NATION}, {dc_pp_sql('nation')},
  dc_sites AS (SELECT * FROM dc_pp WHERE site <> 'total'),
  {distribution_sql('dc_sites', 'check_type, application', 'prop_total_change', 'dc_dist')},
  {outlier_sql('dc_dist', 'prop_total_change', 'dc_anom')}"""


def dc_dist(spark, folder):
    rows = without_totals(dc_pp(spark, folder, "nation"))
    return outliers.distribution(rows, ["check_type", "application"], "prop_total_change")


def dc_anom(spark, folder):
    return outliers.flag_outliers(dc_dist(spark, folder), "prop_total_change")


@query(
    "ad_01",
    f"{DC_OUTLIERS} SELECT * REPLACE (round(mean_val, 9) AS mean_val, round(sd_val, 9) AS sd_val)"
    " FROM dc_dist",
)
def distribution(spark, folder):
    return rounded(dc_dist(spark, folder), 9, "mean_val", "sd_val")


@query("ad_02", f"{DC_OUTLIERS} SELECT * REPLACE ({ROUNDED}) FROM dc_anom")
def outlier_flags(spark, folder):
    return rounded(dc_anom(spark, folder), 9, *INEXACT)


SUPPRESSED = """suppressed AS (
  SELECT r.*, CASE
    WHEN (anomaly_yn = 'outlier' OR site = 'total') AND prop_total_change < lower_tail THEN low
    WHEN (anomaly_yn = 'outlier' OR site = 'total') AND prop_total_change > upper_tail THEN high
    ELSE prop_total_change END AS plot_prop
  FROM (
    SELECT * FROM dc_anom
    UNION ALL BY NAME
    SELECT t.*, b.lower_tail, b.upper_tail
    FROM (SELECT * FROM dc_pp WHERE site = 'total') t JOIN (
      SELECT DISTINCT check_name, application, lower_tail, upper_tail FROM dc_anom
      WHERE lower_tail IS NOT NULL AND upper_tail IS NOT NULL) b USING (check_name, application)
  ) r LEFT JOIN (
    SELECT application, min(prop_total_change) AS low, max(prop_total_change) AS high
    FROM dc_anom WHERE anomaly_yn <> 'outlier' GROUP BY application) u USING (application))"""


def dc_suppressed(spark, folder):
    stated = outliers.distribution(
        dc_pp(spark, folder, "nation"),
        ["check_type", "application"],
        "prop_total_change",
        sites_only=True,
    )
    return outliers.suppress_outliers(outliers.flag_outliers(stated, "prop_total_change"))


@query("ad_03", f"{DC_OUTLIERS}, {SUPPRESSED} SELECT * REPLACE ({ROUNDED}) FROM suppressed")
def suppressed_outliers(spark, folder):
    return rounded(dc_suppressed(spark, folder), 9, *INEXACT)


def _anomalies(name, pp_sql, source, group, value):
    return f"""{BY_NATION}, {pp_sql}, {name}_rows AS ({source}),
      {distribution_sql(f'{name}_rows', group, value, f'{name}_dist')},
      {outlier_sql(f'{name}_dist', value, f'{name}_anom')}
      SELECT * REPLACE ({ROUNDED}) FROM {name}_anom"""


BMC_GROUP = "check_name, check_description, check_type, check_name_app, database_version"


@query(
    "ad_bmc",
    _anomalies(
        "bmc",
        bmc_pp_sql(),
        "SELECT * FROM bmc_pp WHERE best_notbest = 1",
        BMC_GROUP,
        "best_row_prop",
    ),
)
def best_mapped_outliers(spark, folder):
    best = bmc_pp(spark, folder, "nation").filter("best_notbest = 1")
    stated = outliers.distribution(best, BMC_GROUP.split(", "), "best_row_prop")
    return rounded(outliers.flag_outliers(stated, "best_row_prop"), 9, *INEXACT)


@query(
    "ad_ecp",
    _anomalies(
        "ecp", ecp_pp_sql(), "SELECT * FROM ecp_pp", "check_name", "prop_with_concept"
    ),
)
def expected_outliers(spark, folder):
    stated = outliers.distribution(
        ecp_pp(spark, folder, "nation"), ["check_name"], "prop_with_concept"
    )
    return rounded(outliers.flag_outliers(stated, "prop_with_concept"), 9, *INEXACT)


DP_GROUP = "check_name, implausible_type, check_name_app"


@query(
    "ad_dp",
    _anomalies("dp", dp_pp_sql(), "SELECT * FROM dp_pp", DP_GROUP, "prop_implausible"),
)
def date_outliers(spark, folder):
    stated = outliers.distribution(
        dp_pp(spark, folder, "nation"), DP_GROUP.split(", "), "prop_implausible"
    )
    return rounded(outliers.flag_outliers(stated, "prop_implausible"), 9, *INEXACT)


# --- cross-site summaries ----------------------------------------------------------------


def summary_sql(
    source: str, value: str, group, name: str, suffix: str = "", drop: str = ""
) -> str:
    """Defines <name>: rows of source with the six statistics of their group."""
    keys = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in group)
    listed = ", ".join(group)
    return f"""{name} AS (
      SELECT t.*{drop}, s.* EXCLUDE ({listed}) FROM {source} t JOIN (
        SELECT {listed}, min({value}) AS min_val{suffix},
               round(quantile_cont({value}, 0.25), 9) AS q1{suffix},
               round(quantile_cont({value}, 0.5), 9) AS median_val{suffix},
               round(avg({value}), 9) AS mean_val{suffix},
               round(quantile_cont({value}, 0.75), 9) AS q3{suffix}, max({value}) AS max_val{suffix}
        FROM {source} GROUP BY {listed}) s ON {keys})"""


# Fixed values, stated for the SQL apart from the code they check: the summarised value and the
# grouping columns of every check.
SUMMARISED = {
    "dc": (
        "prop_total_change",
        "domain check_name application check_type check_name_app check_description",
    ),
    "vs": ("prop_viol", "table_application measurement_column check_type check_name"),
    "vc": ("prop_viol", "table_application measurement_column check_type check_name"),
    "uc": ("unmapped_prop", "check_description check_name check_type"),
    "uc_by_year": (
        "prop_total",
        "check_type database_version year_date check_description check_name",
    ),
    "bmc": ("best_row_prop", "check_name check_description best_notbest"),
    "dcon": ("prop", "cohort check_name check_description check_type"),
    "mf": (
        "prop_missing_visits_total",
        "check_description domain check_name check_type check_name_app",
    ),
    "ecp": ("prop_with_concept", "concept_group check_name check_name_app"),
    "dp": ("prop_implausible", "implausible_type check_name check_description check_name_app"),
}


def ln_sql(check: str, pp_sql: str, pp: str, where: str = "TRUE") -> str:
    value, columns = SUMMARISED[check]
    group = columns.split()
    filled = f" REPLACE (coalesce({value}, 0) AS {value})" if check == "uc" else ""
    totals = (
        f" UNION ALL BY NAME SELECT * FROM {pp} WHERE site = 'total' AND {where}"
        if check not in ("vs", "vc")
        else ""
    )
    return f"""{BY_NATION}, {pp_sql},
      ln_rows AS (SELECT *{filled} FROM {pp} WHERE site <> 'total' AND {where}),
      {summary_sql('ln_rows', value, group, 'ln')} SELECT * FROM ln{totals}"""


ROUNDED_STATISTICS = ("q1", "median_val", "mean_val", "q3")


def ln(df, check):
    return rounded(summary.summarize_check(df, check), 9, *ROUNDED_STATISTICS)


@query(
    "ln_01",
    f"""{BY_NATION}, {dc_pp_sql('nation')}, ln_rows AS (SELECT * FROM dc_pp WHERE site <> 'total'),
    {summary_sql('ln_rows', 'prop_total_change', SUMMARISED['dc'][1].split(), 'ln')}
    SELECT * FROM ln""",
)
def summarised_sites(spark, folder):
    rows = without_totals(dc_pp(spark, folder, "nation"))
    parameters = summary.PARAMETERS["dc"]
    stated = summary.summarize_sites(rows, parameters["value"], parameters["group"])
    return rounded(stated, 9, *ROUNDED_STATISTICS)


@query(
    "ln_02",
    f"""{DC_OUTLIERS}, {SUPPRESSED},
    ln_rows AS (SELECT * EXCLUDE (mean_val, median_val, min_val, max_val)
                         REPLACE (round(sd_val, 9) AS sd_val, round(lower_tail, 9) AS lower_tail,
                                  round(upper_tail, 9) AS upper_tail)
                FROM suppressed WHERE site <> 'total'),
    {summary_sql('ln_rows', 'prop_total_change', SUMMARISED['dc'][1].split(), 'ln')}
    SELECT * FROM ln UNION ALL BY NAME
    SELECT * EXCLUDE (mean_val, median_val, min_val, max_val)
             REPLACE (round(sd_val, 9) AS sd_val, round(lower_tail, 9) AS lower_tail,
                      round(upper_tail, 9) AS upper_tail)
    FROM suppressed WHERE site = 'total'""",
)
def summarised_cycle(spark, folder):
    rows = ln(dc_suppressed(spark, folder), "dc")
    return rounded(rows, 9, "sd_val", "lower_tail", "upper_tail")


@query("ln_03", ln_sql("vs", VS, "vs_pp", "total_denom_ct <> 0"))
def summarised_value_sets(spark, folder):
    result = process.process_conformance(ck.vs(spark, folder, "nation"), "concept_id")
    return ln(result.processed, "vs")


@query("ln_03_vc", ln_sql("vc", VC, "vc_pp"))
def summarised_vocabularies(spark, folder):
    result = process.process_conformance(ck.vc(spark, folder, "nation"), "vocabulary_id")
    return ln(result.processed, "vc")


@query("ln_04", ln_sql("uc", uc_pp_sql(), "uc_pp"))
def summarised_unmapped(spark, folder):
    return ln(process.process_unmapped(ck.uc(spark, folder, "nation")), "uc")


@query("ln_04_year", ln_sql("uc_by_year", uc_year_pp_sql(), "ucy_pp"))
def summarised_unmapped_by_year(spark, folder):
    counts = checks.unmapped_by_year(
        ck.v.clinical_tables(spark, folder, "nation"), ck.UNMAPPED, ck.VERSION, ck.CODES
    )
    return ln(process.process_unmapped(counts), "uc_by_year")


@query("ln_05_bmc", ln_sql("bmc", bmc_pp_sql(), "bmc_pp"))
def summarised_best(spark, folder):
    return ln(bmc_pp(spark, folder, "nation"), "bmc")


@query("ln_05_dcon", ln_sql("dcon", dcon_pp_sql(), "dcon_pp"))
def summarised_concordance(spark, folder):
    return ln(process.process_concordance(ck.dcon(spark, folder, "nation")), "dcon")


@query("ln_05_mf", ln_sql("mf", mf_pp_sql(), "mf_pp"))
def summarised_missing(spark, folder):
    return ln(process.process_missing_visits(ck.mf(spark, folder, "nation")), "mf")


@query("ln_05_ecp", ln_sql("ecp", ecp_pp_sql(), "ecp_pp"))
def summarised_expected(spark, folder):
    return ln(ecp_pp(spark, folder, "nation"), "ecp")


@query("ln_05_dp", ln_sql("dp", dp_pp_sql(), "dp_pp"))
def summarised_dates(spark, folder):
    return ln(dp_pp(spark, folder, "nation"), "dp")


CFD_GROUP = ("check_description", "check_name", "visit_type")


@query(
    "ln_06",
    f"""{BY_NATION}, {cfd_pp_sql()}, ln_rows AS (
      SELECT * REPLACE (coalesce(fact_pts_prop, 0) AS fact_pts_prop,
                        coalesce(fact_visits_prop, 0) AS fact_visits_prop)
      FROM cfd_pp WHERE site <> 'total'),
    {summary_sql('ln_rows', 'fact_pts_prop', CFD_GROUP, 'by_person', '_pts')},
    {summary_sql('by_person', 'fact_visits_prop', CFD_GROUP, 'ln', '_visits')}
    SELECT * FROM ln UNION ALL BY NAME SELECT * FROM cfd_pp WHERE site = 'total'""",
)
def summarised_documentation(spark, folder):
    rows = summary.summarize_documentation(cfd_pp(spark, folder, "nation"))
    names = [f"{n}_{s}" for n in ROUNDED_STATISTICS for s in ("pts", "visits")]
    return rounded(rows, 9, *names)


@query("pp_ucg", SQL["ck_ucg"])
def stored_source_values(spark, folder):
    """The unmapped source values, stored and copied to the processed results."""
    store = Store(spark, f"{shared_folder(spark)}/results-{uuid.uuid4().hex}")
    values = checks.unmapped_source_values(
        ck.v.clinical_tables(spark, folder), ck.UNMAPPED, ck.VERSION, ck.CODES
    )
    return store.write(store.write(values, "uc_grpd"), "uc_grpd_pp")


LN_COLUMNS = "site, check_name, check_name_app, min_val, q1, median_val, mean_val, q3, max_val"


@query(
    "ln_05",
    f"""{BY_NATION}, {mf_pp_sql()}, {dp_pp_sql()},
    mf_rows AS (SELECT * FROM mf_pp WHERE site <> 'total'),
    dp_rows AS (SELECT * FROM dp_pp WHERE site <> 'total'),
    {summary_sql('mf_rows', SUMMARISED['mf'][0], SUMMARISED['mf'][1].split(), 'mf_ln')},
    {summary_sql('dp_rows', SUMMARISED['dp'][0], SUMMARISED['dp'][1].split(), 'dp_ln')}
    SELECT {LN_COLUMNS} FROM mf_ln UNION ALL SELECT {LN_COLUMNS} FROM dp_ln""",
)
def summarised_by_parameters(spark, folder):
    """Two checks with different values and groups, summarised from the parameter table."""
    processed = {
        "mf": process.process_missing_visits(ck.mf(spark, folder, "nation")),
        "dp": dp_pp(spark, folder, "nation"),
    }
    columns = LN_COLUMNS.split(", ")
    return union_all(
        without_totals(ln(rows, check)).select(*columns) for check, rows in processed.items()
    )
