"""Checks on the driver's tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sitelens.bindings import views as v
from sitelens.bindings.registry import query
from sitelens.bindings.views import BY_REGION, CYCLE_CUT, PREVIOUS_VERSION, VERSION, table
from sitelens.operators.sets import union_all
from sitelens.plans import checks
from sitelens.plans.checks import VisitClass
from sitelens.plans.checks.concordance import near_pairs
from sitelens.sources.specs import (
    BestMappedSpec,
    CodeSets,
    ConcordanceSpec,
    CycleSpec,
    DatePlausibilitySpec,
    DocumentationSpec,
    ExpectedConceptSpec,
    FactsOverTimeSpec,
    MissingVisitSpec,
    UnmappedSpec,
    ValueSetSpec,
    VocabularySpec,
)
from sitelens.sources.tables import Tables, frames

# --- unmapped concepts -------------------------------------------------------------------

UNMAPPED = [
    UnmappedSpec(
        check_id="condsall",
        check_description="All facts",
        table="fact",
        concept_field="mapped_concept_id",
        source_value_field="source_value",
        date_field="fact_date",
    ),
    UnmappedSpec(
        check_id="drugsall",
        check_description="Returned facts",
        table="fact",
        concept_field="mapped_concept_id",
        source_value_field="source_value",
        date_field="fact_date",
        filter_logic="fact_type = 'R'",
    ),
    UnmappedSpec(
        check_id="procsall",
        check_description="Facts linked to a visit",
        table="fact",
        concept_field="linked_visit_id",
        source_value_field="fact_type",
        date_field="visit_start_date",
        filter_logic="value > 10 AND source_value <> 'F'",
    ),
]
CODES = (0,)


def _unmapped_sql(spec: UnmappedSpec) -> str:
    return f"({spec.concept_field} IS NULL OR {spec.concept_field} IN (0))"


def _where(spec) -> str:
    return f"({spec.filter_logic or 'TRUE'})"


def uc_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT site, 'uc_{s.check_id}' AS check_name, '{s.check_description}' AS check_description,
          'uc' AS check_type, '{VERSION}' AS database_version,
          count(*) FILTER ({_where(s)}) AS total_rows,
          count(*) FILTER ({_where(s)} AND {_unmapped_sql(s)}) AS unmapped_rows,
          coalesce(CAST(unmapped_rows AS DOUBLE) / nullif(total_rows, 0), 0) AS unmapped_prop
        FROM facts GROUP BY site"""
        for s in UNMAPPED
    )


def uc_year_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT site, 'uc_{s.check_id}' AS check_name, '{s.check_description}' AS check_description,
          'uc' AS check_type, '{VERSION}' AS database_version,
          CAST(year({s.date_field}) AS INTEGER) AS year_date, count(*) AS total_rows,
          count(*) FILTER ({_unmapped_sql(s)}) AS unmapped_rows,
          CAST(unmapped_rows AS DOUBLE) / total_rows AS prop_total
        FROM facts WHERE {_where(s)} GROUP BY site, year({s.date_field})"""
        for s in UNMAPPED
    )


def uc(spark, folder, site="region"):
    return checks.unmapped_concepts(
        v.clinical_tables(spark, folder, site), UNMAPPED, VERSION, CODES
    )


def uc_year(spark, folder):
    return checks.unmapped_by_year(v.clinical_tables(spark, folder), UNMAPPED, VERSION, CODES)


@query("ck_uc", f"{BY_REGION} {uc_sql()}")
def unmapped(spark, folder):
    return uc(spark, folder)


@query("ck_ucy", f"{BY_REGION} {uc_year_sql()}")
def unmapped_by_year(spark, folder):
    return uc_year(spark, folder)


@query(
    "ck_ucg",
    BY_REGION
    + " UNION ALL ".join(
        f""" SELECT site, 'uc_{s.check_id}' AS check_name, '{s.check_description}' AS check_description,
          'uc' AS check_type, '{VERSION}' AS database_version,
          {s.source_value_field} AS source_value, count(*) AS unmapped_rows
        FROM facts WHERE {_where(s)} AND {_unmapped_sql(s)} GROUP BY site, {s.source_value_field}"""
        for s in UNMAPPED
    ),
)
def unmapped_source_values(spark, folder):
    return checks.unmapped_source_values(
        v.clinical_tables(spark, folder), UNMAPPED, VERSION, CODES
    )


# --- vocabulary and value set conformance ------------------------------------------------

VOCABULARY = [
    VocabularySpec(
        check_id="condsall-cid",
        check_description="All concepts",
        table="fact",
        concept_field="mapped_concept_id",
        acceptable_vocabularies="STANDARD,PROMO, LARGE",
    ),
    VocabularySpec(
        check_id="drugsall-cid",
        check_description="Returned concepts",
        table="fact",
        concept_field="mapped_concept_id",
        acceptable_vocabularies="ECONOMY , SMALL,STANDARD,PROMO",
        filter_logic="fact_type = 'R'",
    ),
]


def _header_sql(check_string: str, spec) -> str:
    return (
        f"'{check_string}_{spec.check_id}' AS check_name,"
        f" '{spec.check_description}' AS check_description,"
        f" '{check_string}' AS check_type, '{VERSION}' AS database_version"
    )


def vc_sql() -> str:
    parts = []
    for spec in VOCABULARY:
        names = ", ".join(f"'{n.strip()}'" for n in spec.acceptable_vocabularies.split(","))
        parts.append(
            f"""SELECT f.site, {_header_sql("vc", spec)},
              'fact' AS table_application, '{spec.concept_field}' AS measurement_column,
              k.vocabulary_id, coalesce(k.vocabulary_id IN ({names}), FALSE) AS accepted_value,
              count(*) AS tot_ct,
              CAST(sum(count(*)) OVER (PARTITION BY f.site) AS BIGINT) AS total_denom_ct
            FROM facts f LEFT JOIN (SELECT * REPLACE (
              CASE WHEN concept_id % 10 = 1 THEN -concept_id ELSE concept_id END AS concept_id)
              FROM concept) k
              ON f.{spec.concept_field} = k.concept_id
            WHERE {_where(spec)} AND f.{spec.concept_field} IS NOT NULL
              AND f.{spec.concept_field} NOT IN (0)
            GROUP BY f.site, k.vocabulary_id"""
        )
    return " UNION ALL ".join(parts)


def vc(spark, folder, site="region"):
    """Every tenth concept has an id that no fact carries, so some concepts are unknown."""
    number = F.col("concept_id")
    known = v.concept(spark, folder).withColumn(
        "concept_id", F.when(number % 10 == 1, -number).otherwise(number)
    )
    return checks.vocabulary_conformance(
        v.clinical_tables(spark, folder, site), VOCABULARY, known, VERSION, CODES
    )


@query("ck_vc", f"{BY_REGION} {vc_sql()}")
def vocabulary_conformance(spark, folder):
    return vc(spark, folder)


VALUE_SETS = [
    ValueSetSpec(
        check_id="flag",
        check_description="Fact type",
        table="fact",
        concept_field="fact_type",
        valueset_name="two_flags",
    ),
    ValueSetSpec(
        check_id="line",
        check_description="Line number",
        table="fact",
        concept_field="line_number",
        valueset_name="four_lines",
        filter_logic="source_value = 'F'",
    ),
]
ALLOWED = {"two_flags": ("A", "N"), "four_lines": (1, 2, 3, 4)}


def vs_sql() -> str:
    parts = []
    for spec in VALUE_SETS:
        allowed = ", ".join(f"'{value}'" for value in ALLOWED[spec.valueset_name])
        value = f"CAST({spec.concept_field} AS VARCHAR)"
        parts.append(
            f"""SELECT site, {_header_sql("vs", spec)},
              'fact' AS table_application, '{spec.concept_field}' AS measurement_column,
              {value} AS concept_id, {value} IN ({allowed}) AS accepted_value, count(*) AS tot_ct,
              CAST(sum(count(*)) OVER (PARTITION BY site) AS BIGINT) AS total_denom_ct
            FROM facts WHERE {_where(spec)} GROUP BY site, {spec.concept_field}"""
        )
    return " UNION ALL ".join(parts)


def vs(spark, folder, site="region", extra=(), sets=None):
    allowed = {
        name: spark.createDataFrame([(value,) for value in values], ["concept_id"])
        for name, values in ALLOWED.items()
    }
    return checks.value_set_conformance(
        v.clinical_tables(spark, folder, site),
        [*VALUE_SETS, *extra],
        CodeSets(named=allowed | (sets or {})),
        VERSION,
    )


@query("ck_vs", f"{BY_REGION} {vs_sql()}")
def value_set_conformance(spark, folder):
    return vs(spark, folder)


# --- missing visit ids -------------------------------------------------------------------

MISSING = [
    MissingVisitSpec(check_id="condsall-visitid", check_description="All facts", table="linked"),
    MissingVisitSpec(
        check_id="drugsall-visitid",
        check_description="Returned facts",
        table="linked",
        filter_logic="fact_type = 'R'",
    ),
    MissingVisitSpec(
        check_id="immsall-visitid",
        check_description="New facts",
        table="linked",
        filter_logic="fact_type IN ('N') AND value < 20",
    ),
]


def mf_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT f.site, {_header_sql("mf_visitid", s)}, '{s.check_description}' AS domain,
          count(*) AS total_rows, count(*) FILTER (f.linked_visit_id IS NULL) AS null_visit_rows,
          count(*) FILTER (f.linked_visit_id IS NOT NULL AND o.o_orderkey IS NULL)
            AS unknown_visit_rows,
          CAST(null_visit_rows + unknown_visit_rows AS DOUBLE) / total_rows
            AS prop_missing_visits_total
        FROM facts f LEFT JOIN orders o ON f.linked_visit_id = o.o_orderkey
        WHERE {_where(s)} GROUP BY f.site"""
        for s in MISSING
    )


def mf(spark, folder, site="region"):
    linked = (
        v.facts(spark, folder, site)
        .drop("visit_occurrence_id")
        .withColumnRenamed("linked_visit_id", "visit_occurrence_id")
    )
    visits = table(spark, folder, "orders").selectExpr("o_orderkey AS visit_occurrence_id")
    tables = Tables({"cdm": frames({"linked": linked})})
    return checks.missing_visit_ids(tables, MISSING, visits, VERSION)


@query("ck_mf", f"{BY_REGION} {mf_sql()}")
def missing_visit_ids(spark, folder):
    return mf(spark, folder)


# --- best mapped concepts ----------------------------------------------------------------

BEST = [
    BestMappedSpec(
        check_id="drugsip-rxnorm",
        check_description="Brand of all facts",
        table="fact",
        concept_field="mapped_concept_id",
        concept_table_field="concept_name",
    ),
    BestMappedSpec(
        check_id="csop",
        check_description="Size of returned facts",
        table="fact",
        concept_field="mapped_concept_id",
        concept_table_field="concept_class_id",
        filter_logic="fact_type = 'R'",
    ),
]
BEST_OWN = [
    BestMappedSpec(
        check_id="provop",
        check_description="Class of visits",
        table="visit_occurrence",
        concept_field="visit_concept_id",
        concept_table_field="visit_concept_id",
    )
]
BEST_LIST = [
    *[("drugsip-rxnorm", f"Brand#{i}", 1, "notbest") for i in range(1, 21)],
    *[("csop", str(i), 0, "best") for i in range(1, 11)],
    ("bmc_provop", "1-URGENT", 1, "notbest"),
    ("bmc_provop", "2-HIGH", 1, "notbest"),
]


def bmc_sql() -> str:
    label = {
        "drugsip-rxnorm": "CASE WHEN concept IN ("
        + ", ".join(f"'Brand#{i}'" for i in range(1, 21))
        + ") THEN 1 ELSE 0 END",
        "csop": "CASE WHEN CAST(concept AS INTEGER) <= 10 THEN 0 ELSE 1 END",
        "provop": "CASE WHEN concept IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END",
    }
    parts = []
    for spec in [*BEST, *BEST_OWN]:
        if spec in BEST_OWN:
            rows = f"SELECT site, {spec.concept_field} AS concept FROM visits"
        else:
            rows = (
                f"SELECT f.site, CAST(k.{spec.concept_table_field} AS VARCHAR) AS concept FROM facts f"
                f" LEFT JOIN concept k ON f.{spec.concept_field} = k.concept_id"
                f" WHERE {_where(spec)} AND f.{spec.concept_field} IS NOT NULL"
            )
        parts.append(
            f"""SELECT site, {_header_sql("bmc", spec)}, '{spec.concept_field}' AS concept_field,
              concept, {label[spec.check_id]} AS best_notbest, count(*) AS row_cts,
              CAST(sum(count(*)) OVER (PARTITION BY site) AS BIGINT) AS total_rows
            FROM ({rows}) GROUP BY site, concept"""
        )
    return " UNION ALL ".join(parts)


def bmc(spark, folder, site="region"):
    best = spark.createDataFrame(
        BEST_LIST, "check_name string, concept string, best_notbest int, default_to string"
    )
    tables = v.clinical_tables(spark, folder, site)
    concept = v.concept(spark, folder)
    return union_all(
        [
            checks.best_mapped_concepts(tables, BEST, best, VERSION, concept),
            checks.best_mapped_concepts(tables, BEST_OWN, best, VERSION),
        ]
    )


@query("ck_bmc", f"{BY_REGION} {bmc_sql()}")
def best_mapped_concepts(spark, folder):
    return bmc(spark, folder)


# --- expected concepts -------------------------------------------------------------------

EXPECTED = [
    ExpectedConceptSpec(
        check_id="ht",
        check_description="Brand 1",
        cohort_definition="Persons with an urgent visit",
        cohort_table="urgent",
        table="fact",
        concept_field="concept_id",
        conceptset_name="brand_1",
    ),
    ExpectedConceptSpec(
        check_id="wt",
        check_description="Brands 2 and 3, returned",
        cohort_definition="Persons with an urgent visit",
        cohort_table="urgent",
        table="fact",
        concept_field="concept_id",
        conceptset_name="brand_2",
        filter_logic="fact_type = 'R'",
    ),
    ExpectedConceptSpec(
        check_id="tract-2020",
        check_description="Brand 4, mapped",
        cohort_definition="All persons",
        cohort_schema="cdm",
        cohort_table="person",
        table="fact",
        concept_field="mapped_concept_id",
        conceptset_name="brand_4",
        filter_logic="value > 5",
    ),
]
SET_SQL = {
    "brand_1": "p_brand = 'Brand#1'",
    "brand_2": "p_brand IN ('Brand#2', 'Brand#3')",
    "brand_4": "p_brand = 'Brand#4'",
}
COHORT_SQL = {
    "urgent": "(SELECT DISTINCT site, person_id FROM visits WHERE visit_concept_id = '1-URGENT')",
    "person": "(SELECT DISTINCT site, person_id FROM persons)",
}


def ecp_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT c.site, {_header_sql("ecp", s)}, '{s.cohort_definition}' AS cohort_definition,
          '{s.conceptset_name}' AS concept_group, count(*) AS total_pts,
          count(h.person_id) AS pts_with_concept,
          CAST(pts_with_concept AS DOUBLE) / total_pts AS prop_with_concept
        FROM {COHORT_SQL[s.cohort_table]} c LEFT JOIN (
          SELECT DISTINCT site, person_id FROM facts JOIN part ON {s.concept_field} = p_partkey
          WHERE {SET_SQL[s.conceptset_name]} AND {_where(s)}) h
          ON c.site = h.site AND c.person_id = h.person_id GROUP BY c.site"""
        for s in EXPECTED
    )


def ecp(spark, folder, site="region"):
    urgent = v.visits(spark, folder, site).filter(F.col("visit_concept_id") == "1-URGENT")
    tables = v.clinical_tables(spark, folder, site).adding("result", {"urgent": urgent})
    return checks.expected_concepts(tables, EXPECTED, v.code_sets(spark, folder), VERSION)


@query("ck_ecp", f"{BY_REGION} {ecp_sql()}")
def expected_concepts(spark, folder):
    return ecp(spark, folder)


# --- fact documentation ------------------------------------------------------------------

DOCUMENTED = [
    DocumentationSpec(check_id="condsall", check_description="Large facts", table="fact",
                      filter_logic="value > 40"),
    DocumentationSpec(check_id="drugsall", check_description="Returned facts", table="fact",
                      filter_logic="fact_type = 'R' AND source_value = 'O'"),
    DocumentationSpec(check_id="icu", check_description="Linked facts", table="linked"),
]
CLASSES = (
    VisitClass("all", None, "", frozenset({"icu"})),
    VisitClass(
        "inpatient",
        "visit_concept_id IN ('1-URGENT', '2-HIGH') AND visit_source_concept_id <> 'P'",
        "-visip",
    ),
    VisitClass(
        "long_inpatient",
        "visit_concept_id IN ('1-URGENT', '2-HIGH') AND visit_source_concept_id <> 'P'"
        " AND stay > 2",
        "-visiplong",
    ),
    VisitClass(
        "outpatient",
        "visit_concept_id IN ('3-MEDIUM', '5-LOW') AND visit_source_concept_id <> 'P'",
        "-visop",
        frozenset({"icu"}),
    ),
    VisitClass(
        "primary_care",
        "visit_concept_id = '3-MEDIUM' AND location_id < 5 AND visit_source_concept_id <> 'P'",
        "-vispc",
        frozenset({"icu"}),
    ),
    VisitClass(
        "emergency",
        "visit_concept_id IN ('2-HIGH', '4-NOT SPECIFIED') AND visit_source_concept_id <> 'P'",
        "-vised",
        frozenset({"icu"}),
    ),
    VisitClass("cancelled", "visit_source_concept_id = 'P'", "-viscn"),
)


def cfd_sql(classes=CLASSES) -> str:
    parts = []
    for c in classes:
        for s in DOCUMENTED:
            if s.check_id in c.skip:
                continue
            key = "linked_visit_id" if s.table == "linked" else "visit_occurrence_id"
            parts.append(
                f"""SELECT v.site, 'cfd_{s.check_id}{c.suffix}' AS check_name,
                  '{s.check_description}' AS check_description, 'cfd' AS check_type,
                  '{VERSION}' AS database_version, '{c.name}' AS visit_type,
                  count(*) AS total_visits, count(h.id) AS fact_visits,
                  CAST(fact_visits AS DOUBLE) / total_visits AS fact_visits_prop,
                  count(DISTINCT v.person_id) AS total_pts,
                  count(DISTINCT v.person_id) FILTER (h.id IS NOT NULL) AS fact_pts,
                  CAST(fact_pts AS DOUBLE) / total_pts AS fact_pts_prop
                FROM (SELECT *, visit_end_date - visit_start_date AS stay FROM visits) v
                LEFT JOIN (SELECT DISTINCT {key} AS id FROM facts
                           WHERE {_where(s)} AND {key} IS NOT NULL) h
                  ON v.visit_occurrence_id = h.id
                WHERE {c.predicate or 'TRUE'} GROUP BY v.site"""
            )
    return " UNION ALL ".join(parts)


def cfd(spark, folder, site="region", classes=CLASSES):
    lines = v.lines(spark, folder)
    linked = lines.drop("visit_occurrence_id").withColumnRenamed(
        "linked_visit_id", "visit_occurrence_id"
    )
    tables = Tables({"cdm": frames({"fact": lines, "linked": linked})})
    visits = v.visits(spark, folder, site).withColumn(
        "stay", F.datediff("visit_end_date", "visit_start_date")
    )
    return checks.fact_documentation_by_class(tables, DOCUMENTED, visits, classes, VERSION)


@query("ck_cfd", f"{BY_REGION} {cfd_sql(CLASSES[1:2])}")
def fact_documentation(spark, folder):
    return cfd(spark, folder, classes=CLASSES[1:2])


@query("ck_cfdm", f"{BY_REGION} {cfd_sql()}")
def fact_documentation_by_class(spark, folder):
    return cfd(spark, folder)


# --- domain concordance ------------------------------------------------------------------


def _cohort(check_id, number, window=None, **given):
    return ConcordanceSpec(
        cohort_id=f"{check_id}_{number}",
        check_id=check_id,
        cohort_description=f"{check_id} cohort {number}",
        table="fact",
        date_field="fact_date",
        time_between_events=window,
        **given,
    )


BY_PERSON = [
    _cohort("brands", 1, 90, concept_field="concept_id", conceptset_name="brand_1"),
    _cohort("brands", 2, 90, concept_field="concept_id", conceptset_name="brand_2",
            filter_logic="fact_type = 'R'"),
    _cohort("types", 1, 2, filter_logic="fact_type = 'A'"),
    _cohort("types", 2, 2, filter_logic="fact_type = 'R'"),
    _cohort("untimed", 1, filter_logic="fact_type = 'A'"),
    _cohort("untimed", 2, concept_field="concept_id", conceptset_name="brand_4"),
]
BY_VISIT = [
    _cohort("vis-types", 1, 30, filter_logic="fact_type = 'A'"),
    _cohort("vis-types", 2, 30, filter_logic="fact_type = 'R'"),
    _cohort("vis-untimed", 1, filter_logic="fact_type = 'N' AND value > 25"),
    _cohort("vis-untimed", 2, filter_logic="fact_type = 'R'"),
]


def dcon_sql(specs, key: str) -> str:
    parts = []
    for one, two in zip(specs[::2], specs[1::2], strict=True):

        def events(s):
            member = (
                f"concept_id IN (SELECT p_partkey FROM part WHERE {SET_SQL[s.conceptset_name]})"
                if s.conceptset_name
                else "TRUE"
            )
            return f"(SELECT DISTINCT site, {key} AS k, fact_date AS d FROM facts WHERE {_where(s)} AND {member})"

        near = "TRUE" if one.time_between_events is None else (
            f"abs(a.d - b.d) <= {one.time_between_events}"
        )
        description = f"{one.cohort_description} / {two.cohort_description}"
        parts.append(
            f"""SELECT site, 'dcon_{one.check_id}' AS check_name, '{description}' AS check_description,
              'dcon' AS check_type, '{VERSION}' AS database_version, cohort,
              count(*) FILTER (category = cohort) AS value, count(*) AS total_ct,
              CAST(value AS DOUBLE) / total_ct AS prop
            FROM (
              SELECT coalesce(x.site, y.site) AS site, CASE
                WHEN y.k IS NULL THEN 'cohort_1_only' WHEN x.k IS NULL THEN 'cohort_2_only'
                WHEN n.k IS NOT NULL THEN 'combined' ELSE 'both_outside_window' END AS category
              FROM (SELECT DISTINCT site, k FROM {events(one)}) x
              FULL JOIN (SELECT DISTINCT site, k FROM {events(two)}) y USING (site, k)
              LEFT JOIN (SELECT DISTINCT a.site, a.k FROM {events(one)} a JOIN {events(two)} b
                         ON a.site = b.site AND a.k = b.k AND {near}) n
                ON n.site = coalesce(x.site, y.site) AND n.k = coalesce(x.k, y.k)
            ), (SELECT unnest(['cohort_1_only', 'cohort_2_only', 'combined', 'both_outside_window'])
               AS cohort)
            GROUP BY site, cohort"""
        )
    return " UNION ALL ".join(parts)


def dcon(spark, folder, site="region"):
    return checks.domain_concordance(
        v.clinical_tables(spark, folder, site), BY_PERSON, v.code_sets(spark, folder), VERSION
    )


@query("ck_dcon", f"{BY_REGION} {dcon_sql(BY_PERSON, 'person_id')}")
def concordance_by_person(spark, folder):
    return dcon(spark, folder)


@query("ck_dcon_visit", f"{BY_REGION} {dcon_sql(BY_VISIT, 'visit_occurrence_id')}")
def concordance_by_visit(spark, folder):
    return checks.domain_concordance(
        v.clinical_tables(spark, folder),
        BY_VISIT,
        v.code_sets(spark, folder),
        VERSION,
        level="visit",
    )


# --- facts over time ---------------------------------------------------------------------

START, AS_OF = datetime.date(1995, 1, 1), datetime.date(2001, 12, 31)
TIMED = [
    FactsOverTimeSpec(check_id="visall", check_description="Visits", check_domain="Visits",
                      table="visit_occurrence", date_field="visit_start_date"),
    FactsOverTimeSpec(check_id="factsall", check_description="Facts", check_domain="Facts",
                      table="fact", date_field="fact_date"),
    FactsOverTimeSpec(check_id="factsr", check_description="Returned", check_domain="Facts",
                      table="fact", date_field="fact_date",
                      filter_logic="fact_type = 'R' AND value = 3"),
]


def fot_sql() -> str:
    """Defines fot: the dense monthly counts."""
    counted = " UNION ALL ".join(
        f"""SELECT site, 'fot_{s.check_id}' AS check_name,
          CAST(date_trunc('month', {s.date_field}) AS DATE) AS time_start, count(*) AS n,
          count(DISTINCT visit_occurrence_id) AS nv, count(DISTINCT person_id) AS np
        FROM {'visits' if s.table == 'visit_occurrence' else 'facts'}
        WHERE {_where(s)} AND {s.date_field} BETWEEN DATE '{START}' AND DATE '{AS_OF}'
        GROUP BY ALL"""
        for s in TIMED
    )
    names = ", ".join(
        f"('fot_{s.check_id}', '{s.check_description}', '{s.check_domain}')" for s in TIMED
    )
    return f"""counted AS ({counted}),
    months AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{AS_OF}', INTERVAL 1 MONTH))
                      AS DATE) AS time_start),
    names(check_name, check_description, domain) AS (VALUES {names}),
    fot AS (
      SELECT r.r_name AS site, k.check_name, k.check_description, 'fot' AS check_type,
             '{VERSION}' AS database_version, k.domain, m.time_start,
             last_day(m.time_start) AS time_end, coalesce(c.n, 0) AS row_cts,
             coalesce(c.nv, 0) AS row_visits, coalesce(c.np, 0) AS row_pts
      FROM region r CROSS JOIN names k CROSS JOIN months m LEFT JOIN counted c
        ON c.site = r.r_name AND c.check_name = k.check_name AND c.time_start = m.time_start)"""


FOTD_SQL = """fotd AS (
  SELECT f.*, t.row_cts AS total_row, t.row_visits AS total_visit, t.row_pts AS total_pt
  FROM fot f LEFT JOIN fot t ON t.check_name = 'fot_visall' AND f.site = t.site
    AND f.time_start = t.time_start AND f.time_end = t.time_end)"""


def fot(spark, folder):
    sites = table(spark, folder, "region").selectExpr("r_name AS site")
    return checks.facts_over_time(
        v.clinical_tables(spark, folder), TIMED, VERSION, START, AS_OF, sites
    )


@query("ck_fot", f"{BY_REGION}, {fot_sql()} SELECT * FROM fot")
def facts_over_time(spark, folder):
    return fot(spark, folder)


@query("ck_fotd", f"{BY_REGION}, {fot_sql()}, {FOTD_SQL} SELECT * FROM fotd")
def facts_over_time_with_denominators(spark, folder):
    return checks.attach_denominators(fot(spark, folder))


# --- date plausibility -------------------------------------------------------------------

DATED = [
    DatePlausibilitySpec(check_id="condsall", check_description="All facts", table="fact",
                         date_field="fact_date"),
    DatePlausibilitySpec(check_id="returned", check_description="Returned facts", table="fact",
                         date_field="fact_date", filter_logic="fact_type = 'R'"),
]
BROKEN = {
    "before_birth": "f.fact_date < p.birth_date",
    "before_visit": "f.fact_date < v.visit_start_date",
    "after_visit": "f.fact_date > v.visit_end_date",
}


def dp_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT f.site, {_header_sql("dp", s)}, '{kind}' AS implausible_type,
          count(*) AS total_rows, count(*) FILTER ({test}) AS implausible_row,
          CAST(implausible_row AS DOUBLE) / total_rows AS prop_implausible
        FROM facts f LEFT JOIN visits v ON f.linked_visit_id = v.visit_occurrence_id
        LEFT JOIN persons p ON f.site = p.site AND f.person_id = p.person_id
        WHERE {_where(s)} GROUP BY f.site"""
        for s in DATED
        for kind, test in BROKEN.items()
    )


def dp(spark, folder, site="region"):
    linked = (
        v.facts(spark, folder, site)
        .drop("visit_occurrence_id")
        .withColumnRenamed("linked_visit_id", "visit_occurrence_id")
    )
    return checks.date_plausibility(
        Tables({"cdm": frames({"fact": linked})}),
        DATED,
        v.visits(spark, folder, site),
        v.persons(spark, folder, site),
        VERSION,
    )


@query("ck_dp", f"{BY_REGION} {dp_sql()}")
def date_plausibility(spark, folder):
    return dp(spark, folder)


# --- data cycle changes ------------------------------------------------------------------

CYCLE = [
    *[
        CycleSpec(
            check_id=f"facts{kind.lower()}",
            check_description=f"Facts of type {kind}",
            check_domain="Facts",
            table_current="fact",
            table_prev="fact",
            filter_logic=f"fact_type = '{kind}'",
        )
        for kind in ("A", "N", "R")
    ],
    CycleSpec(
        check_id="visall",
        check_description="Visits",
        check_domain="Visits",
        table_current="visit_occurrence",
        table_prev="visit_occurrence",
    ),
    CycleSpec(
        check_id="provall",
        check_description="Providers",
        check_domain="Providers",
        table_current="provider",
        table_prev="provider",
    ),
]


def dc_sql(site: str = "region") -> str:
    """Defines dc: current and previous counts."""

    def counts(cut: str, column: str) -> str:
        parts = []
        for kind in ("A", "N", "R"):
            name = f"'dc_facts{kind.lower()}' AS check_name, 'Facts' AS domain"
            for application, measure in (
                ("rows", f"count(*) FILTER (fact_type = '{kind}')"),
                ("person", f"count(DISTINCT person_id) FILTER (fact_type = '{kind}')"),
            ):
                parts.append(
                    f"SELECT site, {name}, '{application}' AS application, {measure} AS {column}"
                    f" FROM facts WHERE fact_date < DATE '{cut}' GROUP BY site"
                )
        for application, measure in (("rows", "count(*)"), ("person", "count(DISTINCT person_id)")):
            parts.append(
                f"SELECT site, 'dc_visall', 'Visits', '{application}', {measure}"
                f" FROM visits WHERE visit_start_date < DATE '{cut}' GROUP BY site"
            )
        parts.append(
            "SELECT site, 'dc_provall', 'Providers', 'rows', count(*)"
            " FROM supplier JOIN sites ON s_nationkey = n_nationkey"
            f" WHERE s_acctbal < {1e9 if cut > '2100' else 5000} GROUP BY site"
        )
        return " UNION ALL ".join(parts)

    return f"""now AS ({counts('9999-01-01', 'current_ct')}),
    before AS ({counts(CYCLE_CUT, 'previous_ct')}),
    dc AS (
      SELECT coalesce(n.site, b.site) AS site, coalesce(n.check_name, b.check_name) AS check_name,
             coalesce(n.application, b.application) AS application, 'dc' AS check_type,
             '{VERSION}' AS database_version, '{PREVIOUS_VERSION}' AS previous_version,
             coalesce(n.domain, b.domain) AS domain,
             coalesce(current_ct, 0) AS current_ct, coalesce(previous_ct, 0) AS previous_ct
      FROM now n FULL JOIN before b ON n.site = b.site AND n.check_name = b.check_name
        AND n.application = b.application)"""


def dc(spark, folder, site="region"):
    providers = table(spark, folder, "supplier").join(
        v._sites(spark, folder, site), F.col("s_nationkey") == F.col("n_nationkey")
    )
    current = v.clinical_tables(spark, folder, site).adding("cdm", {"provider": providers})
    previous = Tables(
        {
            "cdm": frames(
                {
                    "fact": current.cdm("fact").filter(F.col("fact_date") < CYCLE_CUT),
                    "visit_occurrence": current.cdm("visit_occurrence").filter(
                        F.col("visit_start_date") < CYCLE_CUT
                    ),
                    "provider": providers.filter(F.col("s_acctbal") < 5000),
                }
            )
        }
    )
    return checks.data_cycle_changes(current, CYCLE, VERSION, previous, PREVIOUS_VERSION)


@query("ck_dc", f"{BY_REGION}, {dc_sql()} SELECT * FROM dc")
def data_cycle_changes(spark, folder):
    return dc(spark, folder)


# --- metadata ----------------------------------------------------------------------------


@query(
    "ck_meta",
    BY_REGION + """, names AS (
      SELECT DISTINCT check_name, check_type FROM ("""
    + uc_sql()
    + ") UNION SELECT DISTINCT check_name, check_type FROM ("
    + dp_sql()
    + ") UNION SELECT DISTINCT check_name, check_type FROM ("
    + dcon_sql(BY_PERSON, "person_id")
    + """))
    SELECT n.check_name, n.check_type AS check_type_short,
      CASE n.check_type WHEN 'uc' THEN 'Unmapped Concepts' WHEN 'dp' THEN 'Date Plausibility'
        ELSE 'Domain Concordance' END AS check_type,
      CASE n.check_type WHEN 'uc' THEN 'Completeness' WHEN 'dp' THEN 'Correctness'
        ELSE 'Concordance' END AS check_category,
      c.cohort, c.cohort_id, c.cohort_description, c.time_between_events, c.level
    FROM names n LEFT JOIN (VALUES """
    + ", ".join(
        f"('dcon_{s.check_id}', 'cohort_{1 + i % 2}', '{s.cohort_id}', '{s.cohort_description}',"
        f" CAST({'NULL' if s.time_between_events is None else s.time_between_events} AS DOUBLE),"
        " 'patient')"
        for i, s in enumerate(BY_PERSON)
    )
    + """) AS c(check_name, cohort, cohort_id, cohort_description, time_between_events, level)
      USING (check_name)""",
)
def check_metadata(spark, folder):
    results = [uc(spark, folder), dp(spark, folder), dcon(spark, folder)]
    return checks.check_metadata(results, checks.concordance_metadata(spark, BY_PERSON))


@query(
    "ck_dconm",
    f"""{BY_REGION}, counted AS (
      SELECT check_name, cohort AS category, CAST(sum(value) AS BIGINT) AS members
      FROM ({dcon_sql(BY_VISIT, "visit_occurrence_id")}) GROUP BY ALL)
    SELECT c.*, n.category, n.members FROM (VALUES """
    + ", ".join(
        f"('dcon_{s.check_id}', 'cohort_{1 + i % 2}', '{s.cohort_id}', '{s.cohort_description}',"
        f" CAST({'NULL' if s.time_between_events is None else s.time_between_events} AS DOUBLE),"
        f" 'visit')"
        for i, s in enumerate(BY_VISIT)
    )
    + """) AS c(check_name, cohort, cohort_id, cohort_description, time_between_events, level)
    JOIN counted n USING (check_name)""",
)
def concordance_metadata(spark, folder):
    """Metadata of the cohorts with the visits that their check found in each category."""
    counted = (
        concordance_by_visit(spark, folder)
        .groupBy("check_name", F.col("cohort").alias("category"))
        .agg(F.sum("value").alias("members"))
    )
    described = checks.concordance_metadata(spark, BY_VISIT, level="visit")
    return described.join(counted, "check_name")


@query(
    "jn_11",
    BY_REGION + """, e AS (
      SELECT site, person_id, fact_date AS d, fact_type AS t FROM facts
      WHERE fact_type IN ('A', 'R')),
    near AS (
      SELECT DISTINCT a.site, a.person_id FROM e a JOIN e b
        ON a.site = b.site AND a.person_id = b.person_id AND a.t = 'A' AND b.t = 'R'
        AND abs(a.d - b.d) <= 2)
    SELECT e.site, e.person_id, bool_or(t = 'A') AS in_first, bool_or(t = 'R') AS in_second,
           bool_or(n.person_id IS NOT NULL) AS near
    FROM e LEFT JOIN near n ON e.site = n.site AND e.person_id = n.person_id
    GROUP BY e.site, e.person_id""",
)
def events_within_days(spark, folder):
    """Persons with events of two kinds, and whether any two are at most two days apart."""
    chosen = v.facts(spark, folder).filter(F.col("fact_type").isin("A", "R"))
    events = chosen.select(
        F.lit("pair").alias("check_name"),
        "site",
        F.col("person_id").alias("__key"),
        F.col("fact_date").alias("__date"),
        F.when(F.col("fact_type") == "A", 1).otherwise(2).alias("cohort"),
    )
    return near_pairs(events, {"pair": 2}).select(
        "site",
        F.col("__key").alias("person_id"),
        F.col("__one").alias("in_first"),
        F.col("__two").alias("in_second"),
        F.col("__near").alias("near"),
    )
