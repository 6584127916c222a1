"""Cohort builders on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.bindings import views as v
from sitelens.bindings.registry import query
from sitelens.bindings.views import BY_REGION, table
from sitelens.plans import cohorts

INPATIENT = ("1-URGENT", "2-HIGH")
OFFICE = "3-MEDIUM"


@query(
    "co_01",
    BY_REGION + """ SELECT p.visit_occurrence_id, p.plan_class, p.plan_type, v.visit_start_date,
      CASE WHEN p.plan_class = 'BUILDING' THEN 0 WHEN p.plan_class IS NOT NULL THEN 1 END AS payer_class,
      CASE WHEN p.plan_type = 'BUILDING' THEN 0 WHEN p.plan_type IS NOT NULL THEN 1 END AS payer_type
    FROM (SELECT o_orderkey AS visit_occurrence_id, c_mktsegment AS plan_class,
                 CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS plan_type
          FROM orders JOIN customer ON o_custkey = c_custkey) p
    JOIN visits v USING (visit_occurrence_id)""",
)
def payer_with_date(spark, folder):
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    payers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey AS visit_occurrence_id",
        "c_mktsegment AS plan_class",
        "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS plan_type",
    )
    return cohorts.payer_with_date(payers, v.visits(spark, folder), uninformative="BUILDING")


@query(
    "co_02",
    BY_REGION + """, firsts AS (
      SELECT DISTINCT site, person_id, visit_start_date FROM visits
      QUALIFY visit_start_date = min(visit_start_date) OVER (PARTITION BY site, person_id)),
    aged AS (
      SELECT f.site, f.person_id, f.visit_start_date, p.birth_date, p.pn_gestational_age,
             CAST(f.visit_start_date - p.birth_date AS DOUBLE) / 365.25 AS age_first_visit
      FROM firsts f JOIN persons p ON f.site = p.site AND f.person_id = p.person_id)
    SELECT *, CASE
      WHEN pn_gestational_age = 0 OR pn_gestational_age IS NULL THEN 'Null/0 Gestational Age'
      WHEN pn_gestational_age BETWEEN 20 AND 45 THEN '20-45 Weeks (Expected Range)'
      WHEN pn_gestational_age < 20 THEN 'Less than 20 weeks (Short Term)'
      ELSE 'Greater than 45 weeks (Long Term)' END AS ga_group
    FROM aged WHERE age_first_visit <= 2""",
)
def gestational_age(spark, folder):
    return cohorts.gestational_age_cohort(v.visits(spark, folder), v.persons(spark, folder))


@query(
    "co_03",
    BY_REGION + " SELECT site, person_id, visit_occurrence_id, f.concept_id, value, fact_date"
    " FROM facts f JOIN part ON f.concept_id = p_partkey WHERE p_brand = 'Brand#5'",
)
def labs_in_code_set(spark, folder):
    columns = ["site", "person_id", "visit_occurrence_id", "concept_id", "value", "fact_date"]
    codes = v.brand(spark, folder, "Brand#5")
    return cohorts.facts_in_code_set(v.facts(spark, folder), codes, "concept_id", columns)


@query(
    "co_04",
    BY_REGION + " SELECT site, visit_occurrence_id, line_number, concept_id, f.provider_id,"
    " visit_concept_id, s_nationkey AS specialty_concept_id"
    " FROM facts f JOIN supplier ON f.provider_id = s_suppkey"
    " WHERE visit_concept_id IN ('3-MEDIUM', '5-LOW')",
)
def visits_with_provider_specialty(spark, folder):
    seen = v.facts(spark, folder).select(
        "site",
        "visit_occurrence_id",
        "line_number",
        "concept_id",
        "provider_id",
        "visit_concept_id",
    )
    return cohorts.visits_with_specialty(
        seen, v.providers(spark, folder), "provider_id", ("3-MEDIUM", "5-LOW")
    )


@query(
    "co_05",
    BY_REGION + " SELECT v.*, n_nationkey AS specialty_concept_id"
    " FROM visits v JOIN nation ON care_site_id = n_nationkey"
    " WHERE visit_concept_id IN ('3-MEDIUM', '5-LOW')",
)
def visits_with_care_site_specialty(spark, folder):
    return cohorts.visits_with_specialty(
        v.visits(spark, folder),
        v.care_sites(spark, folder),
        "care_site_id",
        ("3-MEDIUM", "5-LOW"),
    )


SEEN_SQL = """seen AS (
  SELECT DISTINCT v.site, v.person_id FROM visits v
  WHERE v.visit_concept_id IN ('1-URGENT', '2-HIGH') AND EXISTS (
    SELECT 1 FROM facts f WHERE f.fact_type = 'R' AND f.person_id = v.person_id
      AND f.visit_occurrence_id = v.visit_occurrence_id))"""


def _seen(spark, folder):
    diagnosed = v.facts(spark, folder).filter(F.col("fact_type") == "R")
    return cohorts.persons_seen_with_diagnosis(v.visits(spark, folder), diagnosed, INPATIENT)


@query("co_06", f"{BY_REGION}, {SEEN_SQL} SELECT * FROM seen")
def persons_seen_with_diagnosis(spark, folder):
    return _seen(spark, folder)


@query(
    "co_07",
    f"""{BY_REGION}, {SEEN_SQL}
    SELECT DISTINCT p.site, p.person_id, p.location_id FROM persons p
    JOIN seen s ON p.site = s.site AND p.person_id = s.person_id
    WHERE p.birth_date IS NOT NULL AND p.gender_concept_id NOT IN ('FURNITURE', 'MACHINERY')""",
)
def geocode_cohort(spark, folder):
    return cohorts.geocode_cohort(
        v.persons(spark, folder), _seen(spark, folder), ("FURNITURE", "MACHINERY")
    )


# A geocode per nation: state and county from keys, tract from the name, blanks in between.
FIPS = (
    "n_nationkey AS location_id",
    "lpad(CAST(n_nationkey AS {text}), 2, '0') AS geocode_state",
    "CASE WHEN n_nationkey % 5 = 0 THEN '' WHEN n_nationkey % 5 = 1 THEN ' '"
    " ELSE lpad(CAST(n_regionkey AS {text}), 3, '1') END AS geocode_county",
    "CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE concat('T', lpad(CAST(n_nationkey AS {text}), 6, '0'))"
    " END AS geocode_tract",
    "CAST(n_regionkey AS {text}) AS geocode_group",
    "2010 + 10 * (n_nationkey % 2) AS geocode_year",
)
FIPS_SQL = f"fips AS (SELECT {', '.join(FIPS).format(text='VARCHAR')} FROM nation)"

GEOCODED = """nullif(nullif(geocode_state, ''), ' ') AS geocode_state,
  nullif(nullif(geocode_county, ''), ' ') AS geocode_county,
  nullif(nullif(geocode_tract, ''), ' ') AS geocode_tract,
  nullif(nullif(geocode_group, ''), ' ') AS geocode_group"""


def _fips(spark, folder):
    return table(spark, folder, "nation").selectExpr(*[e.format(text="STRING") for e in FIPS])


@query(
    "co_08",
    f"""{BY_REGION}, {FIPS_SQL},
    clean AS (SELECT p.site, p.person_id, p.location_id, f.geocode_year, {GEOCODED}
              FROM persons p LEFT JOIN fips f USING (location_id)),
    coded AS (SELECT *, regexp_replace(concat_ws('', geocode_state, geocode_county, geocode_tract),
                                       '[A-Za-z]', '', 'g') AS fips_code_tct,
                     regexp_replace(concat_ws('', geocode_state, geocode_county, geocode_tract,
                                              geocode_group), '[A-Za-z]', '', 'g') AS fips_code_bg
              FROM clean)
    SELECT *, CAST(length(fips_code_tct) AS INTEGER) AS ndigit_fips_tct,
           CAST(length(fips_code_bg) AS INTEGER) AS ndigit_fips_bg FROM coded""",
)
def person_geocodes(spark, folder):
    people = v.persons(spark, folder).select("site", "person_id", "location_id")
    return cohorts.person_geocodes(people, _fips(spark, folder))


@query(
    "co_09",
    f"""{BY_REGION}, {FIPS_SQL},
    history AS (
      SELECT f.site, f.person_id, f.provider_id % 25 AS location_id FROM facts f
      WHERE f.source_value = 'F'),
    clean AS (SELECT h.site, h.person_id, h.location_id, f.geocode_year, {GEOCODED}
              FROM history h LEFT JOIN fips f USING (location_id)),
    coded AS (SELECT *, regexp_replace(concat_ws('', geocode_state, geocode_county, geocode_tract),
                                       '[A-Za-z]', '', 'g') AS tct,
                     regexp_replace(concat_ws('', geocode_state, geocode_county, geocode_tract,
                                              geocode_group), '[A-Za-z]', '', 'g') AS bg
              FROM clean)
    SELECT site, person_id, geocode_year,
           count(DISTINCT location_id) FILTER (length(tct) = 11) AS ngeo_lohis_tct,
           count(DISTINCT location_id) FILTER (length(bg) = 12) AS ngeo_lohis_bg
    FROM coded WHERE length(tct) = 11 OR length(bg) = 12 GROUP BY ALL""",
)
def location_history(spark, folder):
    history = v.facts(spark, folder).selectExpr(
        "site",
        "person_id AS entity_id",
        "CASE WHEN source_value = 'F' THEN 'PERSON' ELSE 'care_site' END AS domain_id",
        "CAST(provider_id % 25 AS INT) AS location_id",
        "visit_start_date AS start_date",
        "fact_date AS end_date",
    )
    return cohorts.location_history_counts(
        history, _fips(spark, folder), v.persons(spark, folder)
    )


@query(
    "co_10",
    BY_REGION + """ SELECT DISTINCT site, person_id FROM facts WHERE fact_type = 'A'
    INTERSECT SELECT site, person_id FROM facts WHERE fact_type = 'N'
    INTERSECT SELECT site, person_id FROM facts WHERE fact_type = 'R'""",
)
def persons_in_all(spark, folder):
    rows = v.facts(spark, folder)
    return cohorts.persons_in_all(*[rows.filter(F.col("fact_type") == t) for t in "ANR"])


@query(
    "co_11",
    BY_REGION + " SELECT DISTINCT site, person_id FROM visits"
    " WHERE visit_concept_id IN ('1-URGENT', '2-HIGH')",
)
def inpatients(spark, folder):
    return cohorts.persons_with_visit(v.visits(spark, folder), INPATIENT)


@query(
    "co_12",
    BY_REGION + " SELECT site, person_id, visit_occurrence_id FROM facts WHERE fact_type = 'A'"
    " UNION SELECT site, person_id, visit_occurrence_id FROM facts WHERE fact_type = 'N'",
)
def procedures_and_drugs(spark, folder):
    rows = v.facts(spark, folder)
    return cohorts.person_visits(
        rows.filter(F.col("fact_type") == "A"), rows.filter(F.col("fact_type") == "N")
    )


@query(
    "co_13",
    BY_REGION + """, icu AS (SELECT DISTINCT site, person_id, visit_occurrence_id FROM visits
      WHERE visit_source_concept_id IN ('P', 'O')),
    payer AS (SELECT v.site, v.person_id, v.visit_occurrence_id FROM lineitem l
      JOIN visits v ON l.l_orderkey = v.visit_occurrence_id)
    SELECT 'icu' AS cohort, * FROM icu UNION ALL SELECT 'payer', * FROM payer""",
)
def transfers_and_payers(spark, folder):
    seen = v.visits(spark, folder)
    transfers = seen.withColumnRenamed("visit_source_concept_id", "service_concept_id")
    icu = cohorts.icu_transfers(transfers, ("P", "O"))
    payers = table(spark, folder, "lineitem").selectExpr("l_orderkey AS visit_occurrence_id")
    columns = ["site", "person_id", "visit_occurrence_id"]
    return (
        icu.select(F.lit("icu").alias("cohort"), *columns)
        .unionByName(
            cohorts.payer_persons(payers, seen).select(F.lit("payer").alias("cohort"), *columns)
        )
    )


@query(
    "co_14",
    BY_REGION + """, stays AS (
      SELECT v.site, v.person_id, v.visit_occurrence_id, v.visit_concept_id, v.visit_start_date,
             max(f.fact_date) AS visit_end_date
      FROM visits v JOIN facts f USING (visit_occurrence_id) GROUP BY ALL)
    SELECT *, CAST(visit_end_date - visit_start_date AS DOUBLE) AS los FROM stays
    WHERE visit_concept_id IN ('1-URGENT', '2-HIGH') AND visit_end_date - visit_start_date > 2""",
)
def long_stays(spark, folder):
    ends = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("visit_occurrence_id"))
        .agg(F.max(F.col("l_shipdate").cast("date")).alias("visit_end_date"))
    )
    stays = (
        v.visits(spark, folder)
        .select(
            "site", "person_id", "visit_occurrence_id", "visit_concept_id", "visit_start_date"
        )
        .join(ends, "visit_occurrence_id")
    )
    return cohorts.long_visits(stays, INPATIENT)


def _specialty_sql(region: str, visit: str | None = None) -> str:
    """General specialty: nation 2."""
    extra = f" AND visit_concept_id = '{visit}'" if visit else ""
    return f"""
    SELECT f.site, f.visit_occurrence_id, f.line_number, f.concept_id, f.provider_id,
           f.care_site_id, f.visit_concept_id,
           CASE WHEN ps.k <> 2 THEN ps.k WHEN cs.k <> 2 THEN cs.k
                WHEN ps.k = 2 OR cs.k = 2 THEN 2 ELSE 0 END AS visit_specialty_concept_id
    FROM facts f
    LEFT JOIN (SELECT s_suppkey, s_nationkey AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{region}') ps
      ON f.provider_id = ps.s_suppkey
    LEFT JOIN (SELECT n_nationkey, n_nationkey AS k FROM nation
               JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{region}') cs
      ON f.care_site_id = cs.n_nationkey
    WHERE (ps.k IS NOT NULL OR cs.k IS NOT NULL){extra}"""


GENERAL = 2


def _attended(spark, folder):
    """Order lines as visits with a provider and a care site."""
    return v.facts(spark, folder).select(
        "site",
        "visit_occurrence_id",
        "line_number",
        "concept_id",
        "provider_id",
        "care_site_id",
        "visit_concept_id",
    )


def _dimensions(spark, folder, region):
    return (
        v.providers(spark, folder),
        v.care_sites(spark, folder),
        v.region_nations(spark, folder, region),
    )


@query(
    "co_15",
    f"""{BY_REGION}
    SELECT 'nephrology' AS kind, * FROM ({_specialty_sql('AMERICA')})
    UNION ALL SELECT 'oncology', * FROM ({_specialty_sql('EUROPE')})
    UNION ALL SELECT 'general', * FROM ({_specialty_sql('ASIA', OFFICE)})""",
)
def three_specialties(spark, folder):
    regions = {"nephrology": "AMERICA", "oncology": "EUROPE", "general": "ASIA"}
    return cohorts.visits_by_specialty(
        _attended(spark, folder),
        v.providers(spark, folder),
        v.care_sites(spark, folder),
        {kind: v.region_nations(spark, folder, region) for kind, region in regions.items()},
        visit_concepts={"general": OFFICE},
        general=GENERAL,
        label="kind",
    )


@query(
    "co_16",
    BY_REGION + """, coded AS (
      SELECT site, person_id, visit_occurrence_id FROM facts JOIN part ON concept_id = p_partkey
        WHERE p_brand = 'Brand#9' AND fact_type = 'A'
      UNION
      SELECT site, person_id, visit_occurrence_id FROM facts JOIN part ON concept_id = p_partkey
        WHERE p_brand = 'Brand#9' AND fact_type = 'N')
    SELECT DISTINCT c.site, c.person_id, c.visit_occurrence_id, v.visit_concept_id, v.visit_start_date
    FROM coded c JOIN visits v USING (visit_occurrence_id) WHERE v.visit_concept_id = '3-MEDIUM'""",
)
def well_care(spark, folder):
    rows = v.facts(spark, folder)
    tables = [(rows.filter(F.col("fact_type") == kind), "concept_id") for kind in ("A", "N")]
    codes = v.brand(spark, folder, "Brand#9")
    return cohorts.coded_visits(tables, codes, v.visits(spark, folder), OFFICE)


@query("co_17", BY_REGION + _specialty_sql("AMERICA"))
def specialty_visits(spark, folder):
    return cohorts.specialty_visits(
        _attended(spark, folder), *_dimensions(spark, folder, "AMERICA"), general=GENERAL
    )


@query(
    "co_18",
    """
    SELECT 'vodi' AS kind, l_orderkey, l_linenumber, l_partkey, l_returnflag, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'A' AND o_orderpriority IN ('3-MEDIUM')
    UNION ALL
    SELECT 'vipdp', l_orderkey, l_linenumber, l_partkey, l_returnflag, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT 'prvo', l_orderkey, l_linenumber, l_partkey, l_returnflag, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority IN ('3-MEDIUM')
    """,
)
def facts_by_setting(spark, folder):
    seen = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS visit_occurrence_id", "o_orderpriority AS visit_concept_id"
    )
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS visit_occurrence_id", "l_linenumber", "l_partkey", "l_returnflag"
    )
    settings = {
        "vodi": cohorts.Setting((OFFICE,), "A"),
        "vipdp": cohorts.Setting(INPATIENT, "R"),
        "prvo": cohorts.Setting((OFFICE,)),
    }
    found = cohorts.facts_by_setting(lines, seen, settings, "l_returnflag", label="kind")
    return found.withColumnsRenamed(
        {"visit_occurrence_id": "l_orderkey", "visit_concept_id": "o_orderpriority"}
    )


@query(
    "co_20",
    BY_REGION + """ SELECT DISTINCT site, person_id FROM facts JOIN part ON concept_id = p_partkey
      WHERE p_brand = 'Brand#1' AND fact_type = 'A'
    INTERSECT
    SELECT site, person_id FROM facts JOIN part ON concept_id = p_partkey
      WHERE p_brand IN ('Brand#2', 'Brand#3') AND fact_type = 'R'""",
)
def code_and_lab(spark, folder):
    rows = v.facts(spark, folder)
    return cohorts.persons_with_code_and_lab(
        rows.filter(F.col("fact_type") == "A"),
        v.brand(spark, folder, "Brand#1"),
        rows.filter(F.col("fact_type") == "R"),
        v.brand(spark, folder, "Brand#2", "Brand#3"),
        "concept_id",
        "concept_id",
    )


@query(
    "co_21",
    """
    SELECT CAST(r_regionkey + 1000 AS BIGINT) AS concept_id FROM region WHERE r_name <> 'ASIA'
    UNION
    SELECT CAST(n_nationkey AS BIGINT) FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'ASIA'
    """,
)
def descendants(spark, folder):
    codes = (
        table(spark, folder, "region")
        .filter(F.col("r_name") != "ASIA")
        .selectExpr("CAST(r_regionkey + 1000 AS BIGINT) AS concept_id")
    )
    ancestors = table(spark, folder, "nation").selectExpr(
        "CAST(n_regionkey + 1000 AS BIGINT) AS ancestor_concept_id",
        "CAST(n_nationkey AS BIGINT) AS descendant_concept_id",
    )
    return cohorts.with_descendants(codes, ancestors)


@query(
    "co_19",
    BY_REGION + " SELECT site, person_id, visit_occurrence_id, f.concept_id, fact_date FROM facts f"
    " JOIN part ON f.concept_id = p_partkey WHERE p_brand = 'Brand#6' AND fact_type = 'N'",
)
def immunisations_in_code_set(spark, folder):
    given = v.facts(spark, folder).filter(F.col("fact_type") == "N")
    columns = ["site", "person_id", "visit_occurrence_id", "concept_id", "fact_date"]
    codes = v.brand(spark, folder, "Brand#6")
    return cohorts.facts_in_code_set(given, codes, "concept_id", columns)
