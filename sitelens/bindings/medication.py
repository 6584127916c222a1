"""The medication study on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.bindings import views as v
from sitelens.bindings.registry import query
from sitelens.bindings.relational import rounded, spread_sql
from sitelens.bindings.views import BY_REGION, PREVIOUS_VERSION, VERSION
from sitelens.functions.columns import all_present, not_in
from sitelens.plans import medication
from sitelens.plans.medication import Field, FieldGroup

# Drug fields with nulls made from keys; the dose unit is the concept of the fact type.
DRUG_COLUMNS = {
    "refills": "CASE WHEN concept_id % 3 = 0 THEN NULL ELSE CAST(line_number AS DOUBLE) END",
    "quantity": "CASE WHEN concept_id % 5 = 0 THEN NULL ELSE value END",
    "days_supply": "CASE WHEN concept_id % 7 = 0 THEN NULL ELSE tax END",
    "effective_drug_dose": "CASE WHEN provider_id % 4 = 0 THEN NULL ELSE discount END",
    "dose_unit_concept_id": "CASE WHEN provider_id % 6 = 0 THEN NULL WHEN fact_type = 'N' THEN 0"
    " WHEN fact_type = 'R' THEN 44814650 ELSE 1 + provider_id % 2 END",
}
DRUG_TYPE = "O"
DRUGS_SQL = (
    "drugs AS (SELECT site, concept_id AS drug_concept_id, visit_start_date, fact_date, "
    + ", ".join(f"{text} AS {name}" for name, text in DRUG_COLUMNS.items())
    + f" FROM facts WHERE source_value = '{DRUG_TYPE}')"
)
CLASSES_SQL = """classes AS (
  SELECT DISTINCT p_partkey AS concept_id, 'rx_one' AS drug_type FROM part WHERE p_brand = 'Brand#1'
  UNION SELECT p_partkey, 'rx_two' FROM part WHERE p_brand IN ('Brand#2', 'Brand#3')
  UNION SELECT p_partkey + 1, 'rx_one' FROM part WHERE p_brand = 'Brand#1' AND p_partkey % 2 = 0),
classed AS (SELECT d.*, c.drug_type FROM drugs d JOIN classes c ON d.drug_concept_id = c.concept_id)"""

FIELDS = (
    Field("drugs-doseunits", "Dose Unit", "dose_unit_concept_id", medication.fixed.NULL_CONCEPTS),
    Field("drugs-dose", "Dosage", "effective_drug_dose"),
    Field("drugs-refill", "Refills", "refills"),
    Field("drugs-quantity", "Quantity", "quantity"),
    Field("drugs-dayssupply", "Days Supply", "days_supply"),
)


def groups():
    return (
        FieldGroup(
            "drugs-refquantdays",
            "Refills, Quantity, and Days Supply",
            all_present("refills", "quantity", "days_supply"),
        ),
        FieldGroup(
            "drugs-dose_unit",
            "Dosage & Dose Unit",
            all_present("effective_drug_dose")
            & not_in("dose_unit_concept_id", medication.fixed.NULL_CONCEPTS),
        ),
    )


CODES = "44814650, 0, 44814653, 44814649"
POPULATED = {
    "drugs-refquantdays": (
        "Refills, Quantity, and Days Supply",
        "refills IS NOT NULL AND quantity IS NOT NULL AND days_supply IS NOT NULL",
    ),
    "drugs-dose_unit": (
        "Dosage & Dose Unit",
        f"effective_drug_dose IS NOT NULL AND dose_unit_concept_id NOT IN ({CODES})",
    ),
}


def field_sql(source: str, keys: str, version: str = VERSION, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT {keys}, 'uc_{f.check_id}' AS check_name, '{f.description}' AS check_description,
          'uc' AS check_type, '{version}' AS database_version, count(*) AS total_rows,
          count(*) FILTER ({f.column} IS NULL{f" OR {f.column} IN ({CODES})" if f.codes else ""})
            AS unmapped_rows, {extra}
          CAST(unmapped_rows AS DOUBLE) / total_rows AS unmapped_prop
        FROM {source} GROUP BY {keys}"""
        for f in FIELDS
    )


def joint_sql(source: str, keys: str, version: str = VERSION, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT {keys}, 'uc_{name}' AS check_name, '{description}' AS check_description,
          'uc' AS check_type, '{version}' AS database_version, count(*) AS total_rows, {extra}
          count(*) FILTER ({condition}) AS populated_rows,
          1 - round(CAST(populated_rows AS DOUBLE) / total_rows, 2) AS unmapped_prop
        FROM {source} GROUP BY {keys}"""
        for name, (description, condition) in POPULATED.items()
    )


def population_sql(source: str, keys: str, version: str = VERSION) -> str:
    return (
        field_sql(source, keys, version, "CAST(NULL AS BIGINT) AS populated_rows,").replace(
            "AS unmapped_rows, CAST", "AS unmapped_rows, CAST"
        )
        + " UNION ALL BY NAME "
        + joint_sql(source, keys, version, "CAST(NULL AS BIGINT) AS unmapped_rows,")
    )


def drugs(spark, folder):
    rows = v.facts(spark, folder)
    chosen = medication.prescriptions(rows, DRUG_TYPE, "source_value")
    return chosen.select(
        "site",
        F.col("concept_id").alias("drug_concept_id"),
        "visit_start_date",
        "fact_date",
        *[F.expr(text).alias(name) for name, text in DRUG_COLUMNS.items()],
    )


def classes(spark, folder):
    one = v.brand(spark, folder, "Brand#1")
    ancestors = one.filter(F.col("concept_id") % 2 == 0).selectExpr(
        "concept_id AS ancestor_concept_id", "concept_id + 1 AS descendant_concept_id"
    )
    sets = {"rx_one": one, "rx_two": v.brand(spark, folder, "Brand#2", "Brand#3")}
    return medication.drug_classes(sets, ancestors.filter(F.col("ancestor_concept_id") >= 0))


@query("dm_01", f"{BY_REGION}, {DRUGS_SQL} {field_sql('drugs', 'site')}")
def field_population(spark, folder):
    return medication.field_population(drugs(spark, folder), VERSION, FIELDS)


@query("dm_02", f"{BY_REGION}, {DRUGS_SQL} {joint_sql('drugs', 'site')}")
def joint_population(spark, folder):
    return medication.joint_population(drugs(spark, folder), VERSION, groups())


@query(
    "dm_03",
    f"{BY_REGION}, {DRUGS_SQL}, {CLASSES_SQL} {population_sql('classed', 'site, drug_type')}",
)
def population_by_class(spark, folder):
    return medication.population_by_class(
        drugs(spark, folder), classes(spark, folder), VERSION, FIELDS, groups()
    )


DOSE_SQL = f"""SELECT site, drug_type, dose_unit_concept_id, {spread_sql('effective_drug_dose')},
  'dose' AS metadata_type
FROM (SELECT * REPLACE (CASE WHEN dose_unit_concept_id IN ({CODES}) THEN 0
                             ELSE dose_unit_concept_id END AS dose_unit_concept_id) FROM classed)
WHERE effective_drug_dose IS NOT NULL GROUP BY site, drug_type, dose_unit_concept_id"""


def doses(spark, folder):
    classed = medication.drugs_by_class(drugs(spark, folder), classes(spark, folder))
    return rounded(medication.dose_distribution(classed))


@query("dm_04", f"{BY_REGION}, {DRUGS_SQL}, {CLASSES_SQL} {DOSE_SQL}")
def dose_distribution(spark, folder):
    return doses(spark, folder)


LENGTH_SQL = " UNION ALL ".join(
    f"""SELECT site, drug_type, '{name}' AS metadata_type, {spread_sql(name)}
    FROM (SELECT *, fact_date - visit_start_date AS rx_length FROM classed)
    WHERE {name} IS NOT NULL GROUP BY site, drug_type"""
    for name in ("refills", "quantity", "days_supply", "rx_length")
)


def lengths(spark, folder):
    classed = medication.drugs_by_class(drugs(spark, folder), classes(spark, folder))
    timed = medication.with_length(classed, "visit_start_date", "fact_date")
    return rounded(medication.column_distributions(timed))


@query("dm_05", f"{BY_REGION}, {DRUGS_SQL}, {CLASSES_SQL} {LENGTH_SQL}")
def column_distributions(spark, folder):
    return lengths(spark, folder)


def _tracking_sql(grouped: bool) -> str:
    test = "" if grouped else "NOT "
    older = population_sql("(SELECT * FROM drugs WHERE fact_date < DATE '2001-01-01')", "site",
                           PREVIOUS_VERSION)
    return f"""{BY_REGION}, {DRUGS_SQL},
      results AS ({population_sql('drugs', 'site')} UNION ALL BY NAME {older})
      SELECT site, check_description,
        max(1 - unmapped_prop) FILTER (database_version = '{PREVIOUS_VERSION}') AS {PREVIOUS_VERSION},
        max(1 - unmapped_prop) FILTER (database_version = '{VERSION}') AS {VERSION}
      FROM results WHERE {test}regexp_matches(check_description, 'and|&')
      GROUP BY site, check_description"""


def results(spark, folder):
    versions = {VERSION: None, PREVIOUS_VERSION: F.col("fact_date") < "2001-01-01"}
    return medication.population_by_version(drugs(spark, folder), versions, FIELDS, groups())


VERSIONS = (PREVIOUS_VERSION, VERSION)


@query("dm_06", _tracking_sql(False))
def tracking(spark, folder):
    return medication.tracking(results(spark, folder), VERSIONS)


@query("dm_06_groups", _tracking_sql(True))
def tracking_groups(spark, folder):
    return medication.tracking(results(spark, folder), VERSIONS, grouped=True)


ORDER = ("drug_type", "max_val", "min_val", "med_val")
PLOT_ORDER = "drug_type, max_val, min_val, med_val"


@query(
    "dm_07",
    f"""{BY_REGION}, {DRUGS_SQL}, {CLASSES_SQL}, doses AS ({DOSE_SQL}),
    named AS (
      SELECT d.*, CASE WHEN d.dose_unit_concept_id IS NULL THEN 'NA' ELSE k.concept_name END
                    AS concept_name
      FROM doses d LEFT JOIN concept k ON d.dose_unit_concept_id = k.concept_id)
    SELECT * FROM named QUALIFY row_number() OVER (
      PARTITION BY site, concept_name
      ORDER BY {PLOT_ORDER}, dose_unit_concept_id NULLS FIRST) = 1""",
)
def dose_plot_data(spark, folder):
    return medication.dose_plot_data(doses(spark, folder), v.concept(spark, folder), ORDER)


@query(
    "dm_07_fields",
    f"""{BY_REGION}, {DRUGS_SQL}, {CLASSES_SQL}, fields AS ({LENGTH_SQL})
    SELECT * REPLACE (CASE WHEN metadata_type = 'rx_length'
                           THEN 'rx length in days ' || chr(10) || '(end date - start date)'
                           ELSE metadata_type END AS metadata_type)
    FROM fields QUALIFY row_number() OVER (
      PARTITION BY site, metadata_type ORDER BY {PLOT_ORDER}) = 1""",
)
def metadata_plot_data(spark, folder):
    return medication.metadata_plot_data(lengths(spark, folder), ORDER)
