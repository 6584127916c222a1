"""Medication study: how completely and plausibly drug fields are filled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import (
    all_present,
    days_between,
    is_unmapped,
    not_in,
    proportion,
    zero_if_null,
)
from sitelens.operators.groups import first_row
from sitelens.operators.joins import decode
from sitelens.operators.reshape import column_spreads, spread, stack, wide
from sitelens.operators.sets import union_all
from sitelens.plans import fixed
from sitelens.plans.checks.common import matching_rows
from sitelens.plans.checks.unmapped import Measure, count_unmapped
from sitelens.plans.cohorts import with_descendants


@dataclass(frozen=True)
class Field:
    """A drug field; codes lists values that count as unmapped besides null."""

    check_id: str
    description: str
    column: str
    codes: tuple = ()


@dataclass(frozen=True)
class FieldGroup:
    """Fields needed together: a row is populated when the condition holds."""

    check_id: str
    description: str
    populated: Column


# The drug fields that are studied. Which codes make a dose unit unmapped is our
# reading; the others count as unmapped only when null.
FIELDS = (
    Field(
        "drugs-doseunits", "Prescription Dose Unit", "dose_unit_concept_id", fixed.NULL_CONCEPTS
    ),
    Field("drugs-dose", "Prescription Dosage", "effective_drug_dose"),
    Field("drugs-end", "Prescription End Date", "drug_exposure_end_date"),
    Field("drugs-refill", "Prescription Refills", "refills"),
    Field("drugs-quantity", "Prescription Quantity", "quantity"),
    Field("drugs-dayssupply", "Prescription Days Supply", "days_supply"),
    Field("drugs-freq", "Prescription Frequency", "frequency"),
)


def standard_groups() -> tuple[FieldGroup, ...]:
    return (
        FieldGroup(
            "drugs-refquantdays",
            "Prescription Refills, Quantity, and Days Supply",
            all_present("refills", "quantity", "days_supply"),
        ),
        FieldGroup(
            "drugs-dose_unit",
            "Prescription Dosage & Dose Unit",
            all_present("effective_drug_dose")
            & not_in("dose_unit_concept_id", fixed.NULL_CONCEPTS),
        ),
    )


HEADER = (
    "check_name",
    "check_description",
    "check_type",
    "database_version",
    "total_rows",
)


def prescriptions(
    drugs: DataFrame, type_concept=fixed.PRESCRIPTION, type_field: str = "drug_type_concept_id"
) -> DataFrame:
    return drugs.filter(F.col(type_field) == type_concept)


def field_population(
    drugs: DataFrame,
    version: str,
    fields: Sequence[Field] = FIELDS,
    keys: Sequence[str] = ("site",),
    check_string: str = "uc",
) -> DataFrame:
    """Unpopulated rows and share per field, all fields in one scan."""
    measures = [
        Measure(
            f"{check_string}_{f.check_id}",
            f.description,
            F.lit(True),
            is_unmapped(f.column, f.codes, null_counts=True),
        )
        for f in fields
    ]
    return (
        count_unmapped(drugs, list(keys), measures)
        .withColumns(
            {
                "check_type": F.lit(check_string),
                "database_version": F.lit(version),
                "unmapped_prop": zero_if_null(proportion("unmapped_rows", "total_rows")),
            }
        )
        .select(*keys, *HEADER, "unmapped_rows", "unmapped_prop")
    )


def joint_population(
    drugs: DataFrame,
    version: str,
    groups: Sequence[FieldGroup] | None = None,
    keys: Sequence[str] = ("site",),
    check_string: str = "uc",
) -> DataFrame:
    """Rows in which all fields of a group are populated, and the share in which not.

    The share is one minus the populated share rounded to two places.
    """
    chosen = list(groups if groups is not None else standard_groups())
    counts = drugs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(g.populated).alias(f"__{i}") for i, g in enumerate(chosen)],
    )
    rows = stack(
        counts,
        keys,
        [
            {
                "check_name": F.lit(f"{check_string}_{g.check_id}"),
                "check_description": F.lit(g.description),
                "total_rows": F.col("__total"),
                "populated_rows": F.col(f"__{i}"),
            }
            for i, g in enumerate(chosen)
        ],
    )
    return rows.withColumns(
        {
            "check_type": F.lit(check_string),
            "database_version": F.lit(version),
            "unmapped_prop": F.lit(1.0)
            - F.round(proportion("populated_rows", "total_rows"), 2),
        }
    ).select(*keys, *HEADER, "populated_rows", "unmapped_prop")


def population(
    drugs: DataFrame,
    version: str,
    fields: Sequence[Field] = FIELDS,
    groups: Sequence[FieldGroup] | None = None,
    keys: Sequence[str] = ("site",),
) -> DataFrame:
    """Single fields and field groups together, from one aggregation."""
    return _population(drugs, fields, groups, keys, F.lit(version))


def population_by_version(
    drugs: DataFrame,
    versions: Mapping[str, Column | None],
    fields: Sequence[Field] = FIELDS,
    groups: Sequence[FieldGroup] | None = None,
    keys: Sequence[str] = ("site",),
) -> DataFrame:
    """Population of several data versions, each the rows that meet a predicate (None: all), from one
    scan and one aggregation in which the version is a key."""
    items = [(version, predicate, {}) for version, predicate in versions.items()]
    rows = matching_rows(drugs, items, drugs.columns).withColumnRenamed("check_name", "__version")
    return _population(rows, fields, groups, [*keys, "__version"], F.col("__version")).drop("__version")


def _population(
    drugs: DataFrame,
    fields: Sequence[Field],
    groups: Sequence[FieldGroup] | None,
    keys: Sequence[str],
    version: Column,
    check_string: str = "uc",
) -> DataFrame:
    chosen = list(groups if groups is not None else standard_groups())
    unmapped = [
        F.count_if(is_unmapped(f.column, f.codes, null_counts=True)).alias(f"__field_{i}")
        for i, f in enumerate(fields)
    ]
    populated = [F.count_if(g.populated).alias(f"__group_{i}") for i, g in enumerate(chosen)]
    counts = drugs.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_rows"), *unmapped, *populated)

    def row(of: Field | FieldGroup, unmapped: Column, populated: Column, share: Column) -> dict:
        return {
            "check_name": F.lit(f"{check_string}_{of.check_id}"),
            "check_description": F.lit(of.description),
            "unmapped_rows": unmapped.cast("long"),
            "unmapped_prop": share,
            "populated_rows": populated.cast("long"),
        }

    none = F.lit(None)
    rows = [
        row(f, F.col(f"__field_{i}"), none, zero_if_null(proportion(f"__field_{i}", "total_rows")))
        for i, f in enumerate(fields)
    ] + [
        row(
            g,
            none,
            F.col(f"__group_{i}"),
            F.lit(1.0) - F.round(proportion(f"__group_{i}", "total_rows"), 2),
        )
        for i, g in enumerate(chosen)
    ]
    headed = {"check_type": F.lit(check_string), "database_version": version}
    return (
        stack(counts, [*keys, "total_rows"], rows)
        .withColumns(headed)
        .select(*keys, *HEADER, "unmapped_rows", "unmapped_prop", "populated_rows")
    )


def drug_classes(
    code_sets: Mapping[str, DataFrame], ancestors: DataFrame | None = None
) -> DataFrame:
    """One labelled list of the concepts of all drug classes, with their descendants."""
    labelled = union_all(
        codes.select("concept_id").withColumn("drug_type", F.lit(name))
        for name, codes in code_sets.items()
    ).distinct()
    return labelled if ancestors is None else with_descendants(labelled, ancestors)


def drugs_by_class(
    drugs: DataFrame, classes: DataFrame, field: str = "drug_concept_id"
) -> DataFrame:
    """Drug records with their class; a record appears once per class that holds its concept."""
    side = classes.select(F.col("concept_id").alias("__code"), "drug_type")
    return drugs.join(side, F.col(field) == F.col("__code")).drop("__code")


def population_by_class(
    drugs: DataFrame,
    classes: DataFrame,
    version: str,
    fields: Sequence[Field] = FIELDS,
    groups: Sequence[FieldGroup] | None = None,
    field: str = "drug_concept_id",
) -> DataFrame:
    """Field population of all sites and drug classes in one join."""
    return population(
        drugs_by_class(drugs, classes, field), version, fields, groups, ("site", "drug_type")
    )


def dose_distribution(
    drugs: DataFrame,
    keys: Sequence[str] = ("site", "drug_type"),
    dose: str = "effective_drug_dose",
    unit: str = "dose_unit_concept_id",
    null_units: Sequence = fixed.NULL_CONCEPTS,
    no_unit=0,
) -> DataFrame:
    """Spread of the dose per unit; units that say nothing are put together."""
    named = F.when(F.col(unit).isin(list(null_units)), F.lit(no_unit)).otherwise(F.col(unit))
    doses = spread(drugs.withColumn(unit, named), [*keys, unit], dose)
    return doses.withColumn("metadata_type", F.lit("dose"))


def with_length(
    drugs: DataFrame,
    start: str = "drug_exposure_start_date",
    end: str = "drug_exposure_end_date",
) -> DataFrame:
    return drugs.withColumn("rx_length", days_between(start, end))


LENGTH_COLUMNS = ("refills", "quantity", "days_supply", "rx_length")


def column_distributions(
    drugs: DataFrame,
    keys: Sequence[str] = ("site", "drug_type"),
    columns: Sequence[str] = LENGTH_COLUMNS,
) -> DataFrame:
    """Spread of refills, quantity, days supply and length."""
    return column_spreads(drugs, keys, columns)


def tracking(
    results: DataFrame,
    versions: Sequence[str],
    grouped: bool = False,
    pattern: str = "and|&",
    keys: Sequence[str] = ("site", "check_description"),
) -> DataFrame:
    """Populated share by site and field, one column per data version.

    grouped picks the checks over several fields, which the pattern tells from single fields.
    """
    joint = F.col("check_description").rlike(pattern)
    rows = results.filter(joint if grouped else ~joint).withColumn(
        "populated_prop", F.lit(1.0) - F.col("unmapped_prop")
    )
    return wide(rows, keys, "database_version", "populated_prop", versions)


def dose_plot_data(
    distributions: DataFrame,
    concept: DataFrame,
    order: Sequence[str],
    unit: str = "dose_unit_concept_id",
) -> DataFrame:
    """Dose spreads with the unit's name ('NA' for none), one row per site and unit."""
    doses = distributions.filter(F.col("metadata_type") == "dose")
    named = decode(doses, concept, unit, {"concept_name": "concept_name"}).withColumn(
        "concept_name", F.when(F.col(unit).isNull(), F.lit("NA")).otherwise(F.col("concept_name"))
    )
    return first_row(named, ["site", "concept_name"], order)


# Fixed value: the long label of the prescription length.
LENGTH_LABEL = "rx length in days \n(end date - start date)"


def metadata_plot_data(distributions: DataFrame, order: Sequence[str]) -> DataFrame:
    """Spreads of the other fields with long labels, one row per site and field."""
    rows = distributions.filter(F.col("metadata_type") != "dose").withColumn(
        "metadata_type",
        F.when(F.col("metadata_type") == "rx_length", F.lit(LENGTH_LABEL)).otherwise(
            F.col("metadata_type")
        ),
    )
    return first_row(rows, ["site", "metadata_type"], order)
