"""Post-processing of check results: totals over all sites, proportions, change rates.

Inputs are check results: a few rows per site and check. The formulas are our definitions,
chosen to give the columns that the later steps read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.functions.columns import proportion, zero_if_null
from sitelens.operators.groups import with_result_values, with_totals

NAMED = ("check_name", "check_description", "check_type", "database_version")
ROWS_SUFFIX = "_rows"
PERSON_SUFFIX = "_person"


def _application(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumn("check_name_app", F.concat(F.col("check_name"), F.lit(suffix)))


def process_cycle(counts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Relative change per site and application, and for all sites from the summed counts.

    The change is null when there was nothing before.
    """
    keys = [
        "check_name",
        "check_type",
        "database_version",
        "previous_version",
        "domain",
        "application",
    ]
    change = proportion(F.col("current_ct") - F.col("previous_ct"), "previous_ct")
    described = metadata.select("check_name", "check_description").distinct()
    return (
        with_totals(counts, keys, ["current_ct", "previous_ct"])
        .withColumns(
            {
                "prop_total_change": change,
                "check_name_app": F.concat_ws("_", "check_name", "application"),
            }
        )
        .join(described, "check_name", "left")
    )


@dataclass(frozen=True)
class Conformance:
    """Shares per application, and the rejected values behind them.

    `by_value` is the one aggregate that violations and zero rows are read off: a row per site,
    application and value, in which all accepted values are one row.
    """

    processed: DataFrame
    violations: DataFrame
    by_value: DataFrame


def process_conformance(counts: DataFrame, value: str) -> Conformance:
    """Accepted and violating share per site and application, and the rejected values.

    Used for vocabularies (value vocabulary_id) and value sets (value concept_id).
    """
    keys = [*NAMED, "table_application", "measurement_column"]
    accepted = F.coalesce("accepted_value", F.lit(True))
    denominator = F.col("accepted_ct") + F.col("viol_ct")
    flagged = counts.withColumns(
        {
            "accepted_ct": F.when(accepted, F.col("tot_ct")).otherwise(0),
            "viol_ct": F.when(~accepted, F.col("tot_ct")).otherwise(0),
        }
    )
    processed = with_totals(flagged, keys, ["accepted_ct", "viol_ct"]).withColumns(
        {
            "total_denom_ct": denominator,
            "accepted_value": F.col("viol_ct") == 0,
            "prop_accepted": proportion("accepted_ct", denominator),
            "prop_viol": proportion("viol_ct", denominator),
        }
    )
    valued = flagged.withColumn(value, F.when(~accepted, F.col(value)))
    counted = with_totals(valued, [*keys, value], ["accepted_ct", "viol_ct"])
    by_value = with_result_values(
        counted,
        ["site", *keys],
        {"total_denom_ct": F.sum(denominator), "__most": F.max("viol_ct")},
    ).withColumnRenamed("viol_ct", "tot_ct")
    violations = by_value.filter(F.col("tot_ct") > 0).withColumns(
        {
            "accepted_value": F.lit(False),
            "tot_prop": proportion("tot_ct", "total_denom_ct"),
        }
    )
    return Conformance(processed, violations.drop("accepted_ct", "__most"), by_value)


ZERO_KEYS = (
    "site",
    "table_application",
    "measurement_column",
    "check_type",
    "check_name",
    "total_denom_ct",
    "check_description",
)


def with_zero_rows(result: Conformance) -> DataFrame:
    """Violations, plus a zero row for every application without one.

    An application without a violation has one row in the aggregate, that of its accepted values.
    """
    violating = F.col("tot_ct") > 0
    share = zero_if_null(proportion("tot_ct", "total_denom_ct"))
    rows = (
        result.by_value.filter(violating | (F.col("__most") == 0))
        .withColumn("accepted_value", F.lit(False))
        .withColumn("tot_prop", share)
    )
    # What a zero row says besides its application is nothing.
    rest = [
        F.col(name) if name in ("tot_ct", "tot_prop") else F.when(violating, F.col(name)).alias(name)
        for name in result.violations.columns
        if name not in ZERO_KEYS
    ]
    return _application(rows.select(*ZERO_KEYS, *rest), ROWS_SUFFIX)


def process_unmapped(counts: DataFrame) -> DataFrame:
    """Unmapped share per site and for all sites; by year when the counts are by year."""
    yearly = "year_date" in counts.columns
    keys = [*NAMED, "year_date"] if yearly else list(NAMED)
    totals = with_totals(counts, keys, ["total_rows", "unmapped_rows"])
    share = proportion("unmapped_rows", "total_rows")
    if yearly:
        return totals.withColumn("prop_total", share)
    return totals.withColumn("unmapped_prop", share)


def process_missing_visits(counts: DataFrame) -> DataFrame:
    sums = ["total_rows", "null_visit_rows", "unknown_visit_rows"]
    missing = F.col("null_visit_rows") + F.col("unknown_visit_rows")
    rows = with_totals(counts, [*NAMED, "domain"], sums).withColumn(
        "prop_missing_visits_total", zero_if_null(proportion(missing, "total_rows"))
    )
    return _application(rows, ROWS_SUFFIX)


def process_best_mapped(counts: DataFrame) -> DataFrame:
    """Rows with best and with other concepts, and their share of all rows."""
    rows = with_totals(counts, [*NAMED, "best_notbest"], ["row_cts"])
    shares = with_result_values(
        rows, ["site", *NAMED], {"total_rows": F.sum("row_cts")}
    ).withColumn("best_row_prop", proportion("row_cts", "total_rows"))
    return _application(shares, ROWS_SUFFIX)


def process_expected(counts: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Share of cohort persons with the concept, with the check's category if given."""
    keys = [*NAMED, "cohort_definition", "concept_group"]
    rows = with_totals(counts, keys, ["total_pts", "pts_with_concept"]).withColumn(
        "prop_with_concept", zero_if_null(proportion("pts_with_concept", "total_pts"))
    )
    rows = _application(rows, PERSON_SUFFIX)
    if categories is None:
        return rows
    return rows.join(categories.select("check_name", "check_cat"), "check_name", "left")


def process_documentation(counts: DataFrame) -> DataFrame:
    sums = ["total_visits", "fact_visits", "total_pts", "fact_pts"]
    return with_totals(counts, [*NAMED, "visit_type"], sums).withColumns(
        {
            "fact_visits_prop": proportion("fact_visits", "total_visits"),
            "fact_pts_prop": proportion("fact_pts", "total_pts"),
        }
    )


def process_concordance(counts: DataFrame) -> DataFrame:
    return with_totals(counts, [*NAMED, "cohort"], ["value", "total_ct"]).withColumn(
        "prop", proportion("value", "total_ct")
    )


def process_dates(counts: DataFrame) -> DataFrame:
    rows = with_totals(
        counts, [*NAMED, "implausible_type"], ["total_rows", "implausible_row"]
    ).withColumn(
        "prop_implausible", zero_if_null(proportion("implausible_row", "total_rows"))
    )
    return _application(rows, ROWS_SUFFIX)


@dataclass(frozen=True)
class Timeline:
    heuristic: DataFrame
    summary: DataFrame
    ratios: DataFrame


def process_timeline(
    counts: DataFrame, target: str = "row_cts", ratio_mult: float = 10_000
) -> Timeline:
    """How far each month is from its neighbours, a summary of that, and ratios to all visits.

    The heuristic is x / mean(previous month, next month) - 1; null in the first and last
    month and where both neighbours are 0. Ratios are ratio_mult * x over the rows, visits and
    persons of all visits of the site and month. Each data version is a series of its own.
    """
    group = ["site", "check_name"]
    group += [name for name in ("database_version",) if name in counts.columns]
    months = Window.partitionBy(*group).orderBy("time_start")
    neighbours = (F.lag(target).over(months) + F.lead(target).over(months)) / F.lit(2.0)
    heuristic = counts.withColumn("__near", neighbours).withColumn(
        "check", F.try_divide(F.col(target).cast("double"), "__near") - F.lit(1.0)
    )
    described = [name for name in ("check_description", "check_type") if name in counts.columns]
    heuristic = heuristic.select(
        *group, *described, "time_start", "time_end", target, "check"
    )
    value = F.col("check")
    summary = heuristic.groupBy(*group, *described).agg(
        F.avg(value).alias("mean_val"),
        F.median(value).alias("median_val"),
        F.stddev_samp(value).alias("sd_val"),
        F.min(value).alias("min_val"),
        F.max(value).alias("max_val"),
    )
    scaled = F.col(target).cast("double") * F.lit(float(ratio_mult))
    ratios = counts.select(
        *group,
        *described,
        "time_start",
        "time_end",
        target,
        *[
            F.try_divide(scaled, F.col(total).cast("double")).alias(f"ratio_{total[6:]}")
            for total in _totals(counts)
        ],
    )
    return Timeline(heuristic, summary, ratios)


def _totals(counts: DataFrame) -> Sequence[str]:
    return [n for n in ("total_row", "total_visit", "total_pt") if n in counts.columns]
