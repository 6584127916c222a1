"""Summary statistics over sites, added to the post-processed results.

Groups hold one row per site, so exact percentiles are cheap. Our definition: the result
keeps the site rows and adds the statistics of their group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import zero_if_null
from sitelens.operators.groups import TOTAL, with_result_values, without_totals

STATISTICS = ("min_val", "q1", "median_val", "mean_val", "q3", "max_val")


def summarize_sites(
    df: DataFrame, value: str, group: Sequence[str], suffix: str = ""
) -> DataFrame:
    """Rows plus min, quartiles, median, mean and max of the value over their group.

    Rows for all sites together neither count nor receive statistics.
    """
    is_site = F.col("site") != F.lit(TOTAL)
    column = F.when(is_site, F.col(value).cast("double"))
    stated = with_result_values(
        df.drop(*[f"{name}{suffix}" for name in STATISTICS]),
        group,
        {
            "__min": F.min(column),
            "__quartiles": F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))),
            "__mean": F.avg(column),
            "__max": F.max(column),
        },
    )
    quartiles = F.col("__quartiles")
    found = (F.col("__min"), quartiles[0], quartiles[1], F.col("__mean"), quartiles[2], F.col("__max"))
    return stated.withColumns(
        {
            f"{name}{suffix}": F.when(is_site, statistic)
            for name, statistic in zip(STATISTICS, found, strict=True)
        }
    ).drop("__min", "__quartiles", "__mean", "__max")


def with_site_summary(
    df: DataFrame,
    value: str,
    group: Sequence[str],
    null_as_zero: bool = False,
    totals: bool = True,
) -> DataFrame:
    """Summary over the site rows; the total rows stay, without statistics."""
    if null_as_zero:
        df = df.withColumn(value, _zero_at_sites(value))
    return summarize_sites(df if totals else without_totals(df), value, group)


def _zero_at_sites(value: str) -> Column:
    is_site = F.col("site") != F.lit(TOTAL)
    return F.when(is_site, zero_if_null(value)).otherwise(F.col(value))


# Per result, the value summarised, the grouping and how it is treated.
PARAMETERS: Mapping[str, Mapping] = {
    "dc": {
        "value": "prop_total_change",
        "group": (
            "domain",
            "check_name",
            "application",
            "check_type",
            "check_name_app",
            "check_description",
        ),
    },
    "vs": {
        "value": "prop_viol",
        "group": ("table_application", "measurement_column", "check_type", "check_name"),
        "totals": False,
    },
    "vc": {
        "value": "prop_viol",
        "group": ("table_application", "measurement_column", "check_type", "check_name"),
        "totals": False,
    },
    "uc": {
        "value": "unmapped_prop",
        "group": ("check_description", "check_name", "check_type"),
        "null_as_zero": True,
    },
    "uc_by_year": {
        "value": "prop_total",
        "group": (
            "check_type",
            "database_version",
            "year_date",
            "check_description",
            "check_name",
        ),
    },
    "bmc": {
        "value": "best_row_prop",
        "group": ("check_name", "check_description", "best_notbest"),
    },
    "dcon": {
        "value": "prop",
        "group": ("cohort", "check_name", "check_description", "check_type"),
    },
    "mf": {
        "value": "prop_missing_visits_total",
        "group": ("check_description", "domain", "check_name", "check_type", "check_name_app"),
    },
    "ecp": {
        "value": "prop_with_concept",
        "group": ("concept_group", "check_name", "check_name_app"),
    },
    "dp": {
        "value": "prop_implausible",
        "group": ("implausible_type", "check_name", "check_description", "check_name_app"),
    },
}


def summarize_check(df: DataFrame, check_string: str) -> DataFrame:
    """Cross-site summary of one post-processed result.

    Value set results without any usable row are left out.
    """
    if check_string == "vs":
        df = df.filter(F.col("total_denom_ct") != 0)
    return with_site_summary(df, **PARAMETERS[check_string])


def summarize_documentation(df: DataFrame) -> DataFrame:
    """Person and visit summaries side by side; the total rows stay, without statistics."""
    group = ["check_description", "check_name", "visit_type"]
    for value, suffix in (("fact_pts_prop", "_pts"), ("fact_visits_prop", "_visits")):
        df = with_site_values(df, value, group, suffix)
    return df


def with_site_values(
    df: DataFrame, value: str, group: Sequence[str], suffix: str
) -> DataFrame:
    """Summary of one value, nulls counting as 0, its columns suffixed."""
    return summarize_sites(df.withColumn(value, _zero_at_sites(value)), value, group, suffix)
