"""Distribution of a value over sites, outlier flags, and their suppression for plots.

Groups hold one row per site. The formulas are our definitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.operators.groups import TOTAL, with_result_values


def distribution(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    min_values: int = 3,
    sites_only: bool = False,
) -> DataFrame:
    """Rows plus mean, median, sd, mad, min and max of their group.

    A group is eligible for outlier detection with at least min_values values that differ.
    With sites_only, rows for all sites together neither count nor receive statistics.
    """
    counted = F.col("site") != TOTAL if sites_only else F.lit(True)
    column = F.when(counted, F.col(value).cast("double"))
    stated = with_result_values(
        df,
        group,
        {
            "mean_val": F.avg(column),
            "median_val": F.median(column),
            "sd_val": F.stddev_samp(column),
            "min_val": F.min(column),
            "max_val": F.max(column),
            "__n": F.count(column),
        },
    )
    centred = with_result_values(
        stated, group, {"mad_val": F.median(F.abs(column - F.col("median_val")))}
    )
    eligible = (F.col("__n") >= min_values) & (F.col("min_val") < F.col("max_val"))
    judged = centred.withColumn(
        "analysis_eligible", F.when(eligible, F.lit("yes")).otherwise(F.lit("no"))
    ).drop("__n")
    if not sites_only:
        return judged
    return judged.withColumns(
        {name: F.when(counted, F.col(name)) for name in judged.columns if name not in df.columns}
    )


def flag_outliers(
    df: DataFrame, value: str, p: float = 0.9, tail: str = "both"
) -> DataFrame:
    """Rows plus lower_tail, upper_tail and anomaly_yn.

    The tails are mean -/+ z * sd, z being the normal quantile that leaves p between the tails
    (or on one side of a single tail). Rows of groups that are not eligible have no tails;
    rows that were not analysed have no flag either.
    """
    if tail not in ("both", "left", "right"):
        raise ValueError(f"tail is 'both', 'left' or 'right', not {tail!r}")
    z = NormalDist().inv_cdf((1 + p) / 2 if tail == "both" else p)
    eligible = F.col("analysis_eligible") == "yes"
    margin = F.lit(z) * F.col("sd_val")
    low = F.when(eligible, F.col("mean_val") - margin) if tail != "right" else F.lit(None)
    high = F.when(eligible, F.col("mean_val") + margin) if tail != "left" else F.lit(None)
    outside = F.coalesce(F.col(value) < F.col("lower_tail"), F.lit(False)) | F.coalesce(
        F.col(value) > F.col("upper_tail"), F.lit(False)
    )
    return df.withColumns(
        {"lower_tail": low.cast("double"), "upper_tail": high.cast("double")}
    ).withColumn(
        "anomaly_yn",
        F.when(F.col("analysis_eligible").isNull(), F.lit(None))
        .when(~eligible, F.lit("not eligible"))
        .when(outside, F.lit("outlier"))
        .otherwise(F.lit("not outlier")),
    )


def suppress_outliers(df: DataFrame, value: str = "prop_total_change") -> DataFrame:
    """Rows plus plot_prop: outliers and totals beyond a tail take the nearest usual value.

    The usual values are the smallest and largest ones per application that are no outliers.
    Totals get the tails of their check and application and are dropped where there are none.
    """
    is_total = F.col("site") == TOTAL
    tails = F.struct("lower_tail", "upper_tail")
    known = F.col("lower_tail").isNotNull() & F.col("upper_tail").isNotNull()
    usual = F.when(F.col("anomaly_yn") != "outlier", F.col(value))
    stated = with_result_values(
        df,
        ["check_name", "application"],
        {"__tails": F.collect_set(F.when(known & ~is_total, tails))},
    )
    stated = with_result_values(
        stated, ["application"], {"__low": F.min(usual), "__high": F.max(usual)}
    )
    chosen = F.when(is_total, F.col("__tails")).otherwise(F.array(tails))
    rows = (
        stated.withColumn("__tails", F.explode(chosen))
        .withColumns(
            {"lower_tail": F.col("__tails.lower_tail"), "upper_tail": F.col("__tails.upper_tail")}
        )
        .drop("__tails")
    )
    clamped = (F.col("anomaly_yn") == "outlier") | is_total
    shown = (
        F.when(clamped & (F.col(value) < F.col("lower_tail")), F.col("__low"))
        .when(clamped & (F.col(value) > F.col("upper_tail")), F.col("__high"))
        .otherwise(F.col(value))
    )
    return rows.withColumn("plot_prop", shown).drop("__low", "__high")
