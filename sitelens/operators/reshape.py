"""Long to wide, wide to long, and the same statistics over several columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sitelens.operators.joins import null_safe_join


def stack(df: DataFrame, keep: Sequence[str], rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per input row and entry of rows, each entry naming the same columns."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    exploded = df.select(*keep, F.explode(F.array(*structs)).alias("__row"))
    return exploded.select(*keep, "__row.*")


def wide(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    values_from: str,
    names: Sequence,
) -> DataFrame:
    """One column per name; other names are left out."""
    return df.groupBy(*keys).pivot(names_from, list(names)).agg(F.max(values_from))


SPREAD_NAMES = ("min_val", "max_val", "q1_val", "q3_val", "med_val", "mean_val", "sd_val")

#: The quartiles by the quarter they close.
QUARTILES = {1: "q1_val", 2: "med_val", 3: "q3_val"}

#: Values are counted in intervals whose width is about one part in so many of the value.
RELATIVE = 1 << 16

def spread(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Minimum, maximum, quartiles, mean and sample standard deviation of a column, one row per
    group that has a value."""
    value = F.col(column).cast("double").alias("__value")
    return _spreads(df.select(*keys, value), keys)


def column_spreads(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], label: str = "metadata_type"
) -> DataFrame:
    """Spread of several columns, one row per group and column that has a value in it.

    The columns are turned into rows, of which only counts per distinct value go on, so the input is
    scanned once.
    """
    rows = [{label: F.lit(c), "__value": F.col(c).cast("double")} for c in columns]
    return _spreads(stack(df, keys, rows), [*keys, label])


def _spreads(values: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Spread of `__value`, null values left out.

    One aggregation gives the moments of a group and how often each distinct value occurs in it. The
    quartiles are values of the group: the smallest ones up to which at least one, two and three
    quarters of its rows reach. Values are counted in narrow intervals; cumulated, these tell the
    interval that holds a rank, and only its values are taken in order. So no sketch grows with the
    accuracy that is asked for, and no task sees more of a group than its intervals, or the distinct
    values of one of them.
    """
    moments = {
        "min_val": F.min("__value"),
        "max_val": F.max("__value"),
        "mean_val": F.avg("__value"),
        "sd_val": F.stddev_samp("__value"),
    }
    known = values.filter(F.col("__value").isNotNull()).withColumn("__distinct", F.col("__value"))
    counted = known.groupingSets(
        [[*groups, "__distinct"], list(groups)], *groups, "__distinct"
    ).agg(
        F.grouping_id().alias("__set"),
        F.count(F.lit(1)).alias("__n"),
        *[column.alias(name) for name, column in moments.items()],
    )
    # Asking for every column keeps both parts alike up to the shuffle, so that they share it.
    counted = counted.filter(F.coalesce(*moments).isNotNull() & (F.col("__n") > 0))
    totals = counted.filter(F.col("__set") != 0).select(*groups, *moments)
    counts = counted.filter(F.col("__set") == 0).select(
        *groups, "__n", F.col("__distinct").alias("__value"), _interval("__distinct").alias("__interval")
    )
    whole = Window.partitionBy(*groups)
    intervals = (
        counts.groupBy(*groups, "__interval")
        .agg(F.sum("__n").alias("__n"))
        .withColumns(
            {"__before": _before(groups, "__interval"), "__rows": F.sum("__n").over(whole)}
        )
    )
    # The smallest rank that closes a quarter.
    closing = F.array(*[F.expr(f"struct({k} AS q, (__rows * {k} + 3) div 4 AS rank)") for k in QUARTILES])
    before = F.col("__before")
    inside = lambda x: (x["rank"] > before) & (x["rank"] <= before + F.col("__n"))
    rest = lambda x: F.struct(x["q"].alias("__q"), (x["rank"] - before).alias("__rank"))
    picked = intervals.select(
        *groups,
        "__interval",
        F.explode(F.transform(F.filter(closing, inside), rest)).alias("__x"),
    ).select(*groups, "__interval", "__x.*")
    quarter = [*groups, "__q"]
    last = null_safe_join(counts, picked, on=[*groups, "__interval"])
    upto = F.sum("__n").over(_ordered(quarter, "__value").rowsBetween(Window.unboundedPreceding, 0))
    # Of the values from the rank on, the smallest.
    quartiles = (
        last.withColumn("__upto", upto)
        .filter(F.col("__upto") >= F.col("__rank"))
        .groupBy(*groups)
        .agg(
            *[
                F.min(F.when(F.col("__q") == k, F.col("__value"))).alias(name)
                for k, name in QUARTILES.items()
            ]
        )
    )
    return null_safe_join(totals, quartiles, on=groups).select(*groups, *SPREAD_NAMES)


def _interval(value: str) -> Column:
    """The interval of a value, wider the farther it is from zero. Never falls as the value grows."""
    size = F.log1p(F.abs(F.col(value))) * F.signum(value)
    # Infinite values, and those that are no numbers, are beyond all others.
    held = F.least(F.greatest(F.nanvl(size, F.lit(1001.0)), F.lit(-1000.0)), F.lit(1001.0))
    return F.floor(held * RELATIVE).cast("int")


def _ordered(groups: Sequence[str], column: str) -> WindowSpec:
    return Window.partitionBy(*groups).orderBy(column)


def _before(groups: Sequence[str], column: str) -> Column:
    """Rows of the group before this interval."""
    window = _ordered(groups, column).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("__n").over(window), F.lit(0))
