"""Grouped selections and group-wide values.

Over facts these are aggregations joined back to the rows, or aggregations of whole rows, not
window functions: partial aggregation runs before the shuffle, so a group that holds a large
share of all rows never has to pass through one task. Check results, whose groups hold one row
per site or per distinct value, use a window instead and so are computed once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.operators.joins import null_safe_join

TOTAL = "total"


def rows_at_minimum(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows whose value equals the minimum of their group; ties are kept.

    The minimum is part of the join key, which spreads the rows of a large group.
    """
    minima = df.groupBy(*keys).agg(F.min(column).alias("__minimum"))
    sides = {key: f"__{key}" for key in keys}
    minima = minima.withColumnsRenamed(sides)
    condition = F.col(column) == F.col("__minimum")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(sides[key]))
    return df.join(minima, condition, "leftsemi")


def with_group_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Every row, plus aggregates of its group."""
    aggregates = df.groupBy(*keys).agg(*[c.alias(name) for name, c in values.items()])
    return null_safe_join(df, aggregates, on=keys, how="left")


def with_result_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """As with_group_values, in one pass, for results whose groups are small by construction."""
    group = Window.partitionBy(*keys)
    return df.withColumns({name: column.over(group) for name, column in values.items()})


def first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], largest: bool = False
) -> DataFrame:
    """One row per group: the smallest (or largest) by the order columns.

    Remaining ties are settled by the other columns, so the choice is repeatable.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    row = F.struct(*order, *rest)
    chosen = (F.max if largest else F.min)(row).alias("__row")
    picked = df.groupBy(*keys).agg(chosen)
    return picked.select(*keys, "__row.*").select(*df.columns)


def with_totals(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    site: str = "site",
    label: str = TOTAL,
) -> DataFrame:
    """Sums per site and key, plus rows for all sites together.

    The input is summed per site first; only those few sums are repeated for the total, so
    the input is read once.
    """
    groups = [site, *[key for key in keys if key != site]]
    per_site = df.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in sums])
    both = per_site.withColumn(site, F.explode(F.array(F.col(site), F.lit(label))))
    return both.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in sums])


def without_totals(df: DataFrame, site: str = "site", label: str = TOTAL) -> DataFrame:
    return df.filter(F.col(site) != F.lit(label))


def only_totals(df: DataFrame, site: str = "site", label: str = TOTAL) -> DataFrame:
    return df.filter(F.col(site) == F.lit(label))
