"""Join helpers.

No join is hinted. Spark broadcasts a side when its files are below
``spark.sql.autoBroadcastJoinThreshold``, or when adaptive execution has measured a shuffled
side to be that small; anything larger is shuffled, with skewed partitions split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    names = [name for name in left.columns if name in right.columns]
    if not names:
        raise ValueError("the two inputs share no column")
    return names


def site_keys(left: DataFrame, right: DataFrame, *names: str) -> list[str]:
    """The names, preceded by ``site`` where both sides have it.

    Ids are unique within a site only, so tables that know their site meet within it.
    """
    both = "site" in left.columns and "site" in right.columns
    return ["site", *names] if both else list(names)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every shared column. Null keys match nothing."""
    return left.join(right, on=shared_columns(left, right), how=how)


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join in which a null key equals a null key. Outer joins coalesce the keys.

    ``eqNullSafe`` remains a hash or sort-merge key in Spark, so nothing degrades to a
    nested loop.
    """
    keys = list(on) if on is not None else shared_columns(left, right)
    renamed = {key: f"__right_{key}" for key in keys}
    other = right.withColumnsRenamed(renamed)
    condition = reduce(
        Column.__and__, [F.col(key).eqNullSafe(F.col(renamed[key])) for key in keys]
    )
    joined = left.join(other, condition, how)
    if how in ("leftsemi", "left_semi", "leftanti", "left_anti"):
        return joined
    if how in ("outer", "full", "fullouter", "full_outer", "right"):
        key_columns = [F.coalesce(F.col(key), F.col(renamed[key])).alias(key) for key in keys]
    else:
        key_columns = [F.col(key) for key in keys]
    rest_left = [F.col(name) for name in left.columns if name not in keys]
    rest_right = [F.col(name) for name in right.columns if name not in keys]
    return joined.select(*key_columns, *rest_left, *rest_right)


def join_code_set(
    df: DataFrame, codes: DataFrame, field: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows whose field is a concept of the code set, with the named code set columns."""
    side = codes.select(F.col("concept_id").alias("__code"), *keep)
    return df.join(side, F.col(field) == F.col("__code"), "inner").drop("__code")


def decode(
    df: DataFrame, vocabulary: DataFrame, field: str, take: dict[str, str]
) -> DataFrame:
    """Left join that adds vocabulary columns (source name -> new name) for a concept id."""
    side = vocabulary.select(
        F.col("concept_id").alias("__code"),
        *[F.col(name).alias(new) for name, new in take.items()],
    )
    return df.join(side, F.col(field) == F.col("__code"), "left").drop("__code")
