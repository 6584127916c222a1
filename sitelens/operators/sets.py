"""Set operations by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Every row of every frame; a column missing in one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    """Union without duplicates, with one distinct at the end however many frames come in."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()
