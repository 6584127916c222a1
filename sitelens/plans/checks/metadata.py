"""Check metadata: long type and category of every check that produced a result."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.operators.sets import union_distinct
from sitelens.plans import fixed
from sitelens.plans.checks.common import labelled


def check_metadata(results: Iterable[DataFrame], descriptions: DataFrame | None = None) -> DataFrame:
    """Distinct check names of all results with check type, category and description.

    descriptions may add columns by check_name.
    """
    names = union_distinct(
        df.select("check_name", F.col("check_type").alias("check_type_short")) for df in results
    )
    typed = names.withColumns(
        {
            "check_type": labelled("check_type_short", {k: v for k, v, _ in fixed.CHECK_TYPES}),
            "check_category": labelled("check_type_short", {k: c for k, _, c in fixed.CHECK_TYPES}),
        }
    )
    return typed if descriptions is None else typed.join(descriptions, "check_name", "left")
