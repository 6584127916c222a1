"""Data cycle changes: rows and persons now and in the previous delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.functions.columns import zero_if_null
from sitelens.operators.joins import null_safe_join
from sitelens.operators.reshape import stack
from sitelens.operators.sets import union_all
from sitelens.plans.checks.common import check_name, grouped, labelled
from sitelens.sources.specs import CycleSpec
from sitelens.sources.tables import Tables

KEYS = ("site", "check_name", "application")


def _counts(
    tables: Tables, specs: Sequence[CycleSpec], previous: bool, check_string: str
) -> DataFrame:
    """Rows and distinct persons per site and check: site, check_name, application, ct.

    Rows are first counted per person, then persons per site, so all checks of a table need
    one scan and no distinct count. Tables without persons only count rows.
    """
    parts = []
    located = (
        (lambda s: (s.schema_prev, s.table_prev))
        if previous
        else (lambda s: (s.schema_current, s.table_current))
    )
    for (schema, table), group in grouped(specs, located).items():
        df = tables.scan(table, schema)
        n = [F.count_if(s.predicate).alias(f"__n_{i}") for i, s in enumerate(group)]
        with_persons = "person_id" in df.columns
        if with_persons:
            per_person = df.groupBy("site", "person_id").agg(*n)
            known = F.col("person_id").isNotNull()
            sums = per_person.groupBy("site").agg(
                *[F.sum(f"__n_{i}").alias(f"__n_{i}") for i in range(len(group))],
                *[
                    F.count_if(known & (F.col(f"__n_{i}") > 0)).alias(f"__p_{i}")
                    for i in range(len(group))
                ],
            )
        else:
            sums = df.groupBy("site").agg(*n)
        rows = []
        for i, spec in enumerate(group):
            name = F.lit(check_name(check_string, spec.check_id))
            rows.append(
                {"check_name": name, "application": F.lit("rows"), "ct": F.col(f"__n_{i}")}
            )
            if with_persons:
                rows.append(
                    {"check_name": name, "application": F.lit("person"), "ct": F.col(f"__p_{i}")}
                )
        parts.append(stack(sums, ["site"], rows))
    return union_all(parts)


def data_cycle_changes(
    current: Tables,
    specs: Sequence[CycleSpec],
    version: str,
    previous: Tables | DataFrame,
    previous_version: str,
    check_string: str = "dc",
) -> DataFrame:
    """Current and previous counts per site, check and application (rows or person).

    previous is either the previous delivery's tables or the stored result of the previous
    run, whose current counts then become the previous ones; of a result that holds several
    versions, the rows of previous_version count.
    """
    now = _counts(current, specs, False, check_string).withColumnRenamed("ct", "current_ct")
    if isinstance(previous, DataFrame):
        if "database_version" in previous.columns:
            previous = previous.filter(F.col("database_version") == previous_version)
        before = previous.select(*KEYS, F.col("current_ct").alias("previous_ct"))
    else:
        before = _counts(previous, specs, True, check_string).withColumnRenamed(
            "ct", "previous_ct"
        )
    joined = null_safe_join(now, before, on=KEYS, how="full")
    domains = {check_name(check_string, s.check_id): s.check_domain for s in specs}
    return joined.select(
        *KEYS,
        F.lit(check_string).alias("check_type"),
        F.lit(version).alias("database_version"),
        F.lit(previous_version).alias("previous_version"),
        labelled("check_name", domains).alias("domain"),
        zero_if_null("current_ct").alias("current_ct"),
        zero_if_null("previous_ct").alias("previous_ct"),
    )


CYCLE_METADATA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("check_description", T.StringType()),
        T.StructField("check_domain", T.StringType()),
    ]
)


def cycle_metadata(
    spark: SparkSession, specs: Sequence[CycleSpec], check_string: str = "dc"
) -> DataFrame:
    """Description and domain of each check."""
    rows = [
        (check_name(check_string, s.check_id), s.check_description, s.check_domain) for s in specs
    ]
    return spark.createDataFrame(rows, CYCLE_METADATA)
