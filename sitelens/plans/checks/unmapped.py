"""Unmapped concepts: facts whose concept is missing or stands for "not mapped"."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import is_unmapped, proportion, zero_if_null
from sitelens.operators.reshape import stack
from sitelens.operators.sets import union_all
from sitelens.plans import fixed
from sitelens.plans.checks.common import (
    HEADER,
    check_name,
    grouped,
    matching_rows,
    with_header,
)
from sitelens.sources.specs import UnmappedSpec
from sitelens.sources.tables import Tables


@dataclass(frozen=True)
class Measure:
    """One count over a table: which rows, and which of them are unmapped."""

    name: str
    description: str | None
    rows: Column
    unmapped: Column


def count_unmapped(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Total and unmapped rows of all measures, from one scan and one aggregation."""
    counts = []
    for i, measure in enumerate(measures):
        counts.append(F.count_if(measure.rows).alias(f"__total_{i}"))
        counts.append(F.count_if(measure.rows & measure.unmapped).alias(f"__unmapped_{i}"))
    table = df.groupBy(*keys).agg(*counts)
    return stack(
        table,
        keys,
        [
            {
                "check_name": F.lit(measure.name),
                "check_description": F.lit(measure.description).cast("string"),
                "total_rows": F.col(f"__total_{i}"),
                "unmapped_rows": F.col(f"__unmapped_{i}"),
            }
            for i, measure in enumerate(measures)
        ],
    )


def measure_of(
    spec: UnmappedSpec, codes: Iterable, null_counts: bool, check_string: str = "uc"
) -> Measure:
    return Measure(
        check_name(check_string, spec.check_id),
        spec.check_description,
        spec.predicate,
        is_unmapped(spec.concept_field, codes, null_counts),
    )


def unmapped_concepts(
    tables: Tables,
    specs: Sequence[UnmappedSpec],
    version: str,
    codes: Iterable = fixed.NULL_CONCEPTS,
    null_counts: bool = True,
    check_string: str = "uc",
) -> DataFrame:
    """Rows, unmapped rows and their share per site and check.

    Our definition: the share is 0 when no row meets the check's predicate.
    """
    parts = [
        count_unmapped(
            tables.scan(table, schema),
            ["site"],
            [measure_of(spec, codes, null_counts, check_string) for spec in group],
        )
        for (schema, table), group in grouped(specs, lambda s: (s.schema, s.table)).items()
    ]
    share = zero_if_null(proportion("unmapped_rows", "total_rows"))
    return (
        union_all(parts)
        .withColumn("unmapped_prop", share)
        .withColumns({"check_type": F.lit(check_string), "database_version": F.lit(version)})
        .select(*HEADER, "total_rows", "unmapped_rows", "unmapped_prop")
    )


def unmapped_by_year(
    tables: Tables,
    specs: Sequence[UnmappedSpec],
    version: str,
    codes: Iterable = fixed.NULL_CONCEPTS,
    null_counts: bool = True,
    check_string: str = "uc",
) -> DataFrame:
    """Unmapped share per site, check and year of the check's date field.

    All checks of a table share one scan, counted by the years of all their date fields and
    then regrouped by each check's own. A year in which no row meets a check's predicate gives
    no row for that check.
    """
    dated = [spec for spec in specs if spec.date_field]
    parts = []
    for (schema, table), group in grouped(dated, lambda s: (s.schema, s.table)).items():
        years = {field: f"__year_{field}" for field in dict.fromkeys(s.date_field for s in group)}
        df = tables.scan(table, schema).withColumns(
            {name: F.year(field) for field, name in years.items()}
        )
        counted = count_unmapped(
            df,
            ["site", *years.values()],
            [measure_of(spec, codes, null_counts, check_string) for spec in group],
        )
        named = F.create_map(
            *[
                part
                for spec in group
                for part in (
                    F.lit(check_name(check_string, spec.check_id)),
                    F.col(years[spec.date_field]),
                )
            ]
        )
        parts.append(counted.withColumn("year_date", named[F.col("check_name")]))
    columns = ["site", "check_name", "check_description", "year_date"]
    return (
        union_all(part.select(*columns, "total_rows", "unmapped_rows") for part in parts)
        .groupBy(*columns)
        .agg(
            F.sum("total_rows").alias("total_rows"), F.sum("unmapped_rows").alias("unmapped_rows")
        )
        .filter(F.col("total_rows") > 0)
        .withColumns(
            {
                "prop_total": proportion("unmapped_rows", "total_rows"),
                "check_type": F.lit(check_string),
                "database_version": F.lit(version),
            }
        )
        .select(*HEADER, "year_date", "total_rows", "unmapped_rows", "prop_total")
    )


def unmapped_source_values(
    tables: Tables,
    specs: Sequence[UnmappedSpec],
    version: str,
    codes: Iterable = fixed.NULL_CONCEPTS,
    null_counts: bool = True,
    check_string: str = "uc",
) -> DataFrame:
    """Unmapped rows per site, check and source value."""
    valued = [spec for spec in specs if spec.source_value_field]
    codes = list(codes)
    parts = []
    for (schema, table), group in grouped(valued, lambda s: (s.schema, s.table)).items():
        items = [
            (
                check_name(check_string, spec.check_id),
                spec.predicate & is_unmapped(spec.concept_field, codes, null_counts),
                {"source_value": F.col(spec.source_value_field).cast("string")},
            )
            for spec in group
        ]
        rows = matching_rows(tables.scan(table, schema), items, ["site"])
        counts = rows.groupBy("site", "check_name", "source_value")
        parts.append(counts.agg(F.count(F.lit(1)).alias("unmapped_rows")))
    names = {check_name(check_string, s.check_id): s.check_description for s in valued}
    return with_header(union_all(parts), names, check_string, version).select(
        *HEADER, "source_value", "unmapped_rows"
    )
