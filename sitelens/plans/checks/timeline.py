"""Facts over time: monthly counts per check."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import month_start, zero_if_null
from sitelens.operators.groups import with_result_values
from sitelens.operators.sets import union_all
from sitelens.plans.checks.common import (
    HEADER,
    check_name,
    grouped,
    labelled,
    matching_rows,
    with_header,
)
from sitelens.sources.specs import FactsOverTimeSpec
from sitelens.sources.tables import Tables

#: Fixed value: the first month counted.
FIRST_DAY = datetime.date(2009, 1, 1)

COUNTS = ("row_cts", "row_visits", "row_pts")


def facts_over_time(
    tables: Tables,
    specs: Sequence[FactsOverTimeSpec],
    version: str,
    start: datetime.date = FIRST_DAY,
    as_of: datetime.date | None = None,
    sites: DataFrame | None = None,
    check_string: str = "fot",
) -> DataFrame:
    """Rows, distinct visits and distinct persons per site, check and month.

    Every month from start to as_of (default today) appears for every site and check, with
    zeros where there is nothing. sites lists the sites to show; by default these are the
    sites with any counted fact.

    All checks of a table share one scan. Rows are counted per visit and per person of a month
    before they are shuffled; the distinct counts are the numbers of these.
    """
    first = F.lit(start)
    last = F.lit(as_of) if as_of is not None else F.current_date()
    parts = []
    for (schema, table), group in grouped(specs, lambda s: (s.schema, s.table)).items():
        df = tables.scan(table, schema)
        for name in ("visit_occurrence_id", "person_id"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit(None).cast("bigint"))
        items = []
        for spec in group:
            date = F.col(spec.date_field).cast("date")
            items.append(
                (
                    check_name(check_string, spec.check_id),
                    _within(date, first, last) & spec.predicate,
                    {"time_start": month_start(spec.date_field)},
                )
            )
        rows = matching_rows(df, items, ["site", "visit_occurrence_id", "person_id"])
        parts.append(_by_visit_and_person(rows))
    counts = (
        union_all(parts)
        .groupBy(*MONTH)
        .agg(
            F.sum("__rows").alias("row_cts"),
            F.count("visit_occurrence_id").alias("row_visits"),
            F.count("person_id").alias("row_pts"),
        )
    )
    names = {check_name(check_string, s.check_id): s for s in specs}
    shown = (sites if sites is not None else counts).select("site").distinct()
    months = F.sequence(month_start(first), month_start(last), F.expr("INTERVAL 1 MONTH"))
    calendar = shown.select(
        "site", F.explode(F.array(*[F.lit(name) for name in names])).alias("check_name")
    ).select("site", "check_name", F.explode(months).alias("time_start"))
    dense = calendar.join(counts, ["site", "check_name", "time_start"], "left").withColumns(
        {name: zero_if_null(name) for name in COUNTS}
    )
    headed = with_header(
        dense, {n: s.check_description for n, s in names.items()}, check_string, version
    )
    return headed.withColumns(
        {
            "domain": labelled("check_name", {n: s.check_domain for n, s in names.items()}),
            "time_end": F.last_day("time_start"),
        }
    ).select(*HEADER, "domain", "time_start", "time_end", *COUNTS)


MONTH = ("site", "check_name", "time_start")


def _by_visit_and_person(rows: DataFrame) -> DataFrame:
    """Per site, check and month: a row for each visit, with how many rows it has, and one for each
    person, with none. Visits and persons are counted side by side, so what is shuffled is their sum
    and not their pairs."""
    visit, person = F.col("visit_occurrence_id"), F.col("person_id")
    none = lambda column, name: F.when(F.lit(False), column).alias(name)
    entries = F.array(
        F.struct(
            F.lit(1).alias("counts"), visit.alias("visit"), none(person, "person")
        ),
        F.struct(F.lit(0).alias("counts"), none(visit, "visit"), person.alias("person")),
    )
    tagged = rows.select(*MONTH, F.explode(entries).alias("__entry"))
    return tagged.groupBy(
        *MONTH,
        F.col("__entry.counts").alias("__counts"),
        F.col("__entry.visit").alias("visit_occurrence_id"),
        F.col("__entry.person").alias("person_id"),
    ).agg(F.sum("__entry.counts").alias("__rows"))


def _within(date: Column, first: Column, last: Column) -> Column:
    return (date >= first) & (date <= last)


def attach_denominators(counts: DataFrame, all_visits: str = "fot_visall") -> DataFrame:
    """Monthly counts with the counts of all visits of the same site, data version and month.

    A site, version and month hold one row per check, so the totals are looked up within that group.
    """

    def of_all(column: str) -> Column:
        return F.max(F.when(F.col("check_name") == all_visits, F.col(column)))

    return with_result_values(
        counts,
        ["site", "database_version", "time_start", "time_end"],
        {
            "total_row": of_all("row_cts"),
            "total_visit": of_all("row_visits"),
            "total_pt": of_all("row_pts"),
        },
    )
