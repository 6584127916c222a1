"""Domain concordance: do two cohorts that belong together occur together?"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.functions.columns import proportion
from sitelens.operators.reshape import stack
from sitelens.operators.sets import union_all
from sitelens.plans.checks.common import (
    HEADER,
    Tag,
    as_predicate,
    check_name,
    grouped,
    labelled,
    tagged_rows,
    with_header,
)
from sitelens.sources.specs import CodeSets, ConcordanceSpec
from sitelens.sources.tables import Tables

#: Key column on which two cohorts are compared, per level.
LEVEL_KEYS = {
    "patient": "person_id",
    "visit": "visit_occurrence_id",
    "visit_detail": "visit_detail_id",
}

COHORTS = ("cohort_1_only", "cohort_2_only", "combined", "both_outside_window")


def level_of(check_id: str) -> str:
    """Level by the text of the check id."""
    if re.search("visdt", check_id):
        return "visit_detail"
    return "visit" if re.search("vis", check_id) else "patient"


def _pairs(specs: Sequence[ConcordanceSpec]) -> dict[str, list[ConcordanceSpec]]:
    pairs = grouped(specs, lambda s: s.check_id)
    for check_id, rows in pairs.items():
        if len(rows) != 2:
            raise ValueError(f"{check_id}: two cohorts are needed, found {len(rows)}")
    return pairs


def cohort_events(
    tables: Tables,
    specs: Sequence[ConcordanceSpec],
    code_sets: CodeSets,
    key: str,
    check_string: str,
) -> DataFrame:
    """Events of both cohorts of every check: check_name, cohort (1 or 2), site, key, date.

    Cohorts that read the same table are found in one scan, in whatever fields their concepts and
    dates are.
    """
    numbered = [
        (spec, number)
        for rows in _pairs(specs).values()
        for number, spec in enumerate(rows, start=1)
    ]
    parts = []
    for (schema, table), group in grouped(numbered, lambda e: (e[0].schema, e[0].table)).items():
        df = tables.scan(table, schema).withColumn("__key", F.col(key))
        tags = [
            Tag(
                {"check_name": check_name(check_string, spec.check_id), "cohort": number},
                {"__date": F.col(spec.date_field).cast("date")},
                as_predicate(spec.filter_logic),
                spec.concept_field,
                code_sets.get(spec.conceptset_name) if spec.conceptset_name else None,
            )
            for spec, number in group
        ]
        found = df.filter(F.col("__key").isNotNull())
        parts.append(tagged_rows(found, tags, ["site", "__key"]))
    return union_all(parts)


def near_pairs(events: DataFrame, windows: Mapping[str, float | None]) -> DataFrame:
    """Per check and key: in cohort 1, in cohort 2, and some pair of events near enough.

    The distinct days of a key are gathered per cohort while it is grouped, so a key holds at most
    two numbers per calendar day, and events are shuffled once. In date order the closest events of
    two different cohorts are neighbours, because any event between them would be closer still;
    comparing each with the one before it therefore finds the smallest distance without forming pairs.
    """
    limit = labelled("check_name", windows, "double")
    day = F.when(limit.isNotNull(), F.datediff("__date", F.lit("1970-01-01").cast("date")))
    one, two = F.col("cohort") == 1, F.col("cohort") == 2
    found = events.groupBy("check_name", "site", "__key").agg(
        F.bool_or(one).alias("__one"),
        F.bool_or(two).alias("__two"),
        # Even for the first cohort, odd for the second.
        F.array_sort(F.collect_set(2 * day + two.cast("int"))).alias("__days"),
    )

    def near(before: Column, after: Column) -> Column:
        gap = F.shiftright(after, 1) - F.shiftright(before, 1)
        crossing = before.bitwiseAND(1) != after.bitwiseAND(1)
        return crossing & ((gap == 0) | (gap <= limit))

    following = F.slice("__days", F.lit(2), F.size("__days"))
    beside = F.exists(F.zip_with("__days", following, near), lambda x: x)
    return found.select(
        "check_name", "site", "__key", "__one", "__two",
        F.coalesce(beside, F.lit(False)).alias("__near"),
    )


def domain_concordance(
    tables: Tables,
    specs: Sequence[ConcordanceSpec],
    code_sets: CodeSets,
    version: str,
    level: str = "patient",
    key: str | None = None,
    check_string: str = "dcon",
) -> DataFrame:
    """Keys in cohort 1 only, in cohort 2 only, in both near each other, in both but apart.

    Our definition: keys are persons, visits or visit details; with time_between_events, both
    cohorts must have events at most that many days apart, in either order; without it,
    belonging to both is enough. The four shares are over all keys of either cohort.
    """
    pairs = _pairs(specs)
    windows = {
        check_name(check_string, check_id): rows[0].time_between_events
        for check_id, rows in pairs.items()
    }
    events = cohort_events(tables, specs, code_sets, key or LEVEL_KEYS[level], check_string)
    one, two, near = F.col("__one"), F.col("__two"), F.col("__near")
    timed = labelled("check_name", windows, "double").isNotNull()
    together = one & two & (near | ~timed)
    counts = near_pairs(events, windows).groupBy("site", "check_name").agg(
        F.count_if(one & ~two).alias(COHORTS[0]),
        F.count_if(two & ~one).alias(COHORTS[1]),
        F.count_if(together).alias(COHORTS[2]),
        F.count_if(one & two & ~together).alias(COHORTS[3]),
        F.count(F.lit(1)).alias("total_ct"),
    )
    rows = stack(
        counts,
        ["site", "check_name", "total_ct"],
        [{"cohort": F.lit(name), "value": F.col(name)} for name in COHORTS],
    )
    descriptions = {
        check_name(check_string, check_id): " / ".join(
            s.cohort_description or s.cohort_id for s in rows_
        )
        for check_id, rows_ in pairs.items()
    }
    return (
        with_header(rows, descriptions, check_string, version)
        .withColumn("prop", proportion("value", "total_ct"))
        .select(*HEADER, "cohort", "value", "total_ct", "prop")
    )


METADATA_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("cohort", T.StringType()),
        T.StructField("cohort_id", T.StringType()),
        T.StructField("cohort_description", T.StringType()),
        T.StructField("time_between_events", T.DoubleType()),
        T.StructField("level", T.StringType()),
    ]
)


def concordance_metadata(
    spark: SparkSession,
    specs: Sequence[ConcordanceSpec],
    level: str | None = None,
    check_string: str = "dcon",
) -> DataFrame:
    """One row per check and cohort: description, window and level."""
    rows = [
        (
            check_name(check_string, check_id),
            f"cohort_{number}",
            spec.cohort_id,
            spec.cohort_description,
            None if spec.time_between_events is None else float(spec.time_between_events),
            level or level_of(check_id),
        )
        for check_id, pair in _pairs(specs).items()
        for number, spec in enumerate(pair, start=1)
    ]
    return spark.createDataFrame(rows, METADATA_SCHEMA)
