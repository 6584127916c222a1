"""Date plausibility: facts before birth, before their visit or after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import proportion, zero_if_null
from sitelens.operators.joins import site_keys
from sitelens.operators.reshape import stack
from sitelens.plans.checks.common import (
    HEADER,
    check_name,
    flagged_rows,
    in_check,
    with_header,
)
from sitelens.sources.specs import DatePlausibilitySpec
from sitelens.sources.tables import Tables

TYPES = ("before_birth", "before_visit", "after_visit")


def date_plausibility(
    tables: Tables,
    specs: Sequence[DatePlausibilitySpec],
    visits: DataFrame,
    persons: DataFrame,
    version: str,
    check_string: str = "dp",
) -> DataFrame:
    """Implausible rows and their share per site, check and kind of implausibility.

    Our definition: the share is over all rows that meet the check's predicate; a row whose
    birth date or visit is unknown is not implausible.

    Rows meet visits, then birth dates: hardly any two share person, visit and date, so counting them
    first would only be a third shuffle. The joins split a visit or person with very many rows.
    """
    specs = list(specs)
    facts = flagged_rows(
        tables,
        specs,
        lambda spec: {
            "site": F.col("site"),
            "person_id": F.col("person_id"),
            "visit_occurrence_id": F.col("visit_occurrence_id"),
            "__date": F.col(spec.date_field).cast("date"),
        },
    )
    births = persons.select("site", "person_id", F.col("birth_date").cast("date").alias("__birth"))
    # Rows without a visit are many, and all have the same null key. They match nothing, so a
    # second key that no visit has deals them out by what else they hold.
    apart = F.when(F.col("visit_occurrence_id").isNull(), F.xxhash64("person_id", "__date"))
    facts = facts.withColumn("__apart", F.coalesce(apart, F.lit(0).cast("long")))
    keys = site_keys(facts, visits, "visit_occurrence_id")
    spans = visits.select(
        *keys,
        F.lit(0).cast("long").alias("__apart"),
        F.col("visit_start_date").cast("date").alias("__start"),
        F.col("visit_end_date").cast("date").alias("__end"),
    )
    date = F.col("__date")
    broken = {
        "before_birth": date < F.col("__birth"),
        "before_visit": date < F.col("__start"),
        "after_visit": date > F.col("__end"),
    }
    sums = []
    for i in range(len(specs)):
        sums.append(F.count_if(in_check(i)).alias(f"__total_{i}"))
        for kind in TYPES:
            sums.append(F.count_if(in_check(i) & broken[kind]).alias(f"__{kind}_{i}"))
    per_site = (
        facts.join(spans, [*keys, "__apart"], "left")
        .join(births, ["site", "person_id"], "left")
        .groupBy("site")
        .agg(*sums)
    )
    rows = stack(
        per_site,
        ["site"],
        [
            {
                "check_name": F.lit(check_name(check_string, spec.check_id)),
                "implausible_type": F.lit(kind),
                "total_rows": F.col(f"__total_{i}"),
                "implausible_row": F.col(f"__{kind}_{i}"),
            }
            for i, spec in enumerate(specs)
            for kind in TYPES
        ],
    ).filter(F.col("total_rows") > 0)
    descriptions = {check_name(check_string, s.check_id): s.check_description for s in specs}
    return (
        with_header(rows, descriptions, check_string, version)
        .withColumn("prop_implausible", zero_if_null(proportion("implausible_row", "total_rows")))
        .select(*HEADER, "implausible_type", "total_rows", "implausible_row", "prop_implausible")
    )
