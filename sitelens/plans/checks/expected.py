"""Expected concepts present: persons of a cohort who have a concept they should have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import proportion, zero_if_null
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
from sitelens.sources.specs import CodeSets, ExpectedConceptSpec
from sitelens.sources.tables import Tables


def expected_concepts(
    tables: Tables,
    specs: Sequence[ExpectedConceptSpec],
    code_sets: CodeSets,
    version: str,
    check_string: str = "ecp",
) -> DataFrame:
    """Cohort persons, those with a fact in the code set, and their share.

    Our definition: the share is over distinct persons of the cohort; a site appears for every
    check whose cohort has persons there, with 0 when none of them has the concept.

    Checks on one table share one scan and one join with the labelled code sets, whatever their
    concept fields. Facts are reduced to one row per person, with a flag per check, before they meet the
    cohorts, which are read once.
    """
    person = ["site", "person_id"]
    hits = []
    for (schema, table), group in grouped(specs, lambda s: (s.schema, s.table)).items():
        tags = [
            Tag(
                {"check_name": check_name(check_string, s.check_id)},
                predicate=as_predicate(s.filter_logic),
                concept_field=s.concept_field,
                codes=code_sets.get(s.conceptset_name),
            )
            for s in group
        ]
        hits.append(tagged_rows(tables.scan(table, schema), tags, person))
    names = {check_name(check_string, s.check_id): s for s in specs}
    flags = {name: f"__has_{i}" for i, name in enumerate(names)}
    persons = union_all(hits).groupBy(*person).agg(
        *[F.max(F.when(F.col("check_name") == n, 1)).alias(flag) for n, flag in flags.items()]
    )
    cohorts = union_all(
        tables.scan(table, schema).select(*person).distinct().withColumn("cohort_table", F.lit(f"{schema}.{table}"))
        for schema, table in dict.fromkeys((s.cohort_schema, s.cohort_table) for s in specs)
    )
    counts = (
        cohorts.join(persons, person, "left")
        .groupBy("site", "cohort_table")
        .agg(
            F.count(F.lit(1)).alias("total_pts"),
            *[F.count(flag).alias(flag) for flag in flags.values()],
        )
    )
    result = stack(
        counts,
        ["site", "cohort_table", "total_pts"],
        [
            {
                "check_name": F.lit(name),
                "__cohort": F.lit(f"{spec.cohort_schema}.{spec.cohort_table}"),
                "pts_with_concept": F.col(flags[name]),
            }
            for name, spec in names.items()
        ],
    ).filter(F.col("cohort_table") == F.col("__cohort"))
    headed = with_header(
        result, {n: s.check_description for n, s in names.items()}, check_string, version
    )
    return headed.withColumns(
        {
            "cohort_definition": labelled(
                "check_name", {n: s.cohort_definition for n, s in names.items()}
            ),
            "concept_group": labelled(
                "check_name", {n: s.conceptset_name for n, s in names.items()}
            ),
            "prop_with_concept": zero_if_null(proportion("pts_with_concept", "total_pts")),
        }
    ).select(
        *HEADER,
        "cohort_definition",
        "concept_group",
        "total_pts",
        "pts_with_concept",
        "prop_with_concept",
    )
