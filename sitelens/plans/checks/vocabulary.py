"""Vocabulary and value set conformance."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import is_unmapped, listed_in
from sitelens.operators.groups import with_group_values
from sitelens.operators.sets import union_all
from sitelens.plans import fixed
from sitelens.plans.checks.common import (
    HEADER,
    as_predicate,
    check_name,
    grouped,
    labelled,
    matching_rows,
    with_header,
)
from sitelens.sources.specs import CodeSets, Spec, ValueSetSpec, VocabularySpec
from sitelens.sources.tables import Tables


def concept_counts(
    tables: Tables, specs: Sequence[Spec], check_string: str, null_values: Iterable
) -> dict[str, DataFrame]:
    """Rows per site, check and concept, by the type in which concepts are held.

    A table is scanned once for all its checks. Its concepts are held as whole numbers, or as
    text if any of its concept fields is not a whole number.

    Counting before any join means that a very frequent concept reaches the join as one row.
    Null and null-like concepts are counted under a null concept with ``tot_ct`` 0, so that a
    check without usable rows still appears.
    """
    null_values = list(null_values)
    by_kind: dict[str, list[DataFrame]] = {}
    for (schema, table), group in grouped(specs, lambda s: (s.schema, s.table)).items():
        df = tables.scan(table, schema)
        types = dict(df.dtypes)
        whole = all(types[spec.concept_field] in WHOLE_NUMBERS for spec in group)
        kind = "bigint" if whole else "string"
        nulls = [v for v in null_values if isinstance(v, int)] if whole else map(str, null_values)
        nulls = list(nulls)
        items = []
        for spec in group:
            concept = F.col(spec.concept_field).cast(kind)
            usable = ~is_unmapped(concept, nulls, null_counts=True)
            items.append(
                (
                    check_name(check_string, spec.check_id),
                    as_predicate(spec.filter_logic),
                    {"concept": F.when(usable, concept)},
                )
            )
        rows = matching_rows(df, items, ["site"])
        counts = rows.groupBy("site", "check_name", "concept").agg(F.count(F.lit(1)).alias("__n"))
        rows_counted = F.when(F.col("concept").isNull(), 0).otherwise(F.col("__n"))
        by_kind.setdefault(kind, []).append(
            counts.select("site", "check_name", "concept", rows_counted.alias("tot_ct"))
        )
    return {kind: union_all(parts) for kind, parts in by_kind.items()}


WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


MEASURES = ("table_application", "measurement_column")


def _finish(
    counts: DataFrame,
    value: str,
    specs: Sequence[Spec],
    check_string: str,
    version: str,
) -> DataFrame:
    """Add denominators, joined back: a free text field can have very many distinct values. Both
    sides of the join share the shuffle of the counts."""
    counted = with_group_values(
        counts, ["site", "check_name"], {"total_denom_ct": F.sum("tot_ct")}
    ).filter((F.col("tot_ct") > 0) | (F.col("total_denom_ct") == 0))
    names = {check_name(check_string, s.check_id): s for s in specs}
    headed = with_header(
        counted,
        {name: spec.check_description for name, spec in names.items()},
        check_string,
        version,
    )
    return headed.withColumns(
        {
            "table_application": labelled("check_name", {n: s.table for n, s in names.items()}),
            "measurement_column": labelled(
                "check_name", {n: s.concept_field for n, s in names.items()}
            ),
        }
    ).select(*HEADER, *MEASURES, value, "accepted_value", "tot_ct", "total_denom_ct")


def vocabulary_conformance(
    tables: Tables,
    specs: Sequence[VocabularySpec],
    concept: DataFrame,
    version: str,
    null_values: Iterable = fixed.NULL_CONCEPTS,
    check_string: str = "vc",
) -> DataFrame:
    """Rows per site, check and vocabulary of the concept, with accepted or not.

    Our definition: a concept that the vocabulary table does not know is not accepted; null
    and null-like concepts count neither in the numerator nor in the denominator.
    """
    accepted_lists = {
        check_name(check_string, s.check_id): s.acceptable_vocabularies for s in specs
    }
    parts = []
    for kind, counts in concept_counts(tables, specs, check_string, null_values).items():
        vocabulary = concept.select(
            F.col("concept_id").cast(kind).alias("concept"), "vocabulary_id"
        )
        known = counts.join(vocabulary, "concept", "left")
        parts.append(
            known.groupBy("site", "check_name", "vocabulary_id", F.isnull("concept").alias("empty"))
            .agg(F.sum("tot_ct").alias("tot_ct"))
            .withColumn(
                "accepted_value",
                F.when(
                    ~F.col("empty"),
                    listed_in("vocabulary_id", labelled("check_name", accepted_lists)),
                ),
            )
        )
    return _finish(union_all(parts), "vocabulary_id", specs, check_string, version)


def value_set_conformance(
    tables: Tables,
    specs: Sequence[ValueSetSpec],
    value_sets: CodeSets,
    version: str,
    null_values: Iterable = fixed.NULL_CONCEPTS,
    check_string: str = "vs",
) -> DataFrame:
    """Rows per site, check and concept, accepted when the concept is in the value set."""
    allowed = union_all(
        value_sets.get(name)
        .select(F.col("concept_id").cast("string").alias("concept"))
        .distinct()
        .withColumn("valueset_name", F.lit(name))
        for name in dict.fromkeys(s.valueset_name for s in specs)
    ).withColumn("__listed", F.lit(True))
    sets = {check_name(check_string, s.check_id): s.valueset_name for s in specs}
    parts = []
    for counts in concept_counts(tables, specs, check_string, null_values).values():
        texts = counts.withColumns(
            {
                "concept": F.col("concept").cast("string"),
                "valueset_name": labelled("check_name", sets),
            }
        )
        parts.append(
            texts.join(allowed, ["valueset_name", "concept"], "left").withColumn(
                "accepted_value",
                F.when(
                    F.col("concept").isNotNull(), F.coalesce(F.col("__listed"), F.lit(False))
                ),
            )
        )
    rows = union_all(parts).withColumnRenamed("concept", "concept_id")
    return _finish(rows, "concept_id", specs, check_string, version)
