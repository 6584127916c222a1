"""Best mapped concepts: how many facts use the most informative kind of concept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.operators.groups import with_group_values
from sitelens.operators.sets import union_all
from sitelens.plans.checks.common import HEADER, check_name, labelled, with_header
from sitelens.plans.checks.vocabulary import concept_counts
from sitelens.sources.specs import BestMappedSpec
from sitelens.sources.tables import Tables


def best_mapped_concepts(
    tables: Tables,
    specs: Sequence[BestMappedSpec],
    best_list: DataFrame,
    version: str,
    concept: DataFrame | None = None,
    check_string: str = "bmc",
) -> DataFrame:
    """Rows per site, check and concept attribute, labelled best (1) or not best (0).

    With a concept table the concept is replaced by the attribute the check names; without one
    the field itself is the attribute. Values that the list does not name get the check's
    default label. best_list holds check_name (the check id, with or without the check
    string), concept, best_notbest and default_to ('best' or 'notbest').

    A table is scanned once and the concept table joined once, whatever attributes the checks
    ask for. Our definition: null concepts are left out; a concept unknown to the concept table
    has a null attribute and gets the default label.
    """
    names = {check_name(check_string, s.check_id): s for s in specs}
    parts = []
    for kind, counts in concept_counts(tables, specs, check_string, ()).items():
        counts = counts.filter(F.col("concept").isNotNull())
        if concept is not None:
            attributes = list(dict.fromkeys(s.concept_table_field for s in specs))
            side = concept.select(
                F.col("concept_id").cast(kind).alias("concept"),
                *[F.col(name).cast("string").alias(f"__{name}") for name in attributes],
            )
            chosen = F.lit(None).cast("string")
            for name in attributes:
                users = [n for n, s in names.items() if s.concept_table_field == name]
                chosen = F.when(F.col("check_name").isin(users), F.col(f"__{name}")).otherwise(
                    chosen
                )
            counts = counts.join(side, "concept", "left").withColumn("__value", chosen)
        else:
            counts = counts.withColumn("__value", F.col("concept").cast("string"))
        parts.append(
            counts.groupBy("site", "check_name", F.col("__value").alias("concept")).agg(
                F.sum("tot_ct").alias("row_cts")
            )
        )
    prefix = f"{check_string}_"
    listed = best_list.select(
        F.when(F.col("check_name").startswith(prefix), F.col("check_name"))
        .otherwise(F.concat(F.lit(prefix), F.col("check_name")))
        .alias("check_name"),
        F.col("concept").cast("string").alias("concept"),
        F.col("best_notbest").cast("int").alias("__label"),
        "default_to",
    )
    labels = listed.groupBy("check_name", "concept").agg(F.max("__label").alias("__label"))
    best = F.when(F.col("default_to") == "best", 1).otherwise(0)
    # One entry per check of this call; a join on the check's name alone would lose its key where
    # only one check is left.
    defaults = (
        listed.filter(F.col("check_name").isin(list(names)))
        .groupBy("check_name")
        .agg(F.max(best).alias("__default"))
        .agg(F.map_from_entries(F.collect_list(F.struct("check_name", "__default"))))
        .scalar()
    )
    rows = (
        union_all(parts)
        .join(labels, ["check_name", "concept"], "left")
        .withColumn("__default", F.try_element_at(defaults, F.col("check_name")))
    )
    result = with_group_values(
        rows, ["site", "check_name"], {"total_rows": F.sum("row_cts")}
    ).withColumn("best_notbest", F.coalesce("__label", "__default", F.lit(0)))
    headed = with_header(
        result, {n: s.check_description for n, s in names.items()}, check_string, version
    )
    return headed.withColumn(
        "concept_field", labelled("check_name", {n: s.concept_field for n, s in names.items()})
    ).select(*HEADER, "concept_field", "concept", "best_notbest", "row_cts", "total_rows")
