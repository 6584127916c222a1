"""Fact documentation: visits and persons of a visit class that have a kind of fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import proportion, zero_if_null
from sitelens.operators.joins import site_keys
from sitelens.operators.reshape import stack
from sitelens.operators.sets import union_all
from sitelens.plans.checks.common import (
    HEADER,
    as_predicate,
    check_name,
    grouped,
    labelled,
    matching_rows,
)
from sitelens.sources.specs import DocumentationSpec
from sitelens.sources.tables import Tables


@dataclass(frozen=True)
class VisitClass:
    """A class of visits: which visits, and what the check names get appended."""

    name: str
    predicate: str | None = None
    suffix: str = ""
    skip: frozenset[str] = field(default_factory=frozenset)


def _documented_visits(tables: Tables, specs: Sequence[DocumentationSpec]) -> DataFrame:
    """One row per visit with a fact: a 0/1 column per check.

    Visits are told apart by site as well if every table has it.
    """
    visit = "visit_occurrence_id"
    scanned = {key: tables.scan(key[1], key[0]) for key in grouped(specs, lambda s: (s.schema, s.table))}
    with_site = all("site" in df.columns for df in scanned.values())
    keys = ["site", visit] if with_site else [visit]
    index = {spec.check_id: i for i, spec in enumerate(specs)}
    parts = []
    for (schema, table), group in grouped(specs, lambda s: (s.schema, s.table)).items():
        df = scanned[schema, table].filter(F.col(visit).isNotNull())
        flags = [
            F.max(F.when(spec.predicate, 1).otherwise(0)).alias(f"__fact_{index[spec.check_id]}")
            for spec in group
        ]
        parts.append(df.groupBy(*keys).agg(*flags))
    names = [f"__fact_{i}" for i in range(len(specs))]
    if len(parts) == 1:
        return parts[0].select(*keys, *names)
    merged = union_all(parts).groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])
    return merged.select(*keys, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def fact_documentation_by_class(
    tables: Tables,
    specs: Sequence[DocumentationSpec],
    visits: DataFrame,
    classes: Sequence[VisitClass],
    version: str,
    check_string: str = "cfd",
) -> DataFrame:
    """Documentation for several visit classes at once.

    Our definition: of the visits of the class, those with at least one fact; of the persons
    who have a visit of the class, those with a fact at one of these visits. A visit counts in
    every class whose predicate it meets.

    Facts are reduced to one row per visit with a column per check, and visits are read and
    joined once for all checks and classes. Persons are counted by aggregating visits to
    persons first, so no distinct count is needed.
    """
    visit = "visit_occurrence_id"
    facts = _documented_visits(tables, specs)
    members = matching_rows(
        visits,
        [(c.name, as_predicate(c.predicate), {}) for c in classes],
        ["site", "person_id", visit],
    ).withColumnRenamed("check_name", "visit_type")
    names = [f"__fact_{i}" for i in range(len(specs))]
    joined = members.join(facts, site_keys(members, facts, visit), "left")
    persons = joined.groupBy("site", "visit_type", "person_id").agg(
        F.count(F.lit(1)).alias("__visits"),
        *[F.sum(F.coalesce(name, F.lit(0))).alias(name) for name in names],
    )
    known = F.col("person_id").isNotNull()
    totals = persons.groupBy("site", "visit_type").agg(
        F.sum("__visits").alias("total_visits"),
        F.count_if(known).alias("total_pts"),
        *[F.sum(name).alias(f"{name}_visits") for name in names],
        *[F.count_if(known & (F.col(name) > 0)).alias(f"{name}_pts") for name in names],
    )
    suffixes = {c.name: c.suffix for c in classes}
    rows = stack(
        totals,
        ["site", "visit_type", "total_visits", "total_pts"],
        [
            {
                "check_name": F.concat(
                    F.lit(check_name(check_string, spec.check_id)),
                    labelled("visit_type", suffixes),
                ),
                "check_id": F.lit(spec.check_id),
                "check_description": F.lit(spec.check_description).cast("string"),
                "fact_visits": F.col(f"__fact_{i}_visits"),
                "fact_pts": F.col(f"__fact_{i}_pts"),
            }
            for i, spec in enumerate(specs)
        ],
    )
    for c in classes:
        if c.skip:
            rows = rows.filter(
                ~((F.col("visit_type") == c.name) & F.col("check_id").isin(sorted(c.skip)))
            )
    return (
        rows.withColumns(
            {
                "check_type": F.lit(check_string),
                "database_version": F.lit(version),
                "fact_visits_prop": zero_if_null(proportion("fact_visits", "total_visits")),
                "fact_pts_prop": zero_if_null(proportion("fact_pts", "total_pts")),
            }
        )
        .select(
            *HEADER,
            "visit_type",
            "total_visits",
            "fact_visits",
            "fact_visits_prop",
            "total_pts",
            "fact_pts",
            "fact_pts_prop",
        )
    )


def fact_documentation(
    tables: Tables,
    specs: Sequence[DocumentationSpec],
    visits: DataFrame,
    visit_class: VisitClass,
    version: str,
    check_string: str = "cfd",
) -> DataFrame:
    """Documentation for one visit class."""
    return fact_documentation_by_class(tables, specs, visits, [visit_class], version, check_string)


# Fixed value: the source concept of a cancelled visit.
CANCELLED = 2000001590

# The visit concepts and visit source concepts of every class.
CLASS_CONCEPTS = {
    "inpatient": ((9201, 2000000048), ()),
    "long_inpatient": ((9201, 2000000048), ()),
    "outpatient": ((9202, 581399), ()),
    "primary_care": ((9202,), ()),
    "emergency": ((9203, 2000000048), ()),
    "cancelled": ((), (CANCELLED,)),
}

# The suffix of a class's checks, a further condition, and checks it leaves out.
CLASS_RULES = (
    ("inpatient", "-visip", None, ()),
    ("long_inpatient", "-visiplong", "datediff(visit_end_date, visit_start_date) > 2", ()),
    ("outpatient", "-visop", None, ("icu",)),
    ("primary_care", "-vispc", "visit_specialty_concept_id IS NOT NULL", ("icu",)),
    ("emergency", "-vised", None, ("icu",)),
    ("cancelled", "-viscn", None, ()),
)


def visit_classes(
    concepts: Mapping[str, tuple[Sequence[int], Sequence[int]]] = CLASS_CONCEPTS,
) -> tuple[VisitClass, ...]:
    """All visits, and the classes that have concepts.

    A class with source concepts holds the visits that carry them; any other class leaves out
    cancelled visits.
    """
    classes = [VisitClass("all", None, "", frozenset({"icu"}))]
    for name, suffix, condition, skip in CLASS_RULES:
        if name not in concepts:
            continue
        kinds, sources = (", ".join(str(int(c)) for c in ids) for ids in concepts[name])
        tests = []
        if kinds:
            tests.append(f"visit_concept_id IN ({kinds})")
        if sources:
            tests.append(f"visit_source_concept_id IN ({sources})")
        else:
            tests.append(f"visit_source_concept_id != {CANCELLED}")
        if condition:
            tests.append(condition)
        classes.append(VisitClass(name, " AND ".join(tests), suffix, frozenset(skip)))
    return tuple(classes)
