"""Shared pieces of the checks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import any_of
from sitelens.operators.sets import union_all
from sitelens.sources.specs import Spec
from sitelens.sources.tables import Tables

Item = TypeVar("Item")

#: Columns that open every check result.
HEADER = ("site", "check_name", "check_description", "check_type", "database_version")


def check_name(check_string: str, check_id: str) -> str:
    return f"{check_string}_{check_id}"


def grouped(items: Iterable[Item], key: Callable[[Item], Hashable]) -> dict[Hashable, list[Item]]:
    """Items by key, in the order they come."""
    groups: dict[Hashable, list[Item]] = defaultdict(list)
    for item in items:
        groups[key(item)].append(item)
    return groups


def with_header(
    df: DataFrame,
    descriptions: Mapping[str, str | None],
    check_string: str,
    version: str,
    description: str = "check_description",
) -> DataFrame:
    """Attach description, check type and data version to rows that carry check_name."""
    return df.withColumns(
        {
            description: labelled("check_name", descriptions),
            "check_type": F.lit(check_string),
            "database_version": F.lit(version),
        }
    )


def labelled(column: str, labels: Mapping[str, str | float | None], kind: str = "string") -> Column:
    """A value per check name, looked up in a map that is part of the plan."""
    known = {name: value for name, value in labels.items() if value is not None}
    if not known:
        return F.lit(None).cast(kind)
    pairs = [F.lit(part) for pair in known.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(column)).cast(kind)


def as_predicate(text: str | None) -> Column | None:
    return F.expr(text) if text else None


def matching_rows(
    df: DataFrame,
    items: Sequence[tuple[str, Column | None, Mapping[str, Column]]],
    keep: Sequence[str],
) -> DataFrame:
    """Each row once per check whose predicate it meets, with that check's own columns.

    items holds check name, predicate and computed columns; all items name the same columns.
    The table is scanned once, and a row is repeated only for checks it belongs to. Rows that
    belong to no check are filtered first, where the scan can use the predicates.
    """
    predicates = [predicate for _, predicate, _ in items]
    if all(predicate is not None for predicate in predicates):
        df = df.filter(any_of(predicates))
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            *[column.alias(alias) for alias, column in columns.items()],
        )
        for name, _, columns in items
    ]
    if len(entries) == 1:
        return df.select(*keep, entries[0].alias("__match")).select(*keep, "__match.*")
    tagged = [
        entry if predicate is None else F.when(predicate, entry)
        for entry, predicate in zip(entries, predicates, strict=True)
    ]
    # Exploding and then filtering stays in generated code; filtering the array would not.
    matches = df.select(*keep, F.explode(F.array(*tagged)).alias("__match"))
    return matches.filter(F.col("__match").isNotNull()).select(*keep, "__match.*")


def _flagged(
    tables: Tables,
    specs: Sequence[Spec],
    keys: Callable[[Spec], Mapping[str, Column]],
) -> Iterator[tuple[DataFrame, list[Column]]]:
    """Scans that the checks share, each with its key and flag columns."""
    index = {id(spec): i for i, spec in enumerate(specs)}
    for (schema, table), same_table in grouped(specs, lambda s: (s.schema, s.table)).items():
        for group in grouped(same_table, lambda s: str(keys(s))).values():
            df = tables.scan(table, schema)
            if all(spec.filter_logic for spec in group):
                df = df.filter(any_of(spec.predicate for spec in group))
            flags = {
                f"__in_{index[id(spec)]}": F.coalesce(spec.predicate, F.lit(False))
                for spec in group
            }
            columns = {**keys(group[0]), **flags}
            yield df, [column.alias(name) for name, column in columns.items()]


def flagged_rows(
    tables: Tables,
    specs: Sequence[Spec],
    keys: Callable[[Spec], Mapping[str, Column]],
) -> DataFrame:
    """What flagged_counts counts, row by row: for keys that hardly any two rows share, which a count
    would shuffle once more."""
    return union_all(df.select(*columns) for df, columns in _flagged(tables, specs, keys))


def flagged_counts(
    tables: Tables,
    specs: Sequence[Spec],
    keys: Callable[[Spec], Mapping[str, Column]],
) -> DataFrame:
    """Rows counted per key and per combination of the checks they belong to.

    keys gives the key columns for a check; checks of a table with equal keys share a scan and
    a count. Column ``__in_<i>`` tells whether the rows belong to check i, ``__n`` how many
    there are. Whatever is looked up by key afterwards is looked up once, not once per check
    or per row.
    """
    return union_all(
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
        for df, columns in _flagged(tables, specs, keys)
    )


def in_check(i: int) -> Column:
    """Rows of flagged_counts or flagged_rows that belong to check i."""
    return F.coalesce(F.col(f"__in_{i}"), F.lit(False))


@dataclass(frozen=True)
class Tag:
    """What a row has to meet to get the labels of a tag: a predicate, and a concept of a code set in
    a field. Either may be missing. `columns` are computed from the row; all tags name the same."""

    labels: Mapping[str, object]
    columns: Mapping[str, Column] = field(default_factory=dict)
    predicate: Column | None = None
    concept_field: str | None = None
    codes: DataFrame | None = None


def tagged_rows(df: DataFrame, tags: Sequence[Tag], keep: Sequence[str]) -> DataFrame:
    """Each row once per tag that it gets, with the labels and columns of the tag.

    The table is scanned once, whatever fields the code sets are looked up in: a row is repeated for
    each field (and each way to compute the columns), and one join with a list of all code sets,
    labelled with field and tag, finds the tags. The join is on field and concept, so the list can be
    of any size. Tags without a code set stand in the list under a number of their own. A code listed
    twice gives a row twice; the callers only ask whether there is one.
    """
    if all(tag.codes is None for tag in tags):
        names = {f"__tag_{i}": tag for i, tag in enumerate(tags)}
        found = matching_rows(
            df, [(name, tag.predicate, tag.columns) for name, tag in names.items()], keep
        )
        values = {
            label: _by_name({name: tag.labels[label] for name, tag in names.items()})
            for label in tags[0].labels
        }
        found = found.withColumns(values)
        return found if "check_name" in values else found.drop("check_name")
    fields = list(dict.fromkeys(tag.concept_field for tag in tags if tag.codes is not None))
    channels = grouped(
        range(len(tags)),
        lambda i: (
            tags[i].concept_field if tags[i].codes is not None else f"tag {i}",
            str(dict(tags[i].columns)),
        ),
    )
    entries, lists = [], []
    for number, members in enumerate(channels.values()):
        first = tags[members[0]]
        code = F.col(first.concept_field) if first.codes is not None else F.lit(number)
        entries.append(
            F.struct(
                F.lit(number).alias("__channel"),
                code.alias("__concept"),
                *[column.alias(name) for name, column in first.columns.items()],
            )
        )
        for i in members:
            own = tags[i].codes
            if own is None:
                own = df.sparkSession.range(1).select(F.lit(number).alias("concept_id"))
            lists.append(
                own.select(
                    F.lit(number).alias("__code_channel"),
                    F.col("concept_id").alias("__code"),
                    F.lit(i).alias("__tag"),
                    *[F.lit(value).alias(name) for name, value in tags[i].labels.items()],
                )
            )
    restricted = {i: tag.predicate for i, tag in enumerate(tags) if tag.predicate is not None}
    met = [F.coalesce(p, F.lit(False)).alias(f"__met_{i}") for i, p in restricted.items()]
    if all(tag.codes is not None for tag in tags):
        df = df.filter(any_of(F.col(name).isNotNull() for name in fields))
    rows = df.select(*keep, *met, F.explode(F.array(*entries)).alias("__entry")).select(
        *keep, *[f"__met_{i}" for i in restricted], "__entry.*"
    )
    found = rows.join(
        union_all(lists),
        (F.col("__channel") == F.col("__code_channel")) & (F.col("__concept") == F.col("__code")),
    )
    if restricted:
        chosen = [(F.col("__tag") == i) & F.col(f"__met_{i}") for i in restricted]
        free = ~F.col("__tag").isin(list(restricted))
        found = found.filter(any_of([free, *chosen]))
    return found.select(*keep, *tags[0].labels, *tags[0].columns)


def _by_name(values: Mapping[str, object]) -> Column:
    """The value of a tag, looked up by the name that its rows carry."""
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("check_name"))
