"""Check specifications, code sets and value sets read from CSV files.

A specification row describes one application of a check. Columns are matched by header name
and cast to declared types; nothing is inferred from the data. ``filter_logic`` holds a Spark
SQL predicate. An ``enabled`` column, if present, switches rows off with the text ``false``.
"""

from __future__ import annotations

from dataclasses import MISSING, dataclass, fields
from typing import TypeVar, get_args, get_type_hints

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True, kw_only=True)
class Spec:
    check_id: str
    check_description: str | None = None
    schema: str = "cdm"
    table: str
    filter_logic: str | None = None

    @property
    def predicate(self) -> Column:
        return F.expr(self.filter_logic) if self.filter_logic else F.lit(True)


@dataclass(frozen=True, kw_only=True)
class VocabularySpec(Spec):
    concept_field: str
    acceptable_vocabularies: str


@dataclass(frozen=True, kw_only=True)
class ValueSetSpec(Spec):
    concept_field: str
    valueset_name: str


@dataclass(frozen=True, kw_only=True)
class UnmappedSpec(Spec):
    concept_field: str
    source_value_field: str | None = None
    date_field: str | None = None


@dataclass(frozen=True, kw_only=True)
class MissingVisitSpec(Spec):
    pass


@dataclass(frozen=True, kw_only=True)
class DocumentationSpec(Spec):
    pass


@dataclass(frozen=True, kw_only=True)
class BestMappedSpec(Spec):
    concept_field: str
    concept_table_field: str


@dataclass(frozen=True, kw_only=True)
class ExpectedConceptSpec(Spec):
    cohort_definition: str | None = None
    cohort_schema: str = "result"
    cohort_table: str
    concept_field: str
    conceptset_name: str


@dataclass(frozen=True, kw_only=True)
class ConcordanceSpec(Spec):
    cohort_id: str
    cohort_description: str | None = None
    date_field: str
    concept_field: str | None = None
    conceptset_name: str | None = None
    time_between_events: float | None = None


@dataclass(frozen=True, kw_only=True)
class FactsOverTimeSpec(Spec):
    check_domain: str | None = None
    date_field: str


@dataclass(frozen=True, kw_only=True)
class DatePlausibilitySpec(Spec):
    date_field: str


@dataclass(frozen=True, kw_only=True)
class CycleSpec:
    check_id: str
    check_description: str | None = None
    check_domain: str | None = None
    schema_current: str = "cdm"
    table_current: str
    schema_prev: str = "cdm"
    table_prev: str
    filter_logic: str | None = None

    @property
    def predicate(self) -> Column:
        return F.expr(self.filter_logic) if self.filter_logic else F.lit(True)


AnySpec = TypeVar("AnySpec")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string; a leading byte order mark is ignored."""
    return spark.read.option("header", True).option("multiLine", True).csv(path)


def _typed(df: DataFrame, types: dict[str, str], optional: set[str], path: str) -> DataFrame:
    missing = [name for name in types if name not in df.columns and name not in optional]
    if missing:
        raise ValueError(f"{path}: missing column(s) {', '.join(missing)}")
    return df.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in types.items() if name in df.columns]
    )


def read_specs(spark: SparkSession, path: str, kind: type[AnySpec]) -> list[AnySpec]:
    """Specification rows as objects of the given kind, whatever their number.

    Each becomes a part of the plan, so they are read into the driver, a partition at a time.
    """
    hints = get_type_hints(kind)
    types, optional = {}, set()
    for field in fields(kind):
        is_number = float in (hints[field.name], *get_args(hints[field.name]))
        types[field.name] = "double" if is_number else "string"
        if field.default is not MISSING:
            optional.add(field.name)
    raw = read_csv(spark, path)
    if "enabled" in raw.columns:
        raw = raw.filter(F.lower(F.coalesce(F.trim("enabled"), F.lit("true"))) != "false")
    specs = []
    for row in _typed(raw, types, optional, path).toLocalIterator():
        given = {name: value for name, value in row.asDict().items() if value is not None}
        absent = [name for name in types if name not in given and name not in optional]
        if absent:
            raise ValueError(f"{path}: no value for {', '.join(absent)} in {given}")
        specs.append(kind(**given))
    return specs


#: Column types of a code set; further columns are allowed and dropped.
CODE_SET_TYPES = {
    "concept_id": "bigint",
    "concept_code": "string",
    "concept_name": "string",
    "vocabulary_id": "string",
}

LIST_TYPES = {"check_name": "string", "concept": "string", "best_notbest": "int", "default_to": "string"}

DESCRIPTION_TYPES = {"check_name": "string", "check_application": "string"}

NAME_TYPES = {"check_name": "string", "new_name": "string"}

CATEGORY_TYPES = {"check_name": "string", "check_cat": "string"}

VISIT_CLASS_TYPES = {
    "visit_type": "string",
    "visit_concept_id": "bigint",
    "visit_source_concept_id": "bigint",
}


def read_code_set(spark: SparkSession, path: str) -> DataFrame:
    """A code set or value set. Only concept_id has to be there."""
    return _typed(read_csv(spark, path), CODE_SET_TYPES, set(CODE_SET_TYPES) - {"concept_id"}, path)


def read_best_list(spark: SparkSession, path: str) -> DataFrame:
    """Concepts labelled best (1) or not best (0), with the label of unlisted concepts."""
    return _typed(read_csv(spark, path), LIST_TYPES, set(), path)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return _typed(read_csv(spark, path), CATEGORY_TYPES, set(), path)


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """What every check is applied to, one row per check name."""
    rows = _typed(read_csv(spark, path), DESCRIPTION_TYPES, set(), path)
    return rows.groupBy("check_name").agg(F.min("check_application").alias("check_application"))


def read_new_names(spark: SparkSession, path: str) -> DataFrame:
    """New check names, one row per present name."""
    rows = _typed(read_csv(spark, path), NAME_TYPES, set(), path)
    return rows.groupBy("check_name").agg(F.min("new_name").alias("new_name"))


def read_visit_classes(spark: SparkSession, path: str) -> DataFrame:
    return _typed(read_csv(spark, path), VISIT_CLASS_TYPES, set(), path)


class CodeSets:
    """Code sets by name: CSV files of one folder, or DataFrames handed in."""

    def __init__(
        self,
        spark: SparkSession | None = None,
        folder: str | None = None,
        named: dict[str, DataFrame] | None = None,
    ):
        self._spark, self._folder, self._named = spark, folder, dict(named or {})

    def get(self, name: str) -> DataFrame:
        if name in self._named:
            return self._named[name]
        if self._folder is None:
            raise KeyError(f"no code set {name!r}; known: {', '.join(sorted(self._named))}")
        path = f"{self._folder.rstrip('/')}/{name}.csv"
        try:
            return read_code_set(self._spark, path)
        except Exception as error:
            raise KeyError(f"code set {name!r} cannot be read from {path}: {error}") from error
