"""Named relations: clinical tables, result tables and the vocabulary."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Loader = Callable[[str], DataFrame]


def parquet_folder(spark: SparkSession, root: str, suffix: str = "") -> Loader:
    """Tables stored as parquet below one folder."""
    return lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}{suffix}")


def catalog_schema(spark: SparkSession, schema: str) -> Loader:
    """Tables of a schema in the session's catalog."""
    return lambda name: spark.table(f"{schema}.{name}")


def frames(named: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> Loader:
    """Relations that are DataFrames, or functions that build one when it is asked for."""

    def load(name: str) -> DataFrame:
        if name not in named:
            raise KeyError(f"no table {name!r}; known: {', '.join(sorted(named))}")
        found = named[name]
        return found if isinstance(found, DataFrame) else found()

    return load


class Tables:
    """Relations looked up by schema and name.

    ``site`` keeps the rows of one site in every table that has a site column. Without it all
    sites are assessed together; site is a grouping key everywhere.
    """

    def __init__(self, schemas: Mapping[str, Loader], site: str | None = None):
        self._schemas = dict(schemas)
        self._site = site

    def scan(self, name: str, schema: str = "cdm") -> DataFrame:
        if schema not in self._schemas:
            raise KeyError(f"no schema {schema!r}; known: {', '.join(sorted(self._schemas))}")
        df = self._schemas[schema](name)
        if self._site is not None and "site" in df.columns:
            df = only_site(df, self._site)
        return df

    def cdm(self, name: str) -> DataFrame:
        return self.scan(name, "cdm")

    def result(self, name: str) -> DataFrame:
        return self.scan(name, "result")

    def vocabulary(self, name: str = "concept") -> DataFrame:
        return self.scan(name, "vocabulary")

    def with_schema(self, schema: str, loader: Loader) -> Tables:
        """The same relations with one schema replaced."""
        return Tables({**self._schemas, schema: loader}, self._site)

    def adding(self, schema: str, named: Mapping[str, DataFrame]) -> Tables:
        """The same relations with further DataFrames in one schema."""
        known = self._schemas.get(schema)

        def load(name: str) -> DataFrame:
            if name in named:
                return named[name]
            if known is None:
                raise KeyError(f"no table {name!r} in schema {schema!r}")
            return known(name)

        return Tables({**self._schemas, schema: load}, self._site)


def add_site(df: DataFrame, site: str) -> DataFrame:
    """Attach the site label to data delivered by one site."""
    return df.withColumn("site", F.lit(site))


def only_site(df: DataFrame, site: str) -> DataFrame:
    return df.filter(F.col("site") == F.lit(site))
