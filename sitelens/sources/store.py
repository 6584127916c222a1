"""Result tables in a shared folder.

A table consists of segments, folders of Parquet files that are never changed once written. A
manifest per version lists the segments that the version is made of. Writing a table adds a segment
and a manifest with that segment alone; appending adds the rows that are new as a segment, and a
manifest with the old segments and the new one, so history is neither read nor written again.

Readers take the newest manifest, so a table can be read while its next version is being written. A
lost executor or a failed job leaves the previous version in place, and of two writers that add the
same version one fails. Folders are listed, and manifests are written and read, through the Hadoop
file system of the session; a session without a JVM handle can run plans but cannot use a store.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.operators.sets import union_distinct

#: The column that tells deliveries apart: rows that differ in it are never compared.
DELIVERY = "database_version"

#: A segment with more deliveries than this does not list them and is compared with every delivery.
MOST_LISTED = 1000

#: Folders of segments are named like a partition, so that Spark reads several of them as one table.
SEGMENT = "__segment"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@dataclass(frozen=True)
class Segment:
    """One folder of rows. `deliveries` are the values of the delivery column in it, None where they
    are not listed; `distinct` says that no row occurs twice, here or in the segments before it."""

    number: int
    deliveries: tuple[str | None, ...] | None
    distinct: bool

    def may_hold(self, delivered: Sequence[str | None] | None) -> bool:
        if self.deliveries is None or delivered is None:
            return True
        return not set(self.deliveries).isdisjoint(delivered)


@dataclass(frozen=True)
class Manifest:
    """What a version of a table is made of."""

    schema: T.StructType
    partition_by: tuple[str, ...]
    segments: tuple[Segment, ...]

    def to_json(self) -> str:
        return json.dumps(
            {
                "schema": self.schema.jsonValue(),
                "partition_by": self.partition_by,
                "segments": [asdict(segment) for segment in self.segments],
            }
        )

    @staticmethod
    def from_json(text: str) -> Manifest:
        read = json.loads(text)

        def segment(entry: dict) -> Segment:
            listed = entry["deliveries"]
            return Segment(
                entry["number"], None if listed is None else tuple(listed), entry["distinct"]
            )

        return Manifest(
            T.StructType.fromJson(read["schema"]),
            tuple(read["partition_by"]),
            tuple(map(segment, read["segments"])),
        )


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root.rstrip("/")
        # Manifests never change, so each is read once.
        self._known: dict[tuple[str, int], Manifest] = {}

    # --- files ---------------------------------------------------------------------------

    def _path(self, path: str):
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self._spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list:
        folder, system = self._path(path)
        return list(system.listStatus(folder)) if system.exists(folder) else []

    def _delete(self, path: str) -> None:
        target, system = self._path(path)
        system.delete(target, True)

    def _manifest_path(self, name: str, version: int) -> str:
        return f"{self._root}/{name}/v{version:06d}.json"

    def _segment_path(self, name: str, number: int) -> str:
        return f"{self._root}/{name}/{SEGMENT}={number:06d}"

    def _numbers(self, name: str, prefix: str, suffix: str = "") -> list[int]:
        found = []
        for status in self._list(f"{self._root}/{name}"):
            label = status.getPath().getName()
            digits = label.removeprefix(prefix).removesuffix(suffix)
            if label == f"{prefix}{digits}{suffix}" and digits.isdigit():
                found.append(int(digits))
        return sorted(found)

    def _versions(self, name: str) -> list[int]:
        return self._numbers(name, "v", ".json")

    def _manifest(self, name: str, version: int) -> Manifest:
        if (name, version) not in self._known:
            path, system = self._path(self._manifest_path(name, version))
            java = self._spark._jvm.java.io
            reader = java.BufferedReader(java.InputStreamReader(system.open(path), "UTF-8"))
            try:
                self._known[name, version] = Manifest.from_json(reader.readLine())
            finally:
                reader.close()
        return self._known[name, version]

    def _newest(self, name: str) -> Manifest | None:
        versions = self._versions(name)
        return self._manifest(name, versions[-1]) if versions else None

    def _commit(self, name: str, manifest: Manifest, before: Manifest | None) -> None:
        """Make a manifest the next version after the one it was worked out from."""
        versions = self._versions(name)
        newest = self._manifest(name, versions[-1]) if versions else None
        version = versions[-1] + 1 if versions else 1
        target, system = self._path(self._manifest_path(name, version))
        written, _ = self._path(f"{self._root}/{name}/.v{version:06d}-{max(self._segments(name), default=0)}")
        stream = system.create(written, True)
        stream.write(bytearray(manifest.to_json().encode()))
        stream.close()
        if newest != before or system.exists(target) or not system.rename(written, target):
            raise RuntimeError(f"another writer changed {name!r} below {self._root}")
        self._known[name, version] = manifest

    def _segments(self, name: str) -> list[int]:
        """Every segment there is, also of jobs that failed or still run."""
        return self._numbers(name, f"{SEGMENT}=")

    # --- reading -------------------------------------------------------------------------

    def names(self) -> list[str]:
        """The tables that have a committed version."""
        found = [s.getPath().getName() for s in self._list(self._root) if s.isDirectory()]
        return sorted(name for name in found if self.exists(name))

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def read(self, name: str) -> DataFrame:
        manifest = self._newest(name)
        if manifest is None:
            raise KeyError(f"no result table {name!r} below {self._root}")
        return self._rows(name, manifest, manifest.segments)

    def _rows(self, name: str, manifest: Manifest, segments: Sequence[Segment]) -> DataFrame:
        if not segments:
            return self._spark.createDataFrame([], manifest.schema)
        paths = [self._segment_path(name, segment.number) for segment in segments]
        reader = self._spark.read.schema(manifest.schema)
        rows = reader.option("basePath", f"{self._root}/{name}").parquet(*paths)
        return rows.select(*manifest.schema.names)

    # --- writing -------------------------------------------------------------------------

    def _write_segment(
        self, df: DataFrame, name: str, partition_by: Sequence[str], distinct: bool
    ) -> Segment:
        known = self._segments(name)
        number = known[-1] + 1 if known else 1
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._segment_path(name, number))
        whole = Manifest(df.schema, tuple(partition_by), (Segment(number, None, distinct),))
        return replace(whole.segments[0], deliveries=self._deliveries(name, whole))

    def _deliveries(self, name: str, manifest: Manifest) -> tuple[str | None, ...] | None:
        """The values of the delivery column of what a manifest lists, if they are few."""
        if DELIVERY not in manifest.schema.names:
            return None
        values = self._rows(name, manifest, manifest.segments).select(
            F.col(DELIVERY).cast("string")
        )
        found = [row[0] for row in values.distinct().limit(MOST_LISTED + 1).collect()]
        return None if len(found) > MOST_LISTED else tuple(found)

    def write(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        csv: str | None = None,
    ) -> DataFrame:
        """Replace the table; with csv, also write it as text below that folder."""
        before = self._newest(name)
        segment = self._write_segment(df, name, partition_by, distinct=False)
        self._commit(name, Manifest(df.schema, tuple(partition_by), (segment,)), before)
        return self._stored(name, csv)

    def _stored(self, name: str, csv: str | None) -> DataFrame:
        stored = self.read(name)
        if csv is not None:
            stored.write.mode("overwrite").option("header", True).csv(f"{csv.rstrip('/')}/{name}")
        return stored

    def append(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        csv: str | None = None,
    ) -> DataFrame:
        """Add the rows that the table does not hold yet.

        Equal rows collapse, so repeating a run changes nothing. The rows are written as a segment,
        whose deliveries tell with which older segments they may share rows; only those are read,
        and where there are some, what is new is written once more without what they hold. A table
        that was replaced, and so may hold equal rows, is made distinct by the first append; one
        whose columns get another type, or that is partitioned otherwise, is written anew.
        """
        before = self._newest(name)
        if before is None:
            return self._add(name, None, df.distinct(), partition_by, (), csv)
        stored = self._rows(name, before, before.segments)
        # Fails here, as a union does, where the columns are not the same.
        schema = _widened(stored, df).schema
        fits = _kinds(schema) == _kinds(before.schema) and tuple(partition_by) == before.partition_by
        if not fits or not all(segment.distinct for segment in before.segments):
            return self._add(name, before, union_distinct([stored, df]), partition_by, (), csv)
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in before.schema]).distinct()
        segment = self._write_segment(rows, name, partition_by, distinct=True)
        touched = [s for s in before.segments if s.may_hold(segment.deliveries)]
        if not touched:
            kept = (*before.segments, segment)
            self._commit(name, replace(before, segments=kept), before)
            return self._stored(name, csv)
        delivered = self._rows(name, before, [segment])
        held = self._rows(name, before, touched)
        if segment.deliveries is not None:
            held = held.filter(_one_of(DELIVERY, segment.deliveries))
        shown = self._add(name, before, delivered.subtract(held), partition_by, before.segments, csv)
        self._delete(self._segment_path(name, segment.number))
        return shown

    def _add(
        self,
        name: str,
        before: Manifest | None,
        rows: DataFrame,
        partition_by: Sequence[str],
        kept: tuple[Segment, ...],
        csv: str | None,
    ) -> DataFrame:
        """Commit distinct rows as one more segment besides those that are kept."""
        segment = self._write_segment(rows, name, partition_by, distinct=True)
        schema = before.schema if before is not None and kept else rows.schema
        if segment.deliveries == ():
            # Nothing new: the version lists what the one before it does.
            self._delete(self._segment_path(name, segment.number))
            segments = kept
        else:
            segments = (*kept, segment)
        self._commit(name, Manifest(schema, tuple(partition_by), segments), before)
        return self._stored(name, csv)

    def write_all(self, tables: Mapping[str, DataFrame], append: bool = False) -> None:
        """Write a named collection of tables."""
        for name, df in tables.items():
            (self.append if append else self.write)(df, name)

    # --- tidying -------------------------------------------------------------------------

    def compact(self, name: str) -> DataFrame:
        """Write the rows of many segments as one segment of a new version."""
        before = self._newest(name)
        if before is None:
            raise KeyError(f"no result table {name!r} below {self._root}")
        distinct = all(segment.distinct for segment in before.segments)
        rows = self._rows(name, before, before.segments)
        segment = self._write_segment(rows, name, before.partition_by, distinct)
        self._commit(name, replace(before, segments=(segment,)), before)
        return self.read(name)

    def drop(self, name: str) -> None:
        """Remove every version of a table; a table that is not there is no error."""
        if self.exists(name):
            self._delete(f"{self._root}/{name}")
            self._known = {key: m for key, m in self._known.items() if key[0] != name}

    def prune(self, name: str, keep: int = 1) -> None:
        """Remove all but the newest versions, and the segments that only those had. Plans over
        removed versions can no longer run."""
        if keep < 1:
            raise ValueError("at least one version has to stay")
        versions = self._versions(name)
        held = {s.number for v in versions[-keep:] for s in self._manifest(name, v).segments}
        for version in versions[:-keep]:
            old = self._manifest(name, version)
            self._delete(self._manifest_path(name, version))
            for number in {segment.number for segment in old.segments} - held:
                self._delete(self._segment_path(name, number))
            del self._known[name, version]


def _widened(stored: DataFrame, df: DataFrame) -> DataFrame:
    return stored.unionByName(df)


def _kinds(schema: T.StructType) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in schema}


def _one_of(column: str, values: Sequence[str | None]) -> Column:
    """Whether a column, as a string, is one of some values, null among them."""
    tests = [F.col(column).cast("string").eqNullSafe(F.lit(value)) for value in values]
    return reduce(Column.__or__, tests, F.lit(False))
