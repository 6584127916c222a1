"""What the operators share: reading, held-out rules, bounded samples, joins of checked size,
checkpoints and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a regular expression class and as Python's bytes.split().
SPACE_CLASS = r"\x20\x09-\x0D"

#: A side of a join is broadcast only if its measured rows need at most so many bytes.
BROADCAST_BYTES = 32 << 20

#: Rows and bytes of text per Arrow batch, so that a batch of long documents fits a Python worker. A
#: batch ends with the row that reaches the bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on; a checkpoint folder only where none is named."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A key with a large share of the rows is dealt to several tasks, even at the cost of a shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    # Local Python workers import the package from where the driver did, whatever their folder.
    # On a cluster it is installed or sent along as for any job.
    context.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def shared_folder(spark: SparkSession) -> str:
    """Where executors and driver can both read and write: what the cluster names for checkpoints,
    else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this program has written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unused(columns: Iterable[str], name: str) -> str:
    """A column name that clashes with none of the given ones, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")


def remainder_is(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def in_sample(key: Column, share: Column) -> Column:
    """Whether a row belongs to a sample of the given share; the same rows on every run."""
    return (F.xxhash64(key, F.lit("sample")) % 1_000_000 + 1_000_000) % 1_000_000 < share * 1_000_000


def sampled(rows: DataFrame, key: str, strata: str, each: int) -> DataFrame:
    """About `each` rows of every value of `strata`, never more than twice that in all.

    Chosen by a hash of `key`; values of `strata` are the classes of a model and so are few.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(strata).count().collect()}
    share = F.lit(0.0)
    for value, count in sorted(counts.items(), key=lambda x: str(x[0])):
        share = F.when(F.col(strata) == F.lit(value), F.lit(min(1.0, each / count))).otherwise(share)
    return rows.filter(in_sample(F.col(key), share)).limit(2 * each * max(1, len(counts)))


def join_checked(
    left: DataFrame, right: DataFrame, on: Column | list[str], how: str, row_bytes: int
) -> DataFrame:
    """Join with the right side broadcast if its counted rows are few, else shuffled."""
    if right.count() * row_bytes <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return left.join(right, on, how)


#: What workers keep from task to task, by the module that keeps it: functions that let it go.
_TABLES: dict[str, Callable[[], None]] = {}


def keeps_tables(module: str, forget: Callable[[], None]) -> None:
    """Say how to free what a module keeps in a worker between its tasks. It is freed when a task of
    another module begins there: a worker lives as long as the session, and a pipeline would have it
    hold the tables of all stages at once."""
    _TABLES[module] = forget


def others_forget(module: str) -> None:
    for name, forget in _TABLES.items():
        if name != module:
            forget()


def map_batches(
    rows: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """Apply a function to every Arrow batch of the rows; order and batches carry no meaning."""

    module = function.__module__

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others_forget(module)
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return rows.mapInArrow(apply, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts as strings; null is empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The connected component of every node of some edges, as rows (node, root).

    Alternating large and small stars: each round points all neighbours of a node at their
    minimum, by an aggregation and a join, until nothing changes. The number of rounds grows with
    the logarithm of the number of nodes. Each round is checkpointed. The root is the smallest
    node; edges from a node to itself only name the node.
    """
    every = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    alone = every.select(F.col("u").alias("node"), F.col("u").alias("root")).unionByName(
        every.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
    now = (
        every.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        now = small.checkpoint()
        found = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return alone.unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))
