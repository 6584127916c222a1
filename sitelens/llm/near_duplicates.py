"""Near duplicates by MinHash, verified step by step with Bayesian bounds and then exactly.

1. Every text becomes a set of word shingles (hashed to 64 bits), a digest of the set, a MinHash
   signature and the hashes of its bands. Texts with equal sets form a class; from here on classes
   stand for texts, so copies cost nothing more.
2. Classes that share a band are candidates. In a band with few classes all pairs are, in a larger
   one every class with the smallest one only; the others of that band meet in step 4.
3. Pairs of small bands compare their signatures in batches. After each batch the posterior of
   "similarity reaches the threshold", from a uniform prior, is bounded; a pair below the chosen
   miss probability is dropped.
4. What is left joins classes into clusters. A cluster is cut into blocks of bounded size, each
   with the cluster's smallest class. Within a block classes are visited from one to the next; a
   visited class meets all that are not yet visited, first by signature as in step 3, then by the
   full sets. Classes that are connected already need no further comparison, so neither large
   groups of near copies nor exact copies are expanded into pairs.
5. Clusters of several blocks that are still in parts have all classes outside their largest part
   compared with all classes of other parts, block by block. So no link is lost for being split.

Chance of missing a pair: it shares no band (at similarity t: (1 - t ** rows) ** bands, 1.2e-5 with
the defaults at 0.85) or is dropped (at most `miss` per batch).

Cases: a null or empty text, or one without words, has an empty set and is linked with nothing; a
null id is linked with nothing and stands for itself; equal rows each come back, with the same
component; texts shorter than a shingle are one shingle; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from sitelens.llm.common import (
    components,
    join_checked,
    keeps_tables,
    map_batches,
    text_bytes,
    unused,
)


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    #: Link when `percent` / 100 of the union is shared.
    percent: int = 85
    bands: int = 24
    rows: int = 6
    #: Signatures are compared in batches of so many values.
    batch: int = 16
    #: Probability of dropping, at a batch, a pair that reaches the threshold.
    miss: float = 1e-6
    #: Bands with at most so many classes are paired completely.
    small_band: int = 6
    #: Classes of a block, and bytes of their sets on average.
    block: int = 2000
    block_bytes: int = 64 << 20

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


_ODD = np.random.RandomState(20240229).randint(0, 1 << 62, 1024, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    """Hashes of words met before; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()
keeps_tables(__name__, _WORDS.clear)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += h[i : i + n] * _ODD[512 + i]
    return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """Smallest hash of every set under every hash function; sets must not be empty."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    found = np.empty((len(sets), hashes), np.uint64)
    for j in range(hashes):
        found[:, j] = np.minimum.reduceat(joined * _ODD[j], starts)
    return found


def band_hashes(signature: np.ndarray, settings: Settings) -> np.ndarray:
    parts = _mixed(signature).reshape(len(signature), settings.bands, settings.rows)
    total = np.arange(settings.bands, dtype=np.uint64)[None, :] * _ODD[600]
    for i in range(settings.rows):
        total = total + parts[:, :, i] * _ODD[601 + i]
    return _mixed(total).astype(np.int64)


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """After how many values how many must be equal for a pair to stay.

    With a uniform prior the posterior of similarity s after m of n matches is Beta(m + 1,
    n - m + 1), and P(s >= t) = P(Binomial(n + 1, t) <= m). The bound is the smallest m for which
    this reaches `miss`.
    """
    t = settings.percent / 100
    found = []
    for n in range(settings.batch, settings.hashes + 1, settings.batch):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= settings.miss:
                break
        found.append((n, m))
    return found


def describe(
    rows: DataFrame, settings: Settings, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, key (digest of the set; null for an empty one), bands and signature."""
    hashes = settings.hashes

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, settings.shingle) for t in text_bytes(batch.column(1))]
        full = [s for s in sets if len(s)]
        bands: list[list[int]] = []
        short: list[bytes] = []
        group: list[np.ndarray] = []
        size = 0
        for i, s in enumerate(full):
            group.append(s)
            size += len(s)
            if size >= 50_000 or i + 1 == len(full):
                found = signatures(group, hashes)
                bands += band_hashes(found, settings).tolist()
                short += [row.tobytes() for row in (found >> np.uint64(20)).astype(np.uint16)]
                group, size = [], 0
        some = iter(zip(bands, short, strict=True))
        pairs = [next(some) if len(s) else (None, None) for s in sets]
        keys = [set_key(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([b for b, _ in pairs], pa.list_(pa.int64())),
                pa.array([s for _, s in pairs], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "key", "bands", "signature"],
        )

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_shingles long, key binary, bands array<long>, signature binary"
    return map_batches(chosen, apply, schema)


def set_key(sorted_hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(sorted_hashes.tobytes(), digest_size=16).digest()


def candidate_pairs(classes: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) from small bands, and (a, smallest) from large ones."""
    banded = classes.select("key", F.explode("bands").alias("band"))
    sizes = (
        banded.groupBy("band")
        .agg(F.count("*").alias("size"), F.min("key").alias("least"))
        .filter("size > 1")
    )
    met = banded.join(sizes, "band").checkpoint()
    star = met.filter((F.col("size") > settings.small_band) & (F.col("key") != F.col("least")))
    # At most `small_band` classes are gathered per band.
    few = (
        met.filter(F.col("size") <= settings.small_band)
        .groupBy("band")
        .agg(F.sort_array(F.collect_set("key")).alias("keys"))
    )
    pairs = few.select(
        F.explode(
            F.flatten(
                F.transform(
                    "keys",
                    lambda a, i: F.transform(
                        F.slice(F.col("keys"), i + 2, settings.small_band),
                        lambda b: F.struct(a.alias("a"), b.alias("b")),
                    ),
                )
            )
        ).alias("p")
    )
    return (
        pairs.select("p.a", "p.b").distinct(),
        star.select(F.col("key").alias("a"), F.col("least").alias("b")).distinct(),
    )


def _undropped(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Places of pairs of signatures that no batch drops; later batches see only what is left."""
    left = np.arange(max(len(a), len(b)))
    matches = np.zeros(len(left), np.int64)
    done = 0
    for n, least in bounds:
        x = a[left] if len(a) > 1 else a
        y = b[left] if len(b) > 1 else b
        matches[left] += (x[:, done:n] == y[:, done:n]).sum(axis=1)
        left = left[matches[left] >= least]
        done = n
        if not len(left):
            break
    return left


def prune(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that the comparison of signatures leaves."""
    bounds = least_matches(settings)
    of = lambda name: classes.select(F.col("key").alias(name), F.col("signature").alias(f"{name}_s"))

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, settings.hashes)
            for i in (2, 3)
        )
        return batch.take(pa.array(_undropped(a, b, bounds))).select([0, 1])

    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "a_s", "b_s")
    return map_batches(joined, apply, "a binary, b binary")


def _shared_enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Block:
    """Classes with their signatures and sets, to be visited."""

    def __init__(self, keys: list[bytes], signs: list[bytes], sets: list[bytes], settings: Settings):
        self.keys = keys
        self.signs = np.frombuffer(b"".join(signs), np.uint16).reshape(len(keys), settings.hashes)
        self.sets = [np.frombuffer(s, np.uint64) for s in sets]
        self.sizes = np.fromiter(map(len, self.sets), np.int64, len(keys))
        self.settings = settings
        self.bounds = least_matches(settings)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of the others are linked with class i."""
        percent = self.settings.percent
        size = self.sizes[others]
        fit = 100 * np.minimum(size, self.sizes[i]) >= percent * np.maximum(size, self.sizes[i])
        others = others[fit]
        if not len(others):
            return others
        near = others[_undropped(self.signs[i : i + 1], self.signs[others], self.bounds)]
        mine = self.sets[i]
        return np.array([j for j in near if _shared_enough(mine, self.sets[j], percent)], np.int64)

    def parts(self) -> list[int]:
        """The number of a class that stands for the part each class belongs to."""
        part = [-1] * len(self.keys)
        unseen = np.arange(len(self.keys))
        while len(unseen):
            root = int(unseen[0])
            part[root] = root
            waiting, unseen = [root], unseen[1:]
            while waiting and len(unseen):
                found = self.linked(waiting.pop(), unseen)
                for j in found:
                    part[j] = root
                waiting += found.tolist()
                unseen = np.setdiff1d(unseen, found, assume_unique=True)
        return part



def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[dict]]:
    """Rows that follow each other with equal values in the named columns."""
    group: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and any(row[n] != group[0][n] for n in names):
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _sorted_groups(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.repartition(*names).sortWithinPartitions(*names)


def with_sets(
    rows: DataFrame, members: DataFrame, settings: Settings, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The members (id, key and more) with the full set of their text.

    Only the texts that stand for a class are read again; repeated ids are told apart by the key.
    """
    chosen = rows.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    joined = join_checked(chosen, members, ["id"], "inner", 600).drop("id")
    names = [c for c in joined.columns if c != "text"]
    joined = joined.select("text", *names)
    at = names.index("key") + 1
    schema = "set binary, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields[1:]
    )

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, settings.shingle) for t in text_bytes(batch.column(0))]
        same = [
            i
            for i, (s, key) in enumerate(zip(sets, batch.column(at).to_pylist(), strict=True))
            if len(s) and set_key(s) == key
        ]
        first = pa.array([sets[i].tobytes() for i in same], pa.binary())
        rest = batch.take(pa.array(same, pa.int32())).columns[1:]
        return pa.RecordBatch.from_arrays([first, *rest], names=["set", *names])

    return map_batches(joined, apply, schema)


def _unrepeated(group: list[dict]) -> list[dict]:
    """Rows that were read twice, because the table repeats them, count once."""
    return list({r["key"]: r for r in group}.values())


def _visit_blocks(members: DataFrame, settings: Settings) -> DataFrame:
    """Links found within blocks: (a, b) for every class and the class its part is named by."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["cluster", "block"]):
            group = sorted(_unrepeated(group), key=lambda r: r["key"])
            keys = [r["key"] for r in group]
            block = _Block(keys, [r["signature"] for r in group], [r["set"] for r in group], settings)
            roots = [keys[i] for i in block.parts()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(roots, pa.binary())], names=["a", "b"]
            )

    chosen = members.select("cluster", "block", "key", "signature", "set")
    return _sorted_groups(chosen, ["cluster", "block"]).mapInArrow(apply, "a binary, b binary")


def _visit_pairs(members: DataFrame, settings: Settings) -> DataFrame:
    """Links between classes outside the largest part and classes of other parts.

    `members` has rows (cluster, mine, other, side, key, part, ...): every task compares one block
    of the outside with one block of all. What a task has linked counts as one part from then on.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["cluster", "mine", "other"]):
            outside = {r["key"] for r in group if r["side"] == 0}
            rows = sorted(_unrepeated(group), key=lambda r: r["key"])
            block = _Block(
                [r["key"] for r in rows], [r["signature"] for r in rows], [r["set"] for r in rows], settings
            )
            part = np.unique(np.array([r["part"].hex() for r in rows]), return_inverse=True)[1]
            found: list[tuple[bytes, bytes]] = []
            for i, r in enumerate(rows):
                if r["key"] not in outside:
                    continue
                for j in block.linked(i, np.flatnonzero(part != part[i])):
                    if part[i] != part[j]:
                        found.append((r["key"], rows[j]["key"]))
                        part[part == part[j]] = part[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )

    return _sorted_groups(members, ["cluster", "mine", "other"]).mapInArrow(
        apply, "a binary, b binary"
    )


def find(
    rows: DataFrame, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `rows`: doc_id, n_shingles, component_id, kept.

    `component_id` is the smallest id of the component, `kept` whether the row has it. A row with
    a null id has a null component and is kept.
    """
    found = _components(rows, settings, id, text)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _components(rows: DataFrame, settings: Settings, id: str, text: str) -> DataFrame:
    """What `find` gives, with the key of each row and `chosen`: whether the row has the id and the
    key that stand for its component."""
    described = describe(rows, settings, id=id, text=text).checkpoint()
    linkable = described.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = (
        linkable.groupBy("key")
        .agg(
            F.min("doc_id").alias("id"),
            F.first(F.struct("bands", "signature")).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
        )
        .select("key", "id", "first.bands", "first.signature", "n_shingles")
        .checkpoint()
    )
    pairs, star = candidate_pairs(classes, settings)
    near = prune(pairs, classes, settings).unionByName(star).checkpoint()
    clusters = components(near).select(F.col("node").alias("key"), F.col("root").alias("cluster"))
    clusters = clusters.checkpoint()
    weighed = clusters.join(classes.select("key", "n_shingles"), "key")
    sizes = weighed.groupBy("cluster").agg(_blocks(settings).alias("parts"))
    members = (
        clusters.join(sizes, "cluster")
        .join(classes.select("key", "id", "signature", "n_shingles"), "key")
        .checkpoint()
    )
    block = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    spread = members.withColumn(
        "block",
        F.explode(
            F.when(F.col("key") == F.col("cluster"), F.sequence(F.lit(0), F.col("parts") - 1))
            .otherwise(F.array(block))
        ),
    )
    links = _visit_blocks(with_sets(rows, spread, settings, id=id, text=text), settings).checkpoint()
    parts = links.select(F.col("a").alias("key"), F.col("b").alias("part"))
    if not members.filter("parts > 1").isEmpty():
        parts = components(links).select(F.col("node").alias("key"), F.col("root").alias("part"))
        parts = parts.checkpoint()
        links = _between_blocks(rows, members, parts, links, settings, id, text)
        if links is not None:
            parts = components(links).select(F.col("node").alias("key"), F.col("root").alias("part"))
    part_ids = (
        parts.distinct()
        .join(classes.select("key", "id"), "key")
    )
    least = part_ids.groupBy("part").agg(
        F.min("id").alias("component_id"), F.min(F.struct("id", "key")).alias("least")
    )
    named = part_ids.join(least, "part").select("key", "component_id", "least.key")
    named = named.toDF("key", "component_id", "least_key")
    # Stored, so that both sides of the next join are plain shuffles and the many copies of one text,
    # which share a key, can be split among tasks.
    whole = (
        classes.select("key", "id")
        .join(named, "key", "left")
        .select(
            "key",
            F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce("least_key", "key").alias("least_key"),
        )
        .checkpoint()
    )
    found = linkable.select("key", "doc_id", "n_shingles").join(whole, "key").select(
        "doc_id",
        "n_shingles",
        "component_id",
        "key",
        ((F.col("doc_id") == F.col("component_id")) & (F.col("key") == F.col("least_key"))).alias("chosen"),
    )
    alone = described.filter("key IS NULL OR doc_id IS NULL").select(
        "doc_id",
        "n_shingles",
        F.col("doc_id").alias("component_id"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(True).alias("chosen"),
    )
    every = found.unionByName(alone)
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _blocks(settings: Settings) -> Column:
    """Into how many blocks the classes of a group are dealt, by their number and the size of their
    sets."""
    by_number = F.ceil(F.count("*") / settings.block)
    by_bytes = F.ceil(F.sum("n_shingles") * 8 / settings.block_bytes)
    return F.greatest(by_number, by_bytes).cast("int")


def _between_blocks(
    rows: DataFrame,
    members: DataFrame,
    parts: DataFrame,
    links: DataFrame,
    settings: Settings,
    id: str,
    text: str,
) -> DataFrame | None:
    """All links, with those between blocks of clusters that are still in parts; None if none is."""
    several = members.filter("parts > 1").join(parts, "key")
    counts = several.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    largest = counts.groupBy("cluster").agg(
        F.max(F.struct("n", "part")).alias("m"), F.count("*").alias("left")
    )
    open_ = (
        several.join(largest.filter("left > 1"), "cluster")
        .withColumn("side", F.when(F.col("part") == F.col("m.part"), 1).otherwise(0))
        .drop("m", "left")
        .checkpoint()
    )
    if open_.isEmpty():
        return None
    outside = open_.filter("side = 0")
    shares = outside.groupBy("cluster").agg(_blocks(settings).alias("shares"))
    open_ = open_.join(shares, "cluster")
    share = F.pmod(F.xxhash64("key"), F.col("shares")).cast("int")
    block = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    as_mine = open_.filter("side = 0").select(
        "cluster", "id", "key", "part", "signature", "side",
        share.alias("mine"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
    )
    as_other = open_.select(
        "cluster", "id", "key", "part", "signature", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("mine"),
        block.alias("other"),
    )
    both = with_sets(rows, as_mine.unionByName(as_other), settings, id=id, text=text)
    return links.unionByName(_visit_pairs(both, settings)).checkpoint()


def keep_one(
    rows: DataFrame, settings: Settings = Settings(), *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, of which one of every component stays.

    Rows whose id is not the component's are dropped, by an anti join with their ids. Rows with a
    null id stay. Rows that share an id are told apart by the key of their text: one row stays of the
    id and key that stand for a component, and one of those without words.
    """
    found = _components(rows, settings, id, text).checkpoint()
    named = found.filter("doc_id IS NOT NULL")
    several = named.groupBy("doc_id").count().filter("count > 1").select("doc_id").checkpoint()
    gone = named.filter("NOT kept").select("doc_id").unionByName(several).distinct()
    gone = gone.withColumnRenamed("doc_id", "gone_id")
    if gone.count() * 16 <= 32 << 20:
        gone = F.broadcast(gone)
    kept = rows.join(gone, F.col(id).cast("long") == F.col("gone_id"), "left_anti")
    if several.isEmpty():
        return kept
    own = unused(rows.columns, "set_key")
    chosen = named.join(several, "doc_id", "left_semi").filter("chosen").select("doc_id", "key").distinct()
    chosen = chosen.toDF("chosen_id", "chosen_key")
    shared_id = several.withColumnRenamed("doc_id", "shared_id")
    shared = rows.join(shared_id, F.col(id).cast("long") == F.col("shared_id"), "left_semi")
    same = (F.col(id).cast("long") == F.col("chosen_id")) & F.col(own).eqNullSafe(F.col("chosen_key"))
    stay = _with_key(shared, own, settings, text).join(chosen, same, "left_semi")
    return kept.unionByName(stay.dropDuplicates([id, own]).drop(own))


def _with_key(rows: DataFrame, name: str, settings: Settings, text: str) -> DataFrame:
    """The rows with the key of their text as one more column; null without words."""
    at = rows.columns.index(text)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, settings.shingle) for t in text_bytes(batch.column(at))]
        keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.binary())
        return pa.RecordBatch.from_arrays(
            [*batch.columns, keys], names=[*batch.schema.names, name]
        )

    return map_batches(rows, apply, StructType([*rows.schema.fields, StructField(name, BinaryType())]))
