"""Order MinHash: fingerprints whose agreement follows edit distance.

Every k-mer of code points is numbered by its occurrence, so repeats differ. A hash deals the
numbered k-mers to slots; a slot selects its `tuple_size` smallest, puts them back into the order
of the text and hashes the tuple of k-mers. So one pass over a long text selects for all slots. A slot
that is dealt too few (in short texts) selects among all k-mers of the text by a hash of its own, as
every slot would if each had one. Two texts agree in a slot only if they share the selected k-mers and
their order. Likeness is the share of agreeing slots among those that either
text fills.

Cases: a text shorter than a k-mer is one k-mer; a null or empty text fills no slot, is like
another empty text (1.0) and unlike any other (0.0); equal texts have equal fingerprints; a long
text is hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import map_batches, texts

KMER = 8
SLOTS = 64
TUPLE_SIZE = 2
#: Texts per range of ids, and the largest number of ranges; their borders are all that is collected.
RANGE_ROWS, MOST_RANGES = 4000, 10_000

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C[1]
    h = (h ^ (h >> np.uint64(27))) * _C[2]
    return h ^ (h >> np.uint64(31))


def _kmers(codes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k-mer, built from hashes of shorter ones."""
    grams, have, factor = (codes + np.uint64(1)) * _C[0], 1, _C[0]
    out, done = None, 0
    while True:
        if k & have:
            # Append this power of two to what is put together already.
            if out is None:
                out, done = grams, have
            else:
                n = len(out) - have
                out = out[:n] * factor + grams[done : done + n]
                done += have
        if have * 2 > k:
            break
        n = len(grams) - have
        grams = grams[:n] * factor + grams[have : have + n]
        factor = factor * factor
        have *= 2
    return _mixed(out[: len(codes) - k + 1])


def signature(
    text: str, kmer: int = KMER, slots: int = SLOTS, tuple_size: int = TUPLE_SIZE
) -> np.ndarray:
    """One number per slot, which is 0 for an empty text."""
    found = np.zeros(slots, np.uint16)
    if not text:
        return found
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        if len(codes) < kmer:
            whole = hashlib.blake2b(codes.tobytes(), digest_size=8).digest()
            grams = np.frombuffer(whole, np.uint64)
        else:
            grams = _kmers(codes, kmer)
        n = len(grams)
        places = np.arange(n, dtype=np.uint64)
        # Equal k-mers become neighbours in the order of the text; a count numbers them.
        ordered = np.sort((grams & ~_LOW) | places)
        gram, place = ordered >> _32, (ordered & _LOW).astype(np.int64)
        new = np.flatnonzero(np.diff(gram, prepend=gram[0] + np.uint64(1)))
        number = np.arange(n) - np.repeat(new, np.diff(new, append=n))
        value = _mixed(gram * _C[0] + number.astype(np.uint64) * _C[1])
        # Slot in the upper half, rank within the slot in the lower half.
        low = value & _LOW
        key = (((value >> _32) * np.uint64(slots)) & ~_LOW) | low
        weight = np.cumprod(np.full(tuple_size, _C[0], np.uint64))
        dealt = np.bincount((key >> _32).astype(np.int64), minlength=slots)
        short = np.flatnonzero(dealt < tuple_size)
        if len(short):
            own_hash = _mixed(value[None, :] + (short[:, None] + 1).astype(np.uint64) * _C[2])
            chosen = np.argsort(own_hash, axis=1, kind="stable")[:, :tuple_size]
            chosen = np.take_along_axis(chosen, np.argsort(place[chosen], axis=1), axis=1)
            tuples = (_mixed(gram[chosen] + _C[2]) * weight[: chosen.shape[1]]).sum(axis=1)
            found[short] = _hashed(tuples)
            full = dealt[(key >> _32).astype(np.int64)] >= tuple_size
            key, place, gram, low = key[full], place[full], gram[full], low[full]
            if not len(key):
                return found
        # Only values among the smallest of all can be among the smallest of their slot.
        if not len(short) and n > 16 * slots * tuple_size:
            few = np.flatnonzero(low < np.uint64((1 << 32) * 8 * slots * tuple_size // n))
            count = np.bincount((key[few] >> _32).astype(np.int64), minlength=slots)
            if count.min() >= tuple_size:
                key, place, gram = key[few], place[few], gram[few]
        order = np.argsort(key, kind="stable")
        own = (key[order] >> _32).astype(np.int64)
        first = np.flatnonzero(np.diff(own, prepend=-1))
        rank = np.arange(len(own)) - np.repeat(first, np.diff(first, append=len(own)))
        chosen = order[rank < tuple_size]
        # Back into the order of the text within every slot.
        own = (key[chosen] >> _32).astype(np.int64)
        chosen = chosen[np.argsort((own << 32) | place[chosen], kind="stable")]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        rank = np.arange(len(own)) - np.repeat(first, np.diff(first, append=len(own)))
        tuples = np.add.reduceat(_mixed(gram[chosen] + _C[2]) * weight[rank], first)
        found[own[first]] = _hashed(tuples)
    return found


def _hashed(tuples: np.ndarray) -> np.ndarray:
    return (_mixed(tuples) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    filled = np.count_nonzero((a > 0) | (b > 0))
    if not filled:
        return 1.0
    return float(np.count_nonzero((a == b) & (a > 0)) / filled)


def as_text(found: np.ndarray) -> str:
    return found.astype(">u2").tobytes().hex()


def fingerprints(rows: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint (four hexadecimal digits a slot) of every text."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [as_text(signature(t)) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"]
        )

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, apply, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the beginning of the following text, or all of it."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def compare_with_next(rows: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text beside the next one in descending order of ids; the first follows the last.

    One row per row of `rows`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null id comes last; equal ids are ordered by a hash of the text.

    Ids are cut into ranges by quantiles. Texts are shuffled once, by range; the first text of a
    range also goes to the range before it, so every range is read as a stream of sorted rows in
    which each row meets its successor, and one text at a time is held.
    """
    base = rows.select(
        F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ids = base.select("doc_id")
    count, named = ids.agg(F.count("*"), F.count("doc_id")).first()
    if not count:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    ranges = max(1, min(MOST_RANGES, count // RANGE_ROWS))
    cuts = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = ids.filter("doc_id IS NOT NULL").agg(
            F.percentile_approx("doc_id", shares, 100 * ranges)
        ).first()[0] or []
    splits = [-float("inf"), *sorted(set(map(float, cuts))), float("inf")]
    # Null ids are ordered by a hash of the text, which is spread evenly.
    nameless = max(1, min(MOST_RANGES, (count - named) // RANGE_ROWS))
    share = (F.col("mark") / F.lit(2.0**64) + F.lit(0.5)) * nameless
    of_null = F.least(F.floor(share), F.lit(nameless - 1)).cast("int") - nameless

    def ranged(frame: DataFrame) -> DataFrame:
        """Ranges are numbered from the smallest ids; those of null ids are before them all."""
        if len(splits) < 3:
            return frame.withColumn("bin", F.when(F.col("doc_id").isNull(), of_null).otherwise(0))
        part = frame.withColumn("as_double", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))
        part = Bucketizer(splits=splits, inputCol="as_double", outputCol="bin").transform(part)
        return part.withColumn(
            "bin", F.when(F.col("doc_id").isNull(), of_null).otherwise(F.col("bin").cast("int"))
        ).drop("as_double")

    keyed = ranged(base.withColumn("mark", F.xxhash64("text")))
    heads = keyed.groupBy("bin").agg(
        F.max(F.struct(F.coalesce("doc_id", F.lit(0).cast("long")).alias("i"), "mark")).alias("head")
    )
    # As many rows as ranges; the range that a head is sent to is the one above it.
    above = Window.orderBy("bin")
    heads = heads.withColumn("to", F.lead("bin").over(above)).withColumn(
        "to", F.coalesce("to", F.min("bin").over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    heads = rows.sparkSession.createDataFrame(
        [(r.bin, r.head.i, r.head.mark, r.to) for r in heads.collect()],
        "bin int, head_id long, head_mark long, to int",
    )
    is_head = (F.coalesce("doc_id", F.lit(0).cast("long")) == F.col("head_id")) & (
        F.col("mark") == F.col("head_mark")
    )
    places = F.when(
        is_head,
        F.array(
            F.struct(F.col("bin").alias("bin"), F.lit(0).alias("extra")),
            F.struct(F.col("to").alias("bin"), F.lit(1).alias("extra")),
        ),
    ).otherwise(F.array(F.struct(F.col("bin").alias("bin"), F.lit(0).alias("extra"))))
    sent = keyed.join(F.broadcast(heads), "bin").select(
        F.explode(places).alias("at"), "doc_id", "mark", "text"
    )
    ordered = (
        sent.select("at.bin", "at.extra", "doc_id", "mark", "text")
        .repartition("bin")
        .sortWithinPartitions("bin", "extra", F.desc_nulls_last("doc_id"), F.desc("mark"))
        .select("bin", "extra", "doc_id", "text")
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row whose successor comes next: range, id, text, signature
        for batch in batches:
            out = []
            bins, extras, ids = (batch.column(i).to_pylist() for i in range(3))
            for i, value in enumerate(texts(batch.column(3))):
                if waiting is None and extras[i]:
                    continue  # a repeated head has been met already
                if waiting is not None and waiting[0] != bins[i]:
                    raise ValueError("a range of ids ended without the text that follows it")
                sign = signature(value)
                if waiting is not None:
                    out.append(_row(*waiting[1:], value, sign))
                waiting = None if extras[i] else (bins[i], ids[i], value, sign)
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
                )
        if waiting is not None:
            raise ValueError("a range of ids ended without the text that follows it")

    return ordered.mapInArrow(apply, SCHEMA)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(",")]
_TYPES = [
    {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[part.split()[1]]
    for part in SCHEMA.split(",")
]


def _row(doc_id, text: str, sign: np.ndarray, following: str, next_sign: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = sign if changed == text else signature(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        as_text(sign),
        as_text(other),
        likeness(sign, other),
        likeness(sign, next_sign),
    )
