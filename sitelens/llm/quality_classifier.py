"""Quality from compression: which of two dictionaries, of good or of bad text, fits better.

Zstandard dictionaries are built from good and bad labelled text. A text is cut into blocks, every
block is compressed with either dictionary, and the difference of both sizes, divided by the length
of the text, says which kind it resembles. A logistic curve fitted on labelled rows that are in
neither dictionary turns the difference into a probability.

Sample bound: at most `Settings.each` labelled rows of a class in expectation (twice that in any
case) are learned from, chosen by a hash; of these, texts of more than `Settings.longest` bytes are left
out. Scoring reads whole texts.

Cases: a null or empty text has difference 0 and the score of that; labels that are null, or of
rows without text, teach nothing; without labels of both classes every score is the share of good
labels (1.0 without any); equal texts have equal scores.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm.common import map_batches, remainder_is, sampled, text_bytes


@dataclass(frozen=True)
class Settings:
    each: int = 1500
    longest: int = 60_000
    dictionary_bytes: int = 112_640
    block_bytes: int = 2048
    level: int = 3
    #: Of the sample, one row in so many fits the curve and is in no dictionary.
    curve_every: int = 3


@dataclass(frozen=True)
class Model:
    """Plain values, so that it can be sent to tasks; `curve` is None for a constant score."""

    good: bytes
    bad: bytes
    curve: tuple[float, float] | None
    share: float
    settings: Settings


@functools.lru_cache(maxsize=4)
def _compressors(model: Model) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    return _compressor(model.good, model.settings), _compressor(model.bad, model.settings)


def _compressor(dictionary: bytes, settings: Settings) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=settings.level)
    return zstandard.ZstdCompressor(
        level=settings.level, dict_data=data, write_checksum=False, write_dict_id=False
    )


def _difference(
    text: bytes,
    good: zstandard.ZstdCompressor,
    bad: zstandard.ZstdCompressor,
    block: int,
) -> float:
    """Bytes that the good dictionary saves over the bad one, per byte of text."""
    if not text:
        return 0.0
    saved = 0
    for start in range(0, len(text), block):
        part = text[start : start + block]
        saved += len(bad.compress(part)) - len(good.compress(part))
    return saved / len(text)


def _dictionary(samples: list[bytes], settings: Settings) -> bytes:
    """A trained dictionary; with too few samples to train one, their text as it is."""
    blocks = [
        t[i : i + settings.block_bytes] for t in samples for i in range(0, len(t), settings.block_bytes)
    ]
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-settings.dictionary_bytes :]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic regression, by Newton's method."""
    scale = float(x.std()) or 1.0
    z = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - 1e-3 * w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    held_out: tuple[int, int] = (5, 0),
) -> Model:
    """Learn from labelled rows that are not held out.

    `held_out`: rows whose crc32 of the id leaves the second number modulo the first.
    """
    usable = labels.select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~remainder_is(F.col("id"), *held_out))
    usable = usable.distinct()
    totals = {r[0]: r[1] for r in usable.groupBy("label").count().collect()}
    share = totals.get(1, 0) / sum(totals.values()) if totals else 1.0
    chosen = F.broadcast(sampled(usable, "id", "label", settings.each))
    rows = (
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
        .join(chosen, "id")
        .filter((F.octet_length("text") > 0) & (F.octet_length("text") <= settings.longest))
        .select("label", F.crc32("text").alias("mix"), "text")
        .limit(4 * settings.each)
        .collect()
    )
    rows = sorted(rows, key=lambda r: (r.mix, bytes(r.text)))
    split: dict[tuple[int, bool], list[bytes]] = {}
    for i, r in enumerate(rows):
        split.setdefault((r.label, i % settings.curve_every == 0), []).append(bytes(r.text))
    if not all(split.get((k, part)) for k in (0, 1) for part in (True, False)):
        return Model(b"", b"", None, share, settings)
    good, bad = (_dictionary(split[k, False], settings) for k in (1, 0))
    tools = _compressor(good, settings), _compressor(bad, settings)
    x, y, weight = [], [], []
    for k in (0, 1):
        texts = split[k, True]
        x += [_difference(t, *tools, settings.block_bytes) for t in texts]
        y += [k] * len(texts)
        weight += [(share if k else 1 - share) / len(texts) * len(rows)] * len(texts)
    curve = _curve(np.array(x), np.array(y, dtype=float), np.array(weight))
    return Model(good, bad, curve, share, settings)


def scorer(spark: SparkSession, model: Model):
    """A function from texts as bytes to scores, for use inside tasks."""
    shipped = spark.sparkContext.broadcast(model)

    def score(values: list[bytes]) -> list[float]:
        model = shipped.value
        if model.curve is None:
            return [model.share] * len(values)
        tools = _compressors(model)
        slope, intercept = model.curve
        found = []
        for value in values:
            z = slope * _difference(value, *tools, model.settings.block_bytes) + intercept
            found.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
        return found

    return score


def score(rows: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The probability of label 1 for every row: doc_id, score."""
    of = scorer(rows.sparkSession, model)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = of(text_bytes(batch.column(1)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
        )

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, apply, "doc_id long, score double")


def accepted(
    rows: DataFrame, model: Model, threshold: float = 0.3, *, text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""
    of = scorer(rows.sparkSession, model)
    at = rows.schema.fieldNames().index(text)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = of(text_bytes(batch.column(at)))
        return batch.filter(pa.array([s >= threshold for s in scores], pa.bool_()))

    return map_batches(rows, apply, rows.schema)
