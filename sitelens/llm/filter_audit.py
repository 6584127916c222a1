"""How filters act together: what each of them removes in every order in which they can run.

Every document gets a verdict of each filter. Counting documents by part and verdicts gives a
contingency tensor for each part: with five filters 2 x 2 x 2 x 2 x 2, index 0 for passing and 1 for
failing along each filter's axis, and such a tensor for each tally (all documents, good ones, toxic
ones). Whatever is asked about an order and a step is a contraction of these tensors in which each
axis is reduced by one of three vectors: passing, failing, or all. One `einsum` does it for all orders
and steps at once, in whole numbers.

One filter looks beyond its own document: a text that also occurs under a smaller id fails it.
Documents are counted by text digest, part, verdicts and tallies before the smallest id of a digest is
looked up, so copies of one text arrive there as a few rows (parts times tallies), however many there
are, and documents are never joined with each other.

Cases: a null text is an empty one. A null part is the part "". A null id is smaller than no other and
has no smaller one; rows that repeat an id and a text do not make each other copies. A document
without a label, or with null marks, is in no tally but that of all documents; several labels of an id
count as one that has the larger marks. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import join_checked, words_of

#: The filter whose verdict depends on other documents.
COPY = "E"

#: The tallies, the first of which is all documents.
TALLIES = ("n", "good", "toxic")

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions under which a text fails on its own, by filter: few words, few distinct words,
    many capitals, odd symbols."""
    n_words = F.size(words)
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": n_words < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n_words,
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def marks(labels: DataFrame, *, id: str = "doc_id") -> DataFrame:
    """One row per id with the tallies it belongs to, as 0 or 1."""
    chosen = labels.filter(F.col(id).isNotNull()).groupBy(F.col(id).cast("long").alias("label_id"))
    flag = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0)))
    return chosen.agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))


def verdicts(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """One row per document: doc_id, part, the digest of its text, the filters it fails on its own
    as a map of flags, and its tallies."""
    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("words", words_of(F.col("text")))
    own = failures(F.col("text"), F.col("words"))
    judged = rows.select(
        "doc_id",
        "part",
        F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("digest"),
        F.struct(*[fails.alias(name) for name, fails in own.items()]).alias("fails"),
    )
    known = marks(labels, id=id)
    joined = join_checked(judged, known, judged["doc_id"] == known["label_id"], "left", 32)
    return joined.select(
        "doc_id",
        "part",
        "digest",
        "fails",
        *[F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in TALLIES[1:]],
    )


def tensors(verdicts: DataFrame) -> DataFrame:
    """The cells of the contingency tensor of each part that are not zero: part, fails (the own
    verdicts and that on copies) and the tallies. At most two to the number of filters a part."""
    alike = ["digest", "part", "fails", *TALLIES[1:]]
    # Rows that repeat an id first: of each group it must be known how many have its smallest id.
    by_id = verdicts.groupBy(*alike, "doc_id").agg(F.count("*").alias("n"))
    first = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    by_text = by_id.groupBy(*alike).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(first).alias("first"),
    )
    # A digest has as many rows here as there are parts and tallies, so the window is small.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    passing = by_text.withColumn("passing", F.col("nameless") + firsts)
    both = F.array(
        F.struct(F.lit(False).alias("copy"), F.col("passing").alias("cell")),
        F.struct(F.lit(True).alias("copy"), (F.col("n") - F.col("passing")).alias("cell")),
    )
    cells = passing.select("part", "fails", *TALLIES[1:], F.explode(both).alias("x")).filter("x.cell > 0")
    return (
        cells.withColumn("fails", F.struct("fails.*", F.col("x.copy").alias(COPY)))
        .groupBy("part", "fails")
        .agg(
            F.sum("x.cell").alias("n"),
            *[F.sum(F.col("x.cell") * F.col(x)).alias(x) for x in TALLIES[1:]],
        )
    )


#: The three ways to reduce an axis.
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def contract(tensor: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Reduce every axis but the first by its vector, for each of many choices of vectors.

    `tensor` has the shape (tallies, 2, 2, ...), `vectors` (choices, filters, 2); the result is
    (choices, tallies).
    """
    filters = tensor.ndim - 1
    axes = list(range(2, 2 + filters))
    operands: list = [tensor, [1, *axes]]
    for i, axis in enumerate(axes):
        operands += [vectors[:, i], [0, axis]]
    return np.einsum(*operands, [0, 1])


def contractions(tensor: np.ndarray, names: Sequence[str]) -> list[dict]:
    """All orders and steps of one part, in the order of permutations."""
    filters = range(len(names))
    orders = list(itertools.permutations(filters))

    def choose(of) -> np.ndarray:
        """The vectors of every order and step, by the place of a filter before, at or after it."""
        return np.array(
            [
                [of(order.index(f) - step) for f in filters]
                for order in orders
                for step in filters
            ]
        )

    removed = contract(tensor, choose(lambda d: PASS if d < 0 else FAIL if d == 0 else ALL))
    kept = contract(tensor, choose(lambda d: PASS if d <= 0 else ALL))
    failing = contract(tensor, choose(lambda d: FAIL if d == 0 else ALL))
    alone = contract(tensor, choose(lambda d: FAIL if d == 0 else PASS))
    filter_of = np.array(orders).ravel()
    total = np.zeros(len(names), dtype=np.int64)
    np.add.at(total, filter_of, removed[:, 0])
    return [
        {
            "filter_order": "".join(names[f] for f in order),
            "step": step + 1,
            "kept": kept[i, 0],
            "removed": removed[i, 0],
            "redundant": failing[i, 0] - removed[i, 0],
            "unique_fails": alone[i, 0],
            "good_lost": removed[i, 1],
            "toxic_lost": removed[i, 2],
            "shapley": total[filter_of[i]],
        }
        for i, (order, step) in enumerate(itertools.product(orders, filters))
    ]


def tensor_of(cells: Sequence[tuple[Mapping[str, bool], Sequence[int]]], names: Sequence[str]) -> np.ndarray:
    """Cells (verdicts, tallies) reshaped to (tallies, 2, 2, ...)."""
    flat = np.zeros((len(TALLIES), 1 << len(names)), dtype=np.int64)
    for fails, tallies in cells:
        place = 0
        for name in names:
            place = 2 * place + bool(fails[name])
        flat[:, place] += np.asarray(tallies, dtype=np.int64)
    return flat.reshape((len(TALLIES), *[2] * len(names)))


def audit(cells: DataFrame) -> DataFrame:
    """Every part, order and step of what `tensors` gives; counts are documents of the part."""
    names = [field.name for field in cells.schema["fails"].dataType.fields]
    # Plain columns: a struct would reach the tasks as one object a row.
    flat = cells.select("part", *[F.col(f"fails.{x}").alias(x) for x in names], *TALLIES)

    def of_part(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.to_dict("records")
        tensor = tensor_of([(r, [r[x] for x in TALLIES]) for r in rows], names)
        found = pd.DataFrame(contractions(tensor, names))
        found.insert(0, "part", rows[0]["part"])
        return found

    return flat.groupBy("part").applyInPandas(of_part, RESULT)
