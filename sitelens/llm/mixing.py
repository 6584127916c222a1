"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Weights are source token shares raised to an exponent between 0 (all sources alike) and 1 (as they
are), and normalised. The exponent is the smallest one at which the entropy of the weights is at
most a target, or at which no source is repeated more often than a limit, or both; it is found by
bisection. The budget is given in tokens; without one it is the least with which every document is
used at least once.

A source's share of the budget is so many whole passes over its documents and a part of one. Its
documents lie in up to 16 ** 3 blocks, by leading hexadecimal digits of a hash of the id. In every
pass the blocks come in another order, a hash of pass and block. The part of a pass takes whole
blocks in that order while they fit, and of the block that no longer fits the documents, in the
order of their hashes, while these fit. So what is taken needs sums over blocks, and an order of
documents only within one block of a source.

All of it is built-in functions. Texts are read once for their length; the rest works on ids.

Cases: a null source is a source of its own; a null id counts as an empty one; a null or empty text
has no tokens and is taken with its block; a source without any token has weight 0 and its
documents are taken once; equal rows are taken or left together; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import BROADCAST_BYTES, unused, words_of

REPETITION_LIMIT = 2.0
BLOCK_TOKENS = 50_000
SEED = "mix"
#: Exponents tried in one job: four halvings of the interval at a time.
_STEPS = 16


def lengths(docs: DataFrame, *, id: str = "doc_id", source: str = "source", text: str = "text"):
    """What mixing needs of the documents: doc_id, source, n_tokens and hash."""
    key = F.coalesce(F.col(id).cast("string"), F.lit(""))
    return docs.select(
        F.col(id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(words_of(F.col(text))).cast("long").alias("n_tokens"),
        hash_of(key).alias("hash"),
    )


def hash_of(key: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), key))


def exponent(
    totals: DataFrame,
    *,
    repetition_limit: float | None = REPETITION_LIMIT,
    entropy: float | None = None,
    budget: float | None = None,
    rounds: int = 13,
) -> float:
    """The smallest exponent that keeps to the limits, by bisection over aggregates of the totals.

    `totals` has a column `tokens`, one row per source. Every job evaluates sixteen exponents of
    the interval that is left, so what reaches the driver are a few numbers. With neither limit
    it is 0. With an entropy above that of equal weights, or a limit that equal weights keep, also.
    """
    positive = totals.filter("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    base = positive.agg(F.sum("t"), F.min("t"), F.max("t")).first()
    if base[0] is None:
        return 1.0
    total, least, most = base
    shares = positive.select((F.col("t") / total).alias("p")).checkpoint()

    def fits(values: list[float]) -> list[bool]:
        columns = []
        for i, a in enumerate(values):
            columns.append(F.sum(F.pow("p", F.lit(a))).alias(f"z{i}"))
            columns.append(F.sum(F.pow("p", F.lit(a)) * a * F.ln("p")).alias(f"e{i}"))
        row = shares.agg(*columns).first()
        good = []
        for i, a in enumerate(values):
            z = row[f"z{i}"]
            # The smallest source is the one that is repeated most.
            if budget is None:
                repeated = (least / most) ** (a - 1)
            else:
                repeated = budget * (least / total) ** a / z / least
            nats = math.log(z) - row[f"e{i}"] / z
            good.append(
                (repetition_limit is None or repeated <= repetition_limit)
                and (entropy is None or nats <= entropy)
            )
        return good

    low, high = 0.0, 1.0
    if fits([0.0])[0]:
        return 0.0
    for _ in range(rounds):
        values = [low + (high - low) * i / _STEPS for i in range(1, _STEPS)]
        good = fits(values)
        first = next((i for i, g in enumerate(good) if g), _STEPS - 1)
        low, high = ([low, *values])[first], ([*values, high])[first]
    return high


def plan(
    slim: DataFrame,
    *,
    repetition_limit: float | None = REPETITION_LIMIT,
    entropy: float | None = None,
    budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """Per source its weight and passes, and per block what of it the last pass takes.

    `slim` is what `lengths` gives, best as a checkpoint. Sources: source, weight, passes (double),
    full (whole passes), digits (of the hash that name a block). Blocks: source, block, before
    (tokens of the blocks that come earlier in the last pass), upto (the last hash taken: null
    for none, '~' for all).
    """
    totals = slim.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).checkpoint()
    a = exponent(
        totals, repetition_limit=repetition_limit, entropy=entropy, budget=budget
    )
    total = float(totals.agg(F.sum("tokens")).first()[0] or 1)
    raised = F.pow(F.col("tokens") / total, F.lit(a))
    scaled = totals.withColumn("raised", F.when(F.col("tokens") > 0, raised).otherwise(0.0))
    z = scaled.agg(
        F.sum("raised"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("raised")))
    ).first()
    # Without a budget the source that is used least, against its size, is used just once.
    norm, cover = (z[0] or 1.0), (z[1] or 0.0)
    unit = cover if budget is None else budget / norm
    sources = scaled.select(
        "source",
        "tokens",
        (F.col("raised") / norm).alias("weight"),
        F.when(F.col("tokens") > 0, F.round(F.col("raised") * unit / F.col("tokens"), 9))
        .otherwise(1.0)
        .alias("passes"),
        F.when(F.col("tokens") <= block_tokens, 0)
        .when(F.col("tokens") <= block_tokens * 16, 1)
        .when(F.col("tokens") <= block_tokens * 256, 2)
        .otherwise(3)
        .alias("digits"),
    ).withColumn("full", F.floor("passes").cast("long"))
    # Tokens of the last, partial pass.
    sources = sources.withColumn(
        "rest", F.floor((F.col("passes") - F.col("full")) * F.col("tokens")).cast("long")
    ).checkpoint()
    placed = _placed(slim, sources).select(
        "source", "block", "n_tokens", "hash", "full", "rest"
    )
    blocks = placed.groupBy("source", "block", "full", "rest").agg(F.sum("n_tokens").alias("tokens"))
    # At most 16 ** 3 rows of a source.
    turn = Window.partitionBy("source").orderBy("turn", "block")
    ordered = blocks.withColumn("turn", order_of(F.col("full"), F.col("block"))).withColumn(
        "before", F.sum("tokens").over(turn.rowsBetween(Window.unboundedPreceding, -1))
    )
    ordered = ordered.withColumn("before", F.coalesce("before", F.lit(0)))
    ordered = ordered.select(
        "source", "block", "before", "tokens", (F.col("rest") - F.col("before")).alias("room")
    ).checkpoint()
    cut = ordered.filter("room > 0 AND room < tokens").select("source", "block", "room")
    inner = Window.partitionBy("source", "block").orderBy("hash")
    taken = (
        _null_safe(placed.select("source", "block", "hash", "n_tokens"), _small(cut), "block")
        .withColumn("used", F.sum("n_tokens").over(inner))
        .filter("used <= room")
        .groupBy("source", "block")
        .agg(F.max("hash").alias("last"))
    )
    limits = _null_safe(ordered, taken, "block", how="left").select(
        "source",
        "block",
        "before",
        F.when((F.col("room") > 0) & (F.col("room") >= F.col("tokens")), F.lit("~"))
        .otherwise(F.col("last"))
        .alias("upto"),
    )
    return sources, limits.checkpoint()


def order_of(epoch: Column, block: Column) -> Column:
    """What the blocks of a pass are sorted by."""
    return F.md5(F.concat(F.lit(SEED + ":"), epoch.cast("string"), F.lit(":"), block))


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() * 64 <= BROADCAST_BYTES else rows


def _null_safe(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on source, where null equals null, and on further columns."""
    other = right.select(
        [F.col(c).alias(f"other_{c}" if c in ("source", *names) else c) for c in right.columns]
    )
    on = left["source"].eqNullSafe(other["other_source"])
    for name in names:
        on &= left[name] == other[f"other_{name}"]
    return left.join(other, on, how).drop("other_source", *[f"other_{n}" for n in names])


def _placed(slim: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with their source's numbers and their block."""
    numbers = sources.select("source", "weight", "passes", "full", "rest", "digits", F.col("tokens").alias("source_tokens"))
    joined = _null_safe(slim, _small(numbers))
    return joined.withColumn("block", F.substring("hash", F.lit(1), F.col("digits")))


def schedule(slim: DataFrame, sources: DataFrame, limits: DataFrame) -> DataFrame:
    """Every use of a document: doc_id, source, epoch, block, n_tokens, weight.

    The order of a mixed stream is by epoch and `order_of` within a source; blocks of different
    sources are independent.
    """
    placed = _null_safe(_placed(slim, sources), _small(limits), "block")
    uses = F.col("full") + F.when(F.col("hash") <= F.col("upto"), 1).otherwise(0)
    return placed.select(
        "doc_id",
        "source",
        F.explode(F.when(uses > 0, F.sequence(F.lit(0).cast("long"), uses - 1))).alias("epoch"),
        "block",
        "n_tokens",
        F.round("weight", 6).alias("weight"),
    )


def mixed(
    docs: DataFrame,
    sources: DataFrame,
    limits: DataFrame,
    *,
    id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """The documents themselves, with all their columns, each as often as it is used.

    Decisions reach the documents by source and block only; both sides are few rows, so the texts
    stay where they are unless there are too many sources to broadcast.
    """
    names = {c: unused(docs.columns, f"mix_{c}") for c in ("source", "hash", "block", "uses")}
    own = list(docs.columns)
    numbers = sources.select(
        F.col("source").alias(names["source"]),
        F.struct("full", "digits").alias(names["uses"]),
    )
    key = F.coalesce(F.col(id).cast("string"), F.lit(""))
    rows = docs.withColumn(names["hash"], hash_of(key))
    on = F.col(source).cast("string").eqNullSafe(F.col(names["source"]))
    rows = rows.join(_small(numbers), on).drop(names["source"])
    rows = rows.withColumn(
        names["block"], F.substring(names["hash"], F.lit(1), F.col(names["uses"])["digits"])
    )
    ends = limits.select(
        F.col("source").alias(names["source"]),
        F.struct("block", "upto").alias(unused(own, "mix_end")),
    )
    end = unused(own, "mix_end")
    on = F.col(source).cast("string").eqNullSafe(F.col(names["source"])) & (
        F.col(names["block"]) == F.col(end)["block"]
    )
    rows = rows.join(_small(ends), on)
    uses = F.col(names["uses"])["full"] + F.when(
        F.col(names["hash"]) <= F.col(end)["upto"], 1
    ).otherwise(0)
    return rows.withColumn(names["uses"], F.explode(F.array_repeat(F.lit(0), uses.cast("int")))).select(
        [F.col(f"`{c}`") for c in own]
    )
