"""Quality rules: simple counts, and a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials
over the buckets are counted: one over trusted texts, one over the raw corpus. A text's score is the
sum of the log ratios of both probabilities over its n-grams, divided by their number, and it is
kept if the score reaches a threshold. Nothing is drawn at random.

All of it is built-in functions: the corpus counts are one aggregation over the buckets, and the
ratios come back as one array of fixed size, so texts are neither joined nor shuffled. Only when the
trusted ids are too many to be broadcast are texts shuffled to meet them.

Cases: a null or empty text has counts of 0, score 0 and fails the base rules; equal rows give
equal results and each counts in the corpus; with no trusted text all ratios shift alike and the
verdict follows the raw corpus; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import SPACE_CLASS, join_checked, words_of

#: Buckets of the hashed n-grams: the size of everything that is collected from the corpus.
BUCKETS = 1 << 16
#: Least score of a kept text.
THRESHOLD = -0.25
#: Symbols that are counted.
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, function) -> Column:
    """Apply a function to a value that is computed once per row."""
    return F.transform(F.array(value), function)[0]


def ngrams(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of every word and of every pair of neighbouring words."""
    bucket = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    single = F.transform(words, lambda w: bucket(F.xxhash64(w)))
    pair = F.transform(words, lambda w, i: bucket(F.xxhash64(w, F.get(words, i + 1))))
    return F.concat(single, F.slice(pair, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words that the text holds twice or more.

    Windows are hashed; only if some are equal are they sorted with their places to see which.
    The places covered by windows of length three that start at sorted places are the sum of the
    gaps between neighbouring places, each at most three.
    """
    windows = F.slice(
        F.transform(
            words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
        ),
        1,
        F.greatest(F.size(words) - 2, F.lit(0)),
    )

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def twice(ordered: Column) -> Column:
        same = lambda w, i: F.coalesce(w["h"] == F.get(ordered, i)["h"], F.lit(False))
        return F.filter(ordered, lambda w, i: same(w, i - 1) | same(w, i + 1))

    def count(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        places = let(F.sort_array(placed), lambda o: F.transform(twice(o), lambda w: w["i"]))
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            let(F.sort_array(places), covered),
        ).otherwise(0)

    return let(windows, count).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def ratios(
    docs: DataFrame,
    trusted_ids: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row with the array of log ratios: trusted over raw, with one added to every count.

    `trusted_ids` has a column `id`; an id that occurs several times counts once.
    """
    trusted = trusted_ids.select(F.col("id").cast("long").alias("id")).distinct()
    trusted = trusted.withColumn("trusted", F.lit(1))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = join_checked(rows, trusted, ["id"], "left", 16)
    words = rows.select("trusted", words_of(F.col("text")).alias("words"))
    counts = (
        words.select("trusted", F.explode(ngrams(F.col("words"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("trusted").alias("good"))
    )
    # The sums are few numbers, the array one row: both are bounded by the number of buckets.
    every = counts.agg(
        F.sum("raw").alias("raws"),
        F.sum("good").alias("goods"),
        F.map_from_entries(
            F.collect_list(F.struct("bucket", F.struct("raw", "good").alias("n")))
        ).alias("counts"),
    )
    share = lambda n, all_: (F.coalesce(n, F.lit(0)) + 1.0) / (F.coalesce(all_, F.lit(0)) + buckets)
    ratio = lambda n: F.log(
        share(n["good"], F.col("goods")) / share(n["raw"], F.col("raws"))
    )
    none = F.struct(F.lit(0).cast("long").alias("raw"), F.lit(0).cast("long").alias("good"))
    filled = F.array_sort(
        F.concat(
            F.transform(F.map_entries("counts"), lambda e: F.struct(e["key"].alias("b"), e["value"].alias("n"))),
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.lit(buckets - 1)), F.map_keys("counts")),
                lambda b: F.struct(b.alias("b"), none.alias("n")),
            ),
        )
    )
    return every.select(F.transform(filled, lambda e: ratio(e["n"])).alias("ratios"))


def judge(
    docs: DataFrame,
    ratios: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, score and kept."""
    chosen = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    words = chosen.withColumns(
        {"words": words_of(F.col("text")), "ratios": ratios.scalar()}
    )
    hashed = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        ngrams(F.col("words"), buckets).alias("grams"),
        "ratios",
    )
    total = F.aggregate(
        "grams", F.lit(0.0), lambda all_, g: all_ + F.get(F.col("ratios"), g)
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        hashed.withColumn("score", total / F.greatest(F.size("grams"), F.lit(1)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .drop("grams", "ratios")
    )
