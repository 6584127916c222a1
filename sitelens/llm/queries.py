"""The operators of this subpackage bound to the driver's tables, with SQL where it can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import (
    bpe,
    brown_lm,
    credentials,
    filter_audit,
    language,
    mixing,
    near_duplicates,
    order_minhash,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    spelling,
)
from sitelens.llm.common import documents, prepare, remainder_is

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The tokenizer files; never copied into the repository.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PACKED_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(spark, folder)

        QUERIES[name] = prepared
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


@query("op1_quality_rules")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Trusted are the documents labelled as good."""
    docs = documents(spark, folder)
    trusted = labels(spark, folder).filter("quality = 1").select(F.col("doc_id").alias("id"))
    return quality_rules.judge(docs, quality_rules.ratios(docs, trusted))


@query("op2_language")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = language.predict(docs, language.fit(docs, held_out=(4, 2)))
    return found.withColumn("held_out", remainder_is(F.col("doc_id"), 4, 2))


@query("op3_pii")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(
        pii.find(documents(spark, folder)),
        pii.BASE_KINDS,
        n_email="email",
        n_ip="ip",
        n_card="card",
        n_phone="phone",
    )


_WORDS_SQL = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_MIXING_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, len({_WORDS_SQL.format("coalesce(text, '')")}) AS n_tokens,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
  FROM documents
), totals AS (
  SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY source
), base AS (
  SELECT CAST(sum(tokens) AS DOUBLE) AS total, min(tokens) AS least, max(tokens) AS most
  FROM totals WHERE tokens > 0
), power AS (
  -- The weights of the largest and the smallest source differ by their ratio to the power a, so
  -- the smallest is repeated ratio ** (1 - a) times as often as the largest: twice at most.
  SELECT total, CASE WHEN most <= 2 * least THEN 0.0 ELSE 1 - ln(2) / ln(most / least) END AS a
  FROM base
), raised AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / total, a) ELSE 0.0 END AS raised
  FROM totals, power
), norm AS (
  SELECT sum(raised) AS z, max(CASE WHEN tokens > 0 THEN tokens / raised END) AS unit FROM raised
), sources AS (
  SELECT source, tokens, raised / z AS weight,
         CASE WHEN tokens > 0 THEN round(raised * unit / tokens, 9) ELSE 1.0 END AS passes,
         CASE WHEN tokens <= 50000 THEN 0 WHEN tokens <= 800000 THEN 1
              WHEN tokens <= 12800000 THEN 2 ELSE 3 END AS digits
  FROM raised, norm
), placed AS (
  SELECT d.*, s.weight, CAST(floor(s.passes) AS BIGINT) AS full_passes,
         CAST(floor((s.passes - floor(s.passes)) * s.tokens) AS BIGINT) AS rest,
         substr(d.hash, 1, s.digits) AS block
  FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), blocks AS (
  SELECT source, block, full_passes, rest, sum(n_tokens) AS tokens
  FROM placed GROUP BY ALL
), turned AS (
  SELECT source, block, tokens, rest - coalesce(sum(tokens) OVER (
           PARTITION BY source
           ORDER BY md5('mix:' || CAST(full_passes AS VARCHAR) || ':' || block), block
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM blocks
), used AS (
  SELECT p.*, t.room, t.tokens AS block_tokens,
         sum(p.n_tokens) OVER (PARTITION BY p.source, p.block ORDER BY p.hash) AS used
  FROM placed p JOIN turned t
    ON p.source IS NOT DISTINCT FROM t.source AND p.block = t.block
), last AS (
  SELECT source, block, max(hash) AS hash FROM used
  WHERE room > 0 AND room < block_tokens AND used <= room GROUP BY source, block
), taken AS (
  SELECT u.*, full_passes + CASE
           WHEN u.room > 0 AND u.room >= u.block_tokens THEN 1
           WHEN u.hash <= l.hash THEN 1 ELSE 0 END AS uses
  FROM used u LEFT JOIN last l
    ON u.source IS NOT DISTINCT FROM l.source AND u.block = l.block
)
SELECT doc_id, source, CAST(unnest(range(uses)) AS BIGINT) AS epoch, block,
       CAST(n_tokens AS BIGINT) AS n_tokens, round(weight, 6) AS weight
FROM taken WHERE uses > 0
"""


@query("op4_mixing", _MIXING_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    slim = mixing.lengths(documents(spark, folder)).checkpoint()
    return mixing.schedule(slim, *mixing.plan(slim))


_NEAR_SQL = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, {_WORDS_SQL.format(
      "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
  )} AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3),
                       lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), shingle AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM sets), pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_
  FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), edges AS MATERIALIZED (
  SELECT p.a, p.b FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b
  WHERE 100 * both_ >= 85 * (len(x.s) + len(y.s) - both_)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), found AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN found ON doc_id = a
"""


@query("op5_near_duplicates", _NEAR_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.find(documents(spark, folder))


@query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = quality_classifier.fit(docs, labels(spark, folder), held_out=(5, 0))
    return quality_classifier.score(docs, model).select(
        "doc_id",
        remainder_is(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op7_order_minhash")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.compare_with_next(documents(spark, folder))


@query("op8_brown_lm")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    settings = brown_lm.Settings()
    known = docs.filter(~remainder_is(F.col("doc_id"), 5, 1)).select("text")
    counts = brown_lm.word_counts(known, settings).checkpoint()
    found = brown_lm.score(docs, counts, brown_lm.fit(known, counts, settings))
    return found.withColumn("held_out", remainder_is(F.col("doc_id"), 5, 1))


@query("op9_credentials")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(
        credentials.find(documents(spark, folder)),
        credentials.BASE_KINDS,
        n_assign="assign",
        n_access="access",
        n_hex="hex",
    )


@query("op10_bpe")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), Path(TOKENIZER).read_text())


_AUDIT_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), least AS (
  SELECT text, min(doc_id) AS least FROM docs GROUP BY text
), words AS (
  SELECT *, {_WORDS_SQL.format("text")} AS w FROM docs
), verdicts AS (
  SELECT part, [
           len(w) < 200,
           100 * len(list_distinct(w)) < 50 * len(w),
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
           regexp_matches(text, '[#$%&*|]'),
           coalesce(doc_id > least, false)] AS fails,
         coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM words JOIN least USING (text) LEFT JOIN labels USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM verdicts GROUP BY ALL
), filters AS (
  SELECT unnest(range(1, 6)) AS i
), orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), judged AS (
  SELECT part, o, s.i AS step, o[s.i] AS filter, fails[o[s.i]] AS failing, n, good, toxic,
         list_contains(list_transform(o[1:s.i - 1], lambda f: fails[f]), true) AS gone,
         len(list_filter(fails, lambda f: f)) AS failed
  FROM cells, orders, filters s
), counted AS (
  SELECT part, o, step, filter,
         coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND failing), 0) AS redundant,
         coalesce(sum(n) FILTER (failing AND failed = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, array_to_string(list_transform(o, lambda f: substr('ABCDE', f, 1)), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""


@query("op11_filter_audit", _AUDIT_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    judged = filter_audit.verdicts(documents(spark, folder), labels(spark, folder))
    return filter_audit.audit(filter_audit.tensors(judged))


@query("op12_packing")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    definition = Path(PACKED_TOKENIZER).read_text()
    pieces = packing.pack(documents(spark, folder), definition, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


_SPELLING_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), found AS (
  SELECT run, CAST(coalesce(doc_id::VARCHAR, '') AS VARCHAR) || ':' || run AS hashed, count(*) AS n
  FROM runs WHERE length(run) >= 5 GROUP BY ALL
), bytes AS (
  -- Letters beyond ASCII are U+00C0 to U+00FF: two bytes, the first of which is 195.
  SELECT run, n, flatten(list_transform(range(1, length(hashed) + 1), lambda i:
           CASE WHEN unicode(substr(hashed, i, 1)) < 128 THEN [unicode(substr(hashed, i, 1))::BIGINT]
                ELSE [195, unicode(substr(hashed, i, 1))::BIGINT - 64] END)) AS b
  FROM found
), hashes AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x:
           xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS h
  FROM bytes, crc_table
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, n
  FROM hashes
), vocabulary AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), shorter AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b
    ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, v.word FROM shorter s JOIN vocabulary v ON s.rest = v.word
  UNION SELECT v.word, s.word FROM shorter s JOIN vocabulary v ON s.rest = v.word
), ranked AS (
  SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place
  FROM near JOIN vocabulary ON other = vocabulary.word
), judged AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN r.n >= 2 * v.n THEN other END AS form, CASE WHEN r.n >= 2 * v.n THEN r.n END AS form_n
  FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND place = 1
), follow AS (
  SELECT word, word AS root FROM judged
  UNION ALL
  SELECT f.word, j.form FROM follow f JOIN judged j ON f.root = j.word WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, f.root, j.n, CAST(j.n_near AS BIGINT) AS n_near, j.form_n
FROM judged j JOIN follow f ON f.word = j.word JOIN judged e ON e.word = f.root
WHERE e.form IS NULL
"""


@query("op13_spelling", _SPELLING_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    settings = spelling.Settings()
    words = spelling.occurrences(
        documents(spark, folder), slip=97, least_length=settings.least_length
    )
    return spelling.variants(spelling.vocabulary(words, settings), settings)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
