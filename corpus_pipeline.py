"""A corpus pipeline: quality, near duplicates, secrets, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitelens.llm import bpe, credentials, mixing, near_duplicates, quality_classifier
from sitelens.llm.common import documents, prepare, remove, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts. Rows keep all columns; a null text is
    scored as an empty one."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.accepted(docs, quality_classifier.fit(docs, labels))


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest id."""
    prepare(spark)
    return near_duplicates.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    prepare(spark)
    return credentials.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights use them: each at least once, none more than
    the repetition limit allows."""
    prepare(spark)
    slim = mixing.lengths(docs).checkpoint()
    return mixing.mixed(docs, *mixing.plan(slim))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text they decode to."""
    prepare(spark)
    definition = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    return bpe.digests(docs, definition)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("near_duplicates", duplicates),
    ("secret_scan", secrets),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: SQL can express neither a trained classifier nor BPE; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder.

    What lies between stages is written to the shared folder of the session, so a lost executor
    repeats at most its own stage. Of these tables only the last one stays: what a stage has read is
    removed once its own result is written.
    """
    prepare(spark)
    folder = f"{shared_folder(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    docs, before = documents(spark, sf_dir), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
