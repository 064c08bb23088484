"""Cleaning of a training corpus in stages, each written and read again before the next one.

Each stage takes (spark, docs, sf_dir), works on all rows the one before kept, and
returns the columns of `documents` (the last one returns tokens).  The cases that a stage's
operator defines for nulls, empty texts, ties and repeated rows hold here, too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratewell.llm import bpe, decontaminate, lines, near, quality, queries
from ratewell.llm.shared import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; fitted on the labels that are not held out."""
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"), queries.LEAST_QUALITY)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words or more; one of which nothing is left goes."""
    left = lines.deduplicate(docs).where(~((F.size(lines.runs_column(docs)) > 0) & (F.btrim("text", F.lit(" \t\r\n")) == "")))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80% of its five-word shingles."""
    return near.deduplicate(docs, size=5, num=80, den=100)


def unseen_by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any run of ten benchmark words."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, and a digest of what they decode to."""
    keep = ("doc_id", "lang", "source")
    encoded = bpe.encode(docs, *queries.vocabulary(), keep=keep)
    return bpe.decode(encoded, *queries.vocabulary(), keep=(*keep, "n_tokens", "ids")).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_documents), ("line_dedup", first_lines), ("minhash_near_dedup", one_of_each),
    ("benchmark_decontamination", unseen_by_benchmark), ("byte_bpe", tokens),
]

#: Learned scores and byte-pair merges have no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
