"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, secrets, tokens.

Each stage takes the documents that the one before kept, written as Parquet, and returns the
columns of documents, but for the last, which returns the tokens of each and the text decoded from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sangam.llm import bpe, decontamination, minhash, quality_rules as rules, secrets
from sangam.llm.common import Scratch, table

#: Words in a shingle, and the least similarity in percent, of near-duplicates and benchmark passages.
SHINGLE, PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.quality_rules(docs).filter("quality.kept").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates.

    Of rows with equal doc_id the one whose text, then language and source, come first
    stays. Rows without doc_id can't be named by a group and stay.
    """
    kept = minhash.near_duplicates(docs, SHINGLE, PERCENT).filter("kept and doc_id is not null").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy("text", "lang", "source")
    named = docs.join(kept, "doc_id", "left_semi").withColumn("__place", F.row_number().over(first))
    return named.filter("__place = 1").select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), SHINGLE, PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and tokens of every document, and the text that they are decoded to."""
    encoded = bpe.bpe_round_trip(docs)
    return encoded.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "tokens", "text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_quality),
    ("near-duplicates", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", redact_secrets),
    ("byte-pair encoding and decoding", encode_tokens),
]

#: Near-duplicates need components and tokens need the merge list: no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{place}")
        if place:
            scratch.drop(f"stage-{place - 1}")
    return docs
