"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillflow.llm import bpe_transducer, line_runs, mixing, quality, simhash
from tillflow.sources.writers import materialise

RANKS = "byte_bpe_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees, learned from the labels that are not held out, accept."""
    trees = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, trees, threshold=0.7)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of 40 and more code points that stand in five and more; n_chars counts what is left."""
    out = line_runs.dedup_lines(docs, least_chars=40, documents=5)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group linked by SimHash."""
    return simhash.keep_one(docs, shingle=4, most_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated as often as it takes them."""
    out = mixing.apply_mix(docs)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, as packed unsigned 32-bit integers, and the hash of the text that they decode to."""
    import public_tokenizers
    ranks = public_tokenizers.path(RANKS)
    out = bpe_transducer.encode_and_decode(docs, ranks)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good), ("lines", drop_lines), ("near copies", drop_near_copies), ("mix", mix_sources), ("encode", encode)]

# SQL has no boosted trees, SimHash or BPE
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
