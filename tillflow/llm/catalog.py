"""The registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe_transducer, lexical, line_runs, mixing, orc_ids, packing, prefix_hash, quality, rlz, simhash, spelling, sphere_filters, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_simhash_pivots")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, most_bits=4)


@query("op2_mix_sources", mixing.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_prefix_hashes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.edited_neighbours(_table(spark, sf_dir, "documents"))


@query("op4_line_runs", line_runs.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_lines(_table(spark, sf_dir, "documents"), least_chars=40, documents=5)
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_rlz_spans")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz.remove_repeats(_table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op6_orc_token_ids")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_ids.token_id_files(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=2)


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op8_bpe_transducer")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _tokenizer("byte_bpe_50k.tiktoken")
    decoded = bpe_transducer.decode(bpe_transducer.encode(_table(spark, sf_dir, "documents"), ranks), ranks)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query("op9_quality_trees")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op10_sphere_filters")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sphere_filters.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


@query("op11_best_fit_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1, room=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(_table(spark, sf_dir, "documents"), least_chars=6, least_count=5, every=199)
    return spelling.group_variants(words, ratio=5)


@query("op13_pair_maxscore", lexical.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)
