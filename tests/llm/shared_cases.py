"""Tables that the tests of the training-data operators share."""

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def real(spark):
    """The whole smallest table of documents, as rows ordered by doc_id."""
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]) as a table of documents with more columns whose names operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    clashing = ("row", "id", "n", "key", "size", "words", "h", "file", "tail", "part", "bucket", "score", "ids", "fingerprint", "shard", "lines",
                "_id", "_version", "_gone", "_factors", "_h1", "_h2", "_rest", "_source", "_v", "_taken", "_size", "_part", "_n_lines", "_n_dropped",
                "_n_words", "_n_removed", "h1", "h2", "word", "rank", "sequence_id", "start", "length", "offset", "_item", "_quality", "print", "label", "first", "begin", "hash",
                "_in", "_before", "_p1", "_p2", "_upto", "plan", "target", "taken")
    return df.selectExpr("*", *[f"'x' as {c}" for c in clashing])


# nulls in every column, empty and white texts, ties, repeated rows, special strings, code points of one to four bytes, a very long text
EDGES = [(5, None), (None, "a row without an id"), (3, ""), (4, " \n\t   "), (7, "same text here"), (8, "same text here"), (8, "same text here"),
         (1, "x<|endoftext|> y <|endoftext|>"), (2, "café 日本語 \U0001f642\U0001f642 don't  stop\r\n\r\nnow "), (9, "word " * 30_000),
         (-4, "negative id", None, None), (10, "q" * 5_000)]
