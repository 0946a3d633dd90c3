"""Membership in lists that are tables: ``IN`` and ``NOT IN`` with SQL's rules for NULL, without the list in the query text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def in_list(df: DataFrame, col: str, listed: DataFrame, entry: str) -> DataFrame:
    """Rows whose ``col`` is in the column ``entry`` of ``listed``; a NULL is in no list.

    A semi-join: a list within the size limits is broadcast, a longer one is joined by key, and Spark filters the rows before that shuffle with a Bloom
    filter of the list where its thresholds (``spark.sql.optimizer.runtime.bloomFilter``) say that it pays.
    """
    entries = listed.select(F.col(entry).alias("_entry")).filter(F.col("_entry").isNotNull())
    return df.join(entries, F.col(col) == F.col("_entry"), "left_semi")


def not_in_list(df: DataFrame, col: str, listed: DataFrame, entry: str) -> DataFrame:
    """Rows for which ``col NOT IN (list)`` is true.

    An empty list keeps all rows, also those with a NULL. A list that holds a NULL keeps none. Else rows with a NULL go, as do those in the
    list. Both cases are settled by one look at the list, while this is called, so what is left is an anti-join on the key: SQL's own form with
    a subquery must keep NULLs in mind for every row, and runs as a nested loop when the list is too long to broadcast.
    """
    entries = listed.select(F.col(entry).alias("_entry"))
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.count("_entry").alias("n_known")).first()
    if not size.n:
        return df
    if size.n_known < size.n:
        return df.filter(F.lit(False))
    return df.filter(F.col(col).isNotNull()).join(entries, F.col(col) == F.col("_entry"), "left_anti")
