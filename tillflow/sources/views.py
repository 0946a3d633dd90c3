"""Views that outlive a session, defined by query files in shared storage."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

_NAME = re.compile(r"[a-z_][a-z0-9_]*")


def read_query_file(spark: SparkSession, path: str) -> str:
    """The text of a file on any file system that Spark reads."""
    rows = spark.read.text(path, wholetext=True).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} is no single query file")
    return rows[0].value


def query_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and text of every ``<name>.sql`` below a folder, by name."""
    files = spark.read.text(f"{folder.rstrip('/')}/*.sql", wholetext=True)
    found = files.select(F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.sql$", 1).alias("name"), "value").collect()
    queries = {r.name: r.value.strip().rstrip(";") for r in found}
    for name in queries:
        if not _NAME.fullmatch(name):
            raise ValueError(f"no name for a view: {name!r}")
    return dict(sorted(queries.items()))


def in_order(queries: Mapping[str, str]) -> list[str]:
    """The names such that a query comes after those whose names it mentions; a circle is an error."""
    mentioned = {name: {m for m in _NAME.findall(text.lower()) if m in queries and m != name} for name, text in queries.items()}
    order: list[str] = []
    while len(order) < len(queries):
        ready = sorted(n for n, needs in mentioned.items() if n not in order and needs <= set(order))
        if not ready:
            raise ValueError(f"views refer to one another in a circle: {sorted(set(queries) - set(order))}")
        order += ready
    return order


def create_views(spark: SparkSession, queries: Mapping[str, str], database: str = "default") -> list[str]:
    """Create or replace a view in the catalog for every query, in the order in which they need one another; returns that order.

    The catalog keeps the texts: every session of the application sees the views, and with a metastore every later application. A query sees the tables of the
    catalog, no temporary view of this session, and names another view of the set by its plain name. If one fails, those that it
    needs are created and those that need it stay as they were.
    """
    order = in_order(queries)
    for name in order:
        spark.sql(f"create or replace view {database}.{name} as {queries[name]}")
    return order


def create_views_from(spark: SparkSession, folder: str, database: str = "default") -> list[str]:
    return create_views(spark, query_files(spark, folder), database)


def read_view(spark: SparkSession, name: str, database: str = "default") -> DataFrame:
    return spark.table(f"{database}.{name}")
