"""Readers: parquet tables, CSV exports, saved snapshots and query text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .views import read_query_file


class Tables(Mapping[str, DataFrame]):
    """Named tables, read on first use from ``root/<name>`` or ``root/<name>.parquet``."""

    def __init__(self, spark: SparkSession, root: str, names: list[str], suffix: str = ".parquet"):
        self._spark, self._root, self._names, self._suffix = spark, root.rstrip("/"), names, suffix
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = self._spark.read.parquet(f"{self._root}/{name}{self._suffix}")
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """CSV with a header row and a declared schema (nothing is inferred)."""
    return spark.read.csv(path, schema=schema, header=True, **options)


def read_sheet_range(spark: SparkSession, path: str, schema: StructType | str, required: str) -> DataFrame:
    """Spreadsheet export: title rows above and blank rows below the data have no ``required`` value.

    A data row whose ``required`` cell does not fit its type is taken for one of those; where that matters, name the range of cells (``sheets.read_sheet``).
    """
    return read_csv(spark, path, schema, mode="PERMISSIVE").filter(F.col(required).isNotNull())


def run_query_file(spark: SparkSession, path: str, args: Mapping[str, object] | None = None,
                   **tables: DataFrame) -> DataFrame:
    """Run the Spark SQL text of a file in any storage that Spark reads. ``{name}`` markers become the given frames, ``:name`` markers arguments."""
    return spark.sql(read_query_file(spark, path), args=dict(args or {}) or None, **tables)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
