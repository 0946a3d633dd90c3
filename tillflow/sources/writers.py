"""Sinks: views, snapshots and numbered export batches."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Replace the temporary view ``name``."""
    df.createOrReplaceTempView(name)
    return df


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder ``spark.checkpoint.dir`` names.

    A session on the local master without one gets a temporary folder, as in a trial run. On a cluster executors do not see each other's
    disks, so a session without the setting is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        # local[...] runs in one process; local-cluster[...] does not
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {context.master})")
        folder = tempfile.mkdtemp(prefix="tillflow-checkpoint-")
    context.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the session's checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: Counter = Counter()
_before: dict = {}


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files behind writes in this session; with several threads the first sets and the last resets."""
    key = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _writing[key]:
            _before[key] = spark.conf.get(_CLEANUP)
            spark.conf.set(_CLEANUP, "true")
        _writing[key] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[key] -= 1
            if not _writing[key]:
                del _writing[key]
                spark.conf.set(_CLEANUP, _before.pop(key))


# what an application has staged and not dropped
_paths: dict[str, list[str]] = {}


def _staged(spark: SparkSession) -> list[str]:
    return _paths.setdefault(spark.sparkContext.applicationId, [])


def drop_all_stages(spark: SparkSession) -> None:
    """Delete everything this application has staged, as a job does when its results are written."""
    while _staged(spark):
        drop_stage(spark, _staged(spark)[-1])


def stage(df: DataFrame) -> str:
    """Write a frame as parquet below the checkpoint folder and return the path.

    The shuffle files behind it go as soon as it is written, since later steps read the parquet.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    _staged(spark).append(path)
    return path


# bytes that the tables of a step may have, by the planner's sizes, to be worked at once; what a step moves between tasks is some times as large
SLICE_BYTES = 384 << 20
# a table whose size the planner can only guess is not read more often
MOST_SLICES = 32


def slices_of(*tables: DataFrame) -> int:
    """In how many slices a step over these tables is worked, so that the shuffle files of one slice at a time are on disk."""
    size = sum(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in tables)
    return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))


def in_slice(k: int, n: int, *by: str | Column) -> Column:
    """Test for the rows of slice ``k`` of ``n``. All rows with equal ``by`` are in one slice, those with nulls too."""
    return F.lit(True) if n == 1 else F.pmod(F.xxhash64(*by), F.lit(n)) == k


def stage_parts(parts: Iterable[DataFrame]) -> str:
    """Write frames of one schema one after the other into one staged folder. The shuffle files behind a part go before the next one begins.

    Packed tighter than other stages, so the file sizes say less of what a table takes in memory: for tables too large to be broadcast.
    """
    path = None
    for df in parts:
        spark = df.sparkSession
        if path is None:
            path = scratch_path(spark, "parts")
            _staged(spark).append(path)
        with _shuffles_dropped(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return path


def materialise_parts(spark: SparkSession, parts: Iterable[DataFrame]) -> DataFrame:
    """:func:`materialise` for the union of ``parts``, worked one at a time."""
    return spark.read.parquet(stage_parts(parts))


def materialise(df: DataFrame) -> DataFrame:
    """Compute a frame once that a job reads several times.

    The staged parquet survives lost executors, is pruned by column like any table, and its file sizes tell the
    planner what may be broadcast.
    """
    return df.sparkSession.read.parquet(stage(df))


def materialise_buckets(df: DataFrame, by: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Compute a frame once and keep it in buckets of ``by``, so that joins, windows and aggregates on ``by`` and more need no shuffle of it.

    The files lie below the checkpoint folder. The catalog knows the table only while it is written and first read.
    """
    spark = df.sparkSession
    path, name = scratch_path(spark, "buckets"), f"tillflow_buckets_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _shuffles_dropped(spark):
        df.write.format("parquet").option("path", path).bucketBy(buckets, *by).saveAsTable(name)
    table = spark.table(name)
    # an external table leaves the catalog, its files stay
    spark.sql(f"drop table {name}")
    _staged(spark).append(path)
    return table


class Stages:
    """Staged tables that one call owns: they are deleted when its ``with`` block ends, whatever ends it.

    What the call returns must be written before the block ends, such as with ``materialise``, or not read these tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        while self.paths:
            drop_stage(self.spark, self.paths.pop())

    def materialise(self, df: DataFrame) -> DataFrame:
        self.paths.append(stage(df))
        return self.spark.read.parquet(self.paths[-1])

    def materialise_parts(self, parts: Iterable[DataFrame]) -> DataFrame:
        self.paths.append(stage_parts(parts))
        return self.spark.read.parquet(self.paths[-1])

    def drop(self, table: DataFrame) -> None:
        """Delete what this call has staged for ``table``, which nothing reads any more."""
        for path in staged_paths(table):
            if path in self.paths:
                self.paths.remove(path)
                drop_stage(self.spark, path)

    def own(self, table: DataFrame) -> DataFrame:
        """Take over a table that another function has just staged."""
        self.paths += [path for path in staged_paths(table) if path not in self.paths]
        return table


def staged_paths(table: DataFrame) -> list[str]:
    """The staged folders of this application that hold the files of ``table``."""
    files = table.inputFiles()
    return [path for path in _staged(table.sparkSession) if any(path.rsplit("/", 1)[1] in file for file in files)]


def is_table(df: DataFrame) -> bool:
    """Whether ``df`` is a table as it lies in its files, so that it can be read several times and staging it would write a copy."""
    return df._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation"


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that no later plan reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _staged(spark):
        _staged(spark).remove(path)


def number_rows(df: DataFrame, order_by: Sequence[str | Column], out: str = "row_index") -> DataFrame:
    """Global 0-based row numbers in ``order_by`` order.

    The rows are range-sorted across all tasks and numbered inside their task; a table with one row per task turns
    that into a global number. The numbered rows are staged in between, so a lost executor cannot renumber them.
    """
    rows = materialise(df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()))
    rows = rows.withColumn("_task", F.shiftright("_id", 33))
    tasks = rows.groupBy("_task").agg(F.min("_id").alias("_base"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    offsets = tasks.select("_task", "_base", before.alias("_before"))
    return (rows.join(offsets, "_task").withColumn(out, F.col("_before") + F.col("_id") - F.col("_base"))
                .drop("_task", "_id", "_base", "_before"))


def number_batches(df: DataFrame, order_by: Sequence[str | Column], size: int, out: str = "batch") -> DataFrame:
    """Batch number (from 1) of every row when the ordered rows are cut into batches of ``size``."""
    return (number_rows(df, order_by, "_row").withColumn(out, (F.floor(F.col("_row") / size) + 1).cast("long"))
            .withColumnRenamed("_row", "row_index"))


def write_batches(df: DataFrame, order_by: Sequence[str | Column], size: int, path: str) -> None:
    """Write ``path/batch=N/*.csv``: one file of ``size`` ordered rows per batch, the last one shorter."""
    (number_batches(df, order_by, size).repartition("batch").sortWithinPartitions("batch", "row_index")
     .drop("row_index").write.mode("overwrite").partitionBy("batch").csv(path, header=True))
