"""Partitioned tables that are refreshed partition by partition, with one switch from the old state to the new."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_NONE = "__none__"


class PartitionedTable:
    """A table kept as parquet in partitions of ``by`` below ``path``, of which a refresh replaces some.

    ``data/run=<id>/...`` holds the files of one refresh, ``states/<n>`` the list of partitions with the run that holds each. A refresh writes its files, then the
    next list under another name, and renames that: readers see the whole old or the whole new state, a refresh that fails
    changes nothing, and files of untouched partitions stay as they are. Two refreshes at once: the second to finish fails. The list has one row per partition
    and goes through the driver. Partition columns are texts, numbers or dates.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str]):
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, list(by)
        self.listed = StructType([*[schema[c] for c in self.by]]).add("run", "string")
        jvm = spark.sparkContext._jvm
        self._file = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._file(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the newest state; -1 for a table without one."""
        folder = self._file(f"{self.path}/states")
        if not self._fs.exists(folder):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=-1)

    def partitions(self, version: int | None = None) -> DataFrame:
        """(by, run): what the table consists of, also at an earlier version that is still kept."""
        version = self.version() if version is None else version
        if version < 0:
            return self.spark.createDataFrame([], self.listed)
        return self.spark.read.schema(self.listed).parquet(f"{self.path}/states/{version}")

    def read(self, version: int | None = None) -> DataFrame:
        listed = self.partitions(version)
        runs = [r.run for r in listed.select("run").distinct().collect()]
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        # a run holds only what one refresh wrote; of it only the partitions count that no later refresh replaced
        stored = self.spark.read.option("basePath", f"{self.path}/data").schema(self._stored()).parquet(*[f"{self.path}/data/run={r}" for r in runs])
        # the list is as small as the table has partitions; with it the scan is pruned to their folders
        marks = listed.select(F.col("run").alias("_run"), *[self._text(c).alias(f"_p_{c}") for c in self.by])
        same = [F.col("run") == F.col("_run"), *[F.col(f"p_{c}") == F.col(f"_p_{c}") for c in self.by]]
        return stored.join(marks, reduce(lambda a, b: a & b, same), "left_semi").select(*self.schema.names)

    def _text(self, col: str):
        # the folder's name: null and empty are told apart, and no type is guessed from it
        return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(_NONE))

    def _stored(self) -> StructType:
        out = StructType(list(self.schema.fields)).add("run", "string")
        for c in self.by:
            out = out.add(f"p_{c}", "string")
        return out

    def replace(self, rows: DataFrame, touched: DataFrame | None = None) -> int:
        """Make ``rows`` the whole content of the ``touched`` partitions, or of the table; returns the new version.

        A touched partition without a row is gone. Rows outside of the touched partitions are an error.
        """
        base, run = self.version(), uuid.uuid4().hex
        marked = rows.select(*self.schema.names).withColumns({f"p_{c}": self._text(c) for c in self.by})
        folder = f"{self.path}/data/run={run}"
        marked.repartition(*[f"p_{c}" for c in self.by]).write.partitionBy(*[f"p_{c}" for c in self.by]).parquet(folder)
        written = self.spark.read.schema(StructType(self._stored().fields[:len(self.schema)] + self._stored().fields[len(self.schema) + 1:])).parquet(folder)
        new = written.select(*self.by).distinct().withColumn("run", F.lit(run))
        if touched is None:
            listed = new
        else:
            given = touched.select(*[F.col(c).alias(f"_t_{c}") for c in self.by]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in self.by])
            outside = new.join(given, same, "left_anti").first()
            if outside is not None:
                self._fs.delete(self._file(folder), True)
                raise ValueError(f"rows outside of the touched partitions, such as {outside.asDict()}")
            listed = self.partitions(base).join(given, same, "left_anti").unionByName(new)
        pending = f"{self.path}/states/_pending-{run}"
        listed.coalesce(1).write.parquet(pending)
        target = self._file(f"{self.path}/states/{base + 1}")
        if self._fs.exists(target) or not self._fs.rename(self._file(pending), target):
            self._fs.delete(self._file(pending), True)
            raise RuntimeError(f"another refresh of {self.path} was faster")
        return base + 1

    def roll(self, rows: DataFrame, first, changed_since=None) -> int:
        """Make the table a rolling extract: the days of ``rows`` from ``first`` on. The table is kept by one date column.

        Partitions before ``first`` go. Days that the table lacks are written, and with ``changed_since`` those from that day on are written anew; all other
        partitions stay as they are, without being read. Returns the new version.
        """
        if len(self.by) != 1:
            raise ValueError(f"a rolling extract is kept by one day, not by {self.by}")
        day = self.by[0]
        stored = self.partitions().select(day).distinct()
        within = rows.filter(F.col(day) >= F.lit(first).cast("date"))
        expired = stored.filter(F.col(day) < F.lit(first).cast("date"))
        old = stored.filter(F.col(day) < F.lit(changed_since).cast("date")) if changed_since is not None else stored
        # the list of partitions is small, so this is a filter on days that reaches the scan of rows
        fresh = within.join(old, day, "left_anti")
        again = stored.join(old, day, "left_anti")
        touched = expired.unionByName(again).unionByName(fresh.select(day)).distinct()
        return self.replace(fresh, touched)

    def vacuum(self, versions: int = 1) -> None:
        """Delete what the last ``versions`` states do not hold: runs without a partition in them, and older lists."""
        newest = self.version()
        kept = range(max(0, newest - versions + 1), newest + 1)
        runs = {r.run for v in kept for r in self.partitions(v).select("run").distinct().collect()}
        for folder, keep in (("data", {f"run={r}" for r in runs}), ("states", {str(v) for v in kept})):
            for status in self._fs.listStatus(self._file(f"{self.path}/{folder}")):
                if status.getPath().getName() not in keep:
                    self._fs.delete(status.getPath(), True)
