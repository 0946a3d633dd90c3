"""Scoring that can be stopped and taken up again: results are logged by row, and only rows without a result are scored."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..sources.writers import Stages
from .scoring import score_rows

_OWN = ("payload_hash", "error", "final", "attempt")


def payload_hash(payload: Sequence[str]) -> Column:
    """A text that differs between payloads; a row whose payload changes is scored again."""
    return F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256)


class ScoreLog:
    """Results of a scoring function, appended batch by batch below ``path``: id, payload_hash, the function's columns, error, final, attempt.

    A row is done when it has a result, when its input is missing, or after ``max_tries`` failures.
    """

    def __init__(self, spark: SparkSession, path: str, id_field: StructField, schema: StructType, max_tries: int = 3):
        clash = {id_field.name, *schema.names} & set(_OWN)
        if clash or id_field.name in schema.names:
            raise ValueError(f"the log has columns of its own with these names: {sorted(clash or {id_field.name})}")
        self.spark, self.path, self.id_col, self.schema, self.max_tries = spark, path, id_field.name, schema, max_tries
        self.fields = StructType([StructField(id_field.name, id_field.dataType), StructField("payload_hash", StringType()), *schema.fields,
                                  StructField("error", StringType()), StructField("final", BooleanType()), StructField("attempt", IntegerType())])
        # an append of nothing makes the folder, so that a new log can be read
        spark.createDataFrame([], self.fields).write.mode("append").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.fields).parquet(self.path)

    def tries(self) -> DataFrame:
        """(id, payload_hash, tried, done) of all rows that were tried."""
        tried = self.read().groupBy(self.id_col, "payload_hash").agg(F.max("attempt").alias("tried"), F.bool_or("final").alias("final"))
        return tried.select(self.id_col, "payload_hash", "tried", (F.col("final") | (F.col("tried") >= self.max_tries)).alias("done"))

    def latest(self) -> DataFrame:
        """One row per id and payload: its last attempt."""
        columns = [c for c in self.fields.names if c not in (self.id_col, "payload_hash")]
        last = self.read().groupBy(self.id_col, "payload_hash").agg(F.max_by(F.struct(*columns), "attempt").alias("_last"))
        return last.select(self.id_col, "payload_hash", *[F.col("_last")[c].alias(c) for c in columns])


def pending_rows(df: DataFrame, log: ScoreLog, payload: Sequence[str]) -> DataFrame:
    """(id, payload, payload_hash, attempt) of the rows to score: each id once, with its smallest payload, numbered by the try that comes next."""
    rows = df.select(log.id_col, *payload).filter(F.col(log.id_col).isNotNull())
    rows = rows.groupBy(log.id_col).agg(F.min(F.struct(*payload)).alias("_p")).select(log.id_col, *[F.col("_p")[c].alias(c) for c in payload])
    rows = rows.withColumn("payload_hash", payload_hash(payload))
    rows = rows.join(log.tries(), [log.id_col, "payload_hash"], "left").filter(~F.coalesce("done", F.lit(False)))
    return rows.select(log.id_col, *payload, "payload_hash", (F.coalesce("tried", F.lit(0)) + 1).alias("attempt"))


def score_pending(df: DataFrame, log: ScoreLog, payload: Sequence[str], required: str, fn: Callable[[pd.DataFrame], pd.DataFrame], batch_rows: int = 100_000,
                  max_batches: int | None = None, missing_error: str = "missing input") -> int:
    """Score the rows of ``df`` without a result in batches of about ``batch_rows``, one commit to the log each; returns how many batches ran.

    Stopped at any moment and called again, it goes on with the rows that the log lacks: a row with a result is not scored a second time, only
    those of the batch that was running. Rows that failed are tried again after all others, up to the log's ``max_tries``. ``max_batches`` ends a call
    early, as for a time slot. Batches are cut by a hash of the id, so none needs the order of all rows. Rows with a null id are left out.
    """
    ran = 0
    while max_batches is None or ran < max_batches:
        with Stages(df.sparkSession) as stages:
            pending = stages.materialise(pending_rows(df, log, payload))
            count = pending.count()
            if not count:
                return ran
            parts = -(-count // batch_rows)
            for part in range(parts):
                if max_batches is not None and ran >= max_batches:
                    return ran
                batch = pending.filter(F.pmod(F.xxhash64(log.id_col), F.lit(parts)) == part)
                kept = [*payload, "payload_hash", "attempt"]
                scored = score_rows(batch, log.id_col, kept, required, fn, log.schema, missing_error, unique=True)
                final = F.col("error").isNull() | F.col(required).isNull() | (F.col(required).cast("string") == "")
                scored.withColumn("final", final).select(*log.fields.names).write.mode("append").parquet(log.path)
                ran += 1
    return ran


def scored(df: DataFrame, log: ScoreLog, payload: Sequence[str]) -> DataFrame:
    """``df`` with the function's columns, ``error`` and ``attempt`` of each row's last try; nulls where it was not tried."""
    found = log.latest().drop("final")
    return df.withColumn("payload_hash", payload_hash(payload)).join(found, [log.id_col, "payload_hash"], "left").drop("payload_hash")
