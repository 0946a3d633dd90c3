"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings: UTC dates, AQE re-planning with skew splitting also where the split costs one more
# shuffle, and size-checked automatic broadcasts only. A broadcast table is built on the driver, many at once in a large
# plan: by file sizes, which in memory become twenty times as much and more, only very small ones; by measured sizes 8 MB.
# lower() and upper() by the JVM's tables: those of ICU are built by the first call in a process, the planner's own calls on constants
# included, as 2.5 GB of garbage in a second, and the heap that a driver grows to for it stays as large.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(1 << 20),
    "spark.sql.icu.caseMappings.enabled": "false",
}


_TUNED: dict[str, SparkSession] = {}


def tuned(spark: SparkSession) -> SparkSession:
    """A session of the same application with the runtime settings; the caller's own session stays as it is."""
    application = spark.sparkContext.applicationId
    if application not in _TUNED:
        session = spark.newSession()
        for key, value in SQL_SETTINGS.items():
            session.conf.set(key, value)
        _TUNED[application] = session
    return _TUNED[application]


def build_session(app: str = "tillflow", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Build a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
