"""Connected components by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.writers import drop_stage, stage


def components(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """Per node of ``edges`` (a, b: long): ``node`` and ``label``, the same for all nodes of a component.

    In a round every node goes to the smallest of itself and its neighbours, and from there ``jumps`` times twice as far; the edges are rewritten
    between the nodes reached and those within one node are dropped. Each node with an edge left loses or becomes a neighbour, so the rounds are
    about the logarithm of the longest chain. A round is three tables in the shared folder, whose true sizes decide the joins; a node
    with very many edges is one key of joins that can be split and of aggregates that combine before the shuffle.
    Rows with a null end are ignored.
    """
    spark = edges.sparkSession

    def read(path: str) -> DataFrame:
        return spark.read.parquet(path)

    both = edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a"))
    live = stage(both.distinct())
    labels = stage(read(live).select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    while not read(live).isEmpty():
        moves = stage(read(live).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")))
        for _ in range(jumps):
            step = read(moves)
            further = step.select(F.col("a").alias("to"), F.col("to").alias("on"))
            moves, old = stage(step.join(further, "to").select("a", F.col("on").alias("to"))), moves
            drop_stage(spark, old)
        move = read(moves)
        ends = read(live).join(move, "a").select(F.col("to").alias("x"), F.col("b"))
        ends = ends.join(move.withColumnRenamed("a", "b"), "b").select("x", F.col("to").alias("y"))
        new_live = stage(ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        moved = read(labels).join(move.select(F.col("a").alias("label"), "to"), "label", "left")
        new_labels = stage(moved.select("node", F.coalesce("to", "label").alias("label")))
        for old in (live, labels, moves):
            drop_stage(spark, old)
        live, labels = new_live, new_labels
    return read(labels)
