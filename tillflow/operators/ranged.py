"""Ordered work over keys of any size: rows in one range sort over all tasks, what crosses the edges of the ranges in a table of one row per range.

A window over a key puts all of it into one task. Here the rows lie in ranges of (key, order) that the data decides, so a key with a third of the
rows is cut into many ranges, and a plain window works inside a key's part of one range. Only the first key of a range can have begun before
it, so what a range needs from those before it is one value. The rows are staged in buckets by range: the window and the join of the carried
values need no further shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.writers import materialise_buckets

RANGE = "_b"


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the number ``_b`` of their range of (keys, order), kept in buckets by it.

    They are staged, so a lost executor cannot deal them to other ranges. Equal rows share a range, so ``order`` should tell the rows of a key apart.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn(RANGE, F.spark_partition_id())
    return materialise_buckets(ranged, [RANGE])


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def _carried(ranged: DataFrame, keys: Sequence[str], last: Column, carry: Column) -> DataFrame:
    """(_b, _lo, _carry): per range its first key, and ``carry`` over the ranges before it that end with this key.

    ``last`` is an aggregate over a range: the struct (key, value) of what its last key hands on; it counts only where its key is the range's last.
    """
    edges = ranged.groupBy(RANGE).agg(F.min(_key(keys)).alias("_lo"), F.max(_key(keys)).alias("_hi"), last.alias("_last"))
    ends = edges.select(F.col("_hi").alias("_k"), (F.col(RANGE) * 2 + 1).alias("_at"), F.lit(None).cast("int").alias(RANGE),
                        F.when(F.col("_last.key").eqNullSafe(F.col("_hi")), F.col("_last.value")).alias("_value"))
    asks = edges.select(F.col("_lo").alias("_k"), (F.col(RANGE) * 2).alias("_at"), RANGE, F.lit(None).cast(ends.schema["_value"].dataType).alias("_value"))
    # one row per range and side, so the window of a key that fills many ranges is short
    before = W.partitionBy("_k").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    rows = ends.union(asks).withColumn("_carry", carry.over(before))
    return rows.filter(F.col(RANGE).isNotNull()).select(RANGE, F.col("_k").alias("_lo"), "_carry")


def last_before(ranged: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the last ``value`` that is not null up to this row of the key. ``ranged`` comes from :func:`in_ranges`."""
    w = W.partitionBy(*keys, RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    given = F.col(value).isNotNull()
    last = F.max_by(F.struct(_key(keys).alias("key"), F.col(value).alias("value")), F.when(given, F.struct(_key(keys).alias("key"), *order)))
    carried = _carried(ranged, keys, last, F.last("_value", ignorenulls=True))
    local = ranged.withColumn("_local", F.last(value, ignorenulls=True).over(w)).join(carried, RANGE, "left")
    found = F.coalesce("_local", F.when(_key(keys).eqNullSafe(F.col("_lo")), F.col("_carry")))
    return local.select(*ranged.columns, found.alias(out))


def along(ranged: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, str] = {}, previous: Mapping[str, str] = {},
          following: Mapping[str, str] = {}) -> DataFrame:
    """Add what a row sees along its key, each as ``{new column: source column}``: sums up to this row (nulls as 0), values of the row before, of the row after.

    ``ranged`` comes from :func:`in_ranges`; ``order`` must tell the rows of a key apart.
    """
    w = W.partitionBy(*keys, RANGE).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    row_of = lambda named: F.struct(*[F.col(c).alias(o) for o, c in named.items()] or [F.lit(0).alias("_")])
    local = ranged.withColumns({f"_s_{o}": F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto) for o, c in sums.items()}
                               | {"_p": F.lag(row_of(previous)).over(w), "_n": F.lead(row_of(following)).over(w)})
    # the sums at a range's last row are those of its last key
    at = F.struct(_key(keys).alias("key"), *order)
    last_row = F.struct(row_of(previous).alias("p"), *[F.col(f"_s_{o}").alias(f"s_{o}") for o in sums])
    edges = local.groupBy(RANGE).agg(F.min(_key(keys)).alias("_lo"), F.max(_key(keys)).alias("_hi"), F.min_by(row_of(following), at).alias("_first"),
                                     F.max_by(last_row, at).alias("_last"))
    # a key that fills many ranges is a row per range and side here
    none = lambda c: F.lit(None).cast(edges.schema[c].dataType).alias(c)
    ends = edges.select(F.col("_hi").alias("_k"), (F.col(RANGE) * 2 + 1).alias("_at"), RANGE, "_last", none("_first"))
    heads = edges.select(F.col("_lo").alias("_k"), (F.col(RANGE) * 2).alias("_at"), RANGE, none("_last"), "_first")
    side = W.partitionBy("_k").orderBy("_at")
    before, after = side.rowsBetween(W.unboundedPreceding, -1), side.rowsBetween(1, W.unboundedFollowing)
    rows = ends.union(heads).select("_k", "_at", RANGE, F.last("_last.p", ignorenulls=True).over(before).alias("_before"), F.first("_first", ignorenulls=True).over(after).alias("_after"),
                                    *[F.sum(f"_last.s_{o}").over(before).alias(f"_c_{o}") for o in sums])
    heads = rows.filter("_at % 2 = 0").select(RANGE, F.col("_k").alias("_lo"), "_before", *[f"_c_{o}" for o in sums])
    ends = rows.filter("_at % 2 = 1").select(RANGE, F.col("_k").alias("_hi"), "_after")
    joined = local.join(heads.join(ends, RANGE), RANGE, "left")
    first, last = _key(keys).eqNullSafe(F.col("_lo")), _key(keys).eqNullSafe(F.col("_hi"))
    totals = [(F.col(f"_s_{o}") + F.coalesce(F.when(first, F.col(f"_c_{o}")), F.lit(0))).alias(o) for o in sums]
    seen = [F.coalesce("_p", F.when(first, F.col("_before")))[o].alias(o) for o in previous]
    seen += [F.coalesce("_n", F.when(last, F.col("_after")))[o].alias(o) for o in following]
    return joined.select(*ranged.columns, *totals, *seen)
