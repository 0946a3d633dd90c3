"""As-of lookups by merging facts and change lists in one order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .ranged import in_ranges, last_before


def asof_merge(facts: DataFrame, changes: DataFrame, on: Mapping[str, str], fact_time: str, change_time: str, values: Sequence[str],
               tie_break: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """Every fact with ``values`` of the last change of its key at or before its time; nulls where there is none.

    ``on`` maps change columns to fact columns. Facts and changes are sorted together and the last change is carried forward, so a fact is never compared
    with the other changes of its key: the work is that of one sort, however long a change list is, and a key that holds a third of the facts or
    100,000 changes is cut into ranges like any rows. Of changes at the same time the last by ``tie_break`` counts, then by their values.
    A change by date holds from the start of its day. Null keys match nothing; a change without a time is dropped, a fact without a time gets nulls.
    The looked-up columns are named ``value + suffix`` and must not be columns of ``facts``.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    order = ["_t", "_side", "_tie", "_spread"]
    new = [v + suffix for v in values]
    clash = set(new) & set(facts.columns)
    if clash:
        raise ValueError(f"columns of the facts and looked-up columns share names: {sorted(clash)}")
    payload = F.struct(*[F.col(v).alias(n) for v, n in zip(values, new, strict=True)])
    known = changes.filter(F.col(change_time).isNotNull()).dropna(subset=list(on))
    known = known.select(*[F.col(c).alias(k) for k, c in zip(keys, on, strict=True)], F.col(change_time).alias("_t"), F.lit(0).alias("_side"),
                         F.struct(*tie_break, F.xxhash64(*values).alias("_h")).alias("_tie"), F.lit(0).cast("long").alias("_spread"), payload.alias("_value"))
    kinds = known.schema
    wanted = facts.select(*[F.col(c).alias(k) for k, c in zip(keys, on.values(), strict=True)], F.col(fact_time).alias("_t"), F.lit(1).alias("_side"),
                          F.lit(None).cast(kinds["_tie"].dataType).alias("_tie"), F.xxhash64(*facts.columns).alias("_spread"),
                          F.lit(None).cast(kinds["_value"].dataType).alias("_value"), F.struct(*facts.columns).alias("_fact"))
    known = known.withColumn("_fact", F.lit(None).cast(wanted.schema["_fact"].dataType))
    found = last_before(in_ranges(known.unionByName(wanted), keys, order), keys, order, "_value", "_found").filter("_side = 1")
    return found.select(*[F.col(f"_fact.`{c}`").alias(c) for c in facts.columns], *[F.col(f"_found.`{n}`").alias(n) for n in new])
