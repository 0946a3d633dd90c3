"""Range-wise work against brute force, with keys and days that hold a third of the rows and more."""

import bisect
import datetime
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators.asof import asof_merge
from tillflow.operators.ranged import along, in_ranges
from tillflow.operators.sweep import at_month_starts, by_day, levels, signed_events

SMALL = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
         "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
JOINS_SHUFFLE = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def conf(spark):
    """Small ranges, so that few rows make many."""
    session = spark.newSession()
    for k, v in SMALL.items():
        session.conf.set(k, v)
    return session


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain_asof(changes, facts):
    by_key = {}
    for k, t, v in changes:
        if k is not None and t is not None:
            by_key.setdefault(k, []).append((t, v))
    for found in by_key.values():
        found.sort()
    out = []
    for k, t, i in facts:
        found = by_key.get(k, [])
        at = 0 if t is None else bisect.bisect_right(found, (t, 1 << 40))
        out.append((i, found[at - 1][1] if at else None))
    return sorted(out, key=repr)


def asof(session, changes, facts):
    c = session.createDataFrame(changes, "k string, t int, v long")
    f = session.createDataFrame(facts, "key string, at int, i int")
    return asof_merge(f, c, {"k": "key"}, "at", "t", ["v"], tie_break=["v"])


def check_asof(session, changes, facts):
    found = asof(session, changes, facts)
    assert found.columns == ["key", "at", "i", "v"]
    assert sorted(((r.i, r.v) for r in found.collect()), key=repr) == plain_asof(changes, facts)


def test_asof_long_change_list_and_hot_key(conf):
    rng = random.Random(3)
    changes = [("long", rng.randrange(1_000_000), i) for i in range(100_000)] + [(f"k{i % 40}", rng.randrange(1_000_000), -i) for i in range(400)]
    facts = [(rng.choice(["long", f"k{rng.randrange(45)}"]), rng.randrange(-1000, 1_000_000), i) for i in range(20_000)]
    # a third of the facts on one key at one moment
    facts += [("k7", 500_000, 20_000 + i) for i in range(10_000)]
    check_asof(conf, changes, facts)
    ranges = in_ranges(conf.createDataFrame(facts, "key string, at int, i int"), ["key"], ["at", "i"])
    assert ranges.filter("key = 'k7'").select("_b").distinct().count() > 1


def test_asof_edges(conf):
    changes = [("a", 5, 1), ("a", 5, 3), ("a", 5, 2), ("a", None, 9), (None, 1, 8), ("b", 10, None), ("b", 3, 4)]
    facts = [("a", 4, 0), ("a", 5, 1), ("a", 5, 1), ("a", None, 2), (None, 7, 3), ("b", 9, 4), ("b", 10, 5), ("c", 1, 6)]
    found = asof(conf, changes, facts)
    # the last change of b says that the value is unknown from 10 on
    assert sorted(((r.i, r.v) for r in found.collect()), key=repr) == sorted([(0, None), (1, 3), (1, 3), (2, None), (3, None), (4, 4), (5, None), (6, None)], key=repr)
    for c, f in (([], facts), (changes, []), ([], [])):
        check_asof(conf, c, f)


def test_asof_without_keys_and_by_date(conf):
    rates = conf.createDataFrame([(datetime.date(2024, 1, 1), 1.0), (datetime.date(2024, 2, 1), 2.0)], "since date, rate double")
    moments = conf.createDataFrame([(datetime.datetime(2023, 12, 31, 23, 59), 1), (datetime.datetime(2024, 2, 1, 0, 0), 2), (datetime.datetime(2024, 1, 31, 23, 0), 3)],
                                   "at timestamp, i int")
    found = asof_merge(moments, rates, {}, "at", "since", ["rate"], suffix="_then")
    assert rows(found, "i", "rate_then") == [(1, None), (2, 2.0), (3, 1.0)]
    with pytest.raises(ValueError, match="rate"):
        asof_merge(moments.withColumn("rate", F.lit(1)), rates, {}, "at", "since", ["rate"])


def test_asof_plan_compares_no_times_and_moves_facts_once(spark):
    session = spark.newSession()
    for k, v in JOINS_SHUFFLE.items():
        session.conf.set(k, v)
    plan = plan_of(asof(session, [("a", 1, 1)], [("a", 2, 3)]))
    joins = re.findall(r"SortMergeJoin \[([^]]*)\], \[([^]]*)\], (\w+)(.*)", plan)
    # joined by the range number alone, no residual
    assert joins and all("_b" in a and "_b" in b and "," not in a and not rest.strip() for a, b, _, rest in joins)
    # the side with the facts is read from its buckets: between its scan and the join there is no exchange
    facts_side = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in facts_side[:facts_side.index("FileScan")]


def test_along(conf):
    rng = random.Random(5)
    data = [(rng.choice(["hot", None, f"k{rng.randrange(30)}"]), i, rng.choice([None, rng.randrange(-50, 50)])) for i in range(20_000)]
    df = conf.createDataFrame(data, "k string, at int, v int").withColumn("one", F.lit(1))
    ranged = in_ranges(df, ["k"], ["at"])
    assert ranged.select("_b").distinct().count() > 5
    out = along(ranged, ["k"], ["at"], {"total": "v", "number": "one"}, {"last_v": "v"}, {"next_at": "at"})
    expected, state, last = [], {}, {}
    for k, at, v in data:
        total, number = state.get(k, (0, 0))
        state[k] = total, number = total + (v or 0), number + 1
        if k in last:
            expected[last[k]][-1] = at
        expected.append([k, at, total, number, data[expected[last[k]][1]][2] if k in last else None, None])
        last[k] = len(expected) - 1
    assert sorted(map(tuple, out.select("k", "at", "total", "number", "last_v", "next_at").collect()), key=repr) == sorted(map(tuple, expected), key=repr)


def day(n):
    return datetime.date(2020, 1, 1) + datetime.timedelta(n)


def test_sweep_equals_expansion(conf):
    rng = random.Random(6)
    data = [(rng.choice(["hot", "cold", None]), day(a), day(a + rng.randrange(-2, 90)), rng.randrange(0, 5)) for a in (rng.randrange(400) for _ in range(3000))]
    data += [("hot", None, day(5), 1), ("hot", day(5), None, 1)]
    spans = conf.createDataFrame(data, "seg string, a date, b date, v long")
    events = signed_events(spans, F.col("a"), F.col("b"), ["seg"], {"n": F.lit(1).cast("long"), "v": F.col("v")})
    steps = levels([events], ["seg"], ["n", "v"])
    level = {}
    for seg, a, b, v in data:
        if a and b:
            for i in range((b - a).days + 1):
                n, total = level.get((seg, a + datetime.timedelta(i)), (0, 0))
                level[seg, a + datetime.timedelta(i)] = n + 1, total + v
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, by_day(steps, day(0), day(600)).select("seg", "day", "n", "v").collect()), key=key) == sorted(
        ((*k, *v) for k, v in level.items()), key=key)
    months = at_month_starts(steps, day(0), day(600))
    assert sorted(map(tuple, months.select("seg", "month", "n", "v").collect()), key=key) == sorted(((*k, *v) for k, v in level.items() if k[1].day == 1), key=key)
    # neighbouring stretches differ, so there are at most two for each span
    assert steps.count() <= 2 * len(data)


def test_sweep_leaves_open_ends_until_the_last_day(conf):
    spans = conf.createDataFrame([("x", day(0), day(9), 2)], "seg string, a date, b date, v long")
    opened = spans.select("seg", F.col("a").alias("day"), F.col("v"))
    found = levels([opened], ["seg"], ["v"], until=str(day(20))).collect()
    assert [tuple(r) for r in found] == [("x", day(0), day(20), 2)]
    assert levels([opened.limit(0)], ["seg"], ["v"]).count() == 0
