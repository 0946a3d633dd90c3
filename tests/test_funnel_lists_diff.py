"""Funnels against every chain of events, long lists against SQL's NOT IN, row differences against plain comparison."""

import datetime
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators.funnel import funnel
from tillflow.operators.lists import in_list, not_in_list
from tillflow.operators.row_diff import differing_buckets, differing_rows

START = datetime.datetime(2024, 1, 1)
STEPS = ["visit", "form", "cart", "pay"]


def plain_funnel(events, steps, limit):
    """For each step the times at which some chain of events reaches it, by looking at all pairs of neighbouring steps."""
    by_user = {}
    for user, at, kind in events:
        if at is not None:
            by_user.setdefault(user, []).append((at, kind))
    out = []
    for user, found in by_user.items():
        reached = [at for at, kind in found if kind == steps[0]]
        times = []
        for step in [*steps[1:], None]:
            if not reached:
                break
            times.append(min(reached))
            reached = [at for at, kind in found if kind == step and any(before < at <= before + limit for before in reached)]
        if times:
            out.append((user, len(times), *times, *[None] * (len(steps) - len(times))))
    return sorted(out, key=repr)


def test_funnel(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    rng = random.Random(11)
    users = ["hot", None, *[f"u{i}" for i in range(200)]]
    events = [(rng.choice(users), START + datetime.timedelta(minutes=rng.randrange(3000)), rng.choice([*STEPS, "other", None])) for _ in range(3000)]
    # one user with most rows, among them many at the same moment
    events += [("hot", START + datetime.timedelta(minutes=rng.randrange(20_000)), rng.choice(STEPS)) for _ in range(3000)]
    events += [("hot", START + datetime.timedelta(minutes=5), k) for k in STEPS * 50] + [("u1", None, "visit")]
    df = session.createDataFrame(events, "u string, t timestamp, k string").repartition(4)
    for steps, minutes in ((STEPS, 90), (STEPS[::-1], 30), (STEPS[:1], 5), (STEPS[:2], 100_000)):
        found = funnel(df, "u", "t", "k", steps, F.make_dt_interval(mins=F.lit(minutes)))
        got = sorted(map(tuple, found.collect()), key=repr)
        assert got == plain_funnel(events, steps, datetime.timedelta(minutes=minutes))


def test_funnel_needs_a_chain_not_first_events(spark):
    minute = lambda n: START + datetime.timedelta(minutes=n)
    events = [("a", minute(0), "visit"), ("a", minute(100), "visit"), ("a", minute(105), "form"), ("b", minute(0), "form"), ("b", minute(1), "visit"),
              ("c", minute(3), "visit"), ("c", minute(3), "form"), ("d", minute(1), "form")]
    df = spark.createDataFrame(events, "u string, t timestamp, k string")
    found = funnel(df, "u", "t", "k", ["visit", "form"], F.make_dt_interval(mins=F.lit(10)))
    assert rows(found) == [("a", 2, minute(0), minute(105)), ("b", 1, minute(1), None), ("c", 1, minute(3), None)]
    assert funnel(df.limit(0), "u", "t", "k", ["visit"], F.make_dt_interval(mins=F.lit(1))).count() == 0
    with pytest.raises(ValueError):
        funnel(df, "u", "t", "k", ["visit", "visit"], F.make_dt_interval(mins=F.lit(1)))


def keys(n, null=True):
    return [(i, None if null and i % 97 == 0 else i * 7 % 300_000) for i in range(n)]


@pytest.mark.parametrize("kind", ["plain", "with null", "empty", "repeated"])
def test_lists_follow_sql(spark, kind):
    df = spark.createDataFrame(keys(20_000), "i int, k int")
    entries = {"plain": [(x,) for x in range(0, 300_000, 3)], "with null": [(x,) for x in range(0, 300_000, 3)] + [(None,)], "empty": [],
               "repeated": [(x % 50,) for x in range(100_000)]}[kind]
    listed = spark.createDataFrame(entries, "entry int")
    df.createOrReplaceTempView("facts")
    listed.createOrReplaceTempView("entries")
    for ours, sql in ((in_list, "in"), (not_in_list, "not in")):
        expected = spark.sql(f"select i from facts where k {sql} (select entry from entries)")
        got = ours(df, "k", listed, "entry").select("i")
        assert sorted(r.i for r in got.collect()) == sorted(r.i for r in expected.collect())


def test_long_lists_need_no_nested_loop(spark):
    session = spark.newSession()
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true"}
    for k, v in settings.items():
        session.conf.set(k, v)
    parquet = session.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    listed = session.read.parquet("/root/testdata/sf0.001/part.parquet").filter("p_size > 40")
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    within = plan_of(in_list(parquet, "l_partkey", listed, "p_partkey"))
    assert "LeftSemi" in within and "might_contain" in within
    without = plan_of(not_in_list(parquet, "l_partkey", listed, "p_partkey"))
    assert "SortMergeJoin" in without and "LeftAnti" in without and "NestedLoop" not in without


def plain_diff(left, right):
    a, b = Counter(left), Counter(right)
    keys_a, keys_b = {r[:3] for r in left}, {r[:3] for r in right}
    out = []
    for row in a.keys() | b.keys():
        if a[row] != b[row]:
            kind = ("repeated" if a[row] and b[row] else "left only" if row[:3] not in keys_b else "right only" if row[:3] not in keys_a else "changed")
            out.append((*row, a[row], b[row], kind))
    return sorted(out, key=repr)


def spend(n):
    return [(f"c{i % 40}" if i % 41 else None, f"2024-01-{i % 28 + 1:02d}", i, round(i * 1.37, 2) if i % 13 else None, "x" if i % 5 else None) for i in range(n)]


SPEND = "campaign string, day string, id int, cost double, note string"


@pytest.mark.parametrize("cells", [1, 8, 256])
def test_planted_differences_are_found(spark, cells):
    left = spend(20_000)
    right = list(left)
    right[5] = (*right[5][:3], 99.0, right[5][4])
    right[77] = (*right[77][:4], "other")
    # a value and a null that change places
    right[78] = (*right[78][:3], None, right[78][4])
    del right[1000], right[41 * 30]
    right += [right[500], right[500], ("new", "2024-01-01", -1, 1.0, None)]
    a, b = (spark.createDataFrame(x, SPEND).repartition(4) for x in (left, right))
    got = sorted(map(tuple, differing_rows(a, b, ["campaign", "day"], ["campaign", "day", "id"], cells).collect()), key=repr)
    assert got == plain_diff(left, right) and {r[-1] for r in got} == {"changed", "left only", "right only", "repeated"}
    assert differing_buckets(a, b, ["campaign", "day"]).count() == len({r[:2] for r in got})
    assert differing_rows(a, a.orderBy("cost"), ["campaign", "day"], ["id"]).count() == 0
    assert differing_rows(a.limit(0), a.limit(0), ["campaign"], ["id"]).count() == 0
    with pytest.raises(ValueError):
        differing_rows(a, b.drop("note"), ["campaign"], ["id"])


def test_only_differing_cells_are_compared(spark):
    """The last aggregation sees the rows of differing cells, not the table."""
    left = spend(20_000)
    right = [*left[:7], (*left[7][:3], 1e9, None), *left[8:]]
    a, b = (spark.createDataFrame(x, SPEND) for x in (left, right))
    from tillflow.operators import row_diff
    rows_ = row_diff._both(a, b)
    near = row_diff._within(rows_, row_diff._differing(rows_, ["campaign", "day"]), ["campaign", "day"])
    assert 0 < near.count() < 2 * 20_000 / 40
