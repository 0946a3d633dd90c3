"""Operators on small literal fixtures with hand-computed results, and on a table with one hot key."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import Window as W, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillflow.operators.calendar import expand_intervals, zero_fill
from tillflow.operators.dedup import latest_per_key
from tillflow.operators.joins import with_group_value
from tillflow.operators.lifecycle import churn_rates, tag_acquisition, tag_lifecycle
from tillflow.operators.margin import margin_waterfall, period_change, split_signed, tax_included
from tillflow.operators.metrics import merge_metrics, reconcile, unmapped, with_baseline
from tillflow.operators.money import to_local, to_usd
from tillflow.operators.proration import prorate
from tillflow.operators.ranges import asof_range_join, effective_ranges
from tillflow.operators.scoring import score_rows
from tillflow.operators.sequence import attribute_history, detect_increase, sequence_events, with_neighbours
from tillflow.operators.subscriptions import effective_end, month_snapshot, monthly_recurring
from tillflow.sources.regions import region_union
from tillflow.sources.writers import number_rows, write_batches

D = lambda s: dt.date.fromisoformat(s)


def test_latest_per_key_settles_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n")], "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"], tie_break=["v"])) == [("a", 2, "z"), ("b", None, "n")]
    assert rows(latest_per_key(df, ["k"], ["t"], desc=False, tie_break=["v"]), "k", "v") == [("a", "x"), ("b", "n")]


def test_ranges_do_not_overlap_and_lookup_uses_both_ends(spark):
    changes = spark.createDataFrame([("a", D("2024-01-01"), 1.0), ("a", D("2024-03-01"), 2.0)], "k string, d date, rate double")
    closed = effective_ranges(changes, ["k"], "d")
    assert rows(closed, "from_date", "to_date") == [(D("2024-01-01"), D("2024-02-29")), (D("2024-03-01"), D("9999-12-31"))]
    assert rows(effective_ranges(changes, ["k"], "d", closed=False), "to_date") == [(D("2024-03-01"),), (D("9999-12-31"),)]
    facts = spark.createDataFrame([(i, k, dt.datetime.fromisoformat(t)) for i, k, t in [
        (1, "a", "2024-01-01T00:00"), (2, "a", "2024-02-29T23:59"), (3, "a", "2024-03-01T00:00"), (4, "a", "2023-12-31T00:00"), (5, "b", "2024-01-05T00:00")]],
        "i int, k string, at timestamp")
    assert [(i, r) for i, r in sorted((x.i, x.rate) for x in asof_range_join(facts, closed, {"k": "k"}, "at").collect())] == [
        (1, 1.0), (2, 1.0), (3, 2.0), (4, None), (5, None)]


def test_money(spark):
    fx = spark.createDataFrame([("sgd", 1.25), ("jpy", 100.0)], "currency string, fx_to_usd double")
    units = spark.createDataFrame([("jpy", 1)], "currency string, subunits int")
    df = spark.createDataFrame([(1, 250, "SGD"), (2, 300, "jpy"), (3, 0, "sgd"), (4, 9, "xxx")], "i int, amount bigint, ccy string")
    assert rows(to_usd(df, "amount", "ccy", fx, units), "i", "amount_usd") == [(1, 2.0), (2, 3.0), (3, 0.0), (4, None)]
    back = to_local(to_usd(df, "amount", "ccy", fx, units), "amount_usd", "ccy", fx)
    assert rows(back, "i", "amount_local") == [(1, 2.5), (2, 300.0), (3, 0.0), (4, None)]


def test_monthly_recurring_kinds(spark):
    df = spark.createDataFrame([("month", 2, 1200, 1), ("month", None, 1200, 1), ("year", 1, 1200, 1), ("week", 1, 1200, 1), ("day", 1, 1200, 1),
                                ("quarter", 1, 1200, 1), ("month", 1, 1200, 0)], "kind string, n bigint, amount bigint, qty bigint")
    got = [r.v for r in df.select(monthly_recurring("amount", "qty", "kind", "n").alias("v")).collect()]
    assert got == pytest.approx([6.0, 12.0, 1.0, 52.0, 365.0, 0.0, 0.0])


def test_effective_end(spark):
    subs = spark.createDataFrame([("s1", "canceled", D("2024-06-01")), ("s2", "active", D("2024-06-01")), ("s3", "active", D("2024-06-01"))],
                                 "subscription_id string, status string, ended_at date")
    inv = spark.createDataFrame([("i1", "s1"), ("i2", "s1"), ("i3", "s2"), ("i4", None)], "id string, subscription_id string")
    ch = spark.createDataFrame([("i1", "succeeded", D("2024-01-05")), ("i2", "failed", D("2024-02-05")), ("i3", "succeeded", D("2024-03-05")),
                                (None, "succeeded", D("2024-03-05"))], "invoice_id string, status string, created date")
    assert rows(effective_end(subs, inv, ch), "subscription_id", "ended_at") == [("s1", D("2024-01-05")), ("s2", D("2024-06-01"))]
    assert len(rows(effective_end(subs, inv, ch, paid_only=False))) == 3


def test_expand_intervals_clips(spark):
    df = spark.createDataFrame([(1, D("2024-01-30"), D("2024-02-01")), (2, D("2024-03-05"), D("2024-03-01")), (3, D("2023-01-01"), D("2024-01-02")),
                                (4, D("2025-01-01"), D("2025-02-01")), (5, D("2024-02-27"), D("2030-01-01")), (6, D("2024-01-05"), None)], "i int, a date, b date")
    got = rows(expand_intervals(df, "a", "b", "d", "2024-01-01", "2024-02-29", tail_days=1), "i", "d")
    assert got == ([(1, D(d)) for d in ("2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02")] + [(3, D(d)) for d in ("2024-01-01", "2024-01-02", "2024-01-03")]
                   + [(5, D(d)) for d in ("2024-02-27", "2024-02-28", "2024-02-29")])
    months = rows(expand_intervals(df, "a", "b", "d", "2024-01-01", "2024-04-15", step="month"), "i", "d")
    assert months == [(1, D("2024-02-01")), (3, D("2024-01-01")), (5, D("2024-03-01")), (5, D("2024-04-01"))]


def test_zero_fill_starts_at_first_activity(spark):
    df = spark.createDataFrame([("a", D("2024-01-15"), 5.0), ("a", D("2024-03-02"), 7.0), ("b", D("2024-05-01"), 1.0)], "k string, d date, v double")
    got = rows(zero_fill(df, ["k"], "d", "v", end="2024-04-10"))
    assert got == [("a", D("2024-01-01"), 5.0), ("a", D("2024-02-01"), 0.0), ("a", D("2024-03-01"), 7.0), ("a", D("2024-04-01"), 0.0), ("b", D("2024-05-01"), 1.0)]


def test_month_snapshot_moves_mid_month_zero(spark):
    df = spark.createDataFrame([("a", D("2024-01-01"), 5.0), ("a", D("2024-01-02"), 5.0), ("a", D("2024-01-20"), 0.0), ("b", D("2024-02-01"), 0.0)],
                               "k string, obs_date date, mrr_usd double")
    assert rows(month_snapshot(df, ["k"])) == [("a", D("2024-01-01"), 5.0), ("a", D("2024-02-01"), 0.0), ("b", D("2024-02-01"), 0.0)]


def test_lifecycle_tags_partition_the_rows(spark):
    series = [("2024-01-01", 5.0), ("2024-02-01", 5.0), ("2024-03-01", 8.0), ("2024-04-01", 3.0), ("2024-05-01", 0.0), ("2024-06-01", 0.0), ("2024-07-01", 4.0)]
    df = spark.createDataFrame([("a", D(d), v) for d, v in series] + [("b", D("2024-02-01"), 1.0)], "k string, d date, v double")
    tags = {(r.k, r.d.month): r.lifecycle for r in tag_lifecycle(df, ["k"], "d", "v").collect()}
    assert [tags["a", m] for m in range(1, 8)] == ["New", "Retention", "Expansion", "Contraction", "Churn", "Retention", "Reactivation"]
    assert tags["b", 2] == "New"
    silent = spark.createDataFrame([("c", D("2024-01-01"), 0.0)], "k string, d date, v double")
    assert tag_lifecycle(silent, ["k"], "d", "v", drop_silent=True).count() == 0


def test_acquisition_grace(spark):
    df = spark.createDataFrame([("a", D("2024-01-01")), ("a", D("2024-01-08")), ("a", D("2024-01-09")), (None, None)], "k string, d date")
    got = [(r.d, r.new_existing) for r in tag_acquisition(df, "k", "d").orderBy("d").collect()]
    assert got == [(None, None), (D("2024-01-01"), "New"), (D("2024-01-08"), "New"), (D("2024-01-09"), "Existing")]


def test_prorated_parts_sum_to_the_pool(spark):
    df = spark.createDataFrame([("x", 1.0, 90.0), ("x", 2.0, 90.0), ("y", 0.0, 10.0), ("z", 5.0, None), (None, 3.0, 6.0)], "p string, v double, pool double")
    got = sorted(prorate(df, "v", "pool", ["p"], "part").select("p", "v", "part").collect(), key=str)
    assert {(r.p, r.v): r.part for r in got} == {("x", 1.0): 30.0, ("x", 2.0): 60.0, ("y", 0.0): None, ("z", 5.0): 0.0, (None, 3.0): 6.0}


def test_waterfall_and_tax(spark):
    df = spark.createDataFrame([(100.0, 10.0, 5.0, 20.0, None, 3.0, 2.0, 7.0, 4.0, 6.0)],
                               "amount double, refunds double, tax_paid_usd double, cogs double, packaging double, delivery_cost double, gateway_fees double, "
                               "marketing_cost double, operating_expense double, staff_cost double")
    r = margin_waterfall(df).first()
    assert (r.net_revenue, r.gross_profit, r.cm2, r.cm3, r.ebitda) == (85.0, 70.0, 65.0, 58.0, 48.0)
    assert margin_waterfall(df, zero_missing=False, ebitda=False).first().cm2 is None
    assert spark.range(1).select(tax_included(F.lit(108.0), F.lit(0.08)).alias("v")).first().v == pytest.approx(8.0)


def test_split_signed_drops_orders_without_sale(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", -4.0), ("b", -3.0)], "k string, v double")
    assert rows(split_signed(df, "v", ["k"])) == [("a", 10.0, 4.0, 0.4)]


def test_merge_metrics_keeps_every_key(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n_a bigint")
    b = spark.createDataFrame([("y", 5.0), (None, 6.0)], "k string, v_b double")
    got = {r.k: (r.n_a, r.v_b) for r in merge_metrics(["k"], [a, b]).collect()}
    assert got == {"x": (1, 0.0), "y": (2, 5.0), None: (0, 6.0)}
    assert {r.k: r.v_b for r in merge_metrics(["k"], [a, b], fill={"n_a": 0}).collect()}["x"] is None


def test_small_metric_helpers(spark):
    a = spark.createDataFrame([(D("2024-01-03"), 1.0), (D("2024-01-09"), 2.0), (None, 9.0)], "d date, v double")
    b = spark.createDataFrame([(D("2024-02-01"), 4.0)], "d date, v double")
    assert [tuple(r) for r in reconcile(a, b, "d", "v").collect()] == [(D("2024-01-01"), 3.0, None)]
    assert rows(with_baseline(spark.createDataFrame([("x", 2.0)], "k string, v double"), "v")) == [("baseline", "x", -2.0), ("main", "x", 2.0)]
    names = spark.createDataFrame([("A",), ("b",), ("b",), ("c",)], "n string")
    assert rows(unmapped(names, spark.createDataFrame([("a",), ("C",)], "n string"), ["n"], ignore_case=True)) == [("b",)]
    m = spark.createDataFrame([(D("2024-01-01"), 10.0), (D("2024-02-01"), 15.0), (D("2024-04-01"), 20.0)], "m date, v double")
    assert [r.change for r in period_change(m, "m", "v").orderBy("m").collect()] == [None, 0.5, None]


def test_region_union_needs_equal_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, x int")
    assert rows(region_union({"sg": a, "hk": b}), "region", "x", "y") == [("hk", 4, 3), ("sg", 1, 2)]
    with pytest.raises(Exception):
        region_union({"sg": a, "hk": spark.createDataFrame([(1,)], "x int")}).count()


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows of which one key holds a third, many on one day, some keys NULL."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(0)).when(i % 97 == 0, F.lit(None)).otherwise(i % 400 + 1)
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.when(i % 5 == 0, F.lit(40)).otherwise((i * 7919) % 700).cast("int"))
    return spark.range(30000).select(i, key.cast("int").alias("k"), day.alias("d"), ((i * 31) % 1009).cast("double").alias("v")).cache()


def test_neighbours_equal_the_plain_window(hot):
    w = W.partitionBy("k").orderBy("d", "id")
    plain = hot.select("id", F.lag("v").over(w).alias("p"), F.lead("d").over(w).alias("n"))
    ours = with_neighbours(hot, ["k"], ["d", "id"], previous={"p": "v"}, following={"n": "d"}).select("id", "p", "n")
    assert ours.count() == 30000
    assert ours.exceptAll(plain).count() == 0


def test_sequence_equals_the_plain_window(hot):
    w = W.partitionBy("k").orderBy("d", "id")
    plain = hot.select("id", F.row_number().over(w).cast("long").alias("n"), F.lead("d").over(w).alias("f"))
    ours = sequence_events(hot, "k", "d", ["id"], "n", "f").select("id", F.col("n").cast("long").alias("n"), "f")
    assert ours.exceptAll(plain).count() == 0 and ours.count() == 30000


def test_group_value_equals_the_plain_window(hot):
    plain = hot.select("id", F.min("d").over(W.partitionBy("k")).alias("m"))
    assert with_group_value(hot, ["k"], m=F.min("d")).select("id", "m").exceptAll(plain).count() == 0


def test_detect_increase_against_brute_force(spark, hot):
    created = with_group_value(hot.filter("k is not null"), ["k"], c=F.min("d"))
    small = created.select("k", "d", F.floor(F.col("v") / 100).cast("int").alias("n"), "c").distinct()
    history = attribute_history(small, ["k"], ["d", "n"], "n")
    ours = sorted((r.k, r.first_n, r.d, r.current_n, r.days_elapsed) if r.d else (r.k, r.first_n, D("9999-01-01"), -1, -1)
                  for r in detect_increase(history, ["k"], "n", "d", "c", 3, 90, F.lit(True)).collect())
    series = {}
    for r in small.collect():
        series.setdefault(r.k, []).append((r.d, r.n, r.c))
    want = []
    for k, seq in series.items():
        seq.sort()
        if seq[0][1] > 3:
            continue
        rises = [(d, n, (d - c).days) for (_, before, _), (d, n, c) in zip(seq, seq[1:]) if n > before and n > 3 and (d - c).days <= 90]
        want += [(k, seq[0][1], d, n, e) for d, n, e in rises] or [(k, seq[0][1], D("9999-01-01"), -1, -1)]
    assert ours == sorted(want)


def test_number_rows_is_global_and_dense(hot):
    got = number_rows(hot.select("id", "k", "d"), ["k", "d", "id"]).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(30000))
    order = [((r.k is not None, r.k or 0), r.d, r.id) for r in got]
    assert order == sorted(order)


def test_write_batches_exact_sizes(spark, hot, tmp_path):
    write_batches(hot.filter("id < 10007").select("id", "v"), ["id"], 3000, str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("batch=*/*.csv"))
    assert [f.parent.name for f in files] == ["batch=1", "batch=2", "batch=3", "batch=4"]
    lines = [f.read_text().splitlines() for f in files]
    assert [len(x) - 1 for x in lines] == [3000, 3000, 3000, 1007]
    assert [int(x[1].split(",")[0]) for x in lines] == [0, 3000, 6000, 9000]


def test_score_rows_captures_errors(spark):
    def fn(batch):
        if (batch["u"] == "bad").any():
            raise ValueError("no")
        return batch["u"].str.upper().to_frame("label")
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "bad"), (3, None), (4, ""), (5, "y")], "i int, u string")
    got = {r.i: (r.label, r.error) for r in score_rows(df, "i", ["u"], "u", fn, StructType([StructField("label", StringType())])).collect()}
    assert got == {1: ("X", None), 2: (None, "no"), 3: (None, "missing input"), 4: (None, "missing input"), 5: ("Y", None)}


def test_churn_rates(spark):
    summary = spark.createDataFrame([(D("2024-02-01"), "churned", 2, -20.0), (D("2024-03-01"), "churned", 1, -5.0), (D("2024-02-01"), "new", 9, 1.0)],
                                    "m date, status string, n bigint, mrr_delta double")
    actives = spark.createDataFrame([(D("2024-02-01"), 10, 100.0), (D("2024-03-01"), 9, 90.0)], "m date, n bigint, mrr_usd double")
    assert rows(churn_rates(summary, actives, "m"), "m", "churn_rate", "dollar_churn_rate") == sorted(
        [(D("2024-02-01"), None, None), (D("2024-03-01"), 0.1, 0.05)], key=lambda r: r[0])


def test_month_observations_equal_the_daily_snapshot(spark):
    from tillflow.operators.subscriptions import month_observations
    spans = [(i, D(a), D(b), v) for i, (a, b, v) in enumerate([
        ("2024-01-10", "2024-03-20", 5.0), ("2024-02-01", "2024-02-29", 5.0), ("2024-02-28", "2024-02-28", 5.0), ("2023-11-03", "2024-01-31", 2.0),
        ("2024-01-15", "2024-02-10", 0.0), ("2024-04-20", "2030-01-01", 0.0), ("2024-04-20", "2030-01-01", 3.0), ("2024-03-31", "2024-04-25", 1.0),
        ("2024-05-01", "2024-05-02", 1.0), ("2023-01-01", "2023-12-31", 4.0), ("2023-01-01", "2023-12-30", 4.0), ("2024-01-02", "2024-04-24", None)])]
    df = spark.createDataFrame(spans, "k int, a date, b date, mrr_usd double")
    daily = expand_intervals(df, "a", "b", "obs_date", "2024-01-01", "2024-04-25", tail_days=1)
    daily = daily.withColumn("mrr_usd", F.when(F.col("b") >= F.col("obs_date"), F.col("mrr_usd")).otherwise(F.lit(0.0)))
    monthly = month_observations(df, "a", "b", "mrr_usd", "2024-01-01", "2024-04-25")
    assert rows(month_snapshot(monthly, ["k"]), "k", "obs_date", "mrr_usd") == rows(month_snapshot(daily, ["k"]), "k", "obs_date", "mrr_usd")


def test_flatten_json_shapes(spark):
    from tillflow.operators.json_fields import flatten_json
    cases = ['{"a": 1, "p": {"q": "x"}}', '[{"a": 2, "p": {"q": "y"}}, {"a": 9}]', "[]", "{broken", '{"a": {"z": 1}, "p": 3}', '{"a": "12.5"}', None]
    df = spark.createDataFrame([(i, j) for i, j in enumerate(cases)], "i int, j string")
    fields = {"a": "bigint", "q": ("p.q", "string")}
    assert rows(flatten_json(df, "j", fields), "i", "a", "q") == [(0, 1, "x"), (1, 2, "y"), (2, None, None), (3, None, None), (4, None, None), (5, None, None), (6, None, None)]
    assert rows(flatten_json(df, "j", fields, or_first_element=False), "i", "a", "q")[1] == (1, None, None)
