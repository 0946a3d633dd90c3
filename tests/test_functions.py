"""Scalar rules that differ from the built-ins."""

from pyspark.sql import functions as F

from tillflow.functions import (CHANNEL_PREFIXES, PAGE_SOURCES, date_steps, exact_sum, greatest_strict, json_either, json_scalar,
                                least_strict, map_channel, parse_datetime, regex_group, safe_divide)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_safe_divide(spark):
    assert one(spark, safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, safe_divide(F.lit(None).cast("int"), F.lit(4))) is None


def test_strict_extremes(spark):
    null = F.lit(None).cast("double")
    assert one(spark, greatest_strict(F.lit(1.0), null)) is None
    assert one(spark, least_strict(null, F.lit(1.0))) is None
    assert one(spark, greatest_strict(F.lit(-3.0), F.lit(0.0))) == 0.0
    assert one(spark, least_strict(F.lit(-3.0), F.lit(0.0))) == -3.0


def test_json_scalars(spark):
    text = '{"a": 1, "o": {"x": 1}, "l": [1], "s": "t", "n": null}'
    want = {"$.a": "1", "$.o": None, "$.l": None, "$.s": "t", "$.n": None, "$.missing": None}
    assert {p: one(spark, json_scalar(F.lit(text), p)) for p in want} == want
    assert one(spark, json_scalar(F.lit("{broken"), "$.a")) is None


def test_json_object_or_array(spark):
    cases = ['{"f": 5}', '[{"f": 6}]', "[]", '{"g": 1}', '{"f": {"x": 1}}', "{broken"]
    df = spark.createDataFrame([(i, j) for i, j in enumerate(cases)], "i int, j string")
    got = [r.v for r in df.select("i", json_either("j", "f").alias("v")).orderBy("i").collect()]
    assert got == ["5", "6", None, None, None, None]


def test_regex_group_without_match(spark):
    assert one(spark, regex_group(F.lit("no"), "a(b)")) is None
    assert one(spark, regex_group(F.lit("ab"), "a(b)")) == "b"


def test_date_steps_backwards_is_empty(spark):
    day = lambda s: F.lit(s).cast("date")
    df = spark.range(1).select(F.explode(date_steps(day("2024-03-01"), day("2024-02-01"), "month")))
    assert df.count() == 0
    df = spark.range(1).select(F.explode(date_steps(day("2024-01-01"), day("2024-03-01"), "month")).alias("d"))
    assert [r.d.month for r in df.collect()] == [1, 2, 3]


def test_parse_datetime_ignores_case(spark):
    for text in ("03-11-2024 09:30pm", "03-11-2024 09:30PM"):
        assert one(spark, F.date_format(parse_datetime(F.lit(text)), "yyyy-MM-dd HH:mm")) == "2024-11-03 21:30"
    assert one(spark, parse_datetime(F.lit("soon"))) is None


def test_channel_rules(spark):
    df = spark.createDataFrame([("FB_x",), ("partner",), (None,), ("Google",), ("instagram",)], "s string")
    got = [r.v for r in df.select(map_channel("s", CHANNEL_PREFIXES, ignore_case=True).alias("v")).collect()]
    assert got == ["facebook_ads", "partner", None, "google_ads", "instagram"]
    # matches two rules: the earlier one wins; the infix test is case-sensitive
    df = spark.createDataFrame([("ig-google",), ("Google",)], "s string")
    assert [r.v for r in df.select(map_channel("s", PAGE_SOURCES, match="contains").alias("v")).collect()] == ["Google", "Google"]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 7 + [1e6, -1e6, 0.3]
    a = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v").alias("s")).first().s
    b = spark.createDataFrame([(v,) for v in reversed(values)], "v double").agg(exact_sum("v").alias("s")).first().s
    assert a == b == 1.0


def test_json_scalars_go_by_type(spark):
    from tillflow.operators.json_fields import flatten_json
    texts = ['{"a": "[Sample] kit"}', '{"a": "{A-1}"}', '{"a": "[1]"}', '{"a": [1]}', '{"a": {"b": 1}}', '{"a": null}', '{"a": 12.5}', '{"a": true}', '{}',
             '{"a": "x", "a": "[y"}', "no json", None, '[{"a": "[z]"}]']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", json_scalar("t", "$.a").alias("v")).orderBy("i").collect()]
    assert got[:9] == ["[Sample] kit", "{A-1}", "[1]", None, None, None, "12.5", "true", None]
    assert got[9] in ("x", None) and got[10:] == [None, None, None]
    flat = [r.a for r in flatten_json(df, "t", {"a": "string"}).orderBy("i").collect()]
    assert flat[:9] == ["[Sample] kit", "{A-1}", "[1]", None, None, None, "12.5", "true", None] and flat[10:] == [None, None, "[z]"]
