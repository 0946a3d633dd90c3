"""Distinct counts from stored bitmaps, and JSON read as VARIANT."""

import datetime
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import distinct
from tillflow.operators.json_fields import flatten_json
from tillflow.operators.variants import bad_json, parse_columns, variant_fields


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def visits(n, seed, users=90_000):
    rng = random.Random(seed)
    # a third of the rows are one user's, users are spread over several bitmaps, some are null
    return [(rng.choice(["web", "app", None]), day(rng.randrange(70)), rng.choice(["u1", f"u{rng.randrange(users)}", f"u{rng.randrange(users)}", None]))
            for _ in range(n)]


def plain(facts, key):
    seen = {}
    for channel, d, user in facts:
        if user is not None:
            seen.setdefault(key(channel, d), set()).add(user)
    return {k: len(v) for k, v in seen.items()}


def counts(df, *cols):
    return {tuple(r[c] for c in cols): r.n for r in df.collect()}


def test_states_roll_up(spark, tmp_path):
    first, late = visits(90_000, 1, users=300_000), visits(4_000, 2)
    late = [(c, day(69), u) for c, _, u in late]
    schema = "channel string, day date, user string"
    facts = spark.createDataFrame(first, schema).repartition(6)
    numbers = distinct.number_entities(facts, "user")
    n_users = len({u for _, _, u in first if u})
    assert tuple(numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number"), F.count("user")).first()) == (1, n_users, n_users, n_users)
    path = str(tmp_path / "states")
    distinct.write_states(distinct.distinct_states(facts, numbers, "user", ["channel", "day"]), path)
    stored = spark.read.parquet(path)
    assert stored.select("bucket").distinct().count() > 1

    def check(all_facts):
        states = spark.read.parquet(path)
        assert counts(distinct.count_states(states, ["channel", "day"]), "channel", "day") == plain(all_facts, lambda c, d: (c, d))
        month = {"channel": F.col("channel"), "month": F.trunc("day", "MM")}
        assert counts(distinct.count_states(states, month), "channel", "month") == plain(all_facts, lambda c, d: (c, d.replace(day=1)))
        assert counts(distinct.count_states(states, {"month": F.trunc("day", "MM")}), "month") == plain(all_facts, lambda c, d: (d.replace(day=1),))
        assert counts(distinct.count_states(states)) == plain(all_facts, lambda c, d: ())

    check(first)
    # users that come in later get the next numbers; the day they came is replaced alone
    more = spark.createDataFrame(late, schema)
    grown = distinct.number_entities(more, "user", numbers)
    assert grown.join(numbers.withColumnRenamed("number", "old"), "user").filter("number != old").isEmpty()
    assert grown.count() == grown.select("number").distinct().count() == len({u for _, _, u in first + late if u})
    files = {f for f in spark.read.parquet(path).inputFiles() if "day=2024-01-05" in f}
    last_day = facts.filter(F.col("day") == day(69)).unionByName(more)
    distinct.write_states(distinct.distinct_states(last_day, grown, "user", ["channel", "day"]), path)
    check(first + late)
    assert {f for f in spark.read.parquet(path).inputFiles() if "day=2024-01-05" in f} == files


def test_states_of_nothing(spark):
    none = spark.createDataFrame([("web", day(0), None)], "channel string, day date, user string")
    numbers = distinct.number_entities(none, "user")
    states = distinct.distinct_states(none, numbers, "user", ["channel"])
    assert numbers.count() == 0 and states.count() == 0 and rows(distinct.count_states(states, ["channel"])) == []
    some = distinct.number_entities(none.withColumn("user", F.lit("a")), "user", numbers)
    assert rows(some) == [("a", 1)]


CASES = ['{"a": 1, "p": {"q": "x", "r": 1.5}}', '[{"a": 2, "p": {"q": "y"}}, {"a": 9}]', "[]", "{broken", '{"a": {"z": 1}, "p": 3}', '{"a": "12"}', None, '{"a": null}',
         '{"a": [1]}', '{"a": true}', '{"a": "[1]"}', '{"a": "{b}"}', "{}", "7", '"text"', "[[1]]", '{"a": 123456789012, "p": {"q": false}}', '{"a": "twelve"}']


@pytest.mark.parametrize("or_first", [True, False])
def test_variant_fields_equal_the_text_parser(spark, or_first):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, j string")
    fields = {"a": "bigint", "text": ("a", "string"), "flag": ("a", "boolean"), "q": ("p.q", "string"), "r": ("p.r", "double")}
    found = variant_fields(parse_columns(df, ["j"]), "j_v", fields, or_first_element=or_first).orderBy("i").collect()
    expected = flatten_json(df, "j", fields, or_first_element=or_first).orderBy("i").collect()
    for case, got, want in zip(CASES, found, expected, strict=True):
        assert [got[c] for c in fields] == [want[c] for c in fields], case


def test_strict_and_bad_rows(spark):
    df = parse_columns(spark.createDataFrame(list(enumerate(CASES)), "i int, j string"), ["j"])
    assert rows(bad_json(df, "j"), "i") == [(3,)]
    with pytest.raises(Exception, match="cannot be cast"):
        variant_fields(df, "j_v", {"a": "bigint"}, strict=True).collect()
    odd = spark.createDataFrame([('{"a b": 1, "c.d": 2}',)], "j string")
    assert variant_fields(parse_columns(odd, ["j"]), "j_v", {"x": ("a b", "int")}).first().x == 1


def test_each_text_is_parsed_once(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, j string")
    typed = variant_fields(parse_columns(df, ["j"]), "j_v", {f"f{i}": (f"p.f{i}", "bigint") for i in range(20)})
    plan = typed.select("i", *[f"f{i}" for i in range(20)])._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parse_json|parseJson", plan)) == 1


def test_variants_are_stored(spark, tmp_path):
    df = parse_columns(spark.createDataFrame(list(enumerate(CASES)), "i int, j string"), ["j"]).drop("j")
    df.write.parquet(str(tmp_path / "v"))
    back = variant_fields(spark.read.parquet(str(tmp_path / "v")), "j_v", {"a": "bigint"})
    assert "parse" not in back._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.a for r in back.orderBy("i").collect()][:3] == [1, 2, None]
