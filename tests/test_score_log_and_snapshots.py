"""Scoring that is stopped and taken up again, and tables refreshed by partition."""

import datetime
import glob
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillflow.operators.score_log import ScoreLog, score_pending, scored
from tillflow.sources.snapshots import PartitionedTable

OUT = StructType([StructField("label", StringType()), StructField("weight", DoubleType())])
ID = StructField("id", StringType())


def counting(folder, fails=lambda url, tries: False):
    """A model that notes every row it is asked for, and fails for some."""
    def model(batch: pd.DataFrame) -> pd.DataFrame:
        import os
        import uuid
        for url in batch["url"]:
            if fails(url, len([n for n in os.listdir(folder) if n.startswith(url + "-")])) and len(batch) == 1:
                open(f"{folder}/{url}-{uuid.uuid4().hex}", "w").close()
                raise ValueError(f"cannot read {url}")
            if fails(url, len([n for n in os.listdir(folder) if n.startswith(url + "-")])):
                raise ValueError("one of the batch")
        for url in batch["url"]:
            open(f"{folder}/{url}-{uuid.uuid4().hex}", "w").close()
        return pd.DataFrame({"label": "l" + batch["url"], "weight": batch["url"].str.len().astype(float)})
    return model


def asked(folder):
    return Counter(p.rsplit("/", 1)[1].split("-")[0] for p in glob.glob(f"{folder}/*"))


@pytest.fixture()
def creatives(spark):
    data = [(f"i{i}", f"u{i}" if i % 10 else None) for i in range(100)] + [("i1", "u1"), ("i1", "zz"), (None, "u5"), ("empty", "")]
    return spark.createDataFrame(data, "id string, url string").repartition(3)


def test_a_stopped_run_goes_on(spark, creatives, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    log = ScoreLog(spark, str(tmp_path / "log"), ID, OUT)
    assert score_pending(creatives, log, ["url"], "url", counting(str(seen)), batch_rows=10, max_batches=3) == 3
    part = set(asked(seen))
    assert 0 < len(part) < 90
    # a new process opens the log anew
    log = ScoreLog(spark, str(tmp_path / "log"), ID, OUT)
    assert score_pending(creatives, log, ["url"], "url", counting(str(seen)), batch_rows=10) > 0
    assert asked(seen) == {f"u{i}": 1 for i in range(100) if i % 10}
    assert score_pending(creatives, log, ["url"], "url", counting(str(seen)), batch_rows=10) == 0
    found = {r.id: r for r in log.latest().collect()}
    assert len(found) == 101 and found["i7"].label == "lu7" and found["i1"].label == "lu1"
    assert found["i10"].error == found["empty"].error == "missing input" and found["i10"].final
    # new and changed rows alone are scored
    more = creatives.filter("id in ('i2', 'i3')").withColumn("url", F.concat("url", F.lit("new"))).unionByName(creatives.filter("id = 'i4'"))
    assert score_pending(more, log, ["url"], "url", counting(str(seen)), batch_rows=10) == 1
    assert asked(seen)["u2new"] == 1 and asked(seen)["u4"] == 1
    shown = {r.id: r.label for r in scored(more, log, ["url"]).collect()}
    assert shown == {"i2": "lu2new", "i3": "lu3new", "i4": "lu4"}


def test_failures_are_retried_up_to_a_limit(spark, creatives, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    # u3 works the second time, u7 never does
    fails = lambda url, tries: url == "u3" and tries < 1 or url == "u7"
    log = ScoreLog(spark, str(tmp_path / "log"), ID, OUT, max_tries=3)
    score_pending(creatives, log, ["url"], "url", counting(str(seen), fails), batch_rows=30)
    found = {r.id: r for r in log.latest().collect()}
    assert (found["i3"].label, found["i3"].attempt, found["i3"].error) == ("lu3", 2, None)
    assert (found["i7"].label, found["i7"].attempt) == (None, 3) and "cannot read u7" in found["i7"].error
    assert asked(seen)["u7"] == 3 and asked(seen)["u3"] == 2 and asked(seen)["u8"] == 1
    assert score_pending(creatives, log, ["url"], "url", counting(str(seen), fails), batch_rows=30) == 0
    with pytest.raises(ValueError):
        ScoreLog(spark, str(tmp_path / "other"), StructField("error", StringType()), OUT)


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def files(table):
    return {f.rsplit("/", 3)[1] + "/" + f.rsplit("/", 1)[1]: f for f in table.read().inputFiles()}


def test_partitions_are_replaced_alone(spark, tmp_path):
    data = [(i, ["sg", "hk", None][i % 3], day(i % 5), i * 1.5) for i in range(300)]
    df = spark.createDataFrame(data, "id int, region string, day date, v double")
    table = PartitionedTable(spark, str(tmp_path / "t"), df.schema, ["region", "day"])
    assert table.version() == -1 and table.read().count() == 0
    assert table.replace(df) == 0
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(data, key=repr)
    before = set(table.partitions().collect())
    state = {r[0]: r for r in data}
    rng = random.Random(1)
    for version in range(1, 4):
        touched = {(rng.choice(["sg", "hk", None, "new"]), day(rng.randrange(6))) for _ in range(3)}
        state = {k: r for k, r in state.items() if (r[1], r[2]) not in touched}
        # one of the touched partitions stays empty
        for i, (region, d) in enumerate(sorted(touched, key=repr)[1:]):
            state[1000 * version + i] = (1000 * version + i, region, d, 0.5)
        marks = spark.createDataFrame(sorted(touched, key=repr), "region string, day date")
        rows = spark.createDataFrame([r for r in state.values() if (r[1], r[2]) in touched] or [], df.schema)
        assert table.replace(rows, marks) == version
        assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(state.values(), key=repr)
        after = set(table.partitions().collect())
        # untouched partitions are those of the same run as before
        assert {p for p in before if (p.region, p.day) not in touched} == {p for p in after if (p.region, p.day) not in touched}
        before = after
    assert table.read(0).count() == 300
    table.vacuum()
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(state.values(), key=repr)
    with pytest.raises(Exception):  # noqa: B017
        table.read(0).collect()


def test_a_failed_refresh_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, region string")
    table = PartitionedTable(spark, str(tmp_path / "t"), df.schema, ["region"])
    table.replace(df)
    with pytest.raises(ValueError, match="outside"):
        table.replace(df, df.filter("id = 1"))
    with pytest.raises(Exception):  # noqa: B017
        table.replace(df.withColumn("id", F.raise_error(F.lit("no")).cast("int")), df)
    assert table.version() == 0 and sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")]
    # another refresh took the next number while this one wrote
    slow = PartitionedTable(spark, str(tmp_path / "t"), df.schema, ["region"])
    slow.version = lambda: -1
    with pytest.raises(RuntimeError, match="another refresh"):
        slow.replace(df)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b")]


def test_a_rolling_extract(spark, tmp_path):
    schema = "id int, day date"
    rows = lambda *days: spark.createDataFrame([(i * 100 + d, day(d)) for d in days for i in range(3)], schema)
    table = PartitionedTable(spark, str(tmp_path / "t"), rows(0).schema, ["day"])
    content = lambda: sorted((r.id, r.day) for r in table.read().collect())
    table.roll(rows(*range(10)), day(4))
    assert content() == sorted((i * 100 + d, day(d)) for d in range(4, 10) for i in range(3))
    before = {p.day: p.run for p in table.partitions().collect()}
    # two days expire, two are new; what changed on an old day is not looked at
    table.roll(rows(*range(12)).withColumn("id", F.col("id") + 1), day(6))
    after = {p.day: p.run for p in table.partitions().collect()}
    assert sorted(after) == [day(d) for d in range(6, 12)] and all(after[day(d)] == before[day(d)] for d in range(6, 10))
    assert content() == sorted((i * 100 + d + (d > 9), day(d)) for d in range(6, 12) for i in range(3))
    # late changes: the last days anew, and one that has no rows any more goes
    table.roll(rows(8, 10), day(6), changed_since=day(9))
    assert content() == sorted((i * 100 + d, day(d)) for d in (6, 7, 8, 10) for i in range(3))
    with pytest.raises(ValueError, match="one day"):
        PartitionedTable(spark, str(tmp_path / "u"), rows(0).schema, ["day", "id"]).roll(rows(1), day(0))
