"""What is moved between tasks: keys that are computed once, names that need no hub, days that arise last."""

import csv
import io
import tracemalloc

import pyarrow.fs
from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.catalog import QUERIES
from tillflow.operators import row_diff
from tillflow.sources import sheets


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_a_json_key_is_read_before_the_join(spark):
    joins = [line for line in plan_of(QUERIES["JN16_json_key"](spark, SF)) if "Join " in line]
    assert joins and not any("json" in line.lower() for line in joins)


def test_new_campaigns_read_one_channel(spark):
    plan = "\n".join(plan_of(QUERIES["JB76_new_campaigns"](spark, SF)))
    # rows of the other channels and all sums are gone
    assert "l_linestatus" in plan and "o_totalprice" not in plan and "sum(" not in plan


def test_small_buckets_are_compared_at_once(spark, monkeypatch):
    wide = spark.range(20_000).selectExpr("if(id % 3 = 0, null, cast(id % 2 as int)) as b", "cast(id % 5000 as string) as k", "id as v")
    other = wide.filter("v % 1000 != 7").unionByName(wide.filter("v % 900 = 1")).unionByName(wide.filter("v % 1700 = 3").withColumn("v", F.col("v") + 100_000))
    marked = wide.selectExpr("*", "1 as l", "0 as r").unionByName(other.selectExpr("*", "0 as l", "1 as r"))
    counts = marked.groupBy("b", "k", "v").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    keys = counts.groupBy("b", "k").agg(F.sum("l").alias("kl"), F.sum("r").alias("kr")).withColumnsRenamed({"b": "b2", "k": "k2"})
    both = counts.filter("l != r").join(keys, F.expr("b <=> b2 and k <=> k2"))
    kind = F.expr("case when l > 0 and r > 0 then 'repeated' when kr = 0 then 'left only' when kl = 0 then 'right only' else 'changed' end")
    wanted = sorted(map(tuple, both.select("b", "k", "v", "l", "r", kind).collect()), key=repr)
    assert spark.range(1).select(row_diff.cells_of(F.lit(1200), 256), row_diff.cells_of(F.lit(50_000_000), 256)).first() == (1, 256)
    for rows in (4096, 50):
        monkeypatch.setattr(row_diff, "CELL_ROWS", rows)
        got = row_diff.differing_rows(wide, other, ["b"], ["k"])
        assert sorted(map(tuple, got.collect()), key=repr) == wanted


def test_a_part_of_a_sheet_is_read_as_a_stream(tmp_path):
    text = "﻿a,b\n" + "".join(f'{i},"line {i}\nof ""é"" and\r\nmore"\n' for i in range(120_000))
    (tmp_path / "sheet.csv").write_bytes(text.encode())
    wanted = list(csv.reader(io.StringIO(text[1:], newline="")))
    system = pyarrow.fs.LocalFileSystem()
    parts, _ = sheets.split_file(system, str(tmp_path / "sheet.csv"), 1, 1 << 20)
    with system.open_input_file(str(tmp_path / "sheet.csv")) as file:
        assert len(parts) > 2 and [r for p in parts for r in sheets.records(sheets._Stretch(file, p.start, p.end), 1000)] == wanted
    reader = sheets.SheetReader(str(tmp_path / "sheet.csv"), StructType.fromDDL("a long, b string"), {"splitbytes": str(1 << 30)})
    whole, = reader.partitions()
    tracemalloc.start()
    n = sum(1 for _ in reader.read(whole))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 120_000 and most < 3 << 20 < whole.end
