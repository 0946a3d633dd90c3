"""The sheet source and sink: ranges, types, bad cells, quoted line breaks over parts, commit and abort."""

import csv
import datetime as dt
import os
import random
from decimal import Decimal

import pyarrow.fs as fs
import pytest
from conftest import rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tillflow.sources import sheets

AWKWARD = ["plain", "a,b", 'say "so"', "two\nlines", "", "dos\r\nlines", '"', "ünï", "\n\n", ",,\n\"\"\n", " blank "]


def write(path, records):
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows(records)
    return str(path)


def test_range_reads_exactly_its_cells(spark, tmp_path):
    table = [[f"title {i}"] for i in range(2)] + [["x", "id", "name", "amount", "y"]]
    table += [["out", str(i), f"n{i}", f"{i / 4}", "out"] for i in range(50)] + [["", "total", "", "wrong", ""]]
    path = write(tmp_path / "sheet.csv", table)
    found = sheets.read_sheet(spark, path, "id long, name string, amount double", "B3:D53")
    assert rows(found) == sorted((i, f"n{i}", i / 4) for i in range(50))
    part = sheets.read_sheet(spark, path, "id int, name string", "B10:C12", header=False)
    assert rows(part) == [(6, "n6"), (7, "n7"), (8, "n8")]
    # without a last row the total's cells are part of the range, and its text is no number
    with pytest.raises(PySparkException, match="cell B54 .*'total' is no bigint"):
        sheets.read_sheet(spark, path, "id long, name string, amount double", "B3:D").collect()
    report = sheets.bad_cells(spark, path, "id long, name string, amount double", "B3:D")
    assert rows(report) == [(54, "B54", "total", "bigint"), (54, "D54", "wrong", "double")]
    given = sheets.read_sheet(spark, path, "id long, name string, amount double", "B3:D", bad_cells="null")
    assert given.count() == 51 and given.filter("id is null and amount is null").count() == 1


def test_a_wide_range_of_many_rows(spark, tmp_path):
    """``A3:H42357``: two title rows, a header in row 3, data until row 42357, notes below."""
    table = [["made for the audit"], []] + [[f"c{i}" for i in range(8)] + ["note"]]
    table += [[str(r * 8 + i) for i in range(8)] + ["never read"] for r in range(42_354)] + [["sum", "of", "all"]] * 3
    path = write(tmp_path / "wide.csv", table)
    sheets.register(spark)
    schema = ", ".join(f"c{i} long" for i in range(8))
    found = spark.read.format("sheet").schema(schema).option("range", "A3:H42357").option("splitBytes", "100000").load(path)
    assert found.rdd.getNumPartitions() > 10
    n = 42_354
    sums = found.agg(F.count("*"), *[F.sum(f"c{i}") for i in range(8)]).first()
    assert tuple(sums) == (n, *[8 * n * (n - 1) // 2 + i * n for i in range(8)])


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
@pytest.mark.parametrize("split", [1, 50, 1000, 1 << 20])
def test_parts_begin_with_records(tmp_path, split, block):
    rng = random.Random(split + block)
    for end in ("\n", "\r\n"):
        table = [[rng.choice(AWKWARD) for _ in range(rng.randrange(0, 5))] for _ in range(200)]
        path = tmp_path / "parts.csv"
        with open(path, "w", encoding="utf-8", newline="") as out:
            csv.writer(out, lineterminator=end).writerows(table)
        parts, after = sheets.split_file(fs.LocalFileSystem(), str(path), 5, split, block)
        data = path.read_bytes()
        assert [p.start for p in parts] == [0, *[p.end for p in parts[:-1]]] and parts[-1].end == len(data)
        assert after == 205
        read, expected = [], list(csv.reader(open(path, encoding="utf-8", newline="")))
        for p in parts:
            assert p.row == 5 + len(read)
            read += list(sheets.records(data[p.start:p.end]))
        assert read == expected
    empty = tmp_path / "empty.csv"
    empty.write_bytes(b"")
    assert sheets.split_file(fs.LocalFileSystem(), str(empty), 1, split, block) == ([], 1)
    empty.write_bytes(b"a,b\nc,d")
    parts, after = sheets.split_file(fs.LocalFileSystem(), str(empty), 1, split, block)
    assert after == 3 and sum(p.end - p.start for p in parts) == 7


def test_types(spark, tmp_path):
    kinds = "l long, i int, d double, b boolean, t date, s timestamp, m decimal(8,2), x string"
    path = write(tmp_path / "types.csv", [["h"] * 8, ["1,234", "7.0", "1,000.5", "TRUE", "2024-02-29", "2024-02-29 10:11:12", "12.5", "a"], [""] * 8,
                                          ["9223372036854775808", "2147483648", "x", "yes", "2023-02-29", "noon", "1.234", "b"]])
    good = sheets.read_sheet(spark, path, kinds, "A1:H3").collect()
    assert tuple(good[0]) == (1234, 7, 1000.5, True, dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 10, 11, 12), Decimal("12.50"), "a")
    assert tuple(good[1]) == (None,) * 8
    bad = sheets.bad_cells(spark, path, kinds, "A1:H4")
    assert sorted(r.cell for r in bad.collect()) == [f"{c}4" for c in "ABCDEFG"]


def test_write_and_read_back(spark, tmp_path):
    data = [(i, AWKWARD[i % len(AWKWARD)] or None, i / 3, dt.date(2024, 1, 1) + dt.timedelta(i), i % 2 == 0) for i in range(500)]
    df = spark.createDataFrame(data, "id long, text string, part double, day date, flag boolean").repartition(5)
    path = str(tmp_path / "out")
    sheets.write_sheet(df, path)
    assert rows(sheets.read_sheet(spark, path, df.schema.simpleString()[7:-1].replace(":", " "))) == sorted(data)
    assert not any(n.startswith("_temporary") for n in os.listdir(path))
    sheets.write_sheet(df.filter("id < 3"), path)
    again = lambda: sheets.read_sheet(spark, path, "id long, text string, part double, day date, flag boolean")
    assert sorted(r.id for r in again().collect()) == [0, 1, 2]
    sheets.write_sheet(df.filter("id in (3, 4)"), path, mode="append")
    assert sorted(r.id for r in again().collect()) == [0, 1, 2, 3, 4]
    sheets.write_sheet(df.limit(0), path)
    assert again().collect() == [] and len(os.listdir(path)) == 1


def test_a_failed_write_leaves_the_old_sheet(spark, tmp_path):
    path = str(tmp_path / "out")
    sheets.write_sheet(spark.range(10), path)
    before = sorted(os.listdir(path))
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):  # noqa: B017
        sheets.write_sheet(broken, path)
    assert sorted(os.listdir(path)) == before
    assert sorted(r.id for r in sheets.read_sheet(spark, path, "id long").collect()) == list(range(10))


@pytest.mark.parametrize("cells", ["A3", "B2:A9", "A9:B2", "A0:B2", "3:7", ""])
def test_ranges_that_are_none(cells):
    with pytest.raises(ValueError):
        sheets.CellRange.parse(cells)


def test_letters():
    assert [sheets.column_number(x) for x in ("A", "Z", "AA", "AZ", "BA", "ZZ", "AAA")] == [0, 25, 26, 51, 52, 701, 702]
    assert all(sheets.column_number(sheets.column_letters(i)) == i for i in range(2000))
    assert sheets.CellRange.parse("$A$3:h42357") == sheets.CellRange(0, 3, 7, 42357)


def test_wrong_use_is_an_error(spark, tmp_path):
    path = write(tmp_path / "s.csv", [["a"], ["1"]])
    sheets.register(spark)
    with pytest.raises((AnalysisException, PySparkException)):
        spark.read.format("sheet").load(path).collect()
    with pytest.raises((AnalysisException, PySparkException)):
        sheets.read_sheet(spark, path, "a long, b long", "A1:A2").collect()
    with pytest.raises((AnalysisException, PySparkException)):
        sheets.read_sheet(spark, str(tmp_path / "none.csv"), "a long").collect()
