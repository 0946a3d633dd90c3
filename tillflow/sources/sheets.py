"""Spreadsheet exports as a data source: cell ranges, typed cells with addresses, and a sink that commits whole.

    register(spark)
    spark.read.format("sheet").schema("id long, amount double").option("range", "A3:H42357").load(path)
    frame.write.format("sheet").mode("overwrite").save(path)

A sheet is a file of comma-separated records in UTF-8, or a folder of such files in the order of their names. Cells with commas, quotes or line breaks
stand in double quotes, a quote inside is doubled. Paths are local or any URI that Arrow's file systems open.
"""

from __future__ import annotations

import csv
import datetime as dt
import decimal
import io
import json
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType,
                               TimestampType)

_RANGE = re.compile(r"([A-Z]+)([0-9]+):([A-Z]+)([0-9]*)").fullmatch
REPORT = "row long, cell string, text string, wanted string"


def column_number(letters: str) -> int:
    """A is 0, Z 25, AA 26."""
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n - 1


def column_letters(number: int) -> str:
    out = ""
    while number >= 0:
        out, number = chr(65 + number % 26) + out, number // 26 - 1
    return out


@dataclass(frozen=True)
class CellRange:
    """Columns ``left`` to ``right`` from 0, rows ``top`` to ``bottom`` from 1; no bottom reads to the end."""

    left: int
    top: int
    right: int
    bottom: int | None

    @classmethod
    def parse(cls, text: str) -> CellRange:
        found = _RANGE(text.upper().replace("$", ""))
        if not found:
            raise ValueError(f"no cell range: {text!r}, wanted such as A3:H42357 or A3:H")
        left, top, right, bottom = found.groups()
        made = cls(column_number(left), int(top), column_number(right), int(bottom) if bottom else None)
        if made.right < made.left or made.top < 1 or (made.bottom is not None and made.bottom < made.top):
            raise ValueError(f"the cell range {text!r} ends before it begins")
        return made


def _flag(text: str) -> bool:
    if text.strip().lower() in ("true", "false"):
        return text.strip().lower() == "true"
    raise ValueError(text)


def _number(text: str) -> int:
    # an export may write whole numbers with separators or a fraction of zeros
    value = decimal.Decimal(text.replace(",", "").strip())
    if value != value.to_integral_value():
        raise ValueError(text)
    return int(value)


def _bounded(bits: int) -> Callable[[str], int]:
    def read(text: str) -> int:
        value = _number(text)
        if not -(1 << bits - 1) <= value < 1 << bits - 1:
            raise ValueError(text)
        return value
    return read


def cell_parser(kind: DataType) -> Callable[[str], object]:
    """A function from a cell's text to a value of the type; it raises ValueError or ArithmeticError on text that does not fit."""
    if isinstance(kind, StringType):
        return str
    if isinstance(kind, LongType):
        return _bounded(64)
    if isinstance(kind, IntegerType):
        return _bounded(32)
    if isinstance(kind, (DoubleType, FloatType)):
        return lambda text: float(text.replace(",", ""))
    if isinstance(kind, BooleanType):
        return _flag
    if isinstance(kind, DateType):
        return lambda text: dt.date.fromisoformat(text.strip())
    if isinstance(kind, TimestampType):
        return lambda text: dt.datetime.fromisoformat(text.strip())
    if isinstance(kind, DecimalType):
        unit = decimal.Decimal(1).scaleb(-kind.scale)

        def exact(text: str) -> decimal.Decimal:
            value = decimal.Decimal(text.replace(",", "").strip())
            if value != value.quantize(unit) or abs(value) >= decimal.Decimal(10) ** (kind.precision - kind.scale):
                raise ValueError(text)
            return value.quantize(unit)
        return exact
    raise ValueError(f"a sheet has no cells of type {kind.simpleString()}")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    """The sheet's files in order, hidden ones left out."""
    system, root = _open(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [root]
    found = system.get_file_info(fs.FileSelector(root))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name[:1] not in "._")


@dataclass
class Part(InputPartition):
    """Records that begin in bytes [start, end) of a file; the first of them is row ``row`` of the sheet."""

    file: str
    start: int
    end: int
    row: int


def split_file(system: fs.FileSystem, file: str, first_row: int, split_bytes: int, block: int = 8 << 20) -> tuple[list[Part], int]:
    """Parts of about ``split_bytes`` that begin with a record, and the number of the row after the file.

    A line break ends a record if an even number of quotes stands before it. One pass over the bytes in blocks counts both, so a part knows its
    first row and needs nothing of the parts before it.
    """
    parts: list[Part] = []
    start, row, start_row, quotes, at = 0, first_row, first_row, 0, 0
    with system.open_input_stream(file) as stream:
        while data := stream.read(block):
            found = np.frombuffer(data, np.uint8)
            inside = (np.cumsum(found == 34) + quotes) & 1
            ends = np.flatnonzero((found == 10) & (inside == 0)) + 1
            quotes = int(inside[-1])
            for cut in np.flatnonzero(np.diff((ends + at) // split_bytes, prepend=at // split_bytes)) if len(ends) else ():
                end = int(ends[cut]) + at
                if end - start >= split_bytes:
                    parts.append(Part(file, start, end, start_row))
                    start, start_row = end, row + int(cut) + 1
            row += len(ends)
            last_break = bool(len(ends)) and int(ends[-1]) == len(found)
            at += len(found)
    if at > start:
        parts.append(Part(file, start, at, start_row))
        # a last record without a line break
        row += 0 if last_break else 1
    return parts, row


class _Stretch(io.RawIOBase):
    """Bytes [start, end) of an open file as a stream, so that a reader holds one buffer and not the part."""

    def __init__(self, file, start: int, end: int):
        self.file, self.at, self.end = file, start, end

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read_at(max(0, min(len(buffer), self.end - self.at)), self.at)
        buffer[:len(data)] = data
        self.at += len(data)
        return len(data)


def records(source: bytes | io.RawIOBase, buffer: int = 1 << 18) -> Iterator[list[str]]:
    stream = io.BytesIO(source) if isinstance(source, bytes) else io.BufferedReader(source, buffer)
    return csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""))


class SheetReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict[str, str]):
        self.path, self.schema = path, schema
        self.cells = CellRange.parse(options["range"]) if options.get("range") else CellRange(0, 1, 1 << 20, None)
        self.header = options.get("header", "true").lower() == "true"
        self.bad = options.get("badcells", "error").lower()
        if self.bad not in ("error", "null", "report"):
            raise ValueError(f"badCells is error, null or report, not {self.bad!r}")
        self.split = int(options.get("splitbytes", 16 << 20))
        self.wanted = StructType.fromJson(json.loads(options["cells"])) if self.bad == "report" else schema
        if options.get("range") and len(self.wanted) > self.cells.right - self.cells.left + 1:
            raise ValueError(f"the range has {self.cells.right - self.cells.left + 1} columns, the schema {len(self.wanted)}")

    def partitions(self) -> list[Part]:
        system, _ = _open(self.path)
        parts, row = [], 1
        for file in _files(self.path):
            found, row = split_file(system, file, row, self.split)
            parts += found
        # parts below the range are not read at all; a part above it is told by the first row of the next
        following = [p.row for p in parts[1:]] + [row]
        first, last = self.cells.top, self.cells.bottom
        return [p for p, after in zip(parts, following, strict=True) if after > first and (last is None or p.row <= last)]

    def read(self, part: Part) -> Iterator[tuple]:
        system, _ = _open(self.path)
        names, parsers = self.wanted.names, [cell_parser(f.dataType) for f in self.wanted]
        kinds = [f.dataType.simpleString() for f in self.wanted]
        left = self.cells.left
        with system.open_input_file(part.file) as file:
            for row, record in enumerate(records(_Stretch(file, part.start, part.end)), part.row):
                if row < self.cells.top or (self.header and row == self.cells.top):
                    continue
                if self.cells.bottom is not None and row > self.cells.bottom:
                    return
                given = record[left:min(self.cells.right + 1, left + len(names))]
                # short records have empty cells; an empty cell is null
                given += [""] * (len(names) - len(given))
                out = []
                for i, (text, parse) in enumerate(zip(given, parsers, strict=True)):
                    if text == "":
                        out.append(None)
                        continue
                    try:
                        out.append(parse(text))
                    except (ValueError, ArithmeticError):
                        cell = f"{column_letters(left + i)}{row}"
                        if self.bad == "error":
                            raise ValueError(f"cell {cell} of {part.file}: {text!r} is no {kinds[i]} ({names[i]})") from None
                        if self.bad == "report":
                            yield row, cell, text, kinds[i]
                        out.append(None)
                if self.bad != "report":
                    yield tuple(out)


@dataclass
class Written(WriterCommitMessage):
    """A part file that a task has written."""

    name: str
    rows: int


class SheetWriter(DataSourceWriter):
    """Tasks write to a folder of this job below ``_temporary``; the commit moves its files to the sheet, an abort deletes the folder."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.names, self.overwrite = path.rstrip("/"), schema.names, overwrite
        self.kinds = [f.dataType for f in schema]
        for kind in self.kinds:
            cell_parser(kind)
        self.job = uuid.uuid4().hex

    def _folder(self) -> tuple[fs.FileSystem, str, str]:
        system, root = _open(self.path)
        return system, root, f"{root}/_temporary/{self.job}"

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext
        context = TaskContext.get()
        system, _, temporary = self._folder()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        system.create_dir(temporary, recursive=True)
        rows = 0
        with system.open_output_stream(f"{temporary}/{name}") as out:
            text = io.TextIOWrapper(out, "utf-8", newline="", write_through=False)
            sheet = csv.writer(text, lineterminator="\n")
            for row in iterator:
                sheet.writerow(["" if v is None else str(v).lower() if isinstance(v, bool) else v.isoformat(" ") if isinstance(v, dt.datetime) else v for v in row])
                rows += 1
            text.flush()
            text.detach()
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, root, temporary = self._folder()
        old = [f for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File and f.base_name[:1] not in "._"]
        first = io.StringIO(newline="")
        csv.writer(first, lineterminator="\n").writerow(self.names)
        # the parts of one job sort behind its header, and behind what an earlier job appended
        stamp = f"{len(old) if not self.overwrite else 0:09d}-{self.job[:8]}"
        if self.overwrite or not old:
            system.create_dir(temporary, recursive=True)
            with system.open_output_stream(f"{temporary}/header") as out:
                out.write(first.getvalue().encode())
            moves = [("header", f"{stamp}-000000.csv")]
        else:
            moves = []
        moves += [(m.name, f"{stamp}-{i + 1:06d}.csv") for i, m in enumerate(sorted((m for m in messages if m and m.rows), key=lambda m: m.name))]
        if self.overwrite:
            for f in old:
                system.delete_file(f.path)
        for source, target in moves:
            system.move(f"{temporary}/{source}", f"{root}/{target}")
        system.delete_dir(temporary)
        self._drop_empty(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        system, root, temporary = self._folder()
        if system.get_file_info(temporary).type == fs.FileType.Directory:
            system.delete_dir(temporary)
        self._drop_empty(system, root)

    @staticmethod
    def _drop_empty(system: fs.FileSystem, root: str) -> None:
        folder = f"{root}/_temporary"
        if system.get_file_info(folder).type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(folder)):
            system.delete_dir(folder)


class SheetSource(DataSource):
    """Format ``sheet``. Options: ``range`` (A3:H42357, or A3:H to the end), ``header`` (the range's first row names the columns and is no data;
    default true), ``badCells`` (error, null or report), ``cells`` (for a report: the wanted schema as JSON), ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> StructType | str:
        if self.options.get("badcells", "").lower() == "report":
            return REPORT
        raise ValueError("a sheet is read with a schema")

    def reader(self, schema: StructType) -> SheetReader:
        return SheetReader(self.options["path"], schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> SheetWriter:
        return SheetWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session. Spark looks formats up in the thread's active session, so to that one too."""
    spark.dataSource.register(SheetSource)
    active = SparkSession.getActiveSession()
    if active is not None and active._jsparkSession.sessionUUID() != spark._jsparkSession.sessionUUID():
        active.dataSource.register(SheetSource)


def read_sheet(spark: SparkSession, path: str, schema: str, cells: str | None = None, header: bool = True, bad_cells: str = "error") -> DataFrame:
    """The cells of a range with the schema's types. A cell that does not fit is an error that names it, or NULL with ``bad_cells="null"``."""
    register(spark)
    reader = spark.read.format("sheet").schema(schema).option("header", str(header)).option("badCells", bad_cells)
    return (reader if cells is None else reader.option("range", cells)).load(path)


def bad_cells(spark: SparkSession, path: str, schema: str, cells: str | None = None, header: bool = True) -> DataFrame:
    """(row, cell, text, wanted): the cells of the range that do not fit the schema."""
    register(spark)
    reader = spark.read.format("sheet").option("header", str(header)).option("badCells", "report").option("cells", StructType.fromDDL(schema).json())
    return (reader if cells is None else reader.option("range", cells)).load(path)


def write_sheet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the rows behind a header row; readers see the old sheet until the commit, and all of the new one after it has moved the parts."""
    register(df.sparkSession)
    df.write.format("sheet").mode(mode).save(path)
