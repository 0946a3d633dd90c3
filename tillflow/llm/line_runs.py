"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.writers import drop_stage, materialise, stage
from .pieces import slices, unused

_WHITE = b" \t\n\x0b\x0c\r"
_NULL = -(1 << 63)
_KEY = ["h1", "h2"]
# what tells rows apart: the id, and 64 hash bits of the text where ids are repeated
_ROW = ["id", "version"]


def line_keys(text: str | None, least: int) -> list[bytes | None]:
    """For each line of the text 128 hash bits of its key, None for a key of fewer than ``least`` code points."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(_WHITE)
        long = len(key) >= least and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= least)
        out.append(xxhash.xxh3_128_digest(key.lower()) if long else None)
    return out


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)


def _key_rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [list({k for k in line_keys(t, least) if k}) for t in batch.column(3).to_pylist()]
            each = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in found]))
            halves = _halves([k for x in found for k in x])
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(each) for i in range(3)], pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                                             ["batch", *_ROW, *_KEY])
    return run


class LineRuns:
    """Sorted immutable runs of (line hash, documents, holder) in levels.

    Each batch of documents becomes one run of level 0. Its keys are merge-anti-joined with the holders of all runs: a key that no earlier batch had
    is held by the batch's largest id, of any other only the number of documents is added. When a level has ``fanout`` runs, they are
    compacted into one run of the next. So n batches leave about fanout * log(n) runs, and each entry is rewritten about log(n) times. Every
    key has one holder over all runs. Batches must come in descending order of id for the holder to be the largest.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def entries(self, paths: list[str] | None = None) -> DataFrame | None:
        """The entries of some runs, or of all."""
        paths = [p for level in self.levels for p in level] if paths is None else paths
        return self.spark.read.parquet(*paths) if paths else None

    def _write(self, entries: DataFrame) -> str:
        return stage(entries.sortWithinPartitions(*_KEY))

    def add(self, keys: DataFrame) -> None:
        """Add a batch: one row (id, h1, h2) for each document and key."""
        own = keys.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("holder"))
        known = self.entries()
        if known is not None:
            own = materialise(own)
            held = known.filter("holder is not null").select(*_KEY)
            fresh = own.join(held, _KEY, "left_anti")
            old = own.join(held, _KEY, "left_semi").withColumn("holder", F.lit(None).cast("long"))
            own = fresh.union(old)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(own))
        for at in range(len(self.levels)):
            if len(self.levels[at]) >= self.fanout:
                self._compact(at)

    def _merged(self, paths: list[str] | None = None) -> DataFrame:
        return self.entries(paths).groupBy(*_KEY).agg(F.sum("documents").alias("documents"), F.max("holder").alias("holder"))

    def _compact(self, at: int) -> None:
        old = self.levels[at]
        if at + 1 == len(self.levels):
            self.levels.append([])
        self.levels[at + 1].append(self._write(self._merged(old)))
        self.levels[at] = []
        for path in old:
            drop_stage(self.spark, path)

    def frequent(self, documents: int) -> DataFrame:
        """The keys (h1, h2, holder) found in at least so many documents."""
        return self._merged().filter(F.col("documents") >= documents).drop("documents")


def repeated_lines(docs: DataFrame, least_chars: int = 40, documents: int = 5, batches: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per id and text that lose lines: ``id`` (null ids as the smallest number), ``version`` (a hash of the text, which tells rows with equal ids
    apart) and ``gone``, the hashes of the text's keys whose lines go, each once.

    The documents are cut into ``batches`` by ranges of the id and added in descending order. A key that goes from one row goes from all with the same id,
    so texts of one id with equal hashes, which share an array, still lose the right lines.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(_NULL)).cast("long").alias("id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    # where to cut the batches need not be exact
    parts = [i / batches for i in range(1, batches)]
    cuts = sorted(set(rows.select("id").approxQuantile("id", parts, 0.01))) if parts else []
    number = sum((F.when(F.col("id") < F.lit(c).cast("long"), 1).otherwise(0) for c in cuts), F.lit(0))
    keyed = rows.select(number.cast("int").alias("batch"), *_ROW, "text")
    keyed = materialise(keyed.mapInArrow(_key_rows(least_chars), "batch int, id long, version long, h1 long, h2 long"))
    runs = LineRuns(spark)
    for at in range(len(cuts) + 1):
        runs.add(keyed.filter(F.col("batch") == at).select("id", *_KEY))
    frequent = materialise(runs.frequent(documents))
    gone = keyed.join(frequent, _KEY).filter("id < holder")
    return gone.groupBy(*_ROW).agg(F.collect_set(F.struct(*_KEY)).alias("gone"))


def _drop(least: int, names: list[str], at: int, counts_as: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts, dropped = [], [], []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1), strict=True):
                text = text or ""
                n, lost = text.count("\n") + 1, 0
                if gone.is_valid:
                    halves = np.stack([gone.values.field(i).to_numpy() for i in range(2)], axis=1)
                    keys = {row.tobytes() for row in halves.astype("<i8")}
                    lines = text.split("\n")
                    kept = [x for x, k in zip(lines, line_keys(text, least), strict=True) if k not in keys]
                    text, lost = "\n".join(kept), n - len(kept)
                texts.append(text)
                counts.append(n)
                dropped.append(lost)
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], [*names, *counts_as])
    return run


def dedup_lines(docs: DataFrame, least_chars: int = 40, documents: int = 5, batches: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all columns, their text without repeated lines, and ``_n_lines`` (before) and ``_n_dropped``,
    with more underscores where ``docs`` have columns of these names.

    A line's key is the line without ASCII white space at both ends, A-Z in lower case. Lines whose key has at least ``least_chars`` code points and stands
    in at least ``documents`` documents go, except in the largest id that holds it. Keys are compared by 128 hash bits.

    A null or empty text is one empty line. Each row counts as a document; of rows with the largest id that holds a line all keep it; null ids
    are smaller than any other; an empty table gives no rows. A line that stands in very many documents is combined before the shuffle, and joined
    back by a join that can be split; rows with one id, or none, are told apart by their texts, so a row is joined with at most its own keys.
    """
    names = docs.columns
    n_lines, n_dropped, own, version, lost = unused(names, "_n_lines", "_n_dropped", "_id", "_version", "_gone")
    gone = materialise(repeated_lines(docs, least_chars, documents, batches, id_col, text))
    gone = gone.withColumnsRenamed({"id": own, "version": version, "gone": lost})
    # a merge join at every size: the texts are shuffled once, in proportion to the input
    same = (F.coalesce(F.col(id_col), F.lit(_NULL)).cast("long") == F.col(own)) & (F.xxhash64(F.col(text)) == F.col(version))
    joined = docs.join(gone.hint("merge"), same, "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {n_lines} long, {n_dropped} long"
    drop = _drop(least_chars, names, names.index(text), [n_lines, n_dropped])
    return joined.select(*[f"`{c}`" for c in names], lost).mapInArrow(drop, schema)


ORACLE = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
frequent as (
  select key, max(doc_id) as holder from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
judged as (
  select k.*, f.key is not null and k.doc_id <> f.holder as gone from keyed k left join frequent f on k.key = f.key)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
