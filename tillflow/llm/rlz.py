"""Substring dedup by relative Lempel-Ziv parsing of documents against all earlier ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.writers import materialise
from .pieces import slices, unused

_ONE = 1 << 64
_SEED = np.random.default_rng(1851)
_BYTE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_NULL = -(1 << 63)


class _Rolling:
    """Hashes of spans modulo 2^64 from running sums, the same wherever the same items stand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, _ONE)
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, items: np.ndarray) -> np.ndarray:
        while len(self.up) <= len(items):
            n = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, n, _ONE))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, n, _ONE))])
        out = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(items * self.up[:len(items)], out=out[1:])
        return out

    def spans(self, items: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums(items)
        return _mixed((sums[end] - sums[begin]) * self.down[begin])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_LETTERS, _GRAMS, _LOW, _HIGH = (_Rolling(b) for b in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5))


def word_hashes(data: bytes, part: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of every word; a long text is read in parts that end at white space."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + part)
        while end < len(data) and not _WHITE[data[end]]:
            end += 1
        codes = np.frombuffer(data[at:end] + b" ", np.uint8)
        inside = np.concatenate([[False], ~_WHITE[codes]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, stop = edges[0::2], edges[1::2]
        spans = _LETTERS.spans(_BYTE[codes], begin, stop)
        out.append(_mixed(spans + (stop - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor of every window: the lowest hash of its ``gram`` neighbouring words, so equal windows have equal anchors."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    begin = np.arange(len(words) - gram + 1)
    return _lowest(_GRAMS.spans(words, begin, begin + gram), window - gram + 1)


def _text(value: str | None) -> bytes:
    return (value or "").encode("utf-8", "surrogatepass")


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [np.unique(anchors(word_hashes(_text(t)), window, gram)) for t in batch.column(2).to_pylist()]
            each = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(each)), batch.column(1).take(pa.array(each)),
                                              pa.array(np.concatenate(found).view(np.int64))], ["id", "version", "anchor"])
    return run


def _window_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            each, places, low, high = [], [], [], []
            for row, (text, shared) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3), strict=True)):
                words = word_hashes(_text(text))
                begin = np.flatnonzero(np.isin(anchors(words, window, gram), shared.values.to_numpy().view(np.uint64)))
                each.append(np.full(len(begin), row))
                places.append(begin)
                low.append(_LOW.spans(words, begin, begin + window))
                high.append(_HIGH.spans(words, begin, begin + window))
            low, high, places, each = (np.concatenate(x) for x in (low, high, places, each))
            yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), batch.column(0).take(pa.array(each)),
                                              batch.column(1).take(pa.array(each)), pa.array(places.astype(np.int32))],
                                             ["low", "high", "id", "version", "place"])
    return run


def factors(places: np.ndarray, blocks: np.ndarray, block_places: np.ndarray, window: int) -> list[dict]:
    """Greedy factors from the windows of one document that an earlier document holds, in order of place.

    A factor grows as long as the next window is held by the same reference at the next place. Where the reference changes, the windows over the
    boundary have been looked up as well, so the next factor begins inside the last one and no covered word is lost.
    """
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (blocks[1:] != blocks[:-1]) | (np.diff(block_places) != 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(places)))
    return [{"start": int(places[b]), "words": int(n) + window - 1, "reference": int(blocks[b]), "reference_start": int(block_places[b])}
            for b, n in zip(begin, count, strict=True)]


_FACTORS = "array<struct<start: int, words: int, reference: long, reference_start: int>>"


def _factor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("reference", pa.int64()), ("reference_start", pa.int32())]))
        for batch in slices(batches, 256):
            rows = []
            for held in batch.column(2):
                fields = [held.values.field(i).to_numpy() for i in range(3)]
                order = np.argsort(fields[0], kind="stable")
                rows.append(factors(*(f[order] for f in fields), window))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, kind)], ["id", "version", "factors"])
    return run


# what tells rows apart: the id, and 64 hash bits of the text where ids are repeated
_ROW = ["id", "version"]


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col), F.lit(_NULL)).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text"))


def parse(docs: DataFrame, window: int = 50, gram: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs`` with any: ``id``, ``version`` (a hash of the text, which tells rows with equal ids apart) and ``factors`` of at least
    ``window`` words that stand in documents with a smaller id.

    The reference is every smaller document. Its index holds windows of words by 128 hash bits with the smallest id and its first place, and only windows
    that can occur twice are entered: a window's anchor, its lowest word-gram hash, is counted over all documents first (about one row per 22 words), and
    windows whose anchor stands in one document alone are left out. Documents with equal texts are entered once, by the smallest id; the others
    are one factor of it. The smallest holder of a window comes from an aggregate that combines before the shuffle and is joined back by a join
    that can be split, so a passage in very many documents loads no single task. Joins are merge joins at every size, so what is shuffled grows
    in proportion to the input.

    Null ids count as smaller than any other and as one document; rows with equal ids are one document's, and never refer to each other.
    """
    rows = _rows(docs, id_col, text).filter("text is not null")
    prints = materialise(rows.select("id", "version", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")))
    least = prints.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first <> last").drop("last")
    copied = materialise(prints.join(materialise(least).hint("merge"), ["h1", "h2"]).filter("id <> first").select(*_ROW, "first").distinct())

    found = rows.mapInArrow(_anchor_rows(window, gram), "id long, version long, anchor long")
    found = materialise(found.join(copied.select(*_ROW).hint("merge"), _ROW, "left_anti"))
    shared = materialise(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    wanted = materialise(found.join(shared.hint("merge"), "anchor").groupBy(*_ROW).agg(F.collect_set("anchor").alias("anchors")))
    windows = rows.join(wanted.hint("merge"), _ROW).select(*_ROW, "text", "anchors")
    windows = materialise(windows.mapInArrow(_window_rows(window, gram), "low long, high long, id long, version long, place int"))
    index = windows.groupBy("low", "high").agg(F.min(F.struct("id", "place")).alias("holder"), F.max("id").alias("last"))
    index = materialise(index.filter("last > holder.id").select("low", "high", "holder"))
    held = windows.join(index.hint("merge"), ["low", "high"]).filter("id > holder.id")
    held = held.groupBy(*_ROW).agg(F.collect_set(F.struct("place", F.col("holder.id").alias("block"), F.col("holder.place").alias("block_place"))).alias("held"))
    parsed = held.mapInArrow(_factor_rows(window), f"id long, version long, factors {_FACTORS}")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.lit((1 << 31) - 1).alias("words"), F.col("first").alias("reference"), F.lit(0).alias("reference_start")))
    return parsed.union(copied.select(*_ROW, whole))


def _without(window: int, names: list[str], at: int, counts_as: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts, counts, removed = [], [], []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                keep = np.ones(len(words), bool)
                for f in found or ():
                    # a copy of a whole text is a factor only if it is long enough
                    if len(words) >= window:
                        keep[f["start"]:f["start"] + f["words"]] = False
                counts.append(len(words))
                removed.append(len(words) - int(keep.sum()))
                kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()]
                texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [*names, *counts_as])
    return run


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all columns, their text without the words that lie in factors (kept words joined by one space), and ``_n_words`` and
    ``_n_removed``, with more underscores where ``docs`` have columns of these names.

    Null and white texts have no words and become empty; an empty table gives no rows.
    """
    names = docs.columns
    n_words, n_removed, own, version, spans_of = unused(names, "_n_words", "_n_removed", "_id", "_version", "_factors")
    spans = materialise(parse(docs, window, gram, id_col, text)).withColumnsRenamed({"id": own, "version": version, "factors": spans_of})
    same = (F.coalesce(F.col(id_col), F.lit(_NULL)).cast("long") == F.col(own)) & (F.xxhash64(F.col(text)) == F.col(version))
    joined = docs.join(spans.hint("merge"), same, "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {n_words} long, {n_removed} long"
    without = _without(window, names, names.index(text), [n_words, n_removed])
    return joined.select(*[f"`{c}`" for c in names], spans_of).mapInArrow(without, schema)
