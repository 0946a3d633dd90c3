"""Token ids in ORC: range-sorted shards whose stripes can be read in parallel or skipped by document id."""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..sources.writers import scratch_path
from .pieces import BYTE_ALPHABET, PieceTable, library_tokenizer, slices

# The writer's settings. Integers get run-length encoding by the format itself.
ORC_OPTIONS = {"orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20),
               "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}


# what stands for the end of a document among its stretches, none of which is empty
_END = b""
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,]*)").fullmatch


class WordEncoder:
    """Ids of stretches between ASCII white space, by the library.

    The tokenizer drops white space and cuts at it, so a stretch has the same ids alone as in its text. For most stretches, Latin-1 letters and then full
    stops or commas, its normalizer only lower-cases and its cutter gives the two parts; the library's merges are called on these directly.
    All other stretches go through the whole tokenizer, many as one text; the places of the ids tell whose they are.
    """

    def __init__(self, path: str, end_id: int):
        self.tokenizer, self.end_id = library_tokenizer(path), end_id
        self.merge = self.tokenizer.model.tokenize
        self.latin = {c: "".join(BYTE_ALPHABET[b] for b in chr(c).lower().encode()) for c in [*range(65, 91), *range(192, 256)]}
        self.ends: dict[str, list[int]] = {"": []}

    def __call__(self, words: Sequence[bytes], part: int = 100) -> list[list[int]]:
        out: list = [None] * len(words)
        rest: list[tuple[int, str]] = []
        for i, raw in enumerate(words):
            if raw.isalpha():  # ASCII letters only
                out[i] = [t.id for t in self.merge(raw.lower().decode())]
                continue
            if raw == _END:
                out[i] = [self.end_id]
                continue
            word = raw.decode("utf-8", "replace")
            plain = _PLAIN(word)
            if plain is None:
                rest.append((i, word))
                continue
            letters, end = plain.groups()
            out[i] = [t.id for t in self.merge(letters.translate(self.latin))]
            if end:
                if end not in self.ends:
                    self.ends[end] = [t.id for t in self.merge(end)]
                out[i] += self.ends[end]
        for at in range(0, len(rest), part):
            texts = [w for _, w in rest[at:at + part]]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            cuts = np.searchsorted([a for a, _ in found.offsets], np.cumsum([0] + [len(t) + 1 for t in texts]))
            ids = found.ids
            for (i, _), a, b in zip(rest[at:at + part], cuts, cuts[1:], strict=False):
                out[i] = ids[a:b]
        return out


class WordTable(PieceTable):
    """Ids of the stretches met before, started anew at ``limit`` stretches or ``limit_bytes`` of them, whichever comes first."""

    def __init__(self, path: str, end_id: int, limit: int = 1_400_000, limit_bytes: int = 64 << 20):
        self.limit_bytes = limit_bytes
        super().__init__(WordEncoder(path, end_id), limit)

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def _fill(self) -> None:
        self.held += sum(map(len, self.slot.new))
        super()._fill()

    def flat_ids(self, lists: Sequence[Sequence]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > self.limit_bytes:
            self.clear()
        return super().flat_ids(lists)


# The rules under which a text can be encoded stretch by stretch as WordEncoder does.
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def has_word_rules(path: str) -> bool:
    """Whether the tokenizer's file normalizes and cuts by ``WORD_RULES``."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    return all(rules.get(name) == rule for name, rule in WORD_RULES.items())


@lru_cache(maxsize=2)
def text_encoder(path: str, end_id: int) -> Callable[[Sequence[str | None]], tuple[np.ndarray, np.ndarray]]:
    """One function per worker, file and end id: the ids of texts one after the other, ``end_id`` behind each, and where each begins and ends.

    Where the file follows ``WORD_RULES`` the texts go stretch by stretch through a table, else whole through the library. The table's many small objects
    hold no cycles, so they are kept from the garbage collector.
    """
    if not has_word_rules(path):
        tokenizer = library_tokenizer(path)

        def whole(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
            found = [[*e.ids, end_id] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
            flat = np.concatenate([np.array(ids, np.uint32) for ids in found]) if found else np.zeros(0, np.uint32)
            return flat, np.cumsum([0, *map(len, found)])
        return whole
    gc.freeze()
    gc.set_threshold(200_000, 100, 100)
    table = WordTable(path, end_id)
    return lambda texts: table.flat_ids([[*(t or "").encode().split(), _END] for t in texts])


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = text_encoder(path, end_id), 0
        for batch in slices(batches, 64):
            flat, cuts = encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.arange(row, row + batch.num_rows)), pa.array(np.diff(cuts)),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat.view(np.int32)))], ["doc_id", "row", "n_tokens", "ids"])
            row += batch.num_rows
    return run


def write_token_ids(docs: DataFrame, tokenizer: str, out: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Write ``out/*.orc`` with doc_id, row (in its shard), n_tokens and ids, in ascending doc_id order.

    The texts are dealt out by ranges of the id, and of their first letters where many rows have one id or none, and sorted inside a range before they are
    encoded, so the files stand in order and what is shuffled is text, which is smaller than its ids. Each file carries row indexes, and Bloom
    filters on doc_id. Ids of tokens go below 2^31. Null texts count as empty and so have the end id alone.
    Rows with equal ids are ordered by text; null ids come first.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    # the order by text begins with that by its first letters, which is all that the choice of the ranges collects
    rows = rows.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    rows.mapInArrow(_encoded(tokenizer, end_id), f"doc_id {kind}, row long, n_tokens long, ids array<int>").write.options(**ORC_OPTIONS).orc(out)


def read_token_ids(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The files' rows; with ``doc_ids`` those documents only, for which stripes and row groups are skipped by range and Bloom filter."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(*doc_ids))


def document_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, ``start`` (ids of all documents before it), n_tokens.

    One number per file is summed over the files in their order; inside a file, whose size the range partitioning bounds, a window counts on.
    """
    rows = spark.read.orc(path).select("doc_id", "row", "n_tokens", F.col("_metadata.file_name").alias("file"))
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # part files are numbered by range, and the files of one part in the order in which they were written
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("int")
    order = W.orderBy(number(r"part-(\d+)"), number(r"-c(\d+)\."))
    before = F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = files.select("file", before.alias("_before"))
    inside = F.coalesce(F.sum("n_tokens").over(W.partitionBy("file").orderBy("row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_inside", inside)
    return rows.join(files, "file").select("doc_id", "file", "row", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("row"), pa.array(sums, pa.int64())], ["file", "row", "ids_crc32"])


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: file, row, ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""
    rows = spark.read.orc(path).select(F.col("_metadata.file_name").alias("file"), "row", "ids")
    return rows.mapInArrow(_checksums, "file string, row long, ids_crc32 long")


def token_id_files(docs: DataFrame, tokenizer: str, end_id: int = 2, out: str | None = None) -> DataFrame:
    """Write the ids of ``docs``, read the files back, and return per document doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "token-ids")
    write_token_ids(docs, tokenizer, out, end_id)
    found = document_offsets(spark, out).join(document_checksums(spark, out), ["file", "row"])
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")
