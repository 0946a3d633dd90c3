"""Token counts: pieces counted once per distinct pre-token and joined to each document's pre-token frequencies."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.writers import materialise
from .pieces import BYTE_ALPHABET, PieceTable, SpaceCutter, library_tokenizer, slices

# distinct pre-tokens, and stretches, that a worker remembers before it starts anew
LIMIT = 500_000


class Numbering:
    """Numbers for the pre-tokens a worker has met, so that a document's frequencies are counted on integers."""

    def __init__(self, path: str):
        self.special = [t.content for t in library_tokenizer(path).get_added_tokens_decoder().values()]
        self.cutter, self.table = SpaceCutter(), PieceTable(self._number, limit=LIMIT)
        self.start_anew()

    def start_anew(self) -> None:
        self.number, self.pieces = {}, []
        self.table.clear()
        self.tokens, self.tokens_of = np.zeros(0, np.int64), None

    def _number(self, stretches: list[str]) -> list[list[int]]:
        number, pieces, out = self.number, self.pieces, []
        for stretch in stretches:
            row = []
            for piece in self.cutter.match(stretch):
                n = number.get(piece)
                if n is None:
                    n = number[piece] = len(pieces)
                    pieces.append(piece)
                row.append(n)
            out.append(row)
        return out

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers of the pre-tokens of all texts one after the other, where each text begins and ends, and its special tokens.

        A special token's string is one token, and the texts before and behind it are cut by themselves.
        """
        parts, ends = [], [0]
        for text in texts:
            own = [text]
            for s in self.special:
                if s in text:
                    own = [x for p in own for x in p.split(s)]
            parts += own
            ends.append(len(parts))
        flat, cuts = self.table.flat_ids([self.cutter.stretches(p) for p in parts])
        return flat, cuts[ends], np.diff(ends) - 1

    def known_tokens(self, head, name: str) -> np.ndarray:
        """For every number the tokens that the broadcast head of that name gives its piece, -1 where it has none."""
        if self.tokens_of != name:
            self.tokens, self.tokens_of = np.zeros(0, np.int64), name
        if len(self.tokens) < len(self.pieces):
            known = head.value
            self.tokens = np.concatenate([self.tokens, np.array([known.get(p, -1) for p in self.pieces[len(self.tokens):]], np.int64)])
        return self.tokens


_NUMBERINGS: dict[str, Numbering] = {}


def _numbering(path: str) -> Numbering:
    """The worker's numbering, which its tasks share."""
    if path not in _NUMBERINGS:
        _NUMBERINGS[path] = Numbering(path)
        gc.freeze()  # strings and integers without cycles: nothing for the garbage collector
        gc.set_threshold(200_000, 100, 100)
    return _NUMBERINGS[path]


def _partial_frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = _numbering(path), np.zeros(LIMIT, np.int64)

        def flush() -> pa.RecordBatch:
            met = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array([own.pieces[i] for i in met.tolist()], pa.string()), pa.array(total[met])], ["piece", "n"])
        for batch in slices(batches, 64):
            if len(own.pieces) >= LIMIT:
                yield flush()
                own.start_anew()
                total = np.zeros(LIMIT, np.int64)
            flat, _, _ = own.numbers([t or "" for t in batch.column(0).to_pylist()])
            if len(total) < len(own.pieces):
                total = np.concatenate([total, np.zeros(len(own.pieces), np.int64)])
            numbers, counts = np.unique(flat, return_counts=True)
            total[numbers] += counts
        yield flush()
    return run


def _count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a pre-token is cut no further, so the library's merges are called on it directly, in the byte-level alphabet
        merge, alphabet = library_tokenizer(path).model.tokenize, BYTE_ALPHABET
        for batch in batches:
            pieces = batch.column("piece")
            tokens = [len(merge("".join([alphabet[b] for b in p.encode()]))) for p in pieces.to_pylist()]
            yield pa.RecordBatch.from_arrays([pieces, batch.column("n"), pa.array(tokens, pa.int32())], ["piece", "n", "tokens"])
    return run


def piece_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every distinct pre-token of the corpus with its frequency ``n`` and its number of ``tokens``, counted once."""
    partial = docs.select(text).mapInArrow(_partial_frequencies(path), "piece string, n long")
    return partial.groupBy("piece").agg(F.sum("n").alias("n")).mapInArrow(_count_pieces(path), "piece string, n long, tokens int")


def _join_head(path: str, head, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, own = TaskContext.get().partitionId() << 33, _numbering(path)
        for batch in slices(batches, 64):
            if len(own.pieces) >= LIMIT:
                own.start_anew()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            flat, cuts, special = own.numbers(texts)
            of = own.known_tokens(head, name)[flat]
            sums = np.concatenate([[0], np.cumsum(np.maximum(of, 0))])[cuts]
            # frequencies by document of the pre-tokens outside the head
            rare = np.flatnonzero(of < 0)
            document = np.searchsorted(cuts, rare, side="right") - 1
            pairs, counts = np.unique(document << 32 | flat[rare].astype(np.int64), return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(texts) + 1) << 32).astype(np.int32)
            pieces = own.pieces
            tail = pa.StructArray.from_arrays([pa.array([pieces[i] for i in (pairs & 0xFFFFFFFF).tolist()], pa.string()), pa.array(counts, pa.int64())],
                                              ["piece", "k"])
            rows = np.arange(row, row + len(texts))
            row += len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                              pa.array(np.diff(sums) + special, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), tail)],
                                             ["row", "id", "n_bytes", "head", "tail"])
    return run


def _head(pieces: DataFrame, size: int) -> dict[str, int]:
    """The tokens of the pre-tokens that occur at least 2^k times, with the smallest k for which there are at most ``size``."""
    counted = pieces.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()  # at most 63 rows
    above, least = 0, 64
    for r in sorted(counted, key=lambda r: -r.k):
        above += r["count"]
        if above > size:
            break
        least = r.k
    table = pieces.filter(F.floor(F.log2("n")).cast("int") >= least).select("piece", "tokens").toArrow()
    return dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", head_size: int = 200_000) -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes`` (UTF-8) and ``n_tokens``, as the byte-level tokenizer file at ``path`` gives them.

    Pre-tokens are counted over all documents, and the tokenizer sees each distinct one once. Its answers are joined to each
    document's frequencies in two parts: the most frequent pre-tokens, at most ``head_size``, which bounds the broadcast, are looked up while the
    document is cut; all others, few and rare, go through a shuffled join on the pre-token. No id list of a text is made.

    Null and empty texts have 0 tokens; repeated rows are counted one by one; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    pieces = materialise(piece_tokens(docs, path, text))
    head = spark.sparkContext.broadcast(_head(pieces, head_size))
    kind = docs.schema[id_col].dataType.simpleString()
    counted = materialise(docs.select(id_col, text).mapInArrow(
        _join_head(path, head, uuid.uuid4().hex), f"row long, id {kind}, n_bytes long, head long, tail array<struct<piece: string, k: long>>"))
    tail = counted.select("row", F.explode("tail").alias("t")).select("row", "t.piece", "t.k")
    tail = tail.join(pieces.select("piece", "tokens"), "piece").groupBy("row").agg(F.sum(F.col("k") * F.col("tokens")).alias("more"))
    return (counted.join(tail, "row", "left")
            .select(F.col("id").alias(id_col), "n_bytes", (F.col("head") + F.coalesce("more", F.lit(0))).alias("n_tokens")))
