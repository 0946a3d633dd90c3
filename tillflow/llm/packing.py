"""Packing documents into fixed windows of tokens by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .orc_ids import text_encoder
from .pieces import slices

# a piece that is placed: document (place in its block), first id, length
Piece = tuple[int, int, int]


class OpenWindows:
    """Open windows by the room left in them, under a segment tree whose nodes count the windows below."""

    def __init__(self, room: int):
        self.leaves = 1 << room.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(room + 1)]

    def _add(self, room: int, n: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove the window with the least room of ``need`` or more, of equal ones the last put in: (window, room)."""
        count, node = self.count, self.leaves + need
        if not count[node]:
            # up to the first subtree on the right that holds a window, then down to its leftmost leaf
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        self._add(room, -1)
        return self.windows[room].pop(), room


def best_fit_decreasing(lengths: Sequence[int], room: int) -> tuple[list[list[int]], list[int]]:
    """Windows as lists of places in ``lengths`` (each from 1 to ``room``), and the room left in each.

    The longest come first, equal ones in their order; each goes to the open window that it leaves the least room in, or opens a new one.
    """
    windows: list[list[int]] = []
    left: list[int] = []
    still_open = OpenWindows(room)
    for i in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        found = still_open.take(lengths[i])
        if found is None:
            window, free = len(windows), room
            windows.append([])
            left.append(room)
        else:
            window, free = found
        windows[window].append(i)
        left[window] = free = free - lengths[i]
        if free:
            still_open.put(window, free)
    return windows, left


def close_gaps(windows: list[list[Piece]], room: int, most_gap: int) -> list[list[Piece]]:
    """Windows without gaps of more than ``most_gap`` places.

    The pieces of the emptiest windows are cut to fill the gaps of the fullest. What the last one holds is ended at powers of two, which need no
    padding: one window for each bit of its length.
    """
    filled = [sum(n for _, _, n in w) for w in windows]
    done = [w for w, n in zip(windows, filled, strict=True) if room - n <= most_gap]
    # by fill, the fullest last; of equal ones the first window last
    rest = sorted(((n, -i) for i, n in enumerate(filled) if room - n > most_gap), reverse=True)
    rest = [(list(windows[-i]), n) for n, i in rest]
    first, last = 0, len(rest) - 1
    while first < last:
        window, n = rest[first]
        donor, held = rest[last]
        while n < room and donor:
            doc, start, length = donor.pop()
            part = min(length, room - n)
            # the end of a piece moves, so what stays keeps its place
            window.append((doc, start + length - part, part))
            if part < length:
                donor.append((doc, start, length - part))
            n, held = n + part, held - part
        rest[last] = (donor, held)
        if n == room:
            done.append(window)
            first += 1
        else:
            rest[first] = (window, n)
        if not donor:
            last -= 1
    if first == last and rest[first][1]:
        pieces, n = rest[first]
        pieces = pieces[::-1]
        for bit in reversed(range(n.bit_length())):
            size, window = n & 1 << bit, []
            while size:
                doc, start, length = pieces.pop()
                part = min(length, size)
                window.append((doc, start, part))
                if part < length:
                    pieces.append((doc, start + part, length - part))
                size -= part
            if window:
                done.append(window)
    return done


class _Block:
    """Documents whose ids wait for the packing of their block."""

    def __init__(self):
        self.ids: list = []
        self.tokens: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id, tokens: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.tokens.append(tokens)
        self.held += len(tokens)

    def windows(self, room: int, most_gap: int) -> Iterator[list[Piece]]:
        """Full windows of the overlong documents first, then the packed rests."""
        rests: list[Piece] = []
        for doc, tokens in enumerate(self.tokens):
            full = len(tokens) // room * room
            for start in range(0, full, room):
                yield [(doc, start, room)]
            if full < len(tokens):
                rests.append((doc, full, len(tokens) - full))
        packed, _ = best_fit_decreasing([n for _, _, n in rests], room)
        yield from close_gaps([[rests[i] for i in w] for w in packed], room, most_gap)


def _packer(path: str, end_id: int, room: int, most_gap: int, block_tokens: int):
    kind = None

    def rows(block: _Block, first: int) -> Iterator[tuple[int, pa.RecordBatch]]:
        out: list[tuple] = []
        sequence = first

        def batch() -> pa.RecordBatch:
            docs, starts, lengths, sequences, offsets = zip(*out, strict=True)
            ids = [block.tokens[d][s:s + n].astype("<u4").tobytes() for d, s, n in zip(docs, starts, lengths, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([block.ids[d] for d in docs], kind), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array([len(block.tokens[d]) for d in docs], pa.int64()), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64()),
                 pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for window in block.windows(room, most_gap):
            offset = 0
            for doc, start, length in window:
                out.append((doc, start, length, sequence, offset))
                offset += length
            sequence += 1
            if len(out) >= 1024:
                yield sequence, batch()
                out.clear()
        if out:
            yield sequence, batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal kind
        encode, block = text_encoder(path, end_id), _Block()
        sequence = TaskContext.get().partitionId() << 33
        for batch in slices(batches, 64):
            kind = batch.schema.field(0).type
            flat, cuts = encode(batch.column(1).to_pylist())
            for doc_id, a, b in zip(batch.column(0).to_pylist(), cuts, cuts[1:], strict=False):
                block.add(doc_id, flat[a:b])
            if block.held >= block_tokens:
                for sequence, found in rows(block, sequence):
                    yield found
                block = _Block()
        for _, found in rows(block, sequence):
            yield found
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, room: int = 2048, most_gap: int = 8, block_tokens: int = 4 << 20,
         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids of all documents, ``end_id`` after each, in sequences of at most ``room`` ids.

    One row per piece: doc_id, ``start`` (ids of its document before it), ``length``, ``doc_tokens`` (of the whole document), ``sequence_id``,
    ``offset`` (in its sequence), and ``ids`` (packed little-endian unsigned 32-bit integers). Documents of more than ``room`` ids are cut into full
    windows; the rests are packed by best-fit decreasing. Gaps of more than ``most_gap`` places are then filled by cutting the pieces of
    the emptiest windows, and what is left at last ends at powers of two; with 0 no sequence needs padding at all, with more fewer documents are cut.

    Each task packs blocks of about ``block_tokens`` ids of its own rows, so nothing is shuffled and a task holds one block; its sequences are
    numbered from its partition's number, and a task that runs again makes all of its sequences anew.

    Null and empty texts have the end id alone. Each row is a document of its own, also with a null or repeated id or equal to another row. An
    empty table gives no rows. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    long = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in long],
                           T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(_packer(tokenizer, end_id, room, most_gap, block_tokens), schema)
