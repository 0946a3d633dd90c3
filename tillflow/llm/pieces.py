"""Helpers of the token operators: cutting texts into pieces, ids of pieces met before, Arrow batches of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

# Fixed value: the public pattern that cuts a text before any merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The byte-level alphabet. Bytes that print stand for themselves, the others for the code points from 256 on.
_PRINT = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_ALPHABET = {b: chr(b) for b in _PRINT} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(_PRINT))}


class SpaceCutter:
    """Cut a text into stretches between two spaces that the matches of ``PATTERN`` never cross.

    A space between two characters that are not white space always begins a match: no match reaches over it from the left, and
    the classes on the right take it in front. So a text without other runs of spaces is cut at its spaces, and a caller
    matches each distinct stretch once. Any other text is matched as a whole.
    """

    def __init__(self, pattern: str = PATTERN):
        self.match = regex.compile(pattern).findall
        self.odd = regex.compile(r"\s \s?|^ | $| \s").search

    def stretches(self, text: str) -> list[str]:
        """The stretches between the spaces, with their space in front; the matches where the text can't be cut so."""
        if not text or self.odd(text):
            return self.match(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]


class _Slots(dict):
    """Slots of pieces; a piece that is looked up for the first time gets the next one and is noted as new."""

    __slots__ = ("new",)

    def __missing__(self, piece) -> int:
        slot = self[piece] = len(self)
        self.new.append(piece)
        return slot


class PieceTable:
    """Ids of the pieces met before in one flat array: a text costs one lookup per piece and one gather.

    Beyond ``limit`` pieces the table starts anew, so a worker's memory is bounded; a piece met again is encoded again.
    """

    def __init__(self, encode: Callable[[Sequence], Iterable[Sequence[int]]], limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.slot = _Slots()
        self.slot.new = []
        self.filled, self.used = 0, 0
        self.start, self.length, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def _fill(self) -> None:
        found = list(self.encode(self.slot.new))
        self.slot.new = []
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        values = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        for name, new, used in (("start", self.used + np.cumsum(lengths) - lengths, self.filled), ("length", lengths, self.filled),
                                ("flat", values, self.used)):
            array = getattr(self, name)
            if used + len(new) > len(array):
                array = np.concatenate([array, np.zeros(max(len(array), len(new)), array.dtype)])
                setattr(self, name, array)
            array[used:used + len(new)] = new
        self.filled += len(found)
        self.used += len(values)

    def flat_ids(self, lists: Sequence[Sequence]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all lists of pieces one after the other, as unsigned 32-bit integers, and where each list begins and ends."""
        if len(self.slot) > self.limit:
            self.clear()
        sizes = [len(pieces) for pieces in lists]
        slots = np.fromiter(map(self.slot.__getitem__, chain.from_iterable(lists)), np.int64, sum(sizes))
        if self.slot.new:
            self._fill()
        lengths = self.length[slots]
        ends = np.cumsum(lengths)
        flat = self.flat[np.repeat(self.start[slots] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        return flat, np.concatenate([[0], ends])[np.cumsum([0, *sizes])]

    def ids(self, lists: Sequence[Sequence]) -> list[np.ndarray]:
        """The ids of each list of pieces."""
        flat, cuts = self.flat_ids(lists)
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def unused(columns: Sequence[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column's name in any case of letters."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that what a worker makes of very long texts at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


@lru_cache(maxsize=4)
def library_tokenizer(path: str):
    """One tokenizer of the tokenizers library per worker and file."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)
