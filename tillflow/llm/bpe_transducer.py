"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding."""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import PieceTable, SpaceCutter, slices


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class _State(dict):
    """A state's moves by byte: (next state, the tokens that may end behind the byte as (length, token), longest first)."""

    __slots__ = ("live", "machine")

    def __missing__(self, byte: int) -> tuple[_State, tuple[tuple[int, int], ...]]:
        move = self[byte] = self.machine.move(self, byte)
        return move


class _Followers(dict):
    """Which tokens may stand behind one token."""

    __slots__ = ("left", "machine")

    def __missing__(self, right: int) -> bool:
        self.machine.known += 1
        holds = self[right] = self.machine.holds(self.left, right)
        return holds


class Transducer:
    """Reads the bytes of one pre-token and emits token ids as soon as no further byte can change them.

    Read as a nondeterministic machine, the vocabulary is a trie in which a token may begin at any byte. A state of the determinised
    machine is the set of trie nodes reached from all places where the token that covers the next byte may have begun; its moves also say which
    tokens may end there, the longest first. States and moves are made when they are first needed; there are no more states than nodes.

    Two tokens may stand side by side only if merging their joined bytes gives the same two again, and a sequence in which all neighbours
    may do so is the one the merges make. So each prefix of the input has one way to end in a whole token, and beside its state the machine
    only remembers the last token of the prefixes that end at a live place. Tokens on which all live places agree are emitted; no live
    place is further back than the longest token, which bounds the lookahead. Remembered pairs are dropped at ``limit``.
    """

    def __init__(self, ranks: dict[bytes, int], limit: int = 1_000_000):
        self.ranks, self.limit, self.known = ranks, limit, 0
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                step = self.child.get(key)
                if step is None:
                    step = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                node = step
            self.token_at[node] = rank
        self.split: dict[int, tuple[int, int] | None] = {}
        self.followers: dict[int, _Followers] = {}
        self.states: dict[tuple, _State] = {}
        self.start = self._state(((0, 0),))

    def _state(self, live: tuple[tuple[int, int], ...]) -> _State:
        state = self.states.get(live)
        if state is None:
            state = self.states[live] = _State()
            state.live, state.machine = live, self
        return state

    def move(self, state: _State, byte: int) -> tuple[_State, tuple[tuple[int, int], ...]]:
        """The move of the nodes of all live places, with the length read from each place, longest first."""
        live = [(step, n + 1) for node, n in state.live if (step := self.child.get(node << 8 | byte)) is not None]
        ending = tuple((n, self.token_at[node]) for node, n in live if self.token_at[node] >= 0)
        return self._state((*live, (0, 0))), ending

    def merged(self, text: bytes, below: int = 1 << 60) -> list[bytes]:
        """What the merges of ranks under ``below`` make of a short text, lowest rank first, leftmost first among equals."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] >= below:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for one byte, or where the merges never make it."""
        if token not in self.split:
            text = self.bytes_of[token]
            parts = self.merged(text, token) if len(text) > 1 else []
            self.split[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.split[token]

    def behind(self, left: int) -> _Followers:
        found = self.followers.get(left)
        if found is None:
            found = self.followers[left] = _Followers()
            found.left, found.machine = left, self
        return found

    def holds(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand behind ``left`` (-1: at the start)."""
        # merges are undone latest first; the seam holds if at no time a merge over it would have come before the one undone
        made = [self.halves(t) is not None or len(self.bytes_of[t]) == 1 for t in (left, right) if t >= 0]
        if left < 0 or not all(made):
            return all(made)
        before = 1 << 60
        while True:
            over = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if over is not None and over < before:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and left > right:
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]  # of equal ranks the merge further left, which is the one over the seam, comes first

    def _agreed(self, state: _State, last: list[int]) -> int:
        """The place up to which the tokens before all live places are the same."""
        ends = {len(last) - 1 - n for _, n in state.live}
        while len(ends) > 1:
            furthest = max(ends)
            ends.remove(furthest)
            ends.add(furthest - self.length[last[furthest]])
        return ends.pop()

    def _tokens(self, last: list[int], end: int) -> list[int]:
        """The tokens up to a place, from the last token of each prefix."""
        out, length = [], self.length
        while end > 0:
            token = last[end]
            out.append(token)
            end -= length[token]
        out.reverse()
        return out

    def encode(self, piece: bytes, every: int = 512) -> list[int]:
        """The tokens of one pre-token; one that is a token itself is that token, as in the public encoder.

        Every so many bytes what is agreed on is emitted and forgotten.
        """
        if piece in self.ranks:
            return [self.ranks[piece]]
        if self.known > self.limit:
            self.followers, self.known = {}, 0
        out: list[int] = []
        state, last, behind, followers = self.start, [-1], [self.behind(-1)], self.followers
        for byte in piece:
            state, ending = state[byte]
            for n, token in ending:
                if n == 1 or behind[-n][token]:  # nothing is shorter than one byte, and one of them fits
                    break
            last.append(token)
            behind.append(followers.get(token) or self.behind(token))
            if len(last) > every:
                cut = self._agreed(state, last)
                if cut > 0:
                    out += self._tokens(last, cut)
                    last, behind = last[cut:], behind[cut:]
        return out + self._tokens(last, len(last) - 1)


class Utf8Stream:
    """Incremental UTF-8 decoding: gives the text of all whole code points and keeps the bytes of a begun one.

    The state is the number of bytes still missing and the range that the next one must lie in. Bytes that are no UTF-8 become
    surrogate escapes, so the text encodes to the same bytes again.
    """

    # Lead byte ranges with the bytes that follow and the range of the first of them (Unicode, table 3-7).
    LEADS = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F),
             (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))

    def __init__(self):
        self.begun = b""

    def _open(self, tail: bytes) -> bool:
        """Whether the tail is the beginning of a code point that lacks bytes."""
        missing, low, high = 0, 0x80, 0xBF
        for i, byte in enumerate(tail):
            if i == 0:
                lead = next((x for x in self.LEADS if x[0] <= byte <= x[1]), None)
                if lead is None:
                    return False
                missing, low, high = lead[2:]
            elif low <= byte <= high:
                missing, low, high = missing - 1, 0x80, 0xBF
            else:
                return False
        return missing > 0

    def feed(self, more: bytes) -> str:
        data = self.begun + more
        keep = next((k for k in range(1, min(3, len(data)) + 1) if data[-k] >= 0xC0 and self._open(data[-k:])), 0)
        self.begun = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "surrogateescape")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "surrogateescape")


class Codec:
    """Encoder of one rank file, with the ids of stretches met before."""

    def __init__(self, path: str):
        self.transducer = Transducer(load_ranks(path))
        self.cutter = SpaceCutter()
        self.table = PieceTable(self._encode_all, limit=600_000)

    def _encode_all(self, stretches: Sequence[str]) -> list[list[int]]:
        encode, match = self.transducer.encode, self.cutter.match
        return [[t for piece in match(s) for t in encode(piece.encode("utf-8", "surrogateescape"))] for s in stretches]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        return self.table.ids([self.cutter.stretches(t) for t in texts])


class Decoder:
    """Decoder of one rank file."""

    def __init__(self, path: str):
        self.token_bytes = {rank: token for token, rank in load_ranks(path).items()}

    def decode(self, ids: np.ndarray, part: int = 4096) -> Iterator[str]:
        """The text of the ids, part by part."""
        stream, of = Utf8Stream(), self.token_bytes
        for at in range(0, len(ids), part):
            yield stream.feed(b"".join([of[t] for t in ids[at:at + part].tolist()]))
        yield stream.close()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One encoder per worker and rank file. Its many small objects hold no cycles, so they are kept from the garbage collector."""
    made = Codec(path)
    gc.freeze()
    gc.set_threshold(200_000, 100, 100)
    return made


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, id_col: str) -> Iterator[pa.RecordBatch]:
    """Batches of id and text as id and ``ids``."""
    coder = codec(path)
    for batch in slices(batches, 64):
        packed = [ids.astype("<u4").tobytes() for ids in coder.encode([t or "" for t in batch.column(1).to_pylist()])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], [id_col, "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, id_col: str) -> Iterator[pa.RecordBatch]:
    """Batches of id and ``ids`` as id, ``ids`` and ``text``."""
    coder = decoder(path)
    for batch in slices(batches):
        texts = ["".join(coder.decode(np.frombuffer(ids or b"", "<u4"))) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], [id_col, "ids", "text"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id and ``ids``, the tokens by the ranks at ``path`` as packed little-endian unsigned 32-bit integers.

    Each match of the public pattern is encoded by itself and no string is special. Null and empty texts have no tokens; rows are
    independent of each other, so repeated rows and lost executors change nothing. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, path, id_col)
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``encode``: id, ``ids`` and ``text``, decoded in parts. Null ids give an empty text; an unknown id is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(batches, path, id_col)
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, ids binary, text string")


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in one worker per task. As two functions each task has two, and every worker comes to hold an encoder's tables."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(_encoded(batches, path, id_col), path, id_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, ids binary, text string")
