"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .pieces import slices

# A Mersenne prime, two bases and the growth of the ladder of lengths at which a fingerprint holds prefix and suffix hashes.
PRIME = (1 << 31) - 1
BASES = (1_042_527_923, 1_679_283_671)
GROWTH = 1.15
_P = np.uint64(PRIME)


class _Powers:
    """Powers of the bases and of their inverses, grown to the longest text met."""

    def __init__(self):
        self.up = np.ones((2, 1), np.uint64)
        self.down = np.ones((2, 1), np.uint64)
        self.roots = (BASES, tuple(pow(b, -1, PRIME) for b in BASES))

    def grow(self, n: int) -> None:
        while self.up.shape[1] <= n:
            size = self.up.shape[1]
            for name, roots in zip(("up", "down"), self.roots, strict=True):
                table = getattr(self, name)
                step = np.array([[pow(r, size, PRIME)] for r in roots], np.uint64)
                setattr(self, name, np.concatenate([table, table * step % _P], axis=1))


POWERS = _Powers()


def ladder(n: int) -> np.ndarray:
    """The lengths 1, 2, 3, ... growing by GROWTH, that are at most n."""
    steps, at = [], 1.0
    while int(at) <= n:
        steps.append(int(at))
        at = max(at * GROWTH, at + 1)
    return np.array(steps, np.int64)


_LADDER = ladder(1 << 40)


class PrefixHashes:
    """Modular prefix arrays of a text: ``sums[k, i]`` is the sum of (code point + 1) * base_k^j over the first i places j."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        self.n = len(codes)
        POWERS.grow(self.n)
        self.sums = np.zeros((2, self.n + 1), np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * POWERS.up[:, :self.n] % _P, axis=1, out=self.sums[:, 1:])
        self.sums[:, 1:] %= _P

    def at(self, ends: np.ndarray) -> np.ndarray:
        return self.sums[:, ends]

    def span(self, begin, end) -> np.ndarray:
        """Hash of [begin, end), the same wherever the same code points stand; arrays give one hash each."""
        begin, end = np.atleast_1d(begin), np.atleast_1d(end)
        parts = (self.at(end) + _P - self.at(begin)) % _P * POWERS.down[:, begin] % _P
        return parts[0] << np.uint64(31) | parts[1]

    def extension(self, begin: int, other: PrefixHashes, other_begin: int) -> int:
        """Length of the longest common extension of the two places, by binary search over span equality."""
        low, high = 0, min(self.n - begin, other.n - other_begin)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(begin, begin + middle)[0] == other.span(other_begin, other_begin + middle)[0]:
                low = middle
            else:
                high = middle - 1
        return low


class Spliced(PrefixHashes):
    """The first ``keep`` places of one text and then the first ``take`` of another, from the arrays of both without hashing anew."""

    def __init__(self, first: PrefixHashes, keep: int, second: PrefixHashes, take: int):
        self.first, self.second, self.keep, self.n = first, second, keep, keep + take

    def at(self, ends: np.ndarray) -> np.ndarray:
        inside = np.minimum(ends, self.keep)
        return (self.first.sums[:, inside] + POWERS.up[:, self.keep, None] * self.second.sums[:, ends - inside]) % _P


@dataclass
class Fingerprint:
    """Length, hash of the whole, and 32 bits of the hash of every prefix (``head``) and suffix (``tail``) whose length is on the ladder."""

    n: int
    whole: int
    head: np.ndarray
    tail: np.ndarray

    @classmethod
    def of(cls, hashes: PrefixHashes) -> Fingerprint:
        n = hashes.n
        steps = _LADDER[:np.searchsorted(_LADDER, n, side="right")]
        k = len(steps)
        begin, end = np.zeros(2 * k + 1, np.int64), np.full(2 * k + 1, n)
        end[:k], begin[k:2 * k] = steps, n - steps
        spans = hashes.span(begin, end)
        short = (spans ^ spans >> np.uint64(30)).astype(np.uint32)
        return cls(n, int(spans[-1]), short[:k], short[k:-1])

    def __str__(self) -> str:
        return f"{self.n:x}-{self.whole:016x}-{self.head.astype('>u4').tobytes().hex()}{self.tail.astype('>u4').tobytes().hex()}"

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        n, whole, short = text.split("-")
        both = np.frombuffer(bytes.fromhex(short), ">u4").astype(np.uint32)
        return cls(int(n, 16), int(whole, 16), both[:len(both) // 2], both[len(both) // 2:])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The longest ladder length at which both agree: agreement at a length implies it at all shorter ones, so a binary search."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return int(_LADDER[low - 1]) if low else 0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of the longer text that lies in the common prefix and the common suffix, from fingerprints alone: 1 for equal texts only.

    Lengths between two steps of the ladder count as the shorter step, so a common part shows with up to a seventh less.
    Common parts between two differences do not count.
    """
    if (a.n, a.whole) == (b.n, b.whole):
        return 1.0
    longest = max(a.n, b.n)
    return min(_common(a.head, b.head) + _common(a.tail, b.tail), min(a.n, b.n), longest - 1) / longest


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars (code points) and ``fingerprint``. Null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [Fingerprint.of(PrefixHashes(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.n for f in made], pa.int64()), pa.array([str(f) for f in made])],
                                             ["doc_id", "n_chars", "fingerprint"])
    return docs.select(id_col, text).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_chars long, fingerprint string")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
# null ids sort first
_NULL = -(1 << 63)


def _spread(firsts: np.ndarray):
    """Per id: the range it lies in, and the range before it if it begins its own (the last one for the first)."""
    @F.pandas_udf("struct<own: int, before: int>")
    def places(ids: pd.Series) -> pd.DataFrame:
        own = np.searchsorted(firsts, ids.to_numpy(), side="right") - 1
        before = np.where(firsts[own] == ids.to_numpy(), (own - 1) % len(firsts), -1)
        return pd.DataFrame({"own": own, "before": before})
    return places


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (range, guest, id, text), where the guests of a range are the first rows of the next one."""
    waiting = None  # range, id, text, prefix hashes and fingerprint of the row whose next one is still to come
    for batch in slices(batches, 256):
        out: list[tuple] = []
        for place, guest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if guest and (waiting is None or waiting[0] != place):
                continue  # its range has its successor already
            text = text or ""
            hashes = PrefixHashes(text)
            mark = Fingerprint.of(hashes)
            if waiting is not None:
                _, own_id, own, own_hashes, own_mark = waiting
                cut = own_hashes.n // 2
                keep, take = own_hashes.n - cut, min(cut, hashes.n)
                edited = Fingerprint.of(Spliced(own_hashes, keep, hashes, take))
                sha = hashlib.sha256((own[:keep] + text[:take]).encode("utf-8", "surrogatepass")).hexdigest()
                out.append((None if own_id == _NULL else own_id, own_hashes.n, sha, str(own_mark), str(edited), likeness(own_mark, edited),
                            likeness(own_mark, mark)))
            waiting = None if guest else (place, doc_id, text, hashes, mark)
        if out:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [x.split()[0] for x in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: fingerprints of its text and of the text whose last floor(n/2) code points are replaced by the first as many of the next
    document's, and how alike the fingerprints are.

    The next document is the next row by id, then text; behind the last comes the first. Ids are cut into ranges by an id-only pass, each text goes
    to its range, and the text that begins a range goes to the one before as well, so no window runs over all rows and texts are shuffled once. The
    cuts, eight for every shuffle partition, are all that the driver holds.

    Null texts count as empty; null ids sort first; rows with equal ids and texts follow each other; of one row the next is itself; an
    empty table gives no rows. Ids are integers. Other columns are not read.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col(id_col), F.lit(_NULL)).cast("long").alias("id"))
    ranges = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = ids.repartitionByRange(ranges, "id").groupBy(F.spark_partition_id().alias("range")).agg(F.min("id").alias("first"))
    firsts = np.array(sorted(r.first for r in first.collect()), np.int64)
    if not len(firsts):
        return spark.createDataFrame([], _OUT)
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(_NULL)).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("at", _spread(firsts)("id"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("at.before") >= 0, F.array(F.struct(F.col("at.own").alias("place"), F.lit(False).alias("guest")),
                                                                                   F.struct(F.col("at.before").alias("place"), F.lit(True).alias("guest"))))
                                            .otherwise(F.array(F.struct(F.col("at.own").alias("place"), F.lit(False).alias("guest"))))))
    rows = rows.select("to.place", "to.guest", "id", "text").repartition("place").sortWithinPartitions("place", "guest", "id", "text")
    return rows.mapInArrow(_with_next, _OUT)
