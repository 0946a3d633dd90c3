"""Spelling variants: words one code point apart, found by partition-and-enumerate signatures of their letters."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.writers import Stages, materialise
from .pieces import slices

_MASK = (1 << 64) - 1
# Latin-1 bytes of runs: A-Z become a-z, a-z and C0-FF stay, all others cut
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))
# what a signature row is: one of two words of equal length, the longer or the shorter of two
_EVEN, _LONGER, _SHORTER = 0, 1, 2


def runs_of(text: str | None) -> list[bytes]:
    """The maximal runs of Latin letters in Latin-1, A-Z lower-cased; other code points cut."""
    return (text or "").encode("latin-1", "replace").translate(_RUNS).split()


def misspelt(run: bytes, prefix: int, every: int) -> bytes:
    """The run, without one letter where ``every`` divides its CRC-32 in UTF-8 after a text whose CRC-32 is ``prefix``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counts(every: int, least_chars: int, most_words: int):
    def batch(total: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        held = 0
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                for found, n in Counter(runs_of(text)).items():
                    # a run of least_chars letters that loses one is no word
                    if len(found) >= least_chars and len(word := misspelt(found, prefix, every)) >= least_chars:
                        if word in total:
                            total[word] += n
                        else:
                            total[word] = n
                            held += len(word) + 100
                if held > 150 * most_words:
                    yield batch(total)
                    total, held = {}, 0
        if total:
            yield batch(total)
    return run


def word_counts(docs: DataFrame, least_chars: int = 6, least_count: int = 5, every: int = 199, most_words: int = 300_000,
                id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of ``least_chars`` and more code points that occur ``least_count`` times and more.

    A word is a maximal run of Latin letters (A-Z, a-z, C0 to FF), A-Z lower-cased. Where ``every`` divides the CRC-32 of ``<id>:<run>`` the letter at
    CRC-32 modulo length is left out. Each task adds up its own documents first and passes its sums on when it holds about ``most_words`` words, so a
    frequent word is a few rows of the shuffle. A null id counts as an empty one, a null text has no words.
    """
    rows = docs.select(F.col(id_col).cast("string"), F.col(text))
    found = rows.mapInArrow(_counts(every, least_chars, most_words), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


@lru_cache(maxsize=1 << 16)
def _dimension(letter: str, nth: int) -> tuple[int, int]:
    """A dimension of the letter vectors, the nth occurrence of a letter: 64 hash bits, and a number that decides its part."""
    digest = hashlib.blake2b(f"{letter}{nth}".encode(), digest_size=12).digest()
    return int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")


@lru_cache(maxsize=1 << 16)
def _salt(*what: int) -> int:
    return int.from_bytes(hashlib.blake2b(repr(what).encode(), digest_size=8).digest(), "little") | 1


def signatures(word: str, parts: int, distance: int, length: int) -> list[int]:
    """Hashes of the word's letter vector without ``distance`` of the ``parts`` parts of its dimensions, one for each choice.

    Two vectors that differ in at most ``distance`` dimensions are equal outside of at most as many parts, so one signature agrees. Signatures of
    different ``length`` differ.
    """
    value = [0] * parts
    seen: Counter[str] = Counter()
    for letter in word:
        seen[letter] += 1
        bits, part = _dimension(letter, seen[letter])
        value[part % parts] += bits
    out = []
    for kept in combinations(range(parts), parts - distance):
        total = _salt(parts, length, *kept)
        for part in kept:
            total += (value[part] & _MASK) * _salt(part)
        total &= _MASK
        out.append((total ^ total >> 29) * 0xBF58476D1CE4E5B9 & _MASK)
    return out


def _signature_rows(even_parts: int, odd_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            sigs: list[int] = []
            roles: list[int] = []
            each: list[int] = []
            for row, word in enumerate(batch.column(0).to_pylist()):
                n = len(word)
                for role, found in ((_EVEN, signatures(word, even_parts, 2, n)), (_LONGER, signatures(word, odd_parts, 1, n)),
                                    (_SHORTER, signatures(word, odd_parts, 1, n + 1))):
                    sigs += found
                    roles += [role] * len(found)
                    each += [row] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.uint64()).view(pa.int64()), pa.array(roles, pa.int8()), batch.column(0).take(pa.array(each, pa.int32()))],
                                             ["sig", "role", "word"])
    return run


def near_pairs(words: DataFrame, even_parts: int = 5, odd_parts: int = 4, most: int = 64) -> DataFrame:
    """All pairs (a, b) of the distinct strings in column ``word`` that differ by exactly one inserted, deleted or replaced code point, each once.

    The letters of a word are a binary vector with one dimension for each occurrence of each letter. A replaced letter changes two dimensions, an
    inserted one changes one. Words of equal length meet in a signature of all but two of ``even_parts`` parts, words whose lengths
    differ by one in a signature of all but one of ``odd_parts``; pairs that meet are verified. In a signature of more than ``most`` words, words meet
    only if they also agree in their first or in their second half, as words with one edit do, so no pair is lost.
    """
    shorter = F.length("word") - F.when(F.col("role") == _LONGER, 1).otherwise(0)
    half = F.floor(F.col("shorter") / 2).cast("int")
    halves = F.array(F.xxhash64(F.lit(1), F.expr("substring(word, 1, half)")), F.xxhash64(F.lit(2), F.expr("right(word, shorter - half)")))
    with Stages(words.sparkSession) as stages:
        rows = stages.materialise(words.select("word").mapInArrow(_signature_rows(even_parts, odd_parts), "sig long, role byte, word string"))
        crowded = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("sig", F.lit(True).alias("crowded"))
        rows = rows.join(crowded, "sig", "left").withColumn("shorter", shorter).withColumn("half", half)
        side = F.explode(F.when(F.col("crowded"), halves).otherwise(F.array(F.lit(0).cast("long"))))
        rows = stages.materialise(rows.select("sig", "role", "word", side.alias("side")))
        a = rows.filter(F.col("role") != _SHORTER).select("sig", "side", F.col("role").alias("role_a"), F.col("word").alias("a"))
        b = rows.filter(F.col("role") != _LONGER).select("sig", "side", F.col("role").alias("role_b"), F.col("word").alias("b"))
        partners = ((F.col("role_a") == _EVEN) & (F.col("role_b") == _EVEN) & (F.col("a") < F.col("b"))
                    | (F.col("role_a") == _LONGER) & (F.col("role_b") == _SHORTER))
        met = a.join(b, ["sig", "side"]).filter(partners & (F.levenshtein("a", "b", 1) == 1))
        return materialise(met.select("a", "b").distinct())


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word on the way over the forms. Forms must not run in a circle.

    Every step doubles the way, and the steps end when no word moves any more.
    """
    with Stages(forms.sparkSession) as stages:
        at = stages.materialise(forms.select("word", F.col("form").alias("root")))
        while True:
            onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
            root = F.coalesce("further", "root").alias("root")
            at = stages.materialise(at.join(onward, "root", "left").select("word", root, F.col("further").isNotNull().alias("moved")))
            if at.filter("moved").isEmpty():
                return materialise(at.select("word", "root"))
            at = at.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """For rows (word, n) with distinct words: word, n, n_near, form, form_n, root.

    Near words differ by exactly one inserted, deleted or replaced code point; n_near counts them. The form is the near word of the largest n, of
    equal ones the first in code-point order, if that n is ``ratio`` times the word's or more, else null; the root is the last word on the
    way over the forms, the word itself without one. n must be above 0 and ratio above 1, so that forms cannot run in a circle. An empty table gives no rows.
    """
    with Stages(words.sparkSession) as stages:
        words = stages.materialise(words.select("word", "n"))
        pairs = near_pairs(words)
        near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(pairs.select("b", "a"))
        others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
        best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form"))).alias("best")
        near = near.join(others, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
        form_n = -F.col("best.minus")
        chosen = form_n >= ratio * F.col("n")
        n_near = F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
        found = words.join(near, "word", "left").select("word", "n", n_near, F.when(chosen, F.col("best.form")).alias("form"),
                                                        F.when(chosen, form_n).alias("form_n"))
        found = materialise(found)
    last = roots(found.filter(F.col("form").isNotNull()).select("word", "form"))
    return found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "form", "root", "n", "n_near", "form_n")
