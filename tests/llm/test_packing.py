"""Packing against the library's ids and a best-fit search over all windows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from shared_cases import EDGES, SF, documents, real  # noqa: F401

from tillflow.llm import catalog, packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def expected_ids(text):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def plain_best_fit(lengths, room):
    """Best-fit decreasing by looking at every open window: how much each window holds."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(room - n)
    return sorted(free)


@pytest.mark.parametrize("room", [1, 7, 64, 100])
def test_best_fit_decreasing(room):
    rng = random.Random(room)
    for n in (0, 1, 5, 200):
        lengths = [min(room, int(rng.expovariate(6 / room)) + 1) for _ in range(n)]
        windows, left = packing.best_fit_decreasing(lengths, room)
        assert sorted(i for w in windows for i in w) == list(range(n))
        assert [room - sum(lengths[i] for i in w) for w in windows] == left and all(x >= 0 for x in left)
        assert sorted(left) == plain_best_fit(lengths, room)


@pytest.mark.parametrize("most_gap", [0, 3, 63])
def test_close_gaps(most_gap):
    rng = random.Random(most_gap)
    for n in (0, 1, 2, 40):
        windows, doc = [], 0
        for _ in range(n):
            window, free = [], 64
            while free > 0 and rng.random() < 0.8 or not window:
                size = rng.randint(1, free)
                window.append((doc, 10, size))
                doc, free = doc + 1, free - size
            windows.append(window)
        lengths = {d: size for w in windows for d, _, size in w}
        out = packing.close_gaps(windows, 64, most_gap)
        fills = [sum(size for _, _, size in w) for w in out]
        # only gaps that may stay, and windows that end at a power of two
        assert all(64 - f <= most_gap or f & (f - 1) == 0 for f in fills) and all(0 < f <= 64 for f in fills)
        spans = {}
        for d, start, size in (p for w in out for p in w):
            spans.setdefault(d, []).append((start, size))
        assert spans.keys() == lengths.keys()
        for d, found in spans.items():
            at = 10
            for start, size in sorted(found):
                assert start == at and size > 0
                at += size
            assert at == 10 + lengths[d]


def check(found, cases, room):
    """Every id of every document lies in one piece; sequences have no holes. Returns the fill of every sequence."""
    docs, sequences = {}, {}
    for r in found:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        docs.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    fills = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= room
        fills.append(at)
    texts = {}
    for r in cases:
        texts.setdefault(r[0], []).append(np.array(expected_ids(r[1]), "<u4").tobytes())
    assert docs.keys() == texts.keys()
    for doc_id, wanted in texts.items():
        pieces = sorted(docs[doc_id], key=lambda p: (p[2], p[0]))
        assert sum(len(p[1]) for p in pieces) == sum(map(len, wanted))
        if len(wanted) == 1:
            assert b"".join(p[1] for p in pieces) == wanted[0] and {p[2] for p in pieces} == {len(wanted[0]) // 4}
    return fills


@pytest.mark.parametrize(("room", "most_gap", "block"), [(2048, 8, 1 << 22), (64, 0, 5_000), (1, 0, 100)])
def test_pack(spark, room, most_gap, block):
    cases = [(r[0], r[1] if r[1] is None or room > 1 else r[1][:500]) for r in EDGES]
    found = packing.pack(documents(spark, cases).repartition(3), VOCABULARY, 1, room, most_gap, block).collect()
    fills = check(found, cases, room)
    assert all(room - f <= most_gap or f & (f - 1) == 0 for f in fills)


def test_pack_empty_and_text_ids(spark):
    empty = packing.pack(documents(spark, []), VOCABULARY, 1)
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    named = spark.createDataFrame([("a", "one two"), ("b", None)], "key string, body string")
    found = packing.pack(named, VOCABULARY, 1, id_col="key", text="body").collect()
    assert sum(r.length for r in found if r.doc_id == "a") == len(expected_ids("one two"))
    assert [(r.length, r.doc_tokens) for r in found if r.doc_id == "b"] == [(1, 1)]


def test_registered_query(spark, real):  # noqa: F811
    found = catalog.QUERIES["op11_best_fit_packing"](spark, SF).collect()
    assert {r.doc_id for r in found} == {d for d, _ in real}
    fills, docs = {}, {}
    for r in found:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
        docs.setdefault(r.doc_id, []).append(r)
    padding = sum(2048 - f for f in fills.values() if f & (f - 1))
    assert padding <= 0.01 * sum(fills.values())
    for doc_id, text in real:
        ids = np.array(expected_ids(text), "<u4")
        pieces = sorted(docs[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
