"""Lexical search against the score's definition, document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from shared_cases import EDGES, SF, documents, real  # noqa: F401

from tillflow.llm import catalog, lexical

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain_search(cases, items, k):
    docs = [(r[0], Counter(plain_terms(r[1]))) for r in cases]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in sorted(set(items), key=repr):
        query = Counter(plain_terms(text))
        found = []
        for doc_id, count, n in docs:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * count[t] // (1000 * count[t] + 12 * m))
                        for t, c in query.items() if t in count)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, i + 1, None if null else doc_id, -score) for i, (score, null, doc_id) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as score", "'y' as rank", "'z' as doc_id", "1 as _item")


ITEMS = [(1, "word same"), (2, "same text HERE"), (3, None), (4, ""), (5, "café 日本語 don't"), (5, "a row without an id"), (6, "word word word"),
         (6, "word word word"), (None, "negative id word"), (7, "nothinglikeit"), (8, "the same word word text " * 40)]


@pytest.mark.parametrize(("k", "most_docs", "part_bytes"), [(20, 16384, 8 << 20), (1, 2, 40), (3, 1, 8 << 20)])
def test_edges(spark, k, most_docs, part_bytes):
    found = lexical.search(documents(spark, EDGES), items_of(spark, ITEMS), k=k, most_docs=most_docs, part_bytes=part_bytes)
    assert got(found) == plain_search(EDGES, ITEMS, k)


def test_many_documents_and_ties(spark, real):  # noqa: F811
    rng = random.Random(2)
    # a few very common terms, a tail of rare ones, and a third of the rows equal
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(60_000)]
    cases = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(1500)]
    cases += [(2000 + i, "w1 w2 w3 w4 copied") for i in range(700)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 30])))) for i in range(60)] + [(100, "w1 w2 w3"), (101, "copied w9")]
    expected = plain_search(cases, items, 20)
    for most_docs in (300, 5000):
        assert got(lexical.search(documents(spark, cases).repartition(3), items_of(spark, items), most_docs=most_docs)) == expected


def test_empty_tables(spark):
    none = documents(spark, [])
    assert got(lexical.search(none, items_of(spark, ITEMS))) == []
    assert got(lexical.search(documents(spark, EDGES), items_of(spark, []))) == []
    assert got(lexical.search(documents(spark, [(1, None), (2, " \n")]), items_of(spark, ITEMS))) == []


def test_pair_bounds_hold_and_tighten():
    """For every prefix of the plan its bound is at least the best sum of these terms, at most the sum of the single maxima, and at times below it."""
    rng = np.random.default_rng(5)
    terms, docs = 12, 400
    tf = rng.integers(0, 4, (terms, docs)) * (rng.random((terms, docs)) < rng.random((terms, 1)))
    tf[:, 0] = 1
    sizes = rng.integers(5, 200, docs)
    held = [np.flatnonzero(row) for row in tf]
    starts = np.cumsum([0, *map(len, held)])
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * len(h) + 1))) for h in held], np.int64)
    index = lexical.PairIndex(list(range(docs)), sizes, np.arange(terms), starts, np.concatenate(held), np.concatenate([row[h] for row, h in zip(tf, held, strict=True)]),
                              weights, docs, int(sizes.sum()), 20)
    impacts = np.zeros((terms, docs), np.int64)
    for t, (places, x) in index.postings.items():
        impacts[t, places] = x
    tighter = 0
    for _ in range(50):
        chosen = rng.choice(terms, rng.integers(1, terms + 1), replace=False).tolist()
        query = [(t, int(rng.integers(1, 4))) for t in chosen]
        plan, bound, _ = index.plan(query)
        for j in range(len(plan) + 1):
            best = sum((c * impacts[t] for t, c in plan[:j]), np.zeros(docs, np.int64)).max()
            single = sum(c * index.top[t] for t, c in plan[:j])
            assert best <= bound[j] <= single
            tighter += bound[j] < single
        total = sum((c * impacts[t] for t, c in query), np.zeros(docs, np.int64))
        order = sorted(range(docs), key=lambda d: (-total[d], d))[:20]
        assert index.search(query, 1) == [(int(total[d]), d) for d in order if total[d] > 0]
    assert tighter


def test_registered_query(spark, real):  # noqa: F811
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got(catalog.QUERIES["op13_pair_maxscore"](spark, SF)) == plain_search(real, items, 20)
