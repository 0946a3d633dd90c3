"""Pair operators against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from shared_cases import EDGES, SF, documents, real  # noqa: F401
from pyspark.sql import functions as F

from tillflow.llm import simhash, sphere_filters
from tillflow.llm.cells import deal
from tillflow.llm.components import components


def reach(n, pairs):
    """The component of each of n nodes, named by its smallest node."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def plain_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "").translate(dict.fromkeys(range(9, 14), " "))).split(" ") if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def check_simhash(spark, cases, most=1000, monkeypatch=None):
    prints = [plain_print(r[1]) for r in cases]
    pairs = [(i, j) for i in range(len(cases)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    group = reach(len(cases), pairs)
    smallest = {}
    for r, g in zip(cases, group, strict=True):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    expected = sorted(((r[0], f"{p:016x}", smallest.get(g)) for r, p, g in zip(cases, prints, group, strict=True)), key=repr)
    got = [tuple(r) for r in simhash.near_duplicates(documents(spark, cases)).collect()]
    assert sorted(got, key=repr) == expected


def near_copies(n, words=120):
    rng = random.Random(9)
    base = [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(500)) for _ in range(words)]
    return [(1000 + i, " ".join(w if rng.random() > 0.004 else f"x{i}" for w in base)) for i in range(n)]


def test_simhash_components(spark, real):
    check_simhash(spark, EDGES + real + near_copies(150))


def test_simhash_splits_hot_buckets(spark, monkeypatch):
    cases = near_copies(300, 40)
    plain = simhash.links
    monkeypatch.setattr(simhash, "links", lambda prints, bits: plain(prints, bits, most=20))
    check_simhash(spark, cases)


def test_simhash_edges(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    check_simhash(spark, [(None, "same words"), (None, "same words"), (3, ""), (2, None)])
    rows = [(i, "one text here for all of them") for i in range(30)] + [(40, "another text that is not near")]
    docs = documents(spark, rows)
    kept = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 40] and kept.columns == docs.columns


def test_keep_one_judges_by_row(spark):
    texts = ["one text here for all of them", "a second text about something else", "and the third is about neither of these", "the last words stand alone"]
    rows = [(3, texts[0]), (8, texts[1]), (8, texts[0]), (None, texts[0]), (None, texts[2]), (None, None), (9, texts[3]), (9, texts[3]), (12, texts[3]), (12, " ")]
    group = {}
    for i, t in rows:
        group.setdefault(plain_print(t), []).append(i)
    least = {p: min((i for i in ids if i is not None), default=None) for p, ids in group.items()}
    assert all((a ^ b).bit_count() > 4 for a in group for b in group if a != b)
    expected = [(i, t) for i, t in rows if least[plain_print(t)] == i]
    assert (8, texts[1]) in expected and (None, texts[2]) in expected
    assert sorted(((r.doc_id, r.text) for r in simhash.keep_one(documents(spark, rows)).collect()), key=repr) == sorted(expected, key=repr)


def test_deal_meets_every_pair_once(spark):
    rows = spark.range(230).select(F.col("id"), F.when(F.col("id") < 200, 1).otherwise(F.col("id")).alias("k"))
    cells = {}
    for r in deal(rows, ["k"], F.xxhash64("id"), 40).collect():
        cells.setdefault((r.k, r.cell_a, r.cell_b), []).append((r.id, r.chunk))
    seen = sorted(tuple(sorted((x, y))) for (_, a, b), m in cells.items() for i, (x, p) in enumerate(m) for y, q in m[:i] if a == b or p != q)
    assert seen == [(i, j) for i in range(200) for j in range(i + 1, 200)]
    assert max(map(len, cells.values())) < 160


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(0, 120)]
    star = [(500, 501 + i) for i in range(80)]
    noise = [(1000 + rng.randrange(150), 1000 + rng.randrange(150)) for _ in range(100)]
    pairs = chain + star + noise + [(7, 7)]
    rng.shuffle(pairs)
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = reach(1200, pairs)
    assert set(got) == {x for a, b in pairs if a != b for x in (a, b)}
    assert all((got[a] == got[b]) == (expected[a] == expected[b]) for a in got for b in (7, 500, 1000, 1075) if b in got)
    assert len(set(got.values())) == len({expected[x] for x in got})


VECTORS = "vec_id long, embedding array<float>, label int"


def brute_links(rows, least=0.93):
    def fine(r):
        return r[2] is not None and r[1] is not None and len(r[1]) and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1])
    out, groups = [0] * len(rows), {}
    for i, r in enumerate(rows):
        if fine(r):
            groups.setdefault((r[2], len(r[1])), []).append(i)
    pairs = []
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], np.float32).astype(float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
        pairs += [(members[i], members[j]) for i, j in zip(a, b, strict=True)]
    for a, b in pairs:
        out[a] += 1
        out[b] += 1
    group = reach(len(rows), pairs)
    smallest = {}
    for r, g in zip(rows, group, strict=True):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    return sorted(((r[0], n, smallest.get(g), r[0] == smallest.get(g)) for r, n, g in zip(rows, out, group, strict=True)), key=repr)


def vectors(n, dim, spread, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 8), dim))
    return [(i, (centres[i % len(centres)] + spread * rng.normal(size=dim)).astype(np.float32).tolist(), i % 3) for i in range(n)]


def test_sphere_filters_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, nan], 0), (4, [inf, 1.0], 0), (5, [1.0, None], 0), (6, [], 0), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 0),
            (9, [2.0, 4.0], 0), (9, [2.0, 4.0], 0), (10, [1.0, 2.0], 1), (None, [1.0, 2.0], 0), (11, [1.0], 0), (12, [-1.0], 0), (13, [3.0], 0),
            (14, [1e-30, 2e-30], 0), (15, [3e38, 3e38], 0), (16, [1.0, 2.0, 0.1], 0), (17, [1.0, 2.0, 0.2], 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as node", "1 as filter", "0 as copies", "'y' as dim")
    got = sorted((tuple(r) for r in sphere_filters.near_duplicates(df).collect()), key=repr)
    assert got == brute_links(rows)
    assert sphere_filters.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("dim,spread", [(64, 0.1), (16, 0.12), (5, 0.15)])
def test_sphere_filters_against_all_pairs(spark, dim, spread):
    rows = vectors(900, dim, spread)
    rows += [(2000 + i, rows[i % 7][1], rows[i % 7][2]) for i in range(60)]
    got = {r.vec_id: r for r in sphere_filters.near_duplicates(spark.createDataFrame(rows, VECTORS), most=50).collect()}
    expected = brute_links(rows)
    assert len(got) == len(rows) and sum(n for _, n, *_ in expected) > 1000
    assert all(got[i].n_links <= n for i, n, *_ in expected)
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(n for _, n, *_ in expected)


def test_sphere_filters_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.normal(size=x.shape)
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.9301 * x + np.sqrt(1 - 0.9301 ** 2) * other
    code = sphere_filters.product_code(64)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert np.mean(met) >= 0.99


def test_sphere_filters_on_real_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert sorted((tuple(r) for r in sphere_filters.near_duplicates(df).collect()), key=repr) == brute_links(rows)


def test_blocks_follow_the_number_of_fingerprints():
    """What is looked at per fingerprint, in rows of keys and pairs of uniform fingerprints, grows far slower than their number."""
    import math
    work = []
    for n in (10 ** k for k in range(4, 11)):
        blocks = simhash.block_count(n, 4)
        keys, bits = math.comb(blocks, 4), 64 * (blocks - 4) / blocks
        work.append(keys + 0.05 * keys * n / 2 ** (bits + 1))
    # a million times the fingerprints, not a hundred times the work for each
    assert work[-1] < 100 * work[0] and all(b < 6 * a for a, b in zip(work, work[1:], strict=False))
    assert [simhash.block_count(n, 4) for n in (0, 10, 10 ** 9)] == [5, 5, 7]


@pytest.mark.parametrize("blocks", [6, 7, 8])
def test_simhash_components_with_more_blocks(spark, real, monkeypatch, blocks):
    monkeypatch.setattr(simhash, "block_count", lambda n, most_bits: blocks)
    check_simhash(spark, EDGES + near_copies(60))
