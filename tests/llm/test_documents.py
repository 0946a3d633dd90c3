"""Mixing, fingerprints and quality scores."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from shared_cases import EDGES, SF, documents, real  # noqa: F401

from tillflow.llm import catalog, mixing, prefix_hash, quality
from tillflow.llm.prefix_hash import Fingerprint, PrefixHashes, Spliced


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def check_neighbours(spark, cases):
    rows = order(cases)
    texts = [r[1] or "" for r in rows]
    expected = []
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        cut = len(t) // 2
        edited = t[:len(t) - cut] + after[:cut]
        marks = [Fingerprint.of(PrefixHashes(x)) for x in (t, edited, after)]
        expected.append((rows[i][0], len(t), hashlib.sha256(edited.encode()).hexdigest(), str(marks[0]), str(marks[1]),
                         prefix_hash.likeness(marks[0], marks[1]), prefix_hash.likeness(marks[0], marks[2])))
    got = [tuple(r) for r in prefix_hash.edited_neighbours(documents(spark, cases)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_edited_neighbours(spark, real):
    check_neighbours(spark, EDGES + real)
    check_neighbours(spark, [(1, "alone é")])
    check_neighbours(spark, [(i % 3, f"text {i % 4}") for i in range(40)])
    assert prefix_hash.edited_neighbours(documents(spark, [])).count() == 0


def test_fingerprints_tell_texts_apart(spark, real):
    got = {r.doc_id: r for r in prefix_hash.fingerprints(documents(spark, real)).collect()}
    by_text = {}
    for i, t in real:
        by_text.setdefault(t, set()).add(got[i].fingerprint)
        assert got[i].n_chars == len(t)
    assert all(len(x) == 1 for x in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)
    for a in list(got.values())[:20]:
        assert str(Fingerprint.parse(a.fingerprint)) == a.fingerprint


def test_likeness():
    def like(a, b):
        return prefix_hash.likeness(*(Fingerprint.of(PrefixHashes(x)) for x in (a, b)))
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    assert like(text, text) == like("", "") == 1 and like(text, "") == like("", text) == 0
    assert 0.4 < like(text, text[:1500] + "z" * 1500) <= 0.5
    assert 0.8 < like(text, text[:1000] + "zz" + text[1000:]) < 1
    assert like("aaaa", "aaaaa") < 1 and like("ab", "cd") == 0


def test_likeness_of_short_texts():
    marks = [Fingerprint.of(PrefixHashes(x)) for x in ("ab", "ac", "xbc", "abc", "abcdez", "abcxyz")]
    assert prefix_hash.likeness(marks[0], marks[1]) == 0.5 and prefix_hash.likeness(marks[2], marks[3]) == pytest.approx(2 / 3)
    assert prefix_hash.likeness(marks[4], marks[5]) == pytest.approx(4 / 6)


def test_spans_and_extensions():
    rng = random.Random(5)
    a, b = ("".join(rng.choice("abé") for _ in range(n)) for n in (400, 300))
    b = b[:100] + a[50:200] + b[100:]
    x, y = PrefixHashes(a), PrefixHashes(b)
    joined, text = Spliced(x, 130, y, 170), a[:130] + b[:170]
    plain = PrefixHashes(text)
    for _ in range(500):
        i, j, n = rng.randrange(400), rng.randrange(450), rng.randrange(1, 30)
        if i + n <= len(a) and j + n <= len(b):
            assert (x.span(i, i + n)[0] == y.span(j, j + n)[0]) == (a[i:i + n] == b[j:j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert x.extension(i, y, j) == k
        i, n = sorted(rng.randrange(301) for _ in range(2))
        assert joined.span(i, n)[0] == plain.span(i, n)[0]
    assert x.extension(50, y, 100) >= 150


def twin(cases, sql):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    if cases:
        con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3] if len(r) > 3 else "s") for r in cases])
    return sorted(map(repr, con.execute(sql).fetchall()))


@pytest.mark.parametrize("cases", [
    EDGES, [], [(1, None, "en", None)], [(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, None, "en", "z")],
    [(i, "w " * (i * 37 % 91), "en", ["é", "b", None, "", "c", "hot", "hot", "hot", "hot"][i % 9]) for i in range(700)],
    [(1, "w " * 5000, "en", "a"), (2, "w " * 10, "en", "b"), (3, "w " * 10, "en", "c")]])
def test_mix_matches_sql(spark, cases):
    got = mixing.mix(documents(spark, cases)).collect()
    assert sorted(repr((r.doc_id, r["size"], r.source_size, r.target, r.taken)) for r in got) == twin(cases, mixing.ORACLE)
    for r in got:
        assert r.taken <= 3 * r["size"] and sum(r.shard_words) == r.taken and min(r.shard_words) >= 0
    taken, aims = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        aims[r.source] = r.target, r.source_size
    assert all(abs(taken[s] - aims[s][0]) <= 16 for s in taken)
    # the targets, by resharing the excess until none is above
    sources = sorted(aims, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    left, open_, fixed = sum(n for _, n in aims.values()), set(sources), {}
    while open_:
        over = {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * aims[s][1]}
        if not over:
            fixed |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        left -= sum(3 * aims[s][1] for s in over)
        fixed |= {s: 3 * aims[s][1] for s in over}
        open_ -= over
    assert all(aims[s][0] == pytest.approx(fixed[s]) for s in sources)


def test_quotas_are_the_highest_quotients(spark):
    rows = [("0a", 500, 1, 1000, 611.25), ("0b", 300, 2, 1000, 288.5), ("0c", 150, 3, 1000, 99.25), ("0d", 50, 4, 1000, 1.0)]
    sources = spark.createDataFrame(rows, "key string, source_size long, place int, total long, target double")
    got = {r.key: r.seats for r in mixing.shard_quotas(sources, 3, 7).collect()}
    quotients = sorted(((-t / (2 * j + 1), p, k) for k, _, p, _, t in rows for j in range(400)))
    for shard in range(1, 8):
        first = [k for *_, k in quotients[:333 * shard // 7]]
        assert {k: s[shard - 1] for k, s in got.items()} == {k: first.count(k) for k, *_ in rows}


def test_quality_held_out(spark):
    def read(name):
        return spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{name}.parquet")
    got = catalog.QUERIES["op9_quality_trees"](spark, SF.replace("0.001", "0.01")).collect()
    assert len(got) == read("documents").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    label = {r.doc_id: r.quality for r in read("labels").collect()}
    judged = [(r.predicted, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    assert len(judged) > 50 and np.mean([p == q for p, q in judged]) >= 0.97


def test_quality_edges(spark):
    docs, none = documents(spark, EDGES), documents(spark, [])
    labels = spark.createDataFrame([(7, 1), (8, 0), (3, 1), (9, 0), (1, None), (None, 1)], "doc_id long, quality int")
    for train in (labels, labels.filter("quality = 1"), labels.limit(0)):
        trees = quality.fit_quality(docs, train)
        got = quality.score_quality(docs, trees).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
        kept = quality.accepted(docs, trees)
        assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.score_quality(none, quality.fit_quality(none, labels)).count() == 0


def test_quality_learns_from_one_row_per_id(spark, monkeypatch):
    seen = []
    plain = quality.fit_trees
    monkeypatch.setattr(quality, "fit_trees", lambda x, y: seen.append((x, y)) or plain(x, y))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    cases = [(i, f"the text of number {i} " * (i + 1)) for i in range(40)]
    learned = [r.doc_id for r in labels.filter(~quality.held_out()).orderBy("doc_id").collect()]
    more = [(learned[0], f"one more text {'of this id ' * n}") for n in range(200)]
    quality.fit_quality(documents(spark, cases + more), labels)
    (x, y), = seen
    texts = {i: [t for j, t in cases + more if j == i] for i in learned}
    assert x.tolist() == [min(quality.statistics_matrix(texts[i]).tolist()) for i in learned] and y.tolist() == [i % 2 for i in learned]


def test_trees_flatten_as_they_were_grown():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.fit_trees(x, y, rounds=30)
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.97
    raw = trees.prior
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        node = 0
        while node < len(f):
            node = 2 * node + 1 + int(x[0, f[node]] > t[node])
        raw += leaf[node - len(f)]
    assert trees.score(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-raw)))
