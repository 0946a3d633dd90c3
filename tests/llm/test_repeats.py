"""Line and substring dedup against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from shared_cases import EDGES, documents, real  # noqa: F401

from tillflow.llm import line_runs, rlz

WHITE = " \t\n\x0b\x0c\r"


def smallest(i):
    return -(1 << 63) if i is None else i


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute_lines(cases, least=40, documents_=5):
    found = {}
    for i, t, *_ in cases:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            found.setdefault(k, []).append(smallest(i))
    out = []
    for i, t, *_ in cases:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key_of(x)) >= least and len(found[key_of(x)]) >= documents_ and smallest(i) < max(found[key_of(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_cases():
    rng = random.Random(8)
    lines = [f"Line number {i} with enough characters to count as long {'é' * (i % 5)}" for i in range(30)] + ["short", "", "x" * 39, "é" * 40, " \t" + "y" * 40 + "\r"]
    rows = []
    for i in range(60):
        own = [rng.choice(lines) for _ in range(rng.randrange(0, 9))]
        own = [x.upper() if rng.random() < 0.2 else "  " + x + "\t" if rng.random() < 0.2 else x for x in own]
        rows.append((rng.choice([i, i, i, 7, None]), "\n".join(own)))
    return rows + EDGES + [(500 + i, "a very common line that stands in all of these documents\n" * 3 + str(i)) for i in range(80)]


def check_lines(spark, cases, **more):
    docs = documents(spark, cases)
    out = line_runs.dedup_lines(docs, **more)
    # the table has columns of these names, so the counts get one more underscore, and what the user's hold stays
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    found = out.collect()
    assert all(r[c] == "x" for r in found for c in docs.columns[5:])
    assert line_runs.dedup_lines(docs.select("doc_id", "text"), **more).columns == ["doc_id", "text", "_n_lines", "_n_dropped"]
    got = sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], r.text) for r in found), key=repr)
    assert got == brute_lines(cases)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_lines(spark, batches):
    check_lines(spark, line_cases(), batches=batches)


def test_lines_edges(spark, real):
    check_lines(spark, real)
    check_lines(spark, [])
    check_lines(spark, [(None, "z" * 50)] * 6)
    check_lines(spark, [(1, "z" * 50)] * 4 + [(2, "Z" * 50 + "\n" + "z" * 50)])


def test_lines_of_repeated_ids(spark):
    lines = [f"Line number {i} with enough characters to count as long" for i in range(20)]
    cases = [(i, "\n".join([f"text {n} of this id"] + lines[n % 10:n % 10 + 10])) for n in range(40) for i in (None, 7)] + [(7, "\n".join(lines[:10] * 3))] * 8
    cases += [(100, "\n".join(lines))]
    check_lines(spark, cases)
    held = line_runs.repeated_lines(documents(spark, cases)).collect()
    assert held and all(len(r.gone) == len({(g.h1, g.h2) for g in r.gone}) == 10 for r in held)


def test_lines_sql(real):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    cases = [r for r in {smallest(r[0]): r for r in line_cases() if r[0] is not None}.values()] + [(i + 10_000, t) for i, t in real]
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in cases])
    expected = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute_lines(cases)]
    assert sorted(con.execute(line_runs.ORACLE).fetchall()) == sorted(expected)


def test_runs_are_levelled(spark):
    runs = line_runs.LineRuns(spark, fanout=2)
    for at in range(5):
        rows = [(100 - at, k, 0) for k in range(at, at + 3)]
        runs.add(spark.createDataFrame(rows, "id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = {r.h1: r.holder for r in runs.entries().collect() if r.holder is not None}
    assert held == {k: 100 - max(0, k - 2) for k in range(7)}
    assert {r.h1 for r in runs.frequent(3).collect()} == {2, 3, 4}


def brute_repeats(cases, window=50):
    words = [[w for w in "".join(" " if c in WHITE else c for c in t or "").split(" ") if w] for _, t, *_ in cases]
    first = {}
    for (i, *_), ws in zip(cases, words, strict=True):
        for at in range(len(ws) - window + 1):
            k = tuple(ws[at:at + window])
            first[k] = min(first.get(k, smallest(i)), smallest(i))
    out = []
    for (i, *_), ws in zip(cases, words, strict=True):
        gone = set()
        for at in range(len(ws) - window + 1):
            if first[tuple(ws[at:at + window])] < smallest(i):
                gone.update(range(at, at + window))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def check_repeats(spark, cases, window=50, **more):
    docs = documents(spark, cases)
    out = rlz.remove_repeats(docs, window=window, **more)
    assert out.columns == [*docs.columns, "__n_words", "__n_removed"]
    found = out.collect()
    assert all(r[c] == "x" for r in found for c in docs.columns[5:])
    got = sorted(((r.doc_id, r["__n_words"], r["__n_removed"], r.text) for r in found), key=repr)
    assert got == brute_repeats(cases, window)


def repeat_cases(window=50):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (window - 1, window, window + 1, 2 * window, 3 * window, 60)]
    passages.append(["same"] * (window + 20))
    rows = []
    for i in range(70):
        own = []
        for _ in range(rng.randrange(0, 5)):
            own += [rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))]
            p = rng.choice(passages)
            a = rng.randrange(0, 8)
            own += p[a if rng.random() < 0.3 else 0:]
        rows.append((i * 7 % 71, rng.choice([" ", "\n", "\t "]).join(own)))
    texts = [t for _, t in rows]
    return rows + [(200 + i, texts[i % 5]) for i in range(25)] + [(3, texts[8]), (None, texts[9]), (None, texts[9]), (None, texts[2])] + EDGES


def test_repeats(spark):
    check_repeats(spark, repeat_cases())


def test_repeats_real(spark, real):
    check_repeats(spark, real)


def test_repeats_short_windows_and_edges(spark):
    check_repeats(spark, repeat_cases(12), window=12, gram=3)
    check_repeats(spark, [])
    check_repeats(spark, [(1, "a " * 49), (2, "a " * 49)])
    check_repeats(spark, [(1, "a " * 50), (1, "a " * 50), (2, "a\t" * 50), (2, "a " * 50)])


def test_word_hashes_do_not_depend_on_parts():
    text = ("some words é " * 50 + "x" * 300 + "\n\ttail ").encode()
    whole = rlz.word_hashes(text)
    assert len(whole) == len(text.split())
    assert all((rlz.word_hashes(text, part) == whole).all() for part in (1, 7, 64, 1000))
    by_word = {}
    for w, h in zip(text.split(), whole.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word) and len(rlz.word_hashes(b" \n")) == 0


def test_factors():
    places, blocks, at = np.array([3, 4, 5, 6, 20, 21]), np.array([1, 1, 2, 2, 2, 2]), np.array([8, 9, 4, 5, 6, 7])
    assert [tuple(f.values()) for f in rlz.factors(places, blocks, at, 50)] == [(3, 51, 1, 8), (5, 51, 2, 4), (20, 51, 2, 6)]
