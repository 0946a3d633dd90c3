"""The pipeline against brute force, stage by stage on the whole smallest table."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from shared_cases import EDGES, SF, documents
from test_pairs import plain_print, reach
from test_repeats import brute_lines

import corpus_pipeline
from tillflow.llm import bpe_transducer, mixing, quality


def copies(rows):
    """Which of (doc_id, text) stays, by all pairs."""
    prints = [plain_print(t) for _, t in rows]
    group = reach(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, i), i)
    return {i for (i, _), g in zip(rows, group, strict=True) if least[g] == i}


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near copies", "mix", "encode"]
    docs = start = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    trees = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), start.schema)
        assert docs.columns == start.columns
        seen.append(sorted((r.doc_id, r.text, r.source, r.n_chars) for r in docs.collect()))
    good = {i: t for i, (t, _) in rows.items() if trees.score(quality.statistics_matrix([t]))[0] >= 0.7}
    assert {i: t for i, t, *_ in seen[0]} == good and 0 < len(good) < len(rows)
    lines = {i: t for i, _, _, t in brute_lines(list(good.items()))}
    assert [(i, t, n) for i, t, _, n in seen[1]] == sorted((i, t, len(t)) for i, t in lines.items())
    kept = copies(sorted(lines.items()))
    assert {i for i, *_ in seen[2]} == kept and len(kept) < len(lines)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(i, lines[i], rows[i][1]) for i in kept])
    taken = {r[0]: (r[1], r[4]) for r in con.execute(mixing.ORACLE).fetchall()}
    mixed = Counter()
    for i, (size, n) in taken.items():
        if n // max(size, 1):
            mixed[i, lines[i]] += n // size
        if n % max(size, 1):
            mixed[i, None] += 1
    got = Counter((i, t if t == lines[i] else None) for i, t, *_ in seen[3])
    assert got == mixed
    parts = {i: t for i, t, *_ in seen[3] if t != lines[i]}
    assert all(lines[i].split()[:taken[i][1] % taken[i][0]] == t.split() for i, t in parts.items())
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_transducer.load_ranks(P.path(corpus_pipeline.RANKS)), special_tokens={})
    last = sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    expected = []
    for i, t, *_ in seen[3]:
        ids = np.array(encoding.encode_ordinary(t), "<u4")
        expected.append((i, len(ids), ids.tobytes(), hashlib.sha256(t.encode()).hexdigest()))
    assert last == sorted(expected)


@pytest.mark.parametrize("cases", [EDGES, []])
def test_stages_on_edges(spark, cases):
    docs = documents(spark, cases)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        found = out.collect()
        assert all(r[c] == "x" for r in found for c in out.columns[5:])
        docs = spark.createDataFrame(found, out.schema)
    corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    # stages on what the trees would reject as well
    docs = documents(spark, cases)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert all(r[c] == "x" for r in docs.collect() for c in docs.columns[5:])
    assert all(r.text for r in docs.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
