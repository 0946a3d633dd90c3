"""Token operators against the public libraries."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from shared_cases import EDGES, documents, real  # noqa: F401
from tokenizers import Tokenizer

from tillflow.llm import bpe_transducer, orc_ids, token_counts
from tillflow.llm.pieces import PieceTable

RANKS, WORDS, BYTES = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def cases(real):
    return EDGES + real


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_transducer.load_ranks(RANKS), special_tokens={})


def test_transducer_round_trip(spark, cases, encoding):
    out = bpe_transducer.decode(bpe_transducer.encode(documents(spark, cases), RANKS), RANKS).collect()
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in out), key=repr)
    assert got == sorted(((i, encoding.encode_ordinary(t or ""), t or "") for i, t, *_ in cases), key=repr)


def test_transducer_forgets_and_goes_on(encoding, real):
    small = bpe_transducer.Transducer(bpe_transducer.load_ranks(RANKS), limit=500)
    words = [w for _, t in real[:20] for w in t.split()] + ["ab" * 700, "q" * 2000, "é" * 900]
    for w in words:
        assert small.encode(w.encode(), every=40) == encoding._core_bpe.encode_single_piece(w.encode())
    assert small.known < 1500


def test_seams_hold_as_merging_says():
    t = bpe_transducer.Transducer({bytes([b]): b for b in range(97, 100)} | {b"aa": 200, b"ab": 201, b"aab": 202, b"ca": 203, b"caab": 204})
    for left in t.bytes_of:
        for right in t.bytes_of:
            both = t.bytes_of[left] + t.bytes_of[right]
            assert t.holds(left, right) == ([t.ranks[x] for x in t.merged(both)] == [left, right]), both


def test_stream_keeps_begun_code_points():
    data = "aé日\U0001f642z".encode() + b"\xff\xe2\x82" + b"ok\xf0\x9f"
    for step in (1, 2, 3, 5):
        stream = bpe_transducer.Utf8Stream()
        parts = [stream.feed(data[i:i + step]) for i in range(0, len(data), step)] + [stream.close()]
        assert "".join(parts).encode("utf-8", "surrogateescape") == data


def test_token_counts(spark, cases):
    library = Tokenizer.from_file(BYTES)
    expected = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in cases), key=repr)
    for head in (200_000, 50, 1):
        got = token_counts.token_counts(documents(spark, cases), BYTES, head_size=head).collect()
        assert sorted((tuple(r) for r in got), key=repr) == expected


def test_token_id_files(spark, cases, tmp_path):
    library = Tokenizer.from_file(WORDS)
    rows = sorted(cases, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for i, t, *_ in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    out = str(tmp_path / "ids")
    got = orc_ids.token_id_files(documents(spark, cases), WORDS, out=out).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)
    one = orc_ids.read_token_ids(spark, out, [9])
    assert [r.n_tokens for r in one.collect()] == [r[2] for r in expected if r[0] == 9]
    assert "PushedFilters: [In(doc_id, [9])" in one._jdf.queryExecution().toString() or "EqualTo(doc_id,9)" in one._jdf.queryExecution().toString()


def test_word_encoder_is_the_library(real):
    library, encode = Tokenizer.from_file(WORDS), orc_ids.WordEncoder(WORDS, 2)
    words = sorted({w for _, t in real for w in t.encode().split()})
    words += [x.encode() for x in ("ÀÉÎ,", "straße.", "A.,.", "ÿ", "it's", "a.b", "İ", "×", "ª", "don't.", "<|endoftext|>", "x<|startoftext|>", "e\u0301t", "1a")]
    assert encode(words) == [library.encode(w.decode(), add_special_tokens=False).ids for w in words]


def test_empty_tables(spark):
    none = documents(spark, [])
    assert bpe_transducer.decode(bpe_transducer.encode(none, RANKS), RANKS).count() == 0
    assert token_counts.token_counts(none, BYTES).count() == 0
    assert orc_ids.token_id_files(none, WORDS).count() == 0


def test_piece_table_starts_anew():
    table = PieceTable(lambda ps: [[int(p)] * (int(p) % 3) for p in ps], limit=10)
    for at in range(0, 60, 4):
        pieces = [str(x) for x in (at, at + 1, at, at + 2)]
        got = table.ids([pieces, [], pieces[:1]])
        assert [x.tolist() for x in got] == [[int(p) for p in ps for _ in range(int(p) % 3)] for ps in (pieces, [], pieces[:1])]
    assert len(table.slot) <= 14


def changed_rules(tmp_path):
    """The word tokenizer without its lower-casing, so that words can't be taken for their lower-cased letters."""
    import json
    rules = json.load(open(WORDS, encoding="utf-8"))
    rules["normalizer"]["normalizers"] = rules["normalizer"]["normalizers"][:-1]
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(rules), encoding="utf-8")
    return str(path)


def test_files_with_other_rules_go_through_the_library(spark, tmp_path):
    path = changed_rules(tmp_path)
    assert orc_ids.has_word_rules(WORDS) and not orc_ids.has_word_rules(path)
    cases = [(1, "Upper Case WORDS and lower ones"), (2, None), (3, "  "), (4, "ÀÉ ÿ. Straße, don't")]
    library = Tokenizer.from_file(path)
    expected = sorted((i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in cases)
    out = str(tmp_path / "ids")
    orc_ids.write_token_ids(documents(spark, cases), path, out, 2)
    assert sorted((r.doc_id, r.ids) for r in orc_ids.read_token_ids(spark, out).collect()) == expected
    assert expected != sorted((i, [*Tokenizer.from_file(WORDS).encode(t or "", add_special_tokens=False).ids, 2]) for i, t in cases)


def test_the_word_table_is_bounded_by_bytes():
    table = orc_ids.WordTable(WORDS, 2, limit_bytes=1000)
    library = Tokenizer.from_file(WORDS)
    for i in range(50):
        words = [f"{i}q".encode() * 40, b"again", f"w{i}".encode()]
        flat, cuts = table.flat_ids([[*words, b""]])
        assert flat.tolist() == [*library.encode(b" ".join(words).decode(), add_special_tokens=False).ids, 2]
        assert table.held <= 1000 + 200


def test_a_hot_id_is_split_and_parts_with_several_files_stay_in_order(spark, tmp_path):
    cases = [(None, f"text number {i} " + "word " * (i % 50)) for i in range(3000)] + [(7, f"other {i}") for i in range(500)] + [(i, f"t {i}") for i in range(100, 400)]
    docs = documents(spark, cases)
    out = str(tmp_path / "ids")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "300")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        orc_ids.write_token_ids(docs, WORDS, out, 2)
    finally:
        for key in ("spark.sql.files.maxRecordsPerFile", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"):
            spark.conf.unset(key)
    rows = orc_ids.document_offsets(spark, out).collect()
    assert len({r.file.split("-")[1] for r in rows if r.doc_id is None}) > 1
    at, last = 0, None
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert last is None or r.doc_id is not None and r.doc_id >= last
        last = r.doc_id
    assert len(rows) == len(cases)


def test_encoding_and_decoding_share_a_worker(spark):
    docs = documents(spark, [(i, t) for i, t in enumerate(["", None, "one two  three", "naïve 中文\n\n x", "one two"])])
    both = bpe_transducer.encode_and_decode(docs, RANKS)
    apart = bpe_transducer.decode(bpe_transducer.encode(docs, RANKS), RANKS)
    key = lambda r: r.doc_id
    assert both.columns == apart.columns and sorted(both.collect(), key=key) == sorted(apart.collect(), key=key)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
