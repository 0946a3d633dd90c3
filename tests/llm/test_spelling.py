"""Spelling variants against brute force over all words and over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from shared_cases import EDGES, SF, documents, real  # noqa: F401

from tillflow.llm import catalog, spelling


def plain_words(cases, least_count=5, every=199):
    total = Counter()
    for doc_id, text, *_ in cases:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(count, ratio=5):
    words = sorted(count)
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for a in words:
        for b in by_length.get(len(a), []) + by_length.get(len(a) + 1, []):
            if (len(b) > len(a) or a < b) and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-count[x], x))
            if count[best] >= ratio * count[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), count[w], len(near[w]), count[form[w]] if w in form else None) for w in words)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def made_words(n=400):
    """Words close to one another: chains of edits, anagrams, repeated letters, letters of two bytes, long words."""
    rng = random.Random(4)
    words = {"abcdef", "fedcba", "aaaaaa", "aaaaaaa", "aaaaab", "éééééé", "eééééé",
             "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499}
    while len(words) < n:
        w = list(rng.choice(sorted(words)))
        at = rng.randrange(len(w))
        w[at:at + 1] = rng.choice([[], [rng.choice("abé")], [w[at], rng.choice("abü")]])
        if len(w) >= 6:
            words.add("".join(w))
    return {w: 5 * 3 ** rng.randrange(8) for w in sorted(words)}


@pytest.mark.parametrize("most", [1, 64])
def test_near_pairs(spark, most):
    count = made_words()
    words = spark.createDataFrame([(w,) for w in count], "word string").repartition(4)
    found = [tuple(sorted(r)) for r in spelling.near_pairs(words, most=most).collect()]
    assert len(found) == len(set(found))
    ordered = sorted(count)
    assert set(found) == {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1:] if one_edit(a, b)}


def test_signatures_agree_for_near_words():
    rng = random.Random(8)
    for _ in range(2000):
        a = "".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 14)))
        at = rng.randrange(len(a))
        b = a[:at] + rng.choice("abcdef") + a[at + 1:]
        longer = a[:at] + rng.choice("abcdef") + a[at:]
        for parts in (3, 5, 7):
            assert set(spelling.signatures(a, parts, 2, len(a))) & set(spelling.signatures(b, parts, 2, len(a)))
            assert set(spelling.signatures(a, parts, 1, len(a) + 1)) & set(spelling.signatures(longer, parts, 1, len(a) + 1))


def test_group_variants(spark):
    count = made_words()
    # a chain of forms longer than one doubling
    count |= {"qrstuv" + "w" * i: 5 ** (i + 1) for i in range(9)}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    assert got(spelling.group_variants(words)) == plain_variants(count)


def test_ties_take_the_first_form(spark):
    count = {"banana": 50, "bananb": 50, "bananc": 10, "Bänana": 50, "alonely": 5}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    found = {r.word: r for r in spelling.group_variants(words).collect()}
    assert (found["bananc"].form, found["bananc"].form_n, found["bananc"].n_near) == ("banana", 50, 2)
    assert found["banana"].form is None and found["banana"].root == "banana"
    assert tuple(found["alonely"]) == ("alonely", None, "alonely", 5, 0, None)


def test_word_counts(spark, real):  # noqa: F811
    text = "Naïve naïve NAÏVE straße ×÷×÷×÷ cafés中cafésĀletters " * 3
    cases = [*EDGES, *real, (77, text), (None, text), (78, None), (-5, "abcdefg€abcdefg " * 9)]
    for every, most in ((199, 300_000), (2, 3)):
        found = spelling.word_counts(documents(spark, cases).repartition(5), every=every, most_words=most)
        assert {r.word: r.n for r in found.collect()} == plain_words(cases, every=every)


def test_empty_tables(spark):
    assert got(spelling.group_variants(spelling.word_counts(documents(spark, [])))) == []
    assert got(spelling.group_variants(spelling.word_counts(documents(spark, [(1, None), (2, ""), (3, "short words only")])))) == []


def test_registered_query(spark, real):  # noqa: F811
    assert got(catalog.QUERIES["op12_spelling_variants"](spark, SF)) == plain_variants(plain_words(real))
