"""Ranked lexical search by MaxScore with joint bounds of term pairs."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..sources.writers import Stages, materialise
from .pieces import slices

# Bytes of UTF-8: A-Z become a-z, ASCII letters and digits and all bytes from 80 stay, all others cut
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_INDEX = ["doc_ids", "sizes", "terms", "starts", "places", "tfs"]


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, in UTF-8: maximal runs of ASCII letters and digits and other code points from 80, A-Z lower-cased."""
    return (text or "").encode().translate(_TERMS).split()


class _Block:
    """Postings of a run of documents, by term."""

    def __init__(self):
        self.ids: list = []
        self.sizes: list[int] = []
        self.terms: list[int] = []
        self.places: list[int] = []
        self.tfs: list[int] = []
        self.docs, self.words = 0, 0

    def add(self, doc_id, words: list[bytes], vocabulary: dict[bytes, int]) -> None:
        if not words:
            return
        self.docs += 1
        self.words += len(words)
        found = Counter(words)
        hits = found.keys() & vocabulary.keys()
        if hits:
            place = len(self.ids)
            self.ids.append(doc_id)
            self.sizes.append(len(words))
            for term in hits:
                self.terms.append(vocabulary[term])
                self.places.append(place)
                self.tfs.append(found[term])

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        """Documents with a term of the vocabulary, and their postings sorted by term and document."""
        terms, places = np.array(self.terms, np.int32), np.array(self.places, np.int32)
        order = np.lexsort((places, terms))
        distinct, starts = np.unique(terms[order], return_index=True)
        ints = lambda x: pa.array([np.asarray(x, np.int32)], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(
            [pa.array([self.docs], pa.int64()), pa.array([self.words], pa.int64()), pa.array([self.ids], pa.list_(kind)), ints(self.sizes),
             ints(distinct), ints(np.append(starts, len(terms))), ints(places[order]), ints(np.array(self.tfs, np.int32)[order])],
            ["docs", "words", *_INDEX])


def _indexer(vocabulary: dict[bytes, int], most_docs: int, most_postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind = _Block(), pa.int64()
        for part in slices(batches):
            kind = part.schema.field(0).type
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                block.add(doc_id, terms_of(text), vocabulary)
                if block.docs >= most_docs or len(block.terms) >= most_postings:
                    yield block.row(kind)
                    block = _Block()
        if block.docs:
            yield block.row(kind)
    return run


class PairIndex:
    """One block of documents with impacts: per term its postings, largest and k-th largest impact; per pair the documents with both and the joint maximum."""

    def __init__(self, ids: list, sizes: np.ndarray, terms: np.ndarray, starts: np.ndarray, places: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, docs: int, words: int, k: int):
        self.ids, self.k = ids, k
        m = 75 + 25 * sizes.astype(np.int64) * docs // max(words, 1)
        tfs = tfs.astype(np.int64)
        impacts = np.repeat(weights[terms], np.diff(starts)) * (1_000_000_000 * tfs // (1000 * tfs + 12 * m[places]))
        self.postings = {int(t): (places[a:b], impacts[a:b]) for t, a, b in zip(terms, starts, starts[1:], strict=False) if weights[t]}
        self.top = {t: int(x.max()) for t, (_, x) in self.postings.items()}
        self.kth = {t: int(np.partition(x, -k)[-k]) if len(x) >= k else 0 for t, (_, x) in self.postings.items()}
        self.pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]) if ids[i] is not None else (True,))
        self.rank = np.empty(len(ids), np.int64)
        self.rank[order] = np.arange(len(ids))

    def pair(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The documents that hold both terms, the impacts of each, and the largest impact that a document has of both or one of them."""
        key = (a, b) if a < b else (b, a)
        if key not in self.pairs:
            (docs_a, x), (docs_b, y) = self.postings[key[0]], self.postings[key[1]]
            both, i, j = np.intersect1d(docs_a, docs_b, assume_unique=True, return_indices=True)
            joint = max(self.top[key[0]], self.top[key[1]], int((x[i] + y[j]).max()) if len(both) else 0)
            self.pairs[key] = both, x[i], y[j], joint
        docs, x, y, joint = self.pairs[key]
        return (docs, x, y, joint) if a < b else (docs, y, x, joint)

    def plan(self, query: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[int], list[bool]]:
        """The query's terms present here by rising bound; for each j a bound on the score of the first j terms; whether it ends with a pair.

        The bound takes a term alone or together with its neighbour, whichever adds less: the joint maximum is at most the sum of both maxima.
        """
        terms = sorted(((t, c) for t, c in query if t in self.postings), key=lambda q: (self.top[q[0]] * q[1], q[0]))
        bound, paired = [0], [False]
        for j, (t, c) in enumerate(terms):
            alone, together = bound[j] + c * self.top[t], None
            if j:
                s, d = terms[j - 1]
                least = min(c, d)
                together = bound[j - 1] + least * self.pair(s, t)[3] + (c - least) * self.top[t] + (d - least) * self.top[s]
            paired.append(together is not None and together < alone)
            bound.append(together if paired[-1] else alone)
        return terms, bound, paired

    def search(self, query: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
        """(score, place) of this block's best k documents with ``least`` and more, equal scores by id; each term counts as often as the query says."""
        terms, bound, paired = self.plan(query)
        least = max([least, 1, *[c * self.kth[t] for t, c in terms]])
        if bound[-1] < least:
            return []
        # a document with the first e terms alone stays below the threshold, so candidates hold one of the others
        e = max(j for j in range(len(bound)) if bound[j] < least)
        total = np.zeros(len(self.ids), np.int64)
        for t, c in terms[e:]:
            docs, x = self.postings[t]
            total[docs] += c * x
        found = np.flatnonzero(total)
        score = total[found]
        while True:
            if len(score) >= self.k:
                least = max(least, int(np.partition(score, -self.k)[-self.k]))
            stay = score + bound[e] >= least
            found, score = found[stay], score[stay]
            if not e or not len(found):
                break
            t, c = terms[e - 1]
            if paired[e]:
                s, d = terms[e - 2]
                docs, x, y, _ = self.pair(s, t)
                at, here = _look_up(docs, found)
                score[here] += d * x[at[here]] + c * y[at[here]]
                rest = np.flatnonzero(~here)
                for term, times in ((s, d), (t, c)):
                    docs, x = self.postings[term]
                    at, here = _look_up(docs, found[rest])
                    score[rest[here]] += times * x[at[here]]
                e -= 2
            else:
                docs, x = self.postings[t]
                at, here = _look_up(docs, found)
                score[here] += c * x[at[here]]
                e -= 1
        best = np.lexsort((self.rank[found], -score))[:self.k]
        return [(int(score[i]), int(found[i])) for i in best]


def _look_up(docs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted document stands in the sorted ``docs``, and whether it does."""
    if not len(docs):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
    return at, docs[at] == wanted


def _order(row: tuple) -> tuple:
    score, doc_id = row
    return (-score, True) if doc_id is None else (-score, False, doc_id)


def _searcher(items: list[tuple[object, list[tuple[int, int]]]], weights: np.ndarray, docs: int, words: int, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        kind = pa.int64()
        for batch in batches:
            kind = batch.column("doc_ids").type.value_type
            for row in range(batch.num_rows):
                ids, *arrays = (batch.column(c)[row].values for c in _INDEX)
                index = PairIndex(ids.to_pylist(), *[x.to_numpy(zero_copy_only=False) for x in arrays], weights, docs, words, k)
                for i, (_, query) in enumerate(items):
                    held = best[i]
                    # what the task has found so far is a bound for the next block
                    found = index.search(query, held[-1][0] if len(held) == k else 1)
                    if found:
                        best[i] = sorted([*held, *[(s, index.ids[p]) for s, p in found]], key=_order)[:k]
        if any(best):
            rows = [(i, score, doc_id) for i, held in enumerate(best) for score, doc_id in held]
            number, score, doc_id = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array([items[i][0] for i in number], id_type), pa.array(doc_id, kind),
                                              pa.array(score, pa.int64())], ["_item", "item_id", "doc_id", "score"])
    return run


def _search_part(docs: DataFrame, items: list[tuple[object, str]], k: int, most_docs: int, most_postings: int, item_type: T.DataType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type
    texts = [Counter(terms_of(text)) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*texts)))}
    id_type = docs.schema["doc_id"].dataType
    ints = T.ArrayType(T.IntegerType())
    blocks = T.StructType([T.StructField("docs", T.LongType()), T.StructField("words", T.LongType()), T.StructField("doc_ids", T.ArrayType(id_type)),
                           *[T.StructField(c, ints) for c in _INDEX[1:]]])
    with Stages(docs.sparkSession) as stages:
        index = stages.materialise(docs.mapInArrow(_indexer(vocabulary, most_docs, most_postings), blocks))
        size = index.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
        held = F.expr("explode(transform(terms, (t, i) -> struct(t, starts[i + 1] - starts[i] as n)))").alias("held")
        # one row per term of the items, whose number the part bounds
        df = {r.t: r.n for r in index.select(held).groupBy("held.t").agg(F.sum("held.n").alias("n")).collect()}
        weights = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        queries = [(item_id, [(vocabulary[t], n) for t, n in sorted(text.items())]) for (item_id, _), text in zip(items, texts, strict=True)]
        out = T.StructType([T.StructField("_item", T.LongType()), T.StructField("item_id", item_type), T.StructField("doc_id", id_type),
                            T.StructField("score", T.LongType())])
        search = _searcher(queries, weights, size.docs, size.words, k, to_arrow_type(item_type))
        found = index.select(*_INDEX).mapInArrow(search, out)
        order = W.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return materialise(found.select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, most_docs: int = 16384, most_postings: int = 2_000_000, part_bytes: int = 8 << 20) -> DataFrame:
    """Each item's ``k`` highest-scoring documents with a score above 0: item_id, rank (from 1), doc_id, score; equal scores by doc_id, null last.

    ``docs`` has doc_id and text, ``items`` item_id and text. The documents are read once into an index of blocks, which keeps the postings of the items'
    terms. Each block is then searched for every item: terms whose joint bound stays below the k-th best score so far propose no
    documents, and a proposed document is given up as soon as what it has and the bound of the rest stay below. The bounds add joint maxima of neighbouring
    terms, taken from lists of the documents that hold both, where they are tighter than two maxima of single terms. Scores are 64-bit integers.

    The items are dealt by hash to parts of about ``part_bytes`` of text, whose vocabulary goes to the driver and all tasks; each part reads the
    documents once. A task holds one block and k rows per item. The index is deleted when the result is written.

    A null or empty text has no terms: such a document counts nowhere and such an item has no rows. Each row is a document of its own,
    also with a null or repeated id. Equal item rows count once; an item_id with several texts is ranked once for each. Without documents or items there are no
    rows. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = size // part_bytes + 1
    results = []
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        rows = sorted(((r.item_id, r.text) for r in rows), key=repr)
        results.append(_search_part(docs, rows, k, most_docs, most_postings, items.schema["item_id"].dataType))
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found


# The scores by their definition, every document with every item.
ORACLE = r"""
with d as (select row_number() over () as r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
  tf as (select r, term, count(*) as tf from (select r, unnest(ws) as term from d) group by r, term),
  size as (select count(*) as n_docs, sum(len(ws)) as n_terms from d where len(ws) > 0),
  m as (select r, doc_id, 75 + (25 * len(ws)::bigint * n_docs) // n_terms::bigint as m from d, size),
  w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from tf, size group by term, n_docs),
  q as (select i, item_id, term, count(*) as c from (select i, item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from (select row_number() over () as i, item_id, text from (select distinct item_id, text from benchmark))) group by i, item_id, term),
  s as (select i, item_id, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score, any_value(doc_id) as doc_id
        from q join tf using (term) join w using (term) join m using (r) group by i, item_id, r)
select item_id, rank, doc_id, score
from (select item_id, row_number() over (partition by i order by score desc, doc_id asc nulls last) as rank, doc_id, score from s where score > 0)
where rank <= 20
"""
