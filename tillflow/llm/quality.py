"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened for vectorised traversal."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .pieces import slices

FEATURES = ["n_bytes", "n_words", "word_bytes", "n_lines", "line_bytes", "longest_line", "upper", "digit", "mark", "stop", "exclaim", "bar", "other_mark",
            "high_byte", "white", "distinct_words", "top_word", "repeated_next", "longest_repeat", "marked_words", "upper_words", "short_words",
            "distinct_lines", "long_words", "worst_upper", "worst_mark", "worst_distinct", "plain_words"]

# classes of bytes: 1 A-Z, 2 a-z, 3 digit, 4 . and ,, 5 !, 6 |, 7 other ASCII marks, 8 white space, 9 above ASCII, 0 controls
_CLASS = np.zeros(256, np.uint8)
for _code in range(256):
    _c = chr(_code)
    _CLASS[_code] = (9 if _code > 127 else 1 if _c.isupper() else 2 if _c.islower() else 3 if _c.isdigit() else 4 if _c in ".," else 5 if _c == "!"
                     else 6 if _c == "|" else 8 if _c.isspace() else 7 if _c.isprintable() else 0)
_EDGE = str.maketrans("", "", ".,;:?'\"-()")


def document_statistics(text: str, window: int = 64) -> list[float]:
    """The FEATURES of one whole text. Shares are of bytes, words or lines; of an empty text all are 0."""
    words = text.split()
    if not words:
        return [float(len(text.encode())), *[0.0] * (len(FEATURES) - 1)]
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = _CLASS[data]
    counts = np.bincount(kinds, minlength=10)
    n, m = len(data), len(words)
    lines = text.split("\n")
    line_sizes = [len(x) for x in lines]
    frequent = Counter(words)
    numbers = {w: i for i, w in enumerate(frequent)}
    order = np.fromiter(map(numbers.__getitem__, words), np.int64, m)
    same = order[1:] == order[:-1]
    changes = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    # words by kind are counted once per distinct word
    sizes = np.fromiter(map(len, frequent), np.int64, len(frequent))
    often = np.fromiter(frequent.values(), np.int64, len(frequent))
    bare = [w.translate(_EDGE) for w in frequent]
    upper = np.fromiter((len(w) > 1 and w.isupper() for w in bare), bool, len(bare))
    plain = np.fromiter((w.isalpha() for w in bare), bool, len(bare))
    marked = np.fromiter((bool(w) and not w[-1].isalnum() for w in bare), bool, len(bare))
    # the worst of the stretches of equal length
    edges = np.arange(0, n, max(256, n // 16))
    length = np.diff(np.append(edges, n))
    worst_upper = (np.add.reduceat(kinds == 1, edges) / length)[length >= min(n, 128)].max(initial=0)
    worst_mark = (np.add.reduceat((kinds >= 5) & (kinds <= 7), edges) / length)[length >= min(n, 128)].max(initial=0)
    worst_distinct = min(len(set(words[i:i + window])) / min(window, m) for i in range(0, max(1, m - window + 1), window))
    share = counts / n
    return [n, m, sizes @ often / m, len(lines), n / len(lines), max(line_sizes), share[1], share[3], share[5:8].sum(), share[4], share[5], share[6],
            share[7], share[9], share[8], len(frequent) / m, often.max() / m, same.mean() if m > 1 else 0.0, np.diff(changes).max() / m, often[marked].sum() / m,
            often[upper].sum() / m, often[sizes <= 2].sum() / m, len(set(lines)) / len(lines), often[sizes >= 20].sum() / m, worst_upper, worst_mark,
            worst_distinct, often[plain].sum() / m]


def statistics_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([document_statistics(t or "") for t in texts], float).reshape(len(texts), len(FEATURES))


@dataclass
class Trees:
    """Complete binary trees of one depth in flat arrays: node i has the children 2i+1 and 2i+2; ``leaf`` holds the last level."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row; all trees go down a level at a time."""
        trees, inner = self.feature.shape
        raw = np.full(len(x), self.prior)
        if len(x) and trees:
            node, rows, each = np.zeros((len(x), trees), np.int64), np.arange(len(x))[:, None], np.arange(trees)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, self.feature[each, node]] > self.threshold[each, node])
            raw += self.leaf[each, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-raw))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2, ridge: float = 2.0) -> Trees:
    """Boost on the logistic loss. Values are cut into quantile bins once; a split is found from sums by node, feature and bin.

    Without rows the score is 0.5, with one label alone the smoothed share of that label.
    """
    inner, n = 2 ** depth - 1, len(y)
    prior = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), prior)
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    raw = np.full(n, prior)
    out = ([], [], [])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        slope, curve = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            sums = np.zeros((2, count, width, bins))
            for f in range(width):
                at = (node - first) * bins + binned[:, f]
                for k, weight in enumerate((slope, curve)):
                    sums[k, :, f] = np.bincount(at, weight, count * bins).reshape(count, bins)
            left = sums.cumsum(axis=3)
            whole = left[..., -1:]
            right = whole - left
            gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - whole[0] ** 2 / (whole[1] + ridge)
            for f, e in enumerate(edges):
                gain[:, f, len(e):] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            for i, b in enumerate(best):
                f, cut = divmod(int(b), bins)
                if gain[i, f, cut] > 1e-9:
                    feature[first + i], threshold[first + i] = f, edges[f][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        g, h = np.bincount(node - inner, slope, inner + 1), np.bincount(node - inner, curve, inner + 1)
        leaf = -rate * g / (h + ridge)
        raw += leaf[node - inner]
        for kept, new in zip(out, (feature, threshold, leaf), strict=True):
            kept.append(new)
    return Trees(*(np.array(x) for x in out), prior)


def document_features(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and ``features``, the FEATURES as an array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = statistics_matrix(batch.column(1).to_pylist())
            features = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, len(FEATURES), dtype=np.int32)), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), features], ["doc_id", "features"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(run, f"doc_id {kind}, features array<double>")


def held_out(id_col: str = "doc_id"):
    """The rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000) -> Trees:
    """Learn ``labels.quality`` of at most ``sample_rows`` labelled documents that are not held out.

    The sample is the first ids in the order of a hash, so it is the same in every run; it bounds what reaches the driver (one row of
    statistics each) and the broadcast of its ids. Null ids and null labels are left out; an id with several labels has its lowest, and of
    an id with several rows the lowest statistics in order are learned from.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("_quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    known = known.withColumnRenamed("doc_id", "_id")
    texts = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(known.select("_id")), "_id")
    # one row per id, combined before the shuffle, however often an id is repeated
    features = document_features(texts, "_id").groupBy(F.col("doc_id").alias("_id")).agg(F.min("features").alias("features"))
    rows = features.join(F.broadcast(known), "_id").orderBy("_id").collect()
    x = np.array([r.features for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([float(r._quality) for r in rows]))


def score_quality(docs: DataFrame, trees: Trees, threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: doc_id, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score >= threshold).

    The trees are a few flat arrays whose size the fit's parameters fix. Null and empty texts are scored by their statistics, which are 0;
    repeated rows are scored alike; an empty table gives no rows. Only id and text are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = model.value.score(statistics_matrix(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, trees: Trees, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text the trees accept, with all their columns."""
    model, columns = docs.sparkSession.sparkContext.broadcast(trees), docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = model.value.score(statistics_matrix(batch.column(at).to_pylist())) >= threshold
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
