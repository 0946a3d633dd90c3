"""SimHash near-dedup over pivot distance tables."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.writers import materialise
from .cells import Forest, deal, starts_of_groups, whole_groups
from .components import components
from .pieces import slices, unused

BITS = 64


def simhash(text: str | None, shingle: int = 4, part: int = 1 << 16) -> int:
    """Unsigned fingerprint of a whole text: a bit is set if it is in over half the XXH64 (seed 42) of its word shingles, repeats included.

    A-Z count as lower case; words are what ASCII white space leaves. Fewer words than a shingle make one shingle, none make 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    # one text with single spaces: a shingle is a slice of it
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    begins = (ends - np.array([len(w) + 1 for w in words])).tolist()
    ends = (ends - 1).tolist()
    digest, last = xxhash.xxh64_intdigest, len(words) - 1
    for at in range(0, n, part):
        hashes = np.array([digest(joined[begins[i]:ends[min(i + shingle - 1, last)]], 42) for i in range(at, min(n, at + part))], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, ``print``, the fingerprint as a signed long of the same 64 bits, and the long columns ``carry``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([simhash(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]], ["doc_id", "print", *carry])
    schema = ", ".join([f"doc_id {docs.schema[id_col].dataType.simpleString()}", "print long", *[f"{c} long" for c in carry]])
    return docs.select(id_col, text, *carry).mapInArrow(run, schema)


def references(n: int) -> list[int]:
    """Seeded reference fingerprints as signed longs."""
    values = [xxhash.xxh64_intdigest(f"reference {i}".encode(), 42) for i in range(n)]
    return [v - (1 << 64) if v >> 63 else v for v in values]


def block_count(n: int, most_bits: int, pair_cost: float = 0.05) -> int:
    """Into how many blocks to cut fingerprints, for the least work on ``n`` of them.

    Fingerprints within ``most_bits`` bits differ in at most as many blocks, so with b blocks they agree in one of the choices of b - most_bits
    of them: as many rows per fingerprint, and buckets of n / 2^bits. A pair to look at costs ``pair_cost`` rows. With more fingerprints there are
    more and longer keys, so the pairs grow little faster than n where a fixed number of blocks has n^2.
    """
    def work(blocks: int) -> float:
        keys, bits = math.comb(blocks, most_bits), BITS * (blocks - most_bits) / blocks
        return keys * (n + pair_cost * n * n / 2 ** (bits + 1))
    return min(range(most_bits + 1, 3 * most_bits + 4), key=work)


def _block_keys(print_: Column, blocks: int, most_bits: int) -> Column:
    """For each choice of ``blocks`` - ``most_bits`` blocks of bits its number and the bits of these blocks.

    Fingerprints within ``most_bits`` bits agree in all blocks of one choice. There their distances to every reference are equal; to the
    references with one bit set in the blocks these distances spell the blocks' bits. So the bits are the key of "all
    coordinate differences in these blocks are 0", and a join on it misses no pair.
    """
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    spans = list(zip(cuts, cuts[1:], strict=False))
    keys = []
    for number, chosen in enumerate(combinations(spans, blocks - most_bits)):
        key = F.lit(0).cast("long")
        for a, b in chosen:
            bits = F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            key = F.shiftleft(key, b - a).bitwiseOR(bits)
        keys.append(F.struct(F.lit(number).alias("block"), key.alias("key")))
    return F.array(*keys)


_CELL = ["block", "key", "cell_a", "cell_b"]


def _linked(most_bits: int):
    """Cells sorted by the distance to the first reference; gives for each linked fingerprint one of its group in the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in whole_groups(batches, _CELL):
            n = cell.num_rows
            prints = cell.column("print").to_numpy().view(np.uint64)
            table = cell.column("distances").chunk(0).flatten().to_numpy().reshape(n, -1).T
            chunk = cell.column("chunk").to_numpy()
            two = cell.column("cell_a").to_numpy() != cell.column("cell_b").to_numpy()
            starts = starts_of_groups(cell, _CELL)
            end = np.repeat(starts[1:], np.diff(starts))
            forest, rows, step = Forest(n), np.arange(n), 1
            # row i against row i + step, for all cells at once; a row leaves when its cell or the window of the first coordinate ends
            while len(rows):
                rows = rows[rows + step < end[rows]]
                rows = rows[table[0, rows + step] - table[0, rows] <= most_bits]
                left = rows[(forest.root[rows] != forest.root[rows + step]) & (~two[rows] | (chunk[rows] != chunk[rows + step]))]
                for distances in table[1:]:
                    left = left[np.abs(distances[left] - distances[left + step]) <= most_bits]
                left = left[np.bitwise_count(prints[left] ^ prints[left + step]) <= most_bits]
                forest.link(left, left + step)
                step += 1
            linked = np.flatnonzero(forest.root != np.arange(n))
            signed = prints.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[forest.root[linked]])], ["a", "b"])
    return run


def links(prints: DataFrame, most_bits: int = 4, pivots: int = 16, most: int = 1000) -> DataFrame:
    """Links (a, b) between distinct fingerprints (``print``, from a table) that connect all within ``most_bits`` bits, directly or by others.

    Each fingerprint gets its distances to ``pivots`` seeded references once, on the JVM. Fingerprints that agree in blocks
    of bits, whose number follows that of the fingerprints, meet in a cell; there, in the order of the first distance, a pair goes if a coordinate differs by more than ``most_bits``, and
    a pair that stays is verified on all bits. Pairs that are connected already need no test, and a cell gives one row per linked
    fingerprint, so a large group of near copies makes no list of its pairs. Buckets of over ``most`` rows are split.
    """
    table = F.array(*[F.bit_count(F.col("print").bitwiseXOR(F.lit(r))).cast("tinyint") for r in references(pivots)])
    blocks = block_count(prints.count(), most_bits)
    rows = prints.select("print", table.alias("distances"), F.explode(_block_keys(F.col("print"), blocks, most_bits)).alias("k"))
    rows = rows.select("print", "distances", "k.block", "k.key")
    cells = deal(rows, ["block", "key"], F.xxhash64("print"), most)
    cells = cells.withColumn("first", F.get("distances", F.lit(0)))
    cells = cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "first", "print")
    return cells.select(*_CELL, "chunk", "print", "distances").mapInArrow(_linked(most_bits), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, most_bits: int = 4, id_col: str = "doc_id", text: str = "text",
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, ``fingerprint`` (16 lowercase hex digits), ``component_id``, the smallest doc_id reachable by links, and the long
    columns ``carry``.

    Documents link where their fingerprints differ in at most ``most_bits`` bits. Equal fingerprints are one before any pair is looked at, so copies cost
    nothing more.

    Null, empty and white texts have fingerprint zero and link like any others; repeated rows are links of each other; a null id is
    never the smallest unless the whole group has no other; an empty table gives no rows. Other columns are not read.
    """
    own = materialise(fingerprints(docs, shingle, id_col, text, carry))
    distinct = materialise(own.groupBy("print").agg(F.min("doc_id").alias("first")))
    labels = components(links(distinct.select("print"), most_bits)).withColumnRenamed("node", "print")
    labelled = distinct.join(labels, "print", "left").withColumn("label", F.coalesce("label", "print"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = materialise(labelled.join(smallest, "label").select("print", "component_id"))
    joined = own.join(classes, "print")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id", *carry)


# what tells rows with equal ids apart: 128 hash bits of the text
_TEXT = ("h1", "h2")


def keep_one(docs: DataFrame, shingle: int = 4, most_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` of one document per group of near-duplicates, the one with the smallest doc_id, with all their columns.

    A row is judged by its own text: rows with a kept doc_id all stay where their texts are in the group that it leads, and go where they are
    in another; rows without an id stay only if their group has no id. Rows with equal ids are told apart by 128 hash bits of their texts.
    """
    hashes = dict(zip(_TEXT, (F.xxhash64("text"), F.xxhash64(F.lit(1), "text")), strict=True))
    found = near_duplicates(docs.select("doc_id", "text").withColumns(hashes), shingle, most_bits, carry=_TEXT)
    gone, h1, h2 = unused(docs.columns, "_gone", "_h1", "_h2")
    lost = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    lost = lost.select(F.col("doc_id").alias(gone), F.col("h1").alias(h1), F.col("h2").alias(h2)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(gone)) & (hashes["h1"] == F.col(h1)) & (hashes["h2"] == F.col(h2))
    # a merge join at every size: the texts are shuffled once, in proportion to the input
    return docs.join(lost.hint("merge"), same, "left_anti")
