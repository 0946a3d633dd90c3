"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, then a seeded choice of blocks.

DataFrame functions only. What is computed over all sources together sees one row per source, or a few per source and shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.writers import materialise
from .pieces import unused

# White space, and a word with the white space behind it.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
_BEFORE = (W.unboundedPreceding, -1)


def word_count(text: Column) -> Column:
    """Words of a text: each is replaced by one letter, which makes no list of words."""
    return F.coalesce(F.length(F.regexp_replace(F.ltrim(text, F.lit(WHITE)), WORD, "x")).cast("long"), F.lit(0).cast("long"))


def _source_key(source: Column) -> Column:
    """A key without nulls that sorts like the sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sources: DataFrame, weights: Sequence[int], times: int) -> DataFrame:
    """Add ``total``, ``target`` and ``place`` to one row per source (``key``, ``source_size``).

    Sources in key order weigh ``weights`` in turn and share the total of all sizes. A target stops at ``times`` the source's size and the excess is
    shared again by weight. That ends where every open source has the same words per unit of weight: in the order of
    size per weight the stopped sources come first, so running sums find the level.
    """
    place = F.row_number().over(W.orderBy("key"))
    rows = sources.withColumn("place", place)
    rows = rows.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long"))
    rows = rows.withColumn("most", F.col("source_size") * times).withColumn("total", F.sum("source_size").over(W.partitionBy()))
    order = W.orderBy(F.col("source_size") / F.col("weight"), "place")
    stopped_before = F.coalesce(F.sum("most").over(order.rowsBetween(*_BEFORE)), F.lit(0).cast("long"))
    open_weight = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("total") - stopped_before) / open_weight).withColumn("rank", F.row_number().over(order))
    is_open = F.col("weight") * F.col("level") <= F.col("most")
    first_open = F.min(F.when(is_open, F.struct("rank", "level"))).over(W.partitionBy())
    rows = rows.withColumn("first", first_open)
    target = F.when(F.col("rank") < F.col("first.rank"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("first.level"))
    return rows.withColumn("target", target).select("key", "source_size", "place", "total", "target")


def shard_quotas(sources: DataFrame, block_words: int, shards: int) -> DataFrame:
    """Per source, ``seats``: for each shard the blocks that the source has in it and all shards before.

    Seats go to the highest quotients target / (2j + 1). With n sources, a source's share q of m seats lies between
    (m - n/2)q - 1/2 and (m + n/2)q + 1/2, so only the few quotients between these bounds are ranked. Seats given in an earlier
    shard stay given in a later one, as ties fall in source order everywhere.
    """
    rows = sources.withColumn("n", F.sum(F.when(F.col("target") > 0, 1).otherwise(0)).over(W.partitionBy()))
    rows = rows.withColumn("blocks", F.expr(f"total div {block_words}"))
    rows = rows.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards)))).withColumn("m", F.expr(f"blocks * shard div {shards}"))
    share = F.when(F.col("target") > 0, F.col("target") / F.col("total")).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0).cast("long"), F.ceil(share * (F.col("m") - F.col("n") / 2) - 0.5) - 1)
    high = F.when(F.col("target") > 0, F.floor(share * (F.col("m") + F.col("n") / 2) + 0.5) + 1).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("low", low).withColumn("high", F.greatest("low", high))
    open_seats = rows.withColumn("open", F.col("m") - F.sum("low").over(W.partitionBy("shard")))
    ranked = open_seats.filter(F.col("high") > F.col("low")).withColumn("j", F.explode(F.expr("sequence(low, high - 1)")))
    ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("shard").orderBy((F.col("target") / (2 * F.col("j") + 1)).desc(), "place", "j")))
    won = ranked.filter(F.col("rank") <= F.col("open")).groupBy("key", "shard").agg(F.count(F.lit(1)).alias("won"))
    seats = rows.select("key", "shard", "low").join(won, ["key", "shard"], "left")
    seats = seats.select("key", F.struct("shard", (F.col("low") + F.coalesce("won", F.lit(0))).alias("seats")).alias("s"))
    return seats.groupBy("key").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["seats"]).alias("seats"))


def prefix_sums(rows: DataFrame, group: str, key: str, value: str, out: str, ties: Sequence[str], digits: int = 2, levels: int = 2) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the group's rows before this one in the order of ``key``, a hexadecimal hash.

    A window never holds a whole group: rows are summed by leading digits, level by level, each window
    runs over the at most 16^digits sums below one prefix, and the last over the rows of one full prefix.
    """
    def prefix(level: int) -> Column:
        return F.substring(key, 1, digits * level)

    rows = rows.withColumn(f"_p{levels}", prefix(levels))
    sums = {levels: rows.groupBy(group, f"_p{levels}").agg(F.sum(value).alias("_s"))}
    for level in range(levels - 1, 0, -1):
        sums[level] = sums[level + 1].groupBy(group, F.substring(f"_p{level + 1}", 1, digits * level).alias(f"_p{level}")).agg(F.sum("_s").alias("_s"))
    before = None
    for level in range(1, levels + 1):
        outer = [group] if level == 1 else [group, f"_p{level - 1}"]
        table = sums[level] if level == 1 else sums[level].withColumn(f"_p{level - 1}", F.substring(f"_p{level}", 1, digits * (level - 1)))
        inside = F.coalesce(F.sum("_s").over(W.partitionBy(*outer).orderBy(f"_p{level}").rowsBetween(*_BEFORE)), F.lit(0).cast("long"))
        table = table.withColumn("_in", inside)
        if before is not None:
            table = table.join(before, outer).withColumn("_in", F.col("_in") + F.col("_before"))
        before = table.select(group, f"_p{level}", F.col("_in").alias("_before"))
    at = W.partitionBy(group, f"_p{levels}").orderBy(key, *ties).rowsBetween(*_BEFORE)
    rows = rows.withColumn("_in", F.coalesce(F.sum(value).over(at), F.lit(0).cast("long")))
    rows = rows.join(before, [group, f"_p{levels}"]).withColumn(out, F.col("_in") + F.col("_before"))
    return rows.drop("_in", "_before", f"_p{levels}")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), times: int = 3, block_words: int = 16, shards: int = 8, seed: str = "mix-1",
        id_col: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, source, ``size`` (words), ``source_size``, ``target`` (its source's), ``taken`` (words the mix takes,
    repeats counted) and ``shard_words`` (the same by output shard), and the columns ``keep``.

    A source's documents, ordered by a seeded hash of their id, are one stream that is cut into blocks of ``block_words`` words and starts anew at its
    end; each shard takes its quota of blocks from where the last one stopped. A source never gives more than ``times`` its size,
    so its last block may be short.

    Null texts have size 0; a null source is a source of its own, ordered last; null ids are hashed as an empty id; rows with
    equal ids are ordered by size and are taken one by one; an empty table gives no rows. Other columns are not read.
    """
    key = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                                   key.alias("hash"), *keep))
    rows = rows.withColumn("key", _source_key(F.col("source")))
    sources = targets(rows.groupBy("key").agg(F.sum("size").alias("source_size")), weights, times)
    quotas = shard_quotas(sources, block_words, shards)
    # one row per source, written so that its true size decides how it is joined
    plan = materialise(sources.join(quotas, "key").select(
        "key", "source_size", "target",
        F.transform("seats", lambda s: F.least(s * block_words, F.col("source_size") * times)).alias("ends")))
    rows = prefix_sums(rows, "key", "hash", "size", "begin", ["size"]).join(plan, "key")

    def words_in_first(n: Column) -> Column:
        rounds = F.floor(n / F.col("source_size"))
        rest = n - rounds * F.col("source_size")
        return rounds * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(rest - F.col("begin"), F.col("size")))

    ends = F.when(F.col("source_size") > 0, F.transform("ends", words_in_first)).otherwise(F.transform("ends", lambda _: F.lit(0).cast("long")))
    rows = rows.withColumn("_upto", ends)
    by_shard = F.transform("_upto", lambda x, i: x - F.when(i > 0, F.get("_upto", i - 1)).otherwise(F.lit(0).cast("long")))
    return rows.select("doc_id", "source", "size", "source_size", "target", F.element_at("_upto", -1).alias("taken"), by_shard.alias("shard_words"),
                       *keep)


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a document as often as it is taken whole, and once more with its first words if a part is taken.

    Documents that the mix does not take are gone. Rows that agree in id, source and text are one row here, taken as often as all of
    them; of their other columns the smallest values stay.
    """
    names = docs.columns
    rest = [c for c in names if c not in ("doc_id", "source", "text")]
    version, others, own, origin, of, n, size, part = unused(names, "_version", "_rest", "_id", "_source", "_v", "_taken", "_size", "_part")
    marked = docs.withColumn(version, F.xxhash64(F.col("text")))
    taken = mix(marked, keep=[version], **options).filter("taken > 0")
    taken = taken.groupBy("doc_id", "source", version).agg(F.sum("taken").alias(n), F.first("size").alias(size))
    taken = taken.select(F.col("doc_id").alias(own), F.col("source").alias(origin), F.col(version).alias(of), n, size)
    unique = marked.groupBy("doc_id", "source", version).agg(
        F.min("text").alias("text"), F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias(others) if rest else F.lit(None).alias(others))
    same = F.col("doc_id").eqNullSafe(F.col(own)) & F.col("source").eqNullSafe(F.col(origin)) & (F.col(version) == F.col(of))
    rows = unique.join(taken, same).withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} + {size} - 1) div {size} - 1"))))
    left = F.col(n) - F.col(part) * F.col(size)
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    text = F.when(left >= F.col(size), F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), left.cast("int")), ""))
    rows = rows.withColumn("text", text)
    return rows.select(*[F.col(c) if c in ("doc_id", "source", "text") else F.col(others)[c].alias(c) for c in names])


ORACLE = r"""
with docs as (
  select doc_id, case when source is null then '1' else '0' || source end as key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix-1/' || coalesce(doc_id::varchar, '')) as hash
  from documents),
sized as (select key, sum(size)::bigint as source_size from docs group by key),
weighed as (
  select *, row_number() over (order by key) as place, sum(source_size) over ()::bigint as total, source_size * 3 as most,
         ((row_number() over (order by key) - 1) % 3 + 1)::bigint as weight
  from sized),
levels as (
  select *, row_number() over o as rank,
         (total - coalesce(sum(most) over (o rows between unbounded preceding and 1 preceding), 0))::double
           / (sum(weight) over (o rows between current row and unbounded following))::double as level
  from weighed window o as (order by source_size::double / weight::double, place)),
opened as (select min(rank) as rank, arg_min(level, rank) as level from levels where weight * level <= most),
aims as (
  select l.key, l.place, l.source_size, l.total, case when l.rank < o.rank then most::double else weight * o.level end as target
  from levels l, opened o),
bounds as (
  select *, total // 16 as m, case when target > 0 then target / total else 0 end as share,
         sum(case when target > 0 then 1 else 0 end) over () as n
  from aims),
ranged as (
  select *, greatest(0, ceil(share * (m - n / 2.0) - 0.5)::bigint - 1) as low,
         case when target > 0 then floor(share * (m + n / 2.0) + 0.5)::bigint + 1 else 0 end as high
  from bounds),
tried as (select *, unnest(range(low::bigint, greatest(low, high)::bigint)) as j from ranged),
ranked as (select *, row_number() over (order by target / (2 * j + 1) desc, place, j) as rank from tried),
won as (select key, count(*) as won from ranked where rank <= (select any_value(m) - sum(low) from ranged) group by key),
quota as (
  select r.key, r.source_size, r.target, least((r.low + coalesce(w.won, 0)) * 16, r.source_size * 3)::bigint as words
  from ranged r left join won w on r.key = w.key),
placed as (
  select *, coalesce(sum(size) over (partition by key order by hash, size rows between unbounded preceding and 1 preceding), 0)::bigint as begin
  from docs)
select p.doc_id, p.size, q.source_size, q.target,
       (case when q.source_size > 0 then (q.words // q.source_size) * p.size
          + greatest(0, least(q.words % q.source_size - p.begin, p.size)) else 0 end)::bigint as taken
from placed p join quota q on p.key = q.key
"""
