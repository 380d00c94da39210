"""Mixing sources to target weights: equal-token blocks apportioned by Sainte-Laguë, then chosen by a seed.

Sources share a budget of words by weight; no source gets more than a multiple of its own words, and what it cannot take is shared
among the others. Blocks of equal size go to sources, and within a source to its shards, by highest quotient (votes / (2 k + 1)),
so every shard has an integer quota. Within a shard documents lie in a seeded order and form one stream of words; the chosen blocks
are spread evenly over it from a seeded start, so the words taken of a document follow from its offset alone and no block is ever a
row. Only ids, sources and sizes are shuffled, never texts.

Rows of one doc_id and source are repeated alike in mixed_documents, by the largest of their numbers.

The table of sources (one row for each) is ordered in one task; documents are not. Null text has size 0, null source is a source of
its own, ordered last. Documents of size 0 take 0. Equal doc_ids are rows of their own. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.tables import few, free_names, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2.0
#: Words of a block. Rounding moves a shard by less than a block, so blocks are small against shards.
BLOCK_WORDS = 32
#: Words of a shard, about: the rows that one window holds.
SHARD_WORDS = 1_000_000
SEED = 17


def seeded(seed: int, *columns: str) -> Column:
    """60 bits of a digest, as a long of at least 0."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """source, source_size, target for (source, size) rows: the weighted share of share * all words, at most repeats * own words.

    Sources stop in the order of what they can take for their weight; the level is where the sum of the stopped and the weighted
    rest meets the budget.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.select("source", "source_size", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("_w"))
    rows = rows.withColumns({"_cap": F.col("source_size") * repeats, "_ratio": F.col("source_size") * repeats / F.col("_w")})
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    rows = rows.withColumns({
        "_budget": F.sum("source_size").over(whole) * share,
        "_stopped": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        "_rest": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
    })
    level = (F.col("_budget") - F.col("_stopped")) / F.col("_rest")
    rows = rows.withColumn("_level", F.max(F.when(level <= F.col("_ratio"), level)).over(whole))
    return rows.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))).alias("target"))


def apportion(cells: DataFrame, keys: list[str], order: list[str], seats: str, votes: str = "votes") -> DataFrame:
    """Add quota: the seats of each group of keys, given to its cells by the highest votes / (2 k + 1), ties in the given order.

    Rounded shares are at most half a cell's share of the cells away from the result, so only quotients that near are compared: all
    in all about six for each cell.
    """
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    share = F.when(F.col("_sum") > 0, F.col(votes) / F.col("_sum")).otherwise(F.lit(0.0))
    cells = cells.withColumns({"_sum": F.sum(votes).over(group), "_cells": F.count(F.lit(1)).over(group)})
    cells = cells.withColumns({"_near": F.floor(share * F.col(seats) + 0.5), "_reach": F.ceil(share * F.col("_cells") / 2) + 1})
    cells = cells.withColumn("_sure", F.greatest(F.lit(0), F.col("_near") - F.col("_reach")).cast("long"))
    cells = cells.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
    seat = F.explode(F.sequence(F.col("_sure"), (F.col("_near") + F.col("_reach")).cast("long")))
    tried = cells.filter(F.col(votes) > 0).select(*dict.fromkeys(keys + order), "_left", F.col(votes).alias("_v"), seat.alias("_k"))
    best = Window.partitionBy(*(keys or [F.lit(0)])).orderBy((F.col("_v") / (2 * F.col("_k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in order], "_k")
    won = tried.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= F.col("_left"))
    names = list(dict.fromkeys(keys + order))
    won = won.groupBy(*[F.col(c).alias(f"_by_{c}") for c in names]).agg(F.count(F.lit(1)).alias("_won"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in names])
    joined = cells.join(won, same, "left").withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
    return joined.select(*[c for c in cells.columns if not c.startswith("_")], "quota")


def mix(sizes: DataFrame, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED, **shares) -> DataFrame:
    """doc_id, source, size -> doc_id, source, size, source_size, target, taken.

    A document is taken whole once for every full pass over its shard, and once more as far as chosen blocks cover it.
    """
    sizes = written(sizes.select("doc_id", "source", "size"))
    targets = source_targets(sizes, **shares).withColumn("_shards", F.ceil(F.col("source_size") / shard_words).cast("long"))
    targets = targets.withColumn("blocks", F.floor(F.sum("target").over(Window.partitionBy(F.lit(0))) / block + 0.5).cast("long"))
    quotas = apportion(targets.withColumnRenamed("_shards", "shards"), [], ["source"], "blocks", "target")
    quotas = quotas.select(F.col("source").alias("_source"), "source_size", "target", "shards", "quota")

    docs = sizes.join(few(written(quotas)), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    spot = seeded(seed, "doc_id")
    docs = docs.withColumns({"_spot": spot, "_shard": F.when(F.col("shards") > 1, F.pmod(spot, F.col("shards"))).otherwise(F.lit(0))})
    cells = docs.groupBy("source", "_shard").agg(F.sum("size").cast("double").alias("votes"), F.first("quota").alias("seats"))
    cells = cells.withColumnRenamed("_shard", "shard")
    cells = apportion(cells, ["source"], ["shard"], "seats").select(F.col("source").alias("_source"), "shard", F.col("votes").cast("long").alias("_words"), "quota")
    docs = docs.drop("quota", "shards").join(few(written(cells)), F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("shard"))).drop("_source")

    stream = Window.partitionBy("source", "_shard").orderBy("_spot", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    docs = docs.withColumn("_end", F.sum("size").over(stream)).withColumn("_start", F.col("_end") - F.col("size"))
    n = F.greatest(F.ceil(F.col("_words") / block), F.lit(1)).cast("long")
    docs = docs.withColumns({"_n": n, "_full": F.floor(F.col("quota") / n).cast("long"), "_more": F.pmod(F.col("quota"), n)})
    docs = docs.withColumn("_turn", F.pmod(seeded(seed, "source", "_shard"), F.col("_n")))

    def chosen(b: Column) -> Column:
        """Blocks chosen before block b."""
        return F.floor((b + F.col("_turn")) * F.col("_more") / F.col("_n")).cast("long") - F.floor(F.col("_turn") * F.col("_more") / F.col("_n")).cast("long")

    def covered(offset: Column) -> Column:
        """Words of chosen blocks before an offset of the stream."""
        b = F.floor(offset / block).cast("long")
        return chosen(b) * block + (chosen(b + 1) - chosen(b)) * (offset - b * block)

    part = covered(F.col("_end")) - covered(F.col("_start"))
    taken = F.when(F.col("size") > 0, F.col("_full") * F.col("size") + part).otherwise(F.lit(0))
    return docs.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


@free_names("doc_id", "text", "source")
def mixed_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mixture as documents: whole texts, each as often as it is taken; a part that is left over comes whole with its odds.

    The odds are fixed by the seed and doc_id, so reruns agree. Columns of docs, repeated documents as repeated rows.
    """
    taken = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), seed=seed, **options)
    odds = seeded(seed + 1, "doc_id") / float(1 << 60)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + odds)).otherwise(F.lit(1)).cast("int")
    taken = taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source")).agg(F.max(times).alias("_times")).filter("_times > 0")
    kept = docs.join(taken, docs["doc_id"].eqNullSafe(F.col("_id")) & docs["source"].eqNullSafe(F.col("_source")))
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[docs[c] for c in docs.columns])
