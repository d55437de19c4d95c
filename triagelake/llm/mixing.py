"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The rows of each source are dealt by a hash of their id into ``BLOCKS`` blocks.  A source whose target is k times its size and a
rest draws every block k times and then, in the order of a keyed permutation, blocks until the rest is reached; of the block in
which that happens only the leading documents count, and of the last document only the leading words, so the words taken equal the
target rounded to whole words.  The number of draws of each source is its quota.

The output shards form a binary tree over all draws.  At each node the quotas of all sources are split between its two halves by one
multivariate-hypergeometric draw, down to the leaves, so each shard gets an exact number of blocks of each source as if all draws
had been shuffled together.  A node's random numbers depend only on the seed and its range of shards: any task can walk from the
root to its own leaf, and a lost task comes back the same.  The walk also yields where in each source's sequence of draws a shard
begins, so the shards' blocks are disjoint.  Within a shard rows are shuffled by a keyed hash.

Only per-source totals come to the driver: one row per source, checked against ``MAX_SOURCES``.

Defined results: a null text has no words; a document without words is never taken.  A null source is a source of its own, the last
one.  Rows that repeat an id are documents of their own.  An empty table gives an empty result; targets are 0 if nobody has words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.llm.common import WORD, stored

BLOCKS = 1024
#: More sources than this are an error: group them before mixing.
MAX_SOURCES = 100_000
#: Words that one task sorts when a shard is shuffled.
PART_WORDS = 1_000_000
WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _source_key() -> Column:
    """A text that tells a null source from every other."""
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS) -> list[float]:
    """Words for each source: all words shared by weight, at most ``MOST_REPEATS`` times a source's own, the excess reshared."""
    total, weight = sum(sizes), [weights[i % len(weights)] for i in range(len(sizes))]
    full: set[int] = set()
    while True:
        rest = total - sum(MOST_REPEATS * sizes[i] for i in full)
        free = sum(w for i, w in enumerate(weight) if i not in full)
        share = rest / free if free else 0.0
        over = {i for i, w in enumerate(weight) if i not in full and share * w > MOST_REPEATS * sizes[i]}
        if not over:
            return [float(MOST_REPEATS * sizes[i]) if i in full else share * w for i, w in enumerate(weight)]
        full |= over


def leaf_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws of each source for ``shard``, and how many draws of that source come before them."""
    total = int(quotas.sum())
    have, before, low, high = quotas.copy(), np.zeros_like(quotas), 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        wanted = total * middle // shards - total * low // shards
        random = np.random.default_rng([seed, low, high])
        left = random.multivariate_hypergeometric(have, wanted, method="marginals")
        if shard < middle:
            have, high = left, middle
        else:
            before, have, low = before + left, have - left, middle
    return have, before


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """Narrow rows that stand for the documents."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    return docs.select("doc_id", word_count().alias("size"), _source_key().alias("key"),
                       F.pmod(order, F.lit(BLOCKS)).cast("int").alias("block"), order.alias("place"))


def _shares(sized: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """key, source_size, target, number: one row per source."""
    found = sized.groupBy("key").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them before mixing")
    found.sort(key=lambda r: (r.key == "-", r.key))
    rows = [(r.key, r.size, t, i) for i, (r, t) in enumerate(zip(found, targets([r.size for r in found], weights)))]
    # MAX_SOURCES rows at most, so it goes to all tasks; a join by source would send a hot source to one of them.
    return F.broadcast(sized.sparkSession.createDataFrame(rows, "key string, source_size long, target double, number int"))


def plan_draws(sized: DataFrame, shares: DataFrame, shards: int, seed: int) -> DataFrame:
    """key, block, epoch, words (to take from the block), whole, shard: one row per draw of a block."""
    spark = sized.sparkSession
    blocks = sized.groupBy("key", "block").agg(F.sum("size").alias("block_words")).where("block_words > 0")
    whole_words = F.round("target").cast("long")
    epoch = F.explode(F.sequence(F.lit(0), F.floor(whole_words / F.col("source_size")).cast("int"))).alias("epoch")
    turns = blocks.join(shares, "key").withColumn("wanted", whole_words).select("*", epoch)
    # A source has at most BLOCKS blocks, so these windows are small whatever the input.
    order = Window.partitionBy("key", "epoch").orderBy(F.xxhash64(F.lit(seed), F.col("key"), F.col("epoch"), F.col("block")), "block")
    before = F.sum("block_words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("block_words")
    words = F.least(F.col("block_words"), F.col("wanted") - F.col("epoch") * F.col("source_size") - before)
    taken = turns.withColumn("turn", F.row_number().over(order)).withColumn("words", words).where("words > 0")
    draw = (F.row_number().over(Window.partitionBy("key").orderBy("epoch", "turn")) - 1).cast("long")
    draws = stored(taken.select("key", "number", "block", "epoch", "words", (F.col("words") == F.col("block_words")).alias("whole"),
                                draw.alias("draw")), "draws")

    quotas = np.zeros(max(1, shares.count()), dtype=np.int64)
    for row in draws.groupBy("number").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per source
        quotas[row.number] = row.n

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                have, before = leaf_quotas(quotas, shards, int(shard), seed)
                numbers = np.flatnonzero(have)
                yield pd.DataFrame({"number": numbers.astype("int32"), "shard": np.int32(shard), "low": before[numbers],
                                    "high": before[numbers] + have[numbers] - 1})

    ranges = spark.range(shards, numPartitions=min(shards, 64)).mapInPandas(leaves, "number int, shard int, low long, high long")
    owned = ranges.select("number", "shard", F.explode(F.sequence("low", "high")).alias("draw"))
    return stored(draws.join(owned, ["number", "draw"]).select("key", "block", "epoch", "words", "whole", "shard"), "shards")


def _before(size: str, *key: str, last: tuple[str, ...] = ()) -> Column:
    """Words of the documents of the same block that come earlier; only blocks that are taken in part need it."""
    order = Window.partitionBy(*key).orderBy(*last).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(size).over(order) - F.col(size)


def mixed_sizes(docs: DataFrame, shards: int = 64, seed: int = 7, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, and the shards that it goes to."""
    sized = stored(_sized(docs, seed), "sized")
    shares = _shares(sized, weights)
    draws = plan_draws(sized, shares, shards, seed)
    per_block = draws.groupBy("key", "block").agg(
        F.sum(F.col("whole").cast("long")).alias("times"), F.max(F.when(~F.col("whole"), F.col("words"))).alias("part"),
        F.sort_array(F.collect_set("shard")).alias("shards"))  # a block has MOST_REPEATS + 1 draws at most
    rows = sized.join(shares, "key", "left").join(per_block, ["key", "block"], "left")
    times = F.coalesce("times", F.lit(0)) * F.col("size")
    columns = ["doc_id", "size", "source_size", "target"]
    plain = rows.where("part IS NULL").select(*columns, times.alias("taken"), "shards")
    before = _before("size", "key", "block", last=("place", "doc_id", "size"))
    some = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - before))
    cut = rows.where("part IS NOT NULL").select(*columns, (times + some).alias("taken"), "shards")
    return plain.unionByName(cut)


def mix(docs: DataFrame, shards: int = 64, seed: int = 7, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The mixed documents, with all columns of ``docs``: repeated rows where a document is drawn more than once, shuffled by shard.

    A document that is taken in part keeps its leading words, joined by single spaces.
    """
    sized = stored(_sized(docs, seed), "sized")
    shares = _shares(sized, weights)
    draws = plan_draws(sized, shares, shards, seed)
    keyed = docs.withColumns({
        "__key": _source_key(), "__place": F.xxhash64(F.lit(seed), F.col("doc_id")),
        "__block": F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(BLOCKS)).cast("int"), "__size": word_count()})
    drawn = draws.select(F.col("key").alias("__key"), F.col("block").alias("__block"), F.col("epoch").alias("__epoch"),
                         F.col("words").alias("__part"), F.col("whole").alias("__whole"), F.col("shard").alias("__shard"))
    copies = keyed.where("__size > 0").join(drawn, ["__key", "__block"])
    before = _before("__size", "__key", "__block", "__epoch", last=("__place", "doc_id", "__size", "text"))
    cut = copies.where("NOT __whole").withColumn("__part", F.col("__part") - before).where("__part > 0")
    leading = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__part").cast("int")), " ")
    cut = cut.withColumn("text", F.when(F.col("__part") < F.col("__size"), leading).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("__part") < F.col("__size"), F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    rows = copies.where("__whole").unionByName(cut)
    local = F.xxhash64(F.lit(seed), F.col("__shard"), F.col("__epoch"), F.col("doc_id"))
    # A shard is shuffled as a whole: its rows are dealt by the leading bits of the sorting key into parts that a task can sort.
    words = shares.agg(F.sum("source_size")).first()[0] or 0
    parts = 1 + words // (shards * PART_WORDS)
    part = F.shiftrightunsigned("__local", 34) * F.lit(parts) / F.lit(1 << 30)
    return rows.withColumn("__local", local).withColumn("__slot", F.floor(part)).repartition("__shard", "__slot").sortWithinPartitions(
        "__shard", "__slot", F.shiftrightunsigned("__local", 34), "__local").select(*docs.columns)
