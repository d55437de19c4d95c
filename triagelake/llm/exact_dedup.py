"""Exact duplicates through an extendible-hash index that is kept as files in the shared folder.

Every text has a 64-bit key.  The index holds one entry per distinct text; entries live in buckets, and a directory maps the
leading bits of a key to its bucket.  While a bucket holds more entries than ``capacity`` it is split, and the directory is
doubled when the bucket is as deep as the directory.  Owner tasks each write one range of buckets and keys.  Entries with the same
key form a chain; texts are told apart by their bytes and never by the key alone.

Copies are combined before the shuffle, so a text that a third of all rows hold costs one entry per map task.  Afterwards only
keys, checksums and ids move.

Defined results: a null text counts as empty, and all empty texts are copies of each other.  Rows that share both text and id are
one document: they stay or go together.  A row without id never stays if a copy has one; where no copy has an id, all of them
stay, as none can be preferred.  An empty table gives an empty result.  Further columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.llm.common import stored

#: Leading bits that the directory can tell apart; so it has 65,536 rows at most, whatever the input.
MAX_DEPTH = 16


@dataclass(frozen=True)
class Index:
    """``entries``: bucket, depth, key, chain, text_sha256, n_bytes, keep_id, group_size.  ``depth``: of the directory."""

    entries: DataFrame
    depth: int


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", _text().alias("text"), F.xxhash64(_text()).alias("key"))


def _cell() -> Column:
    return F.shiftrightunsigned("key", 64 - MAX_DEPTH)


def split_buckets(sizes: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """Buckets (first cell, last cell, depth) after all splits; ``sizes`` has the entries of each of 2 ** MAX_DEPTH cells."""
    sums = [0]
    for cell in range(1 << MAX_DEPTH):
        sums.append(sums[-1] + sizes.get(cell, 0))
    full, buckets = [(0, 1 << MAX_DEPTH, 0)], []
    while full:
        low, high, depth = full.pop()
        if sums[high] - sums[low] > capacity and depth < MAX_DEPTH:
            middle = (low + high) // 2
            full += [(middle, high, depth + 1), (low, middle, depth + 1)]
        else:
            buckets.append((low, high - 1, depth))
    return buckets


def build_index(docs: DataFrame, capacity: int = 1_000_000) -> Index:
    """Index of the distinct texts of ``docs`` (doc_id, text).

    A bucket that is overfull at the greatest depth stays so: it is still written in ranges of keys by several owners.
    """
    spark = docs.sparkSession
    # The aggregation compares whole texts; max and count take fixed width, so it hashes and combines before the shuffle.
    distinct = _keyed(docs).groupBy("key", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = stored(distinct.select(
        "key", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").alias("n_bytes"), "keep_id", "group_size"), "entries")

    sizes = {r.cell: r.n for r in entries.groupBy(_cell().alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = split_buckets(sizes, capacity)
    directory = spark.createDataFrame([(i, *bucket) for i, bucket in enumerate(buckets)],
                                      "bucket int, low long, high long, depth int")
    cells = directory.select("bucket", "depth", F.explode(F.sequence("low", "high")).alias("cell"))

    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256"))
    placed = entries.withColumn("cell", _cell()).join(F.broadcast(cells), "cell").drop("cell")  # 65,536 rows at most
    owned = placed.repartitionByRange("bucket", "key").withColumn("chain", chain).sortWithinPartitions("bucket", "key", "chain")
    return Index(stored(owned, "index"), max(depth for _, _, depth in buckets))


def lookup(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``; all texts must be in the index."""
    rows = docs.select("doc_id", F.xxhash64(_text()).alias("key"), F.sha2(_text(), 256).alias("text_sha256"))
    entries = index.entries.select("key", "text_sha256", "keep_id", "group_size")
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return rows.join(entries, ["key", "text_sha256"]).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, capacity: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``, copies included; of equal texts the largest id stays."""
    return lookup(docs, build_index(docs, capacity))


def drop_exact_duplicates(docs: DataFrame, capacity: int = 1_000_000) -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    kept = build_index(docs, capacity).entries.select(
        F.col("keep_id").alias("__keep"), F.col("key").alias("__key"), F.col("text_sha256").alias("__sha"))
    rows = docs.withColumns({"__key": F.xxhash64(_text()), "__sha": F.sha2(_text(), 256)})
    return rows.alias("r").join(
        kept.alias("k"), (F.col("r.__key") == F.col("k.__key")) & (F.col("r.__sha") == F.col("k.__sha"))
        & F.col("r.doc_id").eqNullSafe(F.col("k.__keep")), "left_semi").select(*[F.col(f"r.`{c}`") for c in docs.columns])
