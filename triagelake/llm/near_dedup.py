"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct word shingles.  Its sketch has ``BINS`` coordinates that are filled in rounds: in round i below
``BINS`` each shingle is thrown into a hashed bin with the value (i, hash); in the rounds after that each shingle is thrown into bin
i - ``BINS``, which guarantees that every coordinate is filled.  Each bin keeps its least value.  Rounds end when all bins are
filled, so a large set needs one round and a sketch costs O(set + BINS log BINS) however many coordinates there are.  Two sets
agree in a coordinate with a chance of their similarity, concentrated as if coordinates were independent.

Bands of ``ROWS`` coordinates are the buckets: at a similarity of 0.8 a pair shares none of the 42 with a chance of 3 in a million.
Documents with equal sets form a class, and only the smallest id of a class takes part further on.  Within a bucket every class
is verified against the bucket's smallest id, which is linear however large the bucket is; classes that are then connected need no
further look.  Buckets whose classes are still in different components are compared as a whole: their sets are laid out as a matrix,
whose product has the sizes of all intersections, and one link is reported for each two components.  No pair becomes a row.  A bucket
with more than ``TILE`` elements or ``TILE_SETS`` sets is cut into tiles, and tiles are compared two by two, their matrices filled in
blocks of rows, so every task stays bounded and no link that could join two components is lost.  Verification always takes the whole shingle sets.

Components come from alternating large-star and small-star steps over stored edges.  Hot buckets, classes and components are only
ever aggregated by min or joined on a key with one row on the other side, which Spark can split.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and stays.  Rows that repeat an
id count as one document: their sets must be those of the row with the largest text.  Rows without id are not compared; they stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from triagelake.llm.common import stored, with_columns
from triagelake.llm.words import BASES, U64, Spans, mix, pieces, signed, words_of

BINS, ROWS = 252, 6
#: Elements of the sets that one task compares at once.
TILE = 1_000_000
#: Sets of one tile, and cells of the matrices that are filled at a time: many small sets make large matrices.
TILE_SETS, CELLS = 4_000, 4_000_000
_LOW = U64((1 << 48) - 1)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text, A-Z lower-cased; fewer words than ``size`` make one shingle."""
    sets = []
    for _, some in pieces(texts):
        words = words_of([t.lower() for t in some])  # bytes.lower() changes A-Z only
        for d in range(len(some)):
            own = words.hashes[words.slice(d)]
            if not len(own):
                sets.append(own)
                continue
            width = min(size, len(own))
            start = np.arange(len(own) - width + 1)
            sets.append(np.unique(Spans(own, BASES[1]).of(start, start + width) + U64(width != size)))
    return sets


def sketch(elements: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One 64-bit value per bin: round in the upper bits, hash below.  Not for empty sets."""
    best = np.full(bins, np.iinfo(np.uint64).max, dtype=U64)
    # Several rounds at once for small sets: values of later rounds are larger, so they never change a bin that is filled before.
    step, at = max(1, 2 * bins // len(elements)), 0
    while at < 2 * bins and best.max() == np.iinfo(np.uint64).max:
        rounds = np.arange(at, min(at + step, 2 * bins), dtype=U64)
        thrown = mix(elements[None, :] + mix(rounds + U64(1))[:, None])
        place = ((thrown >> U64(48)) * U64(bins)) >> U64(16)
        late = rounds >= bins
        place[late] = (rounds[late] - U64(bins))[:, None]
        value = (rounds[:, None] << U64(48)) | (mix(thrown) & _LOW)
        np.minimum.at(best, place.astype(np.int64).ravel(), value.ravel())
        at += step
    return best


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band."""
    grid = values.reshape(-1, rows)
    out = mix(np.arange(1, len(grid) + 1, dtype=U64))
    for column in grid.T:
        out = mix(out ^ column) + out
    return out


def _scorer(size: int) -> Callable[[], Callable[[list], list[pa.Array]]]:
    def build() -> Callable[[list], list[pa.Array]]:
        def score(texts: list[bytes]) -> list[pa.Array]:
            counts, keys, buckets = [], [], []
            known: dict[bytes, np.ndarray] = {}
            for own in shingle_sets(texts, size):
                counts.append(len(own))
                if not len(own):
                    keys.append((None, None))
                    buckets.append(None)
                    continue
                end = np.array([len(own)])
                key = tuple(int(signed(Spans(own, base).of(np.array([0]), end))[0]) for base in BASES[1:])
                keys.append(key)
                if key not in known:
                    known[key] = signed(bands(sketch(own)))
                buckets.append(known[key])
            return [pa.array(counts, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                    pa.array(buckets, pa.list_(pa.int64()))]

        return score

    return build


FIELDS = [StructField("n_shingles", LongType()), StructField("set_1", LongType()), StructField("set_2", LongType()),
          StructField("bands", ArrayType(LongType()))]


def _links(sets: list[np.ndarray], ids: np.ndarray, owners: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """One similar pair of ids for each two owners (components) that have one."""
    names, counts = np.unique(owners, return_counts=True)
    rest = np.flatnonzero(owners != names[counts.argmax()])  # the largest component is compared with the others only
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), size)
    values, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(held > 1)
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    height = max(1, CELLS // len(sets))
    for low in range(0, len(rest), height):
        some = rest[low: low + height]
        both = np.zeros((len(some), len(sets)), dtype=np.float32)
        width = max(1, 2 * CELLS // len(sets))
        for at in range(0, len(shared), width):
            inside = (column >= at) & (column < at + width)
            grid = np.zeros((len(sets), min(width, len(shared) - at)), dtype=np.float32)
            grid[row[inside], column[inside] - at] = 1
            both += grid[some] @ grid.T
        close = 100 * both >= percent * (size[some][:, None] + size[None, :] - both)
        i, j = np.nonzero(close & (owners[some][:, None] != owners[None, :]))
        found.update({tuple(sorted((owners[some[x]], owners[y]))): (ids[some[x]], ids[y]) for x, y in zip(i, j)})
    return [(int(max(pair)), int(min(pair))) for pair in found.values()]


def _open_links(inside: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between different components in the buckets ``inside`` (bucket, member, n_shingles, component)."""
    needed = F.greatest(F.floor(F.sum("n_shingles") / TILE), F.floor(F.count(F.lit(1)) / TILE_SETS))
    tiles = inside.groupBy("bucket").agg((1 + needed).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("member"), F.col("tiles")).cast("int")
    turned = inside.join(tiles, "bucket").withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    turned = turned.select("bucket", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "member", "n_shingles",
                           "component")
    total = turned.agg(F.sum("n_shingles"), F.count(F.lit(1))).first()
    groups = 1 + max((total[0] or 0) // (2 * TILE), total[1] // (2 * TILE_SETS))
    turned = turned.withColumn("group", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(groups)))

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([signed(s) for s in own], pa.list_(pa.int64()))],
                                             names=["member", "elements"])

    wanted = inside.select(F.col("member").alias("doc_id")).distinct()
    sets = texts.join(wanted, "doc_id").select("doc_id", "text").mapInArrow(elements, "member long, elements array<long>")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for _, own in rows.groupby(["bucket", "low", "high"], sort=False):
            found += _links(own["elements"].tolist(), own["member"].to_numpy(), own["component"].to_numpy(), percent)
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")

    joined = turned.join(sets, "member").select("group", "bucket", "low", "high", "member", "component", "elements")
    return joined.groupBy("group").applyInPandas(compare, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
            keep = []
            for at in range(0, len(a), 500):
                distinct = list({*a[at: at + 500], *b[at: at + 500]})
                own = dict(zip(distinct, shingle_sets(distinct, size)))
                for x, y in zip(a[at: at + 500], b[at: at + 500]):
                    s, t = own[x], own[y]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * both >= percent * (len(s) + len(t) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for all nodes of the edges (a, b) but the smallest of each component."""
    mark = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "parent").cast("decimal(38,0)")).alias("s")]
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent")).distinct(), "edges")
    seen = now.agg(*mark).first()
    while True:
        both = now.unionByName(now.select(F.col("parent").alias("node"), F.col("node").alias("parent")))
        least = both.groupBy("node").agg(F.min("parent").alias("least"))
        # Large star: all larger neighbours go to the least one; small star: all smaller ones, and the node itself.
        large = both.join(least, "node").where("parent > node").select(
            F.col("parent").alias("node"), F.least("node", "least").alias("parent")).distinct()
        small = large.join(large.groupBy("node").agg(F.min("parent").alias("least")), "node")
        after = small.select("node", F.col("least").alias("parent")).unionByName(
            small.where("parent > least").select(F.col("parent").alias("node"), F.col("least").alias("parent"))).distinct()
        after = stored(after, "edges")
        before, seen, now = seen, after.agg(*mark).first(), after
        if seen == before:
            return now.select("node", F.col("parent").alias("component"))


def _joined(members: DataFrame, edges: DataFrame) -> DataFrame:
    """member, component of every class representative."""
    found = components(edges).withColumnRenamed("node", "member")
    return members.join(found, "member", "left").select("member", F.coalesce("component", "member").alias("component"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", "text")
    sketched = stored(with_columns(rows, FIELDS, _scorer(size)).drop("text"), "sketches")
    full = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("set_1", "set_2").agg(F.min("doc_id").alias("member"))
    classes = stored(classes, "classes")
    firsts = full.join(classes.select(F.col("set_1").alias("s1"), F.col("set_2").alias("s2"), "member"),
                       (F.col("doc_id") == F.col("member")) & (F.col("set_1") == F.col("s1")) & (F.col("set_2") == F.col("s2")))
    placed = firsts.select("member", "n_shingles", F.explode("bands").alias("bucket"))
    crowded = placed.groupBy("bucket").agg(F.min("member").alias("leader"), F.max("member").alias("last")).where("leader < last")
    shared = stored(placed.join(crowded, "bucket").select("bucket", "member", "n_shingles", "leader"), "buckets")

    wanted = shared.select(F.col("member").alias("doc_id")).distinct()
    texts = stored(rows.join(wanted, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text")), "texts")
    members = classes.select("member").distinct()

    pairs = shared.where("member > leader").select(F.col("member").alias("a"), F.col("leader").alias("b")).distinct()
    edges = stored(_verified(pairs, texts, size, percent), "links")
    joined = stored(_joined(members, edges), "joined")
    owned = shared.join(joined, "member").select("bucket", "member", "n_shingles", "component")
    open_ = owned.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    inside = stored(owned.join(open_, "bucket"), "open")
    more = stored(_open_links(inside, texts, size, percent), "links")
    if not more.isEmpty():
        # Components are merged as wholes: the graph that is left has one node for each of them.
        of = joined.select(F.col("member").alias("node"), "component")
        ends = more.join(of.select(F.col("node").alias("a"), F.col("component").alias("x")), "a").join(
            of.select(F.col("node").alias("b"), F.col("component").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        merged = components(ends).select(F.col("node").alias("component"), F.col("component").alias("merged"))
        joined = joined.join(merged, "component", "left").select("member", F.coalesce("merged", "component").alias("component"))

    found = classes.join(joined, "member")
    labelled = sketched.join(found.select("set_1", "set_2", "component"), ["set_1", "set_2"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns of ``docs``."""
    losing = near_duplicates(docs, size, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__lost")).distinct()
    return docs.join(losing, F.col("doc_id") == F.col("__lost"), "left_anti")
