"""Merkle manifest of a document table by butterfly exchange: every document gets its proof up to the root without a downward pass.

Leaves.  A row's leaf is H(f(doc_id) f(source) f(lang) f(n_chars) f(text)), H the lowercase hex SHA-256 of the concatenated
inputs, f(v) = "-" for null, else the UTF-8 byte count of v as text, ":", and v (integers in decimal).  Computed by Spark SQL.

Trees.  Per source, leaves ascend by doc_id (nulls first; repeated ids by leaf); while more than one node remains, every run of
``FANOUT`` consecutive nodes (the last run may be shorter, even one) becomes the H of their digests.  What remains (a lone leaf
itself) is the source's subroot; subroots, ordered by source (null first, then UTF-8 bytes), give the root in the same way.

Positions.  Rows are range-partitioned by (source, doc_id, leaf) and sorted; a row's position within its source is its place in
its task plus the rows of its source in all earlier tasks.  No task ever holds a whole source.

Blocks and rounds.  Positions are cut into aligned blocks of FANOUT ** DEPTH leaves; each block's subtree is hashed in one task
(``applyInPandas`` per block), which also gives each leaf its siblings inside the block.  Above the blocks, rounds run over one row
per block: in round r, the blocks of an aligned group of FANOUT ** (r + 1) blocks fall into FANOUT subgroups of FANOUT ** r, all of
whose members know their subgroup's root; each block meets the blocks at the same offset in the other subgroups (a subgroup that
is short is met at the offset modulo its size), so that every block learns its siblings and hashes the parent itself.  After the
last round every block holds its root and all upper siblings, and nothing has to be sent back down.  A group (by block position)
never holds more than FANOUT rows.  The tree over subroots is built the same way, with one item per source.

Proofs.  proof_sha256 is H of the sibling digests of all levels from the leaf via the subroot to the root, level by level, left to
right (H of nothing if there are none).  Tampering: where crc32 of the decimal doc_id is even, the text loses its \\n characters
(null texts stay null; a null doc_id is not tampered).  folded_root folds the tampered leaf with the original siblings level by level;
verified says whether it equals the root.

Defined results: one row per input row, repeated rows included (each is a leaf).  Null values take part as "-".  An empty table
gives an empty result.  Very long texts are hashed whole by Spark.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.llm.common import stored

FANOUT = 3
DEPTH = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(row[name]) for name in FIELDS]), 256)


def tampered(text: Column, doc_id: Column) -> Column:
    """The text with its line feeds deleted where crc32 of the decimal doc_id is even."""
    even = (F.crc32(doc_id.cast("string").cast("binary")) % 2) == 0
    return F.when(even & text.isNotNull(), F.regexp_replace(text, "\n", "")).otherwise(text)


def _h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def positions(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """rows with pos (0-based place within ``group`` by ``order``) and n (rows of the group), without any task holding a group."""
    parts = max(1, rows.rdd.getNumPartitions())
    ordered = stored(rows.repartitionByRange(parts, F.col(group).asc_nulls_first(), *order)
                     .sortWithinPartitions(F.col(group).asc_nulls_first(), *order)
                     .select("*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_at")), f"{group}-ordered")
    runs = ordered.groupBy("_task", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_task")
    runs = runs.select("_task", F.col(group).alias("_g"), "_first",
                       (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"), F.sum("_rows").over(Window.partitionBy(group)).alias("n"))
    joined = ordered.join(runs, (ordered["_task"] == runs["_task"]) & ordered[group].eqNullSafe(runs["_g"]))
    return joined.select(*[ordered[c] for c in rows.columns], (ordered["_at"] - runs["_first"] + runs["_before"]).alias("pos"), runs["n"])


def _blocks(items: DataFrame, group: str, fold: bool) -> DataFrame:
    """Subtrees of aligned blocks: per item its siblings inside the block (text; folded h2 if ``fold``, else the levels); per block
    its root and n.  ``items`` has group, pos, n, h, doc_id and, if ``fold``, h2."""
    size = FANOUT ** DEPTH
    schema = (f"{group} string, block long, pos long, n long, kind string, doc_id long, leaf string, root string, siblings string, "
              "folded string, levels array<struct<left:string,right:string>>")

    def subtree(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", kind="stable")
        nodes = rows["h"].tolist()
        folded = rows["h2"].tolist() if fold else [None] * len(nodes)
        n = int(rows["n"].iloc[0])
        whole = n <= size  # the group is this one block: hash only while more than one node remains
        places = list(range(len(nodes)))
        text: list[list[str]] = [[] for _ in nodes]
        levels: list[list[dict]] = [[] for _ in nodes]
        depth = 0
        while (len(nodes) > 1) if whole else (depth < DEPTH):
            for k, i in enumerate(places):
                start = i - i % FANOUT
                left, right = "".join(nodes[start:i]), "".join(nodes[i + 1:start + FANOUT])
                text[k].append(left + right)
                if fold:
                    folded[k] = _h([left, folded[k], right])
                else:
                    levels[k].append({"left": left, "right": right})
            nodes = [_h(nodes[j:j + FANOUT]) for j in range(0, len(nodes), FANOUT)]
            places = [i // FANOUT for i in places]
            depth += 1
        block, key = int(rows["block"].iloc[0]), rows[group].iloc[0]
        out = pd.DataFrame({group: key, "block": block, "pos": rows["pos"].to_numpy(), "n": n, "kind": "item",
                            "doc_id": rows["doc_id"].to_numpy(), "leaf": rows["h"].to_numpy(), "root": None,
                            "siblings": ["".join(t) for t in text], "folded": folded, "levels": [None if fold else v for v in levels]})
        top = pd.DataFrame({group: [key], "block": [block], "pos": [None], "n": [n], "kind": ["block"], "doc_id": [None], "leaf": [None],
                            "root": [nodes[0]], "siblings": [None], "folded": [None], "levels": [None]})
        return pd.concat([out, top], ignore_index=True)

    columns = [group, "pos", "n", "h", "doc_id", *(["h2"] if fold else [])]
    blocks = items.select(*columns, (F.col("pos") / F.lit(size)).cast("long").alias("block"))
    return stored(blocks.groupBy(group, "block").applyInPandas(subtree, schema), f"{group}-blocks")


def _rounds(tops: DataFrame, group: str) -> DataFrame:
    """Butterfly rounds over one row per block: group, block, block_root, upper (text of all upper siblings), upper_levels."""
    size = FANOUT ** DEPTH
    state = stored(tops.select(group, "block", ((F.col("n") + size - 1) / size).cast("long").alias("blocks"), F.col("root").alias("h"),
                               F.lit("").alias("upper"),
                               F.array().cast("array<struct<left:string,right:string>>").alias("upper_levels")), f"{group}-round")
    most = state.agg(F.max("blocks")).first()[0] or 0
    span = 1
    while span < most:
        active = F.col("blocks") > span
        step = span * FANOUT
        ahead = state.where(active).withColumns({
            "g": (F.col("block") / step).cast("long"), "j": (F.col("block") / span).cast("long") % FANOUT, "o": F.col("block") % span})
        size_j = F.least(F.lit(span), F.col("blocks") - F.col("g") * step - F.col("j") * span)
        size_0 = F.least(F.lit(span), F.col("blocks") - F.col("g") * step)
        # Each block is met at its own offset and, in a short subgroup, at every offset that falls onto it.
        sent = ahead.select(F.col(group).alias("_group"), F.col("g").alias("_g"), "j", "h",
                            F.explode(F.sequence("o", size_0 - 1, size_j)).alias("_o"))
        met = sent.groupBy("_group", "_g", "_o").agg(F.array_sort(F.collect_list(F.struct("j", "h"))).alias("run"))
        joined = ahead.join(met, F.col(group).eqNullSafe(F.col("_group")) & (F.col("g") == F.col("_g")) & (F.col("o") == F.col("_o")))
        left = F.array_join(F.transform(F.filter("run", lambda x: x["j"] < F.col("j")), lambda x: x["h"]), "")
        right = F.array_join(F.transform(F.filter("run", lambda x: x["j"] > F.col("j")), lambda x: x["h"]), "")
        moved = joined.select(
            group, "block", "blocks", F.sha2(F.array_join(F.transform("run", lambda x: x["h"]), ""), 256).alias("h"),
            F.concat("upper", left, right).alias("upper"),
            F.concat("upper_levels", F.array(F.struct(left.alias("left"), right.alias("right")))).alias("upper_levels"))
        state = stored(moved.unionByName(state.where(~active)), f"{group}-round")
        span = step
    return state.select(F.col(group).alias("_group"), F.col("block").alias("_block"), F.col("h").alias("block_root"), "upper",
                        "upper_levels")


def tree(items: DataFrame, group: str, fold: bool) -> DataFrame:
    """Per item: group, pos, doc_id, leaf, root of its group, siblings (text of all levels), and folded or levels."""
    made = _blocks(items, group, fold)
    tops = _rounds(made.where(F.col("kind") == "block").select(group, "block", "n", "root"), group)
    found = made.where(F.col("kind") == "item").join(
        tops, F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block")))
    return found.select(group, "pos", "doc_id", "leaf", F.col("block_root").alias("root"),
                        F.concat("siblings", "upper").alias("siblings"),
                        (fold_up(F.col("folded"), F.col("upper_levels")) if fold else F.lit(None).cast("string")).alias("folded"),
                        (F.lit(None) if fold else F.concat("levels", "upper_levels")).alias("levels"))


def fold_up(start: Column, levels: Column) -> Column:
    return F.aggregate(levels, start, lambda h, level: F.sha2(F.concat(level["left"], h, level["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified: one row per document."""
    row = {name: F.col(name) for name in FIELDS}
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(row).alias("h"),
        leaf(row | {"text": tampered(F.col("text"), F.col("doc_id"))}).alias("h2"))
    placed = positions(leaves, "source", [F.col("doc_id").asc_nulls_first(), F.col("h")])
    per_leaf = stored(tree(placed, "source", fold=True), "manifest-leaves")
    # The tree over subroots: one item per source, ordered by source.
    subroots = per_leaf.where(F.col("pos") == 0).select(F.lit("").alias("all"), "source", F.col("root").alias("h"),
                                                         F.lit(None).cast("long").alias("doc_id"))
    ordered = positions(subroots, "all", [F.col("source").asc_nulls_first()])
    top = tree(ordered, "all", fold=False).join(ordered.select("pos", F.col("source").alias("_source")), "pos").select(
        "_source", F.col("root").alias("top_root"), F.col("siblings").alias("top_siblings"), F.col("levels").alias("top_levels"))
    # One row per source on the right: broadcast or split by adaptive execution where a source is hot.
    return per_leaf.join(top, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "leaf", F.col("root").alias("subroot"), F.col("top_root").alias("root"),
        F.sha2(F.concat("siblings", "top_siblings"), 256).alias("proof_sha256"),
        fold_up(F.col("folded"), F.col("top_levels")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
