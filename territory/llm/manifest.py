"""Merkle manifest of a dataset: a root for all rows and a proof for each.

Leaves are numbered within their group, and each level of a tree is one window
with fixed offsets: lag and lead columns, masked by a node's slot in its run and
by the length of the run, are its siblings, and the first child of a run hashes
the parent from itself and the siblings to its right. The tops of the groups
form one more tree, whose top is the root.

No window holds a group: nodes are numbered by range partitions and their
counts, and a window spans a block of ``BLOCK_LEVELS`` levels, whose bounds no run
crosses. Proofs come down the levels again by joins on (group, parent), in
which a key has ``fanout`` rows, so a source with a third of all rows is spread
like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from territory.llm.blocks import store

FANOUT = 3
#: A window spans fanout^BLOCK_LEVELS nodes.
BLOCK_LEVELS = 5

PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column | str) -> Column:
    """Lower-case hexadecimal SHA-256 of strings one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column | str) -> Column:
    """Digest of a row: each value as its length in bytes, ``:`` and its text; null as ``-``."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _numbered(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``_pos`` (place in ``_group`` from 0, ascending in ``order``, nulls first) and ``_n`` (size of the group)."""
    keys = ["_group", *order]
    spread = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = store(spread.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    counts = placed.groupBy("_group", part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    # A row per range partition and group in it.
    group = Window.partitionBy("_group")
    before = F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = counts.select("_group", "_part", (before - F.col("_rows") - F.col("_first")).alias("_shift"), F.sum("_rows").over(group).alias("_n"))
    return (
        placed.withColumn("_part", part)
        .join(offsets, ["_group", "_part"])
        .withColumn("_pos", F.col("_place") + F.col("_shift"))
        .drop("_part", "_shift", "_place")
    )


def _levels(nodes: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Stored levels of the trees of all groups, with ``_left`` and ``_right`` siblings, and the tops found at each level.

    ``nodes`` has ``_group``, ``_pos``, ``_n`` and ``_digest``; its other columns stay in the lowest level.
    """
    levels, tops = [], []
    most = 0
    while True:
        place = F.col("_pos")
        slot = place % fanout
        run = F.least(F.lit(fanout), F.col("_n") - place + slot)
        block = F.floor(place / fanout**BLOCK_LEVELS)
        along = Window.partitionBy("_group", block).orderBy("_pos")
        nothing = F.lit("")
        left = [F.when(slot >= d, F.lag("_digest", d).over(along)).otherwise(nothing) for d in range(fanout - 1, 0, -1)]
        right = [F.when(slot + d < run, F.lead("_digest", d).over(along)).otherwise(nothing) for d in range(1, fanout)]
        level = store(nodes.withColumns({"_left": F.concat(*left), "_right": F.concat(*right)}), name)
        if not levels:
            most = level.agg(F.max("_n")).first()[0] or 0
        levels.append(level)
        tops.append(level.filter("_n = 1").select("_group", "_digest"))
        if most <= 1:
            return levels, tops
        most = -(-most // fanout)
        nodes = level.filter((F.col("_n") > 1) & (slot == 0)).select(
            "_group",
            F.floor(place / fanout).alias("_pos"),
            F.ceil(F.col("_n") / fanout).alias("_n"),
            digest("_digest", "_right").alias("_digest"),
        )


def _descend(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The lowest level with ``_top`` and ``_path``: the siblings from the leaf up, then the path of its top.

    ``tops`` has ``_group``, ``_top`` and ``_path``, one row per group.
    """
    above = None
    for n in range(len(levels) - 1, -1, -1):
        level = levels[n]
        ended = level.filter("_n = 1").join(tops, "_group")
        if above is not None:
            parents = above.select("_group", F.col("_pos").alias("_parent"), "_top", "_path")
            siblings = F.array(F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))
            under = (
                level.filter("_n > 1")
                .withColumn("_parent", F.floor(F.col("_pos") / fanout))
                .join(parents, ["_group", "_parent"])
                .withColumn("_path", F.concat(siblings, "_path"))
                .drop("_parent")
            )
            ended = ended.unionByName(under)
        above = ended
    return above


def manifest(
    leaves: DataFrame, leaf: str, id_col: str = "doc_id", group_col: str = "source", fanout: int = FANOUT
) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path`` (these replace columns of these names).

    ``leaf`` is a column of digests (``leaf_digest``). Per group, leaves ascend
    by id; while a group has several nodes, every ``fanout`` consecutive ones, the
    last run fewer, become their digest. What is left is the subroot, for a
    lone leaf the leaf itself. Subroots ascend by the group's text, compared
    by UTF-8 bytes, and give the root likewise. ``path`` holds the digests to the
    left and right of the row's node, level by level from the leaf to the root.
    Give this function digests and ids, not texts: its rows are shuffled.

    A null group is one group, before all others; null ids come first in
    their group; rows that share group and id are ordered by their leaf, and
    equal leaves under one id have a place each. An empty table gives no rows.
    Other columns stay, whatever their names.
    """
    new = ["subroot", "root", "path"]
    docs = leaves.drop(*new)
    # A null group sorts before the empty text: every other one has a mark in front.
    group = F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        group.alias("_group"),
        F.col(id_col).alias("_id"),
        F.col(leaf).alias("_digest"),
    )
    nodes = _numbered(store(rows, "merkle-rows"), ["_id", "_digest"], "merkle-leaves").drop("_id")
    levels, found = _levels(nodes, fanout, "merkle-level")
    tops = found[0]
    for part in found[1:]:
        tops = tops.unionByName(part)
    tops = tops.select(F.lit("").alias("_group"), F.col("_group").alias("_source"), "_digest")
    upper, last = _levels(_numbered(tops, ["_source"], "merkle-tops"), fanout, "merkle-upper")
    top = last[-1].select("_digest").first()
    root = F.lit(top[0] if top else None).cast("string")
    whole = upper[0].limit(0).select("_group", F.lit("").alias("_top"), F.lit(None).cast(PATH).alias("_path"))
    if top:
        whole = tops.sparkSession.createDataFrame([("", top[0], [])], whole.schema)
    sources = _descend(upper, whole, fanout).select(
        F.col("_source").alias("_group"), F.col("_digest").alias("_top"), "_path"
    )
    out = _descend(levels, store(sources, "merkle-sources"), fanout)
    return out.select("_doc.*", F.col("_top").alias("subroot"), root.alias("root"), F.col("_path").alias("path"))


def fold(leaf: Column | str, path: Column | str) -> Column:
    """The root that a leaf gives with the siblings of a path: the true one if nothing was changed."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda node, level: digest(level["left"], node, level["right"]))


def proof_digest(path: Column | str) -> Column:
    """Digest of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)
