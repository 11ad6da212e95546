"""A Merkle manifest of a table: one tree per group of rows, one tree over the groups' roots.

A row's leaf is the SHA-256 of its fields. A group's leaves ascend by the order column; while a
tree has several nodes, every ARITY consecutive ones (the last run may be shorter, one node
included) become the SHA-256 of their hex digests. What remains is the group's subroot; the
subroots, ordered by group, become the root in the same way.

Trees are worked on in superblocks of ARITY ** LEVELS (4,096) consecutive nodes, which is what one call of a task's function holds. On the way up each
superblock becomes one node, so the next table is some thousands of times smaller. On the way
down the nodes of a superblock are cogrouped with the one row of nodes outside it that its
members' proofs need: the task repeats the local reduction, joins both parts of each proof and
folds the claimed leaf up to the root. No group of rows meets in one task, however large.

* A row's place in its group comes from ranges of (group, order, leaf) and the number of rows in
  the ranges before, so a group with most of the rows is cut like any other.
* A null field is ``-`` in the leaf, an empty one ``0:``. Null groups are a group of their own,
  before all others; a null order value comes before all others.
* Rows that repeat the order value are ordered by leaf. Rows that are equal throughout have a
  leaf and a proof each, for their own places.
* An empty table has no rows and no root. Columns not named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.storage import cut_lineage

ARITY = 16
LEVELS = 3


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Shape(NamedTuple):
    """How trees are cut into superblocks."""

    arity: int
    levels: int

    @property
    def block(self) -> int:
        return self.arity**self.levels

    def local(self, nodes: list[str], size: int) -> tuple[list[list[str]], str]:
        """The levels of a superblock below its topmost node, and that node; ``size`` is the number of nodes of the whole tree."""
        below = []
        while size > 1 and len(below) < self.levels:
            below.append(nodes)
            nodes = [digest("".join(nodes[i : i + self.arity])) for i in range(0, len(nodes), self.arity)]
            size = -(-size // self.arity)
        return below, nodes[0]

    def siblings(self, below: list[list[str]], index: int) -> list[str]:
        """For each level the nodes left and right of that which leads to node ``index``, within its run."""
        path = []
        for level in below:
            start = index - index % self.arity
            path.append("".join(level[start:index]) + ":" + "".join(level[index + 1 : start + self.arity]))
            index //= self.arity
        return path


def leaf(fields: Sequence[Column]) -> Column:
    """The SHA-256 of fields one behind the other, each ``-`` if null, else its UTF-8 length, a colon and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, claimed: Column | None = None, proofs: bool = False, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Each row's order value and group, its leaf, subroot and root, its proof's SHA-256, and where the claimed leaf leads.

    ``claimed`` is the leaf to check against the manifest (null or not given: the row's own);
    ``folded_root`` is the root that follows from it and the row's proof, ``verified`` whether
    that is the manifest's. With ``proofs`` the siblings themselves come too, one text for each
    level: those left of the node, a colon, those right of it.
    """
    if arity < 2 or levels < 1:
        raise ValueError("a superblock joins two nodes at least")
    shape = Shape(arity, levels)
    own = leaf([F.col(c) for c in fields])
    rows = docs.select(
        # a text that is never null and keeps the order, nulls first
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(order).alias("key"),
        F.col(group).alias("group"),
        own.alias("node"),
        (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
    )
    trees = [_placed(cut_lineage(rows, "merkle-leaves"), ["key", "node"])]
    trees += _reduced(trees[0], shape)
    subroots = trees[-1]
    tops = [_placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "node"), ["key"])]
    tops += _reduced(tops[0], shape)

    whole = tops[-1].select("tree", F.col("rank").alias("block"), F.col("node").alias("root"), F.array().cast("array<string>").alias("outer"))
    for nodes in reversed(tops[:-1]):
        whole = _paths(nodes, whole, shape)
    tree_of = tops[0].select(F.col("rank").alias("block"), F.col("key").alias("tree_name"))
    inner = whole.join(tree_of, "block").select(F.col("tree_name").alias("tree"), F.lit(0).cast("long").alias("block"), "root", "outer")
    inner = inner.join(subroots.select("tree", F.col("node").alias("subroot")), "tree")
    for nodes in reversed(trees[1:-1]):
        inner = _paths(nodes, inner, shape)
    return _folded(trees[0], inner, shape, docs.schema[order].dataType, docs.schema[group].dataType, order, group, proofs)


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with their ``rank`` in their tree and the tree's ``size``.

    Rows equal in all of ``order`` are spread by a seeded number, so no range holds them all.
    """
    ranges = nodes.withColumn("spread", F.rand(7)).repartitionByRange("tree", *order, "spread").sortWithinPartitions("tree", *order, "spread")
    placed = cut_lineage(ranges.drop("spread").withColumn("place", F.monotonically_increasing_id()), "merkle-places")
    part = F.shiftright("place", 33)
    pieces = placed.groupBy("tree", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    along = Window.partitionBy("tree").orderBy("part")
    offsets = pieces.select(
        "tree", "part", (F.sum("n").over(along) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("size")
    )
    ranked = placed.withColumn("part", part).join(offsets, ["tree", "part"])
    return ranked.withColumn("rank", F.col("place") + F.col("shift")).drop("part", "shift", "place")


def _reduced(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """The tables above ``nodes``, each with one row for each superblock of the one before, up to one row a tree."""
    schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("rank", T.LongType()), T.StructField("size", T.LongType()), T.StructField("node", T.StringType())])

    def reduce(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        size = int(block["size"].iloc[0])
        _, top = shape.local(block.sort_values("rank")["node"].tolist(), size)
        return pd.DataFrame({"tree": [key[0]], "rank": [key[1]], "size": [-(-size // shape.block)], "node": [top]})

    above = []
    while True:
        blocks = nodes.select("tree", "rank", "size", "node", F.floor(F.col("rank") / shape.block).alias("block")).groupBy("tree", "block")
        nodes = cut_lineage(blocks.applyInPandas(reduce, schema), "merkle-nodes")
        above.append(nodes)
        if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
            return above


def _cogrouped(nodes: DataFrame, outer: DataFrame, shape: Shape):
    inside = nodes.withColumn("block", F.floor(F.col("rank") / shape.block)).groupBy("tree", "block")
    return inside.cogroup(outer.groupBy("tree", "block"))


def _paths(nodes: DataFrame, outer: DataFrame, shape: Shape) -> DataFrame:
    """What the superblocks below need: for each node, now a ``block``, the siblings from it up to the root."""
    names = [c for c in outer.columns if c not in ("tree", "block", "outer")]
    schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), *(outer.schema[c] for c in names), outer.schema["outer"]])

    def join(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if block.empty or above.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        block = block.sort_values("rank")
        below, _ = shape.local(block["node"].tolist(), int(block["size"].iloc[0]))
        rest = list(above["outer"].iloc[0])
        paths = [shape.siblings(below, i) + rest for i in range(len(block))]
        return pd.DataFrame({"tree": key[0], "block": block["rank"].to_numpy(), **{c: above[c].iloc[0] for c in names}, "outer": paths})

    return cut_lineage(_cogrouped(nodes.select("tree", "rank", "size", "node"), outer, shape).applyInPandas(join, schema), "merkle-outer")


def _folded(leaves: DataFrame, outer: DataFrame, shape: Shape, order_type: T.DataType, group_type: T.DataType, order: str, group: str, proofs: bool) -> DataFrame:
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    # keys travel as texts: a column of numbers with nulls has no pandas type of its own
    schema = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("group", T.StringType()), *(T.StructField(c, T.StringType()) for c in texts),
        T.StructField("verified", T.BooleanType()), *([T.StructField("proof", T.ArrayType(T.StringType()))] if proofs else []),
    ])

    def fold(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if block.empty or above.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        block = block.sort_values("rank")
        nodes, (top,) = block["node"].tolist(), above.to_dict("records")
        below, _ = shape.local(nodes, int(block["size"].iloc[0]))
        rest, digests, folded, paths = list(top["outer"]), [], [], []
        for i, (own, told) in enumerate(zip(nodes, block["claimed"].tolist(), strict=True)):
            path = shape.siblings(below, i) + rest
            node = told if isinstance(told, str) else own
            for level in path:
                node = digest(level.replace(":", node))
            digests.append(digest("".join(path).replace(":", "")))
            folded.append(node)
            if proofs:
                paths.append(path)
        out = {"key": block["key"].to_numpy(), "group": block["group"].to_numpy(), "leaf": nodes, "subroot": top["subroot"], "root": top["root"], "proof_sha256": digests, "folded_root": folded}
        out["verified"] = [node == top["root"] for node in folded]
        return pd.DataFrame(out | ({"proof": paths} if proofs else {}))

    narrow = leaves.select("tree", "rank", "size", "node", "claimed", F.col("key").cast("string").alias("key"), F.col("group").cast("string").alias("group"))
    found = _cogrouped(narrow, outer, shape).applyInPandas(fold, schema)
    rest = [c for c in found.columns if c not in ("key", "group")]
    return found.select(F.col("key").cast(order_type).alias(order), F.col("group").cast(group_type).alias(group), *rest)
