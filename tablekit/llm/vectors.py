"""Embedding near-duplicates: links of cosine ``least`` or more, by a subspace pigeonhole join.

Unit vectors are turned by a fixed random rotation and split into blocks of ``BLOCK``
dimensions. Two vectors link if their squared distance is at most 2 - 2 * least; then in
some block theirs is at most that block's proportional share. So every block is a range
join of its own: vectors lie in cells along the block's first coordinate, as wide as the
block's radius, and meet those of their own and the next cell. Pairs within the block's
radius are verified on the original vectors in double precision.

A cell is dealt out in tiles, so that no task holds a hot cell. A pair counts in the first
block whose share it keeps. Pairs are dropped once they are counted and their rows joined,
so a task's memory is bound by its tiles and a strip, however many pairs link. A task returns a row per linked vector - how many it is linked
with there, and the smallest vector it reaches there - so links are counted, not listed.
Equal vectors are one class with a multiplicity.

* Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, nor do rows
  without id. Vectors of different lengths never link.
* Rows that repeat an id and its vector are one vector. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablekit.llm.components import components
from tablekit.storage import cut_lineage

BLOCK = 16
#: Rows of a tile. A task compares two tiles at most, in strips.
TILE = 20_000
STRIP = 512
#: Pairs of a strip that are verified, counted and joined at once, and then dropped.
CUT = 1 << 16
SEED = 4_711
#: What the two ways of computing a block's distance may differ by.
SLACK, LOOSE = 1e-6, 1e-4


def rotation(d: int) -> np.ndarray:
    """A random rotation of ``d`` dimensions, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def blocks(d: int, least: float) -> list[tuple[slice, float]]:
    """The dimensions of each block and its share of the squared distance."""
    count = max(1, -(-d // BLOCK))
    edges = np.linspace(0, d, count + 1).round().astype(int).tolist()
    return [(slice(a, b), (2 - 2 * least) * (b - a) / d) for a, b in zip(edges, edges[1:], strict=False)]


def rotated(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(x.shape[1])


def prepare(rows: DataFrame, least: float, vec_id: str, embedding: str) -> DataFrame:
    """``id, print, d, cells, vector``; ``print`` is null for what links with nothing."""
    schema = T.StructType(
        [
            T.StructField("id", rows.schema[vec_id].dataType),
            T.StructField("print", T.BinaryType()),
            T.StructField("d", T.IntegerType()),
            T.StructField("cells", T.ArrayType(T.IntegerType())),
            T.StructField("vector", T.ArrayType(T.DoubleType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null numbers become NaN
            sizes = np.array([len(v) if v.is_valid else 0 for v in vectors], np.int64)
            start = np.cumsum(sizes) - sizes
            prints, cells, kept = [None] * len(ids), [None] * len(ids), [None] * len(ids)
            for d in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == d)
                x = values[start[at][:, None] + np.arange(d)]
                norm = np.linalg.norm(x, axis=1)
                good = np.isfinite(norm) & (norm > 0)
                at, x = at[good], x[good]
                if not len(at):
                    continue
                turned = rotated(x)
                cell = np.stack([np.floor(turned[:, b.start] / np.sqrt(share + LOOSE)) for b, share in blocks(d, least)], axis=1).astype(np.int32)
                for i, row, c in zip(at.tolist(), x, cell, strict=True):
                    prints[i], cells[i], kept[i] = hashlib.blake2b((row + 0.0).tobytes(), digest_size=16).digest(), c, row
            columns = [ids, prints, sizes, cells, kept]
            yield pa.RecordBatch.from_arrays([c if c is ids else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>")).mapInArrow(run, schema)


def _meetings(classes: DataFrame) -> DataFrame:
    """Each class once per block, cell it meets others in, and pair of tiles."""
    placed = classes.select("id", "n", "d", "vector", F.posexplode("cells").alias("block", "own"))
    placed = placed.withColumn("cell", F.explode(F.array(F.col("own"), F.col("own") - 1))).withColumn("upper", F.col("cell") != F.col("own"))
    # cells are few: a block's coordinates lie between -1 and 1
    counted = placed.groupBy("d", "block", "cell").agg(F.count("*").alias("held"))
    placed = placed.join(counted, ["d", "block", "cell"])
    placed = placed.withColumn("tiles", F.ceil(F.col("held") / F.lit(TILE)).cast("int")).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select("d", "block", "cell", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "tile", "upper", "id", "n", "vector")
    keys = ["d", "block", "cell", "one", "two"]
    return placed.repartition(*keys).sortWithinPartitions(*keys)


def links(classes: DataFrame, least: float) -> DataFrame:
    """``id, n_links, reached``: per task, how many vectors a class links with and the smallest it reaches."""
    kind = classes.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_links", T.LongType()), T.StructField("reached", kind)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for key, part in _groups(batches):
            rows = _linked(key, part, least)
            if rows is not None:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow, strict=True)], schema=arrow)

    return _meetings(classes).mapInArrow(run, schema)


def _groups(batches):
    """(d, block, one, two) and the rows of one pair of tiles after the other."""
    held, current = [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(5)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b <= a:
                continue
            key = tuple(keys[a].tolist())
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def _linked(key: tuple, part: pa.Table, least: float):
    d, block, _, one, two = key
    if len(part) < 2:
        return None
    tile, upper = part["tile"].to_numpy(), part["upper"].to_numpy(zero_copy_only=False)
    ids, weight = part["id"].to_pylist(), part["n"].to_numpy()
    vectors = part["vector"].combine_chunks()
    x = vectors.flatten().to_numpy().reshape(-1, d)
    norm = np.linalg.norm(x, axis=1)
    turned = rotated(x)
    shares = blocks(d, least)
    span, share = shares[block]
    u = turned[:, span].astype(np.float32)
    # one product per strip tells all: <u, v> - |u|^2 / 2 - |v|^2 / 2 is minus half the squared distance
    half, one_each = ((u * u).sum(axis=1) / 2)[:, None], np.ones((len(u), 1), np.float32)
    of_left, of_right = np.hstack([u, half, one_each]), np.hstack([u, -one_each, -half])
    enough = np.float32(-(share + LOOSE) / 2)
    left = np.flatnonzero(tile == one)
    right = left if one == two else np.flatnonzero(tile == two)
    count = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    turned_right = np.ascontiguousarray(of_right[right].T)
    for start in range(0, len(left), STRIP):
        rows = left[start : start + STRIP]
        skip = start if one == two else 0  # within a tile each pair is looked at once
        close = np.flatnonzero((of_left[rows] @ turned_right[:, skip:]).ravel() >= enough)
        for cut in range(0, len(close), CUT):
            i, j = np.divmod(close[cut : cut + CUT], len(right) - skip)
            p, q = rows[i], right[skip + j]
            keep = ~(upper[p] & upper[q])
            if one == two:
                keep &= p < q
            p, q = p[keep], q[keep]
            fits = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= least
            p, q = p[fits], q[fits]
            apart = (turned[p] - turned[q]) ** 2
            fits = apart[:, span].sum(axis=1) <= share + SLACK
            for before, its_share in shares[:block]:
                fits &= apart[:, before].sum(axis=1) > its_share + SLACK
            p, q = p[fits], q[fits]
            np.add.at(count, p, weight[q])
            np.add.at(count, q, weight[p])
            root = _merged(root, p, q)
    linked = np.flatnonzero(count)
    if not len(linked):
        return None
    root = root.tolist()
    smallest: dict[int, object] = {}
    for i in linked.tolist():
        r = root[i]
        if r not in smallest or ids[i] < smallest[r]:
            smallest[r] = ids[i]
    return [ids[i] for i in linked.tolist()], count[linked], [smallest[root[i]] for i in linked.tolist()]


def _merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root of every row after joining rows ``a`` with rows ``b``; ``root`` names roots only."""
    one, two = root[a], root[b]
    apart = one != two
    if not apart.any():
        return root
    n = len(root)
    one, two = np.divmod(np.unique(np.minimum(one, two)[apart] * n + np.maximum(one, two)[apart]), n)
    above = list(range(n))

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for i, j in zip(one.tolist(), two.tolist(), strict=True):
        i, j = find(i), find(j)
        if i != j:
            above[j] = i
    return np.array([find(i) for i in range(n)])[root]


def near_duplicates(rows: DataFrame, least: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept`` (it is its component's)."""
    every = cut_lineage(prepare(rows, least, vec_id, embedding), "vectors")
    able = every.where("print is not null and id is not null")
    grouped = able.groupBy("print").agg(F.min("id").alias("first"), F.count_distinct("id").alias("n"))
    chosen = able.join(grouped.select(F.col("first").alias("id"), "print", "n"), ["id", "print"])
    classes = cut_lineage(chosen.select("id", "n", "d", "cells", "vector").dropDuplicates(["id", "d", "vector"]), "classes")
    found = cut_lineage(links(classes, least), "found")
    counts = found.groupBy("id").agg(F.sum("n_links").alias("others"))
    label = components(found, "id", "reached")
    reached = (
        grouped.select("print", "n", F.col("first").alias("id"))
        .join(counts, "id", "left")
        .join(label.withColumnRenamed("node", "id"), "id", "left")
        .select("print", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    out = able.select("id", "print").join(reached, "print").select("id", "n_links", "component_id")
    out = out.union(every.where("print is null or id is null").select("id", F.lit(0).cast("long"), F.col("id")))
    return out.select(F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
