"""N-gram Jaccard join: links between documents whose word shingle sets are alike, by grouped prefixes.

A document's set is its distinct shingles of ``n`` words. Two sets of sizes x <= y with a
Jaccard similarity of at least t share one of their first x - ceil(t x) + 1 and
y - ceil(t y) + 1 shingles under any common order. The order here puts rare shingles
first: those whose hash lies in a fixed low share of the hash space come first, by the
number of documents that hold them, all others after them by hash. Only for the low share
is that number counted.

1. Equal sets collapse into one class, represented by its smallest document.
2. Classes that share a prefix shingle meet in that shingle's list. Lists with the same
   members are kept once. A list is cut into tiles, so no task holds a hot list whole.
   Within a tile, classes of identical prefix and size form one group; group pairs pass if
   sizes agree and if the prefixes share as many shingles as the threshold demands.
3. Members of the pairs that passed are verified on their whole sets. A large list first
   yields each member's best partner. What these link is one component. Then its members are
   compared across components within the task, which hands on only the pairs that tie
   components together, so a large group of near copies does not become all its pairs.

Every pair that can reach the threshold is verified or already connected, so components
are exact. Shingles are 63-bit hashes. Prefixes are compared by 32 bits of them, sketches of
sets by 31; shingles of one document that fall together there count as shared, so that chance
can only add candidates.

* Null and wordless texts have no shingles and link with nothing; a text of fewer than
  ``n`` words is one shingle.
* Rows without id are returned without component. Rows that share an id are one document
  with the links of them all. Repeated rows give a row each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablekit.llm.components import components
from tablekit.llm.packed import hash_spans, layout, mix, true_runs
from tablekit.llm.rows import field, map_rows, text_bytes
from tablekit.storage import cut_lineage

#: Rows of one list that meet in one task at most, twice (a tile with another).
TILE = 1536
#: A list of at most so many members yields all pairs at once.
SMALL = 8
#: Values of a sketched shingle.
SKETCH = 2**31 - 1
#: The counted share of the hash space, in prefix lengths.
COUNTED = 1.5
#: Rows of a tile's matrices, and columns of shared shingles, worked on at a time.
_BLOCK, _COLUMNS = 256, 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_PRIME = np.uint64(0xC2B2AE3D27D4EB4F)


def needed(size: int, num: int, den: int) -> int:
    """The least overlap with any partner of a set of that size."""
    return -(-num * size // den)


def shingles(data: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct 63-bit shingle hashes of each text."""
    data = _LOWER[data]
    start, end = true_runs(_IN_WORD[data], bounds)
    words = hash_spans(data, start, end - start)
    at = np.searchsorted(start, bounds)
    runs = np.full(max(0, len(words) - n + 1), n, np.uint64)
    for k in range(n):
        runs = mix((runs ^ words[k : k + len(runs)]) * _PRIME)
    runs >>= np.uint64(1)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1]).astype(np.int64)
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                one = mix((one ^ words[k : k + 1]) * _PRIME)
            yield (one >> np.uint64(1)).astype(np.int64)
        else:
            yield np.empty(0, np.int64)


def profiles(docs: DataFrame, n: int, num: int, den: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``size``, ``print`` (of the whole set), ``near`` and ``far`` prefix candidates (32-bit).

    ``near`` are the shingles of the counted share; ``far`` are those that fill up the prefix
    where the counted share holds too few.
    """
    cut = int(min(1.0, COUNTED * (1 - num / den)) * 2**63)
    keys = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [field(docs, doc_id, "id"), T.StructField("size", T.LongType()), T.StructField("print", T.BinaryType()), T.StructField("near", keys), T.StructField("far", keys)]
    )

    def convert(batch: pa.RecordBatch):
        size, prints, near, far = [], [], [], []
        for u in shingles(*layout(batch.column(1)), n):
            counted = int(np.searchsorted(u, cut))
            prefix = len(u) - needed(len(u), num, den) + 1
            low = u.astype(np.uint32).view(np.int32)
            size.append(len(u))
            prints.append(hashlib.blake2b(u.tobytes(), digest_size=16).digest())
            near.append(low[:counted])
            far.append(low[counted : max(counted, prefix)])
        return [batch.column(0), size, prints, near, far]

    return map_rows(docs.select(F.col(doc_id).alias("id"), text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text")


def whole_sets(docs: DataFrame, ids: DataFrame, n: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and the whole ``shingles`` of the documents in ``ids``."""
    schema = T.StructType([field(docs, doc_id, "id"), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def convert(batch: pa.RecordBatch):
        return [batch.column(0), list(shingles(*layout(batch.column(1)), n))]

    chosen = docs.select(F.col(doc_id).alias("id"), text_bytes(text).alias("__llm_text")).join(ids.hint("shuffle_hash"), "id")
    return map_rows(chosen, schema, convert, "__llm_text")


def prefixes(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Classes that share a prefix shingle with another: ``id, size, prefix, keys``.

    ``keys`` are the shingles of the prefix that more than one class holds there, as 32 bits;
    ``lost`` is how many fell together with another.
    """
    least = F.ceil(F.col("size") * F.lit(num) / F.lit(den))
    rows = classes.withColumn("prefix", F.col("size") - least + 1).withColumn("n_near", F.size("near").cast("long"))
    named = rows.select("id", F.posexplode(F.concat("near", "far")).alias("at", "key"))
    counts = named.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    held = named.join(counts, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "key", "at"))).alias("held"))
    joined = rows.select("id", "size", "prefix", "n_near").join(held, "id")
    near = F.filter("held", lambda x: x["at"] < F.col("n_near"))
    far = F.filter("held", lambda x: x["at"] >= F.col("n_near"))
    # counted shingles that no other class holds stand before those that others hold
    room = F.greatest(F.lit(0), F.col("prefix") - (F.col("n_near") - F.size(near))).cast("int")
    kept = F.concat(F.slice(near, 1, room), far)
    keys = F.array_sort(F.array_distinct(F.transform(kept, lambda x: x["key"])))
    return joined.select("id", "size", "prefix", keys.alias("keys"), (F.size(kept) - F.size(keys)).alias("lost")).where(F.size("keys") > 0)


def lists(prefixed: DataFrame) -> DataFrame:
    """``key, members`` of the lists with two members or more, one for each distinct membership."""
    entries = prefixed.select(F.explode("keys").alias("key"), "id")
    hashed = F.xxhash64("id")
    found = entries.groupBy("key").agg(F.count("*").alias("members"), F.bit_xor(hashed).alias("h1"), F.bit_xor(F.xxhash64(hashed, F.lit(7))).alias("h2"))
    return found.where("members > 1").groupBy("members", "h1", "h2").agg(F.min("key").alias("key")).select("key", "members")


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows of lists, each once per pair of tiles of its list that it is needed in."""
    columns = [c for c in rows.columns if c != "key"]
    tiles = F.ceil(F.col("members") / F.lit(TILE)).cast("int")
    rows = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("key", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "tile", *columns)
    return rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")


def _chosen(tiled: DataFrame, schema: T.StructType, choose) -> DataFrame:
    """The rows that ``choose`` makes of the rows of each pair of tiles."""

    def run(batches):
        for group in _groups(batches):
            rows = choose(group)
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, to_arrow_schema(schema), strict=True)], names=schema.names)

    return tiled.mapInArrow(run, schema)


def _pair_schema(prefixed: DataFrame) -> T.StructType:
    kind = prefixed.schema["id"].dataType
    return T.StructType([T.StructField("a", kind), T.StructField("b", kind)])


def _named(group: list[dict], pairs) -> list[tuple]:
    """Pairs of rows as pairs of ids, the smaller first."""
    ids = [r["id"] for r in group]
    return [(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in pairs]


def _values(column: pa.Array) -> Iterator | list:
    """A column's values; lists as arrays of their own, a fifth of the size of lists of Python's numbers."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        return column.to_pylist()
    values = column.values.to_numpy(zero_copy_only=False)
    return (values[a:b].copy() for a, b in pairwise(column.offsets.to_pylist()))


def _groups(batches) -> Iterator[list[dict]]:
    """The rows of one pair of tiles after the other."""
    rows = (dict(zip(batch.schema.names, row, strict=True)) for batch in batches for row in zip(*map(_values, batch.columns), strict=True))
    for _, group in groupby(rows, key=lambda r: (r["key"], r["one"], r["two"])):
        group = list(group)
        if len(group) > 1:
            yield group


def candidates(prefixed: DataFrame, chosen: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of the lists in ``chosen`` that pass the size and prefix filters.

    All such pairs of small lists, and each member's best partner - most shared shingles,
    then smallest id - in large ones.
    """
    rows = prefixed.select(F.explode("keys").alias("key"), "id", "size", "prefix", "keys", "lost").join(chosen, "key")

    def choose(group: list[dict]) -> list[tuple]:
        if group[0]["members"] <= SMALL:
            return _named(group, zip(*(x.tolist() for x in _passing(group, num, den)[0]), strict=True))
        # most shared first, then the smallest id: one number for both
        _, first, rank = np.unique([r["id"] for r in group], return_index=True, return_inverse=True)
        best = np.full(len(group), -1, np.int64)
        for one, two, shared in _blocks(group, num, den):
            for x, y in ((one, two), (two, one)):
                np.maximum.at(best, x, shared.astype(np.int64) * len(first) + len(first) - 1 - rank[y])
        found = np.flatnonzero(best >= 0)
        return _named(group, zip(found.tolist(), first[len(first) - 1 - best[found] % len(first)].tolist(), strict=True))

    return _chosen(_tiles(rows), _pair_schema(prefixed), choose).distinct()


def bridges(prefixed: DataFrame, chosen: DataFrame, sets: DataFrame, label: DataFrame, num: int, den: int, turn: int) -> DataFrame:
    """Pairs that tie different components of the lists in ``chosen`` together, as few as do.

    A pair belongs to the largest list that holds both. First each list names the members
    that have a pair of their own there which passes the prefix filter; only they are given
    their sets, as 31 bits of each shingle in the first ``turn``. Then a task compares
    these pairs and keeps one only if what it has kept before does not connect the two.
    """
    order = -F.col("members") * F.lit(2**32) + F.col("key").cast("long") + F.lit(2**31)
    entries = prefixed.select(F.explode("keys").alias("key"), "id").join(chosen, "key").withColumn("order", order)
    lists_of = entries.groupBy("id").agg(F.collect_list("order").alias("lists"))
    named = prefixed.select("id", "size", "prefix", "keys", "lost").join(lists_of, "id").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = cut_lineage(named, "named")
    rows = entries.select("key", "id", "members", "order").join(named, "id")
    place = ["key", "one", "two"]
    schema = T.StructType([*(T.StructField(c, T.IntegerType()) for c in (*place, "tile")), T.StructField("id", prefixed.schema["id"].dataType), T.StructField("order", T.LongType())])

    def taking_part(group: list[dict]) -> list[tuple]:
        part = np.zeros(len(group), bool)
        for pair in _own_pairs(group, num, den):
            for side in pair:
                part[side] = True
        return [tuple(group[i][c] for c in schema.names) for i in np.flatnonzero(part).tolist()]

    # after the first turn whole shingles, so that no pair fails again
    sketch = F.col("shingles") if turn else F.transform("shingles", lambda s: (s % F.lit(SKETCH)).cast("int"))
    part = _chosen(_tiles(rows), schema, taking_part).join(named, "id").join(sets.select("id", sketch.alias("sketch")), "id")

    def tying(group: list[dict]) -> list[tuple]:
        size = [r["size"] for r in group]
        labels = [r["label"] for r in group]
        sketches = [np.unique(r.pop("sketch")) for r in group]
        # shingles that fall together in a sketch may all be shared
        lost = [n - len(s) for n, s in zip(size, sketches, strict=True)]
        root = {x: x for x in labels}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        kept = []
        for one, two in _own_pairs(group, num, den):
            for i, j in zip(one.tolist(), two.tolist(), strict=True):
                x, y = find(labels[i]), find(labels[j])
                if x != y:
                    both = _both(sketches[i], sketches[j]) + min(lost[i], lost[j])
                    if both * den >= (size[i] + size[j] - both) * num:
                        root[y] = x
                        kept.append((i, j))
        return _named(group, kept)

    return _chosen(part.repartition(*place).sortWithinPartitions(*place), _pair_schema(prefixed), tying).distinct()


def _both(one: np.ndarray, two: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    return int(np.count_nonzero(one.take(np.searchsorted(one, two), mode="clip") == two))


def _own_pairs(group: list[dict], num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The passing pairs across components that no larger list holds, some rows' at a time."""
    label = np.unique([r["label"] for r in group], return_inverse=True)[1]
    if not label.any():
        return
    before = None
    for one, two, _ in _blocks(group, num, den):
        across = label[one] != label[two]
        one, two = one[across], two[across]
        if len(one):
            if before is None:
                before = _shared([r["lists"][r["lists"] < r["order"]] for r in group]) > 0
            own = ~before[one, two]
            yield one[own], two[own]


def _passing(group: list[dict], num: int, den: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """All pairs of a pair of tiles that pass, and how many prefix shingles they share."""
    one, two, shared = (np.concatenate(parts) for parts in zip(*_blocks(group, num, den), strict=True))
    return (one, two), shared


def _blocks(group: list[dict], num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of a pair of tiles that pass, and how many prefix shingles they share, _BLOCK first rows' at a time.

    Classes of identical prefix and size are one group; pairs of groups are filtered, and
    those that pass are expanded to their members. Of two tiles only pairs across count.
    """
    groups: dict[tuple, list[int]] = {}
    for i, row in enumerate(group):
        groups.setdefault((row["size"], row["prefix"], np.asarray(row["keys"], np.int64).tobytes(), row["lost"]), []).append(i)
    shape = [group[members[0]] for members in groups.values()]
    size = np.array([r["size"] for r in shape])
    rest = size - np.array([r["prefix"] for r in shape])
    lost = np.array([r["lost"] for r in shape])
    shared = _shared([r["keys"] for r in shape])
    alike = np.zeros(shared.shape, bool)
    for start in range(0, len(shape), _BLOCK):
        some = slice(start, start + _BLOCK)
        low, high = np.minimum.outer(size[some], size), np.maximum.outer(size[some], size)
        least = -(-num * (low + high) // (num + den))
        alike[some] = (low * den >= high * num) & (shared[some] >= 1)
        alike[some] &= shared[some] + np.minimum.outer(lost[some], lost) >= least - np.maximum.outer(rest[some], rest)
    of = np.zeros(len(group), np.int64)
    for g, members in enumerate(groups.values()):
        of[members] = g
    ids, tile = np.unique([r["id"] for r in group], return_inverse=True)[1], np.array([r["tile"] for r in group])
    for start in range(0, len(group), _BLOCK):
        one, two = np.nonzero(np.triu(alike[of[start : start + _BLOCK]][:, of], start + 1))
        one += start
        keep = ids[one] != ids[two]
        if group[0]["one"] != group[0]["two"]:
            keep &= tile[one] != tile[two]
        one, two = one[keep], two[keep]
        yield one, two, shared[of[one], of[two]]


def _shared(sets: list) -> np.ndarray:
    """How many keys each two sets share."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate([np.asarray(s, np.int64) for s in sets])
    row = np.repeat(np.arange(n), size)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.zeros((n, n), np.float32)
    several = times[column] > 1
    row, column = row[several], (np.cumsum(times > 1) - 1)[column[several]]
    width = int(column.max()) + 1 if len(column) else 0
    for start in range(0, width, _COLUMNS):
        here = (column >= start) & (column < start + _COLUMNS)
        matrix = np.zeros((n, min(_COLUMNS, width - start)), np.float32)
        matrix[row[here], column[here] - start] = 1
        for a in range(0, n, _BLOCK):
            shared[a : a + _BLOCK, a:] += matrix[a : a + _BLOCK] @ matrix[a:].T
    for a in range(0, n, _BLOCK):
        shared[a + _BLOCK :, a : a + _BLOCK] = shared[a : a + _BLOCK, a + _BLOCK :].T
    np.fill_diagonal(shared, size)
    return shared


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_one"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_two"))
    both = F.size(F.array_intersect("_one", "_two"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", both.cast("long").alias("both"), (F.size("_one") + F.size("_two")).alias("sum"))
    return joined.where(F.col("both") * den >= (F.col("sum") - F.col("both")) * num).select("a", "b")


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Documents link when ``den`` * intersection >= ``num`` * union.
    """
    rows = cut_lineage(profiles(docs, n, num, den, doc_id, text), "profiles")
    linked = rows.where("size > 0 and id is not null")
    classes = cut_lineage(linked.groupBy("print").agg(F.min("id").alias("first")), "classes")
    chosen = linked.join(classes.select(F.col("first").alias("id"), "print"), ["id", "print"], "left_semi")
    prefixed = cut_lineage(prefixes(chosen, num, den), "prefixes")
    meeting = cut_lineage(lists(prefixed), "lists")

    entries = prefixed.select("id", F.explode("keys").alias("key")).join(meeting, "key", "left_semi")
    sets = cut_lineage(whole_sets(docs, entries.select("id").distinct(), n, doc_id, text), "sets")
    found = cut_lineage(verified(candidates(prefixed, meeting, num, den), sets, num, den), "found")

    # documents whose rows have several sets tie the classes of these together
    of_row = linked.select("id", "print").join(classes, "print").select("id", "first")
    torn = of_row.groupBy("id").agg(F.min("first").alias("a"), F.max("first").alias("b")).where("a < b")
    tied = of_row.join(torn.select("id", "a"), "id").select("a", F.col("first").alias("b"))
    found = found.union(tied)
    label = components(found).select(F.col("node").alias("id"), F.col("component").alias("label"))

    large = meeting.where(F.col("members") > SMALL)
    turn = failed = 0
    while turn == 0 or failed:
        named = prefixed.select(F.explode("keys").alias("key"), "id").join(large, "key").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
        several = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.first("members").alias("members"))
        open_lists = cut_lineage(several.where("lo < hi").select("key", "members"), "open")
        if open_lists.isEmpty():
            break
        tried = cut_lineage(bridges(prefixed, open_lists, sets, label, num, den, turn), "tried")
        more = cut_lineage(verified(tried, sets, num, den), "more")
        found = found.union(more)
        label = components(found).select(F.col("node").alias("id"), F.col("component").alias("label"))
        # a pair that only its sketches link may have kept another from being tried
        failed, turn = tried.count() - more.count(), turn + 1

    reached = classes.join(label.withColumnRenamed("id", "first"), "first", "left").select("print", F.coalesce("label", "first").alias("component_id"))
    alone = rows.where("size = 0 or id is null")
    out = linked.select("print", "id", "size").join(reached, "print").select("id", "size", "component_id")
    out = out.union(alone.select("id", "size", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(doc_id), F.col("size").alias("n_shingles"), "component_id")
