"""Removal of passages that stand earlier in the corpus, by a compacted De Bruijn graph.

Every ``window`` consecutive words of a text hold an anchor: the group of ``gram`` words with the
least hash. Equal windows have equal anchors, so a text is a path from anchor to anchor, and the
words from one anchor past the next are the edges of a De Bruijn graph of variable order.

1. Anchors are counted over the corpus, merged in each task before the shuffle. One that is
   found once ends every window around it; a repeated one is passed through if the words around
   it, or the text's begin or end, are the same wherever it is found, and branches if not.
2. A join brings the kinds back to the places of the repeated anchors.
3. Anchors that are only passed through lie on paths without branches. Each such path is one
   row: whoever holds a window of it holds all of it. Windows around a branch are a row each.
4. Rows are compared by 96 bits of their words. The least document of equal rows is their
   source; the coordinates of all others, and of later places in one text, are removed. Rows
   whose anchors have many places meet in groups of a key; the first of each group meet again.

Texts are shuffled once. The rows compared are paths and the windows around branches, not all windows of the corpus.
All joins, aggregates and groups are on hashes of words or rows. A passage in a third of all
texts is merged in each task while anchors are counted, adaptive execution splits the join that
brings the kinds back, and its n places are compared in about sqrt(n) groups of sqrt(n).

* Words are what blanks and the ASCII controls tab to carriage return separate, byte by byte.
  A text with fewer than ``window`` words keeps them all, as null and empty ones keep nothing.
* A word goes if any window over it stands earlier: in a smaller id, or before in the same text.
  Windows are judged on the input. Rows that share an id are not earlier than each other, so
  rows repeated whole all stay; rows without id are later than all others.
* An empty table stays empty. Extra columns may have any name.
* A text is worked on whole; memory is proportional to the longest text of a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.packed import hash_spans, layout, mix, true_runs
from tablekit.llm.rows import field, map_rows, text_bytes
from tablekit.storage import cut_lineage

WINDOW = 20
GRAM = 5
#: Places of an anchor up to which those of a path or window meet in one group; more meet in groups of about their square root.
HOT_PLACES = 1000
#: In place of the bits of a group's number: the span stands earlier in its own text.
LATER = -1

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Two polynomials modulo 2 ** 64 over two hashes of a word; odd, so that they have inverses.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SALTS = (0x165667B19E3779F9, 0x27D4EB2F165667C5)


class Words:
    """The words of texts side by side: the text of each, and hashes of any stretch of them."""

    def __init__(self, column: pa.Array):
        data, bounds = layout(column)
        starts, ends = true_runs(~_SEPARATOR[data], bounds) if len(data) else (np.empty(0, np.int64),) * 2
        hashed = hash_spans(data, starts, ends - starts)
        self.n = len(starts)
        #: the first word of each text, and behind the last
        self.first = np.searchsorted(starts, bounds)
        self.owner = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))
        self._sums = []
        for base, salt in zip(_BASES, _SALTS, strict=True):
            value = mix((hashed ^ np.uint64(salt)) * np.uint64(base))
            powers = np.full(self.n + 1, base, np.uint64)
            back = np.full(self.n + 1, pow(base, -1, 1 << 64), np.uint64)
            powers[:1] = back[:1] = 1
            powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(value * powers[:-1], out=sums[1:])
            self._sums.append((sums, back))

    def hashes(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """64 bits of the words from ``start`` up to ``end`` and of their number."""
        sums, back = self._sums[which]
        return mix(mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64)) + np.uint64(_SALTS[which]))


class Anchors:
    """The anchors of texts in order: place, and first and last window whose anchor it is."""

    def __init__(self, words: Words, window: int, gram: int):
        empty = np.empty(0, np.int64)
        self.place = self.begin = self.last = self.owner = empty
        self.hash = empty.astype(np.uint64)
        n = words.n - window + 1
        if n <= 0:
            return
        at = np.flatnonzero(words.owner[:n] == words.owner[window - 1 :])
        grams = words.hashes(np.arange(words.n - gram + 1), np.arange(gram, words.n + 1))
        least = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1).argmin(axis=1)[at] + at
        if not len(at):
            return
        new = np.flatnonzero(np.diff(least, prepend=-1))
        self.place, self.begin = least[new], at[new]
        self.last = at[np.append(new[1:], len(at)) - 1]
        self.hash, self.owner = grams[self.place], words.owner[self.place]

    def around(self, words: Words, window: int, gram: int) -> np.ndarray:
        """A hash of the words that tell the anchors before and after (none: the text's begin or end) and every window of each anchor."""
        here = np.arange(len(self.place))
        same = np.append(self.owner[1:] == self.owner[:-1], False)
        before, after = here - np.append(False, same[:-1]), here + same
        start = np.minimum(self.place[before], self.begin)
        end = np.maximum(self.place[after] + gram, self.last + window)
        told = words.hashes(start, end)
        # no anchor is at distance 0 from another
        for distance in (self.place - start, self.place - self.place[before], self.place[after] - self.place):
            told = mix(told + distance.astype(np.uint64) * np.uint64(_BASES[1]))
        return told


def _with_row(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with a hash that equal rows share, and the text's bytes."""
    return docs.withColumn("__llm_row", F.xxhash64(F.col(doc_id), F.col(text))).withColumn("__llm_text", text_bytes(text))


def anchors(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``anchor, around, row, place`` of every anchor."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("around", T.LongType()), T.StructField("row", T.LongType()), T.StructField("place", T.LongType())])

    def convert(batch: pa.RecordBatch):
        words = Words(batch.column("__llm_text"))
        found = Anchors(words, window, gram)
        around = found.around(words, window, gram)
        row = np.asarray(batch.column("__llm_row"))[found.owner]
        return [found.hash.view(np.int64), around.view(np.int64), row, found.place - words.first[found.owner]]

    return map_rows(rows.select("__llm_row", "__llm_text"), schema, convert, "__llm_text")


def _paths(rows: DataFrame, doc_id: str, window: int, gram: int) -> DataFrame:
    """``key_a, key_b, id, row, span, bits``: paths without branches and windows around branches, by 96 bits of their words.

    ``bits`` are those of the group number that the anchor's places need. Spans that their text
    held before have LATER there, joined where they overlap; their key says nothing.
    ``span`` has the first word in its upper 32 bits, the word behind the last in its lower.
    """
    schema = T.StructType([
        T.StructField("key_a", T.LongType()), T.StructField("key_b", T.IntegerType()), field(rows, doc_id, "id"),
        T.StructField("row", T.LongType()), T.StructField("span", T.LongType()), T.StructField("bits", T.ByteType()),
    ])

    def convert(batch: pa.RecordBatch):
        words = Words(batch.column("__llm_text"))
        found = Anchors(words, window, gram)
        told = batch.column("__llm_kinds")
        values = np.asarray(told.flatten())
        owner = np.repeat(np.arange(len(told)), np.asarray(told.value_lengths()))
        # 0: found once in the corpus, 1: branches, 2: passed through
        kind, bits = np.zeros(words.n + 1, np.int8), np.zeros(words.n + 1, np.int8)
        at = words.first[owner] + (values >> 8)
        kind[at], bits[at] = (values & 1) + 1, values >> 1 & 127
        kind, bits = kind[found.place], bits[found.place]
        through = kind == 2
        joined = np.zeros(len(kind), bool)
        joined[1:] = through[1:] & through[:-1] & (found.owner[1:] == found.owner[:-1])
        heads = np.flatnonzero(through & ~joined)
        tails = np.flatnonzero(through & ~np.append(joined[1:], False))
        branch = np.flatnonzero(kind == 1)
        many = found.last[branch] - found.begin[branch] + 1
        windows = np.arange(many.sum()) + np.repeat(found.begin[branch] - (np.cumsum(many) - many), many)
        start = np.concatenate([found.begin[heads], windows])
        end = np.concatenate([found.last[tails], windows]) + window
        bits = np.concatenate([bits[heads], np.repeat(bits[branch], many)])
        own = words.owner[start] if len(start) else start
        a, b = words.hashes(start, end, 0).view(np.int64), words.hashes(start, end, 1).astype(np.uint32).view(np.int32)
        order = np.lexsort((start, b, a, own))
        start, end, own, a, b, bits = (x[order] for x in (start, end, own, a, b, bits))
        later = np.zeros(len(start), bool)
        later[1:] = (own[1:] == own[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        again_start, again_end, again_own = _joined(start[later], end[later], own[later])
        spread = mix(again_start.astype(np.uint64)).view(np.int64)
        a, b, bits = np.append(a[~later], spread), np.append(b[~later], np.zeros(len(spread), np.int32)), np.append(bits[~later], np.full(len(spread), LATER))
        start, end, own = np.append(start[~later], again_start), np.append(end[~later], again_end), np.append(own[~later], again_own)
        shift = words.first[own]
        spans = (start - shift << 32) | (end - shift)
        return [a, b.astype(np.int32), batch.column(doc_id).take(pa.array(own)), np.asarray(batch.column("__llm_row"))[own], spans, bits.astype(np.int8)]

    return map_rows(rows, schema, convert, "__llm_text")


def _joined(start: np.ndarray, end: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of texts side by side, joined where they overlap."""
    order = np.argsort(start, kind="stable")
    start, end, own = start[order], end[order], own[order]
    reach = np.maximum.accumulate(end) if len(end) else end
    first = np.flatnonzero(np.append(True, start[1:] >= reach[:-1])[: len(start)])
    return start[first], np.maximum.reduceat(end, first) if len(first) else end, own[first]


def earlier_spans(rows: DataFrame, doc_id: str, window: int, gram: int) -> DataFrame:
    """``row`` and the ``spans`` of its words that stand earlier in the corpus; rows without any are left out."""
    places = anchors(rows, window, gram)
    repeated = places.groupBy("anchor").agg(F.count("*").alias("n"), F.min("around").alias("least"), F.max("around").alias("most"))
    # a table of its own: a join on an aggregate's partitions could not split an anchor's many places
    bits = F.when(F.col("n") > HOT_PLACES, F.ceil(F.log2("n") / 2)).otherwise(0)
    repeated = cut_lineage(repeated.where("n > 1").select("anchor", (F.col("least") == F.col("most")).alias("same"), bits.cast("byte").alias("bits")), "debruijn-anchors")
    kind = F.col("place") * 256 + F.col("bits") * 2 + F.when(F.col("same"), 1).otherwise(0)
    kinds = places.select("anchor", "row", "place").join(repeated, "anchor").select(F.col("row").alias("__llm_row"), kind.alias("kind"))
    # a set: rows that are equal throughout share their row hash, and each task keeps one of their values
    kinds = cut_lineage(kinds.groupBy("__llm_row").agg(F.collect_set("kind").alias("__llm_kinds")), "debruijn-kinds")
    paths = _paths(rows.join(kinds, "__llm_row"), doc_id, window, gram)
    earlier = "coalesce(first < id or id is null and first is not null, false)"
    # a path has no more places than its anchors: those of many meet in groups, and the first of each group once more
    group = F.expr("if(bits > 0, pmod(row, shiftleft(1L, cast(bits as int))), 0L)")
    grouped = paths.withColumn("group", group).withColumn("first", F.min("id").over(Window.partitionBy("key_a", "key_b", "group")))
    decided = grouped.where(f"bits = {LATER} or {earlier}")
    open_still = grouped.where(f"bits > 0 and not {earlier}").withColumn("first", F.min("id").over(Window.partitionBy("key_a", "key_b")))
    gone = decided.select("row", "span").union(open_still.where(earlier).select("row", "span"))
    return gone.groupBy("row").agg(F.collect_set("span").alias("spans"))


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: id (and ``keep``), ``n_words``, ``n_removed`` and ``kept``, the words that stay with one blank between them."""
    if not 1 <= gram < window:
        raise ValueError("an anchor is shorter than a window")
    names = list(dict.fromkeys([doc_id, *keep]))
    rows = _with_row(docs.select(*dict.fromkeys([*names, text])), doc_id, text).select(*names, "__llm_row", "__llm_text")
    spans = earlier_spans(rows, doc_id, window, gram).select(F.col("row").alias("__llm_row"), F.col("spans").alias("__llm_spans"))
    # the same columns as in `earlier_spans`, so that texts are shuffled once for both joins
    joined = rows.join(spans, "__llm_row", "left")
    schema = T.StructType([*(field(docs, c) for c in names), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")), T.StructField("kept", T.BinaryType())])

    def convert(batch: pa.RecordBatch):
        n_words, n_removed, kept = [], [], []
        for value, gone in zip(batch.column("__llm_text"), batch.column("__llm_spans"), strict=True):
            words = value.as_py().split()
            n_words.append(len(words))
            if gone.is_valid:
                span = np.asarray(gone.values)
                edges = np.bincount(span >> 32, minlength=len(words) + 1) - np.bincount(span & 0xFFFFFFFF, minlength=len(words) + 1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        return [*(batch.column(c) for c in names), n_words, n_removed, kept]

    return map_rows(joined, schema, convert, "__llm_text").withColumn("kept", F.col("kept").cast("string"))
