"""Benchmark decontamination with a generalised suffix automaton.

The benchmark items, as word sequences, become one automaton. Every document streams its
words through it; the automaton's state is the longest run of words ending here that
occurs in some item. A run of ``n`` words marks those words as hit and names the items that
hold the run. Items with fewer words count as one run of their own length.

* Null or wordless documents have no words and no hits; null or wordless items have no runs.
* Repeated documents give a row each; repeated items, or items with equal ids, are one item.
* Extra columns of either table are ignored, whatever their names.
* A table of items too large for one automaton is cut into shards of ``SHARD_WORDS`` words,
  each with an automaton and a broadcast of its own; items are cut with an overlap of
  ``n - 1`` words, so no run is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.rows import field, held, map_rows, text_bytes
from tablekit.storage import cut_lineage

WINDOW = 10
#: Words of one automaton; a Python automaton takes about 1 kB per word.
SHARD_WORDS = 100_000
#: A longer text is read in pieces of about this size.
PIECE = 1 << 20

#: ASCII letters and digits, and all bytes of characters from U+0080.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
REST = re.compile(rb"[0-9A-Za-z\x80-\xff]*")


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, a piece at a time; no word is cut."""
    start = 0
    while start < len(text):
        end = REST.match(text, min(start + PIECE, len(text))).end()
        yield WORD.findall(text[start:end].lower())
        start = end


class Automaton:
    """A suffix automaton of several word sequences, with the items of each run of ``n``."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int):
        self.n = n
        self.go: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.runs: dict[int, set[str]] = {}
        self.shorts: dict[int, set[tuple[int, str]]] = {}
        for item, words in items:
            self._mark(item, words)
        self.has_short = [self._above(s) for s in range(len(self.go))] if self.shorts else [False] * len(self.go)

    def _extend(self, last: int, word: bytes) -> int:
        go, link, length = self.go, self.link, self.length
        known = go[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, word, known)
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        while last >= 0 and word not in go[last]:
            go[last][word] = new
            last = link[last]
        if last >= 0:
            target = go[last][word]
            link[new] = target if length[target] == length[last] + 1 else self._split(last, word, target)
        return new

    def _split(self, state: int, word: bytes, target: int) -> int:
        """The shorter runs of ``target`` get a state of their own."""
        go, link, length = self.go, self.link, self.length
        copy = len(go)
        go.append(dict(go[target]))
        link.append(link[target])
        length.append(length[state] + 1)
        link[target] = copy
        while state >= 0 and go[state].get(word) == target:
            go[state][word] = copy
            state = link[state]
        return copy

    def _of_length(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a longer run."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _mark(self, item: str, words: list[bytes]) -> None:
        state = 0
        for i, word in enumerate(words, 1):
            state = self.go[state][word]
            if i >= self.n:
                self.runs.setdefault(self._of_length(state, self.n), set()).add(item)
        if words and len(words) < self.n:
            self.shorts.setdefault(self._of_length(state, len(words)), set()).add((len(words), item))

    def _above(self, state: int) -> bool:
        while state > 0:
            if state in self.shorts:
                return True
            state = self.link[state]
        return False

    def match(self, text: bytes) -> tuple[int, list[list[int]], set[str]]:
        """The number of words, the merged spans of hit words, and the items found."""
        go, link, length, n, has_short = self.go, self.link, self.length, self.n, self.has_short
        state = run = at = 0
        spans: list[list[int]] = []
        items: set[str] = set()
        for words in word_lists(text):
            for word in words:
                at += 1
                after = go[state].get(word)
                while after is None and state:
                    state = link[state]
                    run = length[state]
                    after = go[state].get(word)
                if after is None:
                    run = 0
                    continue
                state = after
                run += 1
                if run >= n:
                    items |= self.runs[self._of_length(state, n)]
                    _cover(spans, at - n, at)
                if has_short[state]:
                    up = state
                    while up > 0:
                        for size, item in self.shorts.get(up, ()):
                            if size <= run:
                                items.add(item)
                                _cover(spans, at - size, at)
                        up = link[up]
        return at, spans, items


def _cover(spans: list[list[int]], start: int, end: int) -> None:
    """Add a span that ends no earlier than all others."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, end])


def shards(items: DataFrame, item_id: str, text: str, n: int, limit: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in groups of about ``limit`` words; only one group is in memory."""
    group: list[tuple[str, list[bytes]]] = []
    held = 0
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), text_bytes(text).alias("text"))
    for row in named.distinct().toLocalIterator():
        words = [w for part in word_lists(bytes(row.text)) for w in part]
        step = max(limit, n)
        for start in range(0, max(1, len(words) - n + 1), step):
            piece = words[start : start + step + n - 1]
            if piece:
                group.append((row.item, piece))
                held += len(piece)
            if held >= limit:
                yield group
                group, held = [], 0
    if group:
        yield group


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def matches(
    docs: DataFrame,
    items: DataFrame,
    n: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: tuple[str, ...] = (),
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per document: id, ``n_words``, ``spans`` of hit words (start, end exclusive), sorted ``items``.

    ``keep`` names further columns to carry along, none of them called like a result. No shuffle:
    documents stream past the broadcast automata. Items of more than ``shard_words`` words in
    all go through one group after the other; the driver holds one group, as does each task.
    """
    names = [doc_id, *[k for k in keep if k != doc_id]]
    if clash := {"n_words", "spans", "items"} & set(names):
        raise ValueError(f"columns to carry along have the names of results: {sorted(clash)}")
    rows, schema, convert = _last_pass(docs, items, n, names, text, item_id, item_text, shard_words)
    return map_rows(rows, schema, convert, "__llm_text").select(
        *names,
        F.col("__llm_words").alias("n_words"),
        F.transform("__llm_spans", lambda s: F.struct(s[0].alias("start"), s[1].alias("end"))).alias("spans"),
        F.array_sort("__llm_items").alias("items"),
    )


def _last_pass(docs: DataFrame, items: DataFrame, n: int, names: list[str], text: str, item_id: str, item_text: str, shard_words: int):
    """The rows after all groups of items but the last, and the schema and function that add the last one's matches."""
    spark = docs.sparkSession
    span = T.ArrayType(T.ArrayType(T.LongType()))
    carried = [field(docs, k) for k in names]
    out = docs.select(*names, text_bytes(text).alias("__llm_text"), F.lit(0).cast("long").alias("__llm_words"), F.array().cast(span).alias("__llm_spans"), F.array().cast("array<string>").alias("__llm_items"))
    schema = T.StructType([*carried, T.StructField("__llm_text", T.BinaryType()), T.StructField("__llm_words", T.LongType()), T.StructField("__llm_spans", span), T.StructField("__llm_items", T.ArrayType(T.StringType()))])
    groups = shards(items, item_id, item_text, n, shard_words)
    convert = None
    for group in chain([next(groups, [])], groups):
        if convert:
            # one automaton a stage, however many groups there are
            out = cut_lineage(map_rows(out, schema, convert, "__llm_text"), "matched")
        convert = _matcher(spark.sparkContext.broadcast(group), n, len(names))
    return out, schema, convert


def automaton_of(group: list, n: int) -> Automaton:
    """The automaton of a broadcast group, kept by the Python worker."""
    return held(f"automaton {n}", group, lambda: Automaton(group, n))


def _matcher(shared, n: int, carried: int):
    def convert(batch: pa.RecordBatch):
        automaton = automaton_of(shared.value, n)
        words, spans, items = [], [], []
        for text, old_spans, old_items in zip(*(batch.column(carried + i) for i in (0, 2, 3)), strict=True):
            count, found, named = automaton.match(text.as_py())
            words.append(count)
            before, listed = old_spans.as_py(), old_items.as_py()
            spans.append(_merged(before, found) if before else found)
            items.append(sorted(named.union(listed)))
        return [*(batch.column(i) for i in range(carried + 1)), words, spans, items]

    return convert


def hit_words(spans: str = "spans"):
    """The number of hit words of a document."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def remove(
    docs: DataFrame,
    items: DataFrame,
    n: int = WINDOW,
    max_words: int = 0,
    max_coverage: float = 0.8,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` without hit spans longer than ``max_words``; without documents that are mostly hit.

    A document whose hit words are more than ``max_coverage`` of its words goes. In the
    others each span over ``max_words`` is cut from its first word's start to its last
    word's end. Documents without hits keep their text untouched. The columns stay the same.
    """
    outer = docs.columns
    doc_id, text = f"__in{outer.index(doc_id)}", f"__in{outer.index(text)}"
    docs = docs.toDF(*(f"__in{i}" for i in range(len(outer)))).withColumn(text, F.col(text).cast("binary"))  # no column of the input can clash
    names = docs.columns
    at = names.index(text)
    # cut as soon as the last group is matched: a second pass would be a second Python worker for every task
    rows, _, match = _last_pass(docs, items, n, names, text, "item_id", "text", SHARD_WORDS)

    def convert(batch: pa.RecordBatch):
        *_, words, spans, _ = match(batch)
        hit = [sum(end - start for start, end in found) for found in spans]
        keep = pa.array([h <= w * max_coverage for h, w in zip(hit, words, strict=True)], pa.bool_())
        columns = [batch.column(i).filter(keep) for i in range(len(names))]
        cuts = [[{"start": a, "end": b} for a, b in found if b - a > max_words] for found, kept in zip(spans, keep.to_pylist(), strict=True) if kept]
        if any(cuts):
            columns[at] = [without(t, c) if c else t for t, c in zip(columns[at].to_pylist(), cuts, strict=True)]
        return columns

    schema = T.StructType([field(docs, c) for c in names])
    return map_rows(rows, schema, convert, "__llm_text").withColumn(text, F.col(text).cast("string")).toDF(*outer)


def without(text: bytes, spans: list[dict]) -> bytes:
    """Cut spans of words out of a text."""
    out, done = [], 0
    todo = iter(spans)
    span = next(todo)
    begin = 0
    for i, found in enumerate(WORD.finditer(text.lower())):
        if i == span["start"]:
            begin = found.start()
        if i == span["end"] - 1:
            out.append(text[done:begin])
            done = found.end()
            span = next(todo, None)
            if span is None:
                break
    return b"".join([*out, text[done:]])
