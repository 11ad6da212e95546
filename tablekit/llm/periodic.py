"""Runs of repeated words: stretches of a text that repeat with a period.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping
the period, ``exponent`` periods and ``shortest`` words long at least.

Words are appended one by one to a suffix automaton. Its link tree is kept in link-cut form:
the states on a path to the root whose strings ended last at the same word form a segment of
one colour. The path of an appended word is accessed, which walks its segments and recolours
them. A segment whose strings ended last d words ago, with d among their lengths and no
shorter string of that length, tells that the last 2 d words are a square of a primitive word.
Squares are extended to runs over the words beside them.

What goes into the automaton are the stretches that can hold a run at all: in a run of period
q each group of words after the first q words was there at most q words before. Stretches of
such groups, for every power of two above q, are found by sorting; nothing else can be in a
run, and all that can be goes through the automaton.

* Words are what blanks and the ASCII controls tab to carriage return separate; they are compared byte by byte.
* A null or empty text has no words, no runs and an empty collapsed text. Repeated rows are
  rows like any other. An empty table stays empty; columns not named are ignored.
* A text is worked on whole; memory is proportional to the longest text of a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablekit.llm.packed import mix
from tablekit.llm.rows import field, map_rows, text_bytes

EXPONENT = 4
SHORTEST = 6
#: Most words of the groups that are looked up while stretches are sought.
_GROUP = 8
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def squares(words: list[int]):
    """(place of the last word, length of one half) of squares of primitive words, at every place where one ends.

    State 1 is the root, 0 is none. ``left``, ``right`` and ``above`` are the splay trees of
    the segments, in order of depth; the colour stands at the top of each. ``above`` of a top
    is the state that its segment hangs from.
    """
    size, link, follow = [0, 0], [0, 0], [{}, {}]
    left, right, above, colour = [0, 0], [0, 0], [0, 0], [-1, -1]

    def state(length: int, following: dict) -> int:
        size.append(length)
        link.append(0)
        follow.append(following)
        for tree in (left, right, above):
            tree.append(0)
        colour.append(-1)
        return len(size) - 1

    def rotate(x: int, p: int, g: int) -> None:
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            above[inner] = p
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        above[p], above[x] = x, g

    def splay(x: int) -> None:
        """Bring ``x`` to the top of its segment's tree, and the colour with it."""
        while True:
            p = above[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = above[p]
            if not g or (left[g] != p and right[g] != p):
                colour[x] = colour[p]
                rotate(x, p, g)
                return
            gg = above[g]
            if not gg or (left[gg] != g and right[gg] != g):
                colour[x] = colour[g]
            if (left[p] == x) == (left[g] == p):
                rotate(p, g, gg)
                rotate(x, p, gg)
            else:
                rotate(x, p, g)
                rotate(x, g, gg)

    last = 1
    for place, word in enumerate(words):
        current = state(size[last] + 1, {})
        p = last
        while p and word not in follow[p]:
            follow[p][word] = current
            p = link[p]
        target = 1
        if p:
            q = target = follow[p][word]
            if size[p] + 1 != size[q]:
                target = state(size[p] + 1, follow[q].copy())
                while p and follow[p].get(word) == q:
                    follow[p][word] = target
                    p = link[p]
                link[target], link[q] = link[q], target
                # in the middle of q's link, and of q's segment: their strings ended at the same places so far
                splay(q)
                left[target], left[q], above[target] = left[q], target, q
                if left[target]:
                    above[left[target]] = target
        link[current] = above[current] = target
        last = x = current
        below = 0
        while x:
            splay(x)
            if right[x]:
                colour[right[x]] = colour[x]
            right[x] = below
            if below:
                distance = place - colour[x]
                if size[above[x]] < distance <= size[x]:
                    yield place, distance
            below, x = x, above[x]
        colour[below] = place


def _since(groups: np.ndarray) -> np.ndarray:
    """How many places before the same value stood last; the number of values where it did not."""
    since = np.full(len(groups), len(groups), np.int64)
    order = np.argsort(groups, kind="stable")
    ranked = groups[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    since[order[same + 1]] = order[same + 1] - order[same]
    return since


def stretches(ids: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Starts and ends of parts of ``ids`` outside which no word is in a run."""
    n = len(ids)
    found: list[tuple[int, int]] = []
    hashed = mix((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    groups, since, width = hashed, None, 0
    most = 1
    while most // 2 + 1 <= n // exponent:
        # periods above most / 2, up to most
        least = most // 2 + 1
        wanted = min(_GROUP, least)
        if since is None or wanted != width:
            groups = hashed[: n - wanted + 1].copy()
            for k in range(1, wanted):
                groups = mix(groups * np.uint64(0x9E3779B97F4A7C15) + hashed[k : n - wanted + 1 + k])
            since, width = _since(groups), wanted
            if since.min() >= len(since):
                break
        need = max((exponent - 1) * least, shortest - most) - wanted + 1
        near = np.flatnonzero(np.diff(np.concatenate([[False], since <= most, [False]]).astype(np.int8)))
        starts, ends = near[::2], near[1::2]
        for i in np.flatnonzero(ends - starts >= need).tolist():
            found.append((max(0, int(starts[i]) - most), int(ends[i]) + wanted - 1))
        most *= 2
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def runs_of(ids: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, ordered by start and period."""
    words, n = ids.tolist(), len(ids)
    found: list[tuple[int, int, int]] = []
    for a, b in stretches(ids, exponent, shortest):
        reached: dict[int, int] = {}
        for place, period in squares(words[a:b]):
            end = a + place
            if reached.get(period, -1) >= end:
                continue
            start = end - 2 * period + 1
            while start and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while end + 1 < n and words[end + 1] == words[end + 1 - period]:
                end += 1
            reached[period] = end
            if end + 1 - start >= max(shortest, exponent * period):
                found.append((start, end + 1 - start, period))
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one blank between them, without those in a run after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """Per document: id, ``runs`` (start and length in words, period), and the text ``collapsed`` to one period of each. No shuffle."""
    if exponent < 2 or shortest < 2:
        raise ValueError("a run has two periods and two words at least")
    schema = T.StructType([field(docs, doc_id), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.BinaryType())])

    def convert(batch: pa.RecordBatch):
        runs, texts = [], []
        for value in batch.column(1):
            # bytes split at blanks and at tab to carriage return, at nothing else
            words = value.as_py().split()
            own = runs_of(numbered(words), exponent, shortest) if len(words) >= shortest else []
            runs.append([{"start": a, "length": n, "period": q} for a, n, q in own])
            texts.append(collapsed(words, own))
        return [batch.column(0), runs, texts]

    found = map_rows(docs.select(doc_id, text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text")
    return found.withColumn("collapsed", found["collapsed"].cast("string"))
