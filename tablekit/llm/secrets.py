"""Secrets in texts: fixed patterns, and a guess-cost estimate of credential values.

The patterns find assignments, access keys and long hexadecimal runs. Beyond them, values
that stand behind a credential word are judged by what guessing them would cost: a dynamic
program over the value takes the cheapest cut into dictionary words, dates, repeats,
keyboard walks and brute-force characters, in bits. Values at or over ``MIN_BITS`` are
secrets of kind ``guess``; placeholders such as ``password123`` cost little and are not.

* Null is the empty text: no spans. Positions count code points; ends are exclusive.
* Texts are scanned whole. Repeated rows give a row each; extra columns are ignored.
* Spans of one kind never overlap; spans of different kinds may.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.rows import field, map_rows, text_bytes

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "guess")

#: The patterns of the base kinds and the least length of each.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
MIN_ASSIGN = 12

#: Words behind which a value is a credential, and what may stand between. Gaps and values are
#: as long as they are. A quoted value may hold blanks and escaped quotes and ends on its line; one
#: whose quote is not closed there ends as an unquoted one does.
CONTEXT = re.compile(
    rb"""(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|credentials?|auth)["']?[\x20\t]*+(?:[:=]|=>|\bis\b)[\x20\t]*+"""
    rb"""(?:"((?:[^"\\\r\n]++|\\.)*+)"|'((?:[^'\\\r\n]++|\\.)*+)'|["']?([^\s"'<>,;]{8,}))""",
    re.IGNORECASE,
)
HINTS = (b"passw", b"passphrase", b"pwd", b"secret", b"token", b"api", b"credential", b"auth")
#: Shorter values are not judged.
MIN_VALUE = 8
MIN_BITS = 36.0

#: Words that stand in for a password or begin most guesses, most common first.
COMMON = (
    "password pass admin user login welcome secret test demo example sample letmein master changeme default root guest "
    "dragon monkey shadow sunshine princess football baseball qwerty abc token key api auth your my the none null true "
    "false undefined placeholder dummy foo bar temp local host server database value string name hidden private public "
    "january february march april may june july august september october november december summer winter spring autumn "
    "monday tuesday wednesday thursday friday saturday sunday love hello please enter here insert replace this with"
).split()
RANK = {word: i + 1 for i, word in enumerate(COMMON)}
LONGEST = max(map(len, COMMON))
#: No part but a walk or a repeat of one key starts further back: words, dates, blocks of 16.
REACH = max(LONGEST, 16)
#: Rows of a keyboard.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
NEXT_KEYS = {(row[i], row[i + 1]) for row in KEYBOARD for i in range(len(row) - 1)}
NEXT_KEYS |= {(b, a) for a, b in NEXT_KEYS}
LEET = str.maketrans("013457@$!", "oieastasi")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
DATE_BITS = math.log2(365 * 120)


def brute_bits(c: str) -> float:
    """Bits of one character guessed from its class."""
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26)
    return math.log2(33) if c.isascii() else 10.0


def guess_bits(value: str, enough: float = math.inf) -> float:
    """The bits of the cheapest way to guess ``value`` part by part.

    A part costs the bits of its own choice and one bit that ends it. Ties are of no
    consequence, since only the cost is returned. The empty value costs nothing.

    As soon as every way on costs ``enough`` or more, a number that is at least ``enough`` is
    returned: a part starts within the last REACH places or in the walk or repeat under way.
    """
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    cost = [0.0] + [math.inf] * n
    walk_start = repeat_start = 0
    # starts of a walk and of a repeat under way that may still be cheapest, with the cost up to and with their first key
    walk: list[tuple[float, int]] = []
    repeat: list[tuple[float, int]] = []
    dates: dict[int, list[int]] = {}
    for end in range(1, n + 1):
        c = low[end - 1]
        m = DATE.match(value, end - 1)
        if m:
            dates.setdefault(m.end(), []).append(end - 1)
            if m.end() - end > 3 and value[end - 1 : end + 3].isdigit():
                dates.setdefault(end + 3, []).append(end - 1)
        best = cost[end - 1] + brute_bits(value[end - 1]) + (1.0 if value[end - 1].isupper() else 0.0)
        # words, in plain or leet letters, upper case costs a bit
        for start in range(max(0, end - LONGEST), end - 1):
            rank = RANK.get(low[start:end])
            extra = 0.0
            if rank is None:
                rank = RANK.get(plain[start:end])
                extra = 2.0
            if rank is not None:
                if low[start:end] != value[start:end]:
                    extra += 1.0
                best = min(best, cost[start] + math.log2(rank) + 1.0 + extra)
        for start in dates.pop(end, ()):
            best = min(best, cost[start] + (DATE_BITS if end - start > 4 else math.log2(120)) + 1.0)
        # keyboard walks and repeats of three or more: first key, then the length
        if end > 1:
            if (low[end - 2], c) not in NEXT_KEYS:
                walk_start = end - 1
                walk.clear()
            if low[end - 2] != c:
                repeat_start = end - 1
                repeat.clear()
        for since, starts in ((walk_start, walk), (repeat_start, repeat)):
            if end - since >= 3:
                best = min(best, _run_bits(starts, cost[end - 3] + brute_bits(value[end - 3]), end))
        # a repeat of the block before
        for size in range(2, min(16, end // 2) + 1):
            if low[end - size : end] == low[end - 2 * size : end - size]:
                best = min(best, cost[end - size] + math.log2(size) + 2.0)
        cost[end] = best
        if best >= enough and end < n:
            least = min(cost[max(0, end - REACH) : end + 1])
            if least >= enough and all(x >= enough for x, _ in (*walk, *repeat)):
                return least
    return cost[n]


def _run_bits(starts: list[tuple[float, int]], bits: float, end: int) -> float:
    """The cheapest walk or repeat up to ``end``, after its latest possible start has joined ``starts``.

    The length of an earlier start grows the slower, so a start that an earlier one undercuts
    now is undercut from now on, and one that costs no less than a later one always is.
    """
    while starts and starts[-1][0] >= bits:
        starts.pop()
    starts.append((bits, end - 3))
    best, kept = math.inf, []
    for bits, start in starts:
        total = bits + math.log2(end - start) + 1.0
        if total < best:
            best = total
            kept.append((bits, start))
    starts[:] = kept
    return best


def spans_of(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, in order."""
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if b"AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
        m = CONTEXT.search(text)
        while m:
            start, end = m.span(m.lastindex)
            secret = end - start >= MIN_VALUE and guess_bits(text[start:end].decode("utf-8", "replace"), MIN_BITS) >= MIN_BITS
            if secret:
                found.append((start, 3, end))
            # a value that is none may hold the next credential word
            m = CONTEXT.search(text, end if secret else start)
    return sorted(found)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    marks = sorted({x for a, _, b in spans for x in (a, b)})
    at, done, total = {}, 0, 0
    for mark in marks:
        total += len(text[done:mark].decode("utf-8", "replace"))
        at[mark], done = total, mark
    return [(at[a], k, at[b]) for a, k, b in spans]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id and ``spans`` (kind, start, end), ordered by start, then kind. No shuffle."""
    schema = T.StructType([field(docs, doc_id), T.StructField("spans", T.ArrayType(SPAN))])

    def convert(batch: pa.RecordBatch):
        found = []
        for value in batch.column(1):
            raw = value.as_py()
            found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in in_code_points(raw, spans_of(raw))])
        return [batch.column(0), found]

    return map_rows(docs.select(doc_id, text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text")


def listed(spans):
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: bytes = b"[SECRET]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark``; overlapping spans are replaced together.

    Rows and columns stay; null texts stay null; texts without secrets are untouched.
    """
    names = docs.columns
    schema = T.StructType([field(docs, c) if c != text else T.StructField(c, T.BinaryType()) for c in names])
    at = names.index(text)

    def convert(batch: pa.RecordBatch):
        columns = list(batch.columns)
        columns[at] = [None if v is None else _replaced(v, mark) for v in batch.column(at).to_pylist()]
        return columns

    return map_rows(docs.withColumn(text, F.col(text).cast("binary")), schema, convert, text).withColumn(text, F.col(text).cast("string"))


def _replaced(text: bytes, mark: bytes) -> bytes:
    out, done = [], 0
    for start, _, end in spans_of(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return b"".join([*out, text[done:]])
