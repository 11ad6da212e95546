"""Token counts of a unigram vocabulary by a count-only Viterbi.

An Aho-Corasick automaton of the vocabulary lists every piece that ends at each character of
a segment. The dynamic program keeps, per character, the best score of a cut that ends there
and the number of its pieces; no path is kept. Ties go as in the tokenizer: of cuts of equal
score the one whose last piece is longest, since a later one has to be strictly better. A
character that no piece of its own covers is unknown: it scores ``UNKNOWN_PENALTY`` less
than the lowest piece and counts as the pieces of its bytes if the vocabulary has them, else
as one, and unknown characters side by side count as one together.

A text's blanks become the vocabulary's blank mark, with one in front. No piece has the mark
after another character, so a text falls into segments that begin with marks, and each
segment's count is worked out once and kept.

* Null and empty texts have no tokens. Control characters are ordinary unknown characters.
* Repeated rows give a row each. Extra columns are ignored.
* A task forgets the segments it knows when it holds more than ``KEPT``; time only.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablekit.llm.rows import field, held, map_rows, text_bytes

#: Fixed values of the tokenizer's format.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT = 500_000
LONG = 256


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces and byte pieces of a model file, with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        names = {p for p, _ in pieces}
        byte_names = [f"<0x{b:02X}>" for b in range(256)]
        self.has_bytes = all(b in names for b in byte_names)
        ordinary = [(p, s) for p, s in pieces if p and not (self.has_bytes and p in byte_names)]
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in ordinary:
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses a blank")
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.empty = not ordinary
        self.known: dict[str, tuple[int, bool, bool]] = {}

    def count(self, segment: str) -> tuple[int, bool, bool]:
        """The pieces of a segment, and whether its first and last are unknown."""
        n = len(segment)
        best = [0.0] + [None] * n
        pieces = [0] * (n + 1)
        last = [False] * (n + 1)  # whether the cut that ends here ends in an unknown character
        first = [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if not self.empty:
            for end, found in self.automaton.iter(segment):
                ends[end].append(found)
        for end in range(1, n + 1):
            single = False
            for size, score in ends[end - 1]:  # longest first
                start = end - size
                single |= size == 1
                if best[end] is None or best[start] + score > best[end]:
                    best[end] = best[start] + score
                    pieces[end] = pieces[start] + 1
                    last[end] = False
                    first[end] = first[start] if start else False
            if not single and (best[end] is None or best[end - 1] + self.unknown > best[end]):
                best[end] = best[end - 1] + self.unknown
                if self.has_bytes:
                    pieces[end] = pieces[end - 1] + len(segment[end - 1].encode())
                    last[end] = False
                    first[end] = first[end - 1]
                else:
                    pieces[end] = pieces[end - 1] + (not (end > 1 and last[end - 1]))
                    last[end] = True
                    first[end] = first[end - 1] if end > 1 else True
        return pieces[n], first[n], last[n]

    def text(self, text: str) -> int:
        """The tokens of a text."""
        if not text:
            return 0
        known, total, open_unknown = self.known, 0, False
        for segment in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK)):
            found = known.get(segment)
            if found is None:
                found = self.count(segment)
                if len(segment) <= LONG:
                    if len(known) >= KEPT:
                        known.clear()
                    known[segment] = found
            total += found[0] - (open_unknown and found[1])
            open_unknown = found[2]
        return total


def counter_of(pieces: list[tuple[str, float]]) -> Counter:
    """The counter of a broadcast vocabulary, kept by the Python worker."""
    return held("pieces", pieces, lambda: Counter(pieces))


def counts(docs: DataFrame, pieces: list[tuple[str, float]], doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``' id (and ``keep``) and ``n_tokens`` of the whole text. Documents are not shuffled."""
    names = list(dict.fromkeys([doc_id, *keep]))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*(field(docs, k) for k in names), T.StructField("n_tokens", T.LongType())])
    n = len(names)

    def convert(batch: pa.RecordBatch):
        counter = counter_of(shared.value)
        return [*(batch.column(i) for i in range(n)), [counter.text(x.as_py().decode()) for x in batch.column(n)]]

    return map_rows(docs.select(*names, text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text")
