"""Byte-level BPE by merge replay over the distinct words of many texts.

The pattern cuts texts into words. The distinct words that a task has not met yet stand
side by side as byte tokens, with an inverted index from a pair's rank to the places where
the pair stands. The replay takes ranks lowest first and merges the pair at all its places
in all words at once; only the neighbours of merged places get new entries. Of several
places in one word the leftmost goes first and the others are put back, because a merge can
make a pair of lower rank than its own. So every word sees its merges in the order in which
a word-by-word encoder applies them.

* Null texts are empty: no ids, no bytes. Empty texts likewise.
* Special-token strings are ordinary text. Extra columns are ignored; repeated rows give a row each.
* Words are told apart by a 64-bit hash. Decoding is compared with the text, and a text that
  differs is encoded again word by word.
* A task forgets its words' ids when it holds more than ``KEPT_IDS``. This affects time only.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablekit.llm.packed import gather, hash_spans, layout
from tablekit.llm.rows import field, held, map_rows, text_bytes

KEPT_IDS = 1_000_000
NEVER = 1 << 30

#: The characters of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
OTHER, LETTER, NUMBER, SPACE = range(4)
#: What an apostrophe is kept together with.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank a line. The vocabulary bounds its size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def character_classes() -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            kinds[code] = LETTER if kind == "L" else NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.classes = character_classes()
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for bytes {missing}")
        self.byte_token = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        self.token_bytes = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        size[[r for _, r in by_rank]] = [len(t) for t, _ in by_rank]
        self.token_size, self.token_start = size, np.cumsum(size) - size
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.empty(0, np.int32)
        self.size = np.empty(0, np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def word_starts(self, code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the pattern's matches begin in texts side by side."""
        n = len(code)
        kind = self.classes[code]
        start = np.ones(n, bool)
        start[1:] = kind[1:] != kind[:-1]
        start[bounds[bounds < n]] = True
        run = np.flatnonzero(start)
        ends = np.append(run[1:], n)
        final = np.zeros(n + 1, bool)
        final[bounds] = True
        # white space before a word: a blank goes with the word, the rest is a match of its own
        white = (kind[run] == SPACE) & ~final[ends]
        last = ends[white] - 1
        start[last] = True
        start[last[code[last] == 32] + 1] = False
        # an apostrophe and an ending that follows it
        single = (kind[run] == OTHER) & (ends - run == 1) & (code[run] == 39) & start[run] & ~final[ends]
        follower = np.flatnonzero(single) + 1
        follower = follower[kind[run[follower]] == LETTER]
        first, stop = run[follower], ends[follower]
        for ending in ENDINGS:
            fits = stop - first >= len(ending)
            for i, c in enumerate(ending):
                fits[fits] = code[first[fits] + i] == ord(c)
            at, end = first[fits], stop[fits]
            start[at] = False
            start[(at + len(ending))[at + len(ending) < end]] = True
        return np.flatnonzero(start)

    def replay(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words given as spans of bytes, one after the other, and their numbers."""
        n = int(size.sum())
        token = self.byte_token[gather(data, begin, size)]
        word = np.repeat(np.arange(len(size)), size)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        ends = np.cumsum(size)
        after[ends - 1] = -1
        before[ends - size] = -1
        rank = np.full(n, NEVER)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.rank_of(token[inner], token[inner + 1])
        alive = np.ones(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            """Put places under the ranks of the pairs that begin there."""
            at = at[rank[at] < NEVER]
            if not len(at):
                return
            order = np.argsort(rank[at], kind="stable")
            at = at[order]
            ranks = rank[at]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for a, b, r in zip(starts, [*starts[1:], len(at)], ranks[starts].tolist(), strict=True):
                if r in places:
                    places[r].append(at[a:b])
                else:
                    places[r] = [at[a:b]]
                    heapq.heappush(heap, r)

        note(inner)
        while heap:
            current = heapq.heappop(heap)
            found = places.pop(current)
            left = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            left = left[rank[left] == current]
            if not len(left):
                continue
            of = word[left]
            leftmost = np.ones(len(left), bool)
            leftmost[1:] = of[1:] != of[:-1]
            if not leftmost.all():
                places[current] = [left[~leftmost]]
                heapq.heappush(heap, current)
                left = left[leftmost]
            right = after[left]
            token[left] = current
            alive[right] = False
            rank[right] = NEVER
            follower = after[right]
            after[left] = follower
            has = follower >= 0
            before[follower[has]] = left[has]
            rank[left] = NEVER
            first = left[has]
            ahead = before[left]
            second = ahead[ahead >= 0]
            changed = np.concatenate([first, second])
            rank[changed] = self.rank_of(token[changed], token[after[changed]])
            note(changed)
        return token[alive], np.bincount(word[alive], minlength=len(size))

    def _learn(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, names: list[int]) -> None:
        if len(self.ids) > KEPT_IDS:
            self._forget()
        ids, count = self.replay(data, begin, size)
        # a word that is a token itself is that token, whatever its merges give
        several = np.flatnonzero(count > 1)
        longest = int(self.token_size.max())
        starts = np.cumsum(count) - count
        keep = np.ones(len(ids), bool)
        for w in several[size[several] <= longest].tolist():
            whole = self.ranks.get(data[begin[w] : begin[w] + size[w]].tobytes())
            if whole is not None:
                ids[starts[w]] = whole
                keep[starts[w] + 1 : starts[w] + count[w]] = False
                count[w] = 1
        self.known.update(zip(names, range(len(self.size), len(self.size) + len(names)), strict=True))
        self.ids = np.append(self.ids, ids[keep].astype(np.int32))
        self.size = np.append(self.size, count.astype(np.int32))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts side by side, and where each text's ids start and the last end."""
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        starts = self.word_starts(code, np.searchsorted(at, bounds))
        begin = at[starts]
        size = np.diff(np.append(begin, len(data)))
        which, names = pd.factorize(hash_spans(data, begin, size))
        first = np.empty(len(names), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        listed = names.tolist()
        new = [i for i, name in enumerate(listed) if name not in self.known]
        if new and len(self.ids) > KEPT_IDS:
            self._forget()
            new = list(range(len(listed)))
        if new:
            chosen = first[new]
            self._learn(data, begin[chosen], size[chosen], [listed[i] for i in new])
        index = np.array([self.known[name] for name in listed], np.int64)[which]
        count = self.size[index].astype(np.int64)
        ids = gather(self.ids, (np.cumsum(self.size, dtype=np.int64) - self.size)[index], count)
        total = np.append(0, np.cumsum(count))
        return ids, total[np.searchsorted(begin, bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids of texts side by side, and where each text's bytes start and the last end."""
        size = self.token_size[ids]
        total = np.append(0, np.cumsum(size))
        return gather(self.token_bytes, self.token_start[ids], size), total[bounds]

    def encode_checked(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and decoded bytes; two words of one hash would show in the bytes and are encoded apart."""
        ids, id_bounds = self.encode(data, bounds)
        back, back_bounds = self.decode(ids, id_bounds)
        if len(back) == len(data) and (back == data).all():
            return ids, id_bounds, back, back_bounds
        parts = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            self._forget()
            parts.append(self.encode(data[a:b], np.array([0, b - a]))[0])
        id_bounds = np.append(0, np.cumsum([len(p) for p in parts]))
        ids = np.concatenate(parts)
        return ids, id_bounds, *self.decode(ids, id_bounds)


def encoder_of(ranks: dict[bytes, int]) -> Encoder:
    """The encoder of a broadcast vocabulary, kept by the Python worker."""
    return held("bpe", ranks, lambda: Encoder(ranks))


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``' id (and ``keep``), ``ids`` (array of int) of the whole text. Documents are not shuffled."""
    return _mapped(docs, vocabulary, doc_id, text, keep, [T.StructField("ids", T.ArrayType(T.IntegerType()))], _ids)


def _ids(encoder: Encoder, column: pa.Array):
    ids, bounds, _, _ = encoder.encode_checked(*layout(column))
    return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]


def decode(encoded: DataFrame, vocabulary: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Ids back to ``doc_id`` and ``bytes``; null ids are empty."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = T.StructType([field(encoded, doc_id), T.StructField("bytes", T.BinaryType())])

    def run(batches):
        back = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            texts = [b"".join([back[i] for i in x or ()]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=[doc_id, "bytes"])

    return encoded.select(doc_id, ids).mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``n_tokens`` and the SHA-256 of a text's ids (little-endian unsigned 32 bits) and of the bytes decoded from them."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _mapped(docs, vocabulary, doc_id, text, keep, fields, _digests)


def _digests(encoder: Encoder, column: pa.Array):
    ids, bounds, back, back_bounds = encoder.encode_checked(*layout(column))
    stored = memoryview(ids.astype("<u4").tobytes())
    decoded = memoryview(back.tobytes())
    return [
        np.diff(bounds),
        [hashlib.sha256(stored[4 * a : 4 * b]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)],
        [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(back_bounds, back_bounds[1:], strict=False)],
    ]


def _mapped(docs: DataFrame, vocabulary: str, doc_id: str, text: str, keep: tuple[str, ...], fields: list[T.StructField], compute) -> DataFrame:
    names = list(dict.fromkeys([doc_id, *keep]))
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = T.StructType([*(field(docs, k) for k in names), *fields])
    n = len(names)

    def convert(batch: pa.RecordBatch):
        return [*(batch.column(i) for i in range(n)), *compute(encoder_of(shared.value), batch.column(n))]

    return map_rows(docs.select(*names, text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text")
