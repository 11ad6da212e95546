"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram's vector
binds its letters' vectors: each is rotated by its distance from the end and the three are
multiplied. A text's vector is the sum over all its trigrams, a language's prototype the sum
over the texts labelled with it. The prediction is the prototype with the largest cosine.

* Letters are lower-cased; all else separates words, and a word's ends count as a letter.
* A text that is null or has no letter is ``und`` with score 0, as is every text if nothing
  was learned. Of equal cosines the language first in order wins; scores lie in 0 to 1.
* Rows without label are not learned from. Repeated rows count each time. Extra columns are ignored.
* Sums are of integers, so prototypes do not depend on the order of rows.

What cosine a text must reach to be in a language depends on how many trigrams it spreads
over: ``levels`` takes it from labelled texts, each scored by prototypes it is not part of.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.packed import layout, mix
from tablekit.llm.rows import field, held, map_rows, slices, text_bytes

DIMENSIONS = 1024
SEED = 20_011
#: Prototypes go to every task: this many languages at most, 8 kB each. More raise an error.
MAX_LANGUAGES = 5_000
UNKNOWN = "und"
#: Classes of spread: class k holds texts that spread over 2 ** k trigrams or more, but not twice as many.
CLASSES = 32
#: Parts of the labelled texts; each is scored by what was learned from the others.
FOLDS = 3
#: A level is SHARE of the QUANTILE of the held-out scores of one language and spread, if there are LEAST_TEXTS of them. The
#: quantile itself would reject that part of the clean texts.
QUANTILE, SHARE, LEAST_TEXTS = 0.01, 0.5, 50
#: Unrelated sums have cosines of spread 1 / sqrt(dimensions); a level within this many of those tells nothing.
CHANCE = 4.0
#: Text worked on at a time: each byte takes some hundred while trigrams are told apart.
_SLICE_BYTES = 1 << 19
#: Trigrams whose vectors are spelled out together.
_GRAMS = 2048
#: A count costs as much to add as so many to multiply.
_SPARSE = 20


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter, and its lower-case form if that is one code point."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            letter[code] = True
            small = c.lower()
            if len(small) == 1:
                lower[code] = ord(small)
    return letter, lower


def _letters() -> tuple[np.ndarray, np.ndarray]:
    return held("letters", None, letter_tables)


def letter_bits(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """A row of bits for each code point: 1 stands for +1, 0 for -1."""
    words = dimensions // 64
    seeds = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64) + np.uint64(SEED)
    return np.unpackbits(mix(mix(seeds) * np.uint64(0xD6E8FEB86659FD93)).view(np.uint8), axis=1)


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """A row of +1 and -1 for each code point."""
    return (letter_bits(codes, dimensions).astype(np.int8) << 1) - 1


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct trigrams of texts side by side as rows of three code points, and text and trigram of each place."""
    letter, lower = _letters()
    data, bounds = layout(column)
    n = len(bounds) - 1
    # a byte between texts keeps their words apart
    joined = np.full(len(data) + n, 10, np.uint8)
    joined[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(bounds))] = data
    code = np.frombuffer(joined.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((joined & 0xC0) != 0x80)
    is_letter = letter[code]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    code = np.where(is_letter, lower[code], 0)[keep]
    place = np.flatnonzero(keep)
    text = np.searchsorted(at[place], bounds[1:-1] + np.arange(1, n), "left") if n > 1 else np.empty(0, np.int64)
    owner = np.zeros(len(code), np.int64)
    np.add.at(owner, text[text < len(code)], 1)
    owner = np.cumsum(owner)
    code = np.concatenate([[0], code, [0]])
    middle = np.flatnonzero(code[1:-1])
    alphabet, index = np.unique(code, return_inverse=True)
    size = len(alphabet)
    keys = (index[middle] * size + index[middle + 1]) * size + index[middle + 2]
    if size**3 <= 1 << 23:
        grams = np.flatnonzero(np.bincount(keys, minlength=size**3)) if len(keys) else np.empty(0, np.int64)
        number = np.zeros(size**3, np.int64)
        number[grams] = np.arange(len(grams))
        which = number[keys]
    else:
        grams, which = np.unique(keys, return_inverse=True)
    rows = np.stack([alphabet[grams // size**2], alphabet[grams // size % size], alphabet[grams % size]], axis=1)
    return rows, owner[middle], which


class Bound:
    """The bound vectors of trigrams, as bits: of three signs the product is + where the three bits' exclusive or is 1."""

    def __init__(self, rows: np.ndarray, dimensions: int):
        alphabet, index = np.unique(rows, return_inverse=True)
        self.index = index.reshape(rows.shape)
        bits = letter_bits(alphabet, dimensions)
        self.rotated = [np.packbits(np.roll(bits, shift, axis=1), axis=1) for shift in (2, 1, 0)]

    def bits(self, which) -> np.ndarray:
        first, second, third = (letters[self.index[which, k]] for k, letters in enumerate(self.rotated))
        return np.unpackbits(first ^ second ^ third, axis=1)


def text_sums(rows: np.ndarray, owner: np.ndarray, gram: np.ndarray, n: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the trigrams' vectors of each of ``n`` texts, and the sum of the squares of their counts.

    Vectors are spelled out for _GRAMS trigrams at a time, whatever the alphabet. Where texts
    share few trigrams, each text's own are added up; else counts and vectors are multiplied.
    """
    sums, squares = np.zeros((n, dimensions)), np.zeros(n)
    if n * len(rows) <= 1 << 22:
        counts = np.bincount(owner * len(rows) + gram, minlength=n * len(rows))
        pair = np.flatnonzero(counts)
        times = counts[pair]
    else:
        pair, times = np.unique(owner * len(rows) + gram, return_counts=True)
    who, what = np.divmod(pair, len(rows))
    if not len(pair):
        return sums, squares
    squares += np.bincount(who, times.astype(np.float64) ** 2, n)
    bound = Bound(rows, dimensions)
    # a sum of signs is twice the sum of the bits less the number of signs
    if n * len(rows) <= _SPARSE * len(pair):
        order = np.argsort(what, kind="stable")
        cuts = np.searchsorted(what[order], np.arange(0, len(rows) + _GRAMS, _GRAMS))
        for start, a, b in zip(range(0, len(rows), _GRAMS), cuts, cuts[1:], strict=False):
            some = order[a:b]
            block = np.zeros((n, min(_GRAMS, len(rows) - start)), np.float32)
            block[who[some], what[some] - start] = times[some]
            sums += block @ bound.bits(slice(start, start + _GRAMS)).astype(np.float32)
    else:
        for start in range(0, len(pair), _GRAMS):
            some = slice(start, start + _GRAMS)
            first = np.flatnonzero(np.diff(who[some], prepend=-1))
            bits, often = bound.bits(what[some]), times[some].max() > 1
            sums[who[some][first]] += np.add.reduceat(bits * times[some, None] if often else bits, first, axis=0, dtype=np.int64 if often else np.int32)
    sums *= 2
    sums -= np.bincount(who, times, n)[:, None]
    return sums, squares


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The prototype of each language, from all labelled rows of ``docs``.

    Each task sums its own rows, so what is shuffled is one vector per task and language.
    """
    return _learned(docs, F.lit(0), lang, text, dimensions).get(0, {})


def _learned(docs: DataFrame, fold: Column, lang: str, text: str, dimensions: int) -> dict[int, dict[str, np.ndarray]]:
    """The prototypes of each fold's labelled rows."""
    schema = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("sums", T.ArrayType(T.LongType()))])

    def run(batches):
        sums: dict[tuple[int, str], np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "__llm_text", _SLICE_BYTES):
                rows, owner, gram = trigrams(part.column("__llm_text"))
                if not len(rows):
                    continue
                names = list(zip(part.column("fold").to_pylist(), part.column("lang").to_pylist(), strict=True))
                labels = sorted(set(names))
                label_of = np.array([labels.index(x) for x in names])
                added, _ = text_sums(rows, label_of[owner], gram, len(labels), dimensions)
                for label, vector in zip(labels, added, strict=True):
                    sums[label] = sums.get(label, 0) + vector
        if sums:
            values = pa.array([v.round().astype(np.int64) for v in sums.values()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in sums], pa.int32()), pa.array([x for _, x in sums]), values], names=schema.names)

    labelled = docs.where(F.col(lang).isNotNull()).select(fold.cast("int").alias("fold"), F.col(lang).cast("string").alias("lang"), text_bytes(text).alias("__llm_text"))
    summed = labelled.mapInArrow(run, schema).select("fold", "lang", F.posexplode("sums").alias("dimension", "value"))
    summed = summed.groupBy("fold", "lang", "dimension").agg(F.sum("value").alias("value"))
    languages = summed.groupBy("fold", "lang").agg(F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("sums"))
    found: dict[int, dict[str, np.ndarray]] = {}
    for r in languages.orderBy("lang", "fold").limit(FOLDS * MAX_LANGUAGES + 1).toLocalIterator():
        found.setdefault(r.fold, {})[r.lang] = np.array([x.value for x in r.sums], np.float64)
    if len({x for part in found.values() for x in part}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return found


def learn_with_levels(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS) -> tuple[dict[str, np.ndarray], dict[tuple[str, int], float]]:
    """The prototypes of ``learn``, and for (language, class of spread) the cosine a text must reach.

    Every labelled text is scored by the prototypes of the other folds. Texts that these take
    for another language are left out. A language with few texts in a class takes the class's
    level over all languages, or that of its own nearest texts if lower; a class with few texts
    takes the level of the one before, since scores grow with the spread. Without any, or within
    CHANCE, there is no level: so short texts cannot be told from others.
    """
    fold = remainder(doc_id, FOLDS)
    parts = _learned(docs, fold, lang, text, dimensions)
    whole: dict[str, np.ndarray] = {}
    for part in parts.values():
        for label, vector in part.items():
            whole[label] = whole.get(label, 0) + vector
    others = {f: {x: v for x, total in whole.items() if (v := total - parts.get(f, {}).get(x, 0)).any()} for f in range(FOLDS)}
    shared = docs.sparkSession.sparkContext.broadcast(others)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("spread", T.IntegerType()), T.StructField("score", T.DoubleType())])

    def convert(batch: pa.RecordBatch):
        labels, spread, score = [], [], []
        for f in range(FOLDS):
            part = batch.filter(pc.equal(batch.column("fold"), f))
            best, cosine, size = scored(part.column("__llm_text"), shared.value[f])
            right = [i for i, (x, y) in enumerate(zip(best, part.column("lang").to_pylist(), strict=True)) if x == y and size[i] >= 0]
            labels += [best[i] for i in right]
            spread += size[right].tolist()
            score += cosine[right].tolist()
        return [labels, spread, score]

    labelled = docs.where(F.col(lang).isNotNull()).select(fold.cast("int").alias("fold"), F.col(lang).cast("string").alias("lang"), text_bytes(text).alias("__llm_text"))
    told = map_rows(labelled, schema, convert, "__llm_text", _SLICE_BYTES)
    low = F.percentile_approx("score", QUANTILE, 10_000)
    # a class holds twice the spread of the one before, so these are CLASSES rows a language at most; those of all languages have none
    classes = told.withColumn("lang", F.explode(F.array("lang", F.lit(None).cast("string")))).groupBy("lang", "spread").agg(F.count("*").alias("n"), low.alias("low"))
    own: dict[str | None, dict[int, tuple[int, float]]] = {}
    for r in classes.toLocalIterator():
        own.setdefault(r.lang, {})[r.spread] = (r.n, r.low * SHARE)
    pooled = {spread: level for spread, (n, level) in own.get(None, {}).items() if n >= LEAST_TEXTS}
    levels: dict[tuple[str, int], float] = {}
    for label in whole:
        texts, level = own.get(label, {}), None
        for spread in range(CLASSES):
            if texts.get(spread, (0, 0.0))[0] >= LEAST_TEXTS:
                level = texts[spread][1]
            elif spread in pooled:
                level = min([pooled[spread], *(texts[k][1] for k in sorted(texts, key=lambda k: (abs(k - spread), k))[:1])])
            if level is not None and level > CHANCE / np.sqrt(dimensions):
                levels[label, spread] = level
    return whole, levels


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``' id (and ``keep``), ``lang_pred`` and ``score``. Documents are not shuffled."""
    names = list(dict.fromkeys([doc_id, *keep]))
    schema = T.StructType([*(field(docs, k) for k in names), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(prototypes)
    n = len(names)

    def convert(batch: pa.RecordBatch):
        return [*(batch.column(i) for i in range(n)), *scores(batch.column(n), shared.value)]

    return map_rows(docs.select(*names, text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text", _SLICE_BYTES)


def scores(column: pa.Array, prototypes: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """The best language of each text and its cosine."""
    return scored(column, prototypes)[:2]


def scored(column: pa.Array, prototypes: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The best language of each text, its cosine, and the class of its spread; that is -1 where there is no letter.

    The spread is the number of equally frequent trigrams that would give a vector of the
    same length to the sum: a line told a hundred times spreads no further than once.
    """
    n = len(column)
    labels = sorted(prototypes)
    best, score, spread = [UNKNOWN] * n, np.zeros(n), np.full(n, -1, np.int64)
    if not n:
        return best, score, spread
    rows, owner, gram = trigrams(column)
    if not len(rows) or not labels:
        return best, score, spread
    unit = np.stack([prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-300) for x in labels])
    texts, squares = text_sums(rows, owner, gram, n, unit.shape[1])
    norm = np.linalg.norm(texts, axis=1)
    cosine = texts @ unit.T / np.where(norm > 0, norm, 1)[:, None]
    top = cosine.argmax(axis=1)
    total = np.bincount(owner, minlength=n)
    present = total > 0
    wide = np.floor(np.log2(np.maximum(1, total.astype(np.float64) ** 2 / np.maximum(1, squares)) + 1e-6)).astype(np.int64)
    spread = np.where(present, np.clip(wide, 0, CLASSES - 1), -1)
    for i in np.flatnonzero(present).tolist():
        best[i] = labels[top[i]]
        score[i] = min(1.0, max(0.0, cosine[i, top[i]]))
    return best, score, spread


def remainder(doc_id: str, parts: int = 3) -> Column:
    """crc32 of an id as text, modulo ``parts``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def accepted(docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float, text: str = "text", levels: dict[tuple[str, int], float] | None = None) -> DataFrame:
    """The rows of ``docs`` in a learned language: those with letters and a score of ``min_score`` and of their level or more."""
    shared = docs.sparkSession.sparkContext.broadcast((prototypes, levels or {}))
    names = docs.columns

    def convert(batch: pa.RecordBatch):
        learned, least = shared.value
        found = zip(*scored(batch.column(len(names)), learned), strict=True)
        keep = pa.array([x != UNKNOWN and s >= max(min_score, least.get((x, int(k)), 0.0)) for x, s, k in found], pa.bool_())
        return [batch.column(i).filter(keep) for i in range(len(names))]

    schema = T.StructType([field(docs, c) for c in names])
    return map_rows(docs.select(*names, text_bytes(text).alias("__llm_text")), schema, convert, "__llm_text", _SLICE_BYTES)
