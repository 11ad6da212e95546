"""URL verdicts: host and path rules, and a Bloom filter cascade for the URLs no rule fits.

The cascade holds a list of hosts exactly over all hosts of the corpus. Its first level is a
Bloom filter of the listed hosts; the second holds the unlisted hosts that the first lets
through by chance, the third the listed hosts that the second lets through, and so on until
none is left. A host is listed if the number of levels it passes in a row is odd. Because
the levels are built over every host that is asked about, the answer is exact, and no page
is joined with the list.

* A null URL or one without ``://`` has an empty host and an empty path; no rule with a host fits it.
* Hosts compare in lower-case ASCII letters; paths compare as they are, by prefix.
* Of the rules that fit, the longest (host and path together) wins; of equally long ones the
  one first in order of host, then path. Repeated rules count once.
* Null hosts are no keys. Repeated keys count once. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.storage import cut_lineage

#: All levels together; about 400 million listed hosts. A longer list is joined instead.
MAX_BYTES = 512 << 20
#: Bits per key and hash functions of a level: about 2 % of other keys pass.
BITS, HASHES = 8, 6


def host_of(url: str) -> Column:
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def apply_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``rule_verdict``; rules are tried longest first."""
    ordered = sorted(set(rules), key=lambda r: (-len(r.name), r.host, r.path, r.verdict))
    located = pages.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(ordered):
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)
        rule = F.when(fits, r.name).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return located.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _hashed(keys: DataFrame, key: str) -> DataFrame:
    return keys.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _positions(h1: np.ndarray, h2: np.ndarray, size: int, level: int) -> np.ndarray:
    """The bits of each key in a level, a row per hash function."""
    one, two = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
    steps = np.arange(1, HASHES + 1, dtype=np.uint64)[:, None]
    mixed = (one ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) + steps * two
    return ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(3)) % np.uint64(size)


def _passes(h1: np.ndarray, h2: np.ndarray, words: np.ndarray, level: int) -> np.ndarray:
    at = _positions(h1, h2, len(words) * 64, level)
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def levels_passed(h1: np.ndarray, h2: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many levels each key passes before the first it does not."""
    passed = np.zeros(len(h1), np.int64)
    live = np.arange(len(h1))
    for level, words in enumerate(levels):
        live = live[_passes(h1[live], h2[live], words, level)]
        if not len(live):
            break
        passed[live] += 1
    return passed


def _level(keys: DataFrame, count: int, level: int) -> np.ndarray:
    """The filter of a set of keys; bits meet by word, so no task holds more than its share."""
    size = max(1, -(-count * BITS // 64))

    @F.pandas_udf("array<long>")
    def bits(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(list(_positions(h1.to_numpy(), h2.to_numpy(), size * 64, level).T.astype(np.int64)))

    placed = keys.select(F.explode(bits("h1", "h2")).alias("bit"))
    set_words = placed.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    table = set_words.toArrow()
    words = np.zeros(size, np.uint64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return words


def _passed(df: DataFrame, levels: list[np.ndarray]):
    """The number of levels that a key's two hashes pass, as a column function."""
    shared = df.sparkSession.sparkContext.broadcast(levels)

    @F.pandas_udf("long")
    def passed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(levels_passed(h1.to_numpy(), h2.to_numpy(), shared.value))

    return passed


def cascade(listed: DataFrame, universe: DataFrame, key: str) -> list[np.ndarray] | None:
    """The levels over all keys of ``universe``; None if they would take more than ``MAX_BYTES``."""
    asked = _hashed(universe.select(key).distinct(), key)
    inside = _hashed(listed.select(key).distinct(), key)
    known = cut_lineage(
        asked.withColumn("listed", F.lit(False)).union(inside.withColumn("listed", F.lit(True))).groupBy("h1", "h2").agg(F.max("listed").alias("listed")), "keys"
    )
    levels: list[np.ndarray] = []
    held = 0
    while True:
        passed = _passed(known, levels)
        # those still in question: on the side the next level has to hold, let through by all before
        side = len(levels) % 2 == 0
        left = cut_lineage(known.where((F.col("listed") == side) & (passed("h1", "h2") == len(levels))).select("h1", "h2"), "level")
        count = left.count()
        if not count:
            return levels
        held += count * BITS // 8
        if held > MAX_BYTES:
            return None
        levels.append(_level(left, count, len(levels)))


def is_listed(pages: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """``pages`` with a boolean ``listed``: whether their ``key`` is in the list."""
    levels = cascade(listed, pages, key)
    if levels is None:
        marked = listed.where(F.col(key).isNotNull()).select(key).distinct().withColumn("listed", F.lit(True))
        return pages.join(marked, key, "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    passed = _passed(pages, levels)
    return pages.withColumn("listed", F.col(key).isNotNull() & (passed(F.xxhash64(key), F.xxhash64(F.lit(1), key)) % 2 == 1))


def disreputable(ruled: DataFrame) -> DataFrame:
    """Hosts on which rules block more pages than they allow."""
    sign = F.when(F.col("rule_verdict") == "block", 1).when(F.col("rule_verdict") == "allow", -1).otherwise(0)
    return ruled.groupBy("host").agg(F.sum(sign).alias("balance")).where("balance > 0").select("host")


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule``, ``verdict``.

    Where a rule fits, its verdict holds. Elsewhere a page is blocked if its host is on the
    list of hosts that rules block more often than they allow, as the cascade tells.
    """
    ruled = apply_rules(pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url")), rules, "_url").select("_id", "host", "path", "rule", "rule_verdict")
    told = is_listed(ruled, disreputable(ruled), "host")
    verdict = F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return told.select(F.col("_id").alias(page_id), "host", "path", "rule", verdict.alias("verdict"))
