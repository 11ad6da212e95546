"""Periodic runs, substring removal and Merkle manifests against plain versions, and their answers to odd input."""

from __future__ import annotations

import binascii
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekit.llm import debruijn, merkle, periodic
from tablekit.storage import work_dir

DOCS = "doc_id long, text string, source string, runs string, kept string, tree string"
ODD = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "Ünï ſ x " * 40, "word " * 30_000, "x" * 300_000, "one two three " * 50 + "end"]


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty, long and repeated rows, and extra columns with the operators' own names."""
    rows = [(i, t, "s", "clash", "clash", "clash") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, (None, None, None, None, None, None), (None, "no id " * 30, None, None, None, None), rows[-1], rows[-1]], DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


# ------------------------------------------------------------------ periodic runs


def plain_runs(words: list, exponent: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    found: dict = {}
    for period in range(1, len(words) // exponent + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j > i and j - i + period >= max(shortest, exponent * period):
                found.setdefault((i, j - i + period), period)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_squares_are_those_of_primitive_words():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        want = set()
        for end in range(len(words)):
            for half in range(1, (end + 1) // 2 + 1):
                first = words[end - 2 * half + 1 : end - half + 1]
                primitive = not any(half % d == 0 and first[:d] * (half // d) == first for d in range(1, half))
                if primitive and first == words[end - half + 1 : end + 1]:
                    want.add((end, half))
        got = list(periodic.squares(words))
        assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize(("exponent", "shortest"), [(4, 6), (2, 2), (3, 9)])
def test_runs_against_plain_version(exponent, shortest):
    rng = random.Random(exponent)
    for _ in range(1500):
        words = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randrange(3)):
            start = rng.randrange(len(words))
            period = 1 + rng.randrange(max(1, (len(words) - start) // 3))
            for i in range(start, min(len(words), start + rng.randint(1, 60))):
                words[i] = words[start + (i - start) % period]
        assert periodic.runs_of(np.array(words), exponent, shortest) == plain_runs(words, exponent, shortest)


def test_run_in_a_long_text():
    rng = random.Random(2)
    words = [rng.randrange(500) for _ in range(30_000)]
    for i in range(12_000, 25_000):
        words[i] = words[12_000 + (i - 12_000) % 3_100]
    assert (12_000, 13_000, 3_100) in periodic.runs_of(np.array(words))


def test_periodic_odd_rows(odd):
    got = periodic.find(odd).collect()
    want = []
    for r in odd.collect():
        words = split(r.text)
        runs = plain_runs(words) if len(words) < 5_000 else [(0, len(words), 1)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((r.doc_id, runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert got[0].__fields__ == ["doc_id", "runs", "collapsed"]


def test_periodic_empty_table(empty):
    assert periodic.find(empty).count() == 0


# ------------------------------------------------------------------ substring removal


def plain_removal(rows: list[tuple], window: int) -> list[tuple]:
    """Rows (id, text) -> (id, words, removed, kept); ids that are None come last, equal ids are no earlier than each other."""
    least: dict = {}
    for i, text in rows:
        words = split(text)
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            least[key] = min(least.get(key, (True, 0)), (i is None, i or 0))
    out = []
    for i, text in rows:
        words, gone, seen = split(text), set(), set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in seen or least[key] < (i is None, i or 0):
                gone.update(range(k, k + window))
            seen.add(key)
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def removed(frame, **options) -> list[tuple]:
    return sorted((tuple(r) for r in debruijn.remove(frame, **options).collect()), key=str)


def mixed_texts(seed: int, n: int) -> list[tuple]:
    """Texts of few words with copies, edited copies, passages that many share and texts that repeat themselves."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(rng.choice([2, 12, 400]))]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 40))] for _ in range(4)]
    texts: list[list[str]] = []
    for _ in range(n):
        kind = rng.randrange(5)
        if kind == 0 and texts:
            text = list(rng.choice(texts))
        elif kind == 1 and texts:
            text = list(rng.choice(texts))
            for _ in range(rng.randint(1, 3)):
                if text:
                    at = rng.randrange(len(text))
                    text[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(3)
        elif kind == 2:
            text = [rng.choice(words) for _ in range(rng.randint(0, 12))] * rng.randint(1, 6)
        else:
            text = []
            for _ in range(rng.randint(0, 4)):
                text += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(1, 30))]
        texts.append(text)
    ids = [*range(n)]
    rng.shuffle(ids)
    return [(i, " ".join(t)) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize(("window", "gram", "hot"), [(20, 5, 1000), (6, 2, 1000), (6, 2, 3), (2, 1, 20)])
def test_removal_against_plain_version(spark, monkeypatch, window, gram, hot):
    monkeypatch.setattr(debruijn, "HOT_PLACES", hot)
    for seed in range(3):
        rows = mixed_texts(seed * 31 + window, 80)
        rows += [(None, rows[0][1]), (None, None), rows[1], (rows[2][0], rows[3][1]), (None, rows[0][1])]
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert removed(frame, window=window, gram=gram) == plain_removal(rows, window)


def test_removal_odd_rows(odd):
    assert removed(odd) == plain_removal([(r.doc_id, r.text) for r in odd.collect()], 20)


def test_removal_keeps_columns_and_empty_tables(odd, empty):
    got = debruijn.remove(odd, keep=("tree", "source"))
    assert got.columns == ["doc_id", "tree", "source", "n_words", "n_removed", "kept"] and got.count() == odd.count()
    assert debruijn.remove(empty).count() == 0


def test_texts_are_shuffled_once(spark):
    frame = spark.createDataFrame(mixed_texts(1, 60), "doc_id long, text string").repartition(3)
    frame.write.parquet(path := work_dir(spark, "texts"))
    frame = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = debruijn.remove(frame)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # joined with the kinds of their anchors, and with the spans at last
    assert any("ReusedExchange" in line and "__llm_text" in line for line in plan.splitlines()), plan


# ------------------------------------------------------------------ Merkle manifests


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes: list[str], arity: int) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The topmost node, and for each leaf the siblings left and right of it, level by level."""
    paths: list[list] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for i in range(len(nodes)):
            start = i // arity * arity
            for k in under[i]:
                paths[k].append((nodes[start:i], nodes[i + 1 : start + arity]))
        under = [sum(under[i : i + arity], []) for i in range(0, len(nodes), arity)]
        nodes = [sha("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def plain_manifest(rows: list[tuple], arity: int) -> list[tuple]:
    """Rows (id, group, text, tampered text or None) -> the manifest's rows."""

    def leaf(i, group, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, group, text)))

    groups: dict = {}
    for i, group, text, tampered in rows:
        own = leaf(i, group, text)
        groups.setdefault(group, []).append((i is not None, i or 0, own, i, own if tampered is None else leaf(i, group, tampered)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([r[2] for r in sorted(groups[g])], arity) for g in order}
    root, tops = plain_tree([trees[g][0] for g in order], arity)
    out = []
    for g, top in zip(order, tops, strict=True):
        for (_, _, own, i, claimed), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            node = claimed
            for left, right in path + top:
                node = sha("".join([*left, node, *right]))
            proof = sha("".join(h for left, right in path + top for h in left + right))
            out.append((i, g, own, trees[g][0], root, proof, node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize(("arity", "levels"), [(16, 3), (2, 2), (3, 1)])
def test_manifest_against_plain_version(spark, arity, levels):
    rng = random.Random(arity)
    rows = [(i, rng.choice([None, "", "é", "b", "hot", "hot", "hot"]), rng.choice([None, "", "Text é", "other"]), None) for i in range(120)]
    rows = [(i, g, t, t.lower() if t and i % 3 == 0 else None) for i, g, t, _ in rows]
    rows += [(None, "hot", "x", None), (None, None, None, None), rows[5], rows[5], (rows[5][0], rows[5][1], "another", None), (7_000, "alone", "t", None)]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, source string, text string, tampered string, node string, rank string").repartition(3)
    claimed = F.when(F.col("tampered").isNotNull(), merkle.leaf([F.col("doc_id"), F.col("source"), F.col("tampered")]))
    got = merkle.manifest(frame, ["doc_id", "source", "text"], "source", "doc_id", claimed, proofs=True, arity=arity, levels=levels)
    rows_got = got.collect()
    assert sorted((tuple(r)[:8] for r in rows_got), key=str) == plain_manifest(rows, arity)
    for r in rows_got:
        node = r.leaf
        for level in r.proof:
            node = sha(level.replace(":", node))
        assert node == r.root and sha("".join(r.proof).replace(":", "")) == r.proof_sha256


def test_manifest_of_odd_and_of_no_rows(spark, odd, empty):
    plain = plain_manifest([(r.doc_id, r.source, r.text, None) for r in odd.collect()], 16)
    got = merkle.manifest(odd, ["doc_id", "source", "text"], "source", "doc_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain
    assert merkle.manifest(empty, ["doc_id", "source", "text"], "source", "doc_id").count() == 0


def test_hot_group_is_cut(spark):
    """A group of all rows is worked on in superblocks: no call of the function holds more than one."""
    frame = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"))
    got = merkle.manifest(frame, ["doc_id"], "source", "doc_id", arity=4, levels=2)
    assert got.where("verified").count() == 3_000
    assert binascii.crc32(b"1") == spark.range(1).select(F.crc32(F.lit("1").cast("binary"))).first()[0]
