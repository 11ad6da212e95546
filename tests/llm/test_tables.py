"""Operators on pages and vectors, the component helper, and the pipeline."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablekit.llm import urls, vectors, warc
from tablekit.llm.components import components
from tablekit.llm.queries import RULES
from tablekit.storage import work_dir

PAGES = "page_id long, url string, html string, payload string, record_id string"


@pytest.fixture
def pages(spark):
    big = "é" * 40_000 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/3", "small"), (4, "x", "small"), (5, "x\r\ny", None), (6, "u", ""), (7, "u", "\r\n\r\n" * 400), (7, "u", big), (None, None, big), (None, None, None)]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


@pytest.mark.parametrize("chunk", [1 << 20, 1000])
def test_warc_round_trip(spark, pages, chunk):
    path = work_dir(spark, "warc-test")
    warc.write(warc.chunk_rows(warc.plan_records(pages), chunk), path)
    got = [(r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_records(spark, path).collect()]
    want = []
    for r in pages.collect():
        payload = (r.html or "").encode()
        revisit = len(payload) > 70_000 and r.page_id != 7
        want.append((None if r.page_id is None else str(r.page_id), "revisit" if revisit else "response", "7" if revisit else None, len(payload), hashlib.sha1(payload).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)
    joined: dict = {}
    for r in sorted(warc.read_chunks(spark, path).collect(), key=lambda r: r.chunk_no):
        assert len(r.chunk) <= chunk
        joined[r.record_id] = joined.get(r.record_id, b"") + bytes(r.chunk)
    assert joined["3"] == b"small" and joined["2"] == b""


def test_warc_empty(spark, pages):
    path = work_dir(spark, "warc-test")
    warc.write(warc.chunk_rows(warc.plan_records(pages.limit(0))), path)
    assert warc.read_records(spark, path).count() == 0


def test_warc_wrong_digest_is_told(spark):
    path = work_dir(spark, "warc-test")
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nWARC-Payload-Digest: sha1:00\r\nWARC-Payload-Length: 2\r\nContent-Length: 2\r\n\r\nab\r\n\r"
    spark.createDataFrame([(head,)], "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path)
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_records(spark, path).collect()


def test_url_rules_and_cascade(spark, monkeypatch):
    rows = [
        (1, "http://EXAMPLE.org/es/a"), (2, "https://m.example.org/en/12?x"), (3, "https://example.org/en/2#f"), (4, "ftp://x.com/fr/"), (5, "http://x.com/de/1"), (6, "http://x.com/de/2"),
        (7, "http://x.com/en/"), (8, "http://y.com/en/"), (9, None), (10, "no scheme"), (11, "http://"), (12, "http://notexample.org"), (13, "http://y.com?/de/"), (14, "a://b\nc.org/x://y"),
    ]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id int, url string, host string")
    want = {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"), 4: ("com/fr/", "allow"), 5: ("com/de/", "block"), 6: ("com/de/", "block"), 7: (None, "block"), 8: (None, "allow")}
    got = {r.page_id: r for r in urls.judge(frame, RULES).collect()}
    assert len(got) == len(rows)
    assert {i: (got[i].rule, got[i].verdict) for i in want} == want
    assert (got[9].host, got[9].path, got[10].host, got[12].path) == ("", "", "", "") and got[12].rule is None
    assert (got[1].host, got[13].host, got[13].path, got[14].host) == ("example.org", "y.com", "", "b\nc.org")
    assert urls.judge(frame.limit(0), RULES).count() == 0
    monkeypatch.setattr(urls, "MAX_BYTES", 0)
    assert {r.page_id: tuple(r) for r in urls.judge(frame, RULES).collect()} == {i: tuple(r) for i, r in got.items()}


def test_cascade_is_exact(spark):
    keys = spark.range(6000).select(F.concat(F.lit("host"), "id").alias("key")).union(spark.sql("select cast(null as string)"))
    listed = keys.where(F.crc32(F.col("key").cast("binary")) % 4 == 0)
    marked = urls.is_listed(keys, listed, "key")
    assert marked.where(F.col("listed")).select("key").exceptAll(listed).isEmpty()
    assert marked.where(F.col("listed")).count() == listed.count()
    assert len(urls.cascade(listed, keys, "key")) > 1


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame([*pairs, (None, 7)], "a int, b int")
    got = components(frame).collect()
    assert len(got) == len({r.node for r in got})
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {x: c for x, c in label.items() if x not in alone}
    assert components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [20_000, 25])
def test_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    draw = np.random.default_rng(4)
    base = draw.standard_normal((12, 40))
    x = np.concatenate([base[draw.integers(0, 12, 150)] + draw.standard_normal((150, 40)) * 0.3, draw.standard_normal((60, 40))])
    x[7] = x[3]
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)]
    rows += [(900, None, None), (901, [0.0] * 40, None), (902, [float("nan")] * 40, None), (903, [None] * 40, None), (904, [], None), (905, x[0].tolist()[:20], None), (None, x[0].tolist(), None), rows[3]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    got = {r.vec_id: r for r in vectors.near_duplicates(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    label = list(range(len(x)))
    for _ in range(len(x)):
        label = [min([label[i], *(label[j] for j in np.flatnonzero(linked[i]))]) for i in range(len(x))]
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (linked[i].sum(), label[i], label[i] == i)
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vectors.near_duplicates(frame).count() == len(rows)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_all_linked_in_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    n, d = 4_000, 16
    draw = np.random.default_rng(5)
    x = draw.standard_normal(d) + draw.standard_normal((n, d)) * 1e-3
    ids = draw.permutation(n)
    part = pa.table({"tile": np.zeros(n, np.int32), "upper": np.zeros(n, bool), "id": ids, "n": np.ones(n, np.int64), "vector": pa.array(x.tolist(), pa.list_(pa.float64()))})
    tracemalloc.start()
    got, count, reached = vectors._linked((d, 0, 0, 0, 0), part, 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == ids.tolist() and set(count.tolist()) == {n - 1} and set(reached) == {0}
    # its 8 million pairs alone take 128 MB
    assert peak < 100e6


def test_vectors_rows_join_over_cuts():
    draw = random.Random(6)
    for _ in range(30):
        n = draw.randint(2, 40)
        pairs = [(draw.randrange(n), draw.randrange(n)) for _ in range(draw.randint(0, 40))]
        root = np.arange(n)
        label = list(range(n))
        for at in range(0, len(pairs), 3):
            a, b = np.array(pairs[at : at + 3]).T
            root = vectors._merged(root, a, b)
            for i, j in pairs[at : at + 3]:
                label = [label[i] if v == label[j] else v for v in label]
        assert [[root[i] == root[j] for j in range(n)] for i in range(n)] == [[label[i] == label[j] for j in range(n)] for i in range(n)]


# ------------------------------------------------------------------ pipeline

SF = "/root/testdata/sf0.001"


def test_pipeline_against_plain_python(spark):
    import public_tokenizers
    import tiktoken

    from tablekit.llm import bpe, decontaminate, language, secrets
    from tests.llm.test_texts import plain_components, plain_hits

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = language.learn(docs)
    import pyarrow as pa

    rows = docs.collect()
    best, score = language.scores(pa.array([(r.text or "").encode() for r in rows], pa.binary()), learned)
    kept = [r for r, b, s in zip(rows, best, score, strict=True) if b != "und" and s >= corpus_pipeline.MIN_SCORE]
    parts = plain_components([(r.doc_id, r.text) for r in kept], 5, 80, 100)
    kept = [r for r in kept if parts[r.doc_id][1] == r.doc_id]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    automaton = decontaminate.Automaton([(i, decontaminate.WORD.findall((t or "").encode().lower())) for i, t in items], 10)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.VOCABULARY), special_tokens={})
    want = {}
    for r in kept:
        raw = (r.text or "").encode()
        words, hits, _ = plain_hits(r.text, items)
        if hits > 0.8 * words:
            continue
        spans = [{"start": a, "end": b} for a, b in automaton.match(raw)[1]]
        raw = decontaminate.without(raw, spans) if spans else raw
        text = secrets._replaced(raw, b"[SECRET]").decode()
        want[r.doc_id] = (r.lang, r.source, len(own.encode_ordinary(text)), hashlib.sha256(text.encode()).hexdigest())
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.lang, r.source, r.n_tokens, r.decoded_sha256) for r in got} == want
    assert len(got) == len(want)


def test_only_texts_like_labelled_ones_stay(spark):
    import base64

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    draw = random.Random(11)
    polish = "Wczoraj wieczorem poszliśmy nad rzekę, gdzie dzieci puszczały latawce, a starsi ludzie rozmawiali o pogodzie i zbliżających się żniwach."
    strange = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz     ", k=n)) for n in (300, 3_000)]
    strange += [base64.b64encode(draw.randbytes(n)).decode() for n in (300, 3_000)]
    strange += [polish, "Kissa istuu ikkunalla ja katselee ulos, kun lunta sataa hiljaa maahan ja lapset leikkivät pihalla iloisesti koko päivän."]
    added = spark.createDataFrame([(-1 - i, t, lang, "s", len(t)) for i, (t, lang) in enumerate(zip(strange, ["en", "en", None, "en", None, None], strict=True))], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, docs.union(added.select(*docs.columns)), "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "words without an id", "en", "s", 3), (2, "", "en", "s", 0), (3, "Twice told tale of words", "en", None, 5), (3, "Twice told tale of words", "en", None, 5), (4, "Another tale of other words", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, SF)
            assert out.schema.simpleString() == docs.schema.simpleString()
            out.count()
    assert corpus_pipeline.encode(spark, docs, SF).count() == len(rows)
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, SF).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.keep_languages(spark, docs, SF).collect()) == [0, 3, 3, 4]
