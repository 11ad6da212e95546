"""Window operators on keys that are cut into slices, against plain Python."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablekit.operators import events, join, scd, windows
from tablekit.operators.slices import SLICE, slice_hot_keys

DDL = "k STRING, ts TIMESTAMP_NTZ, name STRING, v DOUBLE, id BIGINT"
START = datetime(2024, 1, 1)


def make_rows(seed: int = 5, n: int = 600):
    """A third of the rows on one key, NULL keys and values, ties in time."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else r.choice(["a", "b", None, *[f"k{j}" for j in range(40)]])
        ts = None if r.random() < 0.02 else START + timedelta(minutes=r.randrange(120), microseconds=r.randrange(3))
        name = r.choice(["x", "xylophone-1", "xylophone-2", "é", None])
        v = None if r.random() < 0.1 else float(r.randrange(50))
        out.append((k, ts, name, v, i))
    return out


@pytest.fixture
def table(spark):
    return spark.createDataFrame(make_rows(), DDL).repartition(5)


def in_order(rows, fields, descending=()):
    """Rows per key, sorted as Spark sorts: NULL is smallest."""
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    for group in groups.values():
        for f in reversed(fields):
            group.sort(key=lambda x, f=f: (x[f] is not None, x[f] if x[f] is not None else 0), reverse=f in descending)
    return groups


def result(df, *cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize(
    "order", [["ts", "id"], ["-ts", "id"], ["v", "-id"], ["-v", "id"], ["id"], ["-id"], ["name", "id"], ["-name", "id"]]
)
def test_row_number_equals_plain_sort(table, cut_small, order):
    place = {"k": 0, "ts": 1, "name": 2, "v": 3, "id": 4}
    fields = [place[o.removeprefix("-")] for o in order]
    down = {place[o[1:]] for o in order if o.startswith("-")}
    want = {}
    for group in in_order(make_rows(), fields, down).values():
        want.update({row[4]: (i,) for i, row in enumerate(group, start=1)})
    assert result(windows.row_number(table, ["k"], order), "row_number") == want


def test_only_hot_keys_are_cut_and_no_slice_is_large(table, cut_small):
    sliced = slice_hot_keys(table, ["k"], ["ts", "id"])
    assert sliced.split
    sizes = {(r["k"], r[SLICE]): r["count"] for r in sliced.df.groupBy("k", SLICE).count().collect()}
    assert {k for (k, s) in sizes if s == -1}.isdisjoint({"hot"})
    hot = [n for (k, s), n in sizes.items() if k == "hot"]
    assert len(hot) >= 4 and max(hot) < 100 and sum(hot) == 200


def test_small_tables_are_not_cut(table):
    assert not slice_hot_keys(table, ["k"], ["ts"]).split


@pytest.mark.parametrize("order", [["ts"], ["-v"]])
def test_ranks_with_ties(spark, table, cut_small, order):
    got_rank = result(windows.rank(table, ["k"], order), "rank")
    got_dense = result(windows.dense_rank(table, ["k"], order), "dense_rank")
    table.createOrReplaceTempView("ranked")
    by = order[0].removeprefix("-") + (" desc" if order[0].startswith("-") else "")
    plain = spark.sql(
        f"select id, cast(rank() over (partition by k order by {by}) as bigint) as r, "
        f"cast(dense_rank() over (partition by k order by {by}) as bigint) as d from ranked"
    )
    assert got_rank == result(plain, "r")
    assert got_dense == result(plain, "d")


@pytest.mark.parametrize("reach", [1, 3])
def test_lag_and_lead_cross_the_cuts(table, cut_small, reach):
    got = result(windows.lag_lead(table, ["k"], ["ts", "id"], {"p": ("v", reach)}, {"f": ("id", 1)}), "p", "f")
    want = {}
    for group in in_order(make_rows(), [1, 4]).values():
        for i, row in enumerate(group):
            before = group[i - reach][3] if i >= reach else None
            after = group[i + 1][4] if i + 1 < len(group) else None
            want[row[4]] = (before, after)
    assert got == want


@pytest.mark.parametrize("rows", [True, False])
def test_running_aggregates(spark, table, cut_small, rows):
    aggs = {"s": ("sum", "v"), "n": ("count", "v"), "hi": ("max", "v"), "lo": ("min", "v")}
    order = ["ts", "id"] if rows else ["ts"]
    got = result(windows.running(table, ["k"], order, aggs, rows=rows), "s", "n", "hi", "lo")
    table.createOrReplaceTempView("summed")
    frame = "rows between unbounded preceding and current row" if rows else ""
    over = f"over (partition by k order by {', '.join(order)} {frame})"
    plain = spark.sql(f"select id, sum(v) {over} s, count(v) {over} n, max(v) {over} hi, min(v) {over} lo from summed")
    assert got == result(plain, "s", "n", "hi", "lo")


def test_running_last(table, cut_small):
    got = result(windows.running(table, ["k"], ["ts", "id"], {"seen": ("last", "v")}, rows=True), "seen")
    want = {}
    for group in in_order(make_rows(), [1, 4]).values():
        seen = None
        for row in group:
            seen = row[3] if row[3] is not None else seen
            want[row[4]] = (seen,)
    assert got == want


def test_dense_key_numbers_a_large_table(table, cut_small):
    got = sorted((r["id"], r["key"]) for r in windows.dense_key(table, ["id"]).collect())
    assert got == [(i, i + 1) for i in range(600)]


def test_streaks(table, cut_small):
    got = result(windows.streak_batch(table, ["k"], ["ts", "id"], "v > 15"), "streak")
    want = {}
    for group in in_order(make_rows(), [1, 4]).values():
        run = 0
        for row in group:
            run = run + 1 if row[3] is not None and row[3] > 15 else 0
            want[row[4]] = (run,)
    assert got == want


def test_type2_collapses_repeats(table, cut_small):
    timed = table.filter(F.col("ts").isNotNull())
    got = {
        (r["k"], r["valid_from"], r["name"], r["valid_to"], r["is_current"])
        for r in scd.type2_from_changes(timed, ["k"], ["ts", "id"], ["name"]).collect()
    }
    want = set()
    for k, group in in_order([r for r in make_rows() if r[1]], [1, 4]).items():
        starts = [r for i, r in enumerate(group) if i == 0 or r[2] != group[i - 1][2]]
        for i, r in enumerate(starts):
            until = starts[i + 1][1] if i + 1 < len(starts) else None
            want.add((k, r[1], r[2], until, until is None))
    assert got == want


def test_point_in_time_on_a_hot_key(spark, cut_small):
    r = random.Random(3)
    facts = [("hot" if i % 3 else f"k{i % 7}", START + timedelta(minutes=r.randrange(500)), i) for i in range(300)]
    versions = []
    for k in ["hot", *[f"k{i}" for i in range(5)]]:
        at = START + timedelta(minutes=20)
        for n in range(40):
            until = at + timedelta(minutes=r.randrange(1, 20))
            versions.append((k, at, until, n))
            at = until + timedelta(minutes=r.choice([0, 0, 5]))
    f = spark.createDataFrame(facts, "k STRING, ts TIMESTAMP_NTZ, id BIGINT")
    d = spark.createDataFrame(versions, "k STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, n INT")
    got = sorted((x["id"], x["n"]) for x in join.point_in_time(f, d, ["k"], "ts").collect())
    want = sorted((i, n) for k, ts, i in facts for kk, a, b, n in versions if k == kk and a <= ts < b)
    assert got == want
    assert join.point_in_time(f, d, ["k"], "ts", how="left").count() == len(facts)


def test_retention_by_bytes(table, cut_small):
    sized = table.filter(F.col("ts").isNotNull()).withColumn("size", F.lit(7))
    kept = events.retain(sized, "ts", max_bytes=100, partition=["k"], order=["ts", "id"], size="size")
    want = set()
    for group in in_order([r for r in make_rows() if r[1]], [1, 4]).values():
        want |= {r[4] for r in group[-(100 // 7):]}
    assert {r["id"] for r in kept.collect()} == want


def test_pages_by_number_and_by_last_key(table, cut_small):
    from tablekit.operators import order

    want = list(range(175, 200))
    assert sorted(r["id"] for r in order.page(table, ["id"], 25, 7).collect()) == want
    assert [r["id"] for r in order.page_after(table, ["id"], 25, {"id": 174}).collect()] == want
    assert [r["id"] for r in order.page_after(table, ["id"], 3).collect()] == [0, 1, 2]
    by_two = [(r["v"], r["id"]) for r in table.filter("v is not null").orderBy(F.desc("v"), "id").collect()]
    after = dict(zip(["v", "id"], by_two[40], strict=True))
    assert [(r["v"], r["id"]) for r in order.page_after(table, ["-v", "id"], 10, after).collect()] == by_two[41:51]


@pytest.mark.parametrize("order", [["-u", "id"], ["u", "-id"], ["-b", "-u"]])
def test_slices_follow_whole_values(spark, cut_small, order):
    rows = [("hot", f"https://example.org/a/long/path/{i:05d}", bytes([i % 7]), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k STRING, u STRING, b BINARY, id BIGINT").repartition(4)
    sizes = [r["count"] for r in slice_hot_keys(df, ["k"], order).df.groupBy(SLICE).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 100 and len(sizes) > 20
    got = result(windows.row_number(df, ["k"], order), "row_number")
    down = {n[1:]: True for n in order if n.startswith("-")}
    ranked = sorted(rows, key=lambda r: r[3], reverse="id" in down)
    place = {"u": 1, "b": 2, "id": 3}
    for name in reversed(order):
        plain = name.removeprefix("-")
        ranked.sort(key=lambda r, c=place[plain]: r[c], reverse=plain in down)
    assert got == {r[3]: (i,) for i, r in enumerate(ranked, 1)}


def test_many_hot_keys_and_those_just_over_the_limit(spark, cut_small):
    df = spark.range(1500 * 30).select((F.col("id") % 1500).alias("k"), "id")
    sizes = slice_hot_keys(df, ["k"], ["id"]).df.groupBy("k", SLICE).count()
    worst = sizes.agg(F.max("count"), F.count("*"), F.min(SLICE)).first()
    assert worst[0] < 30 and worst[1] >= 2800 and worst[2] == 0


def test_more_cuts_than_one_level_of_the_tree(spark, cut_small):
    df = spark.range(6000).select(F.lit("one").alias("k"), "id").repartition(3)
    sliced = slice_hot_keys(df, ["k"], ["id"])
    assert sliced.df.select(SLICE).distinct().count() > 200
    numbered = windows.row_number(df, ["k"], ["id"])
    assert numbered.filter(F.col("row_number") != F.col("id") + 1).isEmpty()
