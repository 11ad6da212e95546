"""Cases in which an operator once gave a wrong answer."""

from __future__ import annotations

import math
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import QUERIES, s01_sources, s12_plans
from checks.registry import BASE, Tables
from checks.stand_ins import STAND_INS
from tablekit.functions.exprs import exact_mean, exact_sum, stable_round
from tablekit.operators import join, layout, merge, order, quality, windows
from tablekit.sources import streamio
from tablekit.streaming import stream
from tablekit.streaming.batches import BatchTable

START = datetime(2024, 1, 1)


def at(minutes: int) -> datetime:
    return START + timedelta(minutes=minutes)


def test_a_removed_key_stays_removed(spark, tmp_path):
    schema = spark.createDataFrame([], "k INT, v INT").schema
    state = BatchTable(str(tmp_path / "state"), ["k"], schema, compact_every=2)
    state.apply(spark.createDataFrame([(i, i) for i in range(6)], schema), 0, lambda old, new: merge.upsert(old, new, ["k"]))
    for _ in range(2):  # delivered twice
        state.apply(spark.createDataFrame([(i, 0) for i in range(6)], schema), 1, lambda old, new: old.join(new.select("k"), "k", "left_anti"))
        assert state.read(spark).count() == 0
    for _ in range(2):
        state.apply(spark.createDataFrame([(9, 9)], schema), 2, lambda old, new: merge.upsert(old, new, ["k"]))
        assert [tuple(r) for r in state.read(spark).collect()] == [(9, 9)]
    assert (tmp_path / "state" / "state=1").exists() and not (tmp_path / "state" / "batch=1").exists()


def test_a_batch_that_is_not_finished_is_not_seen(spark, tmp_path):
    schema = spark.createDataFrame([], "k INT, v INT").schema
    state = BatchTable(str(tmp_path / "state"), ["k"], schema)
    add = lambda old, new: merge.upsert(old, new, ["k"])
    state.apply(spark.createDataFrame([(1, 1), (2, 1), (None, 1)], schema), 0, add)
    state.apply(spark.createDataFrame([(1, 2), (3, 2)], schema), 1, add)
    (tmp_path / "state" / "batch=1" / "_SUCCESS").unlink()
    assert sorted(map(str, state.read(spark).collect())) == sorted(map(str, spark.createDataFrame([(1, 1), (2, 1), (None, 1)], schema).collect()))
    state.apply(spark.createDataFrame([(1, 2), (3, 2)], schema), 1, add)
    assert {r["k"]: r["v"] for r in state.read(spark).collect()} == {1: 2, 2: 1, 3: 2, None: 1}
    # the state before a batch does not depend on it
    assert {r["k"]: r["v"] for r in state.read(spark, below=1).collect()} == {1: 1, 2: 1, None: 1}


def test_a_stream_joins_an_aggregated_table_in_append_mode(spark):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).load()
    table = spark.range(9).groupBy((F.col("id") % 3).alias("value")).agg(F.count("*").alias("n"))
    stream.check_output_mode(stream.enrich_static(rate, table, ["value"]), "append")
    with pytest.raises(ValueError, match="watermark"):
        stream.check_output_mode(rate.groupBy("value").count(), "append")
    with pytest.raises(ValueError, match="aggregate"):
        stream.check_output_mode(stream.enrich_static(rate, table, ["value"]), "complete")


@pytest.mark.parametrize("turned", [False, True])
def test_versions_of_no_length_hide_nothing(spark, turned):
    versions = [("a", at(0), at(0), 1), ("a", at(0), None, 2)]
    dim = spark.createDataFrame(versions[::-1] if turned else versions, "k STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, n INT")
    fact = spark.createDataFrame([("a", at(5))], "k STRING, ts TIMESTAMP_NTZ")
    assert [r["n"] for r in join.point_in_time(fact, dim, ["k"], "ts").collect()] == [2]


@pytest.mark.parametrize("how", ["right", "full", "outer"])
def test_interval_join_refuses_what_it_would_double(spark, how):
    a = spark.createDataFrame([("a", at(0))], "k STRING, t TIMESTAMP_NTZ")
    with pytest.raises(ValueError, match="only inner, left"):
        join.interval(a, a.withColumnRenamed("t", "u"), ["k"], "t", "u", 60, how=how)


def test_upsert_takes_one_source_row_per_key(spark):
    target = spark.createDataFrame([(1, 0), (2, 0)], "k INT, v INT")
    source = spark.createDataFrame([(1, 5), (1, 7), (3, 1)], "k INT, v INT")
    assert sorted(tuple(r) for r in merge.upsert(target, source, ["k"]).collect()) == [(1, 7), (2, 0), (3, 1)]


def test_run_log_opens_a_table_once(spark):
    schema = "table_name STRING, status STRING, logged_at TIMESTAMP_NTZ, seq BIGINT"
    log = spark.createDataFrame([("done", "DONE", at(0), 1), ("failed", "FAILED", at(0), 2), ("open", "IN_PROGRESS", at(0), 3)], schema)
    fresh = [(t, "PENDING", at(m), 10 * m + i) for i, t in enumerate(["done", "failed", "open", "new"]) for m in (1, 2)]
    out = quality.run_log(log, spark.createDataFrame([*fresh, ("open", "DONE", at(3), 90)], schema))
    assert sorted((r["table_name"], r["status"], r["seq"]) for r in out.filter("seq >= 10").collect()) == [("failed", "PENDING", 11), ("new", "PENDING", 13), ("open", "DONE", 90)]
    again = quality.run_log(log, spark.createDataFrame(fresh[:2], schema), blocking=("PENDING", "IN_PROGRESS"))
    assert again.filter("table_name = 'done'").count() == 2


def test_rounding_rounds_once(spark):
    row = spark.range(1).select(*(stable_round(F.lit(x), d).alias(f"c{i}") for i, (x, d) in enumerate([(2.4999996, 0), (2.5, 0), (2.675, 2)]))).first()
    assert tuple(row) == (2.0, 3.0, 2.68)


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 12) for _ in range(4_000)] + [0.1] * 50 + [1e300, -1e300, None]
    small = [v for v in values if v is not None and abs(v) < 1e100]
    sums = set()
    for _ in range(3):
        rng.shuffle(values)
        rng.shuffle(small)
        frame = spark.createDataFrame([(v,) for v in small], "v DOUBLE").repartition(5)
        sums.add(tuple(frame.agg(exact_sum("v"), exact_mean("v")).first()))
    assert len(sums) == 1
    total, mean = sums.pop()
    assert total == pytest.approx(math.fsum(small), rel=1e-15) and mean == total / len(small)
    frame = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert frame.agg(exact_sum("v")).first()[0] == pytest.approx(math.fsum(small))
    assert math.isnan(frame.agg(exact_sum(F.when(F.col("v") == 0.1, float("nan")).otherwise(F.col("v")))).first()[0])
    assert frame.limit(0).agg(exact_sum("v"), exact_mean("v")).first() == (None, None)


@pytest.mark.parametrize("timeout", ["none", "event"])
def test_streak_takes_late_rows(spark, tmp_path, timeout):
    schema = "k STRING, ts TIMESTAMP, v INT"
    batches = [
        [("a", at(10), 9), ("a", at(20), 9), ("b", at(20), 9)],
        [("a", at(5), 0), ("a", at(15), 9), ("b", at(25), 9)],  # a late row longer, and a break before the streak
        [("a", at(12), 0), ("b", at(10), 0)],  # breaks in the middle and before
        [("a", at(30), 9), ("b", at(30), 0), ("b", at(40), 9)],
        [("b", at(35), 9)],
    ]
    source = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stored = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    feed = stream.with_event_time(stored, "ts", delay="1 hour") if timeout == "event" else stored
    seen: list[dict] = []
    query = (
        stream.streak(feed, "k", ["ts"], "v > 5", 86_400_000, timeout)
        .writeStream.foreachBatch(lambda df, _: seen.append({r["k"]: r["streak"] for r in df.collect()}))
        .outputMode("update").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [x for x in seen if x] == [{"a": 2, "b": 1}, {"a": 3, "b": 2}, {"a": 2, "b": 2}, {"a": 3, "b": 1}, {"b": 2}]


def test_pages_and_stored_starts(spark):
    df = spark.range(95).select((F.col("id") * 7 % 95).alias("k"), F.col("id").alias("v")).repartition(4)
    want = [list(range(i, min(i + 10, 95))) for i in range(0, 95, 10)] + [[]]
    starts = order.page_starts(df, ["k"], 10)
    for number, keys in enumerate(want):
        assert [r["k"] for r in order.page(df, ["k"], 10, number).collect()] == keys
        assert [r["k"] for r in order.page_from(df, starts, ["k"], 10, number).collect()] == keys
    assert "TakeOrderedAndProject" in order.page(df, ["k"], 10, 3)._jdf.queryExecution().executedPlan().toString()


def test_equal_tables_reconcile_without_moving_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5_000).select((F.col("id") % 3_000).alias("k"), F.lit("x").alias("v")).write.parquet(path)
    table = spark.read.parquet(path)
    same = quality.reconcile(table, table.repartition(3), ["k"], 64)
    assert tuple(same.first()) == (5_000, 5_000, 0, 0)
    assert "xxhash64" not in same._jdf.queryExecution().executedPlan().toString()
    other = table.filter("k <> 7").union(spark.createDataFrame([(9_000, "x"), (None, "x")], "k LONG, v STRING"))
    rows = table.filter("k <> 7").count() + 2
    assert tuple(quality.reconcile(table, other, ["k"], 64).first()) == (5_000, rows, 1, 2)
    assert tuple(quality.reconcile(table.limit(0), table.limit(0), ["k"]).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_dense_steps_of_an_interval_join_are_cut(spark, how):
    a = [("hot", at(0) if i % 2 else at(i % 50), i) for i in range(90)] + [("cold", at(3), 90), (None, at(3), 91), ("alone", at(1), 92)]
    b = [("hot", at(i % 60), i) for i in range(70)] + [("cold", at(4), 70), (None, at(3), 71)]
    left = spark.createDataFrame(a, "k STRING, x TIMESTAMP_NTZ, i INT")
    right = spark.createDataFrame(b, "k STRING, y TIMESTAMP_NTZ, j INT")
    plain = sorted(map(str, join.interval(left, right, ["k"], "x", "y", 3_600, how).collect()))
    spark.conf.set(join.PAIRS_CONF, "500")
    try:
        cut = join.interval(left, right, ["k"], "x", "y", 3_600, how)
        assert sorted(map(str, cut.collect())) == plain
        assert "__part" in cut._jdf.queryExecution().optimizedPlan().toString() and cut.columns == join.interval(left, right, ["k"], "x", "y", 3_600, how).columns
    finally:
        spark.conf.unset(join.PAIRS_CONF)


def test_ties_of_a_hot_key_meet_in_no_task(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") % 3).alias("v"), F.col("id").alias("n")).repartition(8).write.parquet(path)
    table = spark.read.parquet(path)
    settings = {"tablekit.rowsPerSlice": "1000", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        ranked = windows.rank(table, ["k"], ["v"])
        sizes = ranked.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        counts = {r["rank"]: r["count"] for r in ranked.groupBy("rank").count().collect()}
        totals = {r["v"]: r["s"] for r in windows.running_total(table, ["k"], ["v"], "n", "s").select("v", "s").distinct().collect()}
        dense = {r["v"]: r["dense_rank"] for r in windows.dense_rank(table, ["k"], ["v"]).select("v", "dense_rank").distinct().collect()}
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert counts == {1: 6_667, 6_668: 6_667, 13_335: 6_666} and dense == {0: 1, 1: 2, 2: 3}
    assert totals[2] == 20_000 * 19_999 // 2
    # no window runs over the rows: a value's 6,667 rows are dealt to several tasks
    assert sizes < 6_667


def test_clustering_plans_at_real_sizes(spark):
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_000).alias("n"), F.concat(F.lit("key"), F.col("id") % 5_000).alias("s"), F.lit(None).cast("double").alias("x"))
    start = time.perf_counter()
    text = layout.cluster(df, ["n"], 2_000)._jdf.queryExecution().optimizedPlan().toString()
    assert time.perf_counter() - start < 20 and text.count("kll_sketch_agg") == 1
    for columns in (["n"], ["s"], ["s", "n", "x"]):
        ranges = layout.cluster(df, columns, 16).groupBy(F.spark_partition_id()).agg(F.min(columns[0]).alias("lo"), F.max(columns[0]).alias("hi"), F.count("*").alias("rows")).collect()
        assert sum(r["rows"] for r in ranges) == 60_000 and max(r["rows"] for r in ranges) < 12_000
        value = 30_000 if columns[0] == "n" else "key2500"
        assert sum(r["lo"] <= value <= r["hi"] for r in ranges) <= (2 if len(columns) == 1 else 10)


def test_progress_is_kept_in_a_table(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "in"))
    log = stream.ProgressLog(spark, str(tmp_path / "log")).attach()
    try:
        feed = streamio.read_files(spark, str(tmp_path / "in"), "id LONG", max_files=1)
        query = stream.drain(stream.start(feed, str(tmp_path / "out"), "append", str(tmp_path / "c")))
        assert log.wait(query)
    finally:
        log.detach()
    seen = log.read().filter(F.col("run_id") == str(query.runId))
    assert seen.agg(F.sum("input_rows")).first()[0] == 30 and seen.filter("input_rows > 0").count() == 3
    assert stream.progress(query).columns == seen.columns


def test_continuous_trigger_on_the_rate_source(spark, tmp_path):
    rate = streamio.read_rate(spark, 20, partitions=2)
    query = (
        rate.writeStream.format("memory").queryName("continuous_rows").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**stream.trigger("continuous", "500 milliseconds")).start()
    )
    try:
        for _ in range(60):
            query.awaitTermination(0.5)
            if spark.table("continuous_rows").count() >= 40:
                break
    finally:
        query.stop()
    rows = spark.table("continuous_rows").collect()
    values = sorted(r["value"] for r in rows)
    assert len(values) >= 40 and len(set(values)) == len(values) and {r["label"] for r in rows} == {str(v) for v in values}


def test_a_running_ingest_widens_its_table(spark, tmp_path):
    source, table, ckpt = (str(tmp_path / n) for n in ("in", "table", "c"))

    def land(*lines):
        spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.mode("append").text(source)
        stream.drain(streamio.ingest(spark, source, table, "id LONG", ckpt))
        return sorted((tuple(r) for r in streamio.read_ingested(spark, table).collect()), key=str)

    assert land('{"id":1}', "no json") == [(1, None), (None, None)]
    assert land('{"id":2,"n":5,"s":null}', '{"id":"x","n":6}')[:2] == [(1, None, None, None), (2, None, 5, None)]
    assert streamio.read_ingested(spark, table).dtypes == [("id", "bigint"), ("_rescued_data", "string"), ("n", "bigint"), ("s", "string")]
    assert ('{"n":"many"}') in {r["_rescued_data"] for r in spark.createDataFrame(land('{"id":3,"n":"many"}'), "id LONG, _rescued_data STRING, n LONG, s STRING").collect()}
    with pytest.raises(Exception, match="unexpected fields: n"):
        stream.drain(streamio.ingest(spark, source, str(tmp_path / "strict"), "id LONG", str(tmp_path / "c2"), mode=streamio.FAIL))


@pytest.mark.parametrize("name", list(STAND_INS))
def test_a_stand_in_brings_its_own_tables(spark, name):
    alone = spark.newSession()
    assert getattr(Tables(alone, "/root/testdata/sf0.001"), name).columns
    # views of an earlier call, over other tables, are replaced
    for table in BASE:
        spark.range(0).createOrReplaceTempView(table)
    try:
        assert not getattr(Tables(spark, "/root/testdata/sf0.001"), name).isEmpty()
    finally:
        for table in BASE:
            spark.catalog.dropTempView(table)


SHARED_STEP = [
    "s12_05_webchecks_errors",
    "s12_05_webchecks_latest",
    "s12_05_webchecks_slowest",
    "s12_05_webchecks_response_times",
    "s12_05_webchecks_total",
    "s02_10_drop_null_rows",
    "s10_05_row_transform",
    "s12_05_webchecks_by_bucket",
]


@pytest.mark.parametrize("key", SHARED_STEP)
def test_a_query_on_stand_ins_shares_no_views_with_its_session(spark, monkeypatch, key):
    want = sorted(map(str, QUERIES[key](spark, "/root/testdata/sf0.001").collect()))
    mine = spark.newSession()
    mine.range(3).createOrReplaceTempView("events")
    assert sorted(map(str, QUERIES[key](mine, "/root/testdata/sf0.001").collect())) == want
    assert [t.name for t in mine.catalog.listTables()] == ["events"] and mine.table("events").columns == ["id"]
    plain = type(spark).sql

    def late(session, *args, **kwargs):
        # a call in another thread, over other tables, comes in between
        for table in ("events", "pages"):
            session.read.parquet(f"/root/testdata/sf0.01/{table}.parquet").createOrReplaceTempView(table)
        return plain(session, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", late)
    assert sorted(map(str, QUERIES[key](mine, "/root/testdata/sf0.001").collect())) == want


def test_a_table_larger_than_the_target_is_compacted_into_several_files(spark, monkeypatch):
    target = 40_000
    monkeypatch.setattr(layout, "TARGET_FILE_BYTES", target)
    monkeypatch.setattr(layout.compact, "__defaults__", (target, None))
    lines = QUERIES["s14_05_compact"](spark, "/root/testdata/sf0.001")
    assert lines.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert len(lines.inputFiles()) > 1


def test_larger_tables_land_in_more_files_and_as_many_batches(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(s01_sources, "LANDING_BYTES", 4_000, raising=False)
    t = Tables(spark, "/root/testdata/sf0.001")
    twice = t.orders.union(t.orders)
    path = s01_sources.landed(t, twice)
    files = len(spark.read.parquet(path).inputFiles())
    assert files > 4 and files % 4 == 0
    feed = streamio.read_files(spark, path, twice.schema, max_files=s01_sources.spread(twice))
    query = stream.drain(stream.start(feed, str(tmp_path / "out"), "append", str(tmp_path / "c")))
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 4
    assert spark.read.parquet(str(tmp_path / "out")).count() == twice.count()


def test_streaks_of_many_keys_share_state_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    keys = [None, *range(2**60, 2**60 + 300)]
    for batch in range(3):
        rows = [(k, at(100 * batch + i), (n + batch + i) % 5) for n, k in enumerate(keys) for i in range(3) if batch != 1 or n % 2]
        spark.createDataFrame(rows, "k LONG, ts TIMESTAMP, v INT").coalesce(1).write.mode("append").parquet(source)
    feed = stream.with_event_time(streamio.read_files(spark, source, "k LONG, ts TIMESTAMP, v INT", max_files=1), "ts", delay="1 hour")
    seen: list[dict] = []
    streaks = stream.streak(feed, "k", ["ts"], "v > 0", 86_400_000, "event", buckets=4)
    query = stream.drain(stream.start(streaks, lambda df, _: seen.append({r["k"]: r["streak"] for r in df.collect()}), "update", str(tmp_path / "c")))
    want: list[dict] = []
    length = dict.fromkeys(keys, 0)
    for batch in range(3):
        of_batch = [(n, k) for n, k in enumerate(keys) if batch != 1 or n % 2]
        for n, k in of_batch:
            for i in range(3):
                length[k] = length[k] + 1 if (n + batch + i) % 5 else 0
        want.append({k: length[k] for _, k in of_batch})
    assert [x for x in seen if x] == want
    assert max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators) <= 4


def test_idle_keys_of_a_shared_state_row_are_dropped_alone(spark, tmp_path):
    source = str(tmp_path / "in")
    hour = 60
    batches = [[("idle", at(0), 9), ("on", at(0), 9)], [("on", at(5 * hour), 9)], [("on", at(12 * hour), 9)], [("on", at(13 * hour), 9)], [("idle", at(13 * hour), 9)]]
    for rows in batches:
        spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, v INT").coalesce(1).write.mode("append").parquet(source)
    feed = stream.with_event_time(streamio.read_files(spark, source, "k STRING, ts TIMESTAMP, v INT", max_files=1), "ts", delay="1 hour")
    seen: list[dict] = []
    streaks = stream.streak(feed, "k", ["ts"], "v > 0", 8 * 3_600_000, "event", buckets=1)
    stream.drain(stream.start(streaks, lambda df, _: seen.append({r["k"]: r["streak"] for r in df.collect()}), "update", str(tmp_path / "c")))
    assert [x for x in seen if x] == [{"idle": 1, "on": 1}, {"on": 2}, {"on": 3}, {"on": 4}, {"idle": 1}]


@pytest.mark.parametrize("kind, values", [
    ("TIMESTAMP", "timestamp '2024-10-27 00:30:00Z', timestamp '2024-10-27 01:30:00.000001Z'"), ("DOUBLE", "0.1, double('-0.0')"), ("BINARY", "x'ff00', x''"),
    ("DECIMAL(38,3)", "12345678901234567890123456789012345.678, -1.5"), ("STRUCT<a: INT, b: STRING>", "struct(1, 'x'), struct(2, 'y')"),
])
def test_streak_gives_keys_of_any_type_back(spark, tmp_path, kind, values):
    rows = spark.sql(f"select cast(k as {kind}) as k, timestamp '2024-01-01' as ts, 1 as v from (select explode(array({values}, null)) as k)")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    seen: list[list] = []
    streaks = stream.streak(streamio.read_files(spark, str(tmp_path / "in"), rows.schema), "k", ["ts"], "v > 0", timeout="none")
    assert streaks.schema["k"].dataType == rows.schema["k"].dataType
    stream.drain(stream.start(streaks, lambda df, _: seen.append(df.collect()), "update", str(tmp_path / "c")))
    assert sorted((r["k"] for x in seen for r in x), key=str) == sorted((r["k"] for r in rows.collect()), key=str) or kind == "DOUBLE"
    assert [r["streak"] for x in seen for r in x] == [1, 1, 1]


def test_files_are_gathered_from_the_scan_where_it_is_even(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(60_000).repartition(24).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        even = layout.gathered(spark.read.parquet(path), 6)
        assert "Exchange" not in even._jdf.queryExecution().executedPlan().toString()
        assert even.count() == 60_000
        assert layout.partition_report(even).count() == 6
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # one row group cannot be dealt out, and an empty table has no partitions
    one = str(tmp_path / "one")
    spark.range(600).coalesce(1).write.parquet(one)
    assert layout.partition_report(layout.gathered(spark.read.parquet(one), 6)).count() == 6
    assert layout.gathered(spark.read.parquet(one).limit(0), 6).isEmpty()


def _times(spark, path, rows, kind):
    df = spark.createDataFrame(rows, "k STRING, id LONG, ts STRING").withColumn("ts", F.col("ts").cast(kind))
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("closed", [False, True])
def test_packed_interval_join_lists_what_it_would_multiply(spark, tmp_path, monkeypatch, kind, closed):
    monkeypatch.setattr(stream, "PACK_ROWS", 64)
    start, chance, sides = datetime(2024, 1, 1), random.Random(5), {}
    for side in "ab":
        # many rows at few times, ends of steps and of intervals among them, over two batches
        sides[side] = [(chance.choice("xy"), i, start + timedelta(minutes=5 * chance.randrange(10))) for i in range(400)]
        for part in (sides[side][:200], sides[side][200:]):
            _times(spark, str(tmp_path / side), [(k, i, str(at)) for k, i, at in part] + [(None, 900, str(start)), ("x", 901, None)], kind)
    ddl = f"k STRING, id LONG, ts {kind}"
    a, b = (
        streamio.read_files(spark, str(tmp_path / side), ddl, max_files=1).withColumnsRenamed({"id": f"{side}_id", "ts": f"{side}_ts"}) for side in "ab"
    )
    out = str(tmp_path / "out")
    packs = stream.join_interval_packed(a, b, ["k"], "a_ts", "b_ts", "15 minutes", "60 days")
    stream.drain(stream.start(packs, out, "append", str(tmp_path / "ckpt")))
    pairs = stream.interval_pairs(spark.read.parquet(out), ["k"], "a_ts", "b_ts", "15 minutes", closed)
    assert dict(pairs.dtypes)["b_ts"] == kind
    end = timedelta(minutes=15, microseconds=0 if closed else -1)
    want = sorted((i, j) for k, i, at in sides["a"] for m, j, then in sides["b"] if k == m and at <= then <= at + end)
    assert sorted(map(tuple, pairs.select("a_id", "b_id").collect())) == want
    # 2 keys, 4 steps with the same and the next one, 2 batches a side, at most 2 packs each
    assert spark.read.parquet(out).count() <= 2 * 7 * 4 * 4 < len(want) / 50


def test_packed_interval_join_forgets_what_the_watermark_has_passed(spark, tmp_path):
    path = str(tmp_path / "in")
    for hour in range(6):
        _times(spark, path, [("x", 10 * hour + i, f"2024-01-01 {hour:02}:0{i}:00") for i in range(5)], "timestamp")
        time.sleep(0.01)
    a, b = (streamio.read_files(spark, path, "k STRING, id LONG, ts TIMESTAMP", max_files=1).withColumnsRenamed({"id": f"{s}_id", "ts": f"{s}_ts"}) for s in "ab")
    out = str(tmp_path / "out")
    packs = stream.join_interval_packed(a, b, ["k"], "a_ts", "b_ts", "15 minutes", "10 minutes")
    query = stream.drain(stream.start(packs, out, "append", str(tmp_path / "ckpt")))
    assert stream.interval_pairs(spark.read.parquet(out), ["k"], "a_ts", "b_ts", "15 minutes").count() == 6 * 15
    # a pack of a and two of b an hour
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


def test_weather_alerts_meet_readings_in_lists(spark, tmp_path, monkeypatch):
    written = []
    keep = s12_plans.to_files
    monkeypatch.setattr(s12_plans, "to_files", lambda t, df: written.append(keep(t, df)) or written[-1])
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_id < 100")
    copies = events.crossJoin(spark.range(30)).withColumn("event_id", F.col("event_id") + 100 * F.col("id")).drop("id")
    copies.coalesce(1).write.parquet(str(tmp_path / "one"))
    (tmp_path / "events.parquet").symlink_to(tmp_path / "one")
    pairs = QUERIES["s12_25_weather_alert_join"](spark, str(tmp_path)).count()
    assert pairs >= 900 * 10 and written[0].count() < pairs / 20
