"""Stream behaviour that a finished table cannot show."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablekit.sources import streamio
from tablekit.streaming import stream
from tablekit.streaming.batches import BatchTable

DDL = "k STRING, v BIGINT, ts TIMESTAMP"


def land(spark, path, rows):
    spark.createDataFrame(rows, "k STRING, v BIGINT, ts STRING").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for i in range(3):
        land(spark, src, [(f"k{i}", i, "2024-01-01 00:00:00")])
        stream.resume(lambda: streamio.read_files(spark, src, DDL), out, ckpt)
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_late_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [("a", 1, "2024-01-01 00:00:10")])
    land(spark, src, [("a", 1, "2024-01-01 02:00:00")])
    land(spark, src, [("a", 1, "2024-01-01 03:00:00")])
    land(spark, src, [("a", 1, "2024-01-01 00:00:20")])
    land(spark, src, [("a", 1, "2024-01-01 04:00:00")])
    timed = stream.with_event_time(streamio.read_files(spark, src, DDL, max_files=1), "ts", delay="10 minutes")
    counts = stream.tumbling(timed, "ts", "1 minute", ["k"], [F.count(F.lit(1)).alias("n")])
    out = str(tmp_path / "out")
    stream.drain(stream.start(counts, out, "append", str(tmp_path / "ckpt")))
    first = spark.read.parquet(out).orderBy("window_start").first()
    assert first["n"] == 1


def test_output_mode_contract(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [("a", 1, "2024-01-01 00:00:00")])
    raw = streamio.read_files(spark, src, DDL)
    with pytest.raises(ValueError, match="complete"):
        stream.check_output_mode(raw, "complete")
    with pytest.raises(ValueError, match="watermark"):
        stream.check_output_mode(raw.groupBy("k").count(), "append")
    with pytest.raises(ValueError, match="output mode"):
        stream.check_output_mode(raw, "replace")
    stream.check_output_mode(raw.groupBy("k").count(), "complete")


def test_triggers():
    assert stream.trigger("once") == stream.trigger("availableNow") == {"availableNow": True}
    assert stream.trigger("processingTime", "5 seconds") == {"processingTime": "5 seconds"}
    with pytest.raises(ValueError):
        stream.trigger("continuous")


def test_redelivered_batch_changes_nothing(spark, tmp_path):
    schema = "k STRING, v BIGINT"
    first = spark.createDataFrame([("a", 1), ("b", 1)], schema)
    second = spark.createDataFrame([("a", 2), ("c", 2)], schema)
    state = BatchTable(str(tmp_path / "state"), ["k"], first.schema)
    sink = stream.upsert_sink(state, ["v"])
    sink(first, 0)
    for _ in range(2):
        sink(second, 1)
        assert sorted(map(tuple, state.read(spark).collect())) == [("a", 2), ("b", 1), ("c", 2)]


def test_old_value_arriving_late_does_not_win(spark, tmp_path):
    schema = "k STRING, v BIGINT"
    state = BatchTable(str(tmp_path / "state"), ["k"], spark.createDataFrame([], schema).schema)
    sink = stream.upsert_sink(state, ["v"])
    sink(spark.createDataFrame([("a", 5)], schema), 0)
    sink(spark.createDataFrame([("a", 3)], schema), 1)
    assert state.read(spark).first()["v"] == 5


def test_streak_survives_batches_and_disorder(spark, tmp_path):
    src = str(tmp_path / "src")
    land(spark, src, [("a", 40, "2024-01-01 00:00:02"), ("a", 10, "2024-01-01 00:00:01"), ("b", 40, "2024-01-01 00:00:00")])
    land(spark, src, [("a", 41, "2024-01-01 00:00:03"), ("b", 1, "2024-01-01 00:00:05"), ("b", 50, "2024-01-01 00:00:09")])
    streaks = stream.streak(streamio.read_files(spark, src, DDL, max_files=1), "k", ["ts"], "v > 35", timeout="none")
    state = BatchTable(str(tmp_path / "state"), ["k"], streaks.schema)
    stream.drain(stream.start(streaks, stream.latest_state_sink(state), "update", str(tmp_path / "ckpt")))
    assert {r["k"]: r["streak"] for r in state.read(spark).collect()} == {"a": 2, "b": 1}


def test_unexpected_field_stops_the_stream(spark, tmp_path):
    lines = spark.createDataFrame([('{"id":1}',), ('{"id":2,"extra":true}',)], "value STRING")
    with pytest.raises(Exception, match="unexpected fields: extra"):
        streamio.parse_drifting(lines, "id BIGINT", streamio.FAIL).collect()
    assert streamio.parse_drifting(lines, "id BIGINT", streamio.NONE).count() == 2


def test_rate_source_gives_labelled_rows(spark, tmp_path):
    rate = streamio.read_rate(spark, 0, per_batch=5)
    assert rate.columns == ["timestamp", "value", "label"]
    query = rate.writeStream.format("memory").queryName("rate_rows").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start()
    try:
        for _ in range(100):
            if spark.table("rate_rows").count():
                break
            query.awaitTermination(0.2)
        assert stream.status(query)["active"]
        assert spark.table("rate_rows").filter("label = '3'").count() == 1
    finally:
        query.stop()
