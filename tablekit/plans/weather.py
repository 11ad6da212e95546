"""Weather stream: decoded events, windowed averages, alerts and their follow-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.sources import streamio
from tablekit.streaming import stream

SCHEMA = "city STRING, temp_c DOUBLE, humidity INT, condition STRING, fetched_at STRING, event_id BIGINT"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def readings(kv: DataFrame, delay: str) -> DataFrame:
    """Decoded events with event time, repeats of (city, time) dropped."""
    decoded = streamio.decode_events(kv, SCHEMA)
    timed = stream.with_event_time(decoded, "fetched_at", TIME_FORMAT, delay, "event_time")
    return stream.dedup(timed, ["city", "event_time"], "event_time")


def averages(df: DataFrame, width: str = "1 minute") -> DataFrame:
    aggs = [F.avg("temp_c").alias("avg_temp"), F.max("humidity").alias("max_humidity"), F.count(F.lit(1)).alias("readings")]
    return stream.tumbling(df, "event_time", width, ["city"], aggs)


def hot_alerts(df: DataFrame, threshold: float) -> DataFrame:
    """Alert branch, encoded for its own topic."""
    hot = stream.filter_alerts(df, "temp_c", threshold)
    return streamio.encode_events(hot, "city", ["city", "temp_c", "humidity", "condition", "fetched_at", "event_id"])


def alerts_with_readings(alerts: DataFrame, df: DataFrame, delay: str, within: str = "15 minutes") -> DataFrame:
    """Readings of the same city up to ``within`` after an alert, as lists for a sink; see :func:`alert_pairs`."""
    a = alerts.select("city", F.col("event_time").alias("alert_time"), F.col("temp_c").alias("alert_temp"), F.col("event_id").alias("alert_id"))
    b = df.select("city", "event_time", "temp_c", "event_id")
    return stream.join_interval_packed(a, b, ["city"], "alert_time", "event_time", within, delay)


def alert_pairs(lists: DataFrame, within: str = "15 minutes") -> DataFrame:
    """One row for each alert and reading in the lists of :func:`alerts_with_readings`."""
    return stream.interval_pairs(lists, ["city"], "alert_time", "event_time", within, closed=True)
