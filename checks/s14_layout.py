"""Partitions and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from tablekit import storage
from tablekit.operators import layout
from tablekit.sources import io


@check("s14_01_repartition", "select count(*) as rows, count(distinct l_suppkey) as keys, 0::bigint as split_keys from lineitem")
def repartition(t):
    by_key = layout.repartition(t.lineitem.select("l_suppkey"), 8, "l_suppkey")
    split = layout.keys_in_several_partitions(by_key, "l_suppkey").agg(F.count(F.lit(1)).alias("n")).scalar()
    return by_key.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("l_suppkey").alias("keys")).withColumn("split_keys", split)


@check("s14_02_coalesce", "select event_type, count(*) as rows from events group by event_type")
def coalesce(t):
    return layout.coalesce(t.events.repartition(16), 4).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


@check("s14_03_partition_report", "select 8::bigint as partitions, count(*) as rows, true as even from lineitem")
def partition_report(t):
    report = layout.partition_report(layout.repartition(t.lineitem, 8))
    skew = layout.partition_skew(layout.repartition(t.lineitem, 8)).select((F.col("skew") < 1.5).alias("even")).scalar()
    totals = report.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))
    return totals.withColumn("even", skew)


@check("s14_04_file_report", "select 6::bigint as files, true as sized, count(*) as rows from lineitem")
def file_report(t):
    path = t.dir("six")
    layout.gathered(t.lineitem, 6).write.parquet(path)
    rows = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).scalar()
    return layout.file_report(t.spark, path).select("files", (F.col("bytes") > 0).alias("sized"), rows.alias("rows"))


LINES = "select l_orderkey, l_partkey, l_suppkey, l_extendedprice from lineitem"


def _lines(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@check("s14_05_compact", LINES)
def compact(t):
    path = t.dir("small-files")
    _lines(t).repartition(24).write.parquet(path)
    files = layout.files_for(storage.total_bytes(t.spark, path), layout.TARGET_FILE_BYTES)
    layout.compact(t.spark, path, layout.TARGET_FILE_BYTES)
    assert layout.file_report(t.spark, path).first()["files"] == files
    return io.read_parquet(t.spark, path)


@check("s14_05_compact_partitioned", "select o_orderkey, o_orderstatus from orders")
def compact_partitioned(t):
    path = t.dir("small-part-files")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    orders.repartition(12).write.partitionBy("o_orderstatus").parquet(path)
    layout.compact(t.spark, path, target_bytes=max(1, storage.total_bytes(t.spark, path) // 4), by=["o_orderstatus"])
    return io.read_parquet(t.spark, path)


@check("s14_06_cluster", LINES)
def cluster(t):
    path = t.dir("clustered")
    layout.cluster(_lines(t), ["l_partkey", "l_suppkey"], 16).write.parquet(path)
    return io.read_parquet(t.spark, path)


@check("s14_06_cluster_any_type", "select event_id, event_type, ts, value from events")
def cluster_any_type(t):
    path = t.dir("clustered")
    layout.cluster(t.events.select("event_id", "event_type", "ts", "value"), ["event_type", "ts"], 12).write.parquet(path)
    return io.read_parquet(t.spark, path)


@check(
    "s14_07_partition_advice",
    " union all ".join(
        f"select '{c}' as candidate, count(distinct {c}) as distinct_values, count(*) * 40 / count(distinct {c}) as bytes_per_value, "
        f"case when count(*) * 40 / count(distinct {c}) < 10000 then 'too many values' else 'suitable' end as advice from events"
        for c in ("event_type", "user_id", "event_id")
    ),
)
def partition_advice(t):
    return layout.partition_advice(t.events, ["event_type", "user_id", "event_id"], 10_000, 40, exact=True)
