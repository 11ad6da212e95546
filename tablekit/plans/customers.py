"""Customers: daily increments through three layers, and recent spend."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators import merge, rows
from tablekit.operators.buckets import BucketTable
from tablekit.operators.sql import cte_chain
from tablekit.sources import io


@dataclass(frozen=True)
class Layers:
    """Where the layers live."""

    bronze: str
    silver: str
    gold: str


def load_day(
    spark: SparkSession, csv_path: str, schema: str, day: str, layers: Layers, keys: list[str], newer: str, buckets: int = 64
) -> None:
    """One day's file: replace the day in bronze, then merge newer rows into silver and gold.

    Running a day again changes nothing: its bronze directory is replaced and the merges
    compare ``newer``. Silver and gold lie in ``buckets`` by key, of which a day rewrites those
    its keys fall into.
    """
    batch = io.read_csv(spark, csv_path, schema).withColumn("load_day", F.lit(day).cast("date"))
    io.overwrite_partitions(batch, layers.bronze, ["load_day"])
    fresh = spark.read.parquet(layers.bronze).filter(F.col("load_day") == F.lit(day).cast("date")).drop("load_day")
    for target in (layers.silver, layers.gold):
        clean = rows.require(fresh, keys) if target == layers.gold else fresh
        table = BucketTable(target, keys, buckets)
        if table.exists(spark):
            table.merge(clean, lambda old, new: merge.upsert_if(old, new, keys, newer))
        else:
            table.create(merge.upsert_if(clean.limit(0), clean, keys, newer))


SPEND_QUERY = """
with recent as (
  select customer_id, amount from {orders}
  where order_created_at >= :as_of - interval 30 days and order_created_at < :as_of + interval 1 day
), totals as (
  select customer_id, sum(amount) as total_spent from recent group by customer_id
)
select customer_id, total_spent from totals where total_spent > :floor order by total_spent desc, customer_id
"""


def spend(orders: DataFrame, as_of: date, floor: float = 1000) -> DataFrame:
    """Customers above ``floor`` in the 30 days up to ``as_of``, largest first."""
    return cte_chain({"orders": orders}, SPEND_QUERY, as_of=as_of, floor=floor)
