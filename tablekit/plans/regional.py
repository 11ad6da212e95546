"""Computations mapped over countries and cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.operators import agg, quality, rows
from tablekit.streaming import stream

ORDER_RULES = [
    quality.Rule("valid_order_id", "order_id IS NOT NULL", "drop"),
    quality.Rule("valid_amount", "amount > 0", "warn"),
]


def country_sales(sales: DataFrame, factor: int = 10) -> DataFrame:
    """The same computation for every country, spread over the partitions."""
    return sales.withColumn("adjusted_sales", F.col("sales") * factor)


def orders_expectations(landed: DataFrame, keys: str = "city") -> DataFrame:
    """Landed orders: rules applied, one row per order, counted per city."""
    checked = quality.expectations(landed, ORDER_RULES)
    single = rows.drop_duplicates(checked, ["order_id"], ["order_created_at", "amount"])
    return agg.count_by(single, [keys], "orders")


def orders_expectations_stream(landed: DataFrame, delay: str) -> DataFrame:
    """The same as a stream of landed files: orders that pass, each once within ``delay``."""
    checked = quality.expectations(landed, ORDER_RULES)
    timed = checked.withColumn("order_created_at", F.col("order_created_at").cast("timestamp"))
    return stream.dedup(timed, ["order_id"], "order_created_at", delay)
