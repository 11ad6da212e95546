"""Bronze, silver and gold layers of orders, customers and events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions import exprs
from tablekit.operators import cols, join, rows
from tablekit.streaming import stream


def bronze(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The rows as they came, with the time they came."""
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return df.withColumn("_ingest_time", when)


def silver_orders(df: DataFrame, delivered: str = "delivered") -> DataFrame:
    at = F.col("order_created_at")
    single = rows.drop_duplicates(rows.require(df, ["order_id"]), ["order_id"], ["order_created_at", "amount"])
    return single.withColumns(
        {
            "order_month": F.month(at),
            "order_year": F.year(at),
            "order_date": exprs.date_of(at),
            "status_indicator": cols.indicator(F.lower("order_status") == delivered),
        }
    )


def silver_customers(df: DataFrame, premium: str = "Premium") -> DataFrame:
    single = rows.drop_duplicates(df, ["customer_id"], ["customer_name"])
    flagged = single.withColumns(
        {
            "customer_segment_indicator": cols.indicator(F.col("customer_segment") == premium),
            "account_status_indicator": cols.indicator(F.col("account_status") == "Active"),
        }
    )
    return cols.rename(flagged, {"city": "neighbourhood"})


def gold_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, delivered orders and value by month, segment and account status."""
    enriched = join.inner(orders, customers, ["customer_id"])
    return enriched.groupBy("order_month", "order_year", "customer_segment", "account_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("status_indicator").alias("delivered_orders"),
        exprs.stable_round(exprs.exact_sum("amount"), 2).alias("total_value"),
        exprs.stable_round(exprs.exact_mean("amount"), 2).alias("avg_value"),
    )


def bronze_events(df: DataFrame, as_of: datetime | None = None, files: bool = False) -> DataFrame:
    return exprs.lineage(df, as_of, files)


def silver_events(df: DataFrame) -> DataFrame:
    """One row per event id with a typed time."""
    typed = df.withColumn("event_ts", F.col("ts").cast("timestamp_ntz")).filter(F.col("event_ts").isNotNull())
    single = rows.drop_duplicates(typed, ["event_id"], ["event_ts", "user_id", "event_type"])
    return single.select("event_id", "user_id", "event_type", "event_ts")


def gold_events(df: DataFrame) -> DataFrame:
    """Events per hour and type."""
    return stream.tumbling(df, "event_ts", "1 hour", ["event_type"], [F.count(F.lit(1)).alias("count")])
