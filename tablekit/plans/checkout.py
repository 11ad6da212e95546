"""Checkout audit: what happened to payments after checkout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import exact_mean, stable_round, unpack_json
from tablekit.operators import join, order


def audit(transactions: DataFrame, audits: DataFrame, method: str, metadata_schema: str) -> DataFrame:
    """Per method and status transition: events, failures, refunds, mean risk, metadata total."""
    unpacked = audits.withColumn("m", unpack_json("metadata", metadata_schema))
    joined = join.inner(unpacked, transactions.select("checkout_id", method), ["checkout_id"])
    return joined.groupBy(method, "old_status", "new_status").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("new_status") == "FAILED").alias("failures"),
        F.count_if(F.col("new_status") == "REFUNDED").alias("refunds"),
        stable_round(exact_mean("risk_score"), 4).alias("avg_risk"),
        F.sum("m.k").alias("metadata_total"),
    )


def latest(audits: DataFrame, n: int = 5) -> DataFrame:
    return order.limit(audits, ["-event_time", "-audit_id"], n)


def has_transition(audits: DataFrame, new_status: str) -> DataFrame:
    """One row: whether any audit reached a status."""
    return audits.agg(F.coalesce(F.bool_or(F.col("new_status") == new_status), F.lit(False)).alias("found"))
