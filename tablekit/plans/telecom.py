"""Telecom usage: cleaned sessions, a star schema and monthly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions import exprs
from tablekit.operators import cols, join, rows
from tablekit.operators.windows import dense_key, latest_per_key
from tablekit.storage import cut_lineage

# Columns brought to upper case, closed ranges, label thresholds.
UPPER = ["plan_type", "device_type", "customer_status", "region", "source_system"]
PHONE_DIGITS = 10
RANGES = {
    "data_used_mb": (0, None),
    "upload_speed_mbps": (0, 100),
    "download_speed_mbps": (0, 500),
    "signal_strength": (-120, -40),
}
NETWORK = ["network_type", "tower_id", "source_system"]
CUSTOMER = ["customer_id", "phone_number", "region", "plan_type", "device_type", "customer_status", "signup_date"]


def _ts(col: str):
    return F.col(col).try_cast("timestamp_ntz")


def transform(usage: DataFrame) -> DataFrame:
    """Clean sessions: one valid row per usage id, with duration, quality labels and signup parts."""
    short = usage.filter(exprs.max_length("phone_number", PHONE_DIGITS))
    typed = short.withColumns(
        {
            "phone_number": exprs.try_cast("phone_number", "long"),
            **{c: exprs.clean(c, "upper") for c in UPPER},
            "signup_date": exprs.try_cast("signup_date", "date"),
            "session_start": _ts("session_start"),
            "session_end": _ts("session_end"),
        }
    )
    complete = rows.drop_null_rows(typed)
    # ties in ingestion time are settled by the whole row, so exact copies need no step of their own
    order = ["ingestion_timestamp", *[c for c in complete.columns if c not in ("usage_id", "ingestion_timestamp")]]
    latest = latest_per_key(complete, ["usage_id"], order)
    valid = rows.ranges(latest, RANGES)
    return valid.withColumns(
        {
            "session_duration_minutes": exprs.minutes_between("session_start", "session_end"),
            "data_usage_level": cols.bucket(
                "data_used_mb", [(500, "LOW"), (2000, "MEDIUM")], "HIGH", comparisons=["<", "<="]
            ),
            "signal_strength_quality": cols.bucket("signal_strength", [(-60, "HIGH"), (-90, "AVERAGE")], "LOW", ">="),
            "upload_speed_quality": cols.bucket("upload_speed_mbps", [(50, "HIGH"), (20, "AVERAGE")], "LOW", ">="),
            "download_speed_quality": cols.bucket("download_speed_mbps", [(200, "HIGH"), (50, "AVERAGE")], "LOW", ">="),
            "signup_year": F.year("signup_date"),
            "signup_month": F.month("signup_date"),
            "signup_week": exprs.iso_week("signup_date"),
        }
    )


def dim_customer(usage: DataFrame) -> DataFrame:
    """One row per customer, as of their latest session."""
    return latest_per_key(usage, ["customer_id"], ["ingestion_timestamp", "usage_id"]).select(*CUSTOMER)


def dim_time(usage: DataFrame) -> DataFrame:
    start = F.col("session_start")
    return usage.select("session_start").distinct().select(
        "session_start",
        exprs.date_of(start).alias("session_date"),
        F.year(start).alias("session_year"),
        F.month(start).alias("session_month"),
        exprs.iso_week(start).alias("session_week"),
        exprs.weekday_name(start).alias("weekday_name"),
        exprs.day_period(start).alias("day_period"),
    )


def dim_network(usage: DataFrame) -> DataFrame:
    """Distinct networks, numbered in their own order."""
    return dense_key(usage, NETWORK, "network_key")


FACT = [
    "usage_id", "customer_id", "tower_id", "network_key", "session_start", "session_end",
    "data_used_mb", "session_duration_minutes", "signal_strength", "upload_speed_mbps", "download_speed_mbps",
    "data_usage_level", "signal_strength_quality", "upload_speed_quality", "download_speed_quality",
    "network_type", "signup_year", "signup_month", "signup_week",
]


def fact(usage: DataFrame, network: DataFrame) -> DataFrame:
    return join.left(usage, network, NETWORK).select(*FACT)


def gold_kpis(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """KPIs by signup month, region and plan."""

    def mean(col: str):
        return exprs.stable_round(exprs.exact_mean(col), 2)

    def sessions(col: str, value: str):
        return F.count_if(F.col(col) == value)

    joined = join.left(facts, customers.select("customer_id", "region", "plan_type"), ["customer_id"])
    return joined.groupBy("signup_year", "signup_month", "region", "plan_type").agg(
        F.count("usage_id").alias("total_sessions"),
        F.count_distinct("customer_id").alias("active_users"),
        exprs.stable_round(exprs.exact_sum("data_used_mb"), 2).alias("total_data_consumed_mb"),
        mean("data_used_mb").alias("avg_data_usage_mb"),
        mean("session_duration_minutes").alias("avg_session_duration"),
        mean("download_speed_mbps").alias("avg_download_speed"),
        mean("upload_speed_mbps").alias("avg_upload_speed"),
        mean("signal_strength").alias("avg_signal_strength"),
        sessions("data_usage_level", "LOW").alias("low_usage_sessions"),
        sessions("data_usage_level", "MEDIUM").alias("medium_usage_sessions"),
        sessions("data_usage_level", "HIGH").alias("high_usage_sessions"),
        sessions("network_type", "5G").alias("sessions_5g"),
        sessions("network_type", "4G").alias("sessions_4g"),
        sessions("network_type", "LTE").alias("sessions_lte"),
    )


def star(usage: DataFrame) -> dict[str, DataFrame]:
    """Dimensions, facts and KPIs over sessions that are cleaned and stored once.

    Four tables read the sessions; without the stored copy each would clean the raw usage
    again.
    """
    sessions = cut_lineage(transform(usage), "telecom-sessions")
    network, customer = dim_network(sessions), dim_customer(sessions)
    facts = fact(sessions, network)
    return {
        "sessions": sessions,
        "dim_customer": customer,
        "dim_time": dim_time(sessions),
        "dim_network": network,
        "fact": facts,
        "gold_kpis": gold_kpis(facts, customer),
    }
