"""Website checks: cleaned rows and the reports over them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions import exprs
from tablekit.operators import agg, cols, order, udfs

# Fields a row must have, and the code that means no real answer.
REQUIRED = ["status_code", "url", "fix", "response_time_ms", "status_message"]
INVALID_CODE = 999


def transform(checks: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    code, ms, at = F.col("status_code"), F.col("response_time_ms"), F.col("checked_at")
    name, domain = exprs.url_parts("url")
    load = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp_ntz")
    return udfs.row_transform(
        checks,
        [
            {"url": exprs.normalize_url("url"), "response_time_ms": ms.cast("double")},
            {
                "website_name": name,
                "domain": domain,
                "response_time_s": ms / 1000.0,
                "performance_bucket": cols.bucket(
                    ms, [(200, "fast"), (800, "moderate"), (1000, "slow")], "critical", "<="
                ),
                "status_group": F.when(code.between(200, 299), "success")
                .when(code.between(300, 399), "redirection")
                .when(code.between(400, 499), "client_error")
                .when(code.between(500, 599), "server_error")
                .otherwise("invalid_error"),
                "is_error": code >= 400,
                "is_success": code.between(200, 299),
                "is_redirect": code.between(300, 399),
                "is_slow_response": ms > 1000,
                "status_message": F.when(code == INVALID_CODE, "Invalid").otherwise(F.col("status_message")),
                "fix": exprs.clean("fix", "lower"),
                "check_date": exprs.date_of(at),
                "check_month": F.month(at),
                "check_year": F.year(at),
                "check_hour": F.hour(at),
                "check_day_name": exprs.weekday_name(at),
                "ingestion_time": load,
                "load_time": load,
            },
        ],
        drop_null=REQUIRED,
    )


def latest(checks: DataFrame, n: int = 5) -> DataFrame:
    return order.limit(checks, ["-id"], n)


def total(checks: DataFrame) -> DataFrame:
    return checks.agg(F.count(F.lit(1)).alias("total_records"))


def by_status_code(checks: DataFrame) -> DataFrame:
    return agg.distribution(checks, "status_code", "status_code_count")


def by_bucket(checks: DataFrame) -> DataFrame:
    return agg.distribution(checks, "performance_bucket", "bucket_count")


def by_status_group(checks: DataFrame) -> DataFrame:
    return agg.distribution(checks, "status_group", "group_count")


def response_times(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.min("response_time_ms").alias("min_response_time"),
        F.max("response_time_ms").alias("max_response_time"),
        exprs.stable_round(exprs.exact_mean("response_time_ms"), 2).alias("avg_response_time"),
    )


def errors(checks: DataFrame) -> DataFrame:
    return agg.count_by(checks, ["is_error"], "total")


def slowest(checks: DataFrame, n: int = 10) -> DataFrame:
    mean = exprs.stable_round(exprs.exact_mean("response_time_ms"), 4).alias("avg_response_time")
    return order.top_k(checks, ["url"], [mean], ["-avg_response_time", "url"], n)


def daily_volume(checks: DataFrame, n: int = 10) -> DataFrame:
    return order.top_k(checks, ["check_date"], [F.count(F.lit(1)).alias("total_checks")], ["-check_date"], n)


def report(checks: DataFrame) -> dict[str, DataFrame]:
    """All reports; each reads only the columns it needs."""
    return {
        "latest": latest(checks),
        "total": total(checks),
        "by_status_code": by_status_code(checks),
        "by_bucket": by_bucket(checks),
        "by_status_group": by_status_group(checks),
        "response_times": response_times(checks),
        "errors": errors(checks),
        "slowest": slowest(checks),
        "daily_volume": daily_volume(checks),
    }
