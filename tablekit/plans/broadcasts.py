"""Sports broadcasts: cleaning, validation and the summary per sport."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import exact_sum, stable_round
from tablekit.operators import rows

# Placeholder date, open range of minutes, points per stream quality.
NO_DATE = "31-12-9999"
MINUTES = (0, 300)
POINTS = {"4K": 3, "Full HD": 2, "HD": 1}


def _valid(df: DataFrame) -> DataFrame:
    timed = rows.where_inside(df, "duration_minutes", *MINUTES)
    return rows.reject_sentinel(timed, "event_date", NO_DATE)


def clean(df: DataFrame, order: list[str]) -> DataFrame:
    """One row per broadcast, then only rows with a real date and a plausible length."""
    return _valid(rows.drop_duplicates(df, ["broadcast_id"], order))


def validate(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows without date or length go first, so a complete copy of a broadcast can step in."""
    complete = rows.require(df, ["event_date", "duration_minutes"])
    return _valid(rows.drop_duplicates(complete, ["broadcast_id"], order))


def summary(df: DataFrame) -> DataFrame:
    """Twenty metrics per sport, by revenue; ``df`` has one row per broadcast.

    Sums and counts are first taken per sport and network, which makes the networks of a
    sport countable without listing every row once per distinct count.
    """
    points = F.lit(0)
    for quality, value in POINTS.items():
        points = F.when(F.col("stream_quality") == quality, value).otherwise(points)
    scored = df.withColumns({"points": points, "duration_hours": stable_round(F.col("duration_minutes") / 60, 2)})
    summed = ["duration_minutes", "duration_hours", "points", "live_viewers", "peak_viewers", "ad_revenue_usd"]
    fractions = ("duration_hours", "ad_revenue_usd")
    largest = ["duration_minutes", "live_viewers", "peak_viewers", "ad_revenue_usd"]
    parts = scored.groupBy("sport", "network").agg(
        F.count("broadcast_id").alias("n"),
        *[f(c).alias(f"{name}_{c}") for name, f in (("sum", lambda c: exact_sum(c) if c in fractions else F.sum(c)), ("n", F.count)) for c in summed],
        *[F.max(c).alias(f"max_{c}") for c in largest],
        F.min("duration_minutes").alias("min_duration_minutes"),
    )

    def total(col: str) -> Column:
        return exact_sum(f"sum_{col}") if col in fractions else F.sum(f"sum_{col}")

    def mean(col: str) -> Column:
        return F.try_divide(total(col), F.sum(f"n_{col}"))

    broadcasts = F.sum("n")
    return (
        parts.groupBy("sport")
        .agg(
            total("duration_minutes").alias("total_duration_minutes"),
            stable_round(total("duration_hours"), 2).alias("total_duration_hours"),
            stable_round(mean("duration_minutes"), 2).alias("avg_duration_minutes"),
            F.max("max_duration_minutes").alias("max_duration_minutes"),
            F.min("min_duration_minutes").alias("min_duration_minutes"),
            total("points").alias("total_points"),
            stable_round(mean("points"), 2).alias("avg_quality_score"),
            total("live_viewers").alias("total_live_viewers"),
            stable_round(mean("live_viewers"), 0).alias("avg_live_viewers"),
            F.max("max_live_viewers").alias("max_live_viewers"),
            stable_round(mean("peak_viewers"), 0).alias("avg_peak_viewers"),
            F.max("max_peak_viewers").alias("highest_peak_viewers"),
            stable_round(total("ad_revenue_usd"), 2).alias("total_ad_revenue"),
            stable_round(mean("ad_revenue_usd"), 2).alias("avg_ad_revenue"),
            stable_round(F.max("max_ad_revenue_usd"), 2).alias("highest_ad_revenue"),
            broadcasts.alias("total_broadcasts"),
            F.count("network").alias("unique_networks_covered"),
            stable_round(F.try_divide(total("ad_revenue_usd"), total("duration_minutes")), 2).alias("revenue_per_minute"),
            stable_round(F.try_divide(total("ad_revenue_usd"), total("live_viewers")), 4).alias("revenue_per_viewer"),
            stable_round(F.try_divide(total("live_viewers"), broadcasts), 0).alias("avg_viewers_per_broadcast"),
        )
        .orderBy(F.desc("total_ad_revenue"), "sport")
    )
