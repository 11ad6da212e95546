"""Semantics of keyed event logs: ``(key, value, partition, offset, ts, ...)``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.operators.windows import lag_lead, latest_per_key, running, top_n_per_group


def latest_by_key(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Log compaction: the newest value per key; a NULL value deletes the key."""
    return latest_per_key(df, key, order).filter(F.col(value).isNotNull())


def retain(
    df: DataFrame,
    ts: str,
    horizon: datetime | None = None,
    max_bytes: int | None = None,
    partition: list[str] | None = None,
    order: list[str] | None = None,
    size: str | None = None,
) -> DataFrame:
    """Time and size retention: rows from ``horizon`` on, newest ``max_bytes`` per partition."""
    if horizon is not None:
        df = df.filter(F.col(ts) >= F.lit(horizon).cast(df.schema[ts].dataType))
    if max_bytes is not None:
        newest_first = [f"-{c}" for c in order]
        sized = running(df, partition or [], newest_first, {"__bytes": ("sum", size)}, rows=True)
        df = sized.filter(F.col("__bytes") <= max_bytes).drop("__bytes")
    return df


def order_check(df: DataFrame, key: list[str], seq: str, arrival: list[str]) -> DataFrame:
    """Per key: rows, rows that arrived behind an earlier one, and repeated sequence numbers."""
    seen = lag_lead(df, key, arrival, lags={"__prev": (seq, 1)})
    flagged = seen.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(seq) < F.col("__prev")).alias("out_of_order"),
        (F.count(F.lit(1)) - F.count_distinct(seq)).alias("repeats"),
    )
    return flagged


def store_once(df: DataFrame, producer: list[str], seq: str, arrival: list[str]) -> DataFrame:
    """Idempotent re-send: the first arrival of each (producer, seq) is stored."""
    return top_n_per_group(df, [*producer, seq], arrival, 1)


def replay(log: DataFrame, offsets: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Everything from the stored offset of each partition on; others from their start."""
    start = offsets.select(partition, F.col(offset).alias("__from"))
    return log.join(start, partition, "left").filter(F.col(offset) >= F.coalesce("__from", F.lit(0))).drop("__from")
