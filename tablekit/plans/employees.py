"""Employee country snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import surrogate_key
from tablekit.operators import scd


def snapshot(dim: DataFrame | None, batch: DataFrame, key: str, tracked: list[str], updated_at: str) -> DataFrame:
    """Timestamp strategy: a newer ``updated_at`` with other values closes the current row."""
    at = F.col(updated_at)
    if dim is None:
        return scd.first_snapshot(batch, [key], tracked, at)
    return scd.type2_apply(dim, batch, [key], tracked, at)


def keyed_current(dim: DataFrame, key: str, place: str) -> DataFrame:
    """Current rows with a hash key over id and place."""
    now = scd.current(dim)
    return now.select(surrogate_key(key, place).alias("workspace_key"), *now.columns)
