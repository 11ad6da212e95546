"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import surrogate_key
from tablekit.operators.slices import slice_hot_keys
from tablekit.operators.windows import neighbours


def type2_from_changes(
    rows: DataFrame, key: list[str], order: list[str], tracked: list[str], ts: str | None = None
) -> DataFrame:
    """Validity intervals from change rows; repeats of the same values are one version.

    ``ts`` (default: the first order column) gives the bounds. Adds ``valid_from``,
    ``valid_to``, ``is_current`` and a hash ``version_id``.
    """
    at = ts or order[0]
    values = slice_hot_keys(rows.withColumn("__v", F.struct(*tracked)), key, order)
    # a struct is never NULL, so a NULL neighbour means the first row of the key
    before = neighbours(values, {"__before": ("__v", 1)}, {})
    # leaving rows out does not move the others to another slice
    starts = before.on(before.df.filter(~F.col("__v").eqNullSafe(F.col("__before"))))
    ended = neighbours(starts, {}, {"__until": (at, 1)})
    return ended.df.select(
        *key,
        *tracked,
        F.col(at).alias("valid_from"),
        F.col("__until").alias("valid_to"),
        F.col("__until").isNull().alias("is_current"),
        surrogate_key(*key, at).alias("version_id"),
    )


def type2_apply(
    dim: DataFrame, batch: DataFrame, key: list[str], tracked: list[str], as_of: Column | None
) -> DataFrame:
    """Snapshot step: close changed current rows, add their new versions and new keys.

    ``batch`` has one row per key. ``as_of`` is the change time: an expression over the
    batch (e.g. its ``updated_at``); rows that are not newer than the current version are
    ignored. Keys missing from the batch stay as they are.
    """
    when = as_of if as_of is not None else F.current_timestamp()
    stamp_type = dim.schema["valid_from"].dataType
    fresh = batch.select(*key, F.struct(*tracked).alias("__new"), when.cast(stamp_type).alias("__when"))
    current = dim.filter(F.col("valid_to").isNull())
    closed_before = dim.filter(F.col("valid_to").isNotNull())
    both = current.withColumn("__old", F.struct(*tracked)).join(fresh, key, "full_outer")

    is_new = F.col("__old").isNull()
    differs = F.col("__new").isNotNull() & ~F.col("__old").eqNullSafe(F.col("__new"))
    changed = ~is_new & differs & (F.col("__when") > F.col("valid_from"))

    def version(source: str, start: str, end: Column) -> Column:
        fields = [F.col(k).alias(k) for k in key] + [F.col(source)[c].alias(c) for c in tracked]
        return F.struct(
            *fields,
            F.col(start).alias("valid_from"),
            end.cast(stamp_type).alias("valid_to"),
            end.isNull().alias("is_current"),
        )

    opened = version("__new", "__when", F.lit(None))
    kept = version("__old", "valid_from", F.lit(None))
    closed = version("__old", "valid_from", F.col("__when"))
    out = F.when(is_new, F.array(opened)).when(changed, F.array(closed, opened)).otherwise(F.array(kept))
    touched = both.select(F.inline(out))
    columns = [*key, *tracked, "valid_from", "valid_to", "is_current"]
    return closed_before.select(*columns).unionByName(touched.select(*columns))


def first_snapshot(batch: DataFrame, key: list[str], tracked: list[str], as_of: Column) -> DataFrame:
    """The dimension after the first load."""
    return batch.select(
        *key,
        *tracked,
        as_of.alias("valid_from"),
        F.lit(None).cast(batch.select(as_of.alias("x")).schema["x"].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("valid_to").isNull())
