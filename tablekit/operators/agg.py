"""Aggregations. Spark combines partial results in the map tasks, so only one row per
group and task is shuffled; the salted forms add a second stage for keys that are hot
after that as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import exact_sum, salt, stable_round


def count_by(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def stats_by(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(col).alias(f"avg_{col}"), F.max(col).alias(f"max_{col}"), F.min(col).alias(f"min_{col}")
    )


def sum_count(
    df: DataFrame, keys: list[str], sums: dict[str, str], counts: dict[str, str] | None = None
) -> DataFrame:
    """``sums`` is ``{new_name: column}``; ``counts`` likewise, with ``*`` for rows."""
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[(F.count(F.lit(1)) if c == "*" else F.count(c)).alias(n) for n, c in (counts or {}).items()],
    )


def having(df: DataFrame, keys: list[str], aggs: list[Column], pred: Column | str) -> DataFrame:
    """Groups whose aggregate satisfies the predicate."""
    return df.groupBy(*keys).agg(*aggs).filter(pred)


def count_distinct(df: DataFrame, keys: list[str], col: str, name: str, approx_rsd: float | None = None) -> DataFrame:
    """Exact by default; ``approx_rsd`` trades exactness for one small sketch per group."""
    exact = F.count_distinct(col) if approx_rsd is None else F.approx_count_distinct(col, approx_rsd)
    return df.groupBy(*keys).agg(exact.alias(name))


def count_if(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def rounded(df: DataFrame, keys: list[str], aggs: dict[str, Column], digits: int = 2) -> DataFrame:
    """Aggregates rounded once; sums of doubles that must not depend on the order of rows use ``exprs.exact_sum``."""
    return df.groupBy(*keys).agg(*[stable_round(c, digits).alias(n) for n, c in aggs.items()])


def ratio(df: DataFrame, keys: list[str], num: str, den: str, digits: int, name: str = "ratio") -> DataFrame:
    """Ratio of sums, NULL where the denominator sums to zero."""
    return df.groupBy(*keys).agg(stable_round(F.try_divide(exact_sum(num), exact_sum(den)), digits).alias(name))


def global_stats(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.min(col).alias(f"min_{col}"),
        F.max(col).alias(f"max_{col}"),
        F.avg(col).alias(f"avg_{col}"),
        F.count(F.lit(1)).alias("rows"),
    )


def distribution(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Value counts, most frequent first."""
    return count_by(df, [col], name).orderBy(F.desc(name), F.col(col))


def by_expression(df: DataFrame, label: Column, name: str, aggs: list[Column], also: list[str] | None = None) -> DataFrame:
    """Group by a computed label."""
    return df.groupBy(label.alias(name), *(also or [])).agg(*aggs)


def salted_count(df: DataFrame, key: list[str], n: int, row_id: list[str], name: str = "count") -> DataFrame:
    """Count per (key, salt), then add up per key."""
    partial = df.groupBy(*key, salt(n, *row_id).alias("__salt")).agg(F.count(F.lit(1)).alias("__n"))
    return partial.groupBy(*key).agg(F.sum("__n").alias(name))


def salted_hot(
    df: DataFrame, key: str, hot: list, n: int, row_id: list[str], name: str = "count"
) -> DataFrame:
    """Like :func:`salted_count`, but only the named hot keys are salted."""
    spread = F.when(F.col(key).isin(*hot), salt(n, *row_id)).otherwise(0)
    partial = df.groupBy(key, spread.alias("__salt")).agg(F.count(F.lit(1)).alias("__n"))
    return partial.groupBy(key).agg(F.sum("__n").alias(name))


def skew_report(df: DataFrame, key: str, top: int) -> DataFrame:
    """The ``top`` keys: rows, share of all rows, and rows relative to the mean key."""
    counts = count_by(df, [key], "rows")
    total = counts.agg(F.sum("rows").alias("n")).scalar()
    mean = counts.agg(F.avg("rows").alias("n")).scalar()
    return (
        counts.orderBy(F.desc("rows"), F.col(key))
        .limit(top)
        .select(
            key,
            "rows",
            stable_round(F.col("rows") / total, 6).alias("share"),
            stable_round(F.col("rows") / mean, 4).alias("times_mean"),
        )
    )


def max_id_next(df: DataFrame, col: str, name: str = "next_id") -> DataFrame:
    """One past the largest id; 1 for an empty table."""
    return df.agg((F.coalesce(F.max(col), F.lit(0)) + 1).cast("long").alias(name))


def histogram(df: DataFrame, col: str, bounds: list[float], keys: list[str] | None = None) -> DataFrame:
    """Cumulative counts per upper bound, one row per bound; the last bound is open."""
    at_most = [F.count_if(F.col(col) <= b) for b in bounds]
    everything = F.count(col)
    steps = F.array(
        *[F.struct(F.lit(str(b)).alias("le"), n.alias("rows")) for b, n in zip(bounds, at_most, strict=True)],
        F.struct(F.lit("+Inf").alias("le"), everything.alias("rows")),
    )
    grouped = df.groupBy(*(keys or [])).agg(steps.alias("__steps"))
    return grouped.select(*(keys or []), F.inline("__steps"))
