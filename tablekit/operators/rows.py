"""Row operators: filters, NULL handling and duplicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.operators.windows import top_n_per_group

_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def where_compare(df: DataFrame, col: str, op: str, value) -> DataFrame:
    return df.filter(_COMPARE[op](F.col(col), F.lit(value)))


def where_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).like(pattern))


def where_between(df: DataFrame, col: str, low, high) -> DataFrame:
    """Closed range."""
    return df.filter(F.col(col).between(low, high))


def where_inside(df: DataFrame, col: str, low, high) -> DataFrame:
    """Open range."""
    return df.filter((F.col(col) > low) & (F.col(col) < high))


def ranges(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Closed ranges on several columns; ``None`` leaves an end open."""
    for col, (low, high) in bounds.items():
        if low is not None:
            df = df.filter(F.col(col) >= low)
        if high is not None:
            df = df.filter(F.col(col) <= high)
    return df


def where_in(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def where_not_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """SQL's ``NOT IN``: NULL rows are dropped."""
    return df.filter(~F.col(col).isin(*values))


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows in which all named columns are set; NaN counts as missing.

    One ``IS NOT NULL`` per column: each reaches the file scan on its own, which the
    single combined test of ``na.drop`` does not.
    """
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            df = df.filter(~F.isnan(c))
    return df


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any missing value."""
    return require(df, df.columns)


def reject_sentinel(df: DataFrame, col: str, value: str) -> DataFrame:
    """Drop missing values and the placeholder that stands for them."""
    return df.filter(F.col(col).isNotNull() & (F.col(col).cast("string") != F.lit(value)))


def fill(df: DataFrame, defaults: dict) -> DataFrame:
    """A default per column in place of NULL; the column keeps its type."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(c, F.lit(v).cast(types[c])) for c, v in defaults.items()})


def coalesce_cols(*cols: str | Column) -> Column:
    """First non-NULL value."""
    return F.coalesce(*cols)


def distinct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def drop_duplicates(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the first in ``order_by``; NULL keys form one group."""
    return top_n_per_group(df, keys, order_by, 1)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def since_watermark(df: DataFrame, ts: str, last: datetime | None) -> DataFrame:
    """Rows strictly newer than the stored high-water mark; all of them on the first run."""
    return df if last is None else df.filter(F.col(ts) > F.lit(last).cast(df.schema[ts].dataType))


def scalar_subquery_filter(df: DataFrame, col: str, other: DataFrame, value: Column) -> DataFrame:
    """``where col > (select value from other)``. An empty ``other`` keeps everything."""
    bound = other.agg(value.alias("bound")).scalar()
    return df.filter(bound.isNull() | (F.col(col) > bound))


def explode_records(df: DataFrame, arr: str, keep: list[str] | None = None) -> DataFrame:
    """One row per element of an array of structs, its fields as columns."""
    return df.select(*(keep or []), F.inline(arr))
