"""Python functions as columns, for what no built-in expression covers.

Built-in expressions stay in generated code; every function here sends rows to a Python
worker in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators import rows


def scalar(fn: Callable, returns: str, use_arrow: bool = True) -> Callable[..., Column]:
    """A row-at-a-time function, moved in Arrow batches unless ``use_arrow`` is off."""
    return F.udf(fn, returns, useArrow=use_arrow)


def vectorized(fn: Callable[..., pd.Series], returns: str) -> Callable[..., Column]:
    """A function over whole pandas series."""

    def over_series(*series: pd.Series) -> pd.Series:
        return fn(*series)

    # pandas_udf reads the kind of function from its annotations
    def one(a: pd.Series) -> pd.Series:
        return over_series(a)

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return over_series(a, b)

    arity = fn.__code__.co_argcount
    if arity not in (1, 2):
        raise ValueError("one or two columns; put more into a struct")
    return F.pandas_udf(one if arity == 1 else two, returns)


def compare(df: DataFrame, builtin: Column, custom: Column) -> DataFrame:
    """Both results side by side, and whether they agree."""
    return df.select("*", builtin.alias("builtin"), custom.alias("custom")).withColumn(
        "agree", F.col("builtin").eqNullSafe(F.col("custom"))
    )


def row_transform(df: DataFrame, steps: list[dict[str, Column]], drop_null: list[str] | None = None) -> DataFrame:
    """A per-row transformer as column steps: drop incomplete rows, then assign in stages.

    Columns of one step see the values from before it, as one projection.
    """
    if drop_null:
        df = rows.require(df, drop_null)
    for step in steps:
        df = df.withColumns(step)
    return df
