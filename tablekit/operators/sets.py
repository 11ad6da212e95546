"""Set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack by position."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.union(df)
    return out


def union_by_name(a: DataFrame, b: DataFrame, fill_missing: bool = False) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=fill_missing)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def subtract_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag difference: each row of ``b`` cancels one copy in ``a``."""
    return a.exceptAll(b)
