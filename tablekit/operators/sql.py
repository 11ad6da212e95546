"""SQL over named DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cte_chain(tables: dict[str, DataFrame], query: str, **params) -> DataFrame:
    """Run a query whose ``{name}`` placeholders are DataFrames, without touching the catalog."""
    spark = next(iter(tables.values())).sparkSession
    return spark.sql(query, args=params or None, **tables)
