"""Sorting, limits and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.slices import sort_columns
from tablekit.operators.windows import row_number


def sort(df: DataFrame, by: list[str]) -> DataFrame:
    """Multi-key sort; a leading ``-`` sorts that column downwards."""
    return df.orderBy(*sort_columns(by))


def limit(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """First ``n`` rows of an order: every task keeps ``n``, the rest never moves."""
    return df.orderBy(*sort_columns(by)).limit(n)


def top_k(df: DataFrame, group: list[str], aggs: list[Column], by: list[str], k: int) -> DataFrame:
    """Aggregate per group, then the first ``k`` groups; end ``by`` with the key as tie-break."""
    return limit(df.groupBy(*group).agg(*aggs), by, k)


def page(df: DataFrame, key: list[str], size: int, number: int) -> DataFrame:
    """Page ``number`` (from 0) of a keyed order: every task keeps the rows up to the page's end, the rest never moves.

    Whoever turns many pages numbers the rows once, with :func:`page_starts`, and goes on from
    there with :func:`page_from`.
    """
    return df.orderBy(*sort_columns(key)).offset(size * number).limit(size)


def page_starts(df: DataFrame, key: list[str], size: int) -> DataFrame:
    """``page`` and the key values of its first row, for every page; a table to be stored."""
    placed = row_number(df, [], key, "__at")
    names = [k.removeprefix("-") for k in key]
    return placed.filter((F.col("__at") - 1) % size == 0).select(F.expr(f"(__at - 1) div {size}").alias("page"), *names)


def page_from(df: DataFrame, starts: DataFrame, key: list[str], size: int, number: int) -> DataFrame:
    """A page by its stored start: the filter reaches the scan. Empty for a page that there is not."""
    first = starts.filter(F.col("page") == number).first()
    return df.limit(0) if first is None else page_after(df, key, size, first.asDict(), inclusive=True)


def page_after(df: DataFrame, key: list[str], size: int, last: dict | None = None, inclusive: bool = False) -> DataFrame:
    """The ``size`` rows that follow the key values ``last`` of the page before; None is the start.

    Nothing is numbered: the filter reaches the scan and every task keeps ``size`` rows.
    ``last`` holds no NULL. ``inclusive`` starts with the row of these values itself.
    """
    follows = F.lit(last is None or inclusive)
    for name in reversed(key if last else []):
        plain = name.removeprefix("-")
        value = F.lit(last[plain]).cast(df.schema[plain].dataType)
        # NULL is the smallest value
        beyond = F.col(plain).isNull() | (F.col(plain) < value) if name.startswith("-") else F.col(plain) > value
        follows = beyond | ((F.col(plain) == value) & follows)
    return limit(df.filter(follows), key, size)
