"""Column operators: projections, labels and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Select columns; pass ``lit(...)`` for constants."""
    return df.select(*cols)


def star_except(df: DataFrame, except_: list[str]) -> DataFrame:
    """All columns but the named ones. Unknown names are an error, not a no-op."""
    missing = [c for c in except_ if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*except_)


def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns one after the other; later ones may use earlier ones."""
    for name, expr in exprs.items():
        df = df.withColumn(name, expr)
    return df


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def nested(df: DataFrame, path: str, name: str | None = None) -> DataFrame:
    """Select one field inside a struct by its dotted path."""
    return df.select(F.col(path).alias(name or path.rsplit(".", 1)[-1]))


def case_map(col: Column | str, mapping: dict[str, str], default: str | None = None) -> Column:
    """Code to label."""
    source = F.col(col) if isinstance(col, str) else col
    chain = F
    for code, label in mapping.items():
        chain = chain.when(source == F.lit(code), F.lit(label))
    return chain.otherwise(F.lit(default))


def bucket(
    col: Column | str,
    steps: list[tuple[float, str]],
    otherwise: str,
    compare: str = "<",
    comparisons: list[str] | None = None,
) -> Column:
    """Threshold labels: the first ``(bound, label)`` whose comparison holds.

    ``compare`` is one of ``< <= > >=``; ``comparisons`` gives one per step when they differ.
    NULL stays NULL.
    """
    source = F.col(col) if isinstance(col, str) else col
    tests = {
        "<": lambda b: source < b,
        "<=": lambda b: source <= b,
        ">": lambda b: source > b,
        ">=": lambda b: source >= b,
    }
    chain = F.when(source.isNull(), F.lit(None).cast("string"))
    for (bound, label), op in zip(steps, comparisons or [compare] * len(steps), strict=True):
        chain = chain.when(tests[op](F.lit(bound)), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def indicator(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def mask(df: DataFrame, col: str, allowed: bool) -> DataFrame:
    """The column's values for members of an allowed group, NULL for everyone else."""
    return df.withColumn(col, F.when(F.lit(allowed), F.col(col)))


def mask_view(df: DataFrame, col: str, groups: set[str], permitted: set[str]) -> DataFrame:
    """Mask unless one of the reader's groups is permitted to see the column."""
    return mask(df, col, bool(groups & permitted))
