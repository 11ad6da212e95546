"""Window operators. Hot keys are cut into slices, see :mod:`slices`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.operators.slices import SLICE, Sliced, hot_keys, order_names, same_keys, slice_hot_keys, sort_columns


def row_number(df: DataFrame, part: list[str], order: list[str], name: str = "row_number") -> DataFrame:
    """1..n inside each partition; ``order`` must be total to be repeatable."""
    return numbered(slice_hot_keys(df, part, order), F.row_number(), name).done()


def rank(df: DataFrame, part: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Rank with gaps after ties."""

    def scan(values: Sliced) -> Sliced:
        upto = cumulate(values, {"__upto": ("sum", "__n")}, rows=True)
        return upto.on(upto.df.withColumn(name, F.col("__upto") - F.col("__n") + 1).drop("__upto"))

    found = _over_values(df, part, order, {name: F.rank()}, {"__n": F.count(F.lit(1))}, scan)
    return found.withColumn(name, F.col(name).cast("long"))


def dense_rank(df: DataFrame, part: list[str], order: list[str], name: str = "dense_rank") -> DataFrame:
    """Rank without gaps."""
    found = _over_values(df, part, order, {name: F.dense_rank()}, {}, lambda values: numbered(values, F.row_number(), name))
    return found.withColumn(name, F.col(name).cast("long"))


def _over_values(
    df: DataFrame, part: list[str], order: list[str], plain: dict[str, Column], totals: dict[str, Column], scan: Callable[[Sliced], Sliced]
) -> DataFrame:
    """Window functions whose result depends on a row's order values only.

    Keys of ordinary size run ``plain`` over their rows. A hot key's rows are first summed up
    for each combination of order values, in the tasks and then across them; ``scan`` runs over
    these sums, cut into slices if they are many, and its columns are joined with the rows. So
    rows that share their order values need not meet in a task, however many they are: the join
    may split them.
    """
    w = Window.partitionBy(*part).orderBy(*sort_columns(order))

    def windowed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({n: c.over(w) for n, c in plain.items()})

    hot = hot_keys(df, part)
    if hot is None:
        return windowed(df)
    # without partition columns the whole table is one hot key
    cold = windowed(df.join(hot, same_keys(part), "left_anti") if part else df.limit(0))
    rows = df.join(hot, same_keys(part), "left_semi") if part else df
    by = list(dict.fromkeys([*part, *order_names(order)]))
    values = rows.groupBy(*by).agg(*[c.alias(n) for n, c in totals.items()]) if totals else rows.select(*by).distinct()
    scanned = scan(slice_hot_keys(values, part, order)).done(*totals)
    side = scanned.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], *[F.col(n).cast(cold.schema[n].dataType) for n in plain])
    joined = rows.join(side, same_keys(by)).select(*df.columns, *plain)
    return cold.select(*df.columns, *plain).union(joined)


def numbered(sliced: Sliced, ranking: Column, name: str) -> Sliced:
    """Row numbers over slices: each adds the rows of the slices before."""
    local = sliced.df.withColumn(name, ranking.over(sliced.window()).cast("long"))
    if not sliced.split:
        return sliced.on(local)
    before = sliced.carry({"__n": F.count(F.lit(1))}, {"__before": F.sum("__n")})
    total = F.col(name) + F.coalesce("__before", F.lit(0))
    return sliced.on(sliced.with_carry(local, before).withColumn(name, total).drop("__before"))


def lag_lead(
    df: DataFrame,
    part: list[str],
    order: list[str],
    lags: dict[str, tuple[str, int]] | None = None,
    leads: dict[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Add previous and next values: ``{new_name: (column, offset)}``; NULL at the edges."""
    return neighbours(slice_hot_keys(df, part, order), lags or {}, leads or {}).done()


def neighbours(sliced: Sliced, lags: dict[str, tuple[str, int]], leads: dict[str, tuple[str, int]]) -> Sliced:
    """:func:`lag_lead` over slices; several steps can share one cutting of the keys."""
    def shifted(over) -> dict[str, Column]:
        return {
            **{n: F.lag(c, k).over(over) for n, (c, k) in lags.items()},
            **{n: F.lead(c, k).over(over) for n, (c, k) in leads.items()},
        }

    w, part = sliced.window(), sliced.keys
    out = sliced.df.withColumns(shifted(w))
    if not sliced.split:
        return sliced.on(out)

    reach = max(k for _, k in [*lags.values(), *leads.values()])
    place = {
        "__rn": F.row_number().over(w),
        "__left": F.count(F.lit(1)).over(Window.partitionBy(*part, SLICE)) - F.row_number().over(w),
    }
    # the first and last rows of every slice, in order, hold all neighbours across the cuts
    edges = sliced.hot().withColumns(place).filter((F.col("__rn") <= reach) | (F.col("__left") < reach))
    whole = Window.partitionBy(*part).orderBy(*sort_columns(sliced.order))
    across = edges.select(*part, SLICE, "__rn", *[c.alias(f"__e_{n}") for n, c in shifted(whole).items()])
    joined = sliced.with_carry(out.withColumns(place), across, ["__rn"])
    cut = F.col(SLICE) >= 0
    fixed = {
        **{n: F.when(cut & (F.col("__rn") <= k), F.col(f"__e_{n}")).otherwise(F.col(n)) for n, (_, k) in lags.items()},
        **{n: F.when(cut & (F.col("__left") < k), F.col(f"__e_{n}")).otherwise(F.col(n)) for n, (_, k) in leads.items()},
    }
    return sliced.on(joined.withColumns(fixed).drop("__rn", "__left", *[f"__e_{n}" for n in fixed]))


def _add(before: Column, here: Column) -> Column:
    return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)


# inside a slice, over the summaries of earlier slices, and how the two meet
_FOLDS = {
    "sum": (F.sum, F.sum, _add),
    "count": (F.count, F.sum, _add),
    "max": (F.max, F.max, F.greatest),
    "min": (F.min, F.min, F.least),
}


def running(
    df: DataFrame,
    part: list[str],
    order: list[str],
    aggs: dict[str, tuple[str, str]],
    rows: bool = False,
) -> DataFrame:
    """Running ``sum``/``count``/``max``/``min``/``last`` per partition.

    ``aggs`` is ``{new_name: (function, column)}``. The frame is SQL's default: up to the
    current row and its ties. ``rows=True`` stops at the current row itself. ``last`` is the
    latest non-NULL value so far and needs an ascending order.
    """
    if rows or any(f == "last" for f, _ in aggs.values()):
        return cumulate(slice_hot_keys(df, part, order), aggs, rows).done()
    totals = {f"__t{i}": _FOLDS[f][0](c) for i, (f, c) in enumerate(aggs.values())}
    folds = {n: ("sum" if f == "count" else f, f"__t{i}") for i, (n, (f, _)) in enumerate(aggs.items())}
    plain = {n: _FOLDS[f][0](c) for n, (f, c) in aggs.items()}
    return _over_values(df, part, order, plain, totals, lambda values: cumulate(values, folds, rows=True))


def cumulate(sliced: Sliced, aggs: dict[str, tuple[str, str]], rows: bool) -> Sliced:
    """:func:`running` over slices."""
    w = sliced.window()
    start = Window.unboundedPreceding
    frame = w.rowsBetween(start, 0) if rows else w.rangeBetween(start, 0)

    def local(function: str, col: str) -> Column:
        return F.last(col, ignorenulls=True) if function == "last" else _FOLDS[function][0](col)

    out = sliced.df.withColumns({n: local(f, c).over(frame) for n, (f, c) in aggs.items()})
    if not sliced.split:
        return sliced.on(out)

    totals, combine, fixed = {}, {}, {}
    for i, (n, (f, c)) in enumerate(aggs.items()):
        t, b = f"__t{i}", f"__b{i}"
        if f == "last":
            if any(o.startswith("-") for o in sliced.order):
                raise ValueError("running 'last' needs an ascending order")
            totals[t] = F.max_by(c, F.struct(F.isnotnull(c).alias("known"), *sliced.order))
            combine[b] = F.last(t, ignorenulls=True)
            fixed[n] = F.coalesce(F.col(n), F.col(b))
        else:
            inside, over_slices, meet = _FOLDS[f]
            totals[t], combine[b] = inside(c), over_slices(t)
            fixed[n] = meet(F.col(b), F.col(n))
    joined = sliced.with_carry(out, sliced.carry(totals, combine))
    return sliced.on(joined.withColumns(fixed).drop(*combine))


def running_total(df: DataFrame, part: list[str], order: list[str], col: str, name: str = "running_total") -> DataFrame:
    return running(df, part, order, {name: ("sum", col)})


def top_n_per_group(df: DataFrame, group: list[str], order: list[str], n: int, name: str | None = None) -> DataFrame:
    """First ``n`` rows of each group.

    The filter on ``row_number`` makes Spark keep only ``n`` rows per group in every map
    task before the shuffle, so a hot group never travels whole.
    """
    rn = name or "__rn"
    w = Window.partitionBy(*group).orderBy(*sort_columns(order))
    kept = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return kept if name else kept.drop(rn)


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Newest row of each key; ``order`` ascending, its last row wins."""
    flipped = [n[1:] if n.startswith("-") else f"-{n}" for n in order]
    return top_n_per_group(df, key, flipped, 1)


def dense_key(df: DataFrame, cols: list[str], name: str = "key") -> DataFrame:
    """Number the distinct combinations 1..n in their own order."""
    return row_number(df.select(*cols).distinct(), [], cols, name)


def streak_batch(df: DataFrame, key: list[str], order: list[str], cond: str, name: str = "streak") -> DataFrame:
    """Consecutive rows up to here for which ``cond`` holds; 0 on a row where it does not.

    The streak is the distance to the last row that broke it, so no island of rows has to
    be gathered anywhere.
    """
    placed = numbered(slice_hot_keys(df, key, order), F.row_number(), "__at")
    broke = F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.col("__at"))
    marked = placed.on(placed.df.withColumn("__broke", broke))
    seen = cumulate(marked, {"__last": ("max", "__broke")}, rows=True)
    streak = F.col("__at") - F.coalesce("__last", F.lit(0))
    return seen.on(seen.df.withColumn(name, streak)).done("__at", "__broke", "__last")
