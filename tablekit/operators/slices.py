"""Order-preserving slices of hot keys.

A window over ``partitionBy(key)`` sends all rows of one key to one task. When a
key holds a large share of the table that task is the job. The functions here cut
such keys - and only those - into slices along the window order, so the window
runs per (key, slice) and a small summary per slice carries the running state
over the cuts. The cut points are samples of the data; any cut points give the
same result, they only decide how even the slices are. Sizes and cuts are tables
of their own, joined with the rows, so neither their number nor that of the hot
keys is limited.

Orders are lists of column names; a leading ``-`` means descending. NULL counts
as the smallest value, as in Spark's default ordering.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tablekit.storage import cut_lineage

ROWS_PER_SLICE = 5_000_000
ROWS_CONF = "tablekit.rowsPerSlice"
SAMPLES_PER_CUT = 24
#: Cuts that a row is compared with at once; more cuts take more levels of a search tree.
FAN_OUT = 64

SLICE = "__slice"
_ROWS = "__rows"


def sort_columns(order: list[str]) -> list[Column]:
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in order]


def order_names(order: list[str]) -> list[str]:
    return [n.removeprefix("-") for n in order]


def _before(a: Column, b: Column, down: bool) -> Column:
    """Whether ``a`` sorts strictly before ``b``; NULL is the smallest value."""
    small, large = (b, a) if down else (a, b)
    return (small.isNull() & large.isNotNull()) | F.coalesce(small < large, F.lit(False))


def _not_after(cut: Column, order: list[str]) -> Column:
    """Whether a cut's values ``o0, o1, ...`` sort before those of the row or equal them."""
    result = F.lit(True)
    for i, name in reversed(list(enumerate(order))):
        down, mine, its = name.startswith("-"), F.col(name.removeprefix("-")), cut[f"o{i}"]
        result = F.when(_before(its, mine, down), True).when(_before(mine, its, down), False).otherwise(result)
    return result


@dataclass(frozen=True)
class Sliced:
    """A table whose hot keys carry slice numbers; -1 marks keys left whole."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    split: bool

    def window(self) -> WindowSpec:
        by = [*self.keys, SLICE] if self.split else self.keys
        return Window.partitionBy(*by).orderBy(*sort_columns(self.order))

    def on(self, df: DataFrame) -> Sliced:
        """The same slices after columns were added to the table."""
        return replace(self, df=df)

    def done(self, *scratch: str) -> DataFrame:
        return self.df.drop(SLICE, *scratch)

    def hot(self) -> DataFrame:
        return self.df.filter(F.col(SLICE) >= 0)

    def carry(self, totals: dict[str, Column], combine: dict[str, Column]) -> DataFrame:
        """One row per hot (key, slice): state of all slices before it.

        ``totals`` summarises a slice, ``combine`` folds the summaries.
        """
        per_slice = self.hot().groupBy(*self.keys, SLICE).agg(
            *[c.alias(n) for n, c in totals.items()]
        )
        before = (
            Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        )
        return per_slice.select(
            *self.keys, SLICE, *[c.over(before).alias(n) for n, c in combine.items()]
        )

    def with_carry(self, df: DataFrame, carry: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
        """Attach carried columns to the rows of each slice."""
        names = [*self.keys, SLICE, *(extra_keys or [])]
        side = carry.select(*[F.col(c).alias(f"__c_{c}") if c in names else F.col(c) for c in carry.columns])
        on = F.lit(True)
        for c in names:
            on = on & F.col(c).eqNullSafe(F.col(f"__c_{c}"))
        return df.join(side, on, "left").drop(*[f"__c_{c}" for c in names])


def _rows_per_slice(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_CONF, str(ROWS_PER_SLICE)))


def same_keys(keys: list[str]) -> Column:
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return on


def _cuts(df: DataFrame, hot: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """Numbered cut values of each hot key: at least one, and about one per ``limit`` rows."""
    named = [f"__k{i}" for i in range(len(keys))]
    values = F.struct(*[F.col(n).alias(f"o{i}") for i, n in enumerate(order_names(order))])
    picked = df.filter(F.rand(17) < F.lit(SAMPLES_PER_CUT / limit)).join(hot, same_keys(keys))
    whole = Window.partitionBy(*named)
    ranked = picked.select(
        *named,
        _ROWS,
        values.alias("__o"),
        F.row_number().over(whole.orderBy(*sort_columns(order))).alias("__at"),
        F.count(F.lit(1)).over(whole).alias("__n"),
    )
    slices = F.ceil(F.col(_ROWS) / F.lit(limit))
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / slices))
    number = F.floor(F.col("__at") / step)
    return ranked.filter((F.col("__at") % step == 0) & (number < slices)).select(*named, number.alias("__no"), "__o")


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """The keys above the row limit as columns ``__k0, __k1, ...`` with their rows; None if there is none."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > _rows_per_slice(df))
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    hot = cut_lineage(sizes.select(*named, _ROWS), "hot-keys")
    return None if hot.isEmpty() else hot


def slice_hot_keys(df: DataFrame, keys: list[str], order: list[str]) -> Sliced:
    """Find the keys above the row limit and cut them along ``order``."""
    limit = _rows_per_slice(df)
    hot = hot_keys(df, keys)
    if hot is None:
        return Sliced(df, keys, order, split=False)
    cuts = cut_lineage(_cuts(df, hot, keys, order, limit), "cuts")

    # a search tree: on each level a row meets the cuts between two of the level above
    columns = [f"__k{i}" for i in range(len(keys))]
    most = cuts.agg(F.max("__no")).first()[0] or 0
    out = df.join(hot.select(*columns, F.lit(0).cast("long").alias(SLICE)), same_keys(keys), "left").drop(*columns)
    out = out.withColumn(SLICE, F.coalesce(SLICE, F.lit(-1)))
    width = 1
    while width * FAN_OUT <= most:
        width *= FAN_OUT
    while width:
        level = cuts.filter(F.col("__no") % width == 0).withColumn("__no", F.expr(f"__no div {width}"))
        level = level.filter(F.col("__no") % FAN_OUT != 0).groupBy(*columns, F.expr(f"__no div {FAN_OUT}").alias("__under")).agg(F.collect_list("__o").alias("__cuts"))
        passed = F.size(F.filter(F.coalesce("__cuts", F.array().cast(level.schema["__cuts"].dataType)), lambda c: _not_after(c, order)))
        out = out.join(level, same_keys(keys) & (F.col(SLICE) == F.col("__under")), "left")
        out = out.withColumn(SLICE, F.when(F.col(SLICE) >= 0, F.col(SLICE) * FAN_OUT + passed).otherwise(-1)).drop(*columns, "__under", "__cuts")
        width //= FAN_OUT
    return Sliced(out, keys, order, split=True)
