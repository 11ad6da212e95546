"""State-to-state operators: upserts, conditional merges and change application.

Targets hold one row per key. Sources are reduced to one row per key before they are
joined, and that reduction happens in the map tasks, so a key that dominates the source
does not dominate a task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.windows import latest_per_key


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Source rows replace target rows of the same key; the rest is kept or inserted.

    Only the newest source row of each key counts: the last by ``order``, or else the last by
    the other columns in their sequence. NULL keys match nothing.
    """
    newest = latest_per_key(source, keys, order or _others(source, keys))
    kept = target.join(newest.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


def _others(df: DataFrame, keys: list[str]) -> list[str]:
    """The columns beside the keys that can be sorted by; a map cannot."""
    names = [c for c, kind in df.dtypes if c not in keys and "map<" not in kind]
    return names or keys


def upsert_if(target: DataFrame, source: DataFrame, keys: list[str], newer: str) -> DataFrame:
    """Update only where the source's ``newer`` column is greater; insert unmatched rows."""
    return general(
        target,
        latest_per_key(source, keys, [newer]),
        keys,
        [
            When.matched(F.col(f"s.{newer}") > F.col(f"t.{newer}")).update_all(),
            When.not_matched().insert_all(),
        ],
        single=True,
    )


def insert_only(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Add rows whose key is new; never touch an existing row."""
    first = latest_per_key(source, keys, order) if order else source
    fresh = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


@dataclass(frozen=True)
class When:
    """One clause of a merge. Conditions name the sides ``t.col`` and ``s.col``."""

    is_match: bool
    condition: Column | None = None
    action: str = ""
    values: dict[str, Column] = field(default_factory=dict)

    @classmethod
    def matched(cls, condition: Column | None = None) -> When:
        return cls(True, condition)

    @classmethod
    def not_matched(cls, condition: Column | None = None) -> When:
        return cls(False, condition)

    def update_all(self) -> When:
        return When(self.is_match, self.condition, "all")

    def update(self, **values: Column) -> When:
        return When(self.is_match, self.condition, "set", values)

    def delete(self) -> When:
        return When(self.is_match, self.condition, "delete")

    def insert_all(self) -> When:
        return When(self.is_match, self.condition, "all")

    def insert(self, **values: Column) -> When:
        return When(self.is_match, self.condition, "set", values)


def general(target: DataFrame, source: DataFrame, keys: list[str], clauses: list[When], single: bool = False) -> DataFrame:
    """Merge with ordered clauses; the first one that holds decides a row.

    Matched rows without a clause stay, unmatched source rows without one are ignored. Two
    source rows for one target row are an error, raised when the result is computed. With
    ``single`` the source is known to have one row per key and is not counted.
    """
    columns = target.columns
    for clause in clauses:
        if clause.is_match is False and clause.action == "delete":
            raise ValueError("an unmatched row cannot be deleted")
    if single:
        source = source.withColumn("__copies", F.lit(1).cast("long"))
    else:
        counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies")).filter("__copies > 1")
        source = source.join(counts, keys, "left")
    t = target.withColumn("__in_t", F.lit(True)).alias("t")
    s = source.withColumn("__in_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")

    in_t = F.col("t.__in_t").isNotNull()
    in_s = F.col("s.__in_s").isNotNull()
    pick = F.lit(-1)
    for i, clause in reversed(list(enumerate(clauses))):
        holds = in_s & in_t if clause.is_match else in_s & ~in_t
        if clause.condition is not None:
            holds = holds & F.coalesce(clause.condition, F.lit(False))
        pick = F.when(holds, F.lit(i)).otherwise(pick)
    ambiguous = in_t & F.coalesce(F.col("s.__copies") > 1, F.lit(False))
    checked = F.when(ambiguous, F.raise_error(F.lit("several source rows match one target row"))).otherwise(pick)
    decided = joined.withColumn("__clause", checked.cast("int"))

    def value(name: str) -> Column:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}") if name in source.columns else F.lit(None)
        out = old
        for i, clause in reversed(list(enumerate(clauses))):
            if clause.action == "all":
                chosen = new
            elif clause.action == "set":
                chosen = clause.values.get(name, old if clause.is_match else F.lit(None))
            else:
                continue
            out = F.when(F.col("__clause") == i, chosen).otherwise(out)
        return out.cast(target.schema[name].dataType).alias(name)

    deletes = [i for i, c in enumerate(clauses) if c.action == "delete"]
    stays = (F.col("__clause") >= 0) | in_t
    if deletes:
        stays = stays & ~F.col("__clause").isin(*deletes)
    return decided.filter(stays).select(*[value(c) for c in columns])


def apply_cdc(target: DataFrame, feed: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """Apply the newest event of each key: D deletes, U updates, I inserts.

    An update without a target row and an insert onto an existing one are ignored.
    """
    return general(
        target,
        latest_per_key(feed, keys, order),
        keys,
        [
            When.matched(F.col(f"s.{op}") == "D").delete(),
            When.matched(F.col(f"s.{op}") == "U").update_all(),
            When.not_matched(F.col(f"s.{op}") == "I").insert_all(),
        ],
        single=True,
    )


def update(df: DataFrame, cond: Column | str, set_: dict[str, Column]) -> DataFrame:
    """New values where the condition is true; all are computed from the old row."""
    test = F.expr(cond) if isinstance(cond, str) else cond
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: F.when(test, v.cast(types[c])).otherwise(F.col(c)) for c, v in set_.items()})


def delete(df: DataFrame, cond: Column | str) -> DataFrame:
    """Drop rows for which the condition is true; unknown keeps the row."""
    test = F.expr(cond) if isinstance(cond, str) else cond
    return df.filter(~F.coalesce(test, F.lit(False)))


def newer_than_target(target: DataFrame, batch: DataFrame, cursor: str, lag_seconds: int = 0) -> DataFrame:
    """Batch rows past the target's largest cursor value.

    Without lag the comparison is strict; a lag reaches back for late rows and includes its
    lower end. An empty target takes everything.
    """
    top = target.agg(F.max(cursor).alias("top")).scalar()
    if lag_seconds:
        back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lag_seconds))
        return batch.filter(top.isNull() | (F.col(cursor) >= top - back))
    return batch.filter(top.isNull() | (F.col(cursor) > top))


def write_disposition(
    target: DataFrame,
    batch: DataFrame,
    how: str,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    cursor: str | None = None,
    lag_seconds: int = 0,
    tracked: list[str] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """``append``, ``replace``, ``merge``, ``upsert``, ``insert-only`` or ``scd2``.

    ``cursor`` limits the batch to rows newer than the target. ``merge`` and ``upsert``
    take the newest batch row per key. ``scd2`` expects a target in dimension form.
    """
    from tablekit.operators import scd

    if cursor:
        batch = newer_than_target(target, batch, cursor, lag_seconds)
    if how == "append":
        return target.unionByName(batch)
    if how == "replace":
        return batch
    if not keys:
        raise ValueError(f"{how} needs keys")
    if how in ("merge", "upsert"):
        return upsert(target, batch, keys, order)
    if how == "insert-only":
        return insert_only(target, batch, keys, order)
    if how == "scd2":
        return scd.type2_apply(target, batch, keys, tracked or [], as_of)
    raise ValueError(f"unknown write disposition {how!r}")


def incremental_model(
    target: DataFrame | None,
    query: DataFrame,
    how: str = "append",
    unique_key: list[str] | None = None,
    cursor: str | None = None,
    order: list[str] | None = None,
    lag_seconds: int = 0,
) -> DataFrame:
    """First run: the query in full. Later: only rows newer than the target, appended or merged."""
    if target is None:
        return query
    fresh = newer_than_target(target, query, cursor, lag_seconds) if cursor else query
    if how == "append":
        return target.unionByName(fresh)
    if how == "merge":
        return upsert(target, fresh, unique_key, order)
    raise ValueError("append or merge")
