"""Queries over a change log: ``(key..., payload..., op, version, commit_ts, seq)``.

``op`` is I, U or D. ``order`` lists the columns that order the changes of one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.windows import latest_per_key


@dataclass(frozen=True)
class Log:
    """A change log and the roles of its columns."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    op: str = "op"
    version: str = "version"
    ts: str = "commit_ts"
    horizon: object = None

    @property
    def payload(self) -> list[str]:
        meta = {*self.keys, *self.order, self.op, self.version, self.ts}
        return [c for c in self.df.columns if c not in meta]


def as_of(log: Log, version=None, timestamp=None) -> DataFrame:
    """The table as it was at a version or time: newest change per key, deletions left out.

    Asking for a version older than an expired log's horizon is an error.
    """
    if (version is None) == (timestamp is None):
        raise ValueError("give a version or a timestamp")
    if version is not None:
        if log.horizon is not None and version < log.horizon:
            raise ValueError(f"version {version} was expired; history starts at {log.horizon}")
        seen = log.df.filter(F.col(log.version) <= F.lit(version))
    else:
        if log.horizon is not None:
            start = log.df.filter(F.col(log.version) >= F.lit(log.horizon)).agg(F.min(log.ts)).first()[0]
            if start is not None and timestamp < start:
                raise ValueError(f"{timestamp} was expired; history starts at {start}")
        seen = log.df.filter(F.col(log.ts) <= F.lit(timestamp))
    newest = latest_per_key(seen, log.keys, log.order)
    return newest.filter(F.col(log.op) != "D").select(*log.keys, *log.payload)


def _sides(log: Log, v1, v2) -> DataFrame:
    """Both states of each key from one pass over the log: the newest change up to either version."""
    for version in (v1, v2):
        if log.horizon is not None and version < log.horizon:
            raise ValueError(f"version {version} was expired; history starts at {log.horizon}")
    row, place = F.struct(F.col(log.op).alias("op"), F.struct(*log.payload).alias("row")), F.struct(*log.order)

    def newest(version) -> Column:
        return F.max_by(row, F.when(F.col(log.version) <= F.lit(version), place))

    def state(change: str) -> Column:
        return F.when(F.col(change)["op"] != "D", F.col(change)["row"])

    seen = log.df.filter(F.col(log.version) <= F.lit(max(v1, v2)))
    changes = seen.groupBy(*log.keys).agg(newest(v1).alias("__v1"), newest(v2).alias("__v2"))
    both = changes.select(*log.keys, state("__v1").alias("__old"), state("__v2").alias("__new"))
    kind = (
        F.when(F.col("__old").isNull(), "added")
        .when(F.col("__new").isNull(), "removed")
        .when(F.col("__old") != F.col("__new"), "changed")
    )
    same = F.col("__old").eqNullSafe(F.col("__new"))
    return both.filter(~same).withColumn("diff", F.coalesce(kind, F.lit("changed")))


def diff(log: Log, v1, v2) -> DataFrame:
    """Rows added, removed or changed from ``v1`` to ``v2``, with the values of ``v2`` (``v1``'s if removed)."""
    value = F.coalesce("__new", "__old")
    return _sides(log, v1, v2).select(*log.keys, *[value[c].alias(c) for c in log.payload], "diff")


def diff_tables(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The same comparison for two plain tables."""
    payload = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(*payload).alias("__old"))
    b = new.select(*keys, F.struct(*payload).alias("__new"))
    both = a.join(b, keys, "full_outer").filter(~F.col("__old").eqNullSafe(F.col("__new")))
    kind = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").otherwise("changed")
    value = F.coalesce("__new", "__old")
    return both.select(*keys, *[value[c].alias(c) for c in payload], kind.alias("diff"))


def restore_changes(log: Log, to, now) -> DataFrame:
    """The change rows that bring state ``now`` back to state ``to``."""
    op = F.when(F.col("diff") == "added", "I").when(F.col("diff") == "removed", "D").otherwise("U")
    value = F.coalesce("__new", "__old")
    return _sides(log, now, to).select(
        *log.keys, *[value[c].alias(c) for c in log.payload], op.alias(log.op)
    )


def restore(log: Log, to, now, version, timestamp, seq_from: Column | int = 0) -> DataFrame:
    """Append the restoring changes as a new version; history stays as it is."""
    types = {f.name: f.dataType for f in log.df.schema}
    stamp = {log.version: F.lit(version), log.ts: F.lit(timestamp)}
    for c in log.order:
        stamp.setdefault(c, F.lit(seq_from) if isinstance(seq_from, int) else seq_from)
    fresh = restore_changes(log, to, now).withColumns({c: v.cast(types[c]) for c, v in stamp.items()})
    return log.df.unionByName(fresh.select(*log.df.columns))


def describe(log: Log) -> DataFrame:
    """One row per version: last commit time, row counts by kind of change."""
    op = F.col(log.op)
    inserted, updated, deleted = F.count_if(op == "I"), F.count_if(op == "U"), F.count_if(op == "D")
    return log.df.groupBy(log.version).agg(
        F.max(log.ts).alias("committed_at"),
        F.when((updated == 0) & (deleted == 0), "APPEND").otherwise("MERGE").alias("operation"),
        inserted.alias("rows_inserted"),
        updated.alias("rows_updated"),
        deleted.alias("rows_deleted"),
    )


def expire(log: Log, retain_from) -> Log:
    """Drop changes superseded before ``retain_from``; states from there on are unchanged.

    The newest change per key up to the horizon stays as the base, unless it is a deletion.
    """
    old = F.col(log.version) <= F.lit(retain_from)
    base = latest_per_key(log.df.filter(old), log.keys, log.order).filter(F.col(log.op) != "D")
    kept = base.unionByName(log.df.filter(~old))
    return Log(kept, log.keys, log.order, log.op, log.version, log.ts, horizon=retain_from)


def changes(log: Log, from_, to) -> DataFrame:
    """Changes committed in versions ``from_`` to ``to``, both included."""
    return log.df.filter(F.col(log.version).between(from_, to))
