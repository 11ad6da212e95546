"""Publishing a table only after it was checked."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit import storage
from tablekit.operators import history

CHECK_FAILED, EMPTY, UNCHANGED, PUBLISHED = "check failed", "empty", "unchanged", "published"


@dataclass(frozen=True)
class Outcome:
    status: str
    note: str
    changes: dict[str, int]


def write_audit_publish(
    df: DataFrame,
    checks: dict[str, Callable[[DataFrame], DataFrame]],
    target: str,
    keys: list[str],
    note: str,
) -> Outcome:
    """Stage, check, compare with the published table, and swap in if it is worth it.

    A check returns failing rows. Nothing is published when the table is empty, a check
    fails, or no row differs. Readers see the old table until the swap.
    """
    spark = df.sparkSession
    staged = f"{target}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    table = spark.read.schema(df.schema).parquet(staged)

    def stop(status: str, changes: dict[str, int]) -> Outcome:
        storage.delete(spark, staged)
        return Outcome(status, note, changes)

    if table.isEmpty():
        return stop(EMPTY, {})
    for check in checks.values():
        if not check(table).isEmpty():
            return stop(CHECK_FAILED, {})
    changes = _compare(spark, table, target, keys)
    if not sum(changes.values()):
        return stop(UNCHANGED, changes)
    storage.swap_in(spark, staged, target)
    return Outcome(PUBLISHED, note, changes)


def _compare(spark: SparkSession, table: DataFrame, target: str, keys: list[str]) -> dict[str, int]:
    counts = {"added": 0, "removed": 0, "changed": 0}
    if not storage.exists(spark, target):
        return {**counts, "added": table.count()}
    published = spark.read.parquet(target)
    found = history.diff_tables(published, table, keys).groupBy("diff").agg(F.count(F.lit(1)).alias("n"))
    # at most three rows
    return {**counts, **{r["diff"]: r["n"] for r in found.collect()}}


def backfill(build: Callable[[str, str], DataFrame], path: str, day: str, from_day: str, to_day: str) -> None:
    """Rebuild every day of a range in one job and replace just those day directories.

    A day the build leaves empty loses its directory, so a repeated run always ends in the
    same state. The new days are complete before the first old one goes.
    """
    df = build(from_day, to_day)
    inside = F.col(day).between(F.lit(from_day).cast("date"), F.lit(to_day).cast("date"))
    stray = F.raise_error(F.lit(f"the build returned days outside {from_day}..{to_day}")).cast("boolean")
    checked = df.filter(F.when(inside, F.lit(True)).otherwise(stray))
    spark = df.sparkSession
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    # as many tasks as a shuffle has may write a day, since one day can hold most rows
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    checked.repartition(day, F.pmod(F.xxhash64(*df.columns), F.lit(tasks))).write.partitionBy(day).parquet(staged)
    prefix = f"{day}="

    def in_range(name: str) -> bool:
        return name.startswith(prefix) and from_day <= name[len(prefix) :] <= to_day

    storage.move_directories(spark, staged, path, in_range)
