"""Data quality checks. A check returns the failing rows; no rows means it passed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablekit.operators import rows
from tablekit.operators.windows import latest_per_key, top_n_per_group
from tablekit.storage import cut_lineage


class CheckFailed(Exception):
    """A check that must hold did not."""


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: list[str], name: str = "copies") -> DataFrame:
    """Duplicated keys and how often they occur; NULL keys are not compared."""
    return rows.require(df, cols).groupBy(*cols).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def primary_key(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys that are duplicated or have a NULL part."""
    broken = F.lit(False)
    for c in cols:
        broken = broken | F.col(c).isNull()
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).filter((F.col("copies") > 1) | broken)


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows outside the set; NULL passes."""
    return df.filter(~F.col(col).isin(*values))


def row_rule(df: DataFrame, failing: Column | str) -> DataFrame:
    """Rows for which the failure condition is true."""
    return df.filter(failing)


@dataclass(frozen=True)
class Rule:
    """``on_fail``: ``warn`` keeps the row, ``drop`` removes it, ``fail`` stops the job."""

    name: str
    holds: str
    on_fail: str = "warn"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.holds), F.lit(False))


def expectations(df: DataFrame, rules: list[Rule], observe: Observation | None = None) -> DataFrame:
    """Apply rules in one pass.

    ``observe`` collects ``<rule>_passed`` and ``<rule>_failed`` while the result is
    computed. A failing ``fail`` rule raises from the task that meets the row, so nothing
    downstream of it is committed.
    """
    if observe is not None:
        counts = []
        for r in rules:
            counts += [
                F.count_if(r.passed()).alias(f"{r.name}_passed"),
                F.count_if(~r.passed()).alias(f"{r.name}_failed"),
            ]
        df = df.observe(observe, *counts)
    for r in rules:
        if r.on_fail == "fail":
            stop = F.raise_error(F.lit(f"expectation {r.name} failed")).cast("boolean")
            df = df.filter(F.when(r.passed(), F.lit(True)).otherwise(stop))
        elif r.on_fail == "drop":
            df = df.filter(r.passed())
        elif r.on_fail != "warn":
            raise ValueError(f"unknown action {r.on_fail!r}")
    return df


def expectation_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: action, rows that passed and failed. One aggregate, one row per rule."""
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.on_fail).alias("on_fail"),
            F.count_if(r.passed()).alias("passed"),
            F.count_if(~r.passed()).alias("failed"),
        )
        for r in rules
    ]
    return df.agg(F.array(*lines).alias("__r")).select(F.inline("__r"))


def non_empty(df: DataFrame, what: str = "table") -> DataFrame:
    """The table itself, or an error if it has no rows."""
    if df.isEmpty():
        raise CheckFailed(f"{what} is empty")
    return df


def min_score(df: DataFrame, score: Column, threshold: float, what: str = "score") -> float:
    """The aggregate score, or an error below the threshold."""
    value = df.agg(score.alias("s")).first()[0]
    if value is None or value < threshold:
        raise CheckFailed(f"{what} is {value}, below {threshold}")
    return value


def relationship(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose set key has no parent."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


#: Groups of keys whose checksums are compared before rows are.
RECONCILE_BUCKETS = 1 << 14


def reconcile(src: DataFrame, dst: DataFrame, keys: list[str], buckets: int = RECONCILE_BUCKETS) -> DataFrame:
    """One row: row counts, keys missing from and keys extra in the destination.

    Either side is first summed up in its tasks: for each bucket of keys the number of rows and
    two checksums of the keys' hashes. Only buckets that differ are looked at key by key, so
    of equal tables no row is shuffled.
    """
    a, b = _bucket_sums(src, keys, buckets), _bucket_sums(dst, keys, buckets)
    same = F.lit(True)
    for c in ("n", "total", "parity"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    # at most one row per bucket
    sums = a.alias("l").join(b.alias("r"), "bucket", "full_outer").select("bucket", F.col("l.n").alias("a"), F.col("r.n").alias("b"), same.alias("same"))
    sums = cut_lineage(sums, "bucket-sums")
    totals = sums.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("rows_in_source"), F.coalesce(F.sum("b"), F.lit(0)).alias("rows_in_destination"))
    differing = sums.filter("not same").select("bucket")
    if differing.isEmpty():
        none = F.lit(0).cast("long")
        return totals.select("*", none.alias("missing_keys"), none.alias("extra_keys"))

    def keyed(df: DataFrame) -> DataFrame:
        rows = df.select(*keys, _bucket(keys, buckets).alias("bucket")).join(F.broadcast(differing), "bucket", "left_semi")
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    both = keyed(src).alias("l").join(keyed(dst).alias("r"), on, "full_outer")
    found = both.agg(F.count_if(F.col("r.n").isNull()).alias("missing_keys"), F.count_if(F.col("l.n").isNull()).alias("extra_keys"))
    return totals.select("*", *[found.select(c).scalar().alias(c) for c in found.columns])


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _bucket_sums(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    mark = F.xxhash64(F.lit(1), *keys)
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(mark.cast("decimal(20,0)")).alias("total"), F.bit_xor(mark).alias("parity")
    )


RUN_LOG_SCHEMA = (
    "table_name STRING, status STRING, rows_in_source BIGINT, rows_loaded BIGINT, "
    "logged_at TIMESTAMP_NTZ, seq BIGINT"
)

# The states of a run, in order.
RUN_STATES = ["PENDING", "IN_PROGRESS", "DONE", "FAILED"]


# After these states a table is not opened again.
BLOCKING_STATES = ("PENDING", "IN_PROGRESS", "DONE")


def run_log(log: DataFrame, entries: DataFrame, blocking: tuple[str, ...] = BLOCKING_STATES) -> DataFrame:
    """Append entries. A PENDING entry is skipped if its table's newest entry is in a blocking state.

    Of several PENDING entries of one table the first enters.
    """
    blocked = latest_run(log).filter(F.col("status").isin(*blocking)).select("table_name")
    pending = top_n_per_group(entries.filter(F.col("status") == "PENDING"), ["table_name"], ["logged_at", "seq"], 1)
    opens = pending.join(blocked, "table_name", "left_anti")
    rest = entries.filter(F.col("status") != "PENDING")
    return log.unionByName(opens.unionByName(rest))


def latest_run(log: DataFrame) -> DataFrame:
    """Newest entry of each table."""
    return latest_per_key(log, ["table_name"], ["logged_at", "seq"])


def stage_metrics(df: DataFrame, stage: str, status: Column) -> DataFrame:
    """Records by stage and status."""
    return df.groupBy(F.lit(stage).alias("stage"), status.alias("status")).agg(F.count(F.lit(1)).alias("records"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass through, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen
