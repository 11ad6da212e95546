"""Merges, change feeds, history, dimensions and publishing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import ORACLES, check
from checks.s09_streams import CDC
from tablekit.operators import evolve, history, merge, publish, quality, scd
from tablekit.operators.buckets import BucketTable
from tablekit.sources import io


def newest(where: str, cols: str = "k, state, amount") -> str:
    return (
        f"select {cols} from (select *, row_number() over (partition by k order by commit_ts desc, seq desc) as rn "
        f"from fx_changes where {where}) where rn = 1"
    )


T10 = newest("version <= 10") + " and op <> 'D'"
SRC = newest("version > 10", "k, state, amount, op, commit_ts")


def log(t):
    return history.Log(t.fx_changes, ["k"], ["commit_ts", "seq"])


def target(t):
    return history.as_of(log(t), version=10)


def feed(t):
    return t.fx_changes.filter("version > 10")


@check(
    "s11_01_upsert",
    f"with t as ({T10}), s as ({SRC}) select * from t where k not in (select k from s) union all select k, state, amount from s",
    "fx_changes",
)
def upsert(t):
    return merge.upsert(target(t), feed(t), ["k"], ["commit_ts", "seq"])


@check(
    "s11_01_upsert_buckets",
    f"with t as ({T10}), s as ({SRC}) select * from t where k not in (select k from s) union all select k, state, amount from s",
    "fx_changes",
)
def upsert_buckets(t):
    table = BucketTable(t.dir("buckets"), ["k"], 8)
    table.create(target(t))
    for _ in range(2):
        table.upsert(feed(t), ["commit_ts", "seq"])
    return table.read(t.spark)


@check(
    "s11_06_update_buckets",
    "select o_orderkey, case when o_orderstatus = 'F' then o_totalprice * 1.5 else o_totalprice end as o_totalprice from orders where o_orderkey >= 500",
)
def update_buckets(t):
    table = BucketTable(t.dir("buckets"), ["o_orderkey"], 8)
    table.create(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"))
    table.update(t.spark, "o_orderstatus = 'F'", {"o_totalprice": F.col("o_totalprice") * 1.5})
    table.delete(t.spark, "o_orderkey < 500")
    return table.read(t.spark).drop("o_orderstatus")


@check(
    "s11_02_upsert_if",
    f"""with t as ({T10}), s as (select k, state, amount from (select *, row_number() over (partition by k order by amount desc) as rn
      from fx_changes where version > 10) where rn = 1)
    select coalesce(t.k, s.k) as k, case when t.k is null or s.amount > t.amount then s.amount else t.amount end as amount
    from t full join s on t.k = s.k""",
    "fx_changes",
)
def upsert_if(t):
    source = feed(t).groupBy("k").agg(F.max("amount").alias("amount"))
    return merge.upsert_if(target(t).select("k", "amount"), source, ["k"], "amount")


@check(
    "s11_03_insert_only",
    f"with t as ({T10}), s as ({SRC}) select * from t union all select k, state, amount from s where k not in (select k from t)",
    "fx_changes",
)
def insert_only(t):
    return merge.insert_only(target(t), feed(t), ["k"], ["commit_ts", "seq"])


@check(
    "s11_04_general",
    f"""with t as ({T10}), s as ({SRC})
    select coalesce(t.k, s.k) as k, case when t.k is null then 'new' else t.state end as state,
      case when t.k is null then s.amount when s.amount > t.amount then t.amount + s.amount else t.amount end as amount
    from t full join s on t.k = s.k
    where not (t.k is not null and s.k is not null and s.amount < 5) and not (t.k is null and s.amount <= 10)""",
    "fx_changes",
)
def general(t):
    source = merge.latest_per_key(feed(t), ["k"], ["commit_ts", "seq"]).select("k", "state", "amount")
    return merge.general(
        target(t),
        source,
        ["k"],
        [
            merge.When.matched(F.col("s.amount") < 5).delete(),
            merge.When.matched(F.col("s.amount") > F.col("t.amount")).update(amount=F.col("t.amount") + F.col("s.amount")),
            merge.When.not_matched(F.col("s.amount") > 10).insert(k=F.col("s.k"), state=F.lit("new"), amount=F.col("s.amount")),
        ],
    )


@check("s11_05_apply_cdc", CDC, "fx_changes")
def apply_cdc(t):
    return merge.apply_cdc(target(t), t.fx_changes.filter("version > 10"), ["k"], ["commit_ts", "seq"])


@check("s11_06_update", "select o_orderkey, case when o_orderstatus = 'F' then o_totalprice * 1.5 else o_totalprice end as o_totalprice from orders")
def update(t):
    out = merge.update(t.orders, "o_orderstatus = 'F'", {"o_totalprice": F.col("o_totalprice") * 1.5})
    return out.select("o_orderkey", "o_totalprice")


@check("s11_07_delete", "select id, status_code from fx_checks where not coalesce(status_code >= 400, false)", "fx_checks")
def delete(t):
    return merge.delete(t.fx_checks, "status_code >= 400").select("id", "status_code")


@check(
    "s11_08_write_disposition",
    f"""with t as ({T10}), b as ({newest('version > 10')})
    select 'append' as how, * from t union all select 'append', * from b
    union all select 'replace', * from b
    union all select 'merge', * from t where k not in (select k from b) union all select 'merge', * from b
    union all select 'upsert', * from t where k not in (select k from b) union all select 'upsert', * from b
    union all select 'insert-only', * from t union all select 'insert-only', * from b where k not in (select k from t)""",
    "fx_changes",
)
def write_disposition(t):
    base = target(t)
    batch = merge.latest_per_key(feed(t), ["k"], ["commit_ts", "seq"]).select(*base.columns)
    out = None
    for how in ("append", "replace", "merge", "upsert", "insert-only"):
        one = merge.write_disposition(base, batch, how, keys=["k"]).select(F.lit(how).alias("how"), *base.columns)
        out = one if out is None else out.unionByName(one)
    return out


@check(
    "s11_08_cursor_with_lag",
    "with t as (select * from fx_changes where version <= 10) select seq, k, version from t union all select seq, k, version from fx_changes "
    "where commit_ts >= (select max(commit_ts) - interval 3600 second from t)",
    "fx_changes",
)
def cursor_with_lag(t):
    base = t.fx_changes.filter("version <= 10")
    out = merge.write_disposition(base, t.fx_changes, "append", cursor="commit_ts", lag_seconds=3600)
    return out.select("seq", "k", "version")


DAILY = "select o_orderdate::date as day, count(*) as orders from orders group by 1"


@check("s11_09_incremental_append", DAILY)
def incremental_append(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    first = merge.incremental_model(None, daily.filter("day < '1998-01-01'"), cursor="day")
    path = t.dir("incremental")
    io.write_parquet(first, path)
    return merge.incremental_model(io.read_parquet(t.spark, path), daily, cursor="day")


@check(
    "s11_09_incremental_merge",
    f"""with s as ({newest("version > 10")}), b as ({newest("version <= 10")})
    select k, amount from b where k not in (select k from s) union all select k, amount from s""",
    "fx_changes",
)
def incremental_merge(t):
    first = merge.latest_per_key(t.fx_changes.filter("version <= 10"), ["k"], ["commit_ts", "seq"])
    path = t.dir("incremental-merge")
    io.write_parquet(first, path)
    built = io.read_parquet(t.spark, path)
    out = merge.incremental_model(built, t.fx_changes, "merge", ["k"], "commit_ts", ["commit_ts", "seq"])
    return out.select("k", "amount")


# --- history ----------------------------------------------------------------


@check("s11_10_as_of_version", T10, "fx_changes")
def as_of_version(t):
    return target(t)


@check("s11_10_as_of_timestamp", newest("commit_ts <= timestamp '2024-01-18 06:00:00'") + " and op <> 'D'", "fx_changes")
def as_of_timestamp(t):
    return history.as_of(log(t), timestamp=datetime(2024, 1, 18, 6))


T20 = newest("version <= 20") + " and op <> 'D'"


@check(
    "s11_11_diff",
    f"""with a as ({T10}), b as ({T20})
    select coalesce(b.k, a.k) as k, coalesce(b.state, a.state) as state, coalesce(b.amount, a.amount) as amount,
      case when a.k is null then 'added' when b.k is null then 'removed' else 'changed' end as diff
    from a full join b on a.k = b.k where a.k is null or b.k is null or a.state <> b.state or a.amount <> b.amount""",
    "fx_changes",
)
def diff(t):
    return history.diff(log(t), 10, 20)


@check("s11_12_restore", T10, "fx_changes")
def restore(t):
    whole = log(t)
    restored = history.restore(whole, to=10, now=31, version=32, timestamp=datetime(2024, 2, 1), seq_from=10**12)
    return history.as_of(history.Log(restored, ["k"], ["commit_ts", "seq"]), version=32)


@check(
    "s11_12_restore_changes",
    f"""with a as ({T20}), b as ({T10})
    select coalesce(b.k, a.k) as k, coalesce(b.amount, a.amount) as amount,
      case when a.k is null then 'I' when b.k is null then 'D' else 'U' end as op
    from a full join b on a.k = b.k where a.k is null or b.k is null or a.state <> b.state or a.amount <> b.amount""",
    "fx_changes",
)
def restore_changes(t):
    return history.restore_changes(log(t), to=10, now=20).select("k", "amount", "op")


@check(
    "s11_13_describe",
    """select version, max(commit_ts) as committed_at, case when count(*) filter (op <> 'I') = 0 then 'APPEND' else 'MERGE' end as operation,
      count(*) filter (op = 'I') as rows_inserted, count(*) filter (op = 'U') as rows_updated, count(*) filter (op = 'D') as rows_deleted
    from fx_changes group by version""",
    "fx_changes",
)
def describe(t):
    return history.describe(log(t))


@check(
    "s11_14_expire",
    f"""select 'log' as what, count(*) as rows, sum(seq)::bigint as total from (
      (select seq from fx_changes where version > 15) union all ({newest("version <= 15", "seq")} and op <> 'D'))
    union all select 'state', count(*), sum(k)::bigint from ({T20})""",
    "fx_changes",
)
def expire(t):
    kept = history.expire(log(t), 15)
    state = history.as_of(kept, version=20)
    a = kept.df.agg(F.lit("log").alias("what"), F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("total"))
    return a.union(state.agg(F.lit("state"), F.count(F.lit(1)), F.sum("k")))


@check("s11_15_changes", "select k, state, amount, op, version from fx_changes where version between 5 and 8", "fx_changes")
def changes(t):
    return history.changes(log(t), 5, 8).select("k", "state", "amount", "op", "version")


TYPE2 = """with s as (select k, state, commit_ts, seq, lag(state) over (partition by k order by commit_ts, seq) as before,
      row_number() over (partition by k order by commit_ts, seq) as rn from fx_changes{where}),
    v as (select * from s where rn = 1 or state is distinct from before)
  select k, state, commit_ts as valid_from, lead(commit_ts) over (partition by k order by commit_ts, seq) as valid_to,
    lead(commit_ts) over (partition by k order by commit_ts, seq) is null as is_current from v"""


@check("s11_16_type2_from_changes", TYPE2.format(where=""), "fx_changes")
def type2(t):
    return scd.type2_from_changes(t.fx_changes, ["k"], ["commit_ts", "seq"], ["state"]).drop("version_id")


@check(
    "s11_17_type2_apply",
    f"""with d as ({TYPE2.format(where=" where version <= 10")}), b as ({newest("version > 10", "k, state, commit_ts")}),
    m as (select d.*, b.state as new_state, b.commit_ts as closed_at from d left join b on d.k = b.k and d.is_current and d.state <> b.state)
    select k, state, valid_from, coalesce(closed_at, valid_to) as valid_to, is_current and closed_at is null as is_current from m
    union all select k, new_state, closed_at, null, true from m where closed_at is not null
    union all select k, state, commit_ts, null, true from b where k not in (select k from d)""",
    "fx_changes",
)
def type2_apply(t):
    dim = scd.type2_from_changes(t.fx_changes.filter("version <= 10"), ["k"], ["commit_ts", "seq"], ["state"]).drop("version_id")
    batch = merge.latest_per_key(feed(t), ["k"], ["commit_ts", "seq"])
    return scd.type2_apply(dim, batch, ["k"], ["state"], F.col("commit_ts"))


@check("s11_08_write_disposition_scd2", ORACLES["s11_17_type2_apply"])
def write_disposition_scd2(t):
    dim = scd.type2_from_changes(t.fx_changes.filter("version <= 10"), ["k"], ["commit_ts", "seq"], ["state"]).drop("version_id")
    batch = merge.latest_per_key(feed(t), ["k"], ["commit_ts", "seq"])
    return merge.write_disposition(dim, batch, "scd2", ["k"], tracked=["state"], as_of=F.col("commit_ts"))


@check(
    "s11_18_current",
    f"select k, state, valid_from from ({TYPE2.format(where='')}) where valid_to is null",
    "fx_changes",
)
def current(t):
    dim = scd.type2_from_changes(t.fx_changes, ["k"], ["commit_ts", "seq"], ["state"])
    return scd.current(dim).select("k", "state", "valid_from")


# --- schemas and publishing -------------------------------------------------


@check("s11_19_enforce", "select c_custkey, c_name, c_acctbal from customer")
def enforce(t):
    table = t.customer.select("c_custkey", "c_name", "c_acctbal")
    rejected = 0
    for bad in (table.withColumn("extra", F.lit(1)), table.withColumn("c_acctbal", F.col("c_acctbal").cast("string"))):
        try:
            evolve.enforce(bad, table.schema)
        except evolve.SchemaMismatch:
            rejected += 1
    assert rejected == 2
    return evolve.enforce(table.select("c_acctbal", "c_custkey", "c_name"), table.schema)


@check(
    "s11_20_merge_schema",
    """select c_custkey as id, n_name as city, n_regionkey as region, null::int as zipcode, null as tier from customer join nation on c_nationkey = n_nationkey
    union all select s_suppkey, n_name, null, n_nationkey, 'gold' from supplier join nation on s_nationkey = n_nationkey""",
)
def merge_schema(t):
    n = t.nation
    old = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"), F.struct(F.col("n_name").alias("city"), F.col("n_regionkey").alias("region")).alias("address")
    )
    new = t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id"),
        F.struct(F.col("n_name").alias("city"), F.col("n_nationkey").alias("zipcode")).alias("address"),
        F.lit("gold").alias("tier"),
    )
    return evolve.merge_schema(old, new).select("id", "address.city", "address.region", "address.zipcode", "tier")


@check("s11_21_write_audit_publish", "select o_orderkey, o_totalprice * 2 as o_totalprice from orders")
def write_audit_publish(t):
    path = t.dir("published")
    orders = t.orders.select("o_orderkey", "o_totalprice")
    checks = {"key": lambda df: quality.unique(df, ["o_orderkey"]), "price": lambda df: quality.row_rule(df, "o_totalprice < 0")}
    doubled = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    steps = [
        (orders, publish.PUBLISHED),
        (orders, publish.UNCHANGED),
        (orders.filter("o_orderkey is null"), publish.EMPTY),
        (orders.withColumn("o_totalprice", F.lit(-1.0)), publish.CHECK_FAILED),
        (doubled, publish.PUBLISHED),
    ]
    for df, status in steps:
        got = publish.write_audit_publish(df, checks, path, ["o_orderkey"], "nightly")
        assert got.status == status, got
    return io.read_parquet(t.spark, path)


@check(
    "s11_22_backfill",
    "select ts::date as day, count(*) filter (ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-21' or event_type <> 'error') as events from events group by 1",
)
def backfill(t):
    path = t.dir("daily")

    def build(df):
        def run(from_day: str, to_day: str):
            day = F.to_date("ts")
            inside = df.filter(day.between(F.lit(from_day).cast("date"), F.lit(to_day).cast("date")))
            return inside.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("events"))

        return run

    publish.backfill(build(t.events.filter("event_type <> 'error'")), path, "day", "2024-01-01", "2024-12-31")
    for _ in range(2):
        publish.backfill(build(t.events), path, "day", "2024-01-10", "2024-01-20")
    return io.read_parquet(t.spark, path).select("day", "events")
