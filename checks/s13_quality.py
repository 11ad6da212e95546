"""Data quality checks."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.registry import check, fixed
from tablekit.functions.exprs import exact_mean, stable_round
from tablekit.operators import quality

RULES = [
    quality.Rule("has_url", "url is not null", "drop"),
    quality.Rule("quick", "response_time_ms < 500", "warn"),
    quality.Rule("known_code", "status_code <> 999", "drop"),
]


@check("s13_01_not_null", "select id, fix from fx_checks where url is null", "fx_checks")
def not_null(t):
    return quality.not_null(t.fx_checks, "url").select("id", "fix")


@check(
    "s13_02_unique",
    "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1",
)
def unique(t):
    return quality.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@check("s13_02_primary_key", "select status_code, count(*) as copies from fx_checks group by 1 having count(*) > 1 or status_code is null", "fx_checks")
def primary_key(t):
    return quality.primary_key(t.fx_checks, ["status_code"])


@check("s13_03_accepted_values", "select id, status_code from fx_checks where status_code not in (200, 204, 301)", "fx_checks")
def accepted_values(t):
    return quality.accepted_values(t.fx_checks, "status_code", [200, 204, 301]).select("id", "status_code")


@check(
    "s13_04_row_rule",
    "select sale_id, line_no, quantity, sale_amount from fx_sales where sale_id is null or quantity <= 2 or sale_amount <= 0 or payment_method not in ('Card', 'UPI', 'NetBanking')",
    "fx_sales",
)
def row_rule(t):
    failing = "sale_id is null or quantity <= 2 or sale_amount <= 0 or payment_method not in ('Card', 'UPI', 'NetBanking')"
    return quality.row_rule(t.fx_sales, failing).select("sale_id", "line_no", "quantity", "sale_amount")


@check("s13_04_row_rule_dates", "select product_id, category, created_at, product_name from fx_products where created_at is null or created_at <= date '2024-01-01'", "fx_products")
def row_rule_dates(t):
    bad = quality.row_rule(t.fx_products, "created_at is null or created_at <= date '2024-01-01'")
    return bad.select("product_id", "category", "created_at", "product_name")


@check("s13_05_expectations", "select id, url, status_code from fx_checks where url is not null and status_code <> 999", "fx_checks")
def expectations(t):
    return quality.expectations(t.fx_checks, RULES).select("id", "url", "status_code")


@check(
    "s13_05_expectations_observed",
    """select count(*) as kept, (select count(*) from fx_checks where url is null) as no_url,
      (select count(*) from fx_checks where not coalesce(response_time_ms < 500, false)) as slow
    from fx_checks where url is not null and status_code <> 999""",
    "fx_checks",
)
def expectations_observed(t):
    seen = Observation()
    path = t.dir("expected")
    quality.expectations(t.fx_checks, RULES, seen).write.parquet(path)
    counts = seen.get
    return t.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("kept"),
        F.lit(counts["has_url_failed"]).cast("long").alias("no_url"),
        F.lit(counts["quick_failed"]).cast("long").alias("slow"),
    )


@check(
    "s13_05_expectation_report",
    """select 'has_url' as rule, 'drop' as on_fail, count(*) filter (url is not null) as passed, count(*) filter (url is null) as failed from fx_checks
    union all select 'quick', 'warn', count(*) filter (response_time_ms < 500), count(*) - count(*) filter (response_time_ms < 500) from fx_checks
    union all select 'known_code', 'drop', count(*) filter (status_code <> 999), count(*) - count(*) filter (status_code <> 999) from fx_checks""",
    "fx_checks",
)
def expectation_report(t):
    return quality.expectation_report(t.fx_checks, RULES)


@check("s13_06_non_empty", f"select count(*) as rows, {fixed('avg(value)', 4)} as score from events")
def non_empty(t):
    df = quality.non_empty(t.events, "events")
    quality.min_score(df, F.avg("value"), 0.0)
    return df.agg(F.count(F.lit(1)).alias("rows"), stable_round(exact_mean("value"), 4).alias("score"))


@check("s13_07_relationship", "select audit_id, checkout_id from fx_audit where checkout_id not in (select order_id from fx_orders)", "fx_audit fx_orders")
def relationship(t):
    return quality.relationship(t.fx_audit, t.fx_orders, "checkout_id", "order_id").select("audit_id", "checkout_id")


@check(
    "s13_08_reconcile",
    """with a as (select l_orderkey as k, count(*) as n from lineitem group by 1), b as (select o_orderkey as k, count(*) as n from orders group by 1)
    select sum(a.n)::bigint as rows_in_source, sum(b.n)::bigint as rows_in_destination, count(*) filter (b.k is null) as missing_keys,
      count(*) filter (a.k is null) as extra_keys from a full join b on a.k = b.k""",
)
def reconcile(t):
    src = t.lineitem.select(F.col("l_orderkey").alias("k"))
    return quality.reconcile(src, t.orders.select(F.col("o_orderkey").alias("k")), ["k"])


@check(
    "s13_09_run_log",
    """with l as (select event_type as table_name, case user_id % 3 when 0 then 'PENDING' when 1 then 'IN_PROGRESS' else 'DONE' end as status,
      ts as logged_at, event_id as seq, date_trunc('day', ts) as d from events),
    per_day as (select * from (select *, row_number() over (partition by table_name, d order by logged_at desc, seq desc) as rn from l) where rn = 1)
    select table_name, status, logged_at, seq from (select *, row_number() over (partition by table_name order by logged_at desc, seq desc) as r from per_day) where r = 1""",
)
def run_log(t):
    state = F.when(F.col("user_id") % 3 == 0, "PENDING").when(F.col("user_id") % 3 == 1, "IN_PROGRESS").otherwise("DONE")
    log = t.events.select(
        F.col("event_type").alias("table_name"), state.alias("status"), F.col("event_id").alias("rows_in_source"),
        F.col("event_id").alias("rows_loaded"), F.col("ts").alias("logged_at"), F.col("event_id").alias("seq"),
    )
    return quality.latest_run(log).select("table_name", "status", "logged_at", "seq")


@check(
    "s13_09_run_log_append",
    """with l as (select event_type || '-' || (user_id % 50)::varchar as table_name, case user_id % 3 when 0 then 'PENDING' when 1 then 'FAILED' else 'DONE' end as status,
      ts as logged_at, event_id as seq from events),
    old as (select * from l where logged_at < timestamp '2024-01-20'), fresh as (select * from l where logged_at >= timestamp '2024-01-20'),
    last as (select * from (select *, row_number() over (partition by table_name order by logged_at desc, seq desc) as rn from old) where rn = 1),
    opening as (select * from (select *, row_number() over (partition by table_name order by logged_at, seq) as rn from fresh where status = 'PENDING') where rn = 1)
    select table_name, status, seq from old union all select table_name, status, seq from fresh where status <> 'PENDING'
    union all select table_name, status, seq from opening where table_name not in (select table_name from last where status <> 'FAILED')""",
)
def run_log_append(t):
    state = F.when(F.col("user_id") % 3 == 0, "PENDING").when(F.col("user_id") % 3 == 1, "FAILED").otherwise("DONE")
    table = F.concat_ws("-", "event_type", (F.col("user_id") % 50).cast("string"))
    log = t.events.select(table.alias("table_name"), state.alias("status"), F.col("ts").alias("logged_at"), F.col("event_id").alias("seq"))
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    out = quality.run_log(log.filter(F.col("logged_at") < cut), log.filter(F.col("logged_at") >= cut))
    return out.select("table_name", "status", "seq")


@check(
    "s13_10_stage_metrics",
    "select 'ingest' as stage, case when url is null then 'failed' else 'success' end as status, count(*) as records from fx_checks group by 2",
    "fx_checks",
)
def stage_metrics(t):
    return quality.stage_metrics(t.fx_checks, "ingest", F.when(F.col("url").isNull(), "failed").otherwise("success"))


@check("s13_10_observed", "select count(*) as records from events")
def observed(t):
    counted, seen = quality.observed(t.events, "events")
    path = t.dir("observed")
    counted.write.parquet(path)
    return t.spark.read.parquet(path).agg(F.max(F.lit(seen.get["records"]).cast("long")).alias("records"))
