"""Projections, filters and predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import check
from tablekit.operators import cols, rows
from tablekit.operators.sql import cte_chain


@check("s02_01_pick", "select o_orderkey, o_totalprice, 'v1' as source from orders")
def pick(t):
    return cols.pick(t.orders, "o_orderkey", "o_totalprice", F.lit("v1").alias("source"))


@check("s02_02_star_except", "select c_custkey, c_name, c_nationkey, c_mktsegment from customer")
def star_except(t):
    return cols.star_except(t.customer, ["c_acctbal"])


@check(
    "s02_03_derive",
    "select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net, "
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) as gross from lineitem",
)
def derive(t):
    base = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    full = cols.derive(base, net=F.col("l_extendedprice") * (1 - F.col("l_discount")), gross=F.col("net") * (1 + F.col("l_tax")))
    return full.drop("l_extendedprice", "l_discount", "l_tax")


@check("s02_04_rename", "select r_regionkey as id, r_name as region from region")
def rename(t):
    return cols.rename(t.region, {"r_regionkey": "id", "r_name": "region"})


@check("s02_05_nested", "select n_name as city from nation join customer on n_nationkey = c_nationkey")
def nested(t):
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return cols.nested(placed.select(F.struct(F.col("n_name").alias("city"), "c_name").alias("location")), "location.city")


@check("s02_06_where_compare", "select o_orderkey, o_totalprice from orders where o_totalprice > 100000 and o_orderstatus = 'F'")
def where_compare(t):
    df = rows.where_compare(t.orders, "o_totalprice", ">", 100000)
    return rows.where_compare(df, "o_orderstatus", "=", "F").select("o_orderkey", "o_totalprice")


@check("s02_07_where_like", "select p_partkey, p_name from part where p_name like 's%b_lt'")
def where_like(t):
    return rows.where_like(t.part, "p_name", "s%b_lt").select("p_partkey", "p_name")


@check(
    "s02_08_ranges",
    "select usage_id, ingestion_timestamp from fx_usage where data_used_mb >= 0 and upload_speed_mbps between 0 and 100 "
    "and download_speed_mbps between 0 and 500 and signal_strength between -120 and -40",
    "fx_usage",
)
def ranges(t):
    bounds = {"data_used_mb": (0, None), "upload_speed_mbps": (0, 100), "download_speed_mbps": (0, 500)}
    df = rows.ranges(t.fx_usage, bounds)
    return rows.where_between(df, "signal_strength", -120, -40).select("usage_id", "ingestion_timestamp")


@check(
    "s02_08_where_inside",
    "select broadcast_id, line_no, duration_minutes from fx_broadcasts where duration_minutes > 0 and duration_minutes < 300",
    "fx_broadcasts",
)
def where_inside(t):
    df = rows.where_inside(t.fx_broadcasts, "duration_minutes", 0, 300)
    return df.select("broadcast_id", "line_no", "duration_minutes")


@check(
    "s02_09_where_not_in",
    "select id, code from (select id, nullif(status_code, 204) as code from fx_checks) where code not in (999, 500)",
    "fx_checks",
)
def where_not_in(t):
    checks = t.fx_checks.select("id", F.expr("nullif(status_code, 204)").alias("code"))
    return rows.where_not_in(checks, "code", [999, 500])


@check("s02_09_where_in", "select id, status_code from fx_checks where status_code in (200, 404)", "fx_checks")
def where_in(t):
    return rows.where_in(t.fx_checks, "status_code", [200, 404]).select("id", "status_code")


@check(
    "s02_10_require",
    "select id from fx_checks where url is not null and status_code is not null and response_time_ms is not null",
    "fx_checks",
)
def require(t):
    return rows.require(t.fx_checks, ["url", "status_code", "response_time_ms"]).select("id")


@check(
    "s02_10_drop_null_rows",
    "select id, url, status_code from fx_checks where url is not null and status_code is not null",
    "fx_checks",
)
def drop_null_rows(t):
    return rows.drop_null_rows(t.fx_checks.select("id", "url", "status_code"))


@check(
    "s02_11_reject_sentinel",
    "select broadcast_id, line_no, event_date from fx_broadcasts where event_date is not null and event_date <> '31-12-9999'",
    "fx_broadcasts",
)
def reject_sentinel(t):
    return rows.reject_sentinel(t.fx_broadcasts, "event_date", "31-12-9999").select("broadcast_id", "line_no", "event_date")


@check(
    "s02_12_fill",
    "select id, coalesce(status_code, -1) as status_code, coalesce(url, 'none') as url, "
    "coalesce(url, status_message) as label from fx_checks",
    "fx_checks",
)
def fill(t):
    labelled = t.fx_checks.withColumn("label", rows.coalesce_cols("url", "status_message"))
    return rows.fill(labelled, {"status_code": -1, "url": "none"}).select("id", "status_code", "url", "label")


@check("s02_13_distinct", "select distinct l_returnflag, l_linestatus from lineitem")
def distinct(t):
    return rows.distinct(t.lineitem, ["l_returnflag", "l_linestatus"])


@check(
    "s02_14_drop_duplicates",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from (select *, row_number() over (
      partition by l_orderkey, l_linenumber order by l_extendedprice desc, l_partkey, l_suppkey, l_shipdate, l_quantity) as rn
      from lineitem) where rn = 1""",
)
def drop_duplicates(t):
    order = ["-l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    df = rows.drop_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@check("s02_15_drop_exact_duplicates", "select distinct o_custkey, o_orderstatus from orders")
def drop_exact_duplicates(t):
    return rows.drop_exact_duplicates(t.orders.select("o_custkey", "o_orderstatus"))


@check(
    "s02_16_case_map",
    "select sale_id, line_no, product_id, case payment_method when 'Card' then 'Credit/Debit Card' "
    "when 'UPI' then 'Digital Wallet' else 'Other' end as payment_type from fx_sales",
    "fx_sales",
)
def case_map(t):
    label = cols.case_map("payment_method", {"Card": "Credit/Debit Card", "UPI": "Digital Wallet"}, "Other")
    return t.fx_sales.select("sale_id", "line_no", "product_id", label.alias("payment_type"))


@check(
    "s02_17_bucket",
    """select usage_id, ingestion_timestamp,
      case when data_used_mb < 500 then 'LOW' when data_used_mb <= 2000 then 'MEDIUM' else 'HIGH' end as data_usage_level,
      case when signal_strength >= -60 then 'HIGH' when signal_strength >= -90 then 'AVERAGE' else 'LOW' end as signal_quality
      from fx_usage""",
    "fx_usage",
)
def bucket(t):
    usage = cols.bucket("data_used_mb", [(500, "LOW"), (2000, "MEDIUM")], "HIGH", comparisons=["<", "<="])
    signal = cols.bucket("signal_strength", [(-60, "HIGH"), (-90, "AVERAGE")], "LOW", ">=")
    return t.fx_usage.select(
        "usage_id", "ingestion_timestamp", usage.alias("data_usage_level"), signal.alias("signal_quality")
    )


@check(
    "s02_18_indicator",
    "select id, case when status_code >= 400 then 1 else 0 end as is_error, "
    "case when response_time_ms > 1000 then 1 else 0 end as is_slow from fx_checks",
    "fx_checks",
)
def indicator(t):
    return t.fx_checks.select(
        "id",
        cols.indicator(F.col("status_code") >= 400).alias("is_error"),
        cols.indicator(F.col("response_time_ms") > 1000).alias("is_slow"),
    )


@check("s02_19_since_watermark", "select event_id, ts from events where ts > timestamp '2024-01-10 12:00:00'")
def since_watermark(t):
    return rows.since_watermark(t.events, "ts", datetime(2024, 1, 10, 12)).select("event_id", "ts")


@check(
    "s02_20_scalar_subquery_filter",
    "select o_orderkey, o_orderdate from orders where o_orderdate > (select max(o_orderdate) - interval 30 day from orders)",
)
def scalar_subquery_filter(t):
    bound = F.max("o_orderdate") - F.expr("interval 30 days")
    return rows.scalar_subquery_filter(t.orders, "o_orderdate", t.orders, bound).select("o_orderkey", "o_orderdate")


CTE = """with big as (select o_custkey, o_totalprice from {orders} where o_totalprice > 50000),
  totals as (select o_custkey, count(*) as orders, round(sum(o_totalprice), 2) as amount from big group by o_custkey)
  select c_mktsegment, count(*) as customers, round(sum(amount), 2) as amount
  from totals join {customer} on o_custkey = c_custkey group by c_mktsegment"""


@check("s02_21_cte_chain", CTE.format(orders="orders", customer="customer"))
def cte(t):
    return cte_chain({"orders": t.orders, "customer": t.customer}, CTE)


@check("s02_22_mask", "select c_custkey, c_name, cast(null as double) as c_acctbal from customer")
def mask(t):
    masked = cols.mask_view(t.customer, "c_acctbal", {"analysts"}, {"finance"})
    return masked.select("c_custkey", "c_name", "c_acctbal")


@check("s02_23_explode_records", "select n_regionkey, n_nationkey as id, upper(n_name) as name from nation")
def explode_records(t):
    users = F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("users")
    # one document per region: nation has a fixed number of rows
    documents = t.nation.groupBy("n_regionkey").agg(users)
    return rows.explode_records(documents, "users", ["n_regionkey"]).withColumn("name", F.upper("name"))
