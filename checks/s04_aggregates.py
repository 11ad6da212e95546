"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, fixed
from tablekit.functions.exprs import exact_mean, exact_sum, stable_round
from tablekit.operators import agg

LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey"]


@check("s04_01_count_by", "select l_returnflag, l_linestatus, count(*) as count from lineitem group by all")
def count_by(t):
    return agg.count_by(t.lineitem, ["l_returnflag", "l_linestatus"])


@check(
    "s04_02_stats_by",
    f"select o_orderpriority, {fixed('avg(o_totalprice)', 4)} as avg_o_totalprice, max(o_totalprice) as max_o_totalprice, "
    "min(o_totalprice) as min_o_totalprice from orders group by o_orderpriority",
)
def stats_by(t):
    stats = agg.stats_by(t.orders, ["o_orderpriority"], "o_totalprice")
    return stats.withColumn("avg_o_totalprice", stable_round("avg_o_totalprice", 4))


@check(
    "s04_03_sum_count",
    "select city, order_status, round(sum(amount), 2) as total_amount, count(order_id) as total_orders, count(*) as rows "
    "from fx_orders join fx_customers using (customer_id) group by city, order_status",
    "fx_orders fx_customers",
)
def sum_count(t):
    joined = t.fx_orders.join(t.fx_customers, "customer_id")
    out = agg.sum_count(joined, ["city", "order_status"], {"total_amount": "amount"}, {"total_orders": "order_id", "rows": "*"})
    return out.withColumn("total_amount", F.round("total_amount", 2))


@check(
    "s04_04_having",
    "select o_custkey, count(*) as orders, round(sum(o_totalprice), 2) as amount from orders group by o_custkey having count(*) > 10",
)
def having(t):
    aggs = [F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("amount")]
    return agg.having(t.orders, ["o_custkey"], aggs, F.col("orders") > 10)


@check("s04_05_count_distinct", "select l_suppkey, count(distinct l_partkey) as parts from lineitem group by l_suppkey")
def count_distinct(t):
    return agg.count_distinct(t.lineitem, ["l_suppkey"], "l_partkey", "parts")


@check("s04_05_approx_count_distinct", "select l_suppkey, count(distinct l_partkey) as parts, true as is_near from lineitem group by l_suppkey")
def approx_count_distinct(t):
    sketch = agg.count_distinct(t.lineitem, ["l_suppkey"], "l_partkey", "about", approx_rsd=0.05)
    exact = agg.count_distinct(t.lineitem, ["l_suppkey"], "l_partkey", "parts")
    # five standard errors, and a count of one
    near = F.abs(F.col("about") - F.col("parts")) <= 5 * 0.05 * F.col("parts") + 1
    return exact.join(sketch, "l_suppkey").select("l_suppkey", "parts", near.alias("is_near"))


@check(
    "s04_06_count_if",
    "select user_id, count(*) filter (event_type = 'click') as clicks, count(*) filter (value > 20) as large from events group by user_id",
)
def count_if(t):
    return agg.count_if(t.events, ["user_id"], {"clicks": F.col("event_type") == "click", "large": F.col("value") > 20})


@check(
    "s04_07_rounded",
    f"select l_returnflag, {fixed('sum(l_extendedprice)', 2)} as total, {fixed('avg(l_quantity)', 2)} as mean from lineitem group by l_returnflag",
)
def rounded(t):
    return agg.rounded(t.lineitem, ["l_returnflag"], {"total": exact_sum("l_extendedprice"), "mean": exact_mean("l_quantity")})


@check(
    "s04_08_ratio",
    f"select l_suppkey, {fixed('sum(l_extendedprice) / nullif(sum(l_quantity), 0)', 2)} as ratio from lineitem group by l_suppkey",
)
def ratio(t):
    return agg.ratio(t.lineitem, ["l_suppkey"], "l_extendedprice", "l_quantity", 2)


@check(
    "s04_09_global_stats",
    f"select min(value) as min_value, max(value) as max_value, {fixed('avg(value)', 6)} as avg_value, count(*) as rows from events",
)
def global_stats(t):
    return agg.global_stats(t.events, "value").withColumn("avg_value", stable_round("avg_value", 6))


@check("s04_10_distribution", "select event_type, count(*) as count from events group by event_type")
def distribution(t):
    return agg.distribution(t.events, "event_type")


@check(
    "s04_11_by_expression",
    "select case when l_quantity < 10 then 'small' when l_quantity < 30 then 'medium' else 'large' end as size, l_returnflag, "
    "count(*) as rows from lineitem group by 1, 2",
)
def by_expression(t):
    size = F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 30, "medium").otherwise("large")
    return agg.by_expression(t.lineitem, size, "size", [F.count(F.lit(1)).alias("rows")], ["l_returnflag"])


@check("s04_12_salted_count", "select l_suppkey, count(*) as count from lineitem group by l_suppkey")
def salted_count(t):
    return agg.salted_count(t.lineitem, ["l_suppkey"], 8, LINE_ID)


@check("s04_13_salted_hot", "select l_suppkey, count(*) as count from lineitem group by l_suppkey")
def salted_hot(t):
    return agg.salted_hot(t.lineitem, "l_suppkey", [1, 2, 3], 8, LINE_ID)


@check(
    "s04_14_skew_report",
    """with c as (select l_suppkey, count(*) as rows from lineitem group by l_suppkey)
    select l_suppkey, rows, round(cast(rows / (select sum(rows) from c) as decimal(38,11)), 6)::double as share,
      round(cast(rows / (select avg(rows) from c) as decimal(38,9)), 4)::double as times_mean
    from c order by rows desc, l_suppkey limit 20""",
)
def skew_report(t):
    return agg.skew_report(t.lineitem, "l_suppkey", 20)


@check("s04_15_max_id_next", "select coalesce(max(event_id), 0) + 1 as next_id from events")
def max_id_next(t):
    return agg.max_id_next(t.events, "event_id")


@check(
    "s04_16_histogram",
    " union all ".join(
        f"select event_type, '{b}' as le, count(*) filter (value <= {b}) as rows from events group by event_type" for b in (5, 10, 25, 50)
    )
    + " union all select event_type, '+Inf', count(value) from events group by event_type",
)
def histogram(t):
    return agg.histogram(t.events, "value", [5, 10, 25, 50], ["event_type"])


@check(
    "s04_16_histogram_text",
    " union all ".join(f"select '{b}' as le, count(*) filter (length(text) <= {b}) as rows from documents" for b in (100, 1000, 10000))
    + " union all select '+Inf', count(text) from documents",
)
def histogram_text(t):
    return agg.histogram(t.documents.select(F.length("text").alias("chars")), "chars", [100, 1000, 10000])
