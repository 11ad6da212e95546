"""Sort, limit, pages and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, fixed
from tablekit.functions.exprs import exact_mean, stable_round
from tablekit.operators import order, sets


@check("s07_01_sort", "select o_orderkey, o_orderdate, o_totalprice from orders order by o_orderdate desc, o_totalprice, o_orderkey")
def sort(t):
    return order.sort(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), ["-o_orderdate", "o_totalprice", "o_orderkey"])


@check("s07_02_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def limit(t):
    return order.limit(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 50)


@check(
    "s07_03_top_k",
    f"select l_suppkey, {fixed('avg(l_extendedprice)', 4)} as avg_price from lineitem group by l_suppkey order by 2 desc, 1 limit 10",
)
def top_k(t):
    mean = stable_round(exact_mean("l_extendedprice"), 4).alias("avg_price")
    return order.top_k(t.lineitem, ["l_suppkey"], [mean], ["-avg_price", "l_suppkey"], 10)


@check("s07_04_page", "select o_orderkey, o_custkey from orders order by o_orderkey limit 100 offset 200")
def page(t):
    return order.page(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 100, 2)


@check("s08_01_union_all", "select c_name as name, c_acctbal as balance from customer union all select s_name, s_acctbal from supplier")
def union_all(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return sets.union_all(a, t.supplier.select("s_name", "s_acctbal"))


@check(
    "s08_02_union_by_name",
    "select c_name as name, c_acctbal as balance, c_mktsegment as segment from customer union all select s_name, s_acctbal, null from supplier",
)
def union_by_name(t):
    a = t.customer.select(F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return sets.union_by_name(a, b, fill_missing=True)


@check(
    "s08_03_subtract",
    "select o_custkey from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'O'",
)
def subtract(t):
    return sets.subtract(t.orders.filter("o_orderstatus = 'F'").select("o_custkey"), t.orders.filter("o_orderstatus = 'O'").select("o_custkey"))


@check(
    "s08_03_subtract_all",
    "select o_custkey from orders where o_orderstatus = 'F' except all select o_custkey from orders where o_orderstatus = 'O'",
)
def subtract_all(t):
    return sets.subtract_all(t.orders.filter("o_orderstatus = 'F'").select("o_custkey"), t.orders.filter("o_orderstatus = 'O'").select("o_custkey"))
