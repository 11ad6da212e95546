"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from tablekit.operators import join
from tablekit.operators.windows import lag_lead
from tablekit.plans import sales

ORDER_CITY = "select order_id, customer_id, amount, order_status, city from fx_orders join fx_customers using (customer_id)"


def _pair(t):
    return t.fx_orders.drop("order_created_at"), t.fx_customers.select("customer_id", "city")


@check("s03_01_inner", ORDER_CITY, "fx_orders fx_customers")
def inner(t):
    return join.inner(*_pair(t), ["customer_id"])


@check(
    "s03_02_left",
    "select order_id, customer_id, city, customer_segment from fx_orders left join "
    "(select * from fx_customers where account_status = 'Active') using (customer_id)",
    "fx_orders fx_customers",
)
def left(t):
    active = t.fx_customers.filter("account_status = 'Active'").select("customer_id", "city", "customer_segment")
    return join.left(t.fx_orders.select("order_id", "customer_id"), active, ["customer_id"])


@check(
    "s03_03_full",
    """select customer_id, orders, city from (select customer_id, count(*) as orders from fx_orders
      where order_status = 'completed' group by customer_id) full join
      (select customer_id, city from fx_customers where account_status = 'Active') using (customer_id)""",
    "fx_orders fx_customers",
)
def full(t):
    done = t.fx_orders.filter("order_status = 'completed'").groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
    active = t.fx_customers.filter("account_status = 'Active'").select("customer_id", "city")
    return join.full(done, active, ["customer_id"])


@check("s03_04_broadcast", ORDER_CITY, "fx_orders fx_customers")
def broadcast(t):
    return join.broadcast(*_pair(t), ["customer_id"])


@check("s03_05_shuffle", ORDER_CITY, "fx_orders fx_customers")
def shuffle(t):
    return join.shuffle(*_pair(t), ["customer_id"])


SUPPLIED = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name from lineitem join supplier on l_suppkey = s_suppkey"


def _supplied(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lines, t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")


@check("s03_06_salted", SUPPLIED)
def salted(t):
    return join.salted(*_supplied(t), ["l_suppkey"], 8, ["l_orderkey", "l_linenumber", "l_partkey"])


@check("s03_06_salted_hot", SUPPLIED)
def salted_hot(t):
    return join.salted(*_supplied(t), ["l_suppkey"], 8, ["l_orderkey", "l_linenumber", "l_partkey"], hot_keys=[1, 2])


@check(
    "s03_07_filter_after",
    "select sale_id, line_no, product_id, sale_amount, product_name from fx_sales join fx_products using (product_id) "
    "where case sale_status when 'completed' then 'Processing Closed' else 'x' end = 'Processing Closed'",
    "fx_sales fx_products",
)
def filter_after(t):
    lines = t.fx_sales.select("sale_id", "line_no", "product_id", "sale_amount", "sale_status")
    closed = sales.status("sale_status") == "Processing Closed"
    named = t.fx_products.select("product_id", "product_name")
    return join.filter_after(lines, named, ["product_id"], closed).drop("sale_status")


def _versions(t):
    """A price per user that holds from one purchase to the next."""
    bought = t.events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("valid_from"), F.col("value").alias("price"), "event_id"
    )
    open_ended = lag_lead(bought, ["user_id"], ["valid_from", "event_id"], leads={"valid_to": ("valid_from", 1)})
    return open_ended.drop("event_id")


VERSIONS = """with v as (select user_id, ts as valid_from, value as price,
    lead(ts) over (partition by user_id order by ts, event_id) as valid_to from events where event_type = 'purchase')
  select e.event_id, e.user_id, e.ts, v.price, v.valid_from, v.valid_to from events e {how} join v
  on e.user_id = v.user_id and e.ts >= v.valid_from and (v.valid_to is null or e.ts < v.valid_to)"""


@check("s03_08_point_in_time", VERSIONS.format(how=""))
def point_in_time(t):
    facts = t.events.select("event_id", "user_id", "ts")
    return join.point_in_time(facts, _versions(t), ["user_id"], "ts")


@check("s03_08_point_in_time_left", VERSIONS.format(how="left"))
def point_in_time_left(t):
    facts = t.events.select("event_id", "user_id", "ts")
    return join.point_in_time(facts, _versions(t), ["user_id"], "ts", how="left")


INTERVAL = """select a.user_id, a.event_id as signup_id, a.ts as signup_ts, b.event_id as buy_id, b.ts as buy_ts
  from (select * from events where event_type = 'signup') a {how} join (select * from events where event_type = 'purchase') b
  on a.user_id = b.user_id and b.ts >= a.ts and b.ts < a.ts + interval 5 hour"""


def signups_and_buys(t):
    a = t.events.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts"))
    b = t.events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), F.col("ts").alias("buy_ts"))
    return a, b


@check("s03_09_interval", INTERVAL.format(how=""))
def interval(t):
    return join.interval(*signups_and_buys(t), ["user_id"], "signup_ts", "buy_ts", 5 * 3600)


@check("s03_09_interval_left", INTERVAL.format(how="left"))
def interval_left(t):
    return join.interval(*signups_and_buys(t), ["user_id"], "signup_ts", "buy_ts", 5 * 3600, "left")


@check("s03_10_semi", "select customer_id, city from fx_customers where customer_id in (select customer_id from fx_orders where amount > 400000)", "fx_customers fx_orders")
def semi(t):
    return join.semi(t.fx_customers.select("customer_id", "city"), t.fx_orders.filter("amount > 400000"), ["customer_id"])


@check("s03_10_anti", "select customer_id, city from fx_customers where customer_id not in (select customer_id from fx_orders where amount > 400000)", "fx_customers fx_orders")
def anti(t):
    return join.anti(t.fx_customers.select("customer_id", "city"), t.fx_orders.filter("amount > 400000"), ["customer_id"])
