"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ORACLES, check
from tablekit.operators import windows
from tablekit.operators.slices import ROWS_CONF

OVER = "over (partition by o_custkey order by o_orderdate, o_orderkey)"
ID = "select o_orderkey, o_custkey, "


def _orders(t, *more):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", *more)


@check("s05_01_row_number", f"{ID} row_number() {OVER} as row_number from orders")
def row_number(t):
    return windows.row_number(_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@check("s05_02_rank", f"{ID} rank() over (partition by o_orderpriority order by o_orderdate desc) as rank from orders")
def rank(t):
    out = windows.rank(_orders(t, "o_orderpriority"), ["o_orderpriority"], ["-o_orderdate"])
    return out.select("o_orderkey", "o_custkey", "rank")


@check("s05_03_dense_rank", f"{ID} dense_rank() over (partition by o_orderpriority order by o_orderdate) as dense_rank from orders")
def dense_rank(t):
    out = windows.dense_rank(_orders(t, "o_orderpriority"), ["o_orderpriority"], ["o_orderdate"])
    return out.select("o_orderkey", "o_custkey", "dense_rank")


@check(
    "s05_04_lag_lead",
    f"{ID} lag(o_totalprice) {OVER} as previous, lead(o_totalprice) {OVER} as following, lag(o_orderkey, 2) {OVER} as before_that from orders",
)
def lag_lead(t):
    out = windows.lag_lead(
        _orders(t, "o_totalprice"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        {"previous": ("o_totalprice", 1), "before_that": ("o_orderkey", 2)},
        {"following": ("o_totalprice", 1)},
    )
    return out.drop("o_orderdate", "o_totalprice")


@check("s05_05_running_total", f"{ID} round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate), 2) as running_total from orders")
def running_total(t):
    out = windows.running_total(_orders(t, "o_totalprice"), ["o_custkey"], ["o_orderdate"], "o_totalprice")
    return out.select("o_orderkey", "o_custkey", F.round("running_total", 2).alias("running_total"))


@check(
    "s05_05_running_rows",
    """select event_id, count(value) over w as seen, max(value) over w as highest, min(value) over w as lowest from events
    window w as (partition by event_type order by ts, event_id rows unbounded preceding)""",
)
def running_rows(t):
    aggs = {"seen": ("count", "value"), "highest": ("max", "value"), "lowest": ("min", "value")}
    out = windows.running(t.events, ["event_type"], ["ts", "event_id"], aggs, rows=True)
    return out.select("event_id", "seen", "highest", "lowest")


@check(
    "s05_06_latest_per_key",
    "select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1",
)
def latest_per_key(t):
    return windows.latest_per_key(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@check(
    "s05_07_top_n_per_group",
    "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 3",
)
def top_n_per_group(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_n_per_group(orders, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 3)


@check(
    "s05_08_dense_key",
    "select network_type, tower_id, source_system, row_number() over (order by network_type, tower_id, source_system) as key "
    "from (select distinct network_type, tower_id, source_system from fx_usage)",
    "fx_usage",
)
def dense_key(t):
    return windows.dense_key(t.fx_usage, ["network_type", "tower_id", "source_system"])


@check(
    "s09_08_streak_batch",
    """with marked as (select *, sum(case when value > 20 then 0 else 1 end) over (partition by user_id order by ts, event_id
        rows unbounded preceding) as island from events)
    select event_id, user_id, sum(case when value > 20 then 1 else 0 end) over (partition by user_id, island
        order by ts, event_id rows unbounded preceding)::bigint as streak from marked""",
)
def streak_batch(t):
    out = windows.streak_batch(t.events, ["user_id"], ["ts", "event_id"], "value > 20")
    return out.select("event_id", "user_id", "streak")


def _with_cut_keys(fn):
    """The same operator with every key above 20 rows cut into slices."""

    def run(t):
        before = t.spark.conf.get(ROWS_CONF, None)
        t.spark.conf.set(ROWS_CONF, "20")
        try:
            return fn(t)
        finally:
            t.spark.conf.unset(ROWS_CONF) if before is None else t.spark.conf.set(ROWS_CONF, before)

    return run


TIES = "over (partition by o_orderstatus order by o_orderpriority)"


@check("s05_02_rank_ties_cut", f"select o_orderkey, rank() {TIES} as rank from orders")
def rank_ties(t):
    return _with_cut_keys(lambda t: windows.rank(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus"], ["o_orderpriority"]))(t).select("o_orderkey", "rank")


@check("s05_03_dense_rank_ties_cut", f"select o_orderkey, dense_rank() {TIES} as dense_rank from orders")
def dense_rank_ties(t):
    return _with_cut_keys(lambda t: windows.dense_rank(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus"], ["o_orderpriority"]))(t).select("o_orderkey", "dense_rank")


@check(
    "s05_05_running_total_ties_cut",
    f"select o_orderkey, count(o_orderkey) {TIES} as seen, (sum(o_custkey) {TIES})::bigint as keys, max(o_totalprice) {TIES} as highest from orders",
)
def running_ties(t):
    aggs = {"seen": ("count", "o_orderkey"), "keys": ("sum", "o_custkey"), "highest": ("max", "o_totalprice")}
    out = _with_cut_keys(lambda t: windows.running(t.orders, ["o_orderstatus"], ["o_orderpriority"], aggs))(t)
    return out.select("o_orderkey", "seen", "keys", "highest")


for _key in ("s05_01_row_number", "s05_02_rank", "s05_03_dense_rank", "s05_04_lag_lead", "s05_05_running_rows"):
    _fn = {"s05_01_row_number": row_number, "s05_02_rank": rank, "s05_03_dense_rank": dense_rank, "s05_04_lag_lead": lag_lead, "s05_05_running_rows": running_rows}[_key]
    check(f"{_key}_cut", ORACLES[_key])(_with_cut_keys(_fn))
