"""Scalar functions, one query per function over a whole table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.registry import check, fixed
from tablekit.functions import exprs


@check("s06_01_clean", "select id, upper(trim(url)) as url, lower(trim(fix)) as fix from fx_checks", "fx_checks")
def clean(t):
    return t.fx_checks.select("id", exprs.clean("url", "upper").alias("url"), exprs.clean("fix", "lower").alias("fix"))


NORMAL = "regexp_replace(replace(replace(lower(trim(url)), 'https://', ''), 'http://', ''), '/+$', '')"


@check("s06_02_normalize_url", f"select id, {NORMAL} as url from fx_checks", "fx_checks")
def normalize_url(t):
    return t.fx_checks.select("id", exprs.normalize_url("url").alias("url"))


HOST = "regexp_extract(url, '^https?://([^/?#:]+)', 1)"


@check(
    "s06_03_url_parts",
    f"select page_id, split_part({HOST}, '.', 1) as site, split_part({HOST}, '.', -1) as domain from pages",
)
def url_parts(t):
    site, domain = exprs.url_parts(exprs.normalize_url("url"))
    return t.pages.select("page_id", site.alias("site"), domain.alias("domain"))


@check("s06_04_join_text", "select l_orderkey, l_linenumber, l_partkey, l_returnflag || '_' || l_linenumber || '_' || l_suppkey as label from lineitem")
def join_text(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", exprs.join_text("_", "l_returnflag", "l_linenumber", "l_suppkey").alias("label"))


@check("s06_05_max_length", "select usage_id, phone_number from fx_usage where length(phone_number) <= 10", "fx_usage")
def max_length(t):
    return t.fx_usage.filter(exprs.max_length("phone_number", 10)).select("usage_id", "phone_number")


@check("s06_06_like", "select p_partkey, p_type like '%E%' as has_e from part")
def like(t):
    return t.part.select("p_partkey", exprs.like("p_type", "%E%").alias("has_e"))


@check(
    "s06_07_try_cast",
    "select order_id, product, try_cast(price as double) as price, try_cast(quantity as bigint) as quantity, "
    "try_cast(substr(order_date, 1, 10) as date) as order_day from fx_shop",
    "fx_shop",
)
def try_cast(t):
    return t.fx_shop.select(
        "order_id",
        "product",
        exprs.try_cast("price", "double").alias("price"),
        exprs.try_cast("quantity", "long").alias("quantity"),
        exprs.try_cast(F.substring("order_date", 1, 10), "date").alias("order_day"),
    )


@check("s06_08_parse_ts", "select order_id, product, price, try_strptime(order_date, '%Y-%m-%d %H:%M:%S') as order_time from fx_shop", "fx_shop")
def parse_ts(t):
    return t.fx_shop.select("order_id", "product", "price", exprs.parse_ts("order_date", "yyyy-MM-dd HH:mm:ss").alias("order_time"))


@check("s06_09_date_of", "select event_id, ts::date as day from events")
def date_of(t):
    return t.events.select("event_id", exprs.date_of("ts").alias("day"))


@check("s06_10_time_of", "select event_id, strftime(ts, '%H:%M:%S') as time from events")
def time_of(t):
    return t.events.select("event_id", exprs.time_of("ts").alias("time"))


@check("s06_11_date_parts", "select event_id, year(ts)::int as year, month(ts)::int as month, hour(ts)::int as hour from events")
def date_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in exprs.date_parts("ts").items()])


@check("s06_12_iso_week", "select o_orderkey, extract(week from o_orderdate)::int as week from orders")
def iso_week(t):
    return t.orders.select("o_orderkey", exprs.iso_week("o_orderdate").alias("week"))


@check("s06_13_iso_weekday", "select o_orderkey, isodow(o_orderdate)::int as weekday from orders")
def iso_weekday(t):
    return t.orders.select("o_orderkey", exprs.iso_weekday("o_orderdate").alias("weekday"))


@check("s06_14_weekday_name", "select o_orderkey, dayname(o_orderdate) as weekday from orders")
def weekday_name(t):
    return t.orders.select("o_orderkey", exprs.weekday_name("o_orderdate").alias("weekday"))


@check(
    "s06_15_day_period",
    "select event_id, case when hour(ts) between 5 and 11 then 'MORNING' when hour(ts) between 12 and 16 then 'AFTERNOON' "
    "when hour(ts) between 17 and 20 then 'EVENING' else 'NIGHT' end as period from events",
)
def day_period(t):
    return t.events.select("event_id", exprs.day_period("ts").alias("period"))


@check(
    "s06_16_days",
    "select o_orderkey, date_diff('day', o_orderdate::date, date '2002-01-01')::int as age, (o_orderdate::date + 30)::date as due from orders",
)
def days(t):
    return t.orders.select(
        "o_orderkey",
        exprs.days_since("o_orderdate", date(2002, 1, 1)).alias("age"),
        exprs.add_days(exprs.date_of("o_orderdate"), 30).alias("due"),
    )


@check(
    "s06_17_minutes_between",
    f"select usage_id, ingestion_timestamp, {fixed('(epoch_us(try_cast(session_end as timestamp)) - epoch_us(try_cast(session_start as timestamp))) / 6e7', 2)} "
    "as minutes from fx_usage",
    "fx_usage",
)
def minutes_between(t):
    start, end = (exprs.try_cast(c, "timestamp_ntz") for c in ("session_start", "session_end"))
    return t.fx_usage.select("usage_id", "ingestion_timestamp", exprs.minutes_between(start, end).alias("minutes"))


@check("s06_18_shift", "select event_id, ts + interval 5 hour as later, ts - interval 30 day as earlier from events")
def shift(t):
    return t.events.select("event_id", exprs.shift("ts", hours=5).alias("later"), exprs.shift("ts", days=-30).alias("earlier"))


@check("s06_19_scaled", f"select id, {fixed('response_time_ms * 0.001', 2)} as seconds from fx_checks", "fx_checks")
def scaled(t):
    return t.fx_checks.select("id", exprs.scaled("response_time_ms", 0.001, 2).alias("seconds"))


@check(
    "s06_20_json",
    """select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' as packed,
      json_extract(props, '$.k')::bigint as k from events""",
)
def json(t):
    return t.events.select(
        "event_id",
        exprs.pack_json("event_id", "event_type").alias("packed"),
        exprs.unpack_json("props", "k BIGINT")["k"].alias("k"),
    )


@check(
    "s06_21_surrogate_key",
    "select id, md5(coalesce(id::varchar, '_dbt_utils_surrogate_key_null_') || '-' || coalesce(url, '_dbt_utils_surrogate_key_null_')) as key from fx_checks",
    "fx_checks",
)
def surrogate_key(t):
    return t.fx_checks.select("id", exprs.surrogate_key("id", "url").alias("key"))


@check("s06_22_lineage", "select event_id, timestamp '2024-02-01 00:00:00' as _ingested_at, 'events.parquet' as file from events")
def lineage(t):
    out = exprs.lineage(t.events, datetime(2024, 2, 1), files=True)
    return out.select("event_id", "_ingested_at", F.element_at(F.split("_source_file", "/"), -1).alias("file"))


@check("s06_23_salt", "select user_id, count(*) as rows, true as in_range from events group by user_id")
def salt(t):
    salted = t.events.withColumn("salt", exprs.salt(8, "event_id"))
    return salted.groupBy("user_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("salt").between(0, 7)).alias("in_range"))


@check("s06_24_arith", "select event_id, event_id % 7 as remainder, value * 2 as doubled, (user_id + event_id) as total from events")
def arith(t):
    return t.events.select(
        "event_id",
        exprs.remainder("event_id", 7).alias("remainder"),
        exprs.scaled("value", 2.0).alias("doubled"),
        (F.col("user_id") + F.col("event_id")).alias("total"),
    )


@check(
    "s06_25_margin",
    f"select l_orderkey, l_linenumber, l_partkey, {fixed('(l_extendedprice - l_quantity * 10) / nullif(l_extendedprice, 0)', 6)} as margin, "
    f"{fixed('l_extendedprice * (1 + l_tax)', 4)} as taxed from lineitem",
)
def margin(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        exprs.stable_round(exprs.margin("l_extendedprice", F.col("l_quantity") * 10), 6).alias("margin"),
        exprs.stable_round(exprs.with_tax("l_extendedprice", "l_tax"), 4).alias("taxed"),
    )
