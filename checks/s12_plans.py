"""Business plans."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.registry import check, fixed
from checks.s01_sources import landed, spread, weather_kv
from checks.s09_streams import ANY_DELAY, ntz, to_files, to_state
from tablekit.functions import exprs
from tablekit.operators.buckets import BucketTable
from tablekit.operators import scd
from tablekit.operators.windows import latest_per_key
from tablekit.plans import (
    broadcasts,
    checkout,
    customers,
    employees,
    medallion,
    regional,
    sales,
    shop,
    telecom,
    weather,
    webchecks,
)
from tablekit.sources import io, streamio
from tablekit.streaming import stream


# --- telecom ----------------------------------------------------------------

TELECOM = f"""typed as (select usage_id, customer_id, try_cast(phone_number as bigint) as phone_number, upper(trim(region)) as region,
    upper(trim(plan_type)) as plan_type, upper(trim(device_type)) as device_type, upper(trim(customer_status)) as customer_status,
    try_cast(signup_date as date) as signup_date, tower_id, try_cast(session_start as timestamp) as session_start,
    try_cast(session_end as timestamp) as session_end, data_used_mb, network_type, signal_strength, upload_speed_mbps,
    download_speed_mbps, upper(trim(source_system)) as source_system, ingestion_timestamp
    from fx_usage where length(phone_number) <= 10),
  complete as (select * from typed where phone_number is not null and signup_date is not null and session_start is not null and session_end is not null),
  latest as (select * exclude (rn) from (select *, row_number() over (partition by usage_id order by ingestion_timestamp desc) as rn from complete) where rn = 1),
  sessions as (select *, {fixed("(epoch_us(session_end) - epoch_us(session_start)) / 6e7", 2)} as session_duration_minutes,
    case when data_used_mb < 500 then 'LOW' when data_used_mb <= 2000 then 'MEDIUM' else 'HIGH' end as data_usage_level,
    case when signal_strength >= -60 then 'HIGH' when signal_strength >= -90 then 'AVERAGE' else 'LOW' end as signal_strength_quality,
    case when upload_speed_mbps >= 50 then 'HIGH' when upload_speed_mbps >= 20 then 'AVERAGE' else 'LOW' end as upload_speed_quality,
    case when download_speed_mbps >= 200 then 'HIGH' when download_speed_mbps >= 50 then 'AVERAGE' else 'LOW' end as download_speed_quality,
    year(signup_date)::int as signup_year, month(signup_date)::int as signup_month, week(signup_date)::int as signup_week
    from latest where data_used_mb >= 0 and upload_speed_mbps between 0 and 100 and download_speed_mbps between 0 and 500
    and signal_strength between -120 and -40),
  customers as (select * from (select customer_id, phone_number, region, plan_type, device_type, customer_status, signup_date,
    row_number() over (partition by customer_id order by ingestion_timestamp desc, usage_id desc) as rn from sessions) where rn = 1),
  networks as (select *, row_number() over (order by network_type, tower_id, source_system) as network_key
    from (select distinct network_type, tower_id, source_system from sessions)),
  facts as (select s.*, n.network_key from sessions s left join networks n using (network_type, tower_id, source_system))"""


@check("s12_01_telecom_transform", f"with {TELECOM} select * from sessions", "fx_usage")
def telecom_transform(t):
    return telecom.transform(t.fx_usage)


@check("s12_02_telecom_dim_customer", f"with {TELECOM} select * exclude (rn) from customers", "fx_usage")
def telecom_dim_customer(t):
    return telecom.star(t.fx_usage)["dim_customer"]


@check(
    "s12_02_telecom_dim_time",
    f"""with {TELECOM} select distinct session_start, session_start::date as session_date, year(session_start)::int as session_year,
      month(session_start)::int as session_month, week(session_start)::int as session_week, dayname(session_start) as weekday_name,
      case when hour(session_start) between 5 and 11 then 'MORNING' when hour(session_start) between 12 and 16 then 'AFTERNOON'
        when hour(session_start) between 17 and 20 then 'EVENING' else 'NIGHT' end as day_period from sessions""",
    "fx_usage",
)
def telecom_dim_time(t):
    return telecom.star(t.fx_usage)["dim_time"]


@check("s12_02_telecom_dim_network", f"with {TELECOM} select * from networks", "fx_usage")
def telecom_dim_network(t):
    return telecom.star(t.fx_usage)["dim_network"]


@check("s12_03_telecom_fact", f"with {TELECOM} select {', '.join(telecom.FACT)} from facts", "fx_usage")
def telecom_fact(t):
    return telecom.star(t.fx_usage)["fact"]


@check(
    "s12_03_telecom_gold_kpis",
    f"""with {TELECOM} select signup_year, signup_month, c.region, c.plan_type, count(f.usage_id) as total_sessions,
      count(distinct f.customer_id) as active_users, {fixed("sum(data_used_mb)", 2)} as total_data_consumed_mb,
      {fixed("avg(data_used_mb)", 2)} as avg_data_usage_mb, {fixed("avg(session_duration_minutes)", 2)} as avg_session_duration,
      {fixed("avg(download_speed_mbps)", 2)} as avg_download_speed, {fixed("avg(upload_speed_mbps)", 2)} as avg_upload_speed,
      {fixed("avg(signal_strength)", 2)} as avg_signal_strength,
      count(*) filter (data_usage_level = 'LOW') as low_usage_sessions, count(*) filter (data_usage_level = 'MEDIUM') as medium_usage_sessions,
      count(*) filter (data_usage_level = 'HIGH') as high_usage_sessions, count(*) filter (network_type = '5G') as sessions_5g,
      count(*) filter (network_type = '4G') as sessions_4g, count(*) filter (network_type = 'LTE') as sessions_lte
    from facts f left join customers c on f.customer_id = c.customer_id group by signup_year, signup_month, c.region, c.plan_type""",
    "fx_usage",
)
def telecom_gold(t):
    return telecom.star(t.fx_usage)["gold_kpis"]


# --- website checks ---------------------------------------------------------

CHECKS = """clean as (select id, regexp_replace(replace(replace(lower(trim(url)), 'https://', ''), 'http://', ''), '/+$', '') as url, status_code,
    response_time_ms::double as response_time_ms, case when status_code = 999 then 'Invalid' else status_message end as status_message,
    lower(trim(fix)) as fix, checked_at from fx_checks
    where url is not null and status_code is not null and response_time_ms is not null and fix is not null and status_message is not null),
  hosted as (select *, regexp_extract(url, '^([^/?#:]+)', 1) as host from clean),
  checks as (select * exclude (host), split_part(host, '.', 1) as website_name, split_part(host, '.', -1) as "domain",
    response_time_ms / 1000.0 as response_time_s,
    case when response_time_ms <= 200 then 'fast' when response_time_ms <= 800 then 'moderate' when response_time_ms <= 1000 then 'slow' else 'critical' end as performance_bucket,
    case when status_code between 200 and 299 then 'success' when status_code between 300 and 399 then 'redirection'
      when status_code between 400 and 499 then 'client_error' when status_code between 500 and 599 then 'server_error' else 'invalid_error' end as status_group,
    status_code >= 400 as is_error, status_code between 200 and 299 as is_success, status_code between 300 and 399 as is_redirect,
    response_time_ms > 1000 as is_slow_response, checked_at::date as check_date, month(checked_at)::int as check_month,
    year(checked_at)::int as check_year, hour(checked_at)::int as check_hour, dayname(checked_at) as check_day_name,
    timestamp '2024-02-01' as ingestion_time, timestamp '2024-02-01' as load_time from hosted)"""


def _checks(t):
    return webchecks.transform(t.fx_checks, datetime(2024, 2, 1))


@check("s12_04_webchecks_transform", f"with {CHECKS} select * from checks", "fx_checks")
def webchecks_transform(t):
    return _checks(t)


REPORTS = {
    "latest": "select * from checks order by id desc limit 5",
    "total": "select count(*) as total_records from checks",
    "by_status_code": "select status_code, count(*) as status_code_count from checks group by 1",
    "by_bucket": "select performance_bucket, count(*) as bucket_count from checks group by 1",
    "by_status_group": "select status_group, count(*) as group_count from checks group by 1",
    "response_times": "select min(response_time_ms) as min_response_time, max(response_time_ms) as max_response_time, "
    + fixed("avg(response_time_ms)", 2)
    + " as avg_response_time from checks",
    "errors": "select is_error, count(*) as total from checks group by 1",
    "slowest": "select url, " + fixed("avg(response_time_ms)", 4) + " as avg_response_time from checks group by 1 order by 2 desc, 1 limit 10",
    "daily_volume": "select check_date, count(*) as total_checks from checks group by 1 order by 1 desc limit 10",
}

for _name, _sql in REPORTS.items():
    check(f"s12_05_webchecks_{_name}", f"with {CHECKS} {_sql}", "fx_checks")(
        lambda t, name=_name: webchecks.report(_checks(t))[name]
    )


# --- shop -------------------------------------------------------------------


@check(
    "s12_06_shop_ingest",
    """with s as (select *, try_strptime(order_date, '%Y-%m-%d %H:%M:%S') as order_datetime from fx_shop)
    select order_id, product, price, order_datetime, 2 as batch from s where order_datetime > timestamp '2000-01-01'""",
    "fx_shop",
)
def shop_ingest(t):
    out, mark = t.dir("ingested"), t.dir("watermark")
    early = t.fx_shop.filter("coalesce(try_to_timestamp(order_date), timestamp '1990-01-01') <= timestamp '2000-01-01'")
    marker = t.fx_shop.limit(1).withColumn("order_date", F.lit("2000-01-01 00:00:00"))
    shop.ingest(early.unionByName(marker), out, mark)
    shop.ingest(t.fx_shop, out, mark)
    table = io.read_parquet(t.spark, out)
    return table.select("order_id", "product", "price", "order_datetime", F.lit(2).alias("batch"))


SHOP = """typed as (select order_id, customer_name, product, trim(category) as category, try_cast(price as double) as price,
    try_cast(quantity as bigint) as quantity, order_date, lower(trim(status)) as status,
    try_strptime(order_date, '%Y-%m-%d %H:%M:%S') as order_datetime from fx_shop),
  single as (select * exclude (rn) from (select *, row_number() over (partition by order_id order by order_datetime, product, price, quantity, customer_name, category, status) as rn
    from typed where order_datetime is not null and price > 0 and quantity > 0) where rn = 1)
  select *, order_datetime::date as order_date_only, strftime(order_datetime, '%H:%M:%S') as order_time_only, price * quantity as order_value,
    isodow(order_datetime)::int as order_weekday, hour(order_datetime)::int as order_hour from single"""


@check("s12_07_shop_transform", f"with {SHOP}", "fx_shop")
def shop_transform(t):
    return shop.transform(t.fx_shop)


@check("s12_08_shop_load", f"with {SHOP}", "fx_shop")
def shop_load(t):
    return io.read_parquet(t.spark, shop.load(shop.transform(t.fx_shop), t.dir("shop"), datetime(2024, 2, 1)))


# --- broadcasts -------------------------------------------------------------

FIRST = "line_no, event_date, duration_minutes, ad_revenue_usd, live_viewers, country"
ORDER = ["line_no", "event_date", "duration_minutes", "ad_revenue_usd", "live_viewers", "country"]
VALID = "duration_minutes > 0 and duration_minutes < 300 and event_date is not null and event_date <> '31-12-9999'"
CLEAN = f"""clean as (select * exclude (rn) from (select *, row_number() over (partition by broadcast_id order by
    line_no, event_date nulls first, duration_minutes, ad_revenue_usd, live_viewers, country) as rn from fx_broadcasts) where rn = 1 and {VALID})"""


@check("s12_09_broadcasts_clean", f"with {CLEAN} select * from clean", "fx_broadcasts")
def broadcasts_clean(t):
    return broadcasts.clean(t.fx_broadcasts, ORDER)


@check(
    "s12_09_broadcasts_validate",
    f"select * exclude (rn) from (select *, row_number() over (partition by broadcast_id order by {FIRST}) as rn from fx_broadcasts "
    f"where event_date is not null and duration_minutes is not null) where rn = 1 and {VALID}",
    "fx_broadcasts",
)
def broadcasts_validate(t):
    return broadcasts.validate(t.fx_broadcasts, ORDER)


@check(
    "s12_10_broadcasts_summary",
    f"""with {CLEAN}, scored as (select *, case stream_quality when '4K' then 3 when 'Full HD' then 2 when 'HD' then 1 else 0 end as points,
      {fixed("duration_minutes / 60", 2)} as duration_hours from clean)
    select sport, sum(duration_minutes)::bigint as total_duration_minutes, {fixed("sum(duration_hours)", 2)} as total_duration_hours,
      {fixed("avg(duration_minutes)", 2)} as avg_duration_minutes, max(duration_minutes) as max_duration_minutes,
      min(duration_minutes) as min_duration_minutes, sum(points)::bigint as total_points, {fixed("avg(points)", 2)} as avg_quality_score,
      sum(live_viewers)::bigint as total_live_viewers, {fixed("avg(live_viewers)", 0)} as avg_live_viewers, max(live_viewers) as max_live_viewers,
      {fixed("avg(peak_viewers)", 0)} as avg_peak_viewers, max(peak_viewers) as highest_peak_viewers,
      {fixed("sum(ad_revenue_usd)", 2)} as total_ad_revenue, {fixed("avg(ad_revenue_usd)", 2)} as avg_ad_revenue,
      {fixed("max(ad_revenue_usd)", 2)} as highest_ad_revenue, count(distinct broadcast_id) as total_broadcasts,
      count(distinct network) as unique_networks_covered, {fixed("sum(ad_revenue_usd) / sum(duration_minutes)", 2)} as revenue_per_minute,
      {fixed("sum(ad_revenue_usd) / sum(live_viewers)", 4)} as revenue_per_viewer,
      {fixed("sum(live_viewers) / count(distinct broadcast_id)", 0)} as avg_viewers_per_broadcast
    from scored group by sport""",
    "fx_broadcasts",
)
def broadcasts_summary(t):
    return broadcasts.summary(broadcasts.clean(t.fx_broadcasts, ORDER))


# --- sales ------------------------------------------------------------------


@check(
    "s12_11_sales_staging",
    "select order_id, customer_id, amount, order_status, order_created_at::date as created_date, strftime(order_created_at, '%H:%M:%S') as created_time from fx_orders",
    "fx_orders",
)
def sales_staging(t):
    return sales.stage_time(t.fx_orders, "order_created_at", "created_date", "created_time")


def money(df, *names):
    """Sums of cents to two digits, so that the order of adding does not show."""
    return df.withColumns({n: F.round(n, 2) for n in names or ("total_sales_amount",)})


TOTALS = "sum(quantity) as total_quantity_sold, round(sum(sale_amount), 2) as total_sales_amount"


@check(
    "s12_12_sales_by_city_status",
    "select city, order_status, round(sum(amount), 2) as total_amount, count(order_id) as total_orders from fx_orders join fx_customers using (customer_id) group by city, order_status",
    "fx_orders fx_customers",
)
def by_city_status(t):
    return money(sales.by_city_status(t.fx_orders, t.fx_customers), "total_amount")


@check(
    "s12_13_sales_by_city",
    f"select city, product_id, product_name, count(*) as total_sales, {TOTALS} from fx_sales join fx_products using (product_id) group by 1, 2, 3",
    "fx_sales fx_products",
)
def by_city(t):
    out = money(sales.by_city(t.fx_products, t.fx_sales))
    return out.withColumn("total_sales", F.col("total_sales").cast("long"))


@check("s12_14_sales_by_customer", f"select customer_name, count(*) as total_orders, {TOTALS} from fx_sales group by 1", "fx_sales")
def by_customer(t):
    return money(sales.by_customer(t.fx_sales))


@check("s12_15_sales_by_date", f"select sale_date, count(*) as total_orders, {TOTALS} from fx_sales group by 1", "fx_sales")
def by_date(t):
    path = t.dir("by-date")
    io.write_parquet(sales.by_date(None, t.fx_sales.filter("sale_date <= '1999-06-30'")), path)
    return money(sales.by_date(io.read_parquet(t.spark, path), t.fx_sales))


@check(
    "s12_16_sales_by_payment",
    f"""with methods as (select distinct payment_method, payment_method || ' payments' as description from fx_sales where payment_method <> 'UPI')
    select case s.payment_method when 'Card' then 'Credit/Debit Card' when 'UPI' then 'Digital Wallet' when 'NetBanking' then 'Bank Transfer' else 'Other' end as payment_type,
      description as payment_method_description, count(*) as total_orders, {TOTALS}
    from fx_sales s left join methods m on s.payment_method = m.payment_method group by 1, 2""",
    "fx_sales",
)
def by_payment(t):
    methods = t.fx_sales.filter("payment_method <> 'UPI'").select("payment_method").distinct()
    methods = methods.withColumn("description", F.concat("payment_method", F.lit(" payments")))
    return money(sales.by_payment(t.fx_sales, methods))


@check(
    "s12_17_sales_by_product",
    f"select product_id, product_name, category, {TOTALS} from fx_sales join fx_products using (product_id) group by product_id, product_name, category, brand",
    "fx_sales fx_products",
)
def by_product(t):
    return money(sales.by_product(t.fx_products, t.fx_sales))


@check("s12_18_sales_products_joined", "select * from fx_sales join fx_products using (product_id)", "fx_sales fx_products")
def products_joined(t):
    return sales.products_joined(t.fx_sales, t.fx_products)


@check("s12_18_sales_completed", "select * from fx_sales join fx_products using (product_id) where sale_status = 'completed'", "fx_sales fx_products")
def completed(t):
    return sales.completed(t.fx_sales, t.fx_products)


@check("s12_18_completed_orders", "select * from fx_orders join fx_customers using (customer_id) where order_status = 'completed'", "fx_orders fx_customers")
def completed_orders(t):
    return sales.completed_orders(t.fx_orders, t.fx_customers)


@check("s12_18_customer_orders", "select * from fx_orders join fx_customers using (customer_id)", "fx_orders fx_customers")
def customer_orders(t):
    return sales.customer_orders(t.fx_orders, t.fx_customers)


@check(
    "s12_19_products_incremental",
    "select product_id, product_name, category, created_at from fx_products",
    "fx_products",
)
def products_incremental(t):
    path = t.dir("products")
    first = t.fx_products.filter("created_at < '2024-01-01'")
    io.write_parquet(sales.products_incremental(None, first), path)
    return sales.products_incremental(io.read_parquet(t.spark, path), t.fx_products)


# --- employees, medallion, customers ----------------------------------------


@check(
    "s12_20_employees_snapshot",
    """with a as (select * from (select *, row_number() over (partition by k order by commit_ts desc, seq desc) as rn from fx_changes where version <= 15) where rn = 1),
      b as (select * from (select *, row_number() over (partition by k order by commit_ts desc, seq desc) as rn from fx_changes) where rn = 1),
      now as (select coalesce(a.k, b.k) as k, case when a.k is null or a.state <> b.state then b.state else a.state end as state,
        case when a.k is null or a.state <> b.state then b.commit_ts else a.commit_ts end as valid_from from b left join a on a.k = b.k)
    select md5(k::varchar || '-' || state) as workspace_key, k, state, valid_from, null::timestamp as valid_to, true as is_current from now""",
    "fx_changes",
)
def employees_snapshot(t):
    order = ["commit_ts", "seq"]
    early = latest_per_key(t.fx_changes.filter("version <= 15"), ["k"], order)
    dim = employees.snapshot(None, early, "k", ["state"], "commit_ts")
    dim = employees.snapshot(dim, latest_per_key(t.fx_changes, ["k"], order), "k", ["state"], "commit_ts")
    return employees.keyed_current(dim, "k", "state")


SILVER = """orders_ as (select *, month(order_created_at)::int as order_month, year(order_created_at)::int as order_year,
    order_created_at::date as order_date, (order_status = 'completed')::int as status_indicator from fx_orders),
  customers_ as (select customer_id, customer_name, city as neighbourhood, customer_segment, account_status,
    (customer_segment = 'BUILDING')::int as customer_segment_indicator, (account_status = 'Active')::int as account_status_indicator from fx_customers)"""


@check("s12_21_orders_bronze", "select *, timestamp '2024-02-01' as _ingest_time from fx_orders", "fx_orders")
def orders_bronze(t):
    return medallion.bronze(t.fx_orders, datetime(2024, 2, 1))


@check("s12_21_orders_silver", f"with {SILVER} select * from orders_", "fx_orders fx_customers")
def orders_silver(t):
    return medallion.silver_orders(t.fx_orders, "completed")


@check("s12_21_customers_silver", f"with {SILVER} select * from customers_", "fx_orders fx_customers")
def customers_silver(t):
    return medallion.silver_customers(t.fx_customers, "BUILDING")


@check(
    "s12_21_orders_gold",
    f"with {SILVER} select order_month, order_year, customer_segment, account_status, count(*) as orders, sum(status_indicator)::bigint as delivered_orders, "
    f"{fixed('sum(amount)', 2)} as total_value, {fixed('avg(amount)', 2)} as avg_value from orders_ join customers_ using (customer_id) group by 1, 2, 3, 4",
    "fx_orders fx_customers",
)
def orders_gold(t):
    return medallion.gold_orders(
        medallion.silver_orders(t.fx_orders, "completed"), medallion.silver_customers(t.fx_customers, "BUILDING")
    )


@check("s12_22_events_gold", "select date_trunc('hour', ts) as window_start, event_type, count(*) as count from events group by 1, 2")
def events_gold(t):
    layers = medallion.silver_events(medallion.bronze_events(t.events, datetime(2024, 2, 1), files=True))
    return medallion.gold_events(layers).drop("window_end")


@check(
    "s12_23_customers_incremental",
    """select layer, k, state, commit_ts from (select k, state, commit_ts, row_number() over (partition by k order by commit_ts desc, seq desc) as rn from fx_changes)
      cross join (values ('silver'), ('gold')) as l(layer) where rn = 1""",
    "fx_changes",
)
def customers_incremental(t):
    schema = "k BIGINT, state STRING, commit_ts TIMESTAMP_NTZ"
    layers = customers.Layers(t.dir("bronze"), t.dir("silver"), t.dir("gold"))
    spans = [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]
    for low, high in [*spans, spans[1]]:
        inside = (F.col("commit_ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("commit_ts") < F.lit(high).cast("timestamp_ntz"))
        path = t.dir("day")
        day = latest_per_key(t.fx_changes.filter(inside), ["k"], ["commit_ts", "seq"])
        io.write_csv(day.select("k", "state", "commit_ts"), path)
        customers.load_day(t.spark, path, schema, low, layers, ["k"], "commit_ts", buckets=8)
    silver, gold = (BucketTable(layer, ["k"], 8).read(t.spark) for layer in (layers.silver, layers.gold))
    return silver.withColumn("layer", F.lit("silver")).unionByName(gold.withColumn("layer", F.lit("gold")))


@check(
    "s12_24_customer_spend",
    "select customer_id, round(total_spent, 2) as total_spent from (select customer_id, sum(amount) as total_spent from fx_orders "
    "where order_created_at >= date '1998-06-30' - interval 30 day and order_created_at < date '1998-07-01' group by 1) where total_spent > 1000",
    "fx_orders",
)
def customer_spend(t):
    return money(customers.spend(t.fx_orders, date(1998, 6, 30)), "total_spent")


# --- weather, checkout, regional --------------------------------------------


READINGS = """readings as (select * from (select *, strptime(fetched_at, '%Y-%m-%dT%H:%M:%S') as event_time,
    row_number() over (partition by city, fetched_at) as rn from fx_weather) where rn = 1)"""


def _topic(t):
    kv = weather_kv(t)
    return streamio.kafka_source(t.spark, topic="weather", directory=landed(t, kv), max_files=2 * spread(kv))


@check(
    "s12_25_weather_averages",
    f"""with r as (select distinct fetched_at, city, temp_c, humidity from fx_weather)
    select date_trunc('minute', strptime(fetched_at, '%Y-%m-%dT%H:%M:%S')) as window_start, city, count(*) as readings,
      {fixed("avg(temp_c)", 4)} as avg_temp, max(humidity) as max_humidity from r group by 1, 2""",
    "fx_weather",
)
def weather_averages(t):
    averages = weather.averages(weather.readings(_topic(t), ANY_DELAY))
    out = to_state(t, averages, ["window_start", "city"])
    rounded = out.withColumn("avg_temp", exprs.stable_round("avg_temp", 4))
    return ntz(rounded, "window_start").select("window_start", "city", "readings", "avg_temp", "max_humidity")


@check(
    "s12_25_weather_hot_alerts",
    """select city as key, '{"city":"' || city || '","humidity":' || humidity || '}' as value from fx_weather where temp_c > 45""",
    "fx_weather",
)
def weather_hot_alerts(t):
    decoded = streamio.decode_events(_topic(t), weather.SCHEMA)
    alerts = to_files(t, weather.hot_alerts(decoded, 45))
    back = streamio.decode_events(alerts, weather.SCHEMA)
    return streamio.encode_events(back, "city", ["city", "humidity"])


@check(
    "s12_25_weather_alert_join",
    """with w as (select *, strptime(fetched_at, '%Y-%m-%dT%H:%M:%S') as at from fx_weather)
    select a.city, a.event_id as alert_id, b.event_id, a.at as alert_time, b.at as event_time from w a join w b
    on a.city = b.city and b.at >= a.at and b.at <= a.at + interval 15 minute where a.temp_c > 45""",
    "fx_weather",
)
def weather_alert_join(t):
    def timed():
        decoded = streamio.decode_events(_topic(t), weather.SCHEMA)
        return decoded.withColumn("event_time", F.to_timestamp("fetched_at", weather.TIME_FORMAT).cast("timestamp_ntz"))

    lists = to_files(t, weather.alerts_with_readings(stream.filter_alerts(timed(), "temp_c", 45), timed(), ANY_DELAY))
    return weather.alert_pairs(lists).select("city", "alert_id", "event_id", "alert_time", "event_time")


@check(
    "s12_26_checkout_audit",
    """select order_status, old_status, new_status, count(*) as events, count(*) filter (new_status = 'FAILED') as failures,
      count(*) filter (new_status = 'REFUNDED') as refunds, round(cast(avg(risk_score) as decimal(38,9)), 4)::double as avg_risk,
      sum(json_extract(metadata, '$.k')::bigint)::bigint as metadata_total
    from fx_audit join fx_orders on checkout_id = order_id group by 1, 2, 3""",
    "fx_audit fx_orders",
)
def checkout_audit(t):
    transactions = t.fx_orders.withColumnRenamed("order_id", "checkout_id")
    return checkout.audit(transactions, t.fx_audit, "order_status", "k BIGINT")


@check("s12_26_checkout_latest", "select * from fx_audit order by event_time desc, audit_id desc limit 5", "fx_audit")
def checkout_latest(t):
    return checkout.latest(t.fx_audit)


@check("s12_26_checkout_exists", "select count(*) > 0 as found from fx_audit where new_status = 'REFUNDED'", "fx_audit")
def checkout_exists(t):
    return checkout.has_transition(t.fx_audit, "REFUNDED")


@check(
    "s12_27_country_sales",
    "select city, round(sum(sale_amount), 2) as sales, round(round(sum(sale_amount), 2) * 10, 2) as adjusted_sales from fx_sales group by city",
    "fx_sales",
)
def country_sales(t):
    per_country = t.fx_sales.groupBy("city").agg(F.round(F.sum("sale_amount"), 2).alias("sales"))
    return money(regional.country_sales(per_country), "adjusted_sales")


@check(
    "s12_28_orders_expectations",
    "select city, count(*) as orders from (select nullif(order_id % 11, 0) as ok, * from fx_orders) join fx_customers using (customer_id) where ok is not null group by city",
    "fx_orders fx_customers",
)
def orders_expectations(t):
    landed_orders = t.fx_orders.join(t.fx_customers, "customer_id").withColumn(
        "order_id", F.when(F.col("order_id") % 11 != 0, F.col("order_id"))
    )
    return regional.orders_expectations(landed_orders)


@check(
    "s12_28_orders_expectations_stream",
    "select city, count(*) as orders from (select nullif(order_id % 11, 0) as ok, * from fx_orders) join fx_customers using (customer_id) where ok is not null group by city",
    "fx_orders fx_customers",
)
def orders_expectations_stream(t):
    orders = t.fx_orders.join(t.fx_customers, "customer_id").withColumn("order_id", F.when(F.col("order_id") % 11 != 0, F.col("order_id")))
    # every order lands twice
    twice = orders.union(orders)
    source = streamio.read_files(t.spark, landed(t, twice), orders.schema, max_files=spread(twice))
    kept = to_files(t, regional.orders_expectations_stream(source, "5000 days"))
    return kept.groupBy("city").agg(F.count(F.lit(1)).alias("orders"))


@check("s11_17_snapshot_first", "select k, state, commit_ts as valid_from, null::timestamp as valid_to, true as is_current from (select *, row_number() over (partition by k order by commit_ts desc, seq desc) as rn from fx_changes) where rn = 1", "fx_changes")
def first_snapshot(t):
    return scd.first_snapshot(latest_per_key(t.fx_changes, ["k"], ["commit_ts", "seq"]), ["k"], ["state"], F.col("commit_ts"))
