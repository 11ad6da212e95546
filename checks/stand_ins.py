"""Views over the given tables that stand for the data sets the plans work on.

Each text runs unchanged on Spark and on the oracle. Each plants the dirt its plan must clean.
"""

STAND_INS = {
    "fx_orders": """
select o_orderkey as order_id, o_custkey as customer_id, o_totalprice as amount,
  case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' else 'cancelled' end as order_status,
  o_orderdate as order_created_at from orders
""",
    "fx_customers": """
select c_custkey as customer_id, c_name as customer_name, n_name as city,
  c_mktsegment as customer_segment, case when c_acctbal < 0 then 'Inactive' else 'Active' end as account_status
  from customer join nation on c_nationkey = n_nationkey
""",
    "fx_products": """
select p_partkey as product_id, p_name as product_name, p_type as category, p_brand as brand,
  p_retailprice as unit_price, p_size % 2 = 0 as is_active,
  case when p_partkey % 3 = 0 then date '2023-12-31' when p_partkey % 3 = 1 then date '2024-01-02' else date '2024-02-01' end as created_at from part
""",
    "fx_sales": """
select l_orderkey as sale_id, l_linenumber as line_no, l_partkey as product_id, c_name as customer_name, n_name as city,
  l_quantity as quantity, l_extendedprice as sale_amount,
  case l_returnflag when 'A' then 'Card' when 'N' then 'UPI' when 'R' then 'NetBanking' end as payment_method,
  case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' else 'cancelled' end as sale_status,
  cast(l_shipdate as date) as sale_date
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""",
    "fx_usage": """
select case when event_id % 10 = 0 then event_id + 1 else event_id end as usage_id, user_id as customer_id,
  case when event_id % 50 = 0 then concat('9', cast(10000000000 + user_id as string)) else cast(9000000000 + user_id as string) end as phone_number,
  case user_id % 4 when 0 then ' north' when 1 then 'south ' when 2 then 'East' else 'WEST' end as region,
  case user_id % 3 when 0 then 'prepaid' when 1 then 'Postpaid' else 'business ' end as plan_type,
  case user_id % 2 when 0 then 'android' else 'iOS' end as device_type,
  case when user_id % 5 = 0 then 'inactive' else 'active' end as customer_status,
  case when event_id % 97 = 0 then 'n/a' else cast(date '2023-01-15' + cast(user_id % 300 as int) as string) end as signup_date,
  concat('T', cast(user_id % 20 as string)) as tower_id,
  case when event_id % 89 = 0 then null else substr(cast(ts as string), 1, 19) end as session_start,
  substr(cast(case event_id % 3 when 0 then ts + interval '15' minute when 1 then ts + interval '40' minute else ts + interval '2' hour end as string), 1, 19) as session_end,
  value * 20 - 10 as data_used_mb,
  case event_id % 3 when 0 then '5G' when 1 then '4G' else 'LTE' end as network_type,
  -(30 + event_id % 100) as signal_strength,
  cast(event_id % 110 as double) as upload_speed_mbps, cast(event_id % 520 as double) as download_speed_mbps,
  case when event_id % 2 = 0 then 'crm' else 'Billing' end as source_system, ts as ingestion_timestamp from events
""",
    "fx_checks": """
select e.event_id as id, case when e.event_id % 101 = 0 then null else concat(' ', upper(p.url), '/') end as url,
  case e.event_id % 8 when 0 then 200 when 1 then 204 when 2 then 301 when 3 then 404 when 4 then 500 when 5 then 999 when 6 then 200 else null end as status_code,
  case when e.event_id % 103 = 0 then null else e.value * 12 end as response_time_ms,
  e.event_type as status_message, concat(e.event_type, ' ') as fix, e.ts as checked_at
  from (select *, event_id % (select count(*) from pages) as page_no from events) e join pages p on e.page_no = p.page_id
""",
    "fx_shop": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as order_id, c_name as customer_name, p_name as product,
  concat(' ', p_type) as category, case when l_partkey % 40 = 0 then 'bad' else cast(l_extendedprice as string) end as price,
  case when l_partkey % 41 = 0 then '0' else cast(cast(l_quantity as int) as string) end as quantity,
  case when l_partkey % 43 = 0 then 'not-found' else substr(cast(l_shipdate as string), 1, 19) end as order_date,
  case o_orderstatus when 'F' then ' Shipped' when 'O' then 'Processing ' else 'CANCELLED' end as status
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey
""",
    "fx_broadcasts": """
select l_orderkey as broadcast_id, l_linenumber as line_no,
  case when l_partkey % 37 = 0 then '31-12-9999' when l_partkey % 53 = 0 then null else substr(cast(l_shipdate as string), 1, 10) end as event_date,
  p_type as sport, p_brand as network, n_name as country, cast(l_quantity as int) * 8 - 20 as duration_minutes,
  l_partkey * 100 + 1 as live_viewers, l_partkey * 130 + 1 as peak_viewers, l_extendedprice as ad_revenue_usd,
  case l_linenumber % 4 when 0 then '4K' when 1 then 'Full HD' when 2 then 'HD' else 'SD' end as stream_quality
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
""",
    "fx_weather": """
select concat('city', cast(user_id % 5 as string)) as city, cast(substr(cast(ts as string), 18, 2) as double) + user_id % 5 as temp_c,
  cast(substr(cast(ts as string), 15, 2) as int) as humidity,
  event_type as condition, replace(substr(cast(ts as string), 1, 19), ' ', 'T') as fetched_at, event_id from events
""",
    "fx_changes": """
select user_id as k, event_type as state, value as amount,
  case event_type when 'error' then 'D' when 'signup' then 'I' else 'U' end as op, ts as commit_ts, event_id as seq,
  cast(extract(day from ts) as int) as version from events
""",
    "fx_audit": """
select e.event_id as audit_id, e.event_id * 2 as checkout_id,
  case e.event_id % 4 when 0 then 'PENDING' when 1 then 'SUCCESS' when 2 then 'FAILED' else 'REFUNDED' end as new_status,
  case e.user_id % 4 when 0 then 'PENDING' when 1 then 'SUCCESS' when 2 then 'FAILED' else 'REFUNDED' end as old_status,
  e.value as risk_score, e.ts as event_time, e.props as metadata from events e
""",
}
