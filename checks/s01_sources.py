"""Sources, sinks and formats: written to a work directory, read back, compared."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from checks.registry import check
from tablekit import storage
from tablekit.operators import join
from tablekit.sources import io, streamio
from tablekit.streaming import stream
from tablekit.streaming.batches import BatchTable

ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"
ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


@check("s01_01_read_csv", "select c_custkey, c_name, c_acctbal from customer")
def read_csv(t):
    path = t.dir("csv")
    io.write_csv(t.customer, path)
    return io.read_csv(t.spark, path).select(F.col("c_custkey").cast("long"), "c_name", "c_acctbal")


def _dirty_csv(t):
    path = t.dir("dirty-csv")
    io.write_csv(t.fx_usage.select("usage_id", "signup_date", "data_used_mb"), path)
    return path


DIRTY_DDL = "usage_id BIGINT, signup_date DATE, data_used_mb DOUBLE"


@check(
    "s01_02_read_csv_strict",
    "select usage_id, try_cast(signup_date as date) as signup_date, data_used_mb from fx_usage",
    "fx_usage",
)
def read_csv_strict(t):
    return io.read_csv_strict(t.spark, _dirty_csv(t), DIRTY_DDL)


@check(
    "s01_03_inference_report",
    """select 'usage_id' as "column", 'int' as inferred_type, 'bigint' as declared_type, 0::bigint as cells_nulled
    union all select 'signup_date', 'string', 'date',
      count(*) filter (signup_date is not null and try_cast(signup_date as date) is null) from fx_usage
    union all select 'data_used_mb', 'double', 'double', 0""",
    "fx_usage",
)
def inference_report(t):
    return io.inference_report(t.spark, _dirty_csv(t), DIRTY_DDL)


@check("s01_04_write_csv", "select p_partkey, p_name, p_brand, p_retailprice from part")
def write_csv(t):
    path = t.dir("piped")
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice")
    io.write_csv(part, path, mode="overwrite", delimiter="|")
    return io.read_csv(t.spark, path, part.schema, delimiter="|")


@check(
    "s01_05_read_json",
    "select s_suppkey as id, s_name as name, n_name as city, r_name as country from supplier "
    "join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
)
def read_json(t):
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    nested = t.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("country")).alias("location"),
    )
    path = t.dir("json")
    io.write_json(nested, path)
    back = io.read_json(t.spark, path, "id BIGINT, name STRING, location STRUCT<city: STRING, country: STRING>")
    return back.select("id", "name", "location.city", "location.country")


@check("s01_06_parquet", ORDERS)
def parquet(t):
    path = t.dir("parquet")
    io.write_parquet(t.orders, path)
    return io.read_parquet(t.spark, path)


@check("s01_07_convert", ORDERS)
def convert(t):
    csv, parquet = t.dir("convert-csv"), t.dir("convert-parquet")
    io.write_csv(t.orders, csv)
    io.convert(t.spark, csv, "csv", parquet, "parquet", ORDERS_DDL)
    return io.read_parquet(t.spark, parquet)


@check("s01_08_write_modes", "select p_brand, 2 * count(*) as rows, false as error_wrote from part group by p_brand")
def write_modes(t):
    path = t.dir("modes")
    part = t.part.select("p_partkey", "p_brand")
    io.write(part, path, "append")
    io.write(part, path, "overwrite")
    io.write(part, path, "append")
    io.write(part, path, "ignore")
    try:
        io.write(part, path, "error")
        wrote = True
    except Exception:
        wrote = False
    table = io.read_parquet(t.spark, path)
    return table.groupBy("p_brand").agg(F.count(F.lit(1)).alias("rows"), F.lit(wrote).alias("error_wrote"))


@check("s01_09_write_partitioned", ORDERS)
def write_partitioned(t):
    path = t.dir("by-status")
    io.write_partitioned(t.orders, path, ["o_orderstatus"])
    return io.read_parquet(t.spark, path).select(*t.orders.columns)


@check(
    "s01_10_overwrite_partitions",
    "select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then 0 else o_totalprice end as o_totalprice from orders",
)
def overwrite_partitions(t):
    path = t.dir("replace-parts")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    io.write_partitioned(orders, path, ["o_orderstatus"])
    batch = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    io.overwrite_partitions(batch, path, ["o_orderstatus"])
    return io.read_parquet(t.spark, path).select(*orders.columns)


REPLACED = """select o_orderkey, o_orderpriority,
  case when o_orderpriority = '1-URGENT' then o_totalprice * 2 else o_totalprice end as o_totalprice from orders"""


@check("s01_11_replace_where", REPLACED)
def replace_where(t):
    path = t.dir("replace-where")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    io.write_parquet(orders, path)
    batch = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        io.replace_where(batch, path, "o_orderpriority = '1-URGENT'")
    return io.read_parquet(t.spark, path)


@check("s01_11_replace_where_partitioned", REPLACED)
def replace_where_partitioned(t):
    path = t.dir("replace-where-parts")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    io.write_partitioned(orders, path, ["o_orderpriority"])
    batch = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    io.replace_where(batch, path, "o_orderpriority = '1-URGENT'", ["o_orderpriority"])
    return io.read_parquet(t.spark, path).select(*orders.columns)


def _database(t) -> str:
    name = f"checks_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{t.dir('database')}'")
    return name


@check(
    "s01_12_catalog_tables",
    "select o_orderpriority, count(*) as orders, round(sum(o_totalprice), 2) as amount from orders "
    "group by o_orderpriority having count(*) > 1",
)
def catalog_tables(t):
    db = _database(t)
    io.save_managed(t.orders.select("o_orderkey", "o_orderpriority"), f"{db}.managed")
    io.save_external(t.orders.select("o_orderkey", "o_totalprice"), f"{db}.external", t.dir("external"))
    return t.spark.sql(
        f"select o_orderpriority, count(*) as orders, round(sum(o_totalprice), 2) as amount "
        f"from {db}.managed join {db}.external using (o_orderkey) group by o_orderpriority having count(*) > 1"
    )


@check("s01_13_create_table", "select c_custkey, c_name, c_mktsegment from customer")
def create_table(t):
    name = f"{_database(t)}.customers"
    columns = "c_custkey BIGINT, c_name STRING, c_mktsegment STRING"
    io.create_table(t.spark, name, columns, ["c_mktsegment"], t.dir("declared"))
    spread = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)
    return t.spark.table(name)


@check(
    "s01_14_load_seed",
    "select n_name as description, count(*) as customers from customer join nation on c_nationkey = n_nationkey group by n_name",
)
def load_seed(t):
    path = t.dir("seed")
    io.write_csv(t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("description")), path)
    seed = io.load_seed(t.spark, path, "code INT, description STRING")
    customers = t.customer.withColumnRenamed("c_nationkey", "code")
    return join.inner(customers, seed, ["code"]).groupBy("description").agg(F.count(F.lit(1)).alias("customers"))


@check("s01_15_copy_into", ORDERS)
def copy_into(t):
    src, table, ledger = t.dir("drops"), t.dir("copied"), t.dir("ledger")
    io.write_csv(t.orders.filter("o_orderstatus = 'F'"), f"{src}/first")
    io.copy_into(t.spark, src, table, ledger, "csv", ORDERS_DDL)
    io.write_csv(t.orders.filter("o_orderstatus <> 'F'"), f"{src}/second")
    io.copy_into(t.spark, src, table, ledger, "csv", ORDERS_DDL)
    again = io.copy_into(t.spark, src, table, ledger, "csv", ORDERS_DDL)
    assert again.files == 0
    return io.read_parquet(t.spark, table)


@check("s01_16_copy_table", ORDERS)
def copy_table(t):
    path = t.dir("copy")
    for _ in range(2):
        io.copy_table(t.orders, path, "o_orderkey", 4)
    return io.read_parquet(t.spark, path)


def _profile(position: int, name: str, kind: str) -> str:
    longest = f"max(length({name}))::int" if kind == "string" else "null::int"
    return (
        f"select {position} as position, '{name}' as \"column\", '{kind}' as type, {longest} as max_length, "
        f"null::int as precision, count(*) filter ({name} is null) as nulls, count(*) as rows from customer"
    )


@check(
    "s01_17_table_profile",
    " union all ".join(
        _profile(i, n, k)
        for i, (n, k) in enumerate(
            [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
            start=1,
        )
    ),
)
def table_profile(t):
    return io.table_profile(t.customer)


@check("s01_18_export_csv", "select s_suppkey as id, s_name as name, n_name as nation from supplier join nation on s_nationkey = n_nationkey")
def export_csv(t):
    path = t.dir("export")
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    io.export_csv(named.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("nation")), path)
    return io.read_csv(t.spark, path, "id BIGINT, name STRING, nation STRING")


# --- streams ----------------------------------------------------------------

EVENTS = "select event_id, ts, user_id, event_type, value, props from events"


#: Bytes of input for each file that lands, about.
LANDING_BYTES = 8 << 20


def spread(df) -> int:
    """How many files stand for one of a small table's, in a landing directory and in a batch."""
    return max(1, math.ceil(storage.input_bytes(df) / (4 * LANDING_BYTES)))


def landed(t, df, files: int = 4) -> str:
    """A landing directory with several files, so a stream takes several batches."""
    path = t.dir("landing")
    df.repartition(files * spread(df)).write.parquet(path)
    return path


@check("s01_19_read_files", EVENTS)
def read_files(t):
    source = streamio.read_files(t.spark, landed(t, t.events), t.events.schema, max_files=spread(t.events))
    out = t.dir("files-out")
    stream.drain(stream.start(source, out, "append", t.dir("ckpt")))
    return t.spark.read.parquet(out)


def _drifting(t) -> str:
    """JSON lines in which some rows have a new field and some a value of the wrong type."""
    user = F.when(F.col("event_id") % 7 == 0, F.lit('"bad"')).otherwise(F.col("user_id").cast("string"))
    line = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"),
        F.lit(',"user_id":'), user,
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(',"event_type":"'), F.col("event_type"), F.lit('"'))).otherwise(""),
        F.lit("}"),
    )
    path = t.dir("drift")
    t.events.select(line.alias("value")).repartition(3).write.text(path)
    return path


@check(
    "s01_20_auto_ingest_rescue",
    """select event_id, case when event_id % 7 <> 0 then user_id end as user_id,
      case when event_id % 21 = 0 then '{"user_id":"bad","event_type":"' || event_type || '"}'
        when event_id % 7 = 0 then '{"user_id":"bad"}'
        when event_id % 3 = 0 then '{"event_type":"' || event_type || '"}' end as _rescued_data from events""",
)
def auto_ingest_rescue(t):
    source = streamio.auto_ingest(t.spark, _drifting(t), "event_id BIGINT, user_id BIGINT", streamio.RESCUE, max_files=1)
    out = t.dir("rescued")
    stream.drain(stream.start(source, out, "append", t.dir("ckpt")))
    return t.spark.read.parquet(out)


@check(
    "s01_20_auto_ingest_add_columns",
    """select event_id, case when event_id % 7 <> 0 then user_id end as user_id,
      case when event_id % 3 = 0 then event_type end as event_type,
      case when event_id % 7 = 0 then '{"user_id":"bad"}' end as _rescued_data from events""",
)
def auto_ingest_add(t):
    path, schema = _drifting(t), "event_id BIGINT, user_id BIGINT"
    found = streamio.discover_columns(t.spark, path, schema)
    source = streamio.auto_ingest(t.spark, path, schema, streamio.ADD, found)
    out = t.dir("added")
    stream.drain(stream.start(source, out, "append", t.dir("ckpt")))
    return t.spark.read.parquet(out)


@check(
    "s01_20_auto_ingest_live",
    """select event_id, case when event_id % 7 <> 0 then user_id end as user_id,
      case when event_id % 3 = 0 then event_type end as event_type,
      case when event_id % 7 = 0 then '{"user_id":"bad"}' end as _rescued_data from events""",
)
def auto_ingest_live(t):
    table = t.dir("live")
    stream.drain(streamio.ingest(t.spark, _drifting(t), table, "event_id BIGINT, user_id BIGINT", t.dir("ckpt"), max_files=1))
    return streamio.read_ingested(t.spark, table)


def _csv_days(t) -> str:
    """CSV files of two headers: the later ones have a column more, in another place, and a cell that is no number."""
    path = t.dir("csv-landing")
    plain = t.events.select("event_id", "user_id")
    more = t.events.select("event_type", F.when(F.col("event_id") % 10 == 0, "none").otherwise(F.col("user_id").cast("string")).alias("user_id"), "event_id")
    for df in (plain.filter("event_id % 2 = 0"), more.filter("event_id % 2 = 1 or event_id % 10 = 0")):
        df.coalesce(2).write.mode("append").option("header", True).csv(path)
    return path


CSV_DAYS = """select event_id, user_id, null as event_type, null as _rescued_data from events where event_id % 2 = 0
  union all select event_id, case when event_id % 10 <> 0 then user_id end, event_type, case when event_id % 10 = 0 then '{"user_id":"none"}' end
  from events where event_id % 2 = 1 or event_id % 10 = 0"""


@check("s01_20_auto_ingest_csv", CSV_DAYS)
def auto_ingest_csv(t):
    table = t.dir("live-csv")
    stream.drain(streamio.ingest(t.spark, _csv_days(t), table, "event_id BIGINT, user_id BIGINT", t.dir("ckpt"), "csv", max_files=1))
    return streamio.read_ingested(t.spark, table)


@check("s01_20_auto_ingest_none", f"select event_id, user_id from ({CSV_DAYS})")
def auto_ingest_none(t):
    table = t.dir("live-none")
    stream.drain(streamio.ingest(t.spark, _csv_days(t), table, "event_id BIGINT, user_id BIGINT", t.dir("ckpt"), "csv", streamio.NONE, max_files=2))
    return streamio.read_ingested(t.spark, table)


@check("s01_21_labelled", "select event_id as value, upper(cast(event_id as varchar)) as label from events")
def labelled(t):
    return streamio.labelled(t.events.select(F.col("event_id").alias("value")))


def weather_kv(t):
    """Weather events as key/value rows of a topic."""
    w = t.fx_weather
    return w.select(
        F.col("city").alias("key"),
        F.to_json(F.struct("city", "temp_c", "humidity", "condition", "fetched_at", "event_id")).alias("value"),
        F.lit("weather").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


WEATHER = "select city, temp_c, humidity, condition, fetched_at, event_id from fx_weather"
WEATHER_DDL = "city STRING, temp_c DOUBLE, humidity INT, condition STRING, fetched_at STRING, event_id BIGINT"


@check("s01_22_decode_events", WEATHER.replace("select ", "select city as key, "), "fx_weather")
def decode_events(t):
    return streamio.decode_events(weather_kv(t), WEATHER_DDL)


ENCODED = """select city as key, '{"city":"' || city || '","event_id":' || event_id || ',"humidity":' || humidity || '}' as value
  from fx_weather where temp_c > 20"""


@check("s01_23_encode_events", ENCODED, "fx_weather")
def encode_events(t):
    return streamio.encode_events(t.fx_weather, "city", ["city", "event_id", "humidity"], F.col("temp_c") > 20)


@check("s01_24_topic_round_trip", ENCODED, "fx_weather")
def topic_round_trip(t):
    kv = weather_kv(t)
    topic = streamio.kafka_source(t.spark, topic="weather", directory=landed(t, kv), max_files=2 * spread(kv))
    decoded = streamio.decode_events(topic, WEATHER_DDL)
    out = t.dir("topic")
    alerts = streamio.encode_events(decoded, "city", ["city", "event_id", "humidity"], F.col("temp_c") > 20)
    stream.drain(streamio.kafka_sink(alerts, t.dir("ckpt"), directory=out))
    return t.spark.read.parquet(out)


@check("s01_25_write_table", EVENTS)
def write_table(t):
    source = streamio.read_files(t.spark, landed(t, t.events), t.events.schema, max_files=2 * spread(t.events))
    out = t.dir("table")
    stream.drain(streamio.write_table(source, out, t.dir("ckpt"), by=["event_type"]))
    return t.spark.read.parquet(out).select(*t.events.columns)


@check(
    "s01_26_fan_out",
    """select 'archive' as sink, count(*) as rows, sum(event_id)::bigint as ids from events
    union all select 'state', count(*), sum(event_id)::bigint from
      (select max(event_id) as event_id from events group by user_id)""",
)
def fan_out(t):
    keep = t.events.select("user_id", "event_id", "value")
    source = streamio.read_files(t.spark, landed(t, keep), keep.schema, max_files=spread(keep))
    archive = t.dir("archive")
    state = BatchTable(t.dir("state"), ["user_id"], keep.schema)
    sinks = [streamio.batch_directory(archive), stream.upsert_sink(state, ["event_id"])]
    stream.drain(streamio.fan_out(source, sinks, t.dir("ckpt")))

    def summary(df, name):
        return df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))

    return summary(t.spark.read.parquet(archive), "archive").union(summary(state.read(t.spark), "state"))


@check("s01_27_read_table_stream", EVENTS)
def read_table_stream(t):
    source = streamio.read_table_stream(t.spark, landed(t, t.events), max_files=2 * spread(t.events))
    out = t.dir("table-stream")
    stream.drain(stream.start(source, out, "append", t.dir("ckpt")))
    return t.spark.read.parquet(out)
