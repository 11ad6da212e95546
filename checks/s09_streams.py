"""Streams: drained with ``availableNow`` and compared with the finished table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, fixed
from checks.s01_sources import landed, spread
from checks.s03_joins import INTERVAL, signups_and_buys
from tablekit.functions.exprs import stable_round
from tablekit.operators import events, history
from tablekit.sources import streamio
from tablekit.streaming import stream
from tablekit.streaming.batches import BatchTable

ANY_DELAY = "60 days"  # longer than the test events last, for files that land in any order


def landed_in_order(t, df, ts: str, cuts: list[str], tail=None) -> str:
    """Files that land one after the other in event-time order, ``spread(df)`` for each batch, then ``tail`` for two."""
    path = t.dir("ordered-landing")
    edges, files = [None, *cuts, None], spread(df)
    for low, high in zip(edges, edges[1:]):
        part = df
        if low:
            part = part.filter(F.col(ts) >= F.lit(low).cast("timestamp_ntz"))
        if high:
            part = part.filter(F.col(ts) < F.lit(high).cast("timestamp_ntz"))
        part.repartition(files).write.mode("append").parquet(path)
    for _ in range(2 * files if tail is not None else 0):
        tail.coalesce(1).write.mode("append").parquet(path)
    return path


def source(t, df, files: int = 4, per_batch: int = 2):
    return streamio.read_files(t.spark, landed(t, df, files), df.schema, max_files=per_batch * spread(df))


def to_files(t, df):
    out = t.dir("out")
    stream.drain(stream.start(df, out, "append", t.dir("ckpt")))
    return t.spark.read.parquet(out)


def to_state(t, df, keys, mode="update"):
    state = BatchTable(t.dir("state"), keys, df.schema)
    stream.drain(stream.start(df, stream.latest_state_sink(state), mode, t.dir("ckpt")))
    return state.read(t.spark)


def weather(t):
    return stream.with_event_time(source(t, t.fx_weather), "fetched_at", "yyyy-MM-dd'T'HH:mm:ss", ANY_DELAY, "event_time")


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@check("s09_01_with_event_time", "select city, event_id, strptime(fetched_at, '%Y-%m-%dT%H:%M:%S') as event_time from fx_weather", "fx_weather")
def with_event_time(t):
    return ntz(to_files(t, weather(t).select("city", "event_id", "event_time")), "event_time")


BUCKETS = f"""select time_bucket(interval 1 hour, strptime(fetched_at, '%Y-%m-%dT%H:%M:%S')) as window_start, city,
  {fixed('avg(temp_c)', 4)} as avg_temp, max(humidity) as max_humidity, count(*) as readings from fx_weather group by 1, 2"""


def temps():
    return [F.avg("temp_c").alias("avg_temp"), F.max("humidity").alias("max_humidity"), F.count(F.lit(1)).alias("readings")]


def _rounded(df):
    return ntz(df, "window_start").drop("window_end").withColumn("avg_temp", stable_round("avg_temp", 4))


@check("s09_02_tumbling", BUCKETS, "fx_weather")
def tumbling(t):
    return _rounded(to_state(t, stream.tumbling(weather(t), "event_time", "1 hour", ["city"], temps()), ["window_start", "city"], "complete"))


SLIDES = f"""with h as (select strptime(fetched_at, '%Y-%m-%dT%H:%M:%S') as seen_at, city, humidity from fx_weather),
  s as (select time_bucket(interval 1 hour, seen_at) as window_start, city, humidity from h
    union all select time_bucket(interval 1 hour, seen_at) - interval 1 hour, city, humidity from h)
  select window_start, city, {fixed('avg(humidity)', 4)} as avg_humidity from s group by 1, 2"""


@check("s09_03_sliding", SLIDES, "fx_weather")
def sliding(t):
    agg = [F.avg("humidity").alias("avg_humidity")]
    out = to_state(t, stream.sliding(weather(t), "event_time", "2 hours", "1 hour", ["city"], agg), ["window_start", "city"])
    return ntz(out, "window_start").drop("window_end").withColumn("avg_humidity", stable_round("avg_humidity", 4))


@check("s09_04_dedup", "select distinct city, strptime(fetched_at, '%Y-%m-%dT%H:%M:%S') as event_time from fx_weather", "fx_weather")
def dedup(t):
    twice = t.fx_weather.union(t.fx_weather)
    timed = stream.with_event_time(source(t, twice), "fetched_at", "yyyy-MM-dd'T'HH:mm:ss", ANY_DELAY, "event_time")
    single = stream.dedup(timed, ["city", "event_time"], "event_time")
    return ntz(to_files(t, single.select("city", "event_time")), "event_time")


@check("s09_04_dedup_within_watermark", "select event_id, user_id, value from events")
def dedup_within(t):
    twice = t.events.union(t.events)
    timed = source(t, twice).withColumn("ts", F.col("ts").cast("timestamp"))
    return to_files(t, stream.dedup(timed, ["event_id"], "ts", ANY_DELAY).select("event_id", "user_id", "value"))


@check("s09_05_enrich_static", "select event_id, user_id, c_name, c_mktsegment from events left join customer on user_id = c_custkey and c_acctbal > 0")
def enrich_static(t):
    dim = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return to_files(t, stream.enrich_static(source(t, t.events.select("event_id", "user_id")), dim, ["user_id"]))


@check("s09_06_join_interval", INTERVAL.format(how=""))
def join_interval(t):
    a, b = (
        stream.with_event_time(source(t, df), ts, delay=ANY_DELAY)
        for df, ts in zip(signups_and_buys(t), ("signup_ts", "buy_ts"), strict=True)
    )
    return ntz(to_files(t, stream.join_interval(a, b, ["user_id"], "signup_ts", "buy_ts", "5 hours")), "signup_ts", "buy_ts")


@check("s09_06_join_interval_left", INTERVAL.format(how="left"))
def join_interval_left(t):
    far = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    sides = []
    for df, ts in zip(signups_and_buys(t), ("signup_ts", "buy_ts"), strict=True):
        # a marker far in the future moves the watermark past everything else
        marker = df.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), ts: far})
        path = landed_in_order(t, df, ts, ["2024-01-11", "2024-01-21"], marker)
        sides.append(stream.with_event_time(streamio.read_files(t.spark, path, df.schema, max_files=spread(df)), ts, delay="1 day"))
    out = to_files(t, stream.join_interval(*sides, ["user_id"], "signup_ts", "buy_ts", "5 hours", "left"))
    return ntz(out.filter("user_id >= 0"), "signup_ts", "buy_ts")


STREAK = """with marked as (select *, sum(case when value > 20 then 0 else 1 end) over (partition by user_id order by ts, event_id
    rows unbounded preceding) as island from events),
  runs as (select user_id, ts, event_id, sum(case when value > 20 then 1 else 0 end) over (partition by user_id, island
    order by ts, event_id rows unbounded preceding)::bigint as streak from marked)
  select user_id, streak from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from runs) where rn = 1"""


@check("s09_07_streak", STREAK)
def streak(t):
    path = landed_in_order(t, t.events, "ts", ["2024-01-08", "2024-01-15", "2024-01-22"])
    feed = stream.with_event_time(streamio.read_files(t.spark, path, t.events.schema, max_files=spread(t.events)), "ts", delay="1 day")
    sixty_days = 60 * 86_400_000
    streaks = stream.streak(feed, "user_id", ["ts", "event_id"], "value > 20", sixty_days, "event")
    return to_state(t, streaks, ["user_id"])


@check("s09_09_filter_alerts", "select event_id, value from events where value > 30")
def filter_alerts(t):
    return to_files(t, stream.filter_alerts(source(t, t.events.select("event_id", "value")), "value", 30))


@check("s09_10_output_modes", "select event_type, count(*) as count from events group by event_type")
def output_modes(t):
    counts = source(t, t.events).groupBy("event_type").count()
    update = to_state(t, counts, ["event_type"], "update")
    complete = to_state(t, counts, ["event_type"], "complete")
    return update.intersect(complete)


@check("s09_11_trigger", "select event_id, user_id from events")
def trigger(t):
    out = t.dir("once")
    feed = source(t, t.events.select("event_id", "user_id"))
    stream.drain(stream.start(feed, out, "append", t.dir("ckpt"), stream.trigger("once")))
    return t.spark.read.parquet(out)


@check("s09_12_resume", "select event_id, user_id from events")
def resume(t):
    path, out, ckpt = t.dir("growing"), t.dir("resumed"), t.dir("ckpt")
    events_ = t.events.select("event_id", "user_id", "ts")
    first = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (events_.filter(first), events_.filter(~first)):
        part.drop("ts").write.mode("append").parquet(path)
        stream.resume(lambda: streamio.read_files(t.spark, path, "event_id BIGINT, user_id BIGINT", max_files=1), out, ckpt)
    return t.spark.read.parquet(out)


@check(
    "s09_13_upsert",
    "select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1",
)
def upsert(t):
    cols = ["user_id", "event_id", "event_type", "value", "ts"]
    keep = t.events.select(*cols)
    state = BatchTable(t.dir("latest"), ["user_id"], keep.schema)
    stream.drain(stream.upsert(source(t, keep, per_batch=1), state, ["ts", "event_id"], t.dir("ckpt")))
    return state.read(t.spark).drop("ts")


@check("s09_14_progress", "select count(*) as input_rows, 1::bigint as queries from events")
def progress(t):
    log = stream.ProgressLog(t.spark, t.dir("progress")).attach()
    try:
        query = stream.drain(stream.start(source(t, t.events, per_batch=1), t.dir("out"), "append", t.dir("ckpt")))
        log.wait(query)
    finally:
        log.detach()
    return log.read().filter(F.col("run_id") == str(query.runId)).agg(F.sum("input_rows").alias("input_rows"), F.count_distinct("run_id").alias("queries"))


LOG_OFFSETS = """with log as (select (user_id % 4)::int as "partition", event_id as "offset" from events),
  done as (select "partition", max("offset") - 100 as committed_offset from log where "partition" < 3 group by 1)"""


def _log(t):
    log = t.events.withColumns({"partition": (F.col("user_id") % 4).cast("int"), "offset": F.col("event_id")})
    done = log.filter("partition < 3").groupBy("partition").agg((F.max("offset") - 100).alias("offset"))
    return log, done


@check(
    "s09_14_lag",
    LOG_OFFSETS + """ select l."partition", latest_offset, committed_offset, latest_offset - coalesce(committed_offset, -1) as lag
    from (select "partition", max("offset") as latest_offset from log group by 1) l left join done d on l."partition" = d."partition\"""",
)
def lag(t):
    log, done = _log(t)
    return stream.lag(log, done)


CDC = """with base as (select k, state, amount from (select *, row_number() over (partition by k order by commit_ts desc, seq desc) as rn
    from fx_changes where version <= 10) where rn = 1 and op <> 'D'),
  feed as (select k, state, amount, op from (select *, row_number() over (partition by k order by commit_ts desc, seq desc) as rn
    from fx_changes where version > 10) where rn = 1)
  select coalesce(b.k, f.k) as k, case when f.op = 'U' or b.k is null then f.state else b.state end as state,
    case when f.op = 'U' or b.k is null then f.amount else b.amount end as amount
  from base b full join feed f on b.k = f.k
  where not (b.k is not null and f.op is not distinct from 'D') and not (b.k is null and f.op <> 'I')"""


@check("s09_15_cdc_dedup", CDC, "fx_changes")
def cdc_dedup(t):
    log = history.Log(t.fx_changes, ["k"], ["commit_ts", "seq"])
    base = history.as_of(log, version=10)
    feed = t.fx_changes.filter("version > 10")
    changes = source(t, feed.union(feed), files=2, per_batch=2).withColumn("commit_ts", F.col("commit_ts").cast("timestamp"))
    single = stream.cdc_dedup(changes, ["k"], "seq", "commit_ts", ANY_DELAY)
    state = BatchTable(t.dir("cdc"), ["k"], base.schema)
    state.apply(base, -1, lambda old, new: new)
    sink = stream.cdc_sink(state, ["commit_ts", "seq"])
    stream.drain(stream.start(single, sink, "append", t.dir("ckpt")))
    return state.read(t.spark)


@check(
    "s09_16_backfill_windows",
    "select date_trunc('hour', ts) as window_start, event_type, count(*) as count from events "
    "where ts >= timestamp '2024-01-15' or event_type <> 'error' group by 1, 2",
)
def backfill_windows(t):
    path = t.dir("windows")
    count = [F.count(F.lit(1)).alias("count")]
    on_time = t.events.filter("event_type <> 'error'")
    first, later = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01", "2024-01-15"))
    stream.backfill_windows(on_time, path, "ts", "1 hour", ["event_type"], count, first)
    stream.backfill_windows(t.events, path, "ts", "1 hour", ["event_type"], count, later)
    return ntz(t.spark.read.parquet(path), "window_start").select("window_start", "event_type", "count")


@check(
    "s09_17_latest_by_key",
    "select k, amount from (select k, case when op = 'D' then null else amount end as amount, "
    "row_number() over (partition by k order by commit_ts desc, seq desc) as rn from fx_changes) where rn = 1 and amount is not null",
    "fx_changes",
)
def latest_by_key(t):
    kv = t.fx_changes.withColumn("amount", F.when(F.col("op") != "D", F.col("amount")))
    return events.latest_by_key(kv, ["k"], ["commit_ts", "seq"], "amount").select("k", "amount")


@check("s09_18_retain_time", "select event_id, ts from events where ts >= timestamp '2024-01-20 00:00:00'")
def retain_time(t):
    from datetime import datetime

    return events.retain(t.events, "ts", horizon=datetime(2024, 1, 20)).select("event_id", "ts")


@check(
    "s09_18_retain_bytes",
    """select event_id from (select event_id, sum(length(props)) over (partition by user_id % 4 order by ts desc, event_id desc
      rows unbounded preceding) as bytes from events) where bytes <= 5000""",
)
def retain_bytes(t):
    log = t.events.withColumns({"partition": F.col("user_id") % 4, "size": F.length("props")})
    kept = events.retain(log, "ts", max_bytes=5000, partition=["partition"], order=["ts", "event_id"], size="size")
    return kept.select("event_id")


@check(
    "s09_19_order_check",
    """with s as (select user_id, event_id // 10 as seq, lag(event_id // 10) over (partition by user_id order by value, event_id) as prev from events)
    select user_id, count(*) as rows, count(*) filter (seq < prev) as out_of_order, count(*) - count(distinct seq) as repeats from s group by user_id""",
)
def order_check(t):
    log = t.events.withColumn("seq", F.expr("event_id div 10"))
    return events.order_check(log, ["user_id"], "seq", ["value", "event_id"])


@check(
    "s09_19_store_once",
    "select user_id, seq, event_id from (select user_id, event_id // 10 as seq, event_id, "
    "row_number() over (partition by user_id, event_id // 10 order by ts, event_id) as rn from events) where rn = 1",
)
def store_once(t):
    log = t.events.withColumn("seq", F.expr("event_id div 10"))
    return events.store_once(log, ["user_id"], "seq", ["ts", "event_id"]).select("user_id", "seq", "event_id")


@check(
    "s09_20_replay",
    LOG_OFFSETS + """ select l."partition", l."offset" from log l left join done d on l."partition" = d."partition"
    where l."offset" >= coalesce(d.committed_offset, 0)""",
)
def replay(t):
    log, done = _log(t)
    return events.replay(log.select("partition", "offset"), done)
