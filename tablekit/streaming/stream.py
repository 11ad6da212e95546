"""Structured Streaming operators."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tablekit.operators import merge
from tablekit.operators.windows import latest_per_key
from tablekit.sources.io import overwrite_partitions
from tablekit.streaming.batches import BatchTable


def with_event_time(df: DataFrame, col: str, fmt: str | None = None, delay: str = "10 minutes", name: str | None = None) -> DataFrame:
    """Parse text time (with ``fmt``) or cast, and set the watermark."""
    at = name or col
    time = F.to_timestamp(col, fmt) if fmt else F.col(col).cast("timestamp")
    return df.withColumn(at, time).withWatermark(at, delay)


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per fixed window and key; ``window_start`` and ``window_end`` as columns."""
    return _windowed(df, F.window(ts, width), keys, aggs)


def sliding(df: DataFrame, ts: str, width: str, slide: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per overlapping window and key."""
    return _windowed(df, F.window(ts, width, slide), keys, aggs)


def _windowed(df: DataFrame, window: Column, keys: list[str], aggs: list[Column]) -> DataFrame:
    grouped = df.groupBy(window.alias("w"), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def dedup(df: DataFrame, keys: list[str], ts: str | None = None, delay: str | None = None) -> DataFrame:
    """Drop repeats with bounded state.

    Give ``delay`` to set a watermark on ``ts``. With ``ts`` among the keys repeats are dropped until
    the watermark passes them; without it, repeats within the watermark's delay are.
    """
    if delay:
        df = df.withWatermark(ts, delay)
    return df.dropDuplicates(keys) if ts in keys else df.dropDuplicatesWithinWatermark(keys)


def enrich_static(stream: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join each micro-batch with a table; broadcast while the table is small."""
    return stream.join(dim, on, how)


def join_interval(
    a: DataFrame, b: DataFrame, keys: list[str], a_ts: str, b_ts: str, within: str, how: str = "inner", closed: bool = False
) -> DataFrame:
    """Two streams: same key and ``a_ts <= b_ts < a_ts + within``. Both need watermarks.

    A left join emits an unmatched row once the watermark rules a partner out. Time is cut
    into steps of ``within``, and rows of ``b`` are listed under their step and the one before,
    so a hot key's state is spread over its time range; hence inner and left joins only.
    """
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError("rows of b are listed twice, so only inner and left joins are possible")
    length = _micros(a.sparkSession, within)

    def step(ts: str) -> Column:
        return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(length))

    a = a.withColumn("__step", step(a_ts))
    renamed = b.withColumnsRenamed({k: f"__b_{k}" for k in keys}).withColumn("__b_step", F.explode(F.array(step(b_ts), step(b_ts) - 1)))
    on = (F.col("__step") == F.col("__b_step")) & (F.col(b_ts) >= F.col(a_ts))
    end = F.expr(f"{a_ts} + interval {within}")
    on = on & ((F.col(b_ts) <= end) if closed else (F.col(b_ts) < end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__b_{k}"))
    return a.join(renamed, on, how).drop("__step", "__b_step", *[f"__b_{k}" for k in keys])


PACK_BYTES = 64 * 1024 * 1024  # of rows that a task packs at a time
PACK_ROWS = 4096  # of one key and step in a pack


def join_interval_packed(
    a: DataFrame, b: DataFrame, keys: list[str], a_ts: str, b_ts: str, within: str, delay: str
) -> DataFrame:
    """The inner :func:`join_interval` as lists: state and output grow with the rows, not with their pairs.

    Rows of a micro-batch with the same key and step of ``within`` are one row, a pack, with the
    other columns in a list; packs of a step meet those of the same and the next one. The result
    has the keys and the lists ``a`` and ``b``, for a sink; :func:`interval_pairs` gives the pairs.
    ``a_ts`` and ``b_ts`` are timestamps, with or without zone, and a day in ``within`` is 24 hours.
    ``delay`` sets the watermark, on the last time of a pack, so a late row may still find partners.
    """
    span = f"interval {within}"
    length = _micros(a.sparkSession, within)
    left = _packs(a, keys, a_ts, length, "a", delay)
    right = _packs(b, keys, b_ts, length, "b", delay).withColumnsRenamed({k: f"__b_{k}" for k in keys})
    right = right.withColumn("__b_step", F.explode(F.array("__step", F.col("__step") - 1))).drop("__step")
    on = F.col("__step") == F.col("__b_step")
    for k in keys:
        on = on & (F.col(k) == F.col(f"__b_{k}"))
    # true of all packs whose steps match; tells Spark when state can go
    on = on & F.expr(f"__b_last >= __a_last - {span} and __b_last <= __a_last + {span} + {span}")
    return left.join(right, on).select(*keys, "a", "b")


def _micros(spark: SparkSession, within: str) -> int:
    return spark.sql(f"select unix_micros(timestamp '1970-01-01 00:00:00Z' + interval {within})").first()[0]


def _micros_of(df: DataFrame, ts: str) -> Column:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"(`{ts}` - timestamp_ntz '1970-01-01 00:00:00') div interval '0.000001' second")
    return F.unix_micros(ts)


def _packs(df: DataFrame, keys: list[str], ts: str, length: int, name: str, delay: str) -> DataFrame:
    rest = [f for f in df.schema.fields if f.name not in keys]
    known = df.dropna(subset=[*keys, ts]).withColumn("__step", F.floor(_micros_of(df, ts) / F.lit(length)))
    group = [*keys, "__step"]
    schema = T.StructType([*[known.schema[g] for g in group], T.StructField(name, T.ArrayType(T.StructType(rest)))])
    columns = [f.name for f in rest]

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        rows = table.select(group).append_column("__row", pa.array(np.arange(table.num_rows)))
        found = rows.group_by(group, use_threads=False).aggregate([("__row", "list")]).combine_chunks()
        lists = found["__row_list"].combine_chunks()
        starts = np.asarray(lists.offsets)
        pieces = -(-np.diff(starts) // PACK_ROWS)
        of = np.repeat(np.arange(len(pieces)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cuts = np.append(starts[of] + PACK_ROWS * nth, starts[-1]).astype(np.int32)
        taken = table.select(columns).take(lists.flatten()).combine_chunks()
        values = pa.StructArray.from_arrays([c.chunk(0) for c in taken.columns], columns)
        out = found.select(group).take(pa.array(of)).append_column(name, pa.ListArray.from_arrays(pa.array(cuts), values))
        return out.combine_chunks().to_batches()[0]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= PACK_BYTES:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    packs = known.repartition(*group).mapInArrow(pack, schema)
    last = f"__{name}_last"
    return packs.withColumn(last, F.array_max(F.col(name).getField(ts)).cast("timestamp")).withWatermark(last, delay)


def interval_pairs(
    packs: DataFrame, keys: list[str], a_ts: str, b_ts: str, within: str, closed: bool = False
) -> DataFrame:
    """The pairs ``a_ts <= b_ts < a_ts + within`` in the rows of :func:`join_interval_packed`, table or stream."""
    pairs = packs.select(*keys, "b", F.inline("a"))
    if isinstance(pairs.schema[a_ts].dataType, T.TimestampNTZType):
        until = F.expr(f"`{a_ts}` + interval {within}")
    else:
        until = F.timestamp_micros(F.unix_micros(a_ts) + F.lit(_micros(packs.sparkSession, within)))
    # the end is one value a row of a, not one a pair
    pairs = pairs.withColumn("__until", until).select(*[c for c in pairs.columns if c != "b"], "__until", F.inline("b"))
    end = F.col("__until")
    return pairs.filter((F.col(b_ts) >= F.col(a_ts)) & ((F.col(b_ts) <= end) if closed else (F.col(b_ts) < end))).drop("__until")


def filter_alerts(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """The side stream of rows above a threshold."""
    return df.filter(F.col(col) > threshold)


# --- keyed state ------------------------------------------------------------


def streak(
    df: DataFrame,
    key: str,
    order: list[str],
    cond: str,
    timeout_ms: int = 3_600_000,
    timeout: str = "processing",
    name: str = "streak",
    buckets: int = 4096,
) -> DataFrame:
    """Consecutive rows at the end of each key's history for which ``cond`` holds.

    One row per key and micro-batch with the streak after it. ``order`` are up to two sortable
    columns, time first. A row that comes in a later batch than rows after it counts as if it had
    come in order, while the watermark has not passed it: it lengthens the streak, or breaks it
    in the middle. So a key's state is its last break, the number of rows behind it that the
    watermark has passed, and the order numbers of those it has not. Without a watermark on the
    first order column nothing is ever passed, and all rows since the last break stay in state.

    State idle for ``timeout_ms`` is dropped, by the clock (``processing``) or by the watermark
    (``event``); a stream that is to end by itself needs ``event`` or ``none``: by the clock there
    is always another batch to wait for. Only the key, the order numbers and the condition of a row
    reach Python, chunk by chunk. The keys of one of ``buckets`` hash buckets share a call and a
    state row, since a call costs far more than a key; more buckets make smaller state rows.
    """
    time = F.col(order[0])
    at = F.unix_micros(time.cast("timestamp")).alias("__t")
    tie = (F.col(order[1]).cast("long") if len(order) > 1 else F.lit(0).cast("long")).alias("__i")
    holds = F.coalesce(F.expr(cond), F.lit(False)).alias("__ok")
    watermarked = "EventTimeWatermark" in _streaming_steps(df._jdf.queryExecution().analyzed())
    if timeout == "event" and not watermarked:
        raise ValueError("a timeout by event time needs a watermark")
    text, back = _as_text(F.col(key), df.schema[key].dataType)
    bucket = F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int").alias("__bucket")
    slim = df.select(bucket, text.alias("__key"), at, tie, holds, *([time] if watermarked else []))
    out = T.StructType([T.StructField("__key", T.StringType()), T.StructField(name, T.LongType())])

    def advance(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, (passed, last_t, last_i, expires), held = _unpacked(state.get[0]) if state.exists else ([], np.zeros((4, 0), np.int64), np.zeros((3, 0), np.int64))
        number = {k: n for n, k in enumerate(keys)}
        opened, broken, newest = [held], [], []
        for chunk in chunks:
            if not len(chunk):
                continue
            codes, seen = pd.factorize(chunk["__key"], use_na_sentinel=False)
            owner = np.array([number.setdefault(None if pd.isna(k) else k, len(number)) for k in seen], np.int64)[codes]
            ok = chunk["__ok"].to_numpy(bool)
            rows = np.stack([owner, chunk["__t"].to_numpy(np.int64), chunk["__i"].to_numpy(np.int64)])
            opened.append(rows[:, ok])
            broken.append(_newest(rows[:, ~ok]))
            newest.append(_newest(rows)[:2])
        n, new = len(number), len(number) - len(keys)
        passed, expires = (np.append(x, np.zeros(new, np.int64)) for x in (passed, expires))
        last_t, last_i = (np.append(x, np.full(new, _NEVER)) for x in (last_t, last_i))
        touched = np.zeros(n, bool)
        watermark_ms = state.getCurrentWatermarkMs() if watermarked else 0
        now_ms = state.getCurrentProcessingTimeMs() if timeout == "processing" else watermark_ms
        for owner, t in newest:
            fresh = np.where(touched[owner], expires[owner], 0)
            since = np.full(len(t), now_ms) if timeout == "processing" else np.maximum(t // 1000, now_ms)
            expires[owner] = np.maximum(fresh, since + timeout_ms)
            touched[owner] = True
        for owner, t, i in broken:
            later = _after(t, i, last_t[owner], last_i[owner])
            owner = owner[later]
            last_t[owner], last_i[owner], passed[owner] = t[later], i[later], 0
        held = np.concatenate(opened, axis=1)
        owner, t, i = held = held[:, _after(*held[1:], last_t[held[0]], last_i[held[0]])]
        length = passed + np.bincount(owner, minlength=n)
        if watermarked:
            # rows at or before the watermark do not come any more
            settled = t <= watermark_ms * 1000
            passed, held = passed + np.bincount(owner[settled], minlength=n), held[:, ~settled]
        names = np.array([*number, None], object)[:-1]
        stays = touched | (expires >= now_ms) if timeout != "none" else np.ones(n, bool)
        if stays.any():
            state.update((_packed(names[stays], np.stack([passed, last_t, last_i, expires])[:, stays], _renumbered(held, stays)),))
            first = int(expires[stays].min())
            if timeout == "processing":
                state.setTimeoutDuration(max(1, first - now_ms))
            elif timeout == "event":
                state.setTimeoutTimestamp(max(first, now_ms + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"__key": names[touched], name: length[touched]})

    found = grouped_state(slim, ["__bucket"], advance, out, "held BINARY", timeout)
    return found.select(back(F.col("__key")).alias(key), name)


def _as_text(col: Column, kind: T.DataType) -> tuple[Column, Callable[[Column], Column]]:
    """A key as text that equal keys share, and how to get it back; NULL stays NULL."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("string"), lambda x: F.timestamp_micros(x.cast("long"))
    if isinstance(kind, T.BinaryType):
        return F.hex(col), F.unhex
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # plus zero, for zero has two signs
        return (col + F.lit(0.0).cast(kind)).cast("string"), lambda x: x.cast(kind)
    if isinstance(kind, (T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return col.cast("string"), lambda x: x.cast(kind)
    whole = T.StructType([T.StructField("k", kind)])
    return F.to_json(F.struct(col.alias("k"))), lambda x: F.from_json(x, whole)["k"]


def _after(t: np.ndarray, i: np.ndarray, last_t: np.ndarray, last_i: np.ndarray) -> np.ndarray:
    """Where (time, tie) lies after another."""
    return (t > last_t) | ((t == last_t) & (i > last_i))


def _newest(rows: np.ndarray) -> np.ndarray:
    """The last (owner, time, tie) of each owner."""
    rows = rows[:, np.lexsort(rows[::-1])]
    return rows[:, np.append(rows[0, 1:] != rows[0, :-1], True)] if rows.shape[1] else rows


def _renumbered(held: np.ndarray, stays: np.ndarray) -> np.ndarray:
    """Rows of the owners that stay, by their new numbers."""
    held = held[:, stays[held[0]]]
    return np.stack([(np.cumsum(stays) - 1)[held[0]], *held[1:]])


def _packed(keys: np.ndarray, numbers: np.ndarray, held: np.ndarray) -> bytes:
    """Keys, four numbers of each, and rows (owner, time, tie) as bytes."""
    sizes = np.array([len(keys), held.shape[1]], np.int64)
    names = pa.record_batch([pa.array(keys, pa.large_string())], ["k"]).serialize().to_pybytes()
    return sizes.tobytes() + numbers.astype(np.int64).tobytes() + held.astype(np.int64).tobytes() + names


def _unpacked(packed: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    n, rows = np.frombuffer(packed, np.int64, 2).tolist()
    numbers = np.frombuffer(packed, np.int64, 4 * n, 16).reshape(4, n)
    held = np.frombuffer(packed, np.int64, 3 * rows, 16 + 32 * n).reshape(3, rows)
    names = pa.ipc.read_record_batch(pa.py_buffer(packed[16 + 32 * n + 24 * rows :]), pa.schema([("k", pa.large_string())]))
    return names.column(0).to_pylist(), numbers, held


_NEVER = -(2**63)


_TIMEOUTS = {
    "none": GroupStateTimeout.NoTimeout,
    "processing": GroupStateTimeout.ProcessingTimeTimeout,
    "event": GroupStateTimeout.EventTimeTimeout,
}


def grouped_state(
    df: DataFrame, keys: list[str], fn: Callable, out: T.StructType | str, state: T.StructType | str, timeout: str = "none"
) -> DataFrame:
    """A pandas function per key and micro-batch, with state kept between batches."""
    return df.groupBy(*keys).applyInPandasWithState(fn, out, state, "update", _TIMEOUTS[timeout])


# --- running a stream -------------------------------------------------------

MODES = ("append", "update", "complete")


def trigger(kind: str, interval: str | None = None) -> dict:
    """Trigger options: ``processingTime``, ``once``, ``availableNow`` or ``continuous``.

    ``once`` is served by ``availableNow``, which also drains everything but in bounded batches.
    """
    if kind in ("processingTime", "continuous"):
        if not interval:
            raise ValueError(f"{kind} needs an interval")
        return {kind: interval}
    if kind in ("once", "availableNow"):
        return {"availableNow": True}
    raise ValueError(f"unknown trigger {kind!r}")


def check_output_mode(df: DataFrame, mode: str) -> None:
    """Refuse combinations that cannot work, before anything is started."""
    if mode not in MODES:
        raise ValueError(f"output mode is one of {MODES}")
    steps = _streaming_steps(df._jdf.queryExecution().analyzed())
    if mode == "complete" and "Aggregate" not in steps:
        raise ValueError("complete mode needs an aggregate")
    if mode == "append" and "Aggregate" in steps and "EventTimeWatermark" not in steps:
        raise ValueError("append mode with an aggregate needs a watermark")


def _streaming_steps(plan) -> set[str]:
    """Names of the plan's nodes over streams; tables that a stream is joined with do not count."""
    if not plan.isStreaming():
        return set()
    children = plan.children()
    return {plan.nodeName()}.union(*(_streaming_steps(children.apply(i)) for i in range(children.size())))


def start(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None] | str,
    mode: str,
    checkpoint: str,
    when: dict | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start a stream into a path, or into a function called per micro-batch.

    The checkpoint holds the position: starting again with the same one goes on after the
    last finished batch, without losing or repeating rows.
    """
    check_output_mode(df, mode)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(when or trigger("availableNow")))
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format(fmt).start(sink)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until an ``availableNow`` stream has taken all it found; errors are raised."""
    query.awaitTermination()
    return query


def resume(make: Callable[[], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Build the stream again and continue it from its checkpoint until it is drained."""
    return drain(start(make(), path, "append", checkpoint))


def latest_state_sink(state: BatchTable) -> Callable[[DataFrame, int], None]:
    """For ``update`` and ``complete`` streams: the newest row of each key."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        state.apply(batch, batch_id, lambda old, new: merge.upsert(old, new, state.keys))

    return sink


def upsert_sink(state: BatchTable, order: list[str]) -> Callable[[DataFrame, int], None]:
    """Merge rows by key; the newest in ``order`` wins, so a late row replaces nothing newer."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        def newest(old: DataFrame, new: DataFrame) -> DataFrame:
            return latest_per_key(old.unionByName(new.select(*old.columns)), state.keys, order)

        state.apply(batch, batch_id, newest)

    return sink


def upsert(
    df: DataFrame, state: BatchTable, order: list[str], checkpoint: str, when: dict | None = None
) -> StreamingQuery:
    """Merge each micro-batch into a latest-state table."""
    return start(df, upsert_sink(state, order), "append", checkpoint, when)


def cdc_dedup(df: DataFrame, key: list[str], offset: str, ts: str, delay: str) -> DataFrame:
    """Drop replays of a change on (key, offset) before it is applied.

    A replay carries the original event time, so the time may join the keys and bound the state.
    """
    return df.withWatermark(ts, delay).dropDuplicates([*key, offset, ts])


def cdc_sink(state: BatchTable, order: list[str]) -> Callable[[DataFrame, int], None]:
    """Apply a deduplicated change feed to a state table."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        state.apply(batch, batch_id, lambda old, new: merge.apply_cdc(old, new, state.keys, order))

    return sink


def progress(query: StreamingQuery) -> DataFrame:
    """What a query still remembers of its triggers; :class:`ProgressLog` keeps all of them."""
    return SparkSession.active().createDataFrame([_progress_row(p) for p in query.recentProgress], PROGRESS)


PROGRESS = (
    "id STRING, run_id STRING, name STRING, batch_id BIGINT, input_rows BIGINT, "
    "input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, triggered_at STRING"
)


class ProgressLog(StreamingQueryListener):
    """Appends a row to a table for every trigger of every query of a session.

    Nothing is polled, and rows stay when a query has gone. ``attach`` starts the log,
    ``detach`` ends it; ``wait`` returns once a query's end has been told.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def attach(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        return self._ended[str(query.runId)].wait(seconds)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.spark.createDataFrame([_progress_row(event.progress)], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()


def _progress_row(p) -> tuple:
    return (
        str(p.id), str(p.runId), p.name, p.batchId, int(p.numInputRows),
        float(p.inputRowsPerSecond or 0.0), float(p.processedRowsPerSecond or 0.0), p.timestamp,
    )


def status(query: StreamingQuery) -> dict:
    return {"id": str(query.id), "run_id": str(query.runId), "active": query.isActive, **query.status}


def lag(log: DataFrame, committed: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Per partition: latest offset, committed offset and the distance between them."""
    latest = log.groupBy(partition).agg(F.max(offset).alias("latest_offset"))
    done = committed.select(partition, F.col(offset).alias("committed_offset"))
    joined = latest.join(done, partition, "left")
    behind = F.col("latest_offset") - F.coalesce("committed_offset", F.lit(-1))
    return joined.withColumn("lag", behind)


def backfill_windows(
    table: DataFrame, path: str, ts: str, width: str, keys: list[str], aggs: list[Column], from_: Column
) -> None:
    """Recompute the windows from a day on, late rows included, and replace those days."""
    day = F.to_date("window_start")
    recent = table.filter(F.col(ts) >= F.date_trunc("day", from_).cast(table.schema[ts].dataType))
    overwrite_partitions(tumbling(recent, ts, width, keys, aggs).withColumn("day", day), path, ["day"])
