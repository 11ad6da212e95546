"""Python functions as columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from checks.registry import check
from checks.s09_streams import source, to_state
from tablekit.functions import exprs
from tablekit.operators import udfs
from tablekit.streaming import stream


@check("s10_01_scalar", "select event_id, event_id * 2 as doubled from events")
def scalar(t):
    return t.events.select("event_id", udfs.scalar(lambda x: x * 2, "bigint")("event_id").alias("doubled"))


@check("s10_02_compare", "select event_id, event_id * 2 as builtin, event_id * 2 as custom, true as agree from events")
def compare(t):
    return udfs.compare(t.events.select("event_id"), F.col("event_id") * 2, udfs.scalar(lambda x: x * 2, "bigint")("event_id"))


@check("s10_03_vectorized", "select event_id, upper(trim(event_type)) as label, value + user_id as total from events")
def vectorized(t):
    label = udfs.vectorized(lambda s: s.str.strip().str.upper(), "string")
    total = udfs.vectorized(lambda a, b: a + b, "double")
    return t.events.select("event_id", label("event_type").alias("label"), total("value", "user_id").alias("total"))


@check("s10_04_grouped_state", "select event_type, count(*) as seen from events group by event_type")
def grouped_state(t):
    def count(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = (state.get[0] if state.exists else 0) + sum(len(c) for c in chunks)
        state.update((seen,))
        yield pd.DataFrame({"event_type": [key[0]], "seen": [seen]})

    feed = source(t, t.events.select("event_type"))
    counted = stream.grouped_state(feed, ["event_type"], count, "event_type STRING, seen BIGINT", "seen BIGINT")
    return to_state(t, counted, ["event_type"])


@check(
    "s10_05_row_transform",
    "select id, lower(trim(url)) as url, status_code >= 400 as is_error, response_time_ms / 1000.0 as seconds from fx_checks "
    "where url is not null and status_code is not null and response_time_ms is not null",
    "fx_checks",
)
def row_transform(t):
    steps = [
        {"url": exprs.clean("url", "lower"), "is_error": F.col("status_code") >= 400},
        {"seconds": F.col("response_time_ms") / 1000.0},
    ]
    out = udfs.row_transform(t.fx_checks, steps, ["url", "status_code", "response_time_ms"])
    return out.select("id", "url", "is_error", "seconds")
