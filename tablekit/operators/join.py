"""Joins.

Plain joins are left to adaptive execution, which splits skewed partitions of a
sort-merge join at run time. Broadcasts happen only for a side whose estimated size is
under a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.operators.windows import running
from tablekit.storage import cut_lineage, plan_bytes

BROADCAST_BYTES = 32 * 1024 * 1024


def inner(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi-join; each key column appears once."""
    return a.join(b, on, "inner")


def left(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.join(b, on, "left")


def full(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.join(b, on, "full_outer")


def semi(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.join(b, on, "left_semi")


def anti(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.join(b, on, "left_anti")


def small_enough(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return plan_bytes(df) <= max_bytes


def hinted(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its estimated size allows one."""
    return F.broadcast(df) if small_enough(df, max_bytes) else df


def broadcast(
    a: DataFrame, small: DataFrame, on: list[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Send ``small`` to every executor so ``a`` is not shuffled.

    A side above ``max_bytes`` is joined by shuffle instead.
    """
    return a.join(hinted(small, max_bytes), on, how)


def shuffle(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Force a sort-merge join."""
    return a.join(b.hint("merge"), on, how)


def salted(
    a: DataFrame,
    b: DataFrame,
    on: list[str],
    n: int,
    row_id: list[str],
    hot_keys: list | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join a skewed ``a``: its rows get one of ``n`` salts, ``b`` is repeated once per salt.

    With ``hot_keys`` (values of the first join column) only those keys are salted, and the
    rest of ``b`` is not repeated. ``row_id`` spreads the rows: name columns that differ
    between the rows of one key.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join keeps the salted side: inner or left")
    spread = F.pmod(F.xxhash64(*row_id), F.lit(n)).cast("int")
    copies = F.sequence(F.lit(0), F.lit(n - 1))
    if hot_keys is not None:
        is_hot = F.coalesce(F.col(on[0]).isin(*hot_keys), F.lit(False))
        spread = F.when(is_hot, spread).otherwise(0)
        copies = F.when(is_hot, copies).otherwise(F.array(F.lit(0)))
    left_side = a.withColumn("__salt", spread)
    right_side = b.withColumn("__salt", F.explode(copies))
    return left_side.join(right_side, [*on, "__salt"], how).drop("__salt")


def filter_after(a: DataFrame, b: DataFrame, on: list[str], cond: Column | str) -> DataFrame:
    """Inner join plus a predicate, which the optimizer moves to the side it concerns."""
    return a.join(b, on, "inner").filter(cond)


def point_in_time(
    fact: DataFrame,
    dim: DataFrame,
    key: list[str],
    ts: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
) -> DataFrame:
    """Each fact row meets the dimension version with ``valid_from <= ts < valid_to``.

    Versions of a key must not overlap; a NULL ``valid_to`` is open. Facts and versions
    are merged on one timeline per key and the last version is carried forward, so the
    work grows with facts plus versions and never with their product.
    """
    # a version that ends when it begins holds nothing and would hide the one it ties with
    dim = dim.filter(F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
    payload = [c for c in dim.columns if c not in key]
    version = F.struct(*[F.col(c) for c in payload])
    row = F.struct(*[F.col(c) for c in fact.columns])
    nothing_fact = F.lit(None).cast(T.StructType(fact.schema.fields))
    nothing_dim = F.lit(None).cast(T.StructType([dim.schema[c] for c in payload]))
    timeline = dim.select(
        *key, F.col(valid_from).alias("__at"), F.lit(0).alias("__side"), nothing_fact.alias("__fact"), version.alias("__dim")
    ).unionByName(
        fact.select(*key, F.col(ts).alias("__at"), F.lit(1).alias("__side"), row.alias("__fact"), nothing_dim.alias("__dim"))
    )
    carried = running(timeline, key, ["__at", "__side"], {"__seen": ("last", "__dim")})
    until = F.col(f"__seen.{valid_to}")
    holds = F.col("__seen").isNotNull() & (until.isNull() | (F.col("__fact")[ts] < until))
    for c in key:
        holds = holds & F.col(c).isNotNull()
    facts = carried.filter("__side = 1").withColumn("__seen", F.when(holds, F.col("__seen")))
    if how == "inner":
        facts = facts.filter(F.col("__seen").isNotNull())
    return facts.select(
        *[F.col("__fact")[c].alias(c) for c in fact.columns], *[F.col("__seen")[c].alias(c) for c in payload]
    )


def _seconds(df: DataFrame, ts: str) -> Column:
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_seconds(c)
    day = F.unix_date(c.cast("date")).cast("long") * 86400
    return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def interval(
    a: DataFrame,
    b: DataFrame,
    keys: list[str],
    a_ts: str,
    b_ts: str,
    within_seconds: int,
    how: str = "inner",
    closed: bool = False,
) -> DataFrame:
    """Pairs of the same key with ``a_ts <= b_ts < a_ts + within`` (``<=`` if closed).

    Time is cut into steps as long as the interval. A row of ``b`` can only meet rows of
    its own step and the one before, so ``b`` is listed under both and the join runs on
    (key, step): a hot key spreads over its time range. ``a`` stays single, hence left,
    semi and anti joins work as well. A (key, step) with more than ``tablekit.pairsPerTask``
    pairs to look at is cut further: its rows of ``a`` are dealt into parts, and its rows of
    ``b`` are listed under each.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "semi", "left_semi", "leftsemi", "anti", "left_anti", "leftanti"):
        raise ValueError("rows of b are listed twice, so only inner, left, semi and anti joins are possible")
    if set(a.columns) & set(b.columns) - set(keys):
        raise ValueError("rename the columns the two sides share, apart from the keys")
    length = F.lit(within_seconds)
    a_step = F.floor(_seconds(a, a_ts) / length)
    b_step = F.floor(_seconds(b, b_ts) / length)
    left_side = a.withColumn("__step", a_step)
    right_side = b.withColumn("__b_step", F.explode(F.array(b_step, b_step - 1)))
    right_side = right_side.withColumnsRenamed({k: f"__b_{k}" for k in keys})
    dense = _dense_steps(left_side, right_side, keys)
    if dense is not None:
        held = F.lit(True)
        for i, k in enumerate(keys):
            held = held & (F.col(k) == F.col(f"__d{i}"))
        left_side = left_side.join(dense, held & (F.col("__step") == F.col("__dense")), "left")
        # by value, so that a row that is computed again falls into the same part
        own = F.xxhash64(*[c for c, kind in a.dtypes if "map<" not in kind and "variant" not in kind])
        left_side = left_side.withColumn("__part", F.pmod(own, F.coalesce("__parts", F.lit(1)))).drop("__dense", "__parts", *[f"__d{i}" for i in range(len(keys))])
        listed = F.lit(True)
        for i, k in enumerate(keys):
            listed = listed & (F.col(f"__b_{k}") == F.col(f"__d{i}"))
        right_side = right_side.join(dense, listed & (F.col("__b_step") == F.col("__dense")), "left")
        right_side = right_side.withColumn("__b_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__parts", F.lit(1)) - 1))).drop("__dense", "__parts", *[f"__d{i}" for i in range(len(keys))])
    end = F.col(a_ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), length)
    on = (F.col("__step") == F.col("__b_step")) & (F.col(b_ts) >= F.col(a_ts))
    on = on & ((F.col(b_ts) <= end) if closed else (F.col(b_ts) < end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__b_{k}"))
    if dense is not None:
        on = on & (F.col("__part") == F.col("__b_part"))
    return left_side.join(right_side, on, how).drop("__step", "__part", "__b_step", "__b_part", *[f"__b_{k}" for k in keys])


PAIRS_PER_TASK = 100_000_000
PAIRS_CONF = "tablekit.pairsPerTask"


def _dense_steps(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame | None:
    """The (key, step) with too many pairs for one task as ``__d0, ..., __dense``, and the ``__parts`` their rows of ``a`` are dealt into."""
    limit = int(a.sparkSession.conf.get(PAIRS_CONF, str(PAIRS_PER_TASK)))
    named = [F.col(k).alias(f"__d{i}") for i, k in enumerate(keys)]
    n_a = a.groupBy(*named, F.col("__step").alias("__dense")).agg(F.count(F.lit(1)).alias("__n"))
    n_b = b.groupBy(*[F.col(f"__b_{k}").alias(f"__d{i}") for i, k in enumerate(keys)], F.col("__b_step").alias("__dense")).agg(F.count(F.lit(1)).alias("__m"))
    # in doubles: the product may be beyond a long
    pairs = F.col("__n").cast("double") * F.col("__m")
    counted = n_a.join(n_b, [*[f"__d{i}" for i in range(len(keys))], "__dense"]).filter(pairs > limit)
    parts = F.least(F.col("__n").cast("double"), F.ceil(pairs / limit).cast("double")).cast("long")
    dense = cut_lineage(counted.select(*[f"__d{i}" for i in range(len(keys))], "__dense", parts.alias("__parts")), "dense-steps")
    return None if dense.isEmpty() else dense
