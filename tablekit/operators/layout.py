"""Partitions and files."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.storage import replace_table, total_bytes

TARGET_FILE_BYTES = 256 * 1024 * 1024


def repartition(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``n`` even partitions, or equal keys together when keys are given."""
    return df.repartition(n, *keys)


def coalesce(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions, without a shuffle."""
    return df.coalesce(n)


def gathered(df: DataFrame, n: int, skew: float = 2.0) -> DataFrame:
    """``n`` partitions, none with more than ``skew`` times the mean rows.

    Those of the scan are put together where that gives such partitions, so a task reads what its
    files hold; else all rows are shuffled, which reads several times that.
    """
    together = df.coalesce(n)
    found = partition_skew(together).first()
    return together if found.partitions == n and found.skew <= skew else df.repartition(n)


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def partition_skew(df: DataFrame) -> DataFrame:
    """One row: partitions, fewest and most rows, and the largest relative to the mean."""
    return partition_report(df).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        (F.max("rows") / F.avg("rows")).alias("skew"),
    )


def keys_in_several_partitions(df: DataFrame, key: str) -> DataFrame:
    """Keys whose rows lie in more than one partition; none after ``repartition(n, key)``."""
    placed = df.select(key, F.spark_partition_id().alias("at"))
    return placed.groupBy(key).agg(F.min("at").alias("lo"), F.max("at").alias("hi")).filter("lo < hi").select(key)


def file_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: files, bytes and mean bytes under a path."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", "true").load(path)
    )
    return found.agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.avg("length").alias("mean_bytes")
    )


def files_for(total: int, target_bytes: int) -> int:
    """How many files of about ``target_bytes`` hold ``total`` bytes."""
    return max(1, math.ceil(total / target_bytes))


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES, by: list[str] | None = None) -> None:
    """Rewrite many small files as few; the rows stay the same.

    The file count follows from the bytes on disk. With ``by`` the directory partitioning is
    kept, and each directory gets as many files as its share of the rows calls for.
    """
    files = files_for(total_bytes(spark, path), target_bytes)
    df = spark.read.parquet(path)
    if not by:
        replace_table(df.repartition(files), path)
        return
    # one directory may hold most of the table: rows of a directory go to several tasks
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by]), F.lit(files)).cast("int")
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    total = sizes.agg(F.sum("__rows").alias("n")).scalar()
    share = sizes.withColumn("__files", F.greatest(F.lit(1), F.ceil(F.col("__rows") * files / total))).drop("__rows")
    side = share.withColumnsRenamed({c: f"__by_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    placed = df.join(side, on).select(*df.columns, (spread % F.col("__files")).alias("__part"))
    replace_table(placed.repartition(files, *by, "__part").drop("__part"), path, by)


#: Sampled values for each rank of a column that has no number to sketch.
SAMPLE_PER_RANK = 8
#: Characters of a text that its cuts keep.
CUT_CHARS = 64


def _as_number(df: DataFrame, name: str) -> tuple[str, Column] | None:
    """The kind of sketch a column's values fit into, and the values as its numbers, in the same order."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint", col.cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "bigint", F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return "bigint", F.unix_date(col).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double", col.cast("double")
    return None


def _cuts(df: DataFrame, cols: list[str], bits: int) -> DataFrame:
    """One row: for each column a sorted array of values that cut it into about ``2**bits`` equal parts.

    Numbers and times come from quantile sketches that tasks build and merge; other types from
    a sample of some rows for each part.
    """
    parts = 2**bits
    # one literal: the sketches take a constant array only
    shares = F.from_json(F.lit(json.dumps([k / parts for k in range(1, parts)])), "array<double>")
    exact = min(65_535, max(200, 2 * parts))
    sketches, arrays, sampled = [F.count(F.lit(1)).alias("n")], [], []
    for i, c in enumerate(cols):
        number = _as_number(df, c)
        if number is None:
            sampled.append(i)
            continue
        kind, value = number
        sketches.append(getattr(F, f"kll_sketch_agg_{kind}")(value, exact).alias(f"s{i}"))
        held = getattr(F, f"kll_sketch_get_n_{kind}")(f"s{i}") > 0
        arrays.append(F.when(held, getattr(F, f"kll_sketch_get_quantile_{kind}")(f"s{i}", shares)).alias(f"c{i}"))
    found = df.agg(*sketches).select(*arrays) if arrays else None
    if not sampled:
        return found
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    some = df.filter(F.rand(17) < F.lit(SAMPLE_PER_RANK * parts) / rows)

    def shortened(c: str) -> Column:
        return F.substring(c, 1, CUT_CHARS) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)

    lists = some.agg(*[F.array_sort(F.collect_list(shortened(cols[i]))).alias(f"l{i}") for i in sampled])

    def spread(values: str) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda k: F.get(F.col(values), F.floor(k * F.size(values) / parts).cast("int")))

    picked = [spread(f"l{i}").alias(f"c{i}") for i in sampled]
    cut = lists.select(*picked)
    return cut if found is None else cut.select("*", found.select(F.struct("*").alias("s")).scalar().alias("s")).select(*[f"c{i}" for i in sampled], "s.*")


def _rank(value: Column, cuts: Column, bits: int) -> Column:
    """How many of up to ``2**bits - 1`` sorted cuts lie at or below the value, by halving; 0 for NULL."""
    steps = F.array(*[F.lit(2**k) for k in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(cuts, low + step - 1) <= value, low + step).otherwise(low))


def z_ranks(df: DataFrame, cols: list[str], bits: int) -> DataFrame:
    """``df`` with ``__z``: the interleaved bits of each column's quantile rank, so nearby rows get nearby values.

    Columns are of any type that can be sorted; NULL has the lowest rank. The cuts are one row
    that the plan holds as a scalar subquery.
    """
    cuts = _cuts(df, cols, bits).select(F.struct("*").alias("c")).scalar()
    ranks = {}
    for i, c in enumerate(cols):
        number = _as_number(df, c)
        ranks[f"__r{i}"] = _rank(F.col(c) if number is None else number[1], F.col("__cuts")[f"c{i}"], bits)
    z = F.lit(0).cast("long")
    for i in range(len(cols)):
        for bit in range(bits):
            flag = F.shiftright(f"__r{i}", bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(flag, bit * len(cols) + i))
    return df.withColumn("__cuts", cuts).withColumns(ranks).withColumn("__z", z).drop("__cuts", *ranks)


def cluster(df: DataFrame, cols: list[str], n: int, bits: int | None = None) -> DataFrame:
    """Bring related values together in ``n`` partitions so files skip more on any of ``cols``.

    Without ``bits`` there are at least 16 values of the curve for each partition.
    """
    if bits is None:
        bits = min(62 // len(cols), max(4, math.ceil((math.log2(max(n, 1)) + 4) / len(cols))))
    tagged = z_ranks(df, cols, bits)
    return tagged.repartitionByRange(n, "__z").sortWithinPartitions("__z", *cols).drop("__z")


def partition_advice(df: DataFrame, cols: list[str], min_bytes: int, bytes_per_row: int, exact: bool = False) -> DataFrame:
    """Per candidate column: distinct values, estimated bytes per directory, and a verdict.

    All candidates are judged in one scan. Distinct counts are sketches unless ``exact``.
    """
    count = F.count_distinct if exact else F.approx_count_distinct
    lines = F.array(
        *[F.struct(F.lit(c).alias("candidate"), count(c).alias("distinct_values"), F.count(F.lit(1)).alias("rows")) for c in cols]
    )
    found = df.agg(lines.alias("__l")).select(F.inline("__l"))
    size = (F.col("rows") * bytes_per_row / F.greatest(F.col("distinct_values"), F.lit(1))).alias("bytes_per_value")
    sized = found.select("candidate", "distinct_values", size)
    return sized.withColumn(
        "advice", F.when(F.col("bytes_per_value") < min_bytes, "too many values").otherwise("suitable")
    )
