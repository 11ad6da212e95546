"""Batch readers and writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit import storage
from tablekit.operators import evolve
from tablekit.operators.slices import same_keys

Schema = str | T.StructType
CORRUPT = "_corrupt_record"

# text formats write milliseconds unless told to keep all digits
FULL_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# --- files ------------------------------------------------------------------


def read_csv(
    spark: SparkSession, path: str, schema: Schema | None = None, header: bool = True, delimiter: str = ","
) -> DataFrame:
    """CSV with a given schema, or types inferred by an extra pass over the file."""
    reader = spark.read.option("header", header).option("sep", delimiter)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_strict(spark: SparkSession, path: str, schema: Schema, keep_bad_lines: bool = False) -> DataFrame:
    """Explicit schema: a cell that does not fit becomes NULL, its row stays.

    ``keep_bad_lines`` adds the original line of such rows as ``_corrupt_record``.
    """
    declared = _struct(schema)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_bad_lines:
        declared = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(declared).csv(path)


def _struct(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def inference_report(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Inferred against declared types, with the cells the declared type turns to NULL."""
    declared = _struct(schema)
    inferred = dict(read_csv(spark, path).dtypes)
    raw = spark.read.option("header", True).schema(T.StructType([T.StructField(f.name, T.StringType()) for f in declared])).csv(path)
    lines = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(inferred.get(f.name)).alias("inferred_type"),
            F.lit(f.dataType.simpleString()).alias("declared_type"),
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias("cells_nulled"),
        )
        for f in declared
    ]
    return raw.agg(F.array(*lines).alias("__r")).select(F.inline("__r"))


def write_csv(df: DataFrame, path: str, mode: str = "error", header: bool = True, delimiter: str = ",") -> None:
    df.write.mode(mode).options(**FULL_TIME).option("header", header).option("sep", delimiter).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A table as CSV files with a header line each."""
    write_csv(df, path, mode="overwrite")


def read_json(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """One JSON object per line, nested structs included."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).options(**FULL_TIME).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def convert(
    spark: SparkSession, src: str, src_fmt: str, dst: str, dst_fmt: str, schema: Schema | None = None, mode: str = "error"
) -> None:
    """Rewrite files of one format in another."""
    reader = spark.read.format(src_fmt)
    if src_fmt == "csv":
        reader = reader.option("header", True)
    if schema:
        reader = reader.schema(schema)
    elif src_fmt == "csv":
        reader = reader.option("inferSchema", True)
    writer = reader.load(src).write.mode(mode).format(dst_fmt)
    if dst_fmt in ("csv", "json"):
        writer = writer.options(**FULL_TIME)
    if dst_fmt == "csv":
        writer = writer.option("header", True)
    writer.save(dst)


MODES = ("overwrite", "append", "error", "ignore")


def write(df: DataFrame, path: str, mode: str, fmt: str = "parquet") -> None:
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    df.write.mode(mode).format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "error") -> None:
    """One directory per value, for pruning."""
    df.write.mode(mode).partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that occur in the batch and leave the others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def replace_where(df: DataFrame, path: str, predicate: str, by: list[str] | None = None) -> None:
    """Delete the rows for which the predicate is true and insert the batch. Repeatable.

    Batch rows must satisfy the predicate. Of a table partitioned ``by`` columns only the
    partitions are rewritten that hold such a row or receive one; another table is rewritten
    beside the old one and swapped in.
    """
    spark = df.sparkSession
    holds = F.coalesce(F.expr(predicate), F.lit(False))
    outside = F.raise_error(F.lit(f"batch row outside {predicate}")).cast("boolean")
    checked = df.filter(F.when(holds, F.lit(True)).otherwise(outside))
    old = spark.read.parquet(path)
    if not by:
        storage.replace_table(old.filter(~holds).unionByName(checked.select(*old.columns)), path)
        return
    touched = old.filter(holds).select(*by).union(df.select(*by))
    rewrite_partitions(spark, path, by, touched, lambda rows: rows.filter(~holds).unionByName(checked.select(*old.columns)))


def rewrite_partitions(spark: SparkSession, path: str, by: list[str], touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
    """Put ``change(rows)`` in the place of the rows of the partitions named in ``touched``.

    The new rows are finished beside the table before Spark moves them in, partition by
    partition; the files of all other partitions stay as they are. Partitions that are left
    without rows are removed last.
    """
    named = storage.cut_lineage(touched.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)]).distinct(), "touched")
    table = spark.read.parquet(path)
    new = storage.cut_lineage(change(table.join(named, same_keys(by), "left_semi")).select(*table.columns), "rewritten")
    overwrite_partitions(new, path, by)
    filled = new.select(*by).distinct()
    emptied = storage.cut_lineage(named.join(filled, same_keys(by), "left_anti"), "emptied")
    if not emptied.isEmpty():
        for directory in _leaf_directories(spark.read.schema(table.schema).parquet(path).join(emptied, same_keys(by), "left_semi")):
            storage.delete(spark, directory)


def _leaf_directories(df: DataFrame) -> list[str]:
    """Partition directories of a file scan: one name each, no data is read."""
    directory = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    return sorted(unquote(r["d"]) for r in df.select(directory.alias("d")).distinct().collect())


# --- catalog ----------------------------------------------------------------


def save_managed(df: DataFrame, name: str, mode: str = "error") -> None:
    """A table whose files belong to the catalog and go with it."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


def save_external(df: DataFrame, name: str, path: str, mode: str = "error") -> None:
    """A table over files that stay when the table is dropped."""
    df.write.mode(mode).format("parquet").option("path", path).saveAsTable(name)


def create_table(
    spark: SparkSession, name: str, columns: str, partitioned_by: list[str] | None = None, path: str | None = None
) -> None:
    """Declared columns, optionally partitioned."""
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partitioned_by:
        ddl += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if path:
        ddl += f" LOCATION '{path}'"
    spark.sql(ddl)


def load_seed(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """A lookup CSV with declared types; broadcast while it is small."""
    return spark.read.option("header", True).schema(schema).csv(path)


# --- incremental loading ----------------------------------------------------


@dataclass(frozen=True)
class Loaded:
    files: int
    rows: int


def copy_into(
    spark: SparkSession,
    src_dir: str,
    table_path: str,
    ledger_path: str,
    fmt: str,
    schema: Schema | None = None,
    merge_schema: bool = False,
) -> Loaded:
    """Load only files that were not loaded before; a second run finds nothing to do.

    The ledger is a table of file paths, sizes and times. A file that changed counts as new.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(src_dir)
    )
    found = listing.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))
    if storage.exists(spark, ledger_path):
        found = found.join(spark.read.parquet(ledger_path), ["file", "bytes", "modified_at"], "left_anti")
    # the pending list is fixed before loading, so files landing meanwhile wait for the next run
    pending_path = storage.work_dir(spark, "pending-files")
    found.write.parquet(pending_path)
    pending = spark.read.schema(found.schema).parquet(pending_path)
    names = [r["file"] for r in pending.select("file").collect()]
    if not names:
        return Loaded(0, 0)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    batch = reader.load(names)
    if storage.exists(spark, table_path):
        table = spark.read.option("mergeSchema", merge_schema).parquet(table_path)
        if merge_schema:
            batch = evolve.conform(batch, evolve.merge_types(table.schema, batch.schema))
        else:
            batch = evolve.enforce(batch, table.schema)
    seen = Observation()
    batch.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(table_path)
    pending.write.mode("append").parquet(ledger_path)
    return Loaded(len(names), seen.get["rows"])


def copy_table(src: DataFrame, dst: str, key: str, chunks: int) -> Loaded:
    """Copy a table in key ranges, the destination replaced as a whole, counts compared."""
    spark = src.sparkSession
    staged = f"{dst}.tmp-{uuid.uuid4().hex}"
    seen = Observation()
    src.repartitionByRange(chunks, key).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    wanted = seen.get["rows"]
    loaded = spark.read.parquet(staged).count()
    if wanted != loaded:
        storage.delete(spark, staged)
        raise RuntimeError(f"source has {wanted} rows, {loaded} were loaded")
    storage.swap_in(spark, staged, dst)
    return Loaded(chunks, loaded)


def read_jdbc_chunks(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, chunks: int, **properties: str
) -> DataFrame:
    """A database table read in parallel key ranges, to feed :func:`copy_table`."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=chunks, properties=properties
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, longest text, precision, NULLs and rows, in one pass."""

    def precision(t: T.DataType) -> int | None:
        return t.precision if isinstance(t, T.DecimalType) else None

    lines = []
    for i, f in enumerate(df.schema, start=1):
        text = isinstance(f.dataType, T.StringType)
        longest = F.max(F.length(f.name)) if text else F.lit(None).cast("int")
        lines.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                longest.alias("max_length"),
                F.lit(precision(f.dataType)).cast("int").alias("precision"),
                F.count_if(F.col(f.name).isNull()).alias("nulls"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
    return df.agg(F.array(*lines).alias("__l")).select(F.inline("__l"))
