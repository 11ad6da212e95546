"""Stream readers and writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablekit import storage

Schema = str | T.StructType
RESCUED = "_rescued_data"


def _struct(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_files(
    spark: SparkSession, path: str, schema: Schema, fmt: str = "parquet", max_files: int | None = None, **options: str
) -> DataFrame:
    """New files of a landing directory. ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Rows added to an existing Parquet table; its schema is taken from the files."""
    return read_files(spark, path, spark.read.parquet(path).schema, "parquet", max_files)


def read_rate(spark: SparkSession, rows_per_second: int, per_batch: int | None = None, partitions: int | None = None) -> DataFrame:
    """A test source of ``(timestamp, value)`` with a text ``label``.

    ``per_batch`` gives a fixed number of rows per micro-batch instead of a clock. A continuous
    query holds one core for each of the ``partitions`` as long as it runs.
    """
    if per_batch:
        source = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch).load()
    else:
        reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
        source = (reader.option("numPartitions", partitions) if partitions else reader).load()
    return labelled(source)


def labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.upper(F.col("value").cast("string")))


# --- keyed events -----------------------------------------------------------


def decode_events(kv: DataFrame, schema: Schema) -> DataFrame:
    """Key and value bytes to text, the JSON value to columns."""
    value = F.from_json(F.col("value").cast("string"), _struct(schema))
    return kv.select(F.col("key").cast("string").alias("key"), value.alias("d")).select("key", "d.*")


def encode_events(df: DataFrame, key: str, cols: list[str], cond: Column | str | None = None) -> DataFrame:
    """Rows (optionally only those that satisfy ``cond``) as key and JSON value."""
    chosen = df if cond is None else df.filter(cond)
    return chosen.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


KV_SCHEMA = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def kafka_source(
    spark: SparkSession,
    servers: str | None = None,
    topic: str = "",
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    directory: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A topic as key/value rows; ``directory`` reads files of such rows in place of a broker."""
    if directory:
        return read_files(spark, directory, KV_SCHEMA, "parquet", max_files).filter(F.col("topic") == topic)
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def kafka_sink(
    kv: DataFrame, checkpoint: str, servers: str | None = None, topic: str = "", directory: str | None = None
) -> StreamingQuery:
    """Write key/value rows to a topic, or to a directory in place of a broker."""
    writer = kv.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if directory:
        return writer.format("parquet").start(directory)
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).start()


# --- schema drift -----------------------------------------------------------

ADD, RESCUE, FAIL, NONE = "addNewColumns", "rescue", "failOnNewColumns", "none"


def auto_ingest(
    spark: SparkSession,
    path: str,
    schema: Schema,
    mode: str = RESCUE,
    new_columns: Schema | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New JSON-lines files, each loaded once, with a rule for unexpected fields.

    ``none`` ignores unknown fields; ``rescue`` keeps them, and values that do not fit their
    column, as JSON text in ``_rescued_data``; ``failOnNewColumns`` stops the stream;
    ``addNewColumns`` also reads ``new_columns`` (see :func:`discover_columns`) and rescues
    what is still unknown.
    """
    lines = read_files(spark, path, "value STRING", "text", max_files)
    return parse_drifting(lines, schema, mode, new_columns)


def parse_drifting(lines: DataFrame, schema: Schema, mode: str = RESCUE, new_columns: Schema | None = None) -> DataFrame:
    """The parsing step of :func:`auto_ingest`, for batch and stream alike."""
    known = _struct(schema)
    if mode == ADD and new_columns:
        have = set(known.names)
        known = T.StructType([*known.fields, *[f for f in _struct(new_columns) if f.name not in have]])
    typed = F.from_json("value", known)
    raw = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    read = lines.select(typed.alias("d"), raw.alias("raw"))
    if mode == NONE:
        return read.select("d.*")

    unknown = F.map_filter("raw", lambda k, v: ~k.isin(*known.names))
    if mode == FAIL:
        stop = F.raise_error(F.concat(F.lit("unexpected fields: "), F.array_join(F.map_keys(unknown), ", ")))
        return read.filter(F.when(F.coalesce(F.size(unknown), F.lit(0)) <= 0, F.lit(True)).otherwise(stop.cast("boolean"))).select("d.*")
    if mode not in (ADD, RESCUE):
        raise ValueError(f"unknown schema evolution mode {mode!r}")

    misfits = F.map_filter(
        "raw",
        lambda k, v: ~k.isin(*known.names) | _misread(k, v, known),
    )
    rescued = F.when(F.size(misfits) > 0, F.to_json(misfits))
    return read.select("d.*", rescued.alias(RESCUED))


def _misread(key: Column, value: Column, known: T.StructType) -> Column:
    """A known field with a value that came out as NULL."""
    out = F.lit(False)
    for f in known:
        out = out | ((key == f.name) & value.isNotNull() & F.col("d").getField(f.name).isNull())
    return out


def discover_columns(spark: SparkSession, path: str, schema: Schema) -> T.StructType:
    """Fields in the files beyond the schema, as text columns, sorted by name."""
    known = _struct(schema)
    raw = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    keys = spark.read.text(path).select(F.explode(F.map_keys(raw)).alias("k")).filter(~F.col("k").isin(*known.names)).distinct()
    # field names of a schema, one row each
    return T.StructType([T.StructField(r["k"], T.StringType()) for r in keys.orderBy("k").collect()])


# --- sinks ------------------------------------------------------------------


def write_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    by: list[str] | None = None,
    table: str | None = None,
) -> StreamingQuery:
    """A stream into a Parquet directory, or into a catalog table stored there."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if by:
        writer = writer.partitionBy(*by)
    return writer.option("path", path).toTable(table) if table else writer.start(path)


def fan_out(
    df: DataFrame, sinks: list[Callable[[DataFrame, int], None]], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Each micro-batch to several sinks, computed once.

    A batch can be delivered again after a failure: sinks get its id and must be repeatable,
    as :func:`batch_directory` is.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def batch_directory(path: str) -> Callable[[DataFrame, int], None]:
    """An archive sink: one directory per batch id, overwritten on redelivery."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return sink


# --- a running ingest -------------------------------------------------------


def ingest(
    spark: SparkSession, path: str, table: str, schema: Schema, checkpoint: str, fmt: str = "json", mode: str = ADD, max_files: int = 1000
) -> StreamingQuery:
    """Load new JSON-lines or CSV files into ``table``, whose schema follows them while the ingest runs.

    Each micro-batch is one directory of the table, overwritten if it is delivered again, so a
    file is loaded once. With ``addNewColumns`` fields that a batch brings along become columns
    from that batch on: of JSON with the type that all their values share, of CSV as text; a
    column keeps its type afterwards, and cells that do not fit it are rescued. The other modes
    are those of :func:`auto_ingest`. CSV files have a header line each and may differ in it.
    Read the table with :func:`read_ingested`.
    """
    if mode not in (ADD, RESCUE, FAIL, NONE):
        raise ValueError(f"unknown schema evolution mode {mode!r}")
    declared = _struct(schema)

    def known() -> T.StructType:
        if mode != ADD or not storage.exists(spark, table):
            return declared
        stored = read_ingested(spark, table).schema
        have = set(declared.names) | {RESCUED}
        return T.StructType([*declared.fields, *[f for f in stored if f.name not in have]])

    def load(batch: DataFrame, batch_id: int) -> None:
        columns = known()
        if fmt == "json":
            if mode == ADD:
                columns = _widened(columns, batch)
            rows = parse_drifting(batch, columns, mode)
        else:
            # the files of one micro-batch, max_files at most
            rows = _csv_rows(spark, [r["path"] for r in batch.select("path").collect()], columns, mode)
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    if fmt == "json":
        source = read_files(spark, path, "value STRING", "text", max_files)
    else:
        listing = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
        source = read_files(spark, path, listing, "binaryFile", max_files, pathGlobFilter="*.csv").select("path")
    return source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table that :func:`ingest` fills, with all columns that came so far."""
    return spark.read.option("mergeSchema", True).parquet(table).drop("batch")


def _widened(known: T.StructType, lines: DataFrame) -> T.StructType:
    """``known`` and the fields that the lines hold beyond it, by the schema all their values share."""
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json("value")).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return known
    # fields without any value, and those whose values share no type, are texts
    ddl = found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")
    fields = T.StructType.fromDDL(ddl[len("STRUCT<") : -1])
    return T.StructType([*known.fields, *[f for f in sorted(fields, key=lambda f: f.name) if f.name not in known.names]])


def _csv_rows(spark: SparkSession, files: list[str], known: T.StructType, mode: str) -> DataFrame | None:
    """The rows of CSV files as columns of ``known``; files of one header are read together."""
    by_header: dict[str, list[str]] = {}
    for file in files:
        by_header.setdefault(storage.first_line(spark, file), []).append(file)
    out = None
    for header, names in sorted(by_header.items()):
        texts = T.StructType([T.StructField(c.strip().strip('"'), T.StringType()) for c in header.split(",")]) if header else None
        if texts is None:
            continue
        part = _fitted(spark.read.schema(texts).option("header", True).csv(names), known, mode)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _fitted(rows: DataFrame, known: T.StructType, mode: str) -> DataFrame:
    """Rows of texts cast to the columns of ``known``; what does not fit goes as the mode says."""
    extra = [c for c in rows.columns if c not in known.names]
    if mode == FAIL and extra:
        raise ValueError(f"unexpected fields: {', '.join(extra)}")
    typed = [(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in known]
    if mode in (FAIL, NONE):
        return rows.select(*typed)
    added = [F.col(c) for c in extra] if mode == ADD else []
    entries = [F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in extra if mode == RESCUE]
    for f in known:
        if f.name in rows.columns:
            misfit = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            entries.append(F.when(misfit, F.struct(F.lit(f.name).alias("key"), F.col(f.name).alias("value"))))
    held = F.filter(F.array(*entries), lambda e: e.isNotNull() & e["value"].isNotNull())
    rescued = F.when(F.size(held) > 0, F.to_json(F.map_from_entries(held)))
    return rows.select(*typed, *added, rescued.alias(RESCUED))
