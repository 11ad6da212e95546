"""E-commerce orders: incremental ingest, cleaning and load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablekit import storage
from tablekit.functions import exprs
from tablekit.operators import rows

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_watermark(spark: SparkSession, path: str) -> datetime | None:
    if not storage.exists(spark, path):
        return None
    return spark.read.schema("watermark TIMESTAMP_NTZ").parquet(path).agg(F.max("watermark")).first()[0]


def ingest(shop: DataFrame, out: str, watermark_path: str) -> int:
    """Write the rows newer than the stored watermark and move it to their newest time.

    The first run takes everything. Returns the number of rows written. The watermark moves
    only after the rows are safe; it is one appended row, and the largest counts.
    """
    spark = shop.sparkSession
    timed = shop.withColumn("order_datetime", exprs.parse_ts("order_date", TIME_FORMAT))
    fresh = rows.since_watermark(timed, "order_datetime", read_watermark(spark, watermark_path))
    seen = Observation()
    counted = fresh.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("order_datetime").alias("newest"))
    counted.write.mode("overwrite").parquet(out)
    got = seen.get
    if got["newest"] is not None:
        spark.createDataFrame([(got["newest"],)], "watermark TIMESTAMP_NTZ").write.mode("append").parquet(watermark_path)
    return got["rows"]


def transform(shop: DataFrame) -> DataFrame:
    """Valid orders, one row per order id (the earliest; ties by value of the columns)."""
    typed = shop.withColumns(
        {
            "order_datetime": exprs.parse_ts("order_date", TIME_FORMAT),
            "price": exprs.try_cast("price", "double"),
            "quantity": exprs.try_cast("quantity", "long"),
            "status": exprs.clean("status", "lower"),
            "category": exprs.clean("category"),
        }
    )
    valid = typed.filter(F.col("order_datetime").isNotNull() & (F.col("price") > 0) & (F.col("quantity") > 0))
    order = ["order_datetime", "product", "price", "quantity", "customer_name", "category", "status", "order_date"]
    single = rows.drop_duplicates(valid, ["order_id"], order)
    at = F.col("order_datetime")
    return single.withColumns(
        {
            "order_date_only": exprs.date_of(at),
            "order_time_only": exprs.time_of(at),
            "order_value": F.col("price") * F.col("quantity"),
            "order_weekday": exprs.iso_weekday(at),
            "order_hour": F.hour(at),
        }
    )


def load(shop: DataFrame, directory: str, stamp: datetime) -> str:
    """Write under a name that carries the load time; returns the path."""
    path = f"{directory}/transformed_{int(stamp.timestamp())}"
    shop.write.mode("overwrite").parquet(path)
    return path
