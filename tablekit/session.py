"""Session defaults shared by the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A session on this machine. A cluster job brings its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablekit")
        .config("spark.driver.memory", memory)
    )
    for name, value in {**LOCAL_DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
