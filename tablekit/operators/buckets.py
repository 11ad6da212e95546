"""Tables in hash buckets of their keys: a change rewrites the buckets it touches, and no other file.

A bucket is a directory of Parquet files. Which ones a change touches follows from the keys of
its source, or from a scan for the rows it is about; their rows are read, changed, finished
beside the table and moved in by Spark's dynamic partition overwrite. Another reader sees each
bucket before or after its change. A change that stopped half-way is made good by running it
again, since upserts and deletes are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit import storage
from tablekit.operators import merge
from tablekit.sources.io import overwrite_partitions, rewrite_partitions

BUCKET = "key_bucket"


@dataclass(frozen=True)
class BucketTable:
    """``n`` buckets by ``keys``; the number belongs to the table and is chosen for its expected size."""

    path: str
    keys: list[str]
    n: int

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int"))

    def exists(self, spark: SparkSession) -> bool:
        return storage.exists(spark, self.path)

    def create(self, df: DataFrame) -> None:
        """A new table; each bucket is written by one task."""
        overwrite_partitions(self._bucketed(df).repartition(BUCKET), self.path, [BUCKET])

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(BUCKET)

    def merge(self, source: DataFrame, fn: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """``fn(old, source)`` on the buckets that keys of ``source`` fall into."""
        self._change(self._bucketed(source).select(BUCKET), source.sparkSession, lambda old: fn(old, source))

    def upsert(self, source: DataFrame, order: list[str] | None = None) -> None:
        self.merge(source, lambda old, new: merge.upsert(old, new, self.keys, order))

    def update(self, spark: SparkSession, cond: Column | str, set_: dict[str, Column]) -> None:
        """New values where the condition is true. Keys stay as they are."""
        if set(set_) & set(self.keys):
            raise ValueError("a key decides the bucket and cannot be set")
        self._change(self._matching(spark, cond), spark, lambda old: merge.update(old, cond, set_))

    def delete(self, spark: SparkSession, cond: Column | str) -> None:
        """Drop rows for which the condition is true; unknown keeps the row."""
        self._change(self._matching(spark, cond), spark, lambda old: merge.delete(old, cond))

    def _matching(self, spark: SparkSession, cond: Column | str) -> DataFrame:
        return spark.read.parquet(self.path).filter(cond).select(BUCKET)

    def _change(self, touched: DataFrame, spark: SparkSession, change: Callable[[DataFrame], DataFrame]) -> None:
        rewrite_partitions(spark, self.path, [BUCKET], touched, lambda old: self._bucketed(change(old.drop(BUCKET))).repartition(BUCKET))
