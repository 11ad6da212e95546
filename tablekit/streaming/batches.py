"""A latest-state table made of appended batches.

Every micro-batch writes one directory, named by its id: the rows it leaves for the keys it
holds, and a tombstone for each key it removed. The state is the newest row of each key, taken
by an aggregate over the batch ids, without tombstones. A batch that is delivered again
overwrites its own directory with the same rows, computed from the batches before it. A
directory that Spark has not finished is not read. ``compact`` is a Spark job that writes the
state up to a batch as one directory, so that readers can leave out the batches it holds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit import storage
from tablekit.operators.slices import same_keys

GONE, BATCH = "__gone", "__batch"
#: Batches since the last compaction after which the next batch compacts.
COMPACT_EVERY = 50


@dataclass(frozen=True)
class BatchTable:
    path: str
    keys: list[str]
    schema: T.StructType
    compact_every: int = COMPACT_EVERY

    def _finished(self, spark: SparkSession, kind: str) -> list[int]:
        names = (n.removeprefix(f"{kind}=") for n in storage.child_names(spark, self.path) if n.startswith(f"{kind}="))
        return sorted(i for i in map(int, names) if storage.exists(spark, f"{self.path}/{kind}={i}/_SUCCESS"))

    def _rows(self, spark: SparkSession, below: int | None = None) -> DataFrame | None:
        """All rows and tombstones that the state follows from; ``below`` leaves out batches from that id on."""
        whole = [i for i in self._finished(spark, "state") if below is None or i < below][-1:]
        batches = [i for i in self._finished(spark, "batch") if (below is None or i < below) and (not whole or i > whole[0])]
        found = [f"{self.path}/state={i}" for i in whole] + [f"{self.path}/batch={i}" for i in batches]
        if not found:
            return None
        stored = T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType()), T.StructField(BATCH, T.LongType())])
        return spark.read.schema(stored).parquet(*found)

    def read(self, spark: SparkSession, below: int | None = None) -> DataFrame:
        """The newest row of each key."""
        rows = self._rows(spark, below)
        if rows is None:
            return spark.createDataFrame([], self.schema)
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in self.keys]), BATCH).alias("__row"))
        return newest.filter(f"not __row.{GONE}").select(*[F.col(c) if c in self.keys else F.col("__row")[c].alias(c) for c in self.schema.names])

    def apply(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Write what ``merge(old_state, batch)`` makes of the keys in the batch.

        ``merge`` sees the old rows of those keys only. The batch is kept while it is used, so a
        stateful stream behind it runs once.
        """
        mine = not batch.is_cached
        if mine:
            batch.persist()
        try:
            if not batch.isEmpty():
                self._append(batch, batch_id, merge)
        finally:
            if mine:
                batch.unpersist()

    def _append(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        spark = batch.sparkSession
        if len(self._finished(spark, "batch")) >= self.compact_every:
            self.compact(spark, batch_id)
        named = batch.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)]).distinct()
        old = self.read(spark, below=batch_id).join(named, same_keys(self.keys), "left_semi")
        new = merge(old, batch).select(*self.schema.names)
        # an old row is a tombstone unless there is a new one for its key
        both = new.withColumn(GONE, F.lit(False)).union(old.select(*self.schema.names).withColumn(GONE, F.lit(True)))
        rest = [c for c in both.columns if c not in self.keys]
        left = both.groupBy(*self.keys).agg(F.min_by(F.struct(*rest), GONE).alias("__row"))
        left = left.select(*[F.col(c) if c in self.keys else F.col("__row")[c].alias(c) for c in both.columns])
        left.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def compact(self, spark: SparkSession, below: int) -> None:
        """The state before batch ``below`` as one directory; the batches it holds go.

        That batch may be delivered again afterwards, so it stays out.
        """
        batches = [i for i in self._finished(spark, "batch") if i < below]
        if not batches:
            return
        last = batches[-1]
        state = self.read(spark, below).withColumns({GONE: F.lit(False), BATCH: F.lit(last).cast("long")})
        state.write.mode("overwrite").parquet(f"{self.path}/state={last}")
        for i in batches:
            storage.delete(spark, f"{self.path}/batch={i}")
        for i in self._finished(spark, "state"):
            if i < last:
                storage.delete(spark, f"{self.path}/state={i}")
