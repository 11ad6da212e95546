"""Directories on the cluster's shared file system.

All path work goes through Hadoop's FileSystem, so the same code serves local
disks, HDFS and object stores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the session names, or else one beside the tables of its warehouse."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    root = (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared").rstrip("/")
    if not configured and not spark.sparkContext.master.startswith("local") and hadoop_path(spark, root)[0].getUri().getScheme() == "file":
        raise RuntimeError(f"{root} is on one machine's disk: set {CHECKPOINT_CONF} to a folder that driver and executors share")
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory name under the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, target = hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength()


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, each once."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    return sum(total_bytes(spark, jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString()) for f in df.inputFiles())


def make_parent(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target.getParent())


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; empty if it has none."""
    fs, target = hadoop_path(spark, path)
    source = fs.open(target)
    try:
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(source, "UTF-8"))
        return lines.readLine() or ""
    finally:
        source.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = hadoop_path(spark, source)
    if not fs.rename(source_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished directory in the place of ``path``.

    The old copy is moved aside first and only removed once the new one is in
    place, so a failure in between leaves a complete copy to go back to.
    """
    aside = f"{path}.old-{uuid.uuid4().hex}"
    had_old = exists(spark, path)
    if had_old:
        rename(spark, path, aside)
    try:
        rename(spark, staged, path)
    except Exception:
        if had_old:
            rename(spark, aside, path)
        raise
    if had_old:
        delete(spark, aside)


def child_names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    fs, target = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)]


def move_directories(spark: SparkSession, staged: str, path: str, chosen) -> None:
    """Replace the chosen partition directories of ``path`` by those of ``staged``.

    The old ones are moved aside and go last; if a move fails, they are put back.
    """
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)
    aside = f"{path}.old-{uuid.uuid4().hex}"
    fs.mkdirs(hadoop_path(spark, aside)[1])
    old = [name for name in child_names(spark, path) if chosen(name)]
    new = [name for name in child_names(spark, staged) if chosen(name)]
    moved: list[tuple[str, str]] = []
    try:
        for source, goal, names in ((path, aside, old), (staged, path, new)):
            for name in names:
                rename(spark, f"{source}/{name}", f"{goal}/{name}")
                moved.append((f"{goal}/{name}", f"{source}/{name}"))
    except Exception:
        for now, before in reversed(moved):
            rename(spark, now, before)
        raise
    delete(spark, aside)
    delete(spark, staged)


def replace_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Write ``df`` beside ``path`` and swap it in; ``df`` may read from ``path``."""
    staged = f"{path}.tmp-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(staged)
    swap_in(df.sparkSession, staged, path)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and read it back."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, known before anything runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
