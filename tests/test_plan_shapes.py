"""What Spark plans for the operators: shuffles, broadcasts, pushed filters, pruned columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.registry import Tables
from checks.stand_ins import STAND_INS
from tablekit.operators import cols, join, layout, order, rows, udfs, windows
from tablekit.sources import io

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="module")
def customer(spark):
    return spark.read.parquet(f"{SF}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chained_columns_become_one_projection(orders):
    text = plan(cols.derive(orders, a=F.col("o_totalprice") * 2, b=F.col("o_totalprice") + 1, c=F.upper("o_orderstatus")))
    assert text.count("Project [") == 1


def test_filters_and_columns_reach_the_scan(orders):
    text = plan(rows.where_compare(orders, "o_totalprice", ">", 1000).select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_required_columns_are_tested_in_the_scan(orders):
    text = plan(rows.require(orders, ["o_orderstatus", "o_orderpriority"]))
    assert "IsNotNull(o_orderstatus)" in text and "IsNotNull(o_orderpriority)" in text


def test_small_side_is_broadcast_and_large_side_stays(orders, customer):
    text = plan(join.broadcast(orders, customer, ["o_custkey"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_side_over_the_limit_is_not_broadcast_by_hint(spark, orders, customer):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(join.broadcast(orders, customer, ["o_custkey"], max_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_forced_shuffle_join(orders, customer):
    assert "SortMergeJoin" in plan(join.shuffle(orders, customer, ["o_custkey"]))


def test_top_n_is_cut_down_before_the_shuffle(orders):
    text = plan(windows.top_n_per_group(orders, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 3))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2
    lines = text.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])


def test_latest_per_key_is_cut_down_before_the_shuffle(orders):
    assert "Partial" in plan(windows.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))


def test_limit_keeps_only_n_rows_per_task(orders):
    assert "TakeOrderedAndProject" in plan(order.limit(orders, ["-o_totalprice"], 5))


def test_window_on_ordinary_keys_shuffles_once(orders):
    text = plan(windows.row_number(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert text.count("Exchange hashpartitioning") == 1


def test_point_in_time_has_no_join(orders, customer):
    dim = customer.select("o_custkey", F.lit("1990-01-01").cast("timestamp_ntz").alias("valid_from"),
                          F.lit(None).cast("timestamp_ntz").alias("valid_to"), "c_name")
    text = plan(join.point_in_time(orders, dim, ["o_custkey"], "o_orderdate"))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_interval_join_matches_on_the_time_step(orders):
    a = orders.select("o_custkey", F.col("o_orderdate").alias("x"))
    b = orders.select("o_custkey", F.col("o_orderdate").alias("y"))
    text = plan(join.interval(a, b, ["o_custkey"], "x", "y", 86_400))
    assert "NestedLoop" not in text and "Cartesian" not in text and "__step" in text


def test_coalesce_does_not_shuffle(orders):
    assert "Exchange" not in plan(layout.coalesce(orders, 1))


def test_partition_pruning_after_partitioned_write(spark, orders, tmp_path):
    path = str(tmp_path / "by-status")
    io.write_partitioned(orders, path, ["o_orderstatus"])
    text = plan(io.read_parquet(spark, path).filter("o_orderstatus = 'F'"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_clustered_files_skip_on_both_columns(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_partkey", "l_suppkey")
    ranges = (
        layout.cluster(lines, ["l_partkey", "l_suppkey"], 16)
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(*[f(c).alias(f"{n}_{c}") for c in ("l_partkey", "l_suppkey") for n, f in (("lo", F.min), ("hi", F.max))])
        .collect()
    )
    for c, value in (("l_partkey", 1000), ("l_suppkey", 50)):
        hit = sum(r[f"lo_{c}"] <= value <= r[f"hi_{c}"] for r in ranges)
        assert hit <= len(ranges) * 0.6


def test_scalar_udf_leaves_generated_code(orders):
    double = udfs.scalar(lambda x: x * 2, "bigint", use_arrow=False)
    assert "BatchEvalPython" in plan(orders.select(double("o_orderkey")))
    assert "EvalPython" not in plan(orders.select(F.col("o_orderkey") * 2))


def test_salted_join_spreads_only_the_hot_key(orders, customer):
    text = plan(join.salted(orders, customer, ["o_custkey"], 4, ["o_orderkey"], hot_keys=[1]))
    assert "__salt" in text
    assert join.salted(orders, customer, ["o_custkey"], 4, ["o_orderkey"], hot_keys=[1]).count() == join.inner(
        orders, customer, ["o_custkey"]
    ).count()


@pytest.mark.parametrize("name", list(STAND_INS))
def test_stand_ins_are_joined_by_keys(spark, name):
    """Whatever columns a query filters on, no product of two tables' rows is planned."""
    df = getattr(Tables(spark, "/root/testdata/sf0.001"), name)
    for kept in (df, df.dropna(), *[df.filter(F.col(c).isNotNull()) for c in df.columns]):
        text = plan(kept)
        assert "NestedLoop" not in text and "Cartesian" not in text
