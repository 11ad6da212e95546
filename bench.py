"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Queries run once to warm up and are then timed, each computed in full into a sink that
keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import QUERIES  # noqa: E402
from tablekit.session import local_session  # noqa: E402
from tablekit.sources import io  # noqa: E402

HEADLINE = [
    "s03_01_inner",
    "s03_06_salted",
    "s03_08_point_in_time",
    "s03_09_interval",
    "s04_01_count_by",
    "s04_05_count_distinct",
    "s04_12_salted_count",
    "s05_01_row_number",
    "s05_04_lag_lead",
    "s05_05_running_total",
    "s05_07_top_n_per_group",
    "s02_14_drop_duplicates",
    "s07_02_limit",
    "s09_08_streak_batch",
    "s11_01_upsert",
    "s11_05_apply_cdc",
    "s11_11_diff",
    "s11_16_type2_from_changes",
    "s12_01_telecom_transform",
    "s12_04_webchecks_transform",
    "s12_07_shop_transform",
    "s12_10_broadcasts_summary",
    "s12_12_sales_by_city_status",
    "s12_13_sales_by_city",
    "s12_21_orders_gold",
    "s13_08_reconcile",
]


PUBLISHED_ROWS = 1_000_000


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def format_reads(spark, sf_dir: str, work: str) -> dict:
    """The published comparison: read one column of a four-column file of 1,000,000 rows and count it.

    The rows are those of ``lineitem``, repeated as often as that takes.
    """
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    times = -(-PUBLISHED_ROWS // max(1, table.count()))
    whole = table.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).limit(PUBLISHED_ROWS).repartition(8)
    lines = whole.selectExpr("l_orderkey as id", "concat('user_', l_suppkey) as user_id", "l_quantity as value", "cast(cast(l_shipdate as date) as string) as date")
    io.write_csv(lines, f"{work}/csv")
    io.write_json(lines, f"{work}/json")
    io.write_parquet(lines, f"{work}/parquet")
    return {
        "read_csv_inferred": lambda: io.read_csv(spark, f"{work}/csv").select("user_id").count(),
        "read_json_inferred": lambda: spark.read.json(f"{work}/json").select("user_id").count(),
        "read_parquet": lambda: io.read_parquet(spark, f"{work}/parquet").select("user_id").count(),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, "8g", **{"spark.checkpoint.dir": f"{work}/shared"})
    runs = format_reads(spark, sf_dir, work)

    def query(key: str):
        return lambda: QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()

    runs.update({key: query(key) for key in HEADLINE})
    seconds = {}
    for name, run in runs.items():
        run()
        seconds[name] = timed(run)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
