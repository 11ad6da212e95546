"""Small tables with results worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit import storage
from tablekit.functions import exprs
from tablekit.operators import agg, cols, evolve, history, merge, publish, quality, rows, scd, windows
from tablekit.operators.buckets import BucketTable
from tablekit.plans import broadcasts, shop, webchecks
from tablekit.sources import io


def values(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


# --- windows ----------------------------------------------------------------


@pytest.fixture(scope="module")
def payments(spark):
    data = [("a", "2024-01-01", 100), ("a", "2024-01-02", 200), ("a", "2024-01-02", 200), ("b", "2024-01-01", 50), ("b", "2024-01-03", 75)]
    return spark.createDataFrame(data, "user STRING, date STRING, amount BIGINT")


def test_rankings_differ_on_ties(payments):
    assert values(windows.rank(payments, ["user"], ["-amount"]), "user", "amount", "rank") == [
        ("a", 100, 3), ("a", 200, 1), ("a", 200, 1), ("b", 50, 2), ("b", 75, 1)]
    assert values(windows.dense_rank(payments, ["user"], ["-amount"]), "user", "amount", "dense_rank") == [
        ("a", 100, 2), ("a", 200, 1), ("a", 200, 1), ("b", 50, 2), ("b", 75, 1)]


def test_running_total_shares_ties(payments):
    got = values(windows.running_total(payments, ["user"], ["date"], "amount"), "user", "date", "running_total")
    assert got[:3] == [("a", "2024-01-01", 100), ("a", "2024-01-02", 500), ("a", "2024-01-02", 500)]


# --- sources ----------------------------------------------------------------


@pytest.fixture
def users_csv(spark, tmp_path):
    path = str(tmp_path / "users")
    data = [(1, "Ann", "2024-01-01"), (2, "Bob", "not-found"), (3, "Cyd", "2024-02-30"), (4, "Dan", "2024-03-01")]
    io.write_csv(spark.createDataFrame(data, "id INT, name STRING, signup_date STRING"), path)
    return path


def test_bad_cells_become_null_and_rows_stay(spark, users_csv):
    df = io.read_csv_strict(spark, users_csv, "id INT, name STRING, signup_date DATE", keep_bad_lines=True)
    assert values(df, "id", "signup_date")[0] == (1, date(2024, 1, 1))
    assert df.filter("signup_date is null").count() == 2
    assert sorted(r["id"] for r in df.collect() if r["_corrupt_record"]) == [2, 3]


def test_one_bad_value_makes_the_inferred_column_text(spark, users_csv):
    report = {r["column"]: r for r in io.inference_report(spark, users_csv, "id INT, name STRING, signup_date DATE").collect()}
    assert report["signup_date"]["inferred_type"] == "string" and report["signup_date"]["cells_nulled"] == 2
    assert report["id"]["inferred_type"] == "int" and report["id"]["cells_nulled"] == 0


def test_timestamps_survive_text_formats(spark, tmp_path):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(1, at)], "id INT, at TIMESTAMP_NTZ")
    io.write_csv(df, str(tmp_path / "c"))
    io.write_json(df, str(tmp_path / "j"))
    assert io.read_csv(spark, str(tmp_path / "c"), df.schema).first()["at"] == at
    assert io.read_json(spark, str(tmp_path / "j"), df.schema).first()["at"] == at


def test_write_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    io.write(df, path, "error")
    with pytest.raises(Exception, match="exists"):
        io.write(df, path, "error")
    with pytest.raises(ValueError, match="mode"):
        io.write(df, path, "replace")
    io.write(df, path, "ignore")
    io.write(df, path, "append")
    assert spark.read.parquet(path).count() == 6


def test_replace_where_refuses_rows_outside_and_keeps_null(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_parquet(spark.createDataFrame([("IN", 1), ("US", 2), (None, 3)], "region STRING, amount INT"), path)
    with pytest.raises(Exception, match="outside"):
        io.replace_where(spark.createDataFrame([("US", 9)], "region STRING, amount INT"), path, "region = 'IN'")
    assert spark.read.parquet(path).count() == 3
    io.replace_where(spark.createDataFrame([("IN", 9)], "region STRING, amount INT"), path, "region = 'IN'")
    assert sorted(r["amount"] for r in spark.read.parquet(path).collect()) == [2, 3, 9]


def test_replace_where_touches_only_matching_directories(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_partitioned(spark.createDataFrame([("a b", 1), ("US", 2), ("x:y", 3)], "region STRING, amount INT"), path, ["region"])
    before = set((tmp_path / "t" / "region=US").iterdir())
    io.replace_where(spark.createDataFrame([("a b", 7)], "region STRING, amount INT"), path, "region <> 'US'", ["region"])
    assert set((tmp_path / "t" / "region=US").iterdir()) == before
    assert values(spark.read.parquet(path), "region", "amount") == [("US", 2), ("a b", 7)]


def test_replace_where_rewrites_partitions_with_matching_rows_only(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_partitioned(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 1), ("c", 1)], "region STRING, amount INT"), path, ["region"])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "region=b").iterdir()}
    for _ in range(2):
        io.replace_where(spark.createDataFrame([("a", 1), ("d", 1)], "region STRING, amount INT"), path, "amount = 1", ["region"])
        assert values(spark.read.parquet(path), "region", "amount") == [("a", 1), ("a", 2), ("b", 3), ("d", 1)]
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "region=b").iterdir()} == before


def test_bucket_table_rewrites_touched_buckets_only(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ["k"], 4)
    table.create(spark.range(40).select(F.col("id").alias("k"), F.lit(0).alias("v")))

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("key_bucket=*/*.parquet")}

    before = files()
    table.upsert(spark.createDataFrame([(3, 9), (3, 8)], "k LONG, v INT"), ["v"])
    after = files()
    touched = {f.parent for f in set(before) ^ set(after)}
    assert len(touched) == 1 and all(before[f] == after[f] for f in set(before) & set(after))
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == {k: 9 if k == 3 else 0 for k in range(40)}
    table.delete(spark, "k <> 3")
    assert values(table.read(spark), "k", "v") == [(3, 9)] and len({f.parent for f in files()}) == 1
    with pytest.raises(ValueError, match="key"):
        table.update(spark, "v = 9", {"k": F.lit(1)})


def test_copy_into_is_a_no_op_the_second_time(spark, tmp_path):
    src, table, ledger = (str(tmp_path / n) for n in ("src", "table", "ledger"))
    io.write_csv(spark.range(5), f"{src}/one")
    assert io.copy_into(spark, src, table, ledger, "csv", "id BIGINT").rows == 5
    assert io.copy_into(spark, src, table, ledger, "csv", "id BIGINT").files == 0
    io.write_csv(spark.range(2).withColumn("note", F.lit("x")), f"{src}/two")
    with pytest.raises(evolve.SchemaMismatch):
        io.copy_into(spark, src, table, ledger, "csv", "id BIGINT, note STRING")
    assert io.copy_into(spark, src, table, ledger, "csv", "id BIGINT, note STRING", merge_schema=True).rows == 2
    assert spark.read.option("mergeSchema", True).parquet(table).filter("note = 'x'").count() == 2


def test_swap_puts_the_old_table_back_when_it_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_parquet(spark.range(4), path)
    with pytest.raises(Exception):  # noqa: B017
        storage.swap_in(spark, str(tmp_path / "missing"), path)
    assert spark.read.parquet(path).count() == 4


def test_shared_folder_comes_from_the_session(spark):
    assert storage.work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- merges and history -----------------------------------------------------


@pytest.fixture(scope="module")
def states(spark):
    return spark.createDataFrame([(1, "a", "KA"), (2, "b", "TN"), (3, "c", "MH"), (None, "n", "XX")], "id INT, name STRING, state STRING")


def test_merge_raises_on_two_source_rows_for_one_target_row(spark, states):
    source = spark.createDataFrame([(3, "x", "DL"), (3, "y", "GA")], "id INT, name STRING, state STRING")
    clauses = [merge.When.matched().update_all(), merge.When.not_matched().insert_all()]
    with pytest.raises(Exception, match="several source rows"):
        merge.general(states, source, ["id"], clauses).collect()


def test_merge_inserts_unmatched_duplicates_and_null_keys(spark, states):
    source = spark.createDataFrame([(9, "x", "DL"), (9, "y", "GA"), (None, "z", "GA")], "id INT, name STRING, state STRING")
    clauses = [merge.When.matched().update_all(), merge.When.not_matched().insert_all()]
    assert merge.general(states, source, ["id"], clauses).count() == 7


def test_first_clause_wins(spark, states):
    source = spark.createDataFrame([(1, "new", "KA"), (2, "new", "DL")], "id INT, name STRING, state STRING")
    clauses = [merge.When.matched(F.col("s.state") == F.col("t.state")).delete(), merge.When.matched().update(name=F.col("s.name"))]
    got = {r["id"]: r["name"] for r in merge.general(states, source, ["id"], clauses).collect()}
    assert got == {2: "new", 3: "c", None: "n"}


def test_cdc_takes_the_newest_event_per_key(spark, states):
    feed = spark.createDataFrame(
        [(2, "b2", "KL", "U", 1), (2, "b3", "AP", "U", 2), (3, "c", "MH", "D", 1), (4, "d", "GA", "I", 1), (5, "e", "UP", "U", 1), (1, "z", "ZZ", "I", 1)],
        "id INT, name STRING, state STRING, op STRING, ts INT",
    )
    got = {r["id"]: (r["name"], r["state"]) for r in merge.apply_cdc(states, feed, ["id"], ["ts"]).collect()}
    assert got == {1: ("a", "KA"), 2: ("b3", "AP"), 4: ("d", "GA"), None: ("n", "XX")}


def test_update_computes_all_values_from_the_old_row(spark):
    df = spark.createDataFrame([(1, 10, 20)], "id INT, a INT, b INT")
    assert values(merge.update(df, "id = 1", {"a": F.col("b"), "b": F.col("a")})) == [(1, 20, 10)]


def test_expired_history_refuses_older_versions(spark):
    log = history.Log(spark.createDataFrame([(1, "x", "I", 1, 1), (1, "y", "U", 2, 2), (2, "z", "I", 3, 3)],
                                            "k INT, v STRING, op STRING, version INT, commit_ts INT"), ["k"], ["commit_ts"])
    kept = history.expire(log, 2)
    assert values(history.as_of(kept, version=2)) == [(1, "y")]
    with pytest.raises(ValueError, match="expired"):
        history.as_of(kept, version=1)
    with pytest.raises(ValueError, match="expired"):
        history.as_of(kept, timestamp=1)


def test_restore_keeps_history_and_brings_back_the_state(spark):
    log = history.Log(spark.createDataFrame([(1, "x", "I", 1, 1), (2, "y", "I", 1, 1), (1, "q", "U", 2, 2), (2, "y", "D", 2, 2), (3, "w", "I", 2, 2)],
                                            "k INT, v STRING, op STRING, version INT, commit_ts INT"), ["k"], ["commit_ts"])
    after = history.restore(log, to=1, now=2, version=3, timestamp=3)
    assert after.count() == 8
    assert values(history.as_of(history.Log(after, ["k"], ["commit_ts"]), version=3)) == [(1, "x"), (2, "y")]


def test_type2_apply_closes_and_opens(spark):
    dim = spark.createDataFrame([(1, "IN", 1, None, True), (2, "US", 1, None, True)], "k INT, c STRING, valid_from INT, valid_to INT, is_current BOOLEAN")
    batch = spark.createDataFrame([(1, "DE", 5), (2, "US", 6), (3, "FR", 7)], "k INT, c STRING, at INT")
    assert sorted(map(str, scd.type2_apply(dim, batch, ["k"], ["c"], F.col("at")).collect())) == sorted(
        map(str, spark.createDataFrame([(1, "IN", 1, 5, False), (1, "DE", 5, None, True), (2, "US", 1, None, True), (3, "FR", 7, None, True)], dim.schema).collect()))
    stale = spark.createDataFrame([(1, "DE", 1)], "k INT, c STRING, at INT")
    assert scd.type2_apply(dim, stale, ["k"], ["c"], F.col("at")).count() == 2


# --- schemas, publishing, quality -------------------------------------------


def test_enforcement_names_what_is_wrong(spark):
    with pytest.raises(evolve.SchemaMismatch, match="extra column device"):
        evolve.enforce(spark.createDataFrame([(1, "x")], "id INT, device STRING"), T.StructType.fromDDL("id INT"))
    with pytest.raises(evolve.SchemaMismatch, match="column id is string"):
        evolve.enforce(spark.createDataFrame([("1",)], "id STRING"), T.StructType.fromDDL("id INT"))


def test_nested_fields_merge_and_can_be_dropped(spark):
    old = spark.createDataFrame([(1, ("Pune", "IN"))], "id INT, address STRUCT<city: STRING, country: STRING>")
    new = spark.createDataFrame([(2, ("Goa", 403))], "id INT, address STRUCT<city: STRING, zipcode: INT>")
    both = evolve.merge_schema(old, new)
    assert both.schema["address"].dataType.names == ["city", "country", "zipcode"]
    assert values(evolve.overwrite_schema(both, new.schema).select("id", "address.zipcode")) == [(1, None), (2, 403)]


def test_failing_check_leaves_the_published_table(spark, tmp_path):
    path = str(tmp_path / "pub")
    good, bad = spark.range(3), spark.createDataFrame([(1,), (1,)], "id BIGINT")
    checks = {"unique": lambda df: quality.unique(df, ["id"])}
    first = publish.write_audit_publish(good, checks, path, ["id"], "v1")
    assert (first.status, first.changes["added"]) == (publish.PUBLISHED, 3)
    assert publish.write_audit_publish(bad, checks, path, ["id"], "v2").status == publish.CHECK_FAILED
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["pub"]


def test_fail_rule_stops_the_job(spark):
    rules = [quality.Rule("positive", "id > 0", "fail")]
    with pytest.raises(Exception, match="expectation positive failed"):
        quality.expectations(spark.range(3), rules).collect()
    assert quality.expectations(spark.range(1, 3), rules).count() == 2


def test_empty_and_low_scores_are_refused(spark):
    with pytest.raises(quality.CheckFailed):
        quality.non_empty(spark.range(0))
    with pytest.raises(quality.CheckFailed):
        quality.min_score(spark.range(3), F.avg("id"), 5)


def test_null_is_not_in_any_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x STRING")
    assert values(rows.where_not_in(df, "x", ["a"])) == [("b",)]
    assert values(quality.accepted_values(df, "x", ["a"])) == [("b",)]


def test_missing_includes_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x DOUBLE")
    assert rows.require(df, ["x"]).count() == 1


# --- functions and plans ----------------------------------------------------


def test_buckets_are_contiguous(spark):
    df = spark.createDataFrame([(200.0,), (200.5,), (800.5,), (1000.0,), (1000.5,), (None,)], "ms DOUBLE")
    label = cols.bucket("ms", [(200, "fast"), (800, "moderate"), (1000, "slow")], "critical", "<=")
    assert [r[0] for r in df.select(label).collect()] == ["fast", "moderate", "slow", "slow", "critical", None]


def test_rounding_is_half_up_on_the_shortest_decimal(spark):
    df = spark.createDataFrame([(263531.06499999994,), (263531.065,), (2.675,), (-2.675,)], "x DOUBLE")
    assert [r[0] for r in df.select(exprs.stable_round("x", 2)).collect()] == [263531.06, 263531.07, 2.68, -2.68]


def test_url_parts(spark):
    df = spark.createDataFrame([(" HTTPS://Shop.Example.com/a/b// ",), ("http://localhost:80/",), ("",)], "url STRING")
    name, domain = exprs.url_parts(exprs.normalize_url("url"))
    got = [tuple(r) for r in df.select(exprs.normalize_url("url"), name, domain).collect()]
    assert got[0] == ("shop.example.com/a/b", "shop", "com")
    assert got[1][1:] == ("localhost", "localhost")
    assert got[2][1:] == ("unknown", "unknown")


def test_strict_time_parsing_raises(spark):
    df = spark.createDataFrame([("not-found",)], "t STRING")
    assert df.select(exprs.parse_ts("t", "yyyy-MM-dd HH:mm:ss")).first()[0] is None
    with pytest.raises(Exception, match="not-found|CANNOT_PARSE"):
        df.select(exprs.parse_ts("t", "yyyy-MM-dd HH:mm:ss", lenient=False)).collect()


def test_skew_report(spark):
    df = spark.createDataFrame([("HOT",)] * 90 + [(f"k{i}",) for i in range(10)], "key STRING")
    top = agg.skew_report(df, "key", 1).first()
    assert (top["key"], top["rows"], top["share"]) == ("HOT", 90, 0.9)
    assert {r["key"]: r["count"] for r in agg.salted_hot(df.withColumn("id", F.monotonically_increasing_id()), "key", ["HOT"], 8, ["id"]).collect()}["HOT"] == 90


def test_empty_table_starts_ids_at_one(spark):
    assert agg.max_id_next(spark.createDataFrame([], "id BIGINT"), "id").first()[0] == 1


def test_webchecks_row(spark):
    schema = "id BIGINT, url STRING, status_code INT, response_time_ms DOUBLE, status_message STRING, fix STRING, checked_at TIMESTAMP_NTZ"
    data = [(1, "https://A.com/", 999, 801.0, "x", " NONE ", datetime(2024, 1, 5, 13)), (2, None, 200, 1.0, "ok", "f", datetime(2024, 1, 5))]
    row = webchecks.transform(spark.createDataFrame(data, schema)).collect()
    assert len(row) == 1
    r = row[0]
    assert (r["status_message"], r["status_group"], r["performance_bucket"], r["fix"]) == ("Invalid", "invalid_error", "slow", "none")
    assert (r["is_error"], r["check_day_name"], r["website_name"], r["domain"]) == (True, "Friday", "a", "com")


def test_validation_prefers_a_complete_copy(spark):
    df = spark.createDataFrame([(1, 1, None, 50), (1, 2, "2024-01-01", 50), (2, 1, "31-12-9999", 50)], "broadcast_id INT, line_no INT, event_date STRING, duration_minutes INT")
    assert broadcasts.clean(df, ["line_no"]).count() == 0
    assert values(broadcasts.validate(df, ["line_no"]), "broadcast_id", "line_no") == [(1, 2)]


def test_ingest_moves_the_watermark(spark, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    first = spark.createDataFrame([("1", "2024-01-01 00:00:00"), ("2", "bad")], "order_id STRING, order_date STRING")
    assert shop.ingest(first, out, mark) == 2
    second = first.union(spark.createDataFrame([("3", "2024-01-02 00:00:00")], first.schema))
    assert shop.ingest(second, out, mark) == 1
    assert shop.ingest(second, out, mark) == 0
    assert shop.read_watermark(spark, mark) == datetime(2024, 1, 2)
