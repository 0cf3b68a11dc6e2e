import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from playmart import schemas, sinks
from playmart.operators import serving


def _times(spark, n, start="2018-11-01"):
    ts = F.expr(f"TIMESTAMP_NTZ '{start} 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 720 AS INT), 0, 0)")
    t = spark.range(n).select(ts.alias("start_time")).distinct()
    return t.selectExpr(
        "start_time", "hour(start_time) hour", "day(start_time) day", "dayofyear(start_time) day_of_year",
        "weekofyear(start_time) week", "month(start_time) month", "year(start_time) year",
        "dayofweek(start_time) weekday",
    )


def test_overwrite_partitioned_and_sorted(spark, tmp_path):
    path = str(tmp_path / "times")
    sinks.write_table(_times(spark, 720), path, schemas.TIMES)
    sinks.write_table(_times(spark, 100), path, schemas.TIMES)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/*/*")) == ["month=11"]
    back = sinks.read_table(spark, path, schemas.TIMES)
    assert back.columns == schemas.TIMES.column_names and back.count() == 100
    for name in glob.glob(f"{path}/*/*/*.parquet"):
        values = pq.read_table(name, partitioning=None).column("start_time").to_pylist()
        assert values == sorted(values)


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="missing columns"):
        sinks.write_table(_times(spark, 10).drop("week"), str(tmp_path / "t"), schemas.TIMES)


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "staged")
    first = spark.createDataFrame([(1, "2018-10"), (2, "2018-11")], "v INT, period STRING")
    sinks.replace_partitions(first, path, ["period"])
    sinks.replace_partitions(spark.createDataFrame([(3, "2018-11")], "v INT, period STRING"), path, ["period"])
    assert sorted(map(tuple, spark.read.parquet(path).select("v", "period").collect())) == [(1, "2018-10"), (3, "2018-11")]


def test_append_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "users")
    one = spark.createDataFrame([(1, "Ann", "Lee", "F", "free")], schemas.USERS.columns)
    two = spark.createDataFrame([(1, "Ann", "Lee", "F", "paid"), (2, "Ben", "Lee", "M", "free")], schemas.USERS.columns)
    for df in (one, two, two):
        sinks.append_absent(spark, df, path, schemas.USERS)
    got = sorted(map(tuple, sinks.read_table(spark, path, schemas.USERS).collect()))
    assert got == [(1, "Ann", "Lee", "F", "free"), (2, "Ben", "Lee", "M", "free")]


def test_serving_layout_spreads_a_hot_partition_key(spark, tmp_path):
    """Nine tenths of the rows in one session: still several files, each with a narrow key range."""
    plays = spark.range(20_000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN id ELSE 7 END AS session_id", "id AS item_in_session", "'a' AS artist",
        "'s' AS song", "1.0D AS length", "id AS ts",
    )
    path = str(tmp_path / "items")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_serving(serving.build_serving(plays, schemas.SESSION_ITEMS, ["ts"]), path, schemas.SESSION_ITEMS)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 20_000 and len(sizes) == 4 and max(sizes) < 10_000
    hit = serving.session_item(spark.read.parquet(path), 7, 11)
    assert hit.count() == 1
    assert "PushedFilters: [IsNotNull(session_id), IsNotNull(item_in_session), EqualTo(session_id,7)" in hit._jdf.queryExecution().executedPlan().toString()


def test_csv_export_has_headers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "id INT, v STRING")
    sinks.write_csv(df.repartition(2), str(tmp_path / "out"))
    parts = glob.glob(f"{tmp_path}/out/*.csv")
    assert parts and all(open(p).readline().strip() == "id,v" for p in parts)


def test_create_and_drop_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    tables = [schemas.SONGPLAYS, schemas.SONGS, schemas.ARTISTS, schemas.USERS, schemas.TIMES, schemas.STAGING_EVENTS]
    sinks.create_tables(spark, tables, "mart", str(tmp_path))
    sinks.create_tables(spark, tables, "mart", str(tmp_path))
    names = {t.name for t in spark.catalog.listTables("mart") if not t.isTemporary}
    assert names == {t.name for t in tables}
    assert spark.table("mart.songplays").columns[-2:] == ["year", "month"]
    sinks.drop_tables(spark, tables, "mart")
    sinks.drop_tables(spark, tables, "mart")
    assert not [t for t in spark.catalog.listTables("mart") if not t.isTemporary]
    spark.sql("DROP DATABASE mart")


def test_bucketed_tables_join_without_a_shuffle(spark):
    users = spark.range(1000).selectExpr("id AS user_id", "'x' AS level")
    plays = spark.range(5000).selectExpr("id % 1000 AS user_id", "id AS play")
    sinks.save_bucketed(users, "b_users", 4, "user_id", ["user_id"])
    sinks.save_bucketed(plays, "b_plays", 4, "user_id", ["user_id"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_plays").join(spark.table("b_users"), "user_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE b_users")
        spark.sql("DROP TABLE b_plays")


def test_frequent_keys_are_reported(spark):
    hot = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS user_id")
    first, second = sinks.key_shares(hot, "user_id", 2).collect()
    assert (first.user_id, first.row_count) == (7, 1001) and abs(first.share - 1001 / 3000) < 1e-9
    assert second.row_count == 1
    assert sinks.key_shares(hot.limit(0), "user_id").count() == 0


def test_publication_switches_all_tables_at_once(spark, tmp_path):
    root = str(tmp_path)
    first = sinks.current(spark, root)
    assert first == sinks.Current(0, {})
    sinks.publish(spark, root, "r1", {("a", "m1"): "p1", ("b", sinks.WHOLE): "p1b"}, first)
    second = sinks.current(spark, root)
    sinks.publish(spark, root, "r2", {("a", "m2"): "p2", ("a", "m1"): "p3"}, second)
    now = sinks.current(spark, root)
    assert now.paths == {("a", "m1"): "p3", ("a", "m2"): "p2", ("b", sinks.WHOLE): "p1b"}
    assert now.of("a") == ["p3", "p2"] and now.of("a", ["m1"]) == ["p2"]
    sinks.publish(spark, root, "r3", {("a", sinks.WHOLE): "p4"}, now)
    assert sinks.current(spark, root).of("a") == ["p4"]


def test_a_run_built_on_old_tables_is_refused(spark, tmp_path):
    root = str(tmp_path)
    base = sinks.current(spark, root)
    sinks.publish(spark, root, "r1", {("a", sinks.WHOLE): "p1"}, base)
    with pytest.raises(sinks.StaleRunError):
        sinks.publish(spark, root, "r2", {("a", sinks.WHOLE): "p2"}, base)
    assert sinks.current(spark, root).of("a") == ["p1"]
