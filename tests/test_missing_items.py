"""Stored look-ups, rejects, delete chains, racing commits, Z-order."""

import glob
import json
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from playmart import sinks
from playmart.operators import dedupe
from playmart.schemas import USER_SESSION, ForeignKey, Table
from playmart.sources import staging


def rows_read(df):
    """Rows that the scan below a narrow query hands on: those of the row groups and pages it had to read."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_look_ups_read_few_row_groups(spark, tmp_path):
    plays = spark.range(0, 200_000, 1, 4).select(
        (F.col("id") % 1000).alias("user_id"), F.hash("id").cast("bigint").alias("session_id"),
        (F.col("id") % 7).alias("item_in_session"), *[F.lit("x").alias(c) for c in USER_SESSION.values],
    )
    path = str(tmp_path / "t")
    sinks.write_serving(plays, path, USER_SESSION, row_group_bytes=64 << 10)
    stored = sinks.read_serving(spark, path, plays.schema)
    wanted = plays.where("user_id = 77").first()
    groups = sum(pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{path}/*.parquet"))
    assert groups > 20
    by_key = stored.where((F.col("user_id") == 77) & (F.col("session_id") == wanted.session_id))
    assert by_key.count() == 1 and rows_read(by_key) < 200_000 / 20
    # The second key column alone: minima and maxima of all row groups fit, the Bloom filters do not.
    by_session = stored.where(F.col("session_id") == wanted.session_id)
    assert by_session.count() == 1 and rows_read(by_session) < 200_000 / 8


EVENT = Table("event", "id BIGINT, small TINYINT, price DECIMAL(5,2), at TIMESTAMP, name STRING", not_null=("id", "name"))
PATHS = ["$.id", "$.small", "$.price", "$.at", "$.name"]


def test_rejects_name_file_line_column_and_reason(spark, tmp_path):
    good = {"id": 1, "small": 2, "price": 1.25, "at": "2020-01-01 00:00:00", "name": "a"}
    lines = [
        json.dumps(good), json.dumps(good | {"small": 300}), "", "no json", json.dumps(good | {"price": "1e9", "at": "soon"}),
        json.dumps({"id": 5}), json.dumps(good | {"id": 7.5}), json.dumps(good | {"id": 8.0, "small": None}),
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    (tmp_path / "b.json").write_text("\n".join([json.dumps(good)] * 3000 + ["[1]"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        load = lambda most: staging.load_checked(spark, f"{tmp_path}/*.json", EVENT, PATHS, f"{tmp_path}/out", max_rejected=most)
        rows, rejects = load(6)
        assert rows.count() == 3002 and rows.schema == EVENT.schema
        found = {(r.file[-6:], r.line, r.column, r.value, r.reason) for r in rejects.collect()}
        with pytest.raises(staging.TooManyRejectsError, match="6 lines"):
            load(5)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {
        ("a.json", 2, "small", "300", "does not fit tinyint"),
        ("a.json", 4, None, "no json", "is no JSON object"),
        ("a.json", 5, "price", "1e9", "does not fit decimal(5,2)"),
        ("a.json", 5, "at", "soon", "does not fit timestamp"),
        ("a.json", 6, "name", None, "missing, but may not be null"),
        ("a.json", 7, "id", "7.5", "does not fit bigint"),
        ("b.json", 3001, None, "[1]", "is no JSON object"),
    }


def test_delete_chains(spark):
    """Two ways to a row, references to the own table, NULL references, and a ring."""
    part = Table("part", "id INT, whole INT", ("id",), (ForeignKey(("whole",), "part", ("id",)),))
    maker = Table("maker", "id INT", ("id",))
    sale = Table(
        "sale", "id INT, part INT, maker INT", ("id",),
        (ForeignKey(("part",), "part", ("id",)), ForeignKey(("maker",), "maker", ("id",))),
    )
    tables = {
        "part": spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)], part.columns),
        "maker": spark.createDataFrame([(1,), (2,)], maker.columns),
        "sale": spark.createDataFrame([(1, 4, 2), (2, 4, 1), (3, 6, 2), (4, None, None), (5, 6, 1)], sale.columns),
    }
    gone = dedupe.delete_chain(tables, [sale, part, maker], {"part": tables["part"].where("id = 1"), "maker": tables["maker"].where("id = 1")})
    ids = {name: sorted(r.id for r in rows.collect()) for name, rows in gone.items()}
    assert ids == {"part": [1, 2, 3, 4], "maker": [1], "sale": [1, 2, 5]}
    left = dedupe.after_deletes(tables, [sale, part, maker], gone)
    assert sorted(r.id for r in left["sale"].collect()) == [3, 4]
    assert dedupe.delete_chain(tables, [sale, part, maker], {}) == {}
    ring = [Table("a", "id INT, b INT", ("id",), (ForeignKey(("b",), "b", ("id",)),)),
            Table("b", "id INT, a INT", ("id",), (ForeignKey(("a",), "a", ("id",)),))]
    with pytest.raises(ValueError, match="ring"):
        dedupe.delete_chain({"a": tables["maker"], "b": tables["maker"]}, ring, {})


def race(spark, root, runs):
    """Publish several runs at once, all built on the same state; run -> sequence number or the error."""
    base, results = sinks.current(spark, root), {}
    ready = threading.Barrier(len(runs))

    def go(name, paths):
        ready.wait()
        try:
            results[name] = sinks.publish(spark, root, name, paths, base)
        except sinks.StaleRunError as error:
            results[name] = error

    threads = [threading.Thread(target=go, args=one) for one in runs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return results


def test_of_racing_runs_one_wins(spark, tmp_path):
    root = str(tmp_path)
    results = race(spark, root, {f"r{k}": {("a", "m1"): f"p{k}", ("b", "m1"): f"q{k}"} for k in range(4)})
    won = [name for name, got in results.items() if got == 1]
    assert len(won) == 1 and sum(isinstance(got, sinks.StaleRunError) for got in results.values()) == 3
    k = won[0][1]
    assert sinks.current(spark, root).paths == {("a", "m1"): f"p{k}", ("b", "m1"): f"q{k}"}
    assert not [f for f in (tmp_path / "publications").iterdir() if f.name.startswith("_")]


def test_racing_runs_of_other_periods_all_win(spark, tmp_path):
    root = str(tmp_path)
    results = race(spark, root, {f"r{k}": {("a", f"m{k}"): f"p{k}"} for k in range(4)})
    assert sorted(results.values()) == [1, 2, 3, 4]
    assert sinks.current(spark, root) == sinks.Current(4, {("a", f"m{k}"): f"p{k}" for k in range(4)})
    base = sinks.Current(3, {})
    with pytest.raises(sinks.StaleRunError):  # the table it has read has changed
        sinks.publish(spark, root, "late", {("c", "m9"): "p9"}, base, reads=["a"])
    with pytest.raises(sinks.StaleRunError):  # the whole of a table against a period of it
        sinks.publish(spark, root, "late", {("a", sinks.WHOLE): "p9"}, base)
    assert sinks.publish(spark, root, "late", {("c", "m9"): "p9"}, base, reads=["b"]) == 5


def files_with(path, low, high):
    """Files whose statistics leave room for low <= x < high and low <= y < high."""
    hit = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        room = True
        for column in (0, 1):
            stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
            room &= min(s.min for s in stats) < high and max(s.max for s in stats) >= low
        hit += room
    return hit


def test_z_order_leaves_files_out_for_two_columns(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 4).select(
        F.pmod(F.hash("id"), F.lit(1000)).alias("x"), F.pmod(F.hash("id", F.lit(1)), F.lit(1000)).alias("y"), "id"
    )
    rows.repartitionByRange(32, "x", "y").sortWithinPartitions("x", "y").write.parquet(f"{tmp_path}/plain")
    sinks.write_z_ordered(rows, f"{tmp_path}/z", ["x", "y"], 32)
    assert spark.read.parquet(f"{tmp_path}/z").exceptAll(rows).isEmpty()
    y_only = [sum(min(s.min for s in [pq.ParquetFile(f).metadata.row_group(0).column(1).statistics]) < 100 for f in glob.glob(f"{tmp_path}/{t}/*.parquet")) for t in ("plain", "z")]
    assert y_only[0] == 32 and y_only[1] <= 12
    assert files_with(f"{tmp_path}/z", 100, 200) <= 4
    hot = rows.withColumn("x", F.lit(5)).withColumn("y", F.when(F.col("id") % 9 > 0, F.col("y")))
    sinks.write_z_ordered(hot, f"{tmp_path}/hot", ["x", "y"], 8)
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 40_000 and len(glob.glob(f"{tmp_path}/hot/*.parquet")) == 8
