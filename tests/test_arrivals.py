"""Newly arrived files, types found in the data, checks counted by the write."""

import json

import pytest
from pyspark.sql import Observation

from playmart import schemas, sinks
from playmart.operators import quality
from playmart.plans import etl
from playmart.schemas import Table
from playmart.sources import inferred
from playmart.streaming import arrivals
from tests.feeds import write_feeds, write_lines

VISIT = Table("visits", "id BIGINT, page STRING", ("id",), not_null=("id",))


def ids(spark, root):
    return sorted(r.id for r in arrivals.arrived(spark, root, VISIT).collect())


def test_each_arrived_file_is_loaded_once(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    go = lambda **how: arrivals.pick_up(spark, str(inbox), root, VISIT, **how)
    write_lines(inbox / "a.json", [{"id": 1, "page": "x"}, {"id": 2}])
    go()
    assert ids(spark, root) == [1, 2]
    write_lines(inbox / "b.json", [{"id": 3}])
    write_lines(inbox / "c.json", [{"id": 4}])
    write_lines(inbox / "d.json", [])
    go(max_files=1)
    assert ids(spark, root) == [1, 2, 3, 4]
    write_lines(inbox / "a.json", [{"id": 1, "page": "x"}, {"id": 2}])  # delivered again
    go()
    go()
    assert ids(spark, root) == [1, 2, 3, 4]
    # Without the checkpoint all files are offered again, and none is loaded.
    go(checkpoint=str(tmp_path / "new"))
    assert ids(spark, root) == [1, 2, 3, 4]
    files = arrivals.arrived_files(spark, root, VISIT).collect()
    assert sorted((r.file[-6:], r.row_count) for r in files) == [("a.json", 2), ("b.json", 1), ("c.json", 1)]


def test_a_batch_that_fails_before_its_commit_is_loaded_whole(spark, tmp_path, monkeypatch):
    inbox, root = tmp_path / "in", str(tmp_path / "out")
    write_lines(inbox / "a.json", [{"id": 1}])
    publish = sinks.publish

    def broken(*args, **how):
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "publish", broken)
    with pytest.raises(Exception, match="lost"):
        arrivals.pick_up(spark, str(inbox), root, VISIT)
    assert ids(spark, root) == []
    write_lines(inbox / "b.json", [{"id": 2}])

    def late(*args, **how):  # commits, then fails before the stream notes it
        publish(*args, **how)
        raise RuntimeError("late")

    monkeypatch.setattr(sinks, "publish", late)
    with pytest.raises(Exception, match="late"):
        arrivals.pick_up(spark, str(inbox), root, VISIT)
    assert ids(spark, root) == [1]
    monkeypatch.setattr(sinks, "publish", publish)
    arrivals.pick_up(spark, str(inbox), root, VISIT)
    assert ids(spark, root) == [1, 2]


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    write_lines(tmp_path / "in" / "h1" / "part.json", [{"id": 1}])
    write_lines(tmp_path / "in" / "h2" / "part.json", [{"id": 2}])
    for by_name, found in ((False, 2), (True, 1)):
        root = str(tmp_path / f"out-{by_name}")
        arrivals.pick_up(spark, str(tmp_path / "in"), root, VISIT, recursive=True, by_name=by_name)
        assert len(ids(spark, root)) == found
    with pytest.raises(ValueError, match="file"):
        arrivals.pick_up(spark, str(tmp_path), str(tmp_path / "o"), Table("t", "file STRING"))


LINES = [
    {"id": 1, "price": 2, "tags": ["a"], "at": {"x": 1}, "odd name": True, "none": None},
    {"id": 2, "price": 2.5, "tags": [], "at": {"y": "b"}, "mixed": 1},
    {"id": 3, "mixed": {"z": 1}},
]


def test_types_are_found_in_all_lines(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", LINES, "no json", "[1]", "", "7")
    rows = inferred.read_json_inferred(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    assert kinds == {
        "_corrupt_record": "string", "id": "bigint", "price": "decimal(20,1)" if "20" in kinds["price"] else kinds["price"],
        "tags": "array<string>", "at": "struct<x:bigint,y:string>", "odd name": "boolean", "none": "string", "mixed": "variant",
    }
    got = {r.id: r for r in rows.where("_corrupt_record IS NULL").collect()}
    assert [float(got[k].price) for k in (1, 2)] == [2.0, 2.5] and got[3].price is None
    assert got[1].at.x == 1 and got[2].at.y == "b" and got[1]["odd name"] is True and got[1].none is None
    assert json.loads(got[3].mixed.toJson()) == {"z": 1}
    assert sorted(r[0] for r in rows.where("_corrupt_record IS NOT NULL").collect()) == ["7", "[1]", "no json"]
    empty = inferred.read_json_inferred(spark, write_lines(tmp_path / "b.json", []))
    assert empty.columns == ["_corrupt_record"] and empty.isEmpty()


def test_drifting_fields(spark):
    lines = spark.createDataFrame([(json.dumps(x), i % 2) for i, x in enumerate(LINES)] + [("no json", 0), (None, 1)], "line STRING, half INT")
    types = inferred.field_types(inferred.parsed(lines, "line"), "parsed", ["half"])
    found = {(r.half, r.path, r.type): r.row_count for r in types.collect()}
    assert found[0, "$.id", "BIGINT"] == 2 and found[1, "$.id", "BIGINT"] == 1
    assert found[0, "$.tags[]", "STRING"] == 1 and found[0, "$.at.x", "BIGINT"] == 1 and found[0, "$.none", "VOID"] == 1
    drift = {r.path: (r.types, r.row_count) for r in inferred.drifting(types).collect()}
    assert drift["$.mixed"] == ("BIGINT, OBJECT", 2) and drift["$.price"][1] == 2 and set(drift) == {"$.mixed", "$.price"}
    with pytest.raises(ValueError, match="kept"):
        inferred.typed_fields(inferred.parsed(lines.withColumnRenamed("half", "ID"), "line"), "parsed", ["ID"])


def test_writes_count_what_the_checks_would_read(spark, tmp_path):
    table = Table("t", "id BIGINT, name STRING, month INT", ("id",), not_null=("id", "name"), partition_by=("month",))
    rows = spark.createDataFrame([(1, "a", 1), (None, "b", 1), (3, None, 2), (3, None, None)], table.columns)
    for name, df in (("some", rows), ("none", rows.where("id > 5"))):
        observation = Observation()
        sinks.write_table(df, f"{tmp_path}/{name}", table, observation=observation)
        counted = quality.observed_counts(observation, table.not_null)
        if name == "some":
            assert counted == (4, {"id": 1, "name": 2})
        assert counted in (None, (0, {"id": 0, "name": 0}), (4, {"id": 1, "name": 2}))
    read = quality.constraint_checks({"t": rows}, [table])
    known = quality.constraint_checks({"t": rows}, [table], {"t": {"id": 1, "name": 2}})
    assert sorted(read.collect()) == sorted(known.collect())


def test_loads_check_by_what_was_written(spark, tmp_path):
    logs, songs = write_feeds(tmp_path)
    load = lambda dialect: etl.run(spark, f"{logs}/*/*/*.json", f"{songs}/*/*/*.json", str(tmp_path / "mart"), dialect, max_corrupt=1)
    done = load(etl.LAKE)
    assert {n: done.rows[n, sinks.WHOLE] for n in ("songplays", "songs")} == {
        n: spark.read.parquet(done.path(n)).count() for n in ("songplays", "songs")
    }
