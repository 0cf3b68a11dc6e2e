"""Properties of the physical plans that decide whether a query holds at scale."""

import re

import pytest

from playmart.plans.queries import QUERIES as LIBRARY
from playmart import sinks
from playmart.operators import facts
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"
# The training-data operators have tests of their own.
QUERIES = LIBRARY


@pytest.fixture(autouse=True)
def long_plan_lines(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def scans(text):
    """Table name -> columns read, one entry per scan."""
    found = re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", text)
    return [(table, sorted(c.split("#")[0] for c in columns.split(",") if c)) for columns, table in found]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_operator_that_breaks_at_scale(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Window [", "CollectLimit"):
        assert bad not in text, f"{bad} in the plan of {name}"
    lines = text.splitlines()
    for k, line in enumerate(lines):
        if "Exchange" not in line or "Broadcast" in line:
            continue
        below = next((x for x in lines[k + 1 :] if "Project" not in x and "Filter" not in x), "")
        # One task is fine for what map tasks have reduced to a row or so each, nowhere else.
        if "Exchange SinglePartition" in line:
            assert "partial_" in below, line
        # No row is shuffled twice in a row, and none for its own sake.
        assert "Exchange hashpartitioning" not in below and "REPARTITION_BY" not in line, line


def test_page_filter_reaches_the_reader(spark):
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in plan(spark, "songplays_inner3")


def test_unused_look_ups_are_left_out(spark):
    assert scans(plan(spark, "dq_pk_duplicates")) == [("lineitem", ["l_linenumber", "l_linestatus", "l_orderkey"])]
    tables = [t for t, _ in scans(plan(spark, "users_latest"))]
    assert sorted(tables) == ["customer", "lineitem", "orders"]


def test_only_used_columns_are_read(spark):
    for table, columns in scans(plan(spark, "songs_played_semi")):
        if table == "lineitem":
            assert columns == ["l_linestatus", "l_partkey"]
        else:
            assert table == "part" and "p_type" not in columns


def test_key_look_up_reaches_the_reader(spark):
    assert "EqualTo(l_orderkey,102)" in plan(spark, "lookup_session_item")


def test_latest_profiles_read_the_log_once(spark):
    frame = QUERIES["users_max_join"](spark, SF_DIR)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"/lineitem\.parquet", final)) == 1


def test_plays_are_counted_before_the_dimension_is_joined(spark):
    """Below the last join of the report, plays are counts per artist."""
    text = plan(spark, "popular_artists")
    first_join = next(m.start() for m in re.finditer(r"Join \[artist_id#", text))
    assert "partial_count(1)" in text[first_join:]


def test_quality_report_scans(spark):
    """Plays are read once per check that needs other columns; no look-up is read that a check does not need."""
    tables = [t for t, _ in scans(plan(spark, "dq_results"))]
    assert tables.count("lineitem") == 3 and tables.count("orders") == 1 and tables.count("part") == 2


@pytest.fixture
def small_limits(spark):
    """Limits at which a few thousand rows behave like a large table."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_song_is_split(spark, small_limits, how):
    """A third of all plays is one song: its partition is read by several tasks."""
    plays = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hit' ELSE concat('song ', id % 500) END AS song", "'a' AS artist",
        "1.0D AS length", "id AS session_id", "cast(hash(id) AS string) AS user_agent", "id AS ts",
        "id AS user_id", "'free' AS level", "'x' AS location",
    )
    songs = spark.range(500).selectExpr(
        "CASE WHEN id = 0 THEN 'hit' ELSE concat('song ', id) END AS title", "'a' AS artist_name",
        "1.0D AS duration", "concat('S', id) AS song_id", "'A1' AS artist_id", "'y' AS artist_location",
    )
    fact = facts.make_songplays(plays, songs, how=how, columns=["song_id", "session_id", "user_agent", "ts"])
    rows = fact.collect()
    plan_text = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan_text
    assert sum(r.song_id == "S0" for r in rows) == 20_000
    unmatched = spark.range(60_000).where("id % 3 <> 0 AND id % 500 = 0").count()
    assert len(rows) == 60_000 - (unmatched if how == "inner" else 0)


def test_hot_month_becomes_several_files(spark, small_limits, tmp_path):
    rows = spark.range(0, 100_000, 1, 8).selectExpr(
        "id AS v", "CASE WHEN id % 10 = 0 THEN 10 ELSE 11 END AS month", "cast(hash(id) AS string) AS t"
    )
    sinks.replace_partitions(rows, str(tmp_path / "t"), ["month"], ["v"])
    files = list((tmp_path / "t" / "month=11").glob("*.parquet"))
    assert len(files) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100_000
