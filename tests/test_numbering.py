"""Gapless numbers and frames side by side."""

import pytest
from pyspark.sql import functions as F

from playmart.operators.numbering import continued, numbered, side_by_side


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_numbers_have_no_gaps(spark, many_ranges):
    rows = spark.range(0, 5000, 1, 5).select(((F.col("id") * 7919) % 5000).alias("v"), F.lit("x").alias("place"))
    out = numbered(rows, ["v"]).collect()
    assert sorted((r.number, r.v) for r in out) == [(v + 1, v) for v in range(5000)]
    assert {r.place for r in out} == {"x"}  # a name that is used inside


def test_numbers_within_groups(spark, many_ranges):
    """A group that holds most rows, a NULL group, NULLs in the order."""
    group = F.expr("CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 > 7 THEN string(id % 3) END")
    value = F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.hash("id"))
    rows = spark.range(0, 3000, 1, 4).select(group.alias("g"), value.alias("v"), "id")
    found = {}
    for r in numbered(rows, ["v", "id"], within=["g"], start=0).collect():
        found.setdefault(r.g, []).append((r.number, r.v, r.id))
    plain = {}
    for r in rows.collect():
        plain.setdefault(r.g, []).append(((r.v is not None, r.v or 0), r.id))
    assert set(found) == set(plain)
    for g, members in found.items():
        assert [(n, i) for n, _, i in sorted(members)] == [(n, i) for n, (_, i) in enumerate(sorted(plain[g]))]


def test_numbers_go_on_from_the_stored_ones(spark):
    empty = spark.createDataFrame([], "v int, id bigint")
    assert continued(empty, empty, ["v"], "id").count() == 0
    first = continued(spark.createDataFrame([(5,), (3,)], "v int"), empty, ["v"], "id")
    assert {(r.v, r.id) for r in first.collect()} == {(3, 1), (5, 2)}
    second = continued(spark.createDataFrame([(1,), (2,)], "v int"), first, ["v"], "id")
    assert {(r.v, r.id) for r in second.collect()} == {(1, 3), (2, 4)}


def test_frames_of_unequal_length_side_by_side(spark, many_ranges):
    left = spark.range(0, 100, 1, 3).select(F.col("id").alias("a"))
    right = spark.range(0, 130, 1, 8).select((-F.col("id")).alias("b"))
    rows = sorted(side_by_side(left, right, ["a"], ["b"]).collect())
    assert [(r.position, r.a, r.b) for r in rows] == [(n, n if n < 100 else None, n - 129) for n in range(130)]
    assert side_by_side(left, right.limit(0), ["a"], ["b"]).where("b IS NULL").count() == 100
    with pytest.raises(ValueError):
        side_by_side(left, left, ["a"], ["a"])
