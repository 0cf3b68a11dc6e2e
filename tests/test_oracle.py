"""Every registered query against its SQL twin, and the row counts that guard against empty results."""

import os

import pytest

import __spark_entry__ as spark_entry
from playmart.plans.queries import QUERIES as LIBRARY
from tests.compare import assert_same, connect
from tests.conftest import TESTDATA

SF_DIR = os.environ.get("TEST_SF_DIR", f"{TESTDATA}/sf0.01")
# Queries of the optional subpackage have tests of their own.
QUERIES = {n: f for n, f in spark_entry.queries().items() if n in LIBRARY}
ORACLE = {n: q for n, q in spark_entry.oracle_sql().items() if n in LIBRARY}

# Queries whose result has an order.
ORDERED = ["popular_artists", "popular_songs", "top3_locations", "plays_by_hour", "plays_by_weekday"]


@pytest.fixture(scope="module")
def sql():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    result = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(result) > 0
    assert_same(result, sql.execute(ORACLE[name]).df())


@pytest.mark.parametrize("name", ORDERED)
def test_order_equals_sql(spark, sql, name):
    result, twin = QUERIES[name](spark, SF_DIR).toPandas(), sql.execute(ORACLE[name]).df()
    assert result.values.tolist() == twin[result.columns].values.tolist()


def test_filters_of_queries_matter(spark):
    """Semi joins leave something out, and a key with NULLs is compared too."""
    counts = {n: QUERIES[n](spark, SF_DIR).count() for n in ("artists_distinct", "artists_played_distinct")}
    assert 0 < counts["artists_played_distinct"] < counts["artists_distinct"]
    counts = {n: QUERIES[n](spark, SF_DIR).count() for n in ("songs_all", "songs_played", "songs_played_semi")}
    assert 0 < counts["songs_played_semi"] <= counts["songs_played"] < counts["songs_all"]
    assert QUERIES["clean_log"](spark, SF_DIR).count() < QUERIES["songplay_stable_key"](spark, SF_DIR).count()


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
