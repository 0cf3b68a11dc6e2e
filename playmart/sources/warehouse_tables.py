"""The raw feeds as views over an order-processing warehouse.

play_log plays the app log: one row per line item, attributes looked up from orders, customers, nations
and parts. song_catalog plays the song feed: one row per part. Both cover their whole tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that order two writes of one key, after everything else is equal.
WRITE_ORDER = ["w1", "w2", "w3"]

ARTIST_NUMBER = "CAST(p_partkey div 64 AS STRING)"
LENGTH = "CAST(floor(p_retailprice * 2) AS DOUBLE) / 2"

_USER_AGENT = """concat('Mozilla/5.0 (',
    CASE l_returnflag WHEN 'A' THEN 'Macintosh; Intel Mac OS X 10_9_4'
                      WHEN 'N' THEN 'Windows NT 6.1; WOW64' ELSE 'X11; Linux x86_64' END,
    ') AppleWebKit/537.36')"""

_PLAY = "l_linestatus = 'F'"

# Epoch ms of a time without zone; the session zone has no part in it.
MILLIS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {})"

# log column -> (expression, table that has to be looked up for it)
_LOG: dict[str, tuple[str, str]] = {
    "artist": (f"CASE WHEN {_PLAY} THEN concat('Artist ', {ARTIST_NUMBER}) END", "part"),
    "auth": (f"CASE WHEN {_PLAY} OR o_orderstatus <> 'P' THEN 'Logged In' ELSE 'Logged Out' END", "orders"),
    "firstName": ("split_part(c_name, '#', 1)", "customer"),
    "gender": ("c_mktsegment", "customer"),
    "itemInSession": ("CAST(l_linenumber AS BIGINT)", ""),
    "lastName": ("split_part(c_name, '#', 2)", "customer"),
    "length": (f"CASE WHEN {_PLAY} THEN {LENGTH} END", "part"),
    "level": ("o_orderpriority", "orders"),
    "location": ("n_name", "nation"),
    "method": (f"CASE WHEN {_PLAY} THEN 'PUT' ELSE 'GET' END", ""),
    "page": (f"CASE WHEN {_PLAY} THEN 'NextSong' ELSE 'Home' END", ""),
    "sessionId": ("l_orderkey", ""),
    "song": (f"CASE WHEN {_PLAY} THEN p_name END", "part"),
    "ts": (f"{MILLIS.format('o_orderdate')} + (l_linenumber div 2) * 20014123L", "orders"),
    "userAgent": (_USER_AGENT, ""),
    "userId": (
        f"CASE WHEN {_PLAY} OR o_orderstatus <> 'P' THEN CAST(o_custkey AS STRING) ELSE '' END",
        "orders",
    ),
    "w1": ("l_partkey", ""),
    "w2": ("l_suppkey", ""),
    "w3": ("l_extendedprice", ""),
}

LOG_COLUMNS = list(_LOG)

_UNPLAYED = "p_size > 40 OR (p_partkey div 64) % 7 = 3"

# Stored columns of the tables used here; with a given schema no footer has to be read to plan a query.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def play_log(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, plays_only: bool = False
) -> DataFrame:
    """The app log, cut to the wanted columns.

    plays_only=True puts the page filter in terms of the stored column, where the Parquet reader can use
    it; the page conditions in the columns then fold away. Every look-up is a left join on a unique key
    and so never changes the row count: a look-up none of whose columns are wanted is left out, which
    saves its shuffle. Order attributes are collected on the smaller orders side before the line items
    are shuffled.
    """
    wanted = list(columns) if columns is not None else LOG_COLUMNS
    needed = {_LOG[c][1] for c in wanted}

    log = load(spark, sf_dir, "lineitem")
    if plays_only:
        log = log.where(_PLAY)
    if needed & {"orders", "customer", "nation"}:
        orders = load(spark, sf_dir, "orders")
        if needed & {"customer", "nation"}:
            customer = load(spark, sf_dir, "customer")
            if "nation" in needed:
                nation = load(spark, sf_dir, "nation")
                customer = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        log = log.join(orders, log.l_orderkey == orders.o_orderkey, "left")
    if "part" in needed:
        part = load(spark, sf_dir, "part")
        log = log.join(part, log.l_partkey == part.p_partkey, "left")
    texts = {c: _LOG[c][0].replace(_PLAY, "true") if plays_only else _LOG[c][0] for c in wanted}
    return log.select(*[F.expr(sql).alias(c) for c, sql in texts.items()])


def song_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song feed. Titles of a fifth of the songs, and all titles of a seventh of the artists, carry a suffix
    that no play has; artists repeat with differing data."""
    return load(spark, sf_dir, "part").select(
        F.expr(f"concat('AR', {ARTIST_NUMBER})").alias("artist_id"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        F.expr("CASE p_type WHEN 'SMALL' THEN '' WHEN 'ECONOMY' THEN NULL ELSE p_type END").alias(
            "artist_location"
        ),
        F.expr("CAST(-p_size AS DOUBLE)").alias("artist_longitude"),
        F.expr(f"concat('Artist ', {ARTIST_NUMBER})").alias("artist_name"),
        F.expr(LENGTH).alias("duration"),
        F.lit(1).cast("bigint").alias("num_songs"),
        F.expr("concat('SO', CAST(p_partkey AS STRING))").alias("song_id"),
        F.expr(f"CASE WHEN {_UNPLAYED} THEN concat(p_name, ' (Demo)') ELSE p_name END").alias("title"),
        F.expr("CAST(1970 + p_size AS BIGINT)").alias("year"),
    )


def event_millis(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The event stream with its time as epoch ms, for time-of-day work."""
    return load(spark, sf_dir, "events").select("event_id", F.expr(MILLIS.format("ts")).alias("ts"), *extra)

