"""Every operator as a query over the warehouse tables: name -> callable(spark, directory).

Each query asks the log view only for the columns it uses, which leaves out the look-ups it does not need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart import sinks
from playmart.functions import keys, text, times
from playmart.operators import dedupe, dims, facts, numbering, quality, reports, serving
from playmart.schemas import (
    CONSOLIDATED_COLUMNS,
    SESSION_ITEMS,
    SONG_LISTENERS,
    USER_SESSION,
    WAREHOUSE,
    ServingTable,
    Table,
)
from playmart.shared import shared_folder
from playmart.sources import inferred
from playmart.sources.feeds import consolidate_events
from playmart.sources.staging import checked_fields, extract_json_paths
from playmart.sources.warehouse_tables import (
    LOG_COLUMNS,
    MILLIS,
    WRITE_ORDER,
    event_millis,
    load,
    play_log,
    song_catalog,
)
from playmart.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]

# Keys the look-ups ask for.
LOOKUP_SESSION = 102
LOOKUP_ITEM = 6
LOOKUP_SONG = "hot bolt"

# Rows from this day on arrive as the second batch of a repeated load.
DELETED_REGION = "ASIA"
INSERT_CUT = "1995-07-01"
UPSERT_CUT = "1998-04-15"

_RAW_NAME = {clean: raw for raw, clean in facts.RENAMES.items()}
_PROFILE = dims.PROFILE
_WRITTEN: set[str] = set()  # serving tables that this process has stored


def _raw(names: tuple[str, ...]) -> list[str]:
    wanted = ["ts" if n == "start_time" else _RAW_NAME.get(n, n) for n in names]
    return list(dict.fromkeys(wanted))


def _log(spark: SparkSession, d: str, *names: str) -> DataFrame:
    """All pages, cleaned names."""
    return facts.rename_log(play_log(spark, d, _raw(names)))


def _plays(spark: SparkSession, d: str, *names: str, grain: str = "second") -> DataFrame:
    raw = play_log(spark, d, dict.fromkeys(["page", *_raw(names)]), plays_only=True)
    return facts.clean_log(raw, grain).drop("page")


_MATCH3 = ("song", "artist", "length")
_MATCH2 = ("song", "artist")
_FACT_FROM_LOG = ("start_time", "user_id", "level", "session_id", "location", "user_agent")


def _unique_catalog(spark: SparkSession, d: str) -> DataFrame:
    catalog = song_catalog(spark, d)
    return facts.songs_with_artist(dims.make_songs_unique(catalog), dims.make_artists(catalog))


def _lake_fact(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The 3-key fact cut to some columns."""
    from_log = [c for c in columns if c not in ("song_id", "artist_id")]
    plays = _plays(spark, d, *_MATCH3, *from_log)
    return facts.make_songplays(plays, _unique_catalog(spark, d), columns=columns)


def _artist_place_fact(spark: SparkSession, d: str, *columns: str, only: tuple[str, ...] = ()) -> DataFrame:
    """The distinct 2-key fact that carries the artist's location, whole or made of some columns.

    `only` cuts the whole fact to some columns and keeps all its rows.
    """
    columns = columns or tuple(facts.FACT_COLUMNS)
    from_log = [c for c in columns if c not in ("song_id", "artist_id", "location")]
    return facts.make_songplays(
        _plays(spark, d, *_MATCH2, *from_log, grain="milli"),
        song_catalog(spark, d),
        keys=facts.TITLE_ARTIST,
        distinct=True,
        location_from="artist",
        columns=columns,
        only=only,
    )


def _played_catalog(spark: SparkSession, d: str) -> DataFrame:
    return dims.played_songs(song_catalog(spark, d), _plays(spark, d, *_MATCH3))


def _event_plays(spark: SparkSession, d: str) -> DataFrame:
    return event_millis(spark, d).withColumn("start_time", times.timestamp_from_seconds("ts"))


# Facts ----------------------------------------------------------------------------------------------


def songplays_inner3(spark: SparkSession, d: str) -> DataFrame:
    return facts.with_calendar(_lake_fact(spark, d, *facts.FACT_COLUMNS))


def songplays_inner2_distinct(spark: SparkSession, d: str) -> DataFrame:
    return _artist_place_fact(spark, d)


def songplays_left3(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, *_MATCH3, *_FACT_FROM_LOG)
    return facts.make_songplays(plays, song_catalog(spark, d), how="left")


def songplays_right2(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, *_MATCH2, *_FACT_FROM_LOG)
    return facts.make_songplays(plays, _unique_catalog(spark, d), keys=facts.TITLE_ARTIST, how="left")


def songplays_left_rounded(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, *_MATCH3, *_FACT_FROM_LOG)
    return facts.make_songplays(plays, song_catalog(spark, d), how="left", rounded=True)


def lookup_enrich_first(spark: SparkSession, d: str) -> DataFrame:
    return facts.enrich_first(_plays(spark, d, *_MATCH3, *_FACT_FROM_LOG), song_catalog(spark, d))


def songplay_md5_key(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, "session_id", "item_in_session", "start_time")
    key = keys.session_second_key("session_id", "start_time").alias("songplay_id")
    return plays.select(key, "session_id", "item_in_session", "start_time")


def songplay_stable_key(spark: SparkSession, d: str) -> DataFrame:
    """Of all log rows: those of logged-out users have a NULL in the key."""
    natural = ["session_id", "item_in_session", "ts", "user_id", "w1", "w2"]
    log = _log(spark, d, *natural)
    return facts.with_stable_key(log, *natural).select("songplay_id", "session_id", "item_in_session", "ts")


# Dimensions -----------------------------------------------------------------------------------------


def clean_log(spark: SparkSession, d: str) -> DataFrame:
    columns = [c for c in LOG_COLUMNS if c not in WRITE_ORDER]
    return facts.clean_log(play_log(spark, d, columns, plays_only=True))


def plays_with_artist(spark: SparkSession, d: str) -> DataFrame:
    log = play_log(spark, d, CONSOLIDATED_COLUMNS)
    return consolidate_events(log.withColumn("userId", text.to_bigint(F.col("userId"))))


def songs_all(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_songs(song_catalog(spark, d))


def songs_played_semi(spark: SparkSession, d: str) -> DataFrame:
    return _played_catalog(spark, d).select(*dims.SONG_COLUMNS)


def songs_played(spark: SparkSession, d: str) -> DataFrame:
    songs = dims.make_songs(song_catalog(spark, d))
    return dims.in_fact(songs, _artist_place_fact(spark, d, "song_id", "artist_id"), ["song_id", "artist_id"])


def songs_with_artist(spark: SparkSession, d: str) -> DataFrame:
    return _unique_catalog(spark, d)


def artists_played(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_artists(_played_catalog(spark, d))


def artists_distinct(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_artists_distinct(song_catalog(spark, d))


def artists_played_distinct(spark: SparkSession, d: str) -> DataFrame:
    artists = dims.make_artists_distinct(song_catalog(spark, d))
    return dims.in_fact(artists, _artist_place_fact(spark, d, "artist_id"), ["artist_id"])


def users_latest(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_users(_plays(spark, d, "user_id", *_PROFILE, "ts"), "latest")


def users_latest_max_window(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_users(_plays(spark, d, "user_id", *_PROFILE, "ts"), "at_last")


def users_max_join(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_users(_log(spark, d, "user_id", *_PROFILE, "ts"), "at_last")


def users_distinct(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_users(_plays(spark, d, "user_id", *_PROFILE), "distinct")


def users_history(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, "user_id", *_PROFILE, "ts", *WRITE_ORDER)
    return dims.make_users(plays, "history", WRITE_ORDER)


def time_dim(spark: SparkSession, d: str) -> DataFrame:
    dim = dims.make_times(_event_plays(spark, d)).withColumnRenamed("weekday", "weekday_sun1")
    return dim.withColumns(
        {
            "weekday_sun0": times.weekday("start_time", "sunday0"),
            "weekday_mon0": times.weekday("start_time", "monday0"),
        }
    )


def time_dim_epoch(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_times_epoch(_event_plays(spark, d))


def time_dim_text(spark: SparkSession, d: str) -> DataFrame:
    return dims.make_times_text(_event_plays(spark, d))


def ts_millis(spark: SparkSession, d: str) -> DataFrame:
    return event_millis(spark, d).select("event_id", times.timestamp_from_millis("ts").alias("start_time"))


def ts_seconds(spark: SparkSession, d: str) -> DataFrame:
    return event_millis(spark, d).select("event_id", times.timestamp_from_seconds("ts").alias("start_time"))


def ts_epoch_second(spark: SparkSession, d: str) -> DataFrame:
    return event_millis(spark, d).select("event_id", times.epoch_second("ts").alias("timestamp"))


def device_token(spark: SparkSession, d: str) -> DataFrame:
    agents = _log(spark, d, "user_agent").distinct()
    return agents.select("user_agent", text.device_token("user_agent").alias("device"))


def stage_jsonpaths(spark: SparkSession, d: str) -> DataFrame:
    table = Table("event_props", "k BIGINT")
    return extract_json_paths(load(spark, d, "events"), "props", ["$.k"], table, keep=["event_id"])


def empty_to_null(spark: SparkSession, d: str) -> DataFrame:
    places = song_catalog(spark, d).select("song_id", "artist_location")
    return text.empty_to_null(places, "artist_location")


# Reports --------------------------------------------------------------------------------------------


# The dashboard reads the distinct 2-key fact and the dimensions limited to it, with all distinct rows.


def popular_artists(spark: SparkSession, d: str) -> DataFrame:
    """Artists that are not in the fact cannot count, so the dimension need not be limited to it first."""
    artists = dims.make_artists_distinct(song_catalog(spark, d))
    return reports.popular_artists(_artist_place_fact(spark, d, only=("artist_id",)), artists)


def popular_songs(spark: SparkSession, d: str) -> DataFrame:
    catalog = song_catalog(spark, d)
    songs, artists = dims.make_songs(catalog), dims.make_artists_distinct(catalog)
    return reports.popular_songs(_artist_place_fact(spark, d, only=("song_id",)), songs, artists)


def location_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.location_counts(_artist_place_fact(spark, d, only=("location",)))


def plays_by_location(spark: SparkSession, d: str) -> DataFrame:
    return reports.plays_by_location(_artist_place_fact(spark, d, only=("location",)))


def top3_locations(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_locations(_artist_place_fact(spark, d, only=("location",)), 3)


def plays_by_user_agent(spark: SparkSession, d: str) -> DataFrame:
    return reports.plays_by_user_agent(_artist_place_fact(spark, d, only=("user_agent",)))


def plays_by_device(spark: SparkSession, d: str) -> DataFrame:
    return reports.plays_by_device(_artist_place_fact(spark, d, only=("user_agent",)))


def plays_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return reports.plays_by_hour(_artist_place_fact(spark, d, only=("start_time",)))


def plays_by_weekday(spark: SparkSession, d: str) -> DataFrame:
    return reports.plays_by_weekday(_artist_place_fact(spark, d, only=("start_time",)), convention="sunday0")


def duplicate_times(spark: SparkSession, d: str) -> DataFrame:
    return reports.duplicates(dims.make_times_epoch(_plays(spark, d, "ts")), "start_time")


def users_with_changes(spark: SparkSession, d: str) -> DataFrame:
    known = _log(spark, d, "user_id", *_PROFILE).where("user_id IS NOT NULL")
    return reports.users_with_changes(known, _PROFILE)


def plays_with_profile(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, "user_id", "ts", "session_id", "item_in_session", "song")
    second = times.epoch_second("ts").alias("timestamp")
    fact = plays.select(second, "user_id", "session_id", "item_in_session", "song")
    return reports.plays_with_profile(fact, users_history(spark, d))


def row_counts(spark: SparkSession, d: str) -> DataFrame:
    names = ["lineitem", "orders", "customer", "nation", "part", "events"]
    return reports.row_counts({n: load(spark, d, n) for n in names})


def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    order = ["session_id", "item_in_session", *WRITE_ORDER]
    plays = _plays(spark, d, *order, "method", "user_agent")
    return reports.sample_rows(plays, order, 10).drop("w3")


# Writes and serving tables --------------------------------------------------------------------------


def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    order = ["o_orderdate", "o_orderkey"]
    before = dedupe.first_per_key(orders.where(f"o_orderdate < '{INSERT_CUT}'"), ["o_custkey"], order)
    after = orders.where(f"o_orderdate >= '{INSERT_CUT}'")
    return before.unionByName(dedupe.insert_if_absent(after, before, ["o_custkey"], order))


def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    key, order = ["user_id", "song"], ["ts", *WRITE_ORDER]
    plays = _plays(spark, d, *key, *order, "session_id").drop("start_time")
    cut = F.expr(MILLIS.format(f"TIMESTAMP_NTZ '{UPSERT_CUT} 00:00:00'"))
    stored = dedupe.last_per_key(plays.where(F.col("ts") < cut), key, order)
    merged = dedupe.upsert(stored, plays.where(F.col("ts") >= cut), key, order)
    return merged.select(*key, "ts", "w1", "w2", "session_id")


def _serving(spark: SparkSession, d: str, table: ServingTable) -> DataFrame:
    plays = _plays(spark, d, *table.primary_key, *table.values, "ts", *WRITE_ORDER)
    return serving.build_serving(plays, table, ["ts", *WRITE_ORDER])


def serving_session_items(spark: SparkSession, d: str) -> DataFrame:
    return _serving(spark, d, SESSION_ITEMS)


def serving_user_session(spark: SparkSession, d: str) -> DataFrame:
    return _serving(spark, d, USER_SESSION)


def serving_song_listeners(spark: SparkSession, d: str) -> DataFrame:
    return _serving(spark, d, SONG_LISTENERS)


def lookup_session_item(spark: SparkSession, d: str) -> DataFrame:
    return serving.session_item(_serving(spark, d, SESSION_ITEMS), LOOKUP_SESSION, LOOKUP_ITEM)


def lookup_user_session(spark: SparkSession, d: str) -> DataFrame:
    owner = load(spark, d, "orders").where(F.col("o_orderkey") == LOOKUP_SESSION)
    sessions = _serving(spark, d, USER_SESSION).where(F.col("session_id") == LOOKUP_SESSION)
    owned = sessions.join(owner.select(F.col("o_custkey").alias("user_id")).distinct(), "user_id", "left_semi")
    return owned.orderBy("item_in_session").select("item_in_session", *USER_SESSION.values)


def lookup_song_listeners(spark: SparkSession, d: str) -> DataFrame:
    return serving.song_listeners(_serving(spark, d, SONG_LISTENERS), LOOKUP_SONG)


def _stored(spark: SparkSession, d: str, table: ServingTable) -> DataFrame:
    """A serving table written once per session and data directory, as a load does, and read for each look-up."""
    rows = _serving(spark, d, table)
    name = hashlib.md5(f"{spark.sparkContext.applicationId} {d} {table.name}".encode()).hexdigest()
    path = f"{shared_folder(spark)}/serving-{name}"
    if path not in _WRITTEN:
        sinks.write_serving(rows, path, table)
        _WRITTEN.add(path)
    return sinks.read_serving(spark, path, rows.schema)


def stored_session_item(spark: SparkSession, d: str) -> DataFrame:
    return serving.session_item(_stored(spark, d, SESSION_ITEMS), LOOKUP_SESSION, LOOKUP_ITEM)


def stored_user_session(spark: SparkSession, d: str) -> DataFrame:
    return serving.sessions_items(_stored(spark, d, USER_SESSION), LOOKUP_SESSION)


def stored_song_listeners(spark: SparkSession, d: str) -> DataFrame:
    return serving.song_listeners(_stored(spark, d, SONG_LISTENERS), LOOKUP_SONG)


def cascade_delete(spark: SparkSession, d: str) -> DataFrame:
    gone = load(spark, d, "customer").where("c_acctbal < 0").select("c_custkey")
    return dedupe.cascade_delete(load(spark, d, "orders"), gone, ["o_custkey"], ["c_custkey"])


def _chain(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    tables = {t.name: load(spark, d, t.name) for t in WAREHOUSE}
    gone = tables["region"].where(F.col("r_name") == DELETED_REGION)
    return {"tables": tables, "gone": dedupe.delete_chain(tables, WAREHOUSE, {"region": gone})}


def delete_chain(spark: SparkSession, d: str) -> DataFrame:
    """Orders that stay when a region goes, with its nations, their customers and theirs."""
    chain = _chain(spark, d)
    return dedupe.after_deletes(chain["tables"], WAREHOUSE, chain["gone"])["orders"]


def delete_chain_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every table that go with the region."""
    counts = [rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("deleted")) for name, rows in _chain(spark, d)["gone"].items()]
    return reduce(DataFrame.unionByName, counts)


# Numbers --------------------------------------------------------------------------------------------

_PLAY_ORDER = ["start_time", "session_id", "item_in_session", *WRITE_ORDER]


def songplay_serial_id(spark: SparkSession, d: str) -> DataFrame:
    """Gapless ids: plays before a time are numbered first, later ones go on from the last number stored."""
    plays = _plays(spark, d, *_PLAY_ORDER).select(*_PLAY_ORDER)
    cut = F.lit(UPSERT_CUT).cast("timestamp_ntz")
    stored = numbering.numbered(plays.where(F.col("start_time") < cut), _PLAY_ORDER, name="songplay_id")
    fresh = numbering.continued(plays.where(F.col("start_time") >= cut), stored, _PLAY_ORDER, "songplay_id")
    return stored.unionByName(fresh)


def side_by_side(spark: SparkSession, d: str) -> DataFrame:
    """Customers by balance beside parts by price; there are more of the one than of the other."""
    customers = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    parts = load(spark, d, "part").select("p_partkey", "p_retailprice")
    return numbering.side_by_side(customers, parts, ["c_acctbal", "c_custkey"], ["p_retailprice", "p_partkey"])


# Checked staging ------------------------------------------------------------------------------------

_EVENT_PROPS = Table("event_props", "k DECIMAL(1,0)")


def _checked_props(spark: SparkSession, d: str) -> DataFrame:
    return checked_fields(load(spark, d, "events"), "props", ["$.k"], _EVENT_PROPS, keep=["event_id"])


def staged_good(spark: SparkSession, d: str) -> DataFrame:
    """Events whose k has one digit, as the staging table wants it."""
    return _checked_props(spark, d).where(F.size("rejects") == 0).drop("rejects")


def staged_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The others, a row for each field that does not fit."""
    return _checked_props(spark, d).select("event_id", F.inline("rejects"))


# Inferred types, arrivals ---------------------------------------------------------------------------


def inferred_props(spark: SparkSession, d: str) -> DataFrame:
    """Events with the fields of their props, whose names and types are found in the data."""
    events = inferred.parsed(load(spark, d, "events"), "props")
    return inferred.typed_fields(events, "parsed", ["event_id", "event_type"])


def inferred_field_types(spark: SparkSession, d: str) -> DataFrame:
    """How often each field of props has each type, by kind of event."""
    events = inferred.parsed(load(spark, d, "events"), "props")
    return inferred.field_types(events, "parsed", ["event_type"])


def inferred_drift(spark: SparkSession, d: str) -> DataFrame:
    """Fields whose values have several types: orders as JSON, where one kind of clerk writes prices as text."""
    orders = load(spark, d, "orders")
    price = F.concat(F.lit('{"order":{"key":'), "o_orderkey", F.lit(',"price":'))
    value = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"')))
    value = F.coalesce(value, F.col("o_custkey").cast("string"))
    lines = orders.select(F.concat(price, value, F.lit("}}")).alias("line"))
    return inferred.drifting(inferred.field_types(inferred.parsed(lines, "line"), "parsed"))


_ARRIVED_EVENTS = Table("events", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")


def arrived_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as picked up from where they arrive; what an earlier pick-up has loaded is not loaded again."""
    name = hashlib.md5(f"{spark.sparkContext.applicationId} {d}".encode()).hexdigest()
    root = f"{shared_folder(spark)}/arrivals-{name}"
    for _ in range(2):
        # As a glob, which holds for one file and for a folder of files.
        arrivals.pick_up(spark, f"{d}/event[s].parquet", root, _ARRIVED_EVENTS, "parquet")
    return arrivals.arrived(spark, root, _ARRIVED_EVENTS)


# Quality --------------------------------------------------------------------------------------------


def dq_results(spark: SparkSession, d: str) -> DataFrame:
    """Named counts with the value each should have; some of them do not hold on this data."""
    total = F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
    item = ["session_id", "item_in_session"]
    profiles = dims.make_users(_plays(spark, d, "user_id", *_PROFILE), "distinct")
    per_user = profiles.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("first_name").isNull()).alias("unnamed")
    )
    users = per_user.agg(
        F.coalesce(F.sum("unnamed"), F.lit(0)).alias("users without first name"),
        F.coalesce(F.sum(F.when(F.col("row_count") > 1, F.col("row_count"))), F.lit(0)).alias("users repeated"),
    ).unpivot([], ["users without first name", "users repeated"], "name", "actual")
    orphans = quality.orphan_counts(
        _plays(spark, d, *_MATCH3), song_catalog(spark, d), _MATCH3, facts.TITLE_ARTIST_DURATION
    )
    checks = quality.check_frame(
        [
            ("plays repeated", quality.duplicate_keys(_plays(spark, d, *item), item).agg(total), 0),
            ("plays without song", orphans.agg(total), 0),
        ]
    )
    return checks.unionByName(quality.verdicts(users, "name", "actual", 0))


def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    columns = ["artist", "song", "length", "user_id", "level", "session_id", "ts", "location"]
    return quality.null_counts(_log(spark, d, *columns), columns)


def dq_not_null_on_write(spark: SparkSession, d: str) -> DataFrame:
    """The same counts taken by the write of a table, without reading it for them."""
    columns = ["artist", "song", "length", "user_id", "level", "session_id", "ts", "location"]
    observation = Observation()
    rows = quality.observed(_log(spark, d, *columns), columns, observation)
    name = hashlib.md5(f"{spark.sparkContext.applicationId} {d}".encode()).hexdigest()
    rows.write.mode("overwrite").parquet(f"{shared_folder(spark)}/observed-{name}")
    counted = quality.observed_counts(observation, columns)
    nulls = counted[1] if counted is not None else dict.fromkeys(columns, 0)
    return spark.createDataFrame([*nulls.items()], "column_name STRING, null_count BIGINT")


def dq_pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    item = ["session_id", "item_in_session"]
    return quality.duplicate_keys(_plays(spark, d, *item), item)


def dq_fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    plays = _plays(spark, d, *_MATCH2)
    return quality.orphan_counts(plays, song_catalog(spark, d), _MATCH2, facts.TITLE_ARTIST)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        songplays_inner3, songplays_inner2_distinct, songplays_left3, songplays_right2,
        songplays_left_rounded, lookup_enrich_first, songplay_md5_key, songplay_stable_key,
        clean_log, plays_with_artist, songs_all, songs_played_semi, songs_played, songs_with_artist,
        artists_played, artists_distinct, artists_played_distinct,
        users_latest, users_latest_max_window, users_max_join, users_distinct, users_history,
        time_dim, time_dim_epoch, time_dim_text, ts_millis, ts_seconds, ts_epoch_second,
        device_token, stage_jsonpaths, empty_to_null,
        popular_artists, popular_songs, location_counts, plays_by_location, top3_locations,
        plays_by_user_agent, plays_by_device, plays_by_hour, plays_by_weekday, duplicate_times,
        users_with_changes, plays_with_profile, row_counts, sample_rows,
        insert_if_absent, upsert_last_wins, serving_session_items, serving_user_session,
        serving_song_listeners, lookup_session_item, lookup_user_session, lookup_song_listeners,
        stored_session_item, stored_user_session, stored_song_listeners, songplay_serial_id, side_by_side,
        staged_good, staged_rejects, delete_chain, delete_chain_counts, cascade_delete, dq_results, dq_not_null,
        inferred_props, inferred_field_types, inferred_drift, arrived_events, dq_not_null_on_write, dq_pk_duplicates, dq_fk_orphans,
    )
}
