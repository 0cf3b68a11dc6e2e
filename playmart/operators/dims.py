"""Dimension builders: songs, artists, users, times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.times import epoch_second, time_of_day, timestamp_from_millis, weekday
from playmart.operators.dedupe import first_per_key, latest_profile, latest_profiles
from playmart.operators.facts import LOG_KEY, TITLE_ARTIST_DURATION

PROFILE = ["first_name", "last_name", "gender", "level"]
SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]


def played_songs(
    songs: DataFrame, plays: DataFrame, keys: Sequence[str] = TITLE_ARTIST_DURATION
) -> DataFrame:
    """Catalog rows that were played. Play keys are made distinct first, so no hot song is joined."""
    heard = plays.select(*[F.col(LOG_KEY[k]).alias(k) for k in keys]).distinct()
    return songs.join(heard, list(keys), "left_semi").select(*songs.columns)


def in_fact(rows: DataFrame, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the fact."""
    return rows.join(fact.select(*keys).distinct(), list(keys), "left_semi").select(*rows.columns)


def make_songs(catalog: DataFrame) -> DataFrame:
    """Distinct song rows of a catalog."""
    return catalog.select(*SONG_COLUMNS).distinct()


def make_songs_unique(catalog: DataFrame) -> DataFrame:
    """One row per song id, rows without an id dropped."""
    songs = catalog.select(*SONG_COLUMNS).where(F.col("song_id").isNotNull())
    return first_per_key(songs, ["song_id"], [])


def artist_rows(catalog: DataFrame, *extra: str) -> DataFrame:
    return catalog.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
        *extra,
    )


def make_artists_distinct(catalog: DataFrame) -> DataFrame:
    """Every distinct artist row; an id with conflicting data has several."""
    return artist_rows(catalog).distinct()


def make_artists(catalog: DataFrame) -> DataFrame:
    """One row per artist: the one of the lowest song id; rows without id or name dropped."""
    rows = artist_rows(catalog, "song_id").where("artist_id IS NOT NULL AND name IS NOT NULL")
    return first_per_key(rows, ["artist_id"], ["song_id"]).drop("song_id")


def make_users(log: DataFrame, policy: str = "latest", order: Sequence[str] = ()) -> DataFrame:
    """Users from a renamed log.

    latest    one row per user: the profile at the user's last time
    at_last   every distinct profile at the last time (ties keep several rows)
    distinct  every distinct profile
    history   one profile per (second, user), first write wins; `order` is the write order
    """
    if policy == "latest":
        return latest_profile(log, "user_id", PROFILE, "ts")
    if policy == "at_last":
        return latest_profiles(log, "user_id", PROFILE, "ts")
    known = log.where(F.col("user_id").isNotNull())
    if policy == "distinct":
        return known.select("user_id", *PROFILE).distinct()
    if policy == "history":
        rows = known.select(epoch_second("ts").alias("timestamp"), "user_id", *PROFILE, "ts", *order)
        first = first_per_key(rows, ["timestamp", "user_id"], ["ts", *order])
        return first.select("timestamp", "user_id", *PROFILE)
    raise ValueError(f"unknown user policy: {policy}")


def make_times(plays: DataFrame, convention: str = "sunday1") -> DataFrame:
    """Distinct start times with their calendar attributes."""
    times = plays.select("start_time").where(F.col("start_time").isNotNull()).distinct()
    return times.select(
        "start_time",
        F.hour("start_time").alias("hour"),
        F.dayofmonth("start_time").alias("day"),
        F.dayofyear("start_time").alias("day_of_year"),
        F.weekofyear("start_time").alias("week"),
        F.month("start_time").alias("month"),
        F.year("start_time").alias("year"),
        weekday("start_time", convention).alias("weekday"),
    )


def make_times_epoch(plays: DataFrame) -> DataFrame:
    """One row per epoch second with the time of day of its earliest play; Monday is weekday 0."""
    first = plays.where(F.col("ts").isNotNull()).groupBy(epoch_second("ts").alias("timestamp")).agg(
        F.min("ts").alias("ts")
    )
    timed = first.withColumn("_at", timestamp_from_millis("ts"))
    return timed.select(
        "timestamp",
        time_of_day("_at").alias("start_time"),
        F.hour("_at").alias("hour"),
        F.dayofmonth("_at").alias("day"),
        F.weekofyear("_at").alias("week"),
        F.month("_at").alias("month"),
        F.year("_at").alias("year"),
        weekday("_at", "monday0").alias("weekday"),
    )


def make_times_text(plays: DataFrame) -> DataFrame:
    """Times whose month and weekday (Sunday = 0) are text."""
    times = make_times(plays, "sunday0").drop("day_of_year")
    return times.withColumns({c: F.col(c).cast("string") for c in ("month", "weekday")})

