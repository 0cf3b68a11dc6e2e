"""Usage reports over the star schema.

The fact is counted per foreign key before any dimension is joined. A hot artist, song or second is
therefore one row per map task in the shuffle, and the joins run on counts, not on plays. Where a report
takes `weight`, the fact may be counted already: the named column then holds the number of plays of a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.text import device_token
from playmart.functions.times import weekday, weekday_name


def _plays_per(fact: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return fact.groupBy(*keys).agg(total.alias("_plays"))


def popular_artists(
    fact: DataFrame, artists: DataFrame, n: int = 10, weight: str | None = None
) -> DataFrame:
    """Top n artists by plays, per id and name; ties by artist id and name.

    An id with several rows in `artists` counts each play once per row that has the name.
    """
    plays = _plays_per(fact.where("artist_id IS NOT NULL"), "artist_id", weight=weight)
    names = artists.groupBy("artist_id", F.col("name").alias("artist_name")).agg(F.count(F.lit(1)).alias("_rows"))
    total = plays.join(names, "artist_id")
    total = total.select("artist_id", "artist_name", (F.col("_plays") * F.col("_rows")).alias("requests_count"))
    return total.orderBy(F.desc("requests_count"), "artist_id", "artist_name").limit(n)


def popular_songs(
    fact: DataFrame, songs: DataFrame, artists: DataFrame, n: int = 10, weight: str | None = None
) -> DataFrame:
    """Top n songs by plays, with title and artist name; ties by song id, title and name.

    As with artists, several rows of an id multiply.
    """
    plays = _plays_per(fact.where("song_id IS NOT NULL"), "song_id", weight=weight)
    named = plays.join(songs.select("song_id", F.col("title").alias("song_title"), "artist_id"), "song_id")
    names = artists.groupBy("artist_id", F.col("name").alias("artist_name")).agg(F.count(F.lit(1)).alias("_rows"))
    named = named.join(names, "artist_id").withColumn("_plays", F.col("_plays") * F.col("_rows"))
    total = named.groupBy("song_id", "song_title", "artist_name").agg(F.sum("_plays").alias("requests_count"))
    return total.orderBy(F.desc("requests_count"), "song_id", "song_title", "artist_name").limit(n)


def location_counts(fact: DataFrame) -> DataFrame:
    """Plays that have a location, and how many different ones."""
    per_place = fact.groupBy("location").agg(F.count("location").alias("_plays"))
    return per_place.agg(
        F.coalesce(F.sum("_plays"), F.lit(0)).alias("location_count"),
        F.count("location").alias("distinct_location_count"),
    )


def plays_by_location(fact: DataFrame) -> DataFrame:
    """Plays per location, most first. The NULL group counts 0 because NULL locations are not counted."""
    per_place = fact.groupBy("location").agg(F.count("location").alias("count"))
    return per_place.orderBy(F.desc("count"), F.asc_nulls_last("location"))


def top_locations(fact: DataFrame, n: int = 3) -> DataFrame:
    return plays_by_location(fact).limit(n)


def plays_by_user_agent(fact: DataFrame, weight: str | None = None) -> DataFrame:
    """Plays per raw user agent; plays without one count 0."""
    known = F.col("user_agent").isNotNull()
    total = F.sum(F.when(known, F.col(weight)).otherwise(0)) if weight else F.count("user_agent")
    return fact.groupBy("user_agent").agg(total.alias("used_count"))


def plays_by_device(fact: DataFrame, weight: str | None = None) -> DataFrame:
    """Plays per device, from the counts per user agent."""
    agents = plays_by_user_agent(fact, weight).withColumn("device", device_token("user_agent"))
    return agents.groupBy("device").agg(F.sum("used_count").alias("used_count"))


def _plays_by_time(fact: DataFrame, times: DataFrame | None, attribute: str, value: Column) -> DataFrame:
    plays = _plays_per(fact.where("start_time IS NOT NULL"), "start_time")
    if times is None:
        plays = plays.withColumn(attribute, value)
    else:
        plays = plays.join(times.select("start_time", attribute), "start_time")
    plays = plays.where(F.col(attribute).isNotNull())
    return plays.groupBy(attribute).agg(F.sum("_plays").alias("requests")).orderBy(attribute)


def plays_by_hour(fact: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Plays per hour by the times table, or by the plays' own times.

    A table of just the fact's times has every time of it, so joining it would build the fact twice for nothing.
    """
    return _plays_by_time(fact, times, "hour", F.hour("start_time"))


def plays_by_weekday(
    fact: DataFrame, times: DataFrame | None = None, convention: str = "sunday1"
) -> DataFrame:
    """Plays per weekday, labelled by the convention the times table was made with."""
    plays = _plays_by_time(fact, times, "weekday", weekday("start_time", convention))
    return plays.withColumn("weekday_name", weekday_name(F.col("weekday"), convention))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.where("count > 1")


def users_with_changes(log: DataFrame, attributes: Sequence[str], key: str = "user_id") -> DataFrame:
    """Keys that show more than one value of any attribute.

    Distinct profiles are taken first; after that "more than one value" is min <> max, so no column has
    to be expanded for a distinct count.
    """
    profiles = log.select(key, *attributes).distinct()
    bounds = [f(a).alias(f"{n}_{a}") for a in attributes for n, f in (("min", F.min), ("max", F.max))]
    changed = " OR ".join(f"min_{a} <> max_{a}" for a in attributes)
    return profiles.groupBy(key).agg(*bounds).where(changed).select(key)


def plays_with_profile(fact: DataFrame, history: DataFrame) -> DataFrame:
    """The fact with the profile the user had at that second."""
    profile = history.select("timestamp", "user_id", "first_name", "last_name", "gender")
    return fact.join(profile, ["timestamp", "user_id"])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; counts of Parquet tables come from file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def sample_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows by a total order."""
    return df.orderBy(*order).limit(n)
