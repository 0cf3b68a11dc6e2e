"""The songplays fact: plays matched to the song catalog.

Expected inputs: a cleaned log (see clean_log) and a raw song catalog. The dialect differences (match
keys, unmatched plays, duplicates, whose location) are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.keys import natural_key
from playmart.functions.text import to_bigint
from playmart.functions.times import timestamp_from_millis, timestamp_from_seconds
from playmart.operators.dedupe import first_per_key

# raw log column -> cleaned name
RENAMES = {
    "userId": "user_id",
    "firstName": "first_name",
    "lastName": "last_name",
    "sessionId": "session_id",
    "itemInSession": "item_in_session",
    "userAgent": "user_agent",
}

# log column that holds each catalog match key
LOG_KEY = {"title": "song", "artist_name": "artist", "duration": "length"}

TITLE_ARTIST = ("title", "artist_name")
TITLE_ARTIST_DURATION = ("title", "artist_name", "duration")

FACT_COLUMNS = [
    "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent",
]


def rename_log(log: DataFrame) -> DataFrame:
    """snake_case names and numeric user ids ('' becomes NULL), all pages kept."""
    renamed = log.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in log.columns})
    if "user_id" in renamed.columns:
        renamed = renamed.withColumn("user_id", to_bigint(F.col("user_id").cast("string")))
    return renamed


def clean_log(log: DataFrame, grain: str = "second") -> DataFrame:
    """Song plays only, renamed, with start_time cut to the second or kept to the millisecond."""
    plays = rename_log(log.where("page = 'NextSong'"))
    if "ts" not in plays.columns:
        return plays
    make = {"second": timestamp_from_seconds, "milli": timestamp_from_millis}[grain]
    return plays.withColumn("start_time", make("ts"))


def _whole(column: Column) -> Column:
    return column.try_cast("decimal(18,0)")


def match_songs(
    plays: DataFrame,
    songs: DataFrame,
    keys: Sequence[str] = TITLE_ARTIST_DURATION,
    how: str = "inner",
    rounded: bool = False,
) -> DataFrame:
    """Plays joined to catalog rows; plays are the preserved side of how='left'.

    The plan leaves broadcasting to Spark's own size check. Beyond it both sides are shuffled, and the
    plays of one hot song are split by the adaptive skew join, which can split the left side of inner and
    left joins. With rounded=True durations are compared as whole numbers.
    """
    on = []
    for key in keys:
        play, song = F.col(f"p.{LOG_KEY[key]}"), F.col(f"s.{key}")
        if rounded and key == "duration":
            play, song = _whole(play), _whole(song)
        on.append(play == song)
    return plays.alias("p").join(songs.alias("s"), on, how)


def _qualified(columns: Sequence[str], location_from: str) -> list[Column]:
    place = {"user": "p.location", "artist": "s.artist_location"}[location_from]
    side = {"song_id": "s.song_id", "artist_id": "s.artist_id", "location": place}
    return [F.col(side.get(c, f"p.{c}")).alias(c) for c in columns]


def distinct_rows(rows: DataFrame, only: Sequence[str] = ()) -> DataFrame:
    """Rows without repetition, cut to some columns if `only` is given.

    The others then take part as 128 bits of hash, with a mark for every NULL, as the hash skips them; so texts
    that are needed only to tell rows apart are not shuffled.
    """
    if not only:
        return rows.distinct()
    others = [F.col(c) for c in rows.columns if c not in only]
    nulls = [c.isNull() for c in others]
    hashes = [F.xxhash64(F.lit(n), *others, *nulls).alias(f"_hash{n}") for n in (1, 2)]
    return rows.select(*only, *hashes).distinct().select(*only)


def make_songplays(
    plays: DataFrame,
    songs: DataFrame,
    *,
    keys: Sequence[str] = TITLE_ARTIST_DURATION,
    how: str = "inner",
    rounded: bool = False,
    distinct: bool = False,
    location_from: str = "user",
    columns: Sequence[str] = FACT_COLUMNS,
    extra: Sequence[str] = (),
    only: Sequence[str] = (),
) -> DataFrame:
    """Fact rows; `extra` carries further play columns, for instance those a key is made of.

    distinct=True drops repeated fact rows; copies are combined in each map task before the shuffle. `only` cuts
    the distinct rows to some columns, one row for each of them still.
    """
    columns = [*columns, *extra]
    fact = match_songs(plays, songs, keys, how, rounded).select(*_qualified(columns, location_from))
    if distinct:
        return distinct_rows(fact, only)
    return fact.select(*only) if only else fact


def count_songplays(
    plays: DataFrame,
    songs: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = TITLE_ARTIST_DURATION,
    how: str = "inner",
) -> DataFrame:
    """Number of fact rows per value of some fact columns, as `plays`, without building the fact.

    Plays are counted per match key in each map task first, so the match shuffles distinct keys, not
    plays, and a hot song is one row.
    """
    own = [c for c in columns if c not in ("song_id", "artist_id")]
    per_key = plays.groupBy(*dict.fromkeys([*(LOG_KEY[k] for k in keys), *own]))
    counted = per_key.agg(F.count(F.lit(1)).alias("plays"))
    matched = match_songs(counted, songs, keys, how).select(*_qualified([*columns, "plays"], "user"))
    return matched.groupBy(*columns).agg(F.sum("plays").alias("plays"))


def songs_with_artist(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs joined to their artist, in catalog column names, for matching."""
    named = artists.select(
        "artist_id", F.col("name").alias("artist_name"), F.col("location").alias("artist_location")
    )
    return songs.join(named, "artist_id")


def first_match(songs: DataFrame, keys: Sequence[str] = TITLE_ARTIST_DURATION) -> DataFrame:
    """One catalog row per match key, lowest song_id first, so that a look-up never multiplies plays."""
    return first_per_key(songs.select(*keys, "song_id", "artist_id", "artist_location"), keys, ["song_id"])


def enrich_first(
    plays: DataFrame, songs: DataFrame, keys: Sequence[str] = TITLE_ARTIST_DURATION, **options
) -> DataFrame:
    """Every play once, with the ids of its first match or NULL."""
    return make_songplays(plays, first_match(songs, keys), keys=keys, how="left", **options)


def with_stable_key(fact: DataFrame, *natural: str) -> DataFrame:
    """songplay_id as md5 over the natural key: equal on every run, unlike a generated id."""
    return fact.withColumn("songplay_id", natural_key(*natural))


def with_calendar(fact: DataFrame) -> DataFrame:
    return fact.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
