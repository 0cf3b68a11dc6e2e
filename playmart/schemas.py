"""One registry of feed, staging and star-schema tables.

Field names, types and keys are fixed values: they have to equal the feeds and the published tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# Raw feeds ------------------------------------------------------------------------------------------

SONG_FEED = (
    "artist_id STRING, artist_latitude DOUBLE, artist_location STRING, artist_longitude DOUBLE, "
    "artist_name STRING, duration DOUBLE, num_songs BIGINT, song_id STRING, title STRING, year BIGINT"
)

LOG_FEED = (
    "artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession BIGINT, lastName STRING, "
    "length DOUBLE, level STRING, location STRING, method STRING, page STRING, registration DOUBLE, "
    "sessionId BIGINT, song STRING, status BIGINT, ts BIGINT, userAgent STRING, userId STRING"
)

EVENT_CSV_FEED = (
    "artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession STRING, lastName STRING, "
    "length STRING, level STRING, location STRING, method STRING, page STRING, registration STRING, "
    "sessionId STRING, song STRING, status STRING, ts STRING, userId STRING"
)

# Types the CSV text is cast to; ts and registration arrive in scientific notation.
EVENT_CSV_TYPES = {
    "itemInSession": "BIGINT",
    "length": "DOUBLE",
    "registration": "DOUBLE",
    "sessionId": "BIGINT",
    "status": "BIGINT",
    "ts": "DOUBLE",
    "userId": "BIGINT",
}

# Columns of the consolidated event CSV, in file order.
CONSOLIDATED_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "sessionId", "song", "userId",
]

# Columns are read in this order when a log is staged by path list.
LOG_JSON_PATHS = [
    "$['artist']", "$['auth']", "$['firstName']", "$['gender']", "$['itemInSession']", "$['lastName']",
    "$['length']", "$['level']", "$['location']", "$['method']", "$['page']", "$['registration']",
    "$['sessionId']", "$['song']", "$['status']", "$['ts']", "$['userAgent']", "$['userId']",
]


# Tables ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    columns: str
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    not_null: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def column_names(self) -> list[str]:
        return self.schema.fieldNames()


# The log as delivered: staging columns of monthly loads.
LOG = Table("log", LOG_FEED)

STAGING_EVENTS = Table(
    "staging_events",
    "artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession INT, lastName STRING, "
    "length DOUBLE, level STRING, location STRING, method STRING, page STRING, registration DOUBLE, "
    "sessionId INT, song STRING, status SMALLINT, ts BIGINT, userAgent STRING, userId BIGINT",
    not_null=("auth", "itemInSession", "level", "method", "page", "sessionId", "status", "ts"),
)

STAGING_SONGS = Table(
    "staging_songs",
    "artist_id STRING, artist_latitude DOUBLE, artist_location STRING, artist_longitude DOUBLE, "
    "artist_name STRING, duration DOUBLE, num_songs INT, song_id STRING, title STRING, year INT",
    not_null=("artist_id", "artist_name", "duration", "num_songs", "song_id", "title", "year"),
)

# Staging variant whose numeric(18,0) columns round durations and coordinates to whole numbers.
STAGING_EVENTS_ROUNDED = Table(
    "staging_events",
    "artist STRING, auth STRING, firstname STRING, gender STRING, iteminsession INT, lastname STRING, "
    "length DECIMAL(18,0), level STRING, location STRING, method STRING, page STRING, "
    "registration DECIMAL(18,0), sessionid INT, song STRING, status INT, ts BIGINT, useragent STRING, "
    "userid INT",
)

STAGING_SONGS_ROUNDED = Table(
    "staging_songs",
    "num_songs INT, artist_id STRING, artist_name STRING, artist_latitude DECIMAL(18,0), "
    "artist_longitude DECIMAL(18,0), artist_location STRING, song_id STRING, title STRING, "
    "duration DECIMAL(18,0), year INT",
)

ARTISTS = Table(
    "artists",
    "artist_id STRING, name STRING, location STRING, latitude DOUBLE, longitude DOUBLE",
    primary_key=("artist_id",),
    not_null=("artist_id", "name"),
    sort_by=("name",),
)

SONGS = Table(
    "songs",
    "song_id STRING, title STRING, artist_id STRING, year BIGINT, duration DOUBLE",
    primary_key=("song_id",),
    foreign_keys=(ForeignKey(("artist_id",), "artists", ("artist_id",)),),
    not_null=("song_id", "title", "artist_id"),
    # A (year, artist_id) layout would write one tiny file per artist; sorting keeps artists together.
    partition_by=("year",),
    sort_by=("artist_id", "title"),
)

USERS = Table(
    "users",
    "user_id BIGINT, first_name STRING, last_name STRING, gender STRING, level STRING",
    primary_key=("user_id",),
    not_null=("user_id",),
    sort_by=("user_id",),
)

USERS_HISTORY = Table(
    "users",
    "timestamp BIGINT, user_id BIGINT, first_name STRING, last_name STRING, gender STRING, level STRING",
    primary_key=("timestamp", "user_id"),
    foreign_keys=(ForeignKey(("timestamp",), "times", ("timestamp",)),),
    not_null=("timestamp", "user_id"),
    sort_by=("user_id", "timestamp"),
)

TIMES = Table(
    "times",
    "start_time TIMESTAMP_NTZ, hour INT, day INT, day_of_year INT, week INT, month INT, year INT, "
    "weekday INT",
    primary_key=("start_time",),
    not_null=("start_time",),
    partition_by=("year", "month"),
    sort_by=("start_time",),
)

TIMES_EPOCH = Table(
    "times",
    "timestamp BIGINT, start_time STRING, hour INT, day INT, week INT, month INT, year INT, weekday INT",
    primary_key=("timestamp",),
    not_null=("timestamp",),
    partition_by=("year", "month"),
    sort_by=("timestamp",),
)

_FACT_KEYS = (
    ForeignKey(("song_id",), "songs", ("song_id",)),
    ForeignKey(("artist_id",), "artists", ("artist_id",)),
)

SONGPLAYS = Table(
    "songplays",
    "songplay_id STRING, start_time TIMESTAMP_NTZ, user_id BIGINT, level STRING, song_id STRING, "
    "artist_id STRING, session_id BIGINT, location STRING, user_agent STRING, year INT, month INT",
    primary_key=("songplay_id",),
    foreign_keys=(
        ForeignKey(("start_time",), "times", ("start_time",)),
        ForeignKey(("user_id",), "users", ("user_id",)),
        *_FACT_KEYS,
    ),
    not_null=("songplay_id", "start_time", "level", "session_id"),
    partition_by=("year", "month"),
    sort_by=("start_time",),
)

SONGPLAYS_EPOCH = Table(
    "songplays",
    "songplay_id STRING, timestamp BIGINT, user_id BIGINT, level STRING, song_id STRING, "
    "artist_id STRING, session_id BIGINT, location STRING, user_agent STRING, year INT, month INT",
    primary_key=("songplay_id",),
    foreign_keys=(
        ForeignKey(("timestamp",), "times", ("timestamp",)),
        ForeignKey(("timestamp", "user_id"), "users", ("timestamp", "user_id")),
        *_FACT_KEYS,
    ),
    not_null=("songplay_id", "timestamp"),
    partition_by=("year", "month"),
    sort_by=("timestamp",),
)


# Keys of the warehouse whose rows stand in for the feeds.
REGION = Table("region", "r_regionkey INT, r_name STRING", primary_key=("r_regionkey",))
NATION = Table(
    "nation",
    "n_nationkey INT, n_name STRING, n_regionkey INT",
    primary_key=("n_nationkey",),
    foreign_keys=(ForeignKey(("n_regionkey",), "region", ("r_regionkey",)),),
)
CUSTOMER = Table(
    "customer",
    "c_custkey BIGINT, c_nationkey INT",
    primary_key=("c_custkey",),
    foreign_keys=(ForeignKey(("c_nationkey",), "nation", ("n_nationkey",)),),
)
ORDERS = Table(
    "orders",
    "o_orderkey BIGINT, o_custkey BIGINT",
    primary_key=("o_orderkey",),
    foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),),
)
LINEITEM = Table(
    "lineitem",
    "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT",
    primary_key=("l_orderkey", "l_linenumber"),
    foreign_keys=(ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),),
)
WAREHOUSE = [REGION, NATION, CUSTOMER, ORDERS, LINEITEM]


@dataclass(frozen=True)
class ServingTable:
    """Query-first table: rows are unique on partition key + clustering key, last write wins."""

    name: str
    partition_key: tuple[str, ...]
    clustering_key: tuple[str, ...]
    values: tuple[str, ...] = field(default=())

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.partition_key + self.clustering_key


SESSION_ITEMS = ServingTable(
    "song_info_session", ("session_id",), ("item_in_session",), ("artist", "song", "length")
)
USER_SESSION = ServingTable(
    "song_playlist_session",
    ("user_id", "session_id"),
    ("item_in_session",),
    ("artist", "song", "first_name", "last_name"),
)
SONG_LISTENERS = ServingTable("song_listeners", ("song",), ("user_id",), ("first_name", "last_name"))


def load_order(tables: list[Table]) -> list[Table]:
    """Parents before children; the reverse is a safe drop order. Foreign keys in a ring are an error."""
    by_name = {t.name: t for t in tables}
    ordered: list[Table] = []

    def visit(table: Table, below: tuple[str, ...]) -> None:
        if table in ordered:
            return
        if table.name in below:
            raise ValueError(f"foreign keys form a ring: {' -> '.join([*below, table.name])}")
        for fk in table.foreign_keys:
            if fk.parent in by_name and fk.parent != table.name:
                visit(by_name[fk.parent], (*below, table.name))
        ordered.append(table)

    for table in tables:
        visit(table, ())
    return ordered
