"""Whole and monthly loads: stage, build, check, publish.

Order: staging -> fact -> dimensions -> checks -> publish. Staged feeds and the fact are written as Parquet
and read back, so five outputs do not repeat the JSON parse or the song match, and a lost executor costs
tasks, not the run. Everything a run writes lies in directories of its own; nothing that is published is
touched before the one append that makes the run current.

A monthly load replaces the month's part of the fact. What the dimensions need of other months is kept as
small summaries per month (profiles, played song keys, seconds), so no earlier log or fact is read again but
for the calendar months that the loaded rows fall in.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart import schemas, sinks
from playmart.functions.keys import natural_key
from playmart.functions.text import empty_to_null
from playmart.functions.times import epoch_second, timestamp_from_millis
from playmart.operators import dims, facts, quality
from playmart.operators.dedupe import first_per_key, profile_summary
from playmart.schemas import Table
from playmart.sources import feeds
from playmart.sources.staging import stage_period

@dataclass(frozen=True)
class Dialect:
    """The choices in which the supported load styles differ."""

    name: str
    keys: tuple[str, ...] = facts.TITLE_ARTIST_DURATION
    how: str = "inner"  # "left" keeps plays without a song
    rounded: bool = False  # hold durations and coordinates as whole numbers
    distinct: bool = False  # drop repeated fact rows
    redelivered: str = "dropped"  # log rows equal in every column count once, or are all "kept"
    location_from: str = "user"  # or "artist"
    scope: str = "played"  # songs and artists: "played", "in_fact" or "all"
    unique_songs: bool = True  # one row per song and artist id, or every distinct row
    users: str = "latest"  # see dims.make_users
    users_from_all_pages: bool = False
    times_from_fact: bool = False  # or from all plays
    grain: str = "second"  # or "milli", or "epoch" for integer seconds
    weekday: str = "sunday1"
    empty_as_null: bool = False

    @property
    def tables(self) -> list[Table]:
        """Registry entries, without the primary key where this style keeps several rows per id."""
        if self.grain == "epoch":
            fact, users, times = schemas.SONGPLAYS_EPOCH, schemas.USERS_HISTORY, schemas.TIMES_EPOCH
        else:
            fact, users, times = schemas.SONGPLAYS, schemas.USERS, schemas.TIMES
        songs, artists = schemas.SONGS, schemas.ARTISTS
        if not self.unique_songs:
            songs, artists = replace(songs, primary_key=()), replace(artists, primary_key=())
        if self.users in ("at_last", "distinct"):
            users = replace(users, primary_key=())
        return [fact, users, songs, artists, times]


LAKE = Dialect("lake")
WAREHOUSE = Dialect(
    "warehouse",
    keys=facts.TITLE_ARTIST,
    distinct=True,
    location_from="artist",
    scope="in_fact",
    unique_songs=False,
    users="at_last",
    users_from_all_pages=True,
    times_from_fact=True,
    grain="milli",
    weekday="sunday0",
)
HISTORY = Dialect(
    "history",
    keys=facts.TITLE_ARTIST,
    how="left",
    scope="all",
    users="history",
    grain="epoch",
    weekday="monday0",
    empty_as_null=True,
)
SCHEDULED = Dialect(
    "scheduled",
    how="left",
    rounded=True,
    scope="all",
    unique_songs=False,
    users="distinct",
    times_from_fact=True,
    weekday="sunday0",
)
DIALECTS = {d.name: d for d in (LAKE, WAREHOUSE, HISTORY, SCHEDULED)}

PLAY_ID = "_play_id"


def identified(log: DataFrame, redelivered: str) -> DataFrame:
    """The log with PLAY_ID, a key over every column as delivered.

    Rows that agree in all columns were delivered more than once: they count once, or are numbered.
    """
    if redelivered not in ("dropped", "kept"):
        raise ValueError(f"redelivered rows are dropped or kept, not {redelivered}")
    same = log.groupBy(*log.columns).agg(F.count(F.lit(1)).alias("_times"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))) if redelivered == "kept" else F.lit(1)
    numbered = same.select(*log.columns, copies.alias("_copy"))
    return numbered.withColumn(PLAY_ID, natural_key(*log.columns, "_copy")).drop("_copy")


def _to_whole(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers rounded half up to whole ones, as a numeric(18,0) column holds them."""
    return df.withColumns({c: F.col(c).try_cast("decimal(18,0)").cast("double") for c in columns})


@dataclass(frozen=True)
class Feeds:
    """Prepared inputs of one load."""

    log: DataFrame  # renamed, all pages
    plays: DataFrame  # cleaned plays
    catalog: DataFrame  # song feed, limited to played songs where the style asks for it

    @classmethod
    def prepare(
        cls, log: DataFrame, catalog: DataFrame, dialect: Dialect, played_before: DataFrame | None = None
    ) -> "Feeds":
        """`played_before` holds song keys of other months; see played_keys."""
        if not dialect.distinct:
            log = identified(log, dialect.redelivered)
        if dialect.empty_as_null:
            log, catalog = empty_to_null(log), empty_to_null(catalog)
        if dialect.rounded:
            log = _to_whole(log, "length")
            catalog = _to_whole(catalog, "duration", "artist_latitude", "artist_longitude")
        plays = facts.clean_log(log, "milli" if dialect.grain == "milli" else "second")
        if dialect.scope == "played":
            heard = played_keys(plays, dialect)
            if played_before is not None:
                heard = heard.unionByName(played_before)
            catalog = catalog.join(heard, list(dialect.keys), "left_semi").select(*catalog.columns)
        return cls(facts.rename_log(log), plays, catalog)

    def users_source(self, dialect: Dialect) -> DataFrame:
        return self.log if dialect.users_from_all_pages else self.plays


def played_keys(plays: DataFrame, dialect: Dialect) -> DataFrame:
    """The distinct song keys of plays, in catalog names."""
    return plays.select(*[F.col(facts.LOG_KEY[k]).alias(k) for k in dialect.keys]).distinct()


def build_fact(inputs: Feeds, dialect: Dialect) -> DataFrame:
    """The fact, one row per key; the key is the same on every run.

    A row is a play with one of its songs. Plays are identified by all their log columns, so nothing is
    reduced here; the distinct style is keyed by the columns it is distinct in.
    """
    catalog = inputs.catalog
    if dialect.unique_songs:
        catalog = facts.songs_with_artist(dims.make_songs_unique(catalog), dims.make_artists(catalog))
    if dialect.distinct:
        extra = ["ts"]
        natural = [*[c for c in facts.FACT_COLUMNS if c != "start_time"], "ts"]
    else:
        extra = ["ts", PLAY_ID]
        natural = [PLAY_ID, "song_id", "artist_id"]
        if not dialect.unique_songs:
            # A catalog row that was delivered twice is one song.
            catalog = catalog.select(*dialect.keys, "song_id", "artist_id", "artist_location").distinct()
    fact = facts.make_songplays(
        inputs.plays,
        catalog,
        keys=dialect.keys,
        how=dialect.how,
        distinct=dialect.distinct,
        location_from=dialect.location_from,
        extra=extra,
    )
    fact = facts.with_calendar(facts.with_stable_key(fact, *natural))
    if dialect.grain == "epoch":
        fact = fact.withColumn("timestamp", epoch_second("ts"))
    return fact.select(*dialect.tables[0].column_names)


def build_catalog(inputs: Feeds, heard: DataFrame, dialect: Dialect) -> dict[str, DataFrame]:
    """Songs and artists; `heard` is the fact, or its distinct song and artist ids."""
    if dialect.unique_songs:
        songs, artists = dims.make_songs_unique(inputs.catalog), dims.make_artists(inputs.catalog)
    else:
        songs, artists = dims.make_songs(inputs.catalog), dims.make_artists_distinct(inputs.catalog)
    if dialect.scope == "in_fact":
        songs = dims.in_fact(songs, heard, ["song_id", "artist_id"])
        artists = dims.in_fact(artists, heard, ["artist_id"])
    return {"songs": songs, "artists": artists}


def build_times(seen: DataFrame, dialect: Dialect) -> DataFrame:
    """Times of plays, of a fact, or of rows of seconds_summary."""
    return dims.make_times_epoch(seen) if dialect.grain == "epoch" else dims.make_times(seen, dialect.weekday)


def build_dims(inputs: Feeds, fact: DataFrame, dialect: Dialect) -> dict[str, DataFrame]:
    """Dimensions; those limited to what the fact holds read the written fact."""
    seen = fact if dialect.times_from_fact else inputs.plays
    users = dims.make_users(inputs.users_source(dialect), dialect.users)
    return {"users": users, **build_catalog(inputs, fact, dialect), "times": build_times(seen, dialect)}


@dataclass(frozen=True)
class Loaded:
    """What a load has published, and how many corrupt rows of each feed it has put aside."""

    run_id: str
    paths: dict[tuple[str, str], str]
    rejected: dict[str, int]
    rows: dict[tuple[str, str], int] | None = None  # counted by the writes

    def path(self, table: str) -> str:
        """The path this run has written a table to, the only one there is after a whole load."""
        return next(p for (name, _), p in self.paths.items() if name == table)


class _Run:
    """Directories of one run, its rejected rows and the tables it will publish."""

    def __init__(self, spark: SparkSession, root: str, dialect: Dialect, max_corrupt: int) -> None:
        self.spark, self.root, self.dialect, self.max_corrupt = spark, root, dialect, max_corrupt
        self.run_id = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.base = sinks.current(spark, root)
        self.paths: dict[tuple[str, str], str] = {}
        self.rejected: dict[str, int] = {}
        self.counted: dict[tuple[str, str], tuple[int, dict[str, int]] | None] = {}

    def stage(self, name: str, feed: DataFrame, compact: bool = False) -> DataFrame:
        """A raw feed as Parquet, once. compact=True merges a feed of many small files by one shuffle.

        Corrupt rows are put aside and counted; more than max_corrupt of them end the load.
        """
        path = f"{self.root}/runs/{self.run_id}/staging/{name}"
        rows = sinks.laid_out(feed) if compact else feed
        rows.write.mode("overwrite").parquet(path)
        good, corrupt = feeds.split_corrupt(self.spark.read.schema(feed.schema).parquet(path))
        aside = f"{self.root}/runs/{self.run_id}/rejected/{name}"
        corrupt.select(feeds.CORRUPT).write.mode("overwrite").text(aside)
        found = self.rejected[name] = self.spark.read.text(aside).count()
        if found > self.max_corrupt:
            raise quality.DataQualityError(f"{found} corrupt rows put aside in {aside}, {self.max_corrupt} allowed")
        return good

    def write(self, df: DataFrame, table: Table, period: str = sinks.WHOLE) -> DataFrame:
        """Write a table to the run's directory, to be published for a period; returns it as written."""
        path = sinks.run_path(self.root, table.name, self.run_id)
        if period != sinks.WHOLE:
            path = sinks.run_path(self.root, table.name, f"{self.run_id}-{period}")
        observation = Observation()
        sinks.write_table(df, path, table, observation=observation)
        self.paths[table.name, period] = path
        self.counted[table.name, period] = quality.observed_counts(observation, table.not_null)
        return sinks.read_runs(self.spark, self.root, [path], table)

    def read(self, table: Table, spark: SparkSession | None = None) -> DataFrame:
        """A table as it will be: what the run has written, and what is published of other periods."""
        mine = {p: path for (name, p), path in self.paths.items() if name == table.name}
        held = [] if sinks.WHOLE in mine else self.base.of(table.name, list(mine))
        return sinks.read_runs(spark or self.spark, self.root, [*held, *mine.values()], table)

    def nulls(self) -> dict[str, dict[str, int]]:
        """NULLs per column, as counted by the writes, of the tables that this run has written all of."""
        found: dict[str, dict[str, int]] = {}
        for table in self.dialect.tables:
            mine = {p: got for (name, p), got in self.counted.items() if name == table.name}
            whole = sinks.WHOLE in mine or table.name == "songplays" or not self.base.of(table.name, list(mine))
            if mine and whole and None not in mine.values():
                found[table.name] = {c: sum(nulls[c] for _, nulls in mine.values()) for c in table.not_null}
        return found

    def check_and_publish(
        self, fact: DataFrame, checks: Sequence[quality.Check]
    ) -> Loaded:
        """Constraints of the written fact and all dimensions, the given checks, then publication."""
        specs = self.dialect.tables
        written = {t.name: self.read(t) for t in specs} | {"songplays": fact}
        quality.enforce(quality.constraint_checks(written, specs, self.nulls()))
        if checks:
            # A session of its own, so that no view of the caller is replaced.
            own = self.spark.newSession()
            for t in specs:
                self.read(t, own).createOrReplaceTempView(t.name)
            quality.run_checks(own, checks)
        # Tables are built on one another and on other periods, so any commit to one of them in the meantime matters.
        reads = [*{name for name, _ in [*self.paths, *self.base.paths]}]
        sinks.publish(self.spark, self.root, self.run_id, self.paths, self.base, reads)
        rows = {key: got[0] for key, got in self.counted.items() if got is not None}
        return Loaded(self.run_id, self.paths, self.rejected, rows)


def run(
    spark: SparkSession,
    log_paths: feeds.Paths,
    song_paths: feeds.Paths,
    root: str,
    dialect: Dialect = LAKE,
    *,
    checks: Sequence[quality.Check] = (),
    recursive: bool = False,
    max_corrupt: int = 0,
) -> Loaded:
    """One whole load. Nothing becomes current unless every table is written and every check passes."""
    this = _Run(spark, root, dialect, max_corrupt)
    log = this.stage("log", feeds.read_log_data(spark, log_paths, recursive=recursive, keep_corrupt=True))
    songs = feeds.read_song_data(spark, song_paths, recursive=recursive, keep_corrupt=True)
    songs = this.stage("songs", songs, compact=True)
    inputs = Feeds.prepare(log, songs, dialect)
    specs = {t.name: t for t in dialect.tables}
    fact = this.write(build_fact(inputs, dialect), specs["songplays"])
    for name, frame in build_dims(inputs, fact, dialect).items():
        this.write(frame, specs[name])
    return this.check_and_publish(fact, checks)


# Monthly loads --------------------------------------------------------------------------------------

# What is kept of a month for the dimensions. Seconds and user states are laid out by calendar month.
PROFILES = Table(
    "_profiles",
    "user_id BIGINT, first_name STRING, last_name STRING, gender STRING, level STRING, ts BIGINT",
)
PLAYED = Table("_played", "title STRING, artist_name STRING, duration DOUBLE")
HEARD = Table("_heard", "song_id STRING, artist_id STRING")
SECONDS = Table("_seconds", "start_time TIMESTAMP_NTZ, ts BIGINT, year INT, month INT", partition_by=("year", "month"))
STATES = Table(
    "_states",
    "timestamp BIGINT, user_id BIGINT, first_name STRING, last_name STRING, gender STRING, level STRING, ts BIGINT, "
    "year INT, month INT",
    partition_by=("year", "month"),
)


def seconds_summary(seen: DataFrame, dialect: Dialect) -> DataFrame:
    """Start times once each, with the ms of the first play; year and month beside them."""
    if dialect.grain == "epoch":
        known = seen.where("ts IS NOT NULL").groupBy(epoch_second("ts").alias("_s")).agg(F.min("ts").alias("ts"))
        rows = known.select(timestamp_from_millis("ts").alias("start_time"), "ts")
    else:
        rows = seen.where("start_time IS NOT NULL").select("start_time").distinct()
        rows = rows.withColumn("ts", F.lit(None).cast("bigint"))
    return facts.with_calendar(rows)


def _calendar_months(rows: DataFrame) -> list[tuple[int, int]]:
    """Calendar months of a table laid out by them; one row per month is fetched."""
    return sorted(tuple(r) for r in rows.select("year", "month").distinct().dropna().collect())


def _in_months(months: Sequence[tuple[int, int]]) -> str:
    return " OR ".join(f"(year = {y} AND month = {m})" for y, m in months) or "false"


def load_period(
    spark: SparkSession,
    log_template: str,
    song_paths: feeds.Paths,
    run_date: dt.date,
    root: str,
    dialect: Dialect = SCHEDULED,
    *,
    checks: Sequence[quality.Check] = (),
    recursive: bool = True,
    max_corrupt: int = 0,
    json_paths: Sequence[str] | None = None,
) -> Loaded:
    """Load one month, or load it again.

    The month's log is staged into typed columns by name, or by an ordered path list if one is given.

    The month's part of the fact and its summaries are replaced; users, songs and artists are rebuilt from the
    summaries of all months, and times for the calendar months the rows fall in. A play that another month
    has already brought is left to that month. A root that was loaded as a whole takes no monthly loads.
    """
    this = _Run(spark, root, dialect, max_corrupt)
    specs = {t.name: t for t in dialect.tables}
    if ("songplays", sinks.WHOLE) in this.base.paths:
        raise ValueError(f"{root} was loaded as a whole; load months into a root of their own")
    period = run_date.strftime("%Y-%m")
    staged = stage_period(
        spark, log_template, run_date, schemas.LOG, json_paths=json_paths, recursive=recursive, keep_corrupt=True
    )
    log = this.stage("log", staged)
    songs = feeds.read_song_data(spark, song_paths, recursive=recursive, keep_corrupt=True)
    songs = this.stage("songs", songs, compact=True)

    def others(table: Table) -> DataFrame:
        return sinks.read_runs(spark, root, this.base.of(table.name, [period]), table)

    played = replace(PLAYED, columns=", ".join(c for c in PLAYED.columns.split(", ") if c.split()[0] in dialect.keys))
    inputs = Feeds.prepare(log, songs, dialect, others(played) if dialect.scope == "played" else None)
    spec = specs["songplays"]
    fresh = build_fact(inputs, dialect)
    fact = this.write(_unknown(this, fresh, inputs, spec, period), spec, period)

    if dialect.scope == "played":
        this.write(played_keys(inputs.plays, dialect), played, period)
    if dialect.scope == "in_fact":
        this.write(fact.select("song_id", "artist_id").distinct(), HEARD, period)
    for name, frame in build_catalog(inputs, this.read(HEARD), dialect).items():
        this.write(frame, specs[name])

    seen = fact if dialect.times_from_fact else inputs.plays
    seconds = this.write(seconds_summary(seen, dialect), SECONDS, period)
    before = sinks.read_runs(spark, root, [p for k, p in this.base.paths.items() if k == (SECONDS.name, period)], SECONDS)
    months = sorted({*_calendar_months(seconds), *_calendar_months(before)})
    touched = this.read(SECONDS).where(_in_months(months))
    _write_months(this, build_times(touched, dialect), specs["times"], months)

    if dialect.users == "history":
        states = this.write(_states(inputs.users_source(dialect)), STATES, period)
        before = [p for k, p in this.base.paths.items() if k == (STATES.name, period)]
        months = sorted({*_calendar_months(states), *_calendar_months(sinks.read_runs(spark, root, before, STATES))})
        users = first_per_key(this.read(STATES).where(_in_months(months)), ["timestamp", "user_id"], ["ts"])
        _write_months(this, users.select(*specs["users"].column_names, "year", "month"), specs["users"], months)
    else:
        this.write(profile_summary(inputs.users_source(dialect), "user_id", dims.PROFILE, "ts"), PROFILES, period)
        this.write(dims.make_users(this.read(PROFILES), dialect.users), specs["users"])
    return this.check_and_publish(fact, checks)


def _unknown(this: _Run, fresh: DataFrame, inputs: Feeds, spec: Table, period: str) -> DataFrame:
    """Fact rows that no other month has brought; only the calendar months of the new rows are looked at."""
    held = this.base.of(spec.name, [period])
    if not held:
        return fresh
    months = _calendar_months(facts.with_calendar(inputs.plays.select("start_time")))
    stored = sinks.read_runs(this.spark, this.root, held, spec).where(_in_months(months))
    return fresh.join(stored.select(*spec.primary_key), list(spec.primary_key), "left_anti")


def _states(log: DataFrame) -> DataFrame:
    """The first profile of every user in every second, with its ms, laid out by calendar month."""
    known = log.where("user_id IS NOT NULL AND ts IS NOT NULL")
    rows = known.select(epoch_second("ts").alias("timestamp"), "user_id", *dims.PROFILE, "ts")
    first = first_per_key(rows, ["timestamp", "user_id"], ["ts"])
    return facts.with_calendar(first.withColumn("start_time", timestamp_from_millis("ts"))).drop("start_time")


def _write_months(this: _Run, rows: DataFrame, table: Table, months: Sequence[tuple[int, int]]) -> None:
    """Publish a table's rows of each calendar month as a period of their own."""
    for year, month in months:
        this.write(rows.where(_in_months([(year, month)])), table, f"{year:04d}-{month:02d}")
