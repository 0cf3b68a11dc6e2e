import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playmart import schemas
from playmart.functions import keys, text, times
from playmart.operators import dedupe, dims, facts, quality, reports, serving
from tests.feeds import PLAYS, SONGS, T0, UA_BARE, UA_MAC, UA_PHONE


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame([tuple(p[c.split()[0]] for c in schemas.LOG_FEED.split(", ")) for p in PLAYS], schemas.LOG_FEED)


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([tuple(s[c.split()[0]] for c in schemas.SONG_FEED.split(", ")) for s in SONGS], schemas.SONG_FEED)


@pytest.fixture(scope="module")
def plays(log):
    return facts.clean_log(log)


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


# functions


def test_time_conversions_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([(T0,), (-1,)], "ms BIGINT")
    out = df.select(
        times.timestamp_from_millis("ms").alias("a"), times.timestamp_from_seconds("ms").alias("b"),
        times.epoch_second("ms").alias("c"),
    )
    expected = [
        (dt.datetime(2018, 11, 1, 21, 1, 46, 796000), dt.datetime(2018, 11, 1, 21, 1, 46), T0 // 1000),
        (dt.datetime(1969, 12, 31, 23, 59, 59, 999000), dt.datetime(1969, 12, 31, 23, 59, 59), -1),
    ]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert [tuple(r) for r in out.collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weekday_conventions_and_names(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2018-11-04', DATE'2018-11-10')) AS d")  # Sunday first
    for convention in ("monday0", "sunday0", "sunday1"):
        number = times.weekday("d", convention)
        named = days.select(number.alias("n"), times.weekday_name(number, convention).alias("name"), F.date_format("d", "EEEE").alias("want"))
        assert all(r.name == r.want for r in named.collect())
    sunday = days.select(*[times.weekday("d", c) for c in ("monday0", "sunday0", "sunday1")]).first()
    assert tuple(sunday) == (6, 0, 1)
    with pytest.raises(ValueError):
        times.weekday("d", "friday")


def test_device_token(spark):
    df = spark.createDataFrame([(UA_MAC,), (UA_PHONE,), (UA_BARE,), ("x (Linux)",), (None,)], "ua STRING")
    got = [r[0] for r in df.select(text.device_token("ua")).collect()]
    assert got == ["Macintosh", "iPhone", "", "Linux", None]


def test_empty_to_null_and_to_bigint(spark):
    df = spark.createDataFrame([("", "8"), ("a", "8.0"), (None, ""), (" ", "x")], "a STRING, b STRING")
    assert [r.a for r in text.empty_to_null(df).collect()] == [None, "a", None, " "]
    assert [r[0] for r in df.select(text.to_bigint(F.col("b"))).collect()] == [8, 8, None, None]


def test_keys(spark, plays):
    keyed = plays.withColumn("k", keys.session_second_key("session_id", "start_time"))
    assert keyed.select("k").distinct().count() == plays.count() - 1  # two plays in one second collide
    stable = facts.with_stable_key(plays, "session_id", "item_in_session", "ts", "user_id")
    assert stable.select("songplay_id").distinct().count() == plays.count()
    again = facts.with_stable_key(plays.repartition(3), "session_id", "item_in_session", "ts", "user_id")
    assert rows(stable, "songplay_id") == rows(again, "songplay_id")
    nulls = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x STRING, y STRING")
    assert nulls.select(keys.natural_key("x", "y")).distinct().count() == 3
    assert nulls.select(keys.md5_concat(F.col("x"), F.col("y"))).where("1=1").first()[0] is None


# one row per key


def test_first_last_and_ties(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (2, None, "z"), (2, 5, "y")], "k INT, o INT, v STRING")
    assert rows(dedupe.first_per_key(df, ["k"], ["o"])) == [(1, 1, "a"), (2, None, "z")]
    assert rows(dedupe.last_per_key(df, ["k"], ["o"])) == [(1, 2, "c"), (2, 5, "y")]
    assert rows(dedupe.first_per_key(df.select("k"), ["k"], [])) == [(1,), (2,)]


def test_reduction_happens_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "cast(id AS string) AS v")
    plan = dedupe.last_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")  # printed below the exchange


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "k INT, v STRING")
    source = spark.createDataFrame([(1, "new", 1), (2, "b", 2), (2, "a", 1), (None, "n", 1)], "k INT, v STRING, o INT")
    fresh = dedupe.insert_if_absent(source, target, ["k"], ["o"])
    assert rows(fresh) == [(2, "a", 1)]
    again = dedupe.insert_if_absent(source, target.unionByName(fresh.drop("o")), ["k"], ["o"])
    assert again.count() == 0


def test_upsert(spark):
    target = spark.createDataFrame([(1, "old"), (3, "kept")], "k INT, v STRING")
    writes = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k INT, v STRING, o INT")
    assert rows(dedupe.upsert(target, writes, ["k"], ["o"])) == [(1, "b"), (2, "c"), (3, "kept")]


def test_cascade_delete_keeps_null_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id INT, ref INT")
    gone = spark.createDataFrame([(10,), (10,)], "id INT")
    assert rows(dedupe.cascade_delete(child, gone, ["ref"], ["id"])) == [(2, 20), (3, None)]


def test_hot_key_gives_the_same_result(spark):
    """A third of all rows in one key: same answer as a plain window."""
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "hash(id) AS o", "cast(id AS string) AS v")
    got = dedupe.first_per_key(df, ["k"], ["o"])
    df.createOrReplaceTempView("hot")
    want = spark.sql("SELECT k, o, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o, v) rn FROM hot) WHERE rn = 1")
    assert rows(got) == rows(want)


def test_one_row_per_key_against_brute_force(spark):
    rng = random.Random(7)
    values = [None, "a", "b", "c"]
    table = [(rng.randrange(40), rng.choice([None, 1, 2, 3]), rng.choice(values), i % 2) for i in range(2000)]
    df = spark.createDataFrame(table, "k INT, o INT, v STRING, late INT").repartition(5)

    def rank(row):  # NULL lowest, then by order and by the remaining column
        return row[1] is not None, row[1] or 0, row[2] is not None, row[2] or ""

    def brute(rows_in, pick):
        groups = {}
        for row in rows_in:
            groups.setdefault(row[0], []).append(row[:3])
        return {k: pick(g, key=rank) for k, g in groups.items()}

    def got(frame):
        found = {r.k: (r.k, r.o, r.v) for r in frame.collect()}
        assert len(found) == frame.count()
        return found

    early, late = [r for r in table if not r[3]], [r for r in table if r[3] and r[0] % 3]
    before = df.where("late = 0 AND k % 2 = 0").drop("late")
    after = df.where("late = 1 AND k % 3 <> 0").drop("late")
    assert got(dedupe.first_per_key(df.drop("late"), ["k"], ["o"])) == brute(table, min)
    assert got(dedupe.last_per_key(df.drop("late"), ["k"], ["o"])) == brute(table, max)
    held = brute([r for r in early if r[0] % 2 == 0], min)
    target = dedupe.first_per_key(before, ["k"], ["o"])
    new = {k: r for k, r in brute(late, min).items() if k not in held}
    assert got(dedupe.insert_if_absent(after, target, ["k"], ["o"])) == new
    assert got(dedupe.upsert(target, after, ["k"], ["o"])) == held | brute(late, max)


# facts


def test_clean_log(plays):
    assert plays.count() == 7
    assert {"user_id", "first_name", "session_id", "item_in_session", "user_agent"} <= set(plays.columns)
    first = plays.where("session_id = 1 AND item_in_session = 0").first()
    assert first.start_time == dt.datetime(2018, 11, 1, 21, 1, 46) and first.user_id == 8


def test_match_variants(plays, catalog):
    three = facts.make_songplays(plays, catalog)
    assert rows(three, "session_id", "song_id") == [(1, "S1"), (1, "S2"), (1, "S3"), (3, "S1"), (5, "S1")]
    two = facts.make_songplays(plays, catalog, keys=facts.TITLE_ARTIST)  # both 'Away' rows match both songs
    assert two.count() == 3 + 1 + 2 * 2
    left = facts.make_songplays(plays, catalog, how="left")
    assert left.count() == 7 and left.where("song_id IS NULL").count() == 2
    rounded = facts.make_songplays(plays, catalog, how="left", rounded=True)
    assert rows(rounded.where("session_id = 2"), "song_id") == [("S4",), (None,)]


def test_fact_location(plays, catalog):
    user = facts.make_songplays(plays, catalog)
    assert {r.location for r in user.collect()} == {"Oslo, Norway"}
    artist = facts.make_songplays(plays, catalog, location_from="artist")
    assert {r.location for r in artist.collect()} == {"Oslo", "", "Bergen"}


def test_distinct_fact(plays, catalog):
    doubled = plays.unionByName(plays)
    once = facts.make_songplays(plays, catalog, keys=facts.TITLE_ARTIST, distinct=True)
    twice = facts.make_songplays(doubled, catalog, keys=facts.TITLE_ARTIST, distinct=True)
    assert rows(once) == rows(twice)
    assert facts.make_songplays(doubled, catalog, keys=facts.TITLE_ARTIST).count() == 2 * 8


def test_distinct_rows_cut_to_some_columns(spark):
    """As many rows as all columns tell apart, wherever the NULLs stand."""
    data = [("a", "x", None), ("a", None, "x"), ("a", "x", None), (None, "a", "x"), ("a", "", "x"), ("b", "x", "x"),
            ("a", None, None), ("a", "", ""), ("a", "", None), ("a", "xx", ""), ("a", "x", "x"), ("b", "x", "x")]
    df = spark.createDataFrame(data, "k string, v string, w string")
    assert rows(facts.distinct_rows(df)) == rows(df.distinct())
    for only in (["k"], ["w", "k"], ["k", "v", "w"]):
        assert rows(facts.distinct_rows(df, only)) == rows(df.distinct().select(*only))
    assert facts.distinct_rows(df.limit(0), ["k"]).count() == 0


def test_look_up_never_multiplies(plays, catalog):
    enriched = facts.enrich_first(plays, catalog, facts.TITLE_ARTIST)
    assert enriched.count() == plays.count()
    assert rows(enriched.where("session_id = 2"), "song_id") == [("S3",), (None,)]


def test_match_through_unique_artist_name(spark, plays, catalog):
    """Songs filed under another name of an artist do not match: the artist row kept decides the name."""
    renamed = catalog.withColumn("artist_name", F.expr("CASE song_id WHEN 'S1' THEN 'Ada B.' ELSE artist_name END"))
    songs = facts.songs_with_artist(dims.make_songs_unique(renamed), dims.make_artists(renamed))
    assert rows(facts.make_songplays(plays, songs), "song_id") == [("S2",)]


# dimensions


def test_songs_and_artists(plays, catalog):
    played = dims.played_songs(catalog, plays)
    assert rows(played, "song_id") == [("S1",), ("S2",), ("S3",)]
    assert rows(dims.make_artists(catalog), "artist_id", "location") == [("A1", "Oslo"), ("A2", ""), ("A3", "Rome")]
    assert dims.make_artists_distinct(catalog).where("artist_id = 'A1'").count() == 3
    broken = catalog.unionByName(catalog.limit(1).withColumn("song_id", F.lit(None).cast("string")))
    assert dims.make_songs_unique(broken).count() == len(SONGS)
    nameless = catalog.withColumn("artist_name", F.lit(None).cast("string"))
    assert dims.make_artists(nameless).count() == 0


def test_users_latest_keeps_users_that_share_a_time(plays):
    users = dims.make_users(plays, "latest")
    assert rows(users, "user_id", "level") == [(10, "free"), (8, "paid"), (9, "free")]


def test_users_ties(spark, plays):
    tied = plays.unionByName(plays.where("session_id = 3").withColumn("level", F.lit("trial")))
    assert dims.make_users(tied, "at_last").where("user_id = 8").count() == 2
    assert dims.make_users(tied, "latest").where("user_id = 8").first().level == "trial"


def test_users_history_distinct_and_changes(log, plays):
    history = dims.make_users(plays, "history", ["session_id", "item_in_session"])
    assert history.where("user_id = 8").count() == 3  # two plays share a second
    assert rows(dims.make_users(plays, "distinct"), "user_id", "level") == [(10, "free"), (8, "free"), (8, "paid"), (9, "free")]
    everyone = facts.rename_log(log)
    assert rows(reports.users_with_changes(everyone, dims.PROFILE)) == [(8,)]
    assert dims.make_users(everyone, "at_last").where("user_id IS NULL").count() == 0
    with pytest.raises(ValueError):
        dims.make_users(plays, "newest")
    fact = plays.select(times.epoch_second("ts").alias("timestamp"), "user_id", "song")
    assert reports.plays_with_profile(fact, history).count() == plays.count()


def test_times(plays):
    dim = dims.make_times(plays)
    assert dim.count() == 5
    row = dim.where("day = 1 AND hour = 21").orderBy("start_time").first()
    assert (row.day_of_year, row.week, row.month, row.year, row.weekday) == (305, 44, 11, 2018, 5)
    epoch = dims.make_times_epoch(plays)
    first = epoch.where(F.col("timestamp") == T0 // 1000).first()
    assert first.start_time == "21:01:46.796" and first.weekday == 3
    assert rows(reports.duplicates(epoch, "start_time")) == [("21:01:46.796", 2)]
    assert dict(dims.make_times_text(plays).dtypes)["month"] == "string"


# reports


def test_reports(spark, plays, catalog):
    fact = facts.make_songplays(plays, catalog, location_from="artist")
    artists, songs = dims.make_artists(catalog), dims.make_songs_unique(catalog)
    assert rows(reports.popular_artists(fact, artists, 1)) == [("A1", "Ada", 4)]
    # artists table with two rows of one name: counts are multiplied, as a plain join would
    assert reports.popular_artists(fact, artists.unionByName(artists), 1).first().requests_count == 8
    assert reports.popular_songs(fact, songs, artists, 1).first().song_title == "Home"
    nulled = text.empty_to_null(fact)
    assert tuple(reports.location_counts(nulled).first()) == (4, 2)
    assert rows(reports.plays_by_location(nulled)) == [("Bergen", 1), ("Oslo", 3), (None, 0)]
    assert [r.location for r in reports.top_locations(nulled, 2).collect()] == ["Oslo", "Bergen"]
    assert tuple(reports.location_counts(fact.where("false")).first()) == (0, 0)
    assert rows(reports.plays_by_device(plays)) == [("", 1), ("Macintosh", 5), ("iPhone", 1)]
    dim = dims.make_times(fact, "sunday0")
    assert rows(reports.plays_by_hour(fact, dim)) == rows(reports.plays_by_hour(fact)) == [(21, 5)]
    assert rows(reports.plays_by_weekday(fact, dim, "sunday0")) == rows(reports.plays_by_weekday(fact, convention="sunday0"))
    assert rows(reports.plays_by_weekday(fact, dim, "sunday0"), "weekday_name", "requests") == [("Friday", 2), ("Thursday", 3)]
    assert rows(reports.row_counts({"a": fact, "b": artists})) == [("a", 5), ("b", 3)]


def test_reports_on_counted_facts(spark, plays, catalog):
    doubled = plays.unionByName(plays).unionByName(plays.withColumn("user_agent", F.lit(None).cast("string")))
    artists, songs = dims.make_artists(catalog), dims.make_songs_unique(catalog)
    for how in ("inner", "left"):
        fact = facts.make_songplays(doubled, catalog, how=how)

        def counted(column):
            return facts.count_songplays(doubled, catalog, [column], how=how)

        assert rows(reports.popular_artists(fact, artists)) == rows(
            reports.popular_artists(counted("artist_id"), artists, weight="plays")
        )
        assert rows(reports.popular_songs(fact, songs, artists)) == rows(
            reports.popular_songs(counted("song_id"), songs, artists, weight="plays")
        )
        for report in (reports.plays_by_user_agent, reports.plays_by_device):
            assert rows(report(fact)) == rows(report(counted("user_agent"), "plays"))


# serving


def test_serving_tables(plays):
    items = serving.build_serving(plays.unionByName(plays.withColumn("ts", F.col("ts") + 1).withColumn("artist", F.lit("Eve"))), schemas.SESSION_ITEMS, ["ts"])
    assert items.count() == plays.count()  # last write wins
    assert serving.session_item(items, 1, 3).collect() == [("Eve", "Away", 180.0)]
    playlist = serving.build_serving(plays, schemas.USER_SESSION, ["ts"])
    assert [r.item_in_session for r in serving.user_session(playlist, 8, 1).collect()] == [0, 2, 3]
    listeners = serving.build_serving(plays, schemas.SONG_LISTENERS, ["ts"])
    assert rows(serving.song_listeners(listeners, "Home")) == [("Ann", "Lee"), ("Cat", "Lee")]
    same_name = plays.withColumn("first_name", F.lit("Ann"))
    assert serving.song_listeners(serving.build_serving(same_name, schemas.SONG_LISTENERS, ["ts"]), "Home").count() == 2


# quality


def test_expected_results(spark):
    spark.createDataFrame([(None,), ("Ann",)], "first_name STRING").createOrReplaceTempView("people")
    vacuous = "SELECT count(first_name) FROM people WHERE first_name IS NULL"
    meant = "SELECT count(*) FROM people WHERE first_name IS NULL"
    assert len(quality.run_checks(spark, quality.pair_checks([vacuous], [(0,)]))) == 1
    with pytest.raises(quality.DataQualityError, match="expected \\(0,\\), got \\(1,\\)"):
        quality.run_checks(spark, quality.pair_checks([vacuous, meant], [(0,), (0,)]))
    with pytest.raises(ValueError, match="2 queries but 1"):
        quality.pair_checks([vacuous, meant], [(0,)])
    with pytest.raises(quality.DataQualityError):
        quality.run_checks(spark, [quality.Check("none", "SELECT 1 WHERE false", (1,))])


def test_constraints(spark):
    songs = spark.createDataFrame([("S1", "a", "A1", 1, 1.0), ("S1", None, "A9", 1, 1.0)], schemas.SONGS.columns)
    artists = spark.createDataFrame([("A1", "Ada", None, None, None)], schemas.ARTISTS.columns)
    report = quality.constraint_checks({"songs": songs, "artists": artists}, [schemas.SONGS, schemas.ARTISTS])
    failed = {r.name: r.actual for r in report.collect() if not r.passed}
    assert failed == {"songs.title not null": 1, "songs primary key": 2, "songs -> artists": 1}
    with pytest.raises(quality.DataQualityError, match="songs -> artists"):
        quality.enforce(report)
    quality.enforce(quality.constraint_checks({"artists": artists}, [schemas.ARTISTS]))


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([("x",), ("x",), (None,), ("p",)], "r STRING")
    parent = spark.createDataFrame([("p",)], "id STRING")
    assert rows(quality.orphan_counts(child, parent, ["r"], ["id"])) == [("x", 2)]


def test_load_order():
    names = [t.name for t in schemas.load_order([schemas.SONGPLAYS, schemas.SONGS, schemas.ARTISTS, schemas.USERS, schemas.TIMES])]
    assert names.index("artists") < names.index("songs") < names.index("songplays") == 4
