import dataclasses
import datetime as dt

import pytest

from playmart import schemas, sinks
from playmart.__main__ import main
from playmart.operators import quality
from playmart.plans import etl
from playmart.sources import feeds
from tests.feeds import PLAYS, T0, play, song, write_feeds, write_lines


@pytest.fixture(scope="module")
def roots(tmp_path_factory):
    return write_feeds(tmp_path_factory.mktemp("feeds"))


def _load(spark, roots, out, dialect, **options):
    logs, songs = roots
    options = {"max_corrupt": 1, **options}  # the feed has one broken line
    return etl.run(spark, logs, songs, str(out), dialect, recursive=True, **options)


def _tables(spark, root, dialect):
    """The published tables."""
    now = sinks.current(spark, str(root))
    return {t.name: sinks.read_runs(spark, str(root), now.of(t.name), t) for t in dialect.tables}


def _rows(tables):
    return {name: sorted(map(repr, df.collect())) for name, df in tables.items()}


# songplays, users, songs, artists, times
EXPECTED = {
    "lake": (5, 3, 3, 2, 5),
    "warehouse": (8, 3, 4, 4, 5),
    "history": (9, 6, 5, 3, 5),
    "scheduled": (7, 4, 5, 5, 5),
}


@pytest.mark.parametrize("name", sorted(etl.DIALECTS))
def test_whole_load(spark, roots, tmp_path, name):
    dialect = etl.DIALECTS[name]
    loaded = _load(spark, roots, tmp_path, dialect)
    tables = _tables(spark, tmp_path, dialect)
    counts = tuple(tables[t].count() for t in ("songplays", "users", "songs", "artists", "times"))
    assert counts == EXPECTED[name]
    assert sinks.current(spark, str(tmp_path)).paths == loaded.paths
    durations = {r.duration for r in tables["songs"].collect()}
    assert (durations <= {100.0, 180.0, 200.0, 240.0}) == dialect.rounded
    fact = tables["songplays"]
    assert fact.select("songplay_id").distinct().count() == fact.count()


def test_keys_are_stable_between_runs(spark, roots, tmp_path):
    runs = []
    for _ in range(2):
        _load(spark, roots, tmp_path, etl.LAKE)
        runs.append(_rows(_tables(spark, tmp_path, etl.LAKE)))
    assert runs[0] == runs[1]


def test_plays_that_differ_anywhere_are_kept(spark, tmp_path):
    """Equal but for level or location; and texts that a separator or a NULL mark could confuse."""
    same = play(1, 0, "8", "Home", "Ada", 200.4, T0)
    rows = [same, same | {"level": "paid"}, same | {"location": "Bergen"}]
    rows += [play(2, 0, "9", "a|b", "c", 1.0, T0), play(2, 0, "9", "a", "b|c", 1.0, T0)]
    _, songs = write_feeds(tmp_path / "feeds")
    log = write_lines(tmp_path / "plays" / "x-events.json", rows)
    for name, expected in (("lake", 3), ("scheduled", 5)):
        dialect = etl.DIALECTS[name]
        etl.run(spark, log, songs, str(tmp_path / name), dialect, recursive=True)
        assert _tables(spark, tmp_path / name, dialect)["songplays"].count() == expected


def test_views_and_settings_of_the_caller_stay(spark, roots, tmp_path):
    spark.range(3).createOrReplaceTempView("users")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        named = quality.Check("named", "SELECT count(*) FROM users WHERE first_name IS NULL", (0,))
        _load(spark, roots, tmp_path, etl.LAKE, checks=[named])
        assert spark.table("users").columns == ["id"]
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        first = _tables(spark, tmp_path, etl.LAKE)["times"].agg({"start_time": "min"}).first()[0]
        assert str(first) == "2018-11-01 21:01:46"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.catalog.dropTempView("users")


def test_failed_check_publishes_nothing(spark, roots, tmp_path):
    check = quality.Check("no free users", "SELECT count(*) FROM users WHERE level = 'free'", (0,))
    with pytest.raises(quality.DataQualityError):
        _load(spark, roots, tmp_path, etl.LAKE, checks=[check])
    assert sinks.current(spark, str(tmp_path)).paths == {}
    good = quality.Check("named", "SELECT count(*) FROM users WHERE first_name IS NULL", (0,))
    before = _load(spark, roots, tmp_path, etl.LAKE, checks=[good])
    with pytest.raises(quality.DataQualityError):
        _load(spark, roots, tmp_path, etl.LAKE, checks=[check])
    assert sinks.current(spark, str(tmp_path)).paths == before.paths


def test_corrupt_rows_stop_a_load_or_are_put_aside(spark, roots, tmp_path):
    with pytest.raises(quality.DataQualityError, match="1 corrupt rows"):
        _load(spark, roots, tmp_path / "a", etl.LAKE, max_corrupt=0)
    loaded = _load(spark, roots, tmp_path / "b", etl.LAKE)
    assert loaded.rejected == {"log": 1, "songs": 0}
    aside = spark.read.text(f"{tmp_path}/b/runs/{loaded.run_id}/rejected/log").collect()
    assert [r.value for r in aside] == ['{"page": "NextSo']
    logs, songs = roots
    month = (logs + "/{year}/{month}", songs, dt.date(2018, 11, 1), str(tmp_path / "c"))
    with pytest.raises(quality.DataQualityError, match="1 corrupt rows"):
        etl.load_period(spark, *month)
    assert etl.load_period(spark, *month, max_corrupt=1).rejected == {"log": 1, "songs": 0}


def test_corrupt_rows_are_written_by_all_tasks(spark, tmp_path):
    feed = spark.createDataFrame([(f"broken {k}",) for k in range(8)], f"{feeds.CORRUPT} string").repartition(4)
    run = etl._Run(spark, str(tmp_path), etl.LAKE, max_corrupt=8)
    run.stage("log", feed)
    assert run.rejected == {"log": 8}
    aside = spark.read.text(f"{tmp_path}/runs/{run.run_id}/rejected/log")
    assert sorted(r.value for r in aside.collect()) == [f"broken {k}" for k in range(8)]
    assert len(aside.inputFiles()) > 1


@pytest.mark.parametrize("redelivered, more", [("dropped", 0), ("kept", 4)])
def test_redelivered_file(spark, tmp_path, redelivered, more):
    dialect = dataclasses.replace(etl.LAKE, redelivered=redelivered)
    feeds = write_feeds(tmp_path / "feeds")
    _load(spark, feeds, tmp_path / "a", dialect)
    write_lines(tmp_path / "feeds" / "logs" / "2018" / "11" / "copy-events.json", PLAYS[:6])
    _load(spark, feeds, tmp_path / "b", dialect)
    once, twice = (_tables(spark, tmp_path / r, dialect)["songplays"].count() for r in "ab")
    assert twice - once == (more and sum(p["page"] == "NextSong" and p["length"] != 239.6 and p["song"] != "Unknown" for p in PLAYS[:6]))


@pytest.mark.parametrize("name", sorted(etl.DIALECTS))
def test_monthly_loads(spark, tmp_path, name):
    """Two months, a month again, a song that comes late: as one whole load of the same files."""
    dialect = etl.DIALECTS[name]
    logs, songs = write_feeds(tmp_path / "feeds")
    december = [play(9, 0, "11", "Home", "Bob", 200.4, T0 + 40 * 86_400_000, first="Dan")]
    december += PLAYS[2:3]  # delivered again in the next month
    write_lines(tmp_path / "feeds" / "logs" / "2018" / "12" / "2018-12-11-events.json", december)
    root = str(tmp_path / "mart")

    def load(month):
        day = dt.date(2018, month, 1)
        etl.load_period(spark, logs + "/{year}/{month}", songs, day, root, dialect, max_corrupt=1)
        return _rows(_tables(spark, root, dialect))

    def whole(out):
        _load(spark, (logs, songs), tmp_path / out, dialect)
        return _rows(_tables(spark, tmp_path / out, dialect))

    november = load(11)
    both = load(12)
    assert len(both["songplays"]) == len(november["songplays"]) + 1
    assert load(11) == both
    write_lines(tmp_path / "feeds" / "songs" / "S" / "9" / "S9.json", [song("S9", "Unknown", "A9", "Zed", 90.0)])
    late = load(11)
    assert len(late["songplays"]) == len(both["songplays"]) + (dialect.how == "inner")
    assert load(12) == whole("whole")
    with pytest.raises(ValueError, match="as a whole"):
        etl.load_period(spark, logs, songs, dt.date(2018, 11, 1), str(tmp_path / "whole"), dialect)


def test_a_month_staged_by_path_list(spark, roots, tmp_path):
    logs, songs = roots
    results = []
    for name, paths in (("by_name", None), ("by_path", schemas.LOG_JSON_PATHS)):
        root = str(tmp_path / name)
        loaded = etl.load_period(
            spark, logs + "/{year}/{month}", songs, dt.date(2018, 11, 1), root, max_corrupt=1, json_paths=paths
        )
        assert loaded.rejected == {"log": 1, "songs": 0}
        results.append(_rows(_tables(spark, root, etl.SCHEDULED)))
    assert results[0] == results[1]


@pytest.mark.parametrize("name", ["scheduled", "history"])
def test_a_month_that_fails_changes_nothing(spark, roots, tmp_path, monkeypatch, name):
    dialect, root = etl.DIALECTS[name], str(tmp_path)
    logs, songs = roots

    def load(**options):
        day = dt.date(2018, 11, 1)
        etl.load_period(spark, logs + "/{year}/{month}", songs, day, root, dialect, max_corrupt=1, **options)

    load()
    before = sinks.current(spark, root), _rows(_tables(spark, root, dialect))
    with pytest.raises(quality.DataQualityError):
        load(checks=[quality.Check("never", "SELECT count(*) FROM users", (-1,))])
    assert (sinks.current(spark, root), _rows(_tables(spark, root, dialect))) == before

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="lost"):
        patched.setattr(sinks, "publish", crash)
        load()
    assert (sinks.current(spark, root), _rows(_tables(spark, root, dialect))) == before


def test_command_line(spark, roots, tmp_path):
    logs, songs = roots
    common = ["--songs", songs, "--max-corrupt", "1", "--root"]
    main(["load", "--logs", logs, "--recursive", "--style", "lake", *common, str(tmp_path / "a")])
    assert _tables(spark, tmp_path / "a", etl.LAKE)["songplays"].count() == EXPECTED["lake"][0]
    main(["month", "--logs", logs + "/{year}/{month}", "--date", "2018-11-01", *common, str(tmp_path / "b")])
    assert _tables(spark, tmp_path / "b", etl.SCHEDULED)["songplays"].count() == EXPECTED["scheduled"][0]


def test_empty_strings_become_null_only_where_asked(spark, roots, tmp_path):
    for name in ("history", "lake"):
        _load(spark, roots, tmp_path / name, etl.DIALECTS[name])
    history, lake = (_tables(spark, tmp_path / n, etl.DIALECTS[n])["artists"] for n in ("history", "lake"))
    assert history.where("artist_id = 'A2'").first().location is None
    assert lake.where("artist_id = 'A2'").first().location == ""
