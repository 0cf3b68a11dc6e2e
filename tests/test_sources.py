import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from playmart import schemas, sinks
from playmart.sources import feeds, staging
from tests.feeds import PLAYS, SONGS, T0, play, song, write_feeds, write_lines


@pytest.fixture(scope="module")
def roots(tmp_path_factory):
    return write_feeds(tmp_path_factory.mktemp("feeds"))


def test_songs_by_glob_and_recursive(spark, roots):
    _, songs = roots
    by_glob = feeds.read_song_data(spark, f"{songs}/*/*/*.json")
    recursive = feeds.read_song_data(spark, songs, recursive=True)
    assert by_glob.schema.simpleString() == recursive.schema.simpleString()
    assert by_glob.count() == recursive.count() == len(SONGS)
    assert [f.name for f in by_glob.schema] == [c.split()[0] for c in schemas.SONG_FEED.split(", ")]


def test_corrupt_lines_are_kept_apart(spark, roots, tmp_path):
    logs, _ = roots
    raw = feeds.read_log_data(spark, f"{logs}/*/*/*-events.json", keep_corrupt=True)
    raw.write.parquet(str(tmp_path / "staged"))
    good, bad = feeds.split_corrupt(spark.read.schema(raw.schema).parquet(str(tmp_path / "staged")))
    assert good.count() == len(PLAYS)
    assert bad.count() == 1


def test_file_count_reads_no_content(spark, roots):
    logs, songs = roots
    assert feeds.list_files(spark, songs).count() == len(SONGS)
    assert feeds.list_files(spark, [logs, songs]).count() == len(SONGS) + 2


def test_path_selection(spark, roots, tmp_path):
    logs, songs = roots
    one = f"{logs}/2018/11/2018-11-01-events.json"
    assert feeds.read_log_data(spark, one).count() == 6
    prefix = feeds.paths_from_prefix(f"{logs}/2018/11/2018-11-0")
    assert feeds.read_log_data(spark, prefix, recursive=True).count() == len(PLAYS) + 1
    top = feeds.paths_from_prefix(f"{logs}/20")
    assert feeds.read_log_data(spark, top, recursive=True).count() == len(PLAYS) + 1
    manifest = tmp_path / "manifest"
    manifest.write_text(json.dumps({"entries": [{"url": one, "mandatory": True}]}))
    assert feeds.read_log_data(spark, feeds.paths_from_manifest(spark, str(manifest))).count() == 6


CSV_HEADER = "artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,registration,sessionId,song,status,ts,userId"


def _csv(path, *lines):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([CSV_HEADER, *lines]) + "\n")


def test_event_csv(spark, tmp_path):
    _csv(
        tmp_path / "e" / "a.csv",
        ",Logged In,Ann,F,0,Lee,,free,\"Oslo, Norway\",GET,Home,1.54092E+12,38,,200,1.54111E+12,39",
        'NA,Logged In,Ann,F,1,Lee,200.4,free,"Oslo, Norway",PUT,NextSong,1.54E+12,38,"Say ""hi""",200,1.54111E+12,39',
    )
    _csv(tmp_path / "e" / "b.csv", "Ada,Logged In,Ben,M,0,Lee,10,paid,Rome,PUT,NextSong,1.54E+12,40,Home,200,1.5E+12,9.0")
    events = feeds.read_event_csv(spark, f"{tmp_path}/e/*.csv")
    assert events.count() == 3
    first = events.where("sessionId = 38 AND itemInSession = 0").first()
    assert first.ts == 1.54111e12 and first.userId == 39 and first.location == "Oslo, Norway"

    kept = feeds.consolidate_events(events)
    assert kept.columns == schemas.CONSOLIDATED_COLUMNS
    rows = {r.sessionId: r for r in kept.collect()}
    assert rows[38].artist == "NA" and rows[38].song == 'Say "hi"'  # only empty text is missing
    assert rows[40].userId == 9

    sinks.write_csv(kept, f"{tmp_path}/out")
    back = feeds.read_consolidated_csv(spark, f"{tmp_path}/out")
    assert back.columns == [c.lower() for c in schemas.CONSOLIDATED_COLUMNS]
    assert dict(back.dtypes)["iteminsession"] == "bigint" and dict(back.dtypes)["length"] == "double"
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, kept.collect()))


def test_event_csv_with_other_column_order_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("auth,artist\nLogged In,Ada\n")
    with pytest.raises(Exception, match="header|schema|HEADER|columns"):
        feeds.read_event_csv(spark, str(tmp_path / "x.csv")).collect()


def test_stage_by_name_exact_and_ignoring_case(spark, tmp_path):
    row = play(1, 0, "8", "Home", "Ada", 200.4, T0)
    other = {k.lower(): v for k, v in play(2, 0, "9", "Away", "Ada", 1.0, T0).items()}
    path = write_lines(tmp_path / "l.json", [row, other])
    exact = {r.sessionId: r for r in staging.stage_by_name(spark, path, schemas.STAGING_EVENTS).collect()}
    assert exact[1].userId == 8 and exact[1].length == 200.4 and exact[1].userAgent is not None
    assert None in exact  # sessionid does not match sessionId
    loose = staging.stage_by_name(spark, path, schemas.STAGING_EVENTS, ignore_case=True)
    rows = {r.sessionId: r for r in loose.collect()}
    assert rows[1].userId == 8 and rows[2].userId == 9 and rows[2].ts == T0
    assert loose.schema == schemas.STAGING_EVENTS.schema
    assert rows[1].registration == 1540344794796.0


def test_logged_out_user_is_null(spark, tmp_path):
    path = write_lines(tmp_path / "l.json", [play(4, 0, "", None, None, None, T0, page="Home")])
    assert staging.stage_by_name(spark, path, schemas.STAGING_EVENTS).first().userId is None


def test_rounded_staging(spark, tmp_path):
    path = write_lines(tmp_path / "s.json", [song("S1", "a", "A", "b", 75.5, lat=-0.5), song("S2", "a", "A", "b", 76.5)])
    rows = {r.song_id: r for r in staging.stage_by_name(spark, path, schemas.STAGING_SONGS_ROUNDED).collect()}
    assert rows["S1"].duration == 76 and rows["S2"].duration == 77 and rows["S1"].artist_latitude == -1


def test_stage_by_paths(spark, tmp_path):
    path = write_lines(tmp_path / "l.json", PLAYS)
    config = tmp_path / "paths.json"
    config.write_text(json.dumps({"jsonpaths": schemas.LOG_JSON_PATHS}))
    paths = staging.read_path_list(spark, str(config))
    by_path = staging.stage_by_paths(spark, path, schemas.STAGING_EVENTS, paths)
    by_name = staging.stage_by_name(spark, path, schemas.STAGING_EVENTS)
    assert sorted(map(repr, by_path.collect())) == sorted(map(repr, by_name.collect()))
    with pytest.raises(ValueError):
        staging.stage_by_paths(spark, path, schemas.STAGING_EVENTS, paths[:3])


def test_nested_paths(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 7}, "c": "x"}')], "id INT, j STRING")
    table = schemas.Table("t", "b INT, c STRING")
    out = staging.extract_json_paths(df, "j", ["$.a.b", "$['c']"], table, keep=["id"])
    assert out.collect() == [(1, 7, "x")]


def test_stage_period(spark, roots):
    logs, songs = roots
    template = logs + "/{year}/{month}"
    month = staging.stage_period(spark, template, dt.date(2018, 11, 5), schemas.STAGING_EVENTS)
    assert month.where(F.col("page").isNotNull()).count() == len(PLAYS)
    fixed = staging.stage_period(spark, songs, dt.date(2018, 11, 5), schemas.STAGING_SONGS, templated=False)
    assert fixed.count() == len(SONGS)
    assert staging.period_path("x/{year}/{month}", dt.date(2019, 3, 1)) == "x/2019/03"
