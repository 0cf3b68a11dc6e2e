"""The same queries as plain SQL for an independent engine, written from the definitions, not the plans."""

from __future__ import annotations

from playmart.plans.queries import DELETED_REGION, INSERT_CUT, LOOKUP_ITEM, LOOKUP_SESSION, LOOKUP_SONG, UPSERT_CUT

FEEDS = """
WITH play_log AS (
  SELECT
    CASE WHEN l.l_linestatus = 'F' THEN concat('Artist ', CAST(p.p_partkey // 64 AS VARCHAR)) END AS artist,
    CASE WHEN l.l_linestatus = 'F' OR o.o_orderstatus <> 'P' THEN 'Logged In' ELSE 'Logged Out' END AS auth,
    split_part(c.c_name, '#', 1) AS first_name,
    c.c_mktsegment AS gender,
    CAST(l.l_linenumber AS BIGINT) AS item_in_session,
    split_part(c.c_name, '#', 2) AS last_name,
    CASE WHEN l.l_linestatus = 'F' THEN floor(p.p_retailprice * 2) / 2 END AS length,
    o.o_orderpriority AS level,
    n.n_name AS location,
    CASE WHEN l.l_linestatus = 'F' THEN 'PUT' ELSE 'GET' END AS method,
    CASE WHEN l.l_linestatus = 'F' THEN 'NextSong' ELSE 'Home' END AS page,
    l.l_orderkey AS session_id,
    CASE WHEN l.l_linestatus = 'F' THEN p.p_name END AS song,
    epoch_us(o.o_orderdate) // 1000 + (l.l_linenumber // 2) * 20014123 AS ts,
    concat('Mozilla/5.0 (',
      CASE l.l_returnflag WHEN 'A' THEN 'Macintosh; Intel Mac OS X 10_9_4'
                          WHEN 'N' THEN 'Windows NT 6.1; WOW64' ELSE 'X11; Linux x86_64' END,
      ') AppleWebKit/537.36') AS user_agent,
    CASE WHEN l.l_linestatus = 'F' OR o.o_orderstatus <> 'P' THEN o.o_custkey END AS user_id,
    l.l_partkey AS w1, l.l_suppkey AS w2, l.l_extendedprice AS w3
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
plays AS (
  SELECT *, make_timestamp((ts - ts % 1000) * 1000) AS start_time, make_timestamp(ts * 1000) AS start_milli
  FROM play_log WHERE page = 'NextSong'
),
song_catalog AS (
  SELECT concat('AR', CAST(p_partkey // 64 AS VARCHAR)) AS artist_id,
    CAST(p_size AS DOUBLE) AS artist_latitude,
    CASE p_type WHEN 'SMALL' THEN '' WHEN 'ECONOMY' THEN NULL ELSE p_type END AS artist_location,
    CAST(-p_size AS DOUBLE) AS artist_longitude,
    concat('Artist ', CAST(p_partkey // 64 AS VARCHAR)) AS artist_name,
    floor(p_retailprice * 2) / 2 AS duration,
    concat('SO', CAST(p_partkey AS VARCHAR)) AS song_id,
    CASE WHEN p_size > 40 OR (p_partkey // 64) % 7 = 3 THEN concat(p_name, ' (Demo)') ELSE p_name END AS title,
    CAST(1970 + p_size AS BIGINT) AS year
  FROM part
),
artists_first AS (
  SELECT artist_id, artist_name AS name, artist_location AS location FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS rn FROM song_catalog
  ) WHERE rn = 1
),
song_artist AS (
  SELECT s.song_id, s.title, s.artist_id, s.year, s.duration, a.name AS artist_name, a.location AS artist_location
  FROM song_catalog s JOIN artists_first a ON s.artist_id = a.artist_id
),
lake_fact AS (
  SELECT p.start_time, p.user_id, p.level, s.song_id, s.artist_id, p.session_id, p.location, p.user_agent
  FROM plays p JOIN song_artist s
    ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration
),
place_fact AS (
  SELECT DISTINCT p.start_milli AS start_time, p.user_id, p.level, s.song_id, s.artist_id, p.session_id,
    s.artist_location AS location, p.user_agent
  FROM plays p JOIN song_catalog s ON p.song = s.title AND p.artist = s.artist_name
),
event_ms AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events
),
event_plays AS (
  SELECT event_id, ms, make_timestamp(ms * 1000) AS start_milli,
    make_timestamp((ms // 1000) * 1000000) AS start_time FROM event_ms
)
"""

_FACT = "p.start_time, p.user_id, p.level, s.song_id, s.artist_id, p.session_id, p.location, p.user_agent"

_CALENDAR = """CAST(hour({t}) AS INTEGER) AS hour, CAST(day({t}) AS INTEGER) AS day,
  CAST(week({t}) AS INTEGER) AS week, CAST(month({t}) AS INTEGER) AS month, CAST(year({t}) AS INTEGER) AS year"""


def _serving(keys: str, values: str) -> str:
    return f"""SELECT {keys}, {values} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, w1 DESC, w2 DESC, w3 DESC) AS rn FROM plays
) WHERE rn = 1"""


_SESSION_ITEMS = _serving("session_id, item_in_session", "artist, song, length")
_USER_SESSION = _serving("user_id, session_id, item_in_session", "artist, song, first_name, last_name")
_LISTENERS = _serving("song, user_id", "first_name, last_name")

_HISTORY = """SELECT timestamp, user_id, first_name, last_name, gender, level FROM (
  SELECT ts // 1000 AS timestamp, user_id, first_name, last_name, gender, level,
    row_number() OVER (PARTITION BY ts // 1000, user_id ORDER BY ts, w1, w2, w3) AS rn FROM plays
) WHERE rn = 1"""

_ARTIST_ROWS = """artist_id, artist_name AS name, artist_location AS location,
  artist_latitude AS latitude, artist_longitude AS longitude"""

# The dimensions of the distinct 2-key fact: every distinct row whose key is in it.
_PLACE_ARTISTS = f"""SELECT DISTINCT {_ARTIST_ROWS} FROM song_catalog
  WHERE artist_id IN (SELECT artist_id FROM place_fact)"""
_PLACE_SONGS = """SELECT DISTINCT song_id, title, artist_id, year, duration FROM song_catalog
  WHERE (song_id, artist_id) IN (SELECT (song_id, artist_id) FROM place_fact)"""
_PLAYED = """EXISTS (SELECT 1 FROM plays p WHERE p.song = s.title AND p.artist = s.artist_name
  AND p.length = s.duration)"""


def _nulls(*columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM play_log" for c in columns
    )


_QUERIES: dict[str, str] = {
    # Facts
    "songplays_inner3": """SELECT *, CAST(year(start_time) AS INTEGER) AS year,
  CAST(month(start_time) AS INTEGER) AS month FROM lake_fact""",
    "songplays_inner2_distinct": "SELECT * FROM place_fact",
    "songplays_left3": f"""SELECT {_FACT} FROM plays p LEFT JOIN song_catalog s
  ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration""",
    "songplays_right2": f"""SELECT {_FACT} FROM song_artist s RIGHT JOIN plays p
  ON s.title = p.song AND s.artist_name = p.artist""",
    "songplays_left_rounded": f"""SELECT {_FACT} FROM plays p LEFT JOIN song_catalog s
  ON p.song = s.title AND p.artist = s.artist_name
  AND CAST(p.length AS DECIMAL(18,0)) = CAST(s.duration AS DECIMAL(18,0))""",
    "lookup_enrich_first": f"""SELECT {_FACT} FROM plays p LEFT JOIN (
    SELECT title, artist_name, duration, song_id, artist_id,
      row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id) AS rn FROM song_catalog
  ) s ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration AND s.rn = 1""",
    "songplay_md5_key": """SELECT md5(CAST(session_id AS VARCHAR) || strftime(start_time, '%Y-%m-%d %H:%M:%S'))
    AS songplay_id, session_id, item_in_session, start_time FROM plays""",
    "songplay_stable_key": """SELECT md5(CAST(to_json(struct_pack(session_id := session_id,
    item_in_session := item_in_session, ts := ts, user_id := user_id, w1 := w1, w2 := w2)) AS VARCHAR))
    AS songplay_id, session_id, item_in_session, ts FROM play_log""",
    # Dimensions
    "clean_log": """SELECT artist, auth, first_name, gender, item_in_session, last_name, length, level, location,
  method, page, session_id, song, ts, user_agent, user_id, start_time FROM plays""",
    "plays_with_artist": """SELECT artist, first_name AS "firstName", gender, item_in_session AS "itemInSession",
  last_name AS "lastName", length, level, location, session_id AS "sessionId", song, user_id AS "userId"
  FROM play_log WHERE artist IS NOT NULL""",
    "songs_all": "SELECT DISTINCT song_id, title, artist_id, year, duration FROM song_catalog",
    "songs_played_semi": f"SELECT song_id, title, artist_id, year, duration FROM song_catalog s WHERE {_PLAYED}",
    "songs_played": """SELECT DISTINCT song_id, title, artist_id, year, duration FROM song_catalog
  WHERE (song_id, artist_id) IN (SELECT (song_id, artist_id) FROM place_fact)""",
    "songs_with_artist": "SELECT * FROM song_artist",
    "artists_played": f"""SELECT {_ARTIST_ROWS} FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS rn FROM song_catalog s WHERE {_PLAYED}
  ) WHERE rn = 1""",
    "artists_distinct": f"SELECT DISTINCT {_ARTIST_ROWS} FROM song_catalog",
    "artists_played_distinct": f"""SELECT DISTINCT {_ARTIST_ROWS} FROM song_catalog
  WHERE artist_id IN (SELECT artist_id FROM place_fact)""",
    "users_latest": """SELECT user_id, first_name, last_name, gender, level FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, first_name DESC, last_name DESC,
      gender DESC, level DESC) AS rn FROM plays WHERE user_id IS NOT NULL
  ) WHERE rn = 1""",
    "users_latest_max_window": """SELECT DISTINCT user_id, first_name, last_name, gender, level FROM (
    SELECT *, max(ts) OVER (PARTITION BY user_id) AS max_ts FROM plays
  ) WHERE ts = max_ts AND user_id IS NOT NULL""",
    "users_max_join": """SELECT DISTINCT user_id, first_name, last_name, gender, level FROM (
    SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS recency FROM play_log WHERE user_id IS NOT NULL
  ) WHERE recency = 1""",
    "users_distinct": """SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays
  WHERE user_id IS NOT NULL""",
    "users_history": _HISTORY,
    "time_dim": f"""SELECT DISTINCT start_time, {_CALENDAR.format(t="start_time")},
  CAST(dayofyear(start_time) AS INTEGER) AS day_of_year,
  CAST(dayofweek(start_time) + 1 AS INTEGER) AS weekday_sun1, CAST(dayofweek(start_time) AS INTEGER) AS weekday_sun0,
  CAST(isodow(start_time) - 1 AS INTEGER) AS weekday_mon0 FROM event_plays""",
    "time_dim_epoch": f"""SELECT timestamp, strftime(played_at, '%H:%M:%S.%g') AS start_time, {_CALENDAR.format(t="played_at")},
  CAST(isodow(played_at) - 1 AS INTEGER) AS weekday
  FROM (SELECT ms // 1000 AS timestamp, min(start_milli) AS played_at FROM event_plays GROUP BY ms // 1000)""",
    "time_dim_text": """SELECT DISTINCT start_time, CAST(hour(start_time) AS INTEGER) AS hour,
  CAST(day(start_time) AS INTEGER) AS day, CAST(week(start_time) AS INTEGER) AS week,
  CAST(month(start_time) AS VARCHAR) AS month, CAST(year(start_time) AS INTEGER) AS year,
  CAST(dayofweek(start_time) AS VARCHAR) AS weekday FROM event_plays""",
    "ts_millis": "SELECT event_id, start_milli AS start_time FROM event_plays",
    "ts_seconds": "SELECT event_id, start_time FROM event_plays",
    "ts_epoch_second": "SELECT event_id, ms // 1000 AS timestamp FROM event_ms",
    "device_token": """SELECT DISTINCT user_agent,
  split_part(split_part(split_part(split_part(user_agent, '(', 2), ';', 1), ')', 1), ' ', 1) AS device FROM play_log""",
    "stage_jsonpaths": "SELECT event_id, CAST(props::JSON->>'$.k' AS BIGINT) AS k FROM events",
    "empty_to_null": "SELECT song_id, nullif(artist_location, '') AS artist_location FROM song_catalog",
    # Reports
    "popular_artists": f"""SELECT artist_id, name AS artist_name, count(*) *
    (SELECT count(*) FROM place_fact played WHERE played.artist_id = dim.artist_id) AS requests_count
  FROM ({_PLACE_ARTISTS}) dim GROUP BY artist_id, name
  ORDER BY requests_count DESC, artist_id, artist_name LIMIT 10""",
    "popular_songs": f"""SELECT song_id, song_title, artist_name, copies * listened AS requests_count FROM (
    SELECT song_id, title AS song_title, name AS artist_name, count(*) AS copies
    FROM ({_PLACE_SONGS}) titles JOIN ({_PLACE_ARTISTS}) names USING (artist_id) GROUP BY ALL
  ) JOIN (SELECT song_id, count(*) AS listened FROM place_fact GROUP BY song_id) USING (song_id)
  ORDER BY requests_count DESC, song_id, song_title, artist_name LIMIT 10""",
    "location_counts": """SELECT count(location) AS location_count,
  count(DISTINCT location) AS distinct_location_count FROM place_fact""",
    "plays_by_location": """SELECT location, count(location) AS count FROM place_fact GROUP BY location""",
    "top3_locations": """SELECT location, count(location) AS count FROM place_fact GROUP BY location
  ORDER BY count DESC, location ASC NULLS LAST LIMIT 3""",
    "plays_by_user_agent": "SELECT user_agent, count(user_agent) AS used_count FROM place_fact GROUP BY user_agent",
    "plays_by_device": """SELECT split_part(split_part(split_part(split_part(user_agent, '(', 2), ';', 1), ')', 1),
    ' ', 1) AS device, count(user_agent) AS used_count FROM place_fact GROUP BY 1""",
    "plays_by_hour": """SELECT CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS requests
  FROM place_fact WHERE start_time IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "plays_by_weekday": """SELECT weekday, any_value(weekday_name) AS weekday_name, count(*) AS requests FROM (
    SELECT CAST(dayofweek(start_time) AS INTEGER) AS weekday, dayname(start_time) AS weekday_name
    FROM place_fact WHERE start_time IS NOT NULL
  ) GROUP BY weekday ORDER BY weekday""",
    "duplicate_times": """SELECT strftime(played_at, '%H:%M:%S.%g') AS start_time, count(*) AS count
  FROM (SELECT min(start_milli) AS played_at FROM plays GROUP BY ts // 1000) GROUP BY 1 HAVING count(*) > 1""",
    "users_with_changes": """SELECT user_id FROM play_log WHERE user_id IS NOT NULL GROUP BY user_id
  HAVING count(DISTINCT first_name) > 1 OR count(DISTINCT last_name) > 1 OR count(DISTINCT gender) > 1
    OR count(DISTINCT level) > 1""",
    "plays_with_profile": f"""SELECT p.ts // 1000 AS timestamp, p.user_id, p.session_id, p.item_in_session, p.song,
  h.first_name, h.last_name, h.gender
  FROM plays p JOIN ({_HISTORY}) h ON h.timestamp = p.ts // 1000 AND h.user_id = p.user_id""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("lineitem", "orders", "customer", "nation", "part", "events")
    ),
    "sample_rows": """SELECT session_id, item_in_session, w1, w2, method, user_agent FROM plays
  ORDER BY session_id, item_in_session, w1, w2, w3 LIMIT 10""",
    # Writes and serving tables
    "insert_if_absent": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate >= TIMESTAMP '{INSERT_CUT}', o_orderdate, o_orderkey) AS rn FROM orders
  ) WHERE rn = 1""",
    "upsert_last_wins": f"""SELECT user_id, song, ts, w1, w2, session_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, song
      ORDER BY ts >= epoch_us(TIMESTAMP '{UPSERT_CUT}') // 1000 DESC, ts DESC, w1 DESC, w2 DESC, w3 DESC) AS rn
    FROM plays
  ) WHERE rn = 1""",
    "serving_session_items": _SESSION_ITEMS,
    "serving_user_session": _USER_SESSION,
    "serving_song_listeners": _LISTENERS,
    "lookup_session_item": f"""SELECT artist, song, length FROM ({_SESSION_ITEMS})
  WHERE session_id = {LOOKUP_SESSION} AND item_in_session = {LOOKUP_ITEM}""",
    "lookup_user_session": f"""SELECT item_in_session, artist, song, first_name, last_name FROM ({_USER_SESSION})
  WHERE session_id = {LOOKUP_SESSION}
    AND user_id = (SELECT o_custkey FROM orders WHERE o_orderkey = {LOOKUP_SESSION})""",
    "lookup_song_listeners": f"SELECT first_name, last_name FROM ({_LISTENERS}) WHERE song = '{LOOKUP_SONG}'",
    "stored_session_item": f"""SELECT artist, song, length FROM ({_SESSION_ITEMS})
  WHERE session_id = {LOOKUP_SESSION} AND item_in_session = {LOOKUP_ITEM}""",
    "stored_user_session": f"SELECT * EXCLUDE (session_id) FROM ({_USER_SESSION}) WHERE session_id = {LOOKUP_SESSION}",
    "stored_song_listeners": f"SELECT first_name, last_name FROM ({_LISTENERS}) WHERE song = '{LOOKUP_SONG}'",
    "songplay_serial_id": """SELECT start_time, session_id, item_in_session, w1, w2, w3,
    row_number() OVER (ORDER BY start_time, session_id, item_in_session, w1, w2, w3) AS songplay_id FROM plays""",
    "side_by_side": """SELECT coalesce(c.position, p.position) AS position, c_custkey, c_acctbal, p_partkey, p_retailprice
  FROM (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS position FROM customer) c
  FULL JOIN (SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS position
    FROM part) p ON c.position = p.position""",
    "staged_good": """SELECT event_id, CAST(props::JSON->>'$.k' AS DECIMAL(1,0)) AS k FROM events
  WHERE coalesce(abs(CAST(props::JSON->>'$.k' AS BIGINT)) < 10, true)""",
    "staged_rejects": """SELECT event_id, 'k' AS "column", props::JSON->>'$.k' AS value,
    'does not fit decimal(1,0)' AS reason FROM events WHERE abs(CAST(props::JSON->>'$.k' AS BIGINT)) >= 10""",
    "delete_chain": f"""SELECT * FROM orders o WHERE NOT EXISTS (
    SELECT 1 FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE o.o_custkey = c.c_custkey AND r.r_name = '{DELETED_REGION}')""",
    "delete_chain_counts": f"""WITH r AS (SELECT r_regionkey FROM region WHERE r_name = '{DELETED_REGION}'),
  n AS (SELECT n_nationkey FROM nation WHERE n_regionkey IN (FROM r)),
  c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (FROM n)),
  o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM c)),
  l AS (SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (FROM o))
  SELECT 'region' AS table_name, count(*) AS deleted FROM r UNION ALL SELECT 'nation', count(*) FROM n
  UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'orders', count(*) FROM o
  UNION ALL SELECT 'lineitem', count(*) FROM l""",
    "cascade_delete": """SELECT * FROM orders WHERE o_custkey IS NULL
  OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    # Quality
    "dq_results": f"""SELECT name, CAST(0 AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, actual = 0 AS passed
  FROM (
    SELECT 'users without first name' AS name, count(*) AS actual FROM (
      SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays WHERE user_id IS NOT NULL)
      WHERE first_name IS NULL
    UNION ALL SELECT 'users repeated', coalesce(sum(n), 0) FROM (
      SELECT count(*) AS n FROM (SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays
        WHERE user_id IS NOT NULL) GROUP BY user_id HAVING count(*) > 1)
    UNION ALL SELECT 'plays repeated', coalesce(sum(n), 0) FROM (
      SELECT count(*) AS n FROM plays GROUP BY session_id, item_in_session HAVING count(*) > 1)
    UNION ALL SELECT 'plays without song', count(*) FROM plays p WHERE NOT EXISTS (
      SELECT 1 FROM song_catalog s WHERE p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration)
  )""",
    "dq_not_null": _nulls("artist", "song", "length", "user_id", "level", "session_id", "ts", "location"),
    "dq_not_null_on_write": _nulls("artist", "song", "length", "user_id", "level", "session_id", "ts", "location"),
    "inferred_props": "SELECT event_id, event_type, CAST(props::JSON->>'$.k' AS BIGINT) AS k FROM events",
    "inferred_field_types": """SELECT event_type, concat('$.', key) AS path,
    CASE json_type(props::JSON, key) WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(props::JSON, key) END AS type,
    count(*) AS row_count
  FROM (SELECT event_type, props, unnest(json_keys(props)) AS key FROM events) GROUP BY ALL""",
    "inferred_drift": """SELECT '$.order.price' AS path, 'BIGINT, STRING' AS types, count(*) AS row_count FROM orders
  HAVING count(DISTINCT o_orderstatus = 'P') = 2""",
    "arrived_events": "SELECT event_id, user_id, event_type, value FROM events",
    "dq_pk_duplicates": """SELECT session_id, item_in_session, count(*) AS row_count FROM plays
  GROUP BY session_id, item_in_session HAVING count(*) > 1""",
    "dq_fk_orphans": """SELECT song, artist, count(*) AS row_count FROM plays p WHERE NOT EXISTS (
    SELECT 1 FROM song_catalog s WHERE p.song = s.title AND p.artist = s.artist_name) GROUP BY song, artist""",
}

# A query with tables of its own goes on from those of the feeds.
ORACLE: dict[str, str] = {name: FEEDS + (", " + sql[5:] if sql.startswith("WITH ") else sql) for name, sql in _QUERIES.items()}
