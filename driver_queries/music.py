"""Star tables, fact joins and the play queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import roles
from driver_queries.functions import TIME_PARTS_SQL, uuid5_sql
from driver_queries.registry import query
from driver_queries.roles import table
from starmill.operators import aggregates
from starmill.operators.dedupe import latest_attributes
from starmill.operators.filters import lookup
from starmill.operators.setops import append_aligned, union_distinct
from starmill.plans import music
from starmill.schemas import MUSIC_TABLES
from starmill.session import scratch_path
from starmill.sinks.tables import write_table
from starmill.sources.files import read_table

# --- star tables ---------------------------------------------------------------------------

SONGS_SQL = (
    roles.RAW_SONGS_SQL
    + """, songs AS (SELECT DISTINCT song_id, title, artist_id, year, duration FROM raw_songs)"""
)

ARTIST_ROWS_SQL = """artist_rows AS (
  SELECT DISTINCT artist_id, artist_name AS name,
         CASE WHEN artist_location IS NULL OR artist_location = '' THEN 'N/A' ELSE artist_location END AS location,
         coalesce(artist_latitude, 0.0::DOUBLE) AS latitude, coalesce(artist_longitude, 0.0::DOUBLE) AS longitude
  FROM raw_songs)"""

ARTISTS_SQL = (
    ARTIST_ROWS_SQL
    + """, artists AS (
  SELECT artist_id, name, location, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY name, location, latitude, longitude) AS rn
    FROM artist_rows) WHERE rn = 1)"""
)

USERS_SQL = """users AS (
  SELECT user_id, first_name, last_name, gender, level, start_time AS last_start_time FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_time DESC, level DESC) AS rn
    FROM plays WHERE user_id IS NOT NULL) WHERE rn = 1)"""

TIME_SQL = f"""times AS (
  SELECT start_time, {TIME_PARTS_SQL.format('start_time')} FROM (SELECT DISTINCT start_time FROM plays))"""

MATCH_SQL = """matches AS (
  SELECT title, name, duration, song_id, artist_id FROM (
    SELECT s.title, a.name, s.duration, s.song_id, s.artist_id,
           row_number() OVER (PARTITION BY s.title, a.name, s.duration ORDER BY s.song_id, s.artist_id) AS rn
    FROM songs s JOIN artists a ON s.artist_id = a.artist_id) WHERE rn = 1)"""

SIX_DIGIT_TIME_SQL = """(CASE WHEN date_trunc('second', start_time) = start_time
    THEN strftime(start_time, '%Y-%m-%d %H:%M:%S') ELSE strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') END)"""

SONGPLAYS_SQL = f"""unique_plays AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start_time, user_id, song
      ORDER BY session_id, item_in_session, level, location, user_agent, artist, length) AS rn
    FROM plays WHERE user_id IS NOT NULL) WHERE rn = 1),
songplays AS (
  SELECT {uuid5_sql(f"(song || {SIX_DIGIT_TIME_SQL} || CAST(user_id AS VARCHAR))")} AS songplay_id,
         start_time, user_id, level, song_id, artist_id, session_id, location, user_agent,
         CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month
  FROM unique_plays LEFT JOIN matches ON song = title AND artist = name AND length = duration)"""

STAR_SQL = ", ".join([
    roles.RAW_EVENTS_SQL, SONGS_SQL.removeprefix(roles.RAW_SONGS_SQL + ", "), ARTISTS_SQL, USERS_SQL, TIME_SQL,
    MATCH_SQL, SONGPLAYS_SQL,
])


def star(spark, sf):
    """The five tables, written and read back: log and catalogue are staged once."""
    base = scratch_path(spark, "star")
    staged = {"log": roles.events_log(spark, sf), "catalogue": roles.raw_songs(spark, sf)}
    for name, df in staged.items():
        write_table(df, f"{base}/staging_{name}")
        staged[name] = read_table(spark, f"{base}/staging_{name}", df.schema)
    tables = {}
    for name, df in music.build_star(staged["log"], staged["catalogue"]).items():
        write_table(df, f"{base}/{name}", sort_by=MUSIC_TABLES[name].sort_by)
        tables[name] = read_table(spark, f"{base}/{name}", df.schema)
    return tables


@query("star_songs", f"WITH {SONGS_SQL} SELECT * FROM songs")
def star_songs(spark, sf):
    return music.build_songs(roles.raw_songs(spark, sf))


@query("star_artists", f"WITH {roles.RAW_SONGS_SQL}, {ARTISTS_SQL} SELECT * FROM artists")
def star_artists(spark, sf):
    return music.build_artists(roles.raw_songs(spark, sf))


@query("artists_distinct", f"WITH {roles.RAW_SONGS_SQL}, {ARTIST_ROWS_SQL} SELECT * FROM artist_rows")
def artists_distinct(spark, sf):
    return music.artists_distinct(roles.raw_songs(spark, sf))


@query("star_users", f"WITH {roles.RAW_EVENTS_SQL}, {USERS_SQL} SELECT * FROM users")
def star_users(spark, sf):
    return music.build_users(music.plays_of(roles.events_log(spark, sf)))


@query(
    "users_distinct",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays WHERE user_id IS NOT NULL""",
)
def users_distinct(spark, sf):
    return music.users_distinct(roles.events_log(spark, sf))


@query(
    "users_distinct_any_page",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT DISTINCT user_id, first_name, last_name, gender, level FROM raw_events WHERE user_id IS NOT NULL""",
)
def users_distinct_any_page(spark, sf):
    return music.users_distinct(roles.events_log(spark, sf), page=None)


@query("star_time", f"WITH {roles.RAW_EVENTS_SQL}, {TIME_SQL} SELECT * FROM times")
def star_time(spark, sf):
    return music.build_time(music.plays_of(roles.events_log(spark, sf)))


@query("star_songplays", f"WITH {STAR_SQL} SELECT * FROM songplays")
def star_songplays(spark, sf):
    plays = music.plays_of(roles.events_log(spark, sf))
    return music.build_songplays(plays, *music.build_catalogue(roles.raw_songs(spark, sf)))


# --- fact joins ----------------------------------------------------------------------------


@query(
    "song_lookup",
    f"""WITH {SONGS_SQL}, {ARTISTS_SQL}
    SELECT s.song_id, s.artist_id, s.title, a.name, s.duration FROM songs s JOIN artists a USING (artist_id)""",
)
def song_lookup(spark, sf):
    return music.song_lookup(*music.build_catalogue(roles.raw_songs(spark, sf)))


@query(
    "fact_left_first_match",
    f"""WITH {STAR_SQL}
    SELECT session_id, item_in_session, start_time, user_id, song, artist, length, song_id, artist_id
    FROM plays LEFT JOIN matches ON song = title AND artist = name AND length = duration""",
)
def fact_left_first_match(spark, sf):
    plays = music.plays_of(roles.events_log(spark, sf))
    rows = music.fact_first_match(plays, *music.build_catalogue(roles.raw_songs(spark, sf)))
    return rows.select(
        "session_id", "item_in_session", "start_time", "user_id", "song", "artist", "length", "song_id", "artist_id"
    )


PLAY_COLUMNS = ["start_time", "user_id", "level", "session_id", "location", "user_agent"]


@query(
    "fact_inner_title",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT DISTINCT {', '.join(PLAY_COLUMNS)}, song_id, artist_id FROM plays JOIN raw_songs ON song = title""",
)
def fact_inner_title(spark, sf):
    plays = music.plays_of(roles.events_log(spark, sf))
    return music.fact_inner_title(plays, roles.raw_songs(spark, sf), PLAY_COLUMNS)


@query(
    "fact_three_key",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT md5(song_id || CAST(start_time AS VARCHAR) || coalesce(CAST(user_id AS VARCHAR), '-9999')) AS songplay_id,
           start_time, coalesce(user_id, -9999) AS user_id, level, song_id, artist_id, session_id, location, user_agent
    FROM plays p JOIN raw_songs s
      ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration""",
)
def fact_three_key(spark, sf):
    plays = music.plays_of(roles.events_log(spark, sf))
    return music.fact_three_key(plays, roles.raw_songs(spark, sf))


@query(
    "fact_three_key_whole_seconds",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT start_time, coalesce(user_id, -9999) AS user_id, song_id, artist_id, session_id, user_agent
    FROM plays p JOIN raw_songs s
      ON p.song = s.title AND p.artist = s.artist_name AND round(p.length) = round(s.duration)""",
)
def fact_three_key_whole_seconds(spark, sf):
    plays = music.plays_of(roles.events_log(spark, sf))
    rows = music.fact_three_key(plays, roles.raw_songs(spark, sf), scale=0)
    return rows.select("start_time", "user_id", "song_id", "artist_id", "session_id", "user_agent")


@query(
    "left_chain_coalesce",
    f"""WITH {roles.RAW_EVENTS_SQL}, {ARTIST_ROWS_SQL}
    SELECT DISTINCT {', '.join('p.' + c for c in PLAY_COLUMNS)}, s.song_id,
           coalesce(a.artist_id, s.artist_id) AS artist_id
    FROM plays p LEFT JOIN raw_songs s ON p.song = s.title LEFT JOIN artist_rows a ON p.artist = a.name""",
)
def left_chain_coalesce(spark, sf):
    raw = roles.raw_songs(spark, sf)
    plays = music.plays_of(roles.events_log(spark, sf))
    return music.fact_left_chain(plays, music.songs_distinct(raw), music.artists_distinct(raw), PLAY_COLUMNS)


@query(
    "fact_time_inner",
    f"""SELECT e.event_id, e.ts AS start_time, {TIME_PARTS_SQL.format('e.ts')}
    FROM events e JOIN (SELECT DISTINCT ts FROM events) t ON e.ts = t.ts""",
)
def fact_time_inner(spark, sf):
    events = table(spark, sf, "events")
    fact = events.select("event_id", F.col("ts").alias("start_time"))
    return music.join_time(fact, music.build_time(events, "ts"))


@query(
    "star_join_all",
    f"""WITH {STAR_SQL}
    SELECT p.songplay_id, p.start_time, p.user_id, p.level, u.first_name, u.last_name, s.title, s.duration,
           a.name, a.location AS artist_location, t.hour, t.weekday
    FROM songplays p JOIN users u ON p.user_id = u.user_id JOIN songs s ON p.song_id = s.song_id
    JOIN artists a ON p.artist_id = a.artist_id JOIN times t ON p.start_time = t.start_time""",
)
def star_join_all(spark, sf):
    return music.join_all(star(spark, sf)).select(
        "songplay_id", "start_time", "user_id", "level", "first_name", "last_name", "title", "duration",
        "name", "artist_location", "hour", "weekday",
    )


# --- play queries --------------------------------------------------------------------------


@query(
    "plays_by_weekday",
    """SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, count(event_id) AS songplay_count
    FROM events GROUP BY 1 ORDER BY 1""",
)
def plays_by_weekday(spark, sf):
    events = table(spark, sf, "events")
    plays = events.select("event_id", F.col("ts").alias("start_time"))
    time = music.build_time(events, "ts")
    counts = aggregates.count_by_joined(plays, time, "start_time", ["weekday"], "event_id", "songplay_count")
    return counts.orderBy("weekday")


@query(
    "plays_by_month",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       count(o_orderkey) AS songplay_count FROM orders GROUP BY 1, 2""",
)
def plays_by_month(spark, sf):
    orders = table(spark, sf, "orders")
    plays = orders.select("o_orderkey", F.col("o_orderdate").alias("start_time"))
    time = music.build_time(orders, "o_orderdate")
    return aggregates.count_by_joined(plays, time, "start_time", ["month", "year"], "o_orderkey", "songplay_count")


@query(
    "level_share",
    f"""WITH {roles.HISTORY_SQL}
    SELECT level, count(event_id) AS n, 100 * count(event_id) // (SELECT count(event_id) FROM history) AS percent
    FROM history GROUP BY level""",
)
def level_share(spark, sf):
    return aggregates.share_of_total(roles.history(spark, sf), "level", "event_id")


@query(
    "level_share_exact",
    f"""WITH {roles.HISTORY_SQL}
    SELECT level, count(event_id) AS n,
           100.0::DOUBLE * count(event_id) / (SELECT count(event_id) FROM history) AS percent
    FROM history GROUP BY level""",
)
def level_share_exact(spark, sf):
    return aggregates.share_of_total(roles.history(spark, sf), "level", "event_id", exact=True)


@query(
    "users_latest_level",
    f"""WITH {roles.HISTORY_SQL}
    SELECT c_custkey AS user_id, c_name AS name, level, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, level DESC) AS rn FROM history)
    JOIN customer ON user_id = c_custkey WHERE rn = 1""",
)
def users_latest_level(spark, sf):
    latest = latest_attributes(roles.history(spark, sf), ["user_id"], "ts", ["level"], [])
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return latest.join(names, "user_id").select("user_id", "name", "level", "ts")


@query(
    "distinct_codes",
    "SELECT DISTINCT c_nationkey AS code, c_mktsegment AS segment FROM customer",
)
def distinct_codes(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(F.col("c_nationkey").alias("code"), F.col("c_mktsegment").alias("segment")).distinct()


@query(
    "union_distinct_codes",
    "SELECT c_nationkey AS code FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct_codes(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("code"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("code"))
    return union_distinct(customers, suppliers)


@query(
    "union_missing_columns",
    """SELECT c_name AS name, c_nationkey AS code, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""",
)
def union_missing_columns(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("code"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("code"), F.col("s_name").alias("name")
    )
    return append_aligned(customers, suppliers)


@query("preview_limit", "SELECT event_id, ts, user_id FROM events ORDER BY event_id LIMIT 5")
def preview_limit(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id").orderBy("event_id").limit(5)


@query("point_lookup", "SELECT conv_id, turn, role, text FROM conversations WHERE conv_id = 3 AND turn = 1")
def point_lookup(spark, sf):
    return lookup(table(spark, sf, "conversations"), conv_id=3, turn=1).select("conv_id", "turn", "role", "text")


@query("session_playlist", "SELECT turn, role, text FROM conversations WHERE conv_id = 5 ORDER BY turn")
def session_playlist(spark, sf):
    rows = lookup(table(spark, sf, "conversations"), conv_id=5)
    return rows.orderBy("turn").select("turn", "role", "text")


@query(
    "song_listeners",
    f"""WITH {roles.HISTORY_SQL}
    SELECT DISTINCT c_custkey AS user_id, c_name AS name FROM history JOIN customer ON user_id = c_custkey
    WHERE k = 42""",
)
def song_listeners(spark, sf):
    listeners = lookup(roles.history(spark, sf), k=42).select("user_id").distinct()
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return listeners.join(names, "user_id")
