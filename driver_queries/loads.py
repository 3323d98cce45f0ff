"""Writes, load modes, upserts and incremental loads, each read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries import roles
from driver_queries.functions import TIME_PARTS_SQL
from driver_queries.music import SONGS_SQL, STAR_SQL
from driver_queries.registry import query
from driver_queries.roles import table
from starmill.operators.dedupe import first_per_key
from starmill.operators.setops import sorted_columns
from starmill.operators.surrogate import unordered_ids
from starmill.operators.upserts import insert_if_absent, merge_latest
from starmill.plans import ledger, music, query_first, scheduled
from starmill.schemas import MUSIC_TABLES, QUERY_FIRST_TABLES, RAW_EVENTS, RAW_EVENTS_CSV, RAW_SONGS
from starmill.session import released_shuffles, scratch_path
from starmill.sinks import compaction, counted, hashed, interleaved, known_keys
from starmill.sinks import tables as sinks
from starmill.sources import files
from starmill.streaming.incremental import (
    append_stream, append_unknown_stream, latest_stream, latest_touched_stream, new_files,
)

MIDDLE = "2024-01-15"
RAW_ROWS = 1_000_000  # in a raw file: a compressed file is read by one task


def raw_files(df):
    """A writer of raw files as a source delivers them: compressed, each of bounded size."""
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", RAW_ROWS)


def halves(df, column="ts", middle=MIDDLE):
    """Rows before a time and all others, those without a time among them."""
    early = F.coalesce(F.col(column) < F.lit(middle).cast("timestamp_ntz"), F.lit(False))
    return df.filter(early), df.filter(~early)


# --- staging -------------------------------------------------------------------------------


@query(
    "json_tree_read",
    f"""WITH {roles.RAW_SONGS_SQL}
    SELECT song_id, title, artist_id, artist_name, artist_location, artist_latitude, duration, year FROM raw_songs""",
)
def json_tree_read(spark, sf):
    path = scratch_path(spark, "songs-json")
    roles.raw_songs(spark, sf).drop("p_partkey").write.partitionBy("year").json(path)
    # the year is a folder name here, so it is read from the file path
    read = files.read_json_tree(spark, path, RAW_SONGS)
    year = F.regexp_extract(F.input_file_name(), r"year=([0-9]+)", 1).cast("int")
    return read.withColumn("year", year).select(
        "song_id", "title", "artist_id", "artist_name", "artist_location", "artist_latitude", "duration", "year"
    )


@query(
    "stage_json_mapped",
    f"WITH {roles.RAW_EVENTS_SQL} SELECT session_id, item_in_session, song, artist, length, page, level FROM raw_events",
)
def stage_json_mapped(spark, sf):
    base = scratch_path(spark, "log-json")
    log = roles.app_log(spark, sf).withColumn("sessionId", F.col("sessionId").cast("int"))
    raw_files(log).json(f"{base}/raw/2018/11")
    mapping = {
        "session_id": "sessionId", "item_in_session": "itemInSession", "song": "song", "artist": "artist",
        "length": "length", "page": "page", "level": "level",
    }
    template = base + "/raw/{execution_date.year}/{execution_date.month}"
    staged = files.stage(spark, template, date(2018, 11, 1), RAW_EVENTS, "json", mapping=mapping, to=f"{base}/staged")
    return staged.withColumn("session_id", F.col("session_id").cast("bigint"))


@query(
    "stage_csv_slim",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT artist, first_name AS "firstName", gender, item_in_session AS "itemInSession", last_name AS "lastName",
           length, level, location, CAST(session_id AS INTEGER) AS "sessionId", song,
           CAST(user_id AS VARCHAR) AS "userId" FROM raw_events WHERE artist <> ''""",
)
def stage_csv_slim(spark, sf):
    base = scratch_path(spark, "log-csv")
    log = roles.app_log(spark, sf)
    columns = [F.col(f.name) if f.name in log.columns else F.lit("").alias(f.name) for f in RAW_EVENTS_CSV]
    raw_files(log.select(*columns)).option("header", True).option("escape", '"').csv(f"{base}/raw")
    raw = files.read_csv_tree(spark, f"{base}/raw", RAW_EVENTS_CSV)
    slim = query_first.slim_events(raw)
    sinks.write_slim_csv(slim, f"{base}/slim", slim.columns)
    return files.read_csv_tree(spark, f"{base}/slim", slim.schema)


def deliver(spark, sf, base):
    """The raw log of November 2018 and the catalogue as JSON files; the template of the log's folders."""
    log = roles.app_log(spark, sf).withColumn("sessionId", F.col("sessionId").cast("int"))
    with released_shuffles(spark):
        raw_files(log).json(f"{base}/log/2018/11")
        raw_files(roles.raw_songs(spark, sf).drop("p_partkey")).json(f"{base}/songs")
    return base + "/log/{execution_date.year}/{execution_date.month}"


@query("scheduled_run", f"WITH {STAR_SQL} SELECT * FROM songplays")
def scheduled_run(spark, sf):
    """The raw log and catalogue as JSON files, loaded twice by the scheduled job, its checks on."""
    base = scratch_path(spark, "scheduled")
    database = "starmill_" + base.rsplit("-", 1)[1]
    template = deliver(spark, sf, base)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    for _ in range(2):
        star = scheduled.run(spark, date(2018, 11, 1), template, f"{base}/songs", f"{base}/house", database)
    return star["songplays"].withColumn("session_id", F.col("session_id").cast("bigint"))


@query(
    "scheduled_load_report",
    f"""WITH {STAR_SQL}, written AS (
      SELECT 'songs' AS table_name, (SELECT count(*) FROM raw_songs) AS rows_in, (SELECT count(*) FROM songs) AS rows_out
      UNION ALL SELECT 'artists', (SELECT count(*) FROM raw_songs), (SELECT count(*) FROM artists)
      UNION ALL SELECT 'users', (SELECT count(*) FROM raw_events), (SELECT count(*) FROM users)
      UNION ALL SELECT 'time', (SELECT count(*) FROM raw_events), (SELECT count(*) FROM times)
      UNION ALL SELECT 'songplays', (SELECT count(*) FROM raw_events), (SELECT count(*) FROM songplays))
    SELECT 1 AS run, * FROM written
    UNION ALL SELECT 2, table_name, rows_in, CASE WHEN table_name = 'users' THEN rows_out ELSE 0 END FROM written""",
)
def scheduled_load_report(spark, sf):
    """What two runs over the same files read and wrote; the second adds nothing."""
    base = scratch_path(spark, "scheduled-report")
    database = "starmill_" + base.rsplit("-", 1)[1]
    template, rows = deliver(spark, sf, base), []
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    for run in (1, 2):
        counts = {}
        scheduled.run(
            spark, date(2018, 11, 1), template, f"{base}/songs", f"{base}/house", database, check=False, counts=counts
        )
        rows += [(run, name, *found) for name, found in counts.items()]
    return spark.createDataFrame(rows, "run int, table_name string, rows_in long, rows_out long")


@query("backfill_run", f"WITH {STAR_SQL} SELECT * FROM songplays")
def backfill_run(spark, sf):
    """Three months of the log, delivered apart; the second month's plays fail once, then the rest is made up for."""
    base = scratch_path(spark, "backfill")
    database = "starmill_" + base.rsplit("-", 1)[1]
    log = roles.app_log(spark, sf).withColumn("sessionId", F.col("sessionId").cast("int"))
    part = F.coalesce(F.expr("ts div 86400000 div 30 % 3"), F.lit(0))  # a time is in one delivery
    for month in range(3):
        raw_files(log.filter(part == month)).json(f"{base}/log/2018/{month + 1}")
    raw_files(roles.raw_songs(spark, sf).drop("p_partkey")).json(f"{base}/songs")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    template = base + "/log/{execution_date.year}/{execution_date.month}"
    steps = scheduled.steps(spark, template, f"{base}/songs", f"{base}/house", database)
    dates, runs = [date(2018, m, 1) for m in (1, 2, 3)], ledger.Ledger(spark, f"{base}/ledger")

    def broken(day):
        if day.month == 2:
            raise OSError("no plays today")
        steps["plays"](day)

    try:
        ledger.backfill(runs, dates, {**steps, "plays": broken})
    except OSError:
        ledger.backfill(runs, dates, steps)
    return spark.table(f"{database}.songplays").withColumn("session_id", F.col("session_id").cast("bigint"))


# --- files ---------------------------------------------------------------------------------


@query("parquet_partition_roundtrip", f"WITH {SONGS_SQL} SELECT * FROM songs")
def parquet_partition_roundtrip(spark, sf):
    path = scratch_path(spark, "songs")
    declared = MUSIC_TABLES["songs"]
    songs = music.build_songs(roles.raw_songs(spark, sf))
    sinks.write_table(songs, path, partition_by=declared.partition_by, sort_by=declared.sort_by)
    return files.read_table(spark, path, declared.schema).select(*declared.schema.names)


@query("csv_pipe_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def csv_pipe_roundtrip(spark, sf):
    path = scratch_path(spark, "pipe")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    sinks.write_pipe_csv(rows, path)
    return files.read_pipe_csv(spark, path, rows.schema, multi_line=True)


@query("fact_append", "SELECT event_id, ts, user_id, event_type, value FROM events")
def fact_append(spark, sf):
    path = scratch_path(spark, "fact")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    early, late = halves(events)
    sinks.load_fact(early, path, events.schema)
    sinks.load_fact(late.select(*reversed(events.columns)), path, events.schema)
    return files.read_table(spark, path, events.schema)


@query("dimension_insert", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def dimension_insert(spark, sf):
    path = scratch_path(spark, "dimension")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    sinks.load_dimension(rows, path, mode="insert")
    sinks.load_dimension(rows, path, mode="insert")
    return files.read_table(spark, path, rows.schema)


@query("dimension_overwrite", "SELECT s_suppkey, s_name FROM supplier")
def dimension_overwrite(spark, sf):
    path = scratch_path(spark, "dimension")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    sinks.load_dimension(rows, path)
    sinks.load_dimension(rows, path)
    return files.read_table(spark, path, rows.schema)


@query(
    "idempotent_partition_load",
    f"""SELECT o_orderdate AS start_time, {TIME_PARTS_SQL.format('o_orderdate')}
    FROM (SELECT DISTINCT o_orderdate FROM orders)""",
)
def idempotent_partition_load(spark, sf):
    path = scratch_path(spark, "time")
    declared = MUSIC_TABLES["time"]
    time = music.build_time(table(spark, sf, "orders"), "o_orderdate")
    for _ in range(2):
        sinks.load_partitions(time, path, declared.key, declared.partition_by, declared.sort_by)
    return files.read_table(spark, path, declared.schema).select(*declared.schema.names)


@query(
    "late_rows_across_months",
    """SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def late_rows_across_months(spark, sf):
    """Three deliveries, each sent twice; every seventh row comes one delivery after its own."""
    path = scratch_path(spark, "late")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )
    own = F.when(F.col("year") < 1997, 0).when(F.col("year") < 1999, 1).otherwise(2)
    sent = orders.withColumn("delivery", F.least(own + (F.col("o_orderkey") % 7 == 0).cast("int"), F.lit(2)))
    for delivery in (0, 1, 2):
        for _ in range(2):
            batch = sent.filter(F.col("delivery") == delivery).drop("delivery")
            sinks.load_partitions(batch, path, ["o_orderkey"], ["year", "month"], ["o_orderdate"])
    return files.read_table(spark, path, orders.schema).select(*orders.columns)


@query(
    "compacted_partitions",
    """SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def compacted_partitions(spark, sf):
    """A table of many small files, compacted twice."""
    path = scratch_path(spark, "small-files")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    orders.repartition(6, "o_orderkey").write.partitionBy("year").parquet(path)
    for _ in range(2):
        compaction.compact(spark, path, ["year"], ["o_orderkey"])
    return files.read_table(spark, path, orders.schema)


@query(
    "interleaved_filters",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_partkey BETWEEN 100 AND 150 OR l_shipdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-04-15'""",
)
def interleaved_filters(spark, sf):
    """Lines laid along the curve of part and date, asked for by either."""
    path = scratch_path(spark, "interleaved")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    interleaved.write_interleaved(lines, path, ["l_partkey", "l_shipdate"])
    stored = files.read_table(spark, path, lines.schema)
    days = [F.lit(d).cast("timestamp_ntz") for d in ("1995-03-01", "1995-04-15")]
    return stored.filter(F.col("l_partkey").between(100, 150) | F.col("l_shipdate").between(*days))


@query(
    "counted_load",
    """SELECT 'orders' AS table_name, count(*) AS rows_in,
           count(*) FILTER (WHERE NOT (o_totalprice < 1000 OR o_orderstatus = 'P')) AS rows_out,
           count(*) FILTER (WHERE o_totalprice < 1000 OR o_orderstatus = 'P') AS rejected FROM orders""",
)
def counted_load(spark, sf):
    """Counts of a load that turns rows away, taken while it writes."""
    rules = {"cheap": F.col("o_totalprice") < 1000, "pending": F.col("o_orderstatus") == "P"}
    counts = counted.write_counted(table(spark, sf, "orders"), scratch_path(spark, "counted"), rules)
    return counted.report(spark, {"orders": counts})


# --- upserts -------------------------------------------------------------------------------

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]
LINE_KEY = LINE_COLUMNS[:2]
LINE_FIRST_SQL = """row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey)"""


@query(
    "upsert_do_nothing",
    f"""WITH early AS (SELECT *, {LINE_FIRST_SQL} AS rn FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
    late AS (SELECT *, {LINE_FIRST_SQL} AS rn FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')
    SELECT {', '.join(LINE_COLUMNS)} FROM early WHERE rn = 1
    UNION ALL
    SELECT {', '.join(LINE_COLUMNS)} FROM late WHERE rn = 1
      AND NOT EXISTS (SELECT 1 FROM early e WHERE e.l_orderkey = late.l_orderkey
                      AND e.l_linenumber = late.l_linenumber)""",
)
def upsert_do_nothing(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_COLUMNS)
    early, late = halves(lines, "l_shipdate", "1998-01-01")
    existing = first_per_key(early, LINE_KEY, ["l_shipdate"])
    return insert_if_absent(existing, late, LINE_KEY, ["l_shipdate"])


UPSERT_SQL = f"""WITH {roles.HISTORY_SQL}
    SELECT user_id, arg_min(event_type, ts) AS first_type, arg_max(level, ts) AS level, max(ts) AS last_start_time
    FROM history GROUP BY 1"""


def user_rows(df):
    return df.select(
        "user_id", F.col("event_type").alias("first_type"), "level", F.col("ts").alias("last_start_time")
    )


@query("upsert_latest", UPSERT_SQL)
def upsert_latest(spark, sf):
    early, late = halves(user_rows(roles.history(spark, sf)), "last_start_time")
    existing = merge_latest(spark.createDataFrame([], early.schema), early, ["user_id"], "last_start_time", ["level"])
    return merge_latest(existing, late, ["user_id"], "last_start_time", ["level"])


@query(
    "query_table_session",
    """SELECT session_id, item_in_session, part_id, ship_time FROM (
      SELECT l_orderkey AS session_id, l_linenumber AS item_in_session, l_partkey AS part_id,
             l_shipdate AS ship_time, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate DESC, l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def query_table_session(spark, sf):
    path = scratch_path(spark, "session-songs")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_linenumber").alias("item_in_session"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_shipdate").alias("ship_time"),
    )
    sinks.upsert_last_write(rows, path, ["session_id"], ["item_in_session"], ["ship_time"])
    return files.read_table(spark, path, rows.schema)


# --- incremental ---------------------------------------------------------------------------


@query("incremental_load", "SELECT event_id, ts, user_id, event_type, value FROM events")
def incremental_load(spark, sf):
    """Two deliveries, the second repeating all of the first; then a run with nothing new."""
    base = scratch_path(spark, "incremental")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    early, _ = halves(events)
    for delivery in (early, events, None):
        if delivery is not None:
            delivery.write.mode("append").parquet(f"{base}/in")
        stream = new_files(spark, f"{base}/in", events.schema, "parquet")
        append_stream(stream, f"{base}/out", ["event_id"], f"{base}/checkpoint").awaitTermination()
    return files.read_table(spark, f"{base}/out", events.schema)


@query("incremental_latest", UPSERT_SQL)
def incremental_latest(spark, sf):
    """The same result as ``upsert_latest``, fed by a stream of two deliveries."""
    base = scratch_path(spark, "incremental-users")
    name = "users_" + base.rsplit("-", 1)[1]
    rows = user_rows(roles.history(spark, sf))
    for delivery in halves(rows, "last_start_time"):
        delivery.write.mode("append").parquet(f"{base}/in")
        stream = new_files(spark, f"{base}/in", rows.schema, "parquet")
        latest_stream(
            stream, name, f"{base}/out", ["user_id"], "last_start_time", ["level"], f"{base}/checkpoint"
        ).awaitTermination()
    return spark.table(name)


@query("upsert_latest_touched", UPSERT_SQL)
def upsert_latest_touched(spark, sf):
    """The history in three batches, and the last one again, into a table of 16 directories."""
    path = scratch_path(spark, "users-hashed")
    rows = user_rows(roles.history(spark, sf))
    hashed.create_hashed(spark, path, rows.schema, ["user_id"], 16)
    early, late = halves(rows, "last_start_time")
    few = F.col("user_id") % 97 == 0
    for batch in (early, late.filter(~few | few.isNull()), late.filter(few), late.filter(few)):
        hashed.merge_touched(spark, batch, path, "last_start_time", ["level"])
    return hashed.read_hashed(spark, path)


@query("incremental_latest_touched", UPSERT_SQL)
def incremental_latest_touched(spark, sf):
    base = scratch_path(spark, "incremental-hashed")
    rows = user_rows(roles.history(spark, sf))
    hashed.create_hashed(spark, f"{base}/out", rows.schema, ["user_id"], 8)
    for delivery in halves(rows, "last_start_time"):
        delivery.write.mode("append").parquet(f"{base}/in")
        stream = new_files(spark, f"{base}/in", rows.schema, "parquet")
        latest_touched_stream(
            stream, f"{base}/out", "last_start_time", ["level"], f"{base}/checkpoint"
        ).awaitTermination()
    return hashed.read_hashed(spark, f"{base}/out")


@query("incremental_load_bitmap", "SELECT event_id, ts, user_id, event_type, value FROM events")
def incremental_load_bitmap(spark, sf):
    """Two deliveries by stream, the second repeating all of the first; then all again as a batch."""
    base = scratch_path(spark, "incremental-bitmap")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    early, _ = halves(events)
    for delivery in (early, events):
        delivery.write.mode("append").parquet(f"{base}/in")
        stream = new_files(spark, f"{base}/in", events.schema, "parquet")
        append_unknown_stream(stream, f"{base}/out", "event_id", f"{base}/checkpoint").awaitTermination()
    known_keys.append_unknown(spark, events, f"{base}/out", "event_id")
    return files.read_table(spark, f"{base}/out", events.schema)


# --- layouts -------------------------------------------------------------------------------


@query(
    "bucketed_join",
    """SELECT o_orderkey, o_orderdate, l_linenumber, l_shipdate, l_extendedprice
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def bucketed_join(spark, sf):
    """Both tables bucketed by the order key; the join then moves no rows."""
    base = scratch_path(spark, "bucketed")
    mark = base.rsplit("-", 1)[1]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    for name, df in (("orders", orders), ("lines", lines)):
        sinks.write_bucketed(df, f"{name}_{mark}", f"{base}/{name}", ["o_orderkey"], 8)
    return spark.table(f"orders_{mark}").hint("merge").join(spark.table(f"lines_{mark}"), "o_orderkey")


@query("gapped_ids", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem")
def gapped_ids(spark, sf):
    numbered = unordered_ids(table(spark, sf, "lineitem").select("l_orderkey"), "id")
    return numbered.agg(F.count("l_orderkey").alias("n_rows"), F.countDistinct("id").alias("n_ids"))


@query(
    "union_by_position",
    "SELECT s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def union_by_position(spark, sf):
    """Columns in two orders, put in one order before a union that matches by position."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return sorted_columns(rows).union(sorted_columns(rows.select(*reversed(rows.columns))))


# --- query-first tables --------------------------------------------------------------------


def query_tables(spark, sf):
    """The app log through CSV files into the three tables."""
    base = scratch_path(spark, "query-first")
    log = roles.app_log(spark, sf)
    columns = [F.col(f.name) if f.name in log.columns else F.lit("").alias(f.name) for f in RAW_EVENTS_CSV]
    raw_files(log.select(*columns)).option("header", True).option("escape", '"').csv(f"{base}/raw")
    slim = query_first.slim_events(files.read_csv_tree(spark, f"{base}/raw", RAW_EVENTS_CSV))
    query_first.load_query_tables(slim, f"{base}/tables")
    return {
        name: files.read_table(spark, f"{base}/tables/{name}", declared.schema)
        for name, declared in QUERY_FIRST_TABLES.items()
    }


SESSION_SONGS_SQL = f"""WITH {roles.RAW_EVENTS_SQL}, session_songs AS (
  SELECT CAST(session_id AS INTEGER) AS session_id, CAST(item_in_session AS INTEGER) AS item_in_session,
         artist, song, length, row_number() OVER (PARTITION BY session_id, item_in_session
         ORDER BY artist DESC, song DESC, length DESC) AS rn FROM raw_events WHERE artist <> '')"""


@query(
    "query_first_session_songs",
    f"{SESSION_SONGS_SQL} SELECT session_id, item_in_session, artist, song, length FROM session_songs WHERE rn = 1",
)
def query_first_session_songs(spark, sf):
    return query_tables(spark, sf)["session_songs"]


@query(
    "query_first_song_users",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT DISTINCT song, user_id, first_name, last_name FROM raw_events WHERE artist <> '' AND user_id IS NOT NULL""",
)
def query_first_song_users(spark, sf):
    """The whole table, without the listeners who had logged out."""
    return query_tables(spark, sf)["song_users"].filter(F.col("user_id").isNotNull())


@query(
    "query_first_lookup",
    f"""{SESSION_SONGS_SQL}
    SELECT artist, song, length FROM session_songs WHERE rn = 1 ORDER BY session_id, item_in_session LIMIT 1""",
)
def query_first_lookup(spark, sf):
    """What was heard at the first place of the first session."""
    tables = query_tables(spark, sf)
    place = F.min(F.struct("session_id", "item_in_session"))
    first = tables["session_songs"].agg(place.alias("at")).select("at.*").first()
    return query_first.item_of_session(tables["session_songs"], *first)
