"""Filters, scalar functions, keys and nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import roles
from driver_queries.registry import query
from driver_queries.roles import table
from starmill.functions import keys, timeparts
from starmill.functions.clean import fit_widths, or_default, parse_date, safe_cast, text_or_default
from starmill.functions.ndc import format_ndc
from starmill.functions.nested import explode_structs, explode_values, flatten_one_level, pick_json_paths, pick_paths
from starmill.operators import filters
from starmill.operators.surrogate import dense_ids
from starmill.plans.music import build_time

# --- filters -------------------------------------------------------------------------------


@query("filter_event_type", "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'view'")
def filter_event_type(spark, sf):
    rows = filters.keep_type(table(spark, sf, "events"), "event_type", "view")
    return rows.select("event_id", "ts", "user_id", "value")


@query(
    "filter_not_null",
    f"""WITH {roles.RAW_SONGS_SQL}
    SELECT song_id, artist_id, artist_location, artist_latitude FROM raw_songs
    WHERE artist_location IS NOT NULL AND artist_latitude IS NOT NULL""",
)
def filter_not_null(spark, sf):
    rows = filters.require_values(roles.raw_songs(spark, sf), ["artist_location", "artist_latitude"])
    return rows.select("song_id", "artist_id", "artist_location", "artist_latitude")


@query(
    "filter_nonempty",
    f"""WITH {roles.RAW_SONGS_SQL}
    SELECT song_id, artist_location FROM raw_songs WHERE artist_location IS NOT NULL AND artist_location <> ''""",
)
def filter_nonempty(spark, sf):
    return filters.require_text(roles.raw_songs(spark, sf), ["artist_location"]).select("song_id", "artist_location")


@query(
    "plays_in_period",
    """SELECT event_id, ts, user_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""",
)
def plays_in_period(spark, sf):
    rows = filters.in_period(table(spark, sf, "events"), "ts", "2024-01-08", "2024-01-15")
    return rows.select("event_id", "ts", "user_id", "event_type")


# --- nested data and JSON ------------------------------------------------------------------


@query(
    "json_path_projection",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def json_path_projection(spark, sf):
    return table(spark, sf, "events").select("event_id", *pick_json_paths(F.col("props"), {"k": "$.k"}))


@query(
    "struct_path_projection",
    """SELECT CAST(o_orderkey AS VARCHAR) AS report_id, strftime(o_orderdate, '%Y%m%d') AS received,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') END AS death_date FROM orders""",
)
def struct_path_projection(spark, sf):
    paths = {
        "report_id": "safetyreportid",
        "received": "receivedate",
        "death_date": "patient.patientdeath.patientdeathdate",
    }
    return pick_paths(roles.report_results(spark, sf), paths)


@query(
    "flatten_depth_one",
    """SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, 2 AS n_drugs,
       o_orderstatus = 'F' AS has_death FROM orders""",
)
def flatten_depth_one(spark, sf):
    flat = flatten_one_level(roles.report_results(spark, sf), sep="_")
    return flat.select(
        "safetyreportid",
        F.size("patient_drug").alias("n_drugs"),
        F.col("patient_patientdeath").isNotNull().alias("has_death"),
    )


@query(
    "explode_structs",
    f"""WITH {roles.REACTIONS_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, o_orderpriority AS reactionmeddrapt FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), CASE o_orderstatus WHEN 'F' THEN 'Fatigue' WHEN 'O' THEN '' END FROM orders""",
)
def explode_structs_query(spark, sf):
    reports = roles.report_results(spark, sf).select("safetyreportid", "patient.reaction")
    return explode_structs(reports, "reaction", ["safetyreportid"])


@query(
    "explode_outer_values",
    f"WITH {roles.LABELS_SQL} SELECT active_ingredient, brand_name, package_ndc FROM drug_labels",
)
def explode_outer_values(spark, sf):
    labels = roles.label_results(spark, sf).select(
        F.element_at("active_ingredient", 1).alias("active_ingredient"),
        F.get("openfda.brand_name", F.lit(0)).alias("brand_name"),
        F.col("openfda.package_ndc").alias("codes"),
    )
    return explode_values(labels, "codes", "package_ndc", ["active_ingredient", "brand_name"])


@query(
    "ndc_format",
    f"""WITH coded AS (SELECT p_partkey, {roles.code_sql('p_partkey')} AS package_ndc FROM part)
    SELECT p_partkey, package_ndc, {roles.ndc_sql('package_ndc')} AS formatted_ndc FROM coded""",
)
def ndc_format(spark, sf):
    coded = table(spark, sf, "part").select("p_partkey", roles.code(F.col("p_partkey")).alias("package_ndc"))
    return coded.withColumn("formatted_ndc", format_ndc(F.col("package_ndc")))


@query(
    "truncate_columns",
    """SELECT o_orderkey, substr(o_orderpriority, 1, 5) AS o_orderpriority, substr(o_orderstatus, 1, 1) AS o_orderstatus
    FROM orders""",
)
def truncate_columns(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return fit_widths(orders, {"o_orderpriority": 5, "o_orderstatus": 1})


# --- time ----------------------------------------------------------------------------------


@query(
    "epoch_millis",
    "SELECT event_id, make_timestamp(1000 * (1541105830796 + event_id * 86399999)) AS start_time FROM events",
)
def epoch_millis(spark, sf):
    ms = F.lit(1541105830796) + F.col("event_id") * 86399999
    return table(spark, sf, "events").select("event_id", timeparts.epoch_millis(ms).alias("start_time"))


@query(
    "epoch_seconds",
    """SELECT event_id, make_timestamp(1000000 * ((1541105830796 + event_id * 86399999) // 1000)) AS start_time
    FROM events""",
)
def epoch_seconds(spark, sf):
    ms = F.lit(1541105830796) + F.col("event_id") * 86399999
    return table(spark, sf, "events").select("event_id", timeparts.epoch_seconds(ms).alias("start_time"))


TIME_PARTS_SQL = """CAST(hour({0}) AS INTEGER) AS hour, CAST(day({0}) AS INTEGER) AS day,
    CAST(week({0}) AS INTEGER) AS week, CAST(month({0}) AS INTEGER) AS month, CAST(year({0}) AS INTEGER) AS year,
    CAST(isodow({0}) - 1 AS INTEGER) AS weekday"""


@query(
    "time_dimension",
    f"SELECT ts AS start_time, {TIME_PARTS_SQL.format('ts')} FROM (SELECT DISTINCT ts FROM events WHERE ts IS NOT NULL)",
)
def time_dimension(spark, sf):
    return build_time(table(spark, sf, "events"), "ts")


@query(
    "weekday_conventions",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS monday0,
       CAST(dayofweek(o_orderdate) AS INTEGER) AS sunday0, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS sunday1
    FROM orders""",
)
def weekday_conventions(spark, sf):
    names = ["monday0", "sunday0", "sunday1"]
    parts = [timeparts.weekday(F.col("o_orderdate"), n).alias(n) for n in names]
    return table(spark, sf, "orders").select("o_orderkey", *parts)


@query(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_day
    FROM orders""",
)
def parse_dates(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, sf, "orders").select("o_orderkey", parse_date(text).alias("order_day"))


# --- cleaning ------------------------------------------------------------------------------


@query(
    "impute_defaults",
    f"""WITH {roles.RAW_SONGS_SQL}
    SELECT song_id, CASE WHEN artist_location IS NULL OR artist_location = '' THEN 'N/A' ELSE artist_location END
             AS location,
           coalesce(artist_latitude, 0.0::DOUBLE) AS latitude, coalesce(artist_longitude, 0.0::DOUBLE) AS longitude
    FROM raw_songs""",
)
def impute_defaults(spark, sf):
    return roles.raw_songs(spark, sf).select(
        "song_id",
        text_or_default(F.col("artist_location")).alias("location"),
        or_default(F.col("artist_latitude"), 0.0).alias("latitude"),
        or_default(F.col("artist_longitude"), 0.0).alias("longitude"),
    )


@query(
    "safe_cast",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id
    FROM events""",
)
def safe_cast_query(spark, sf):
    text = F.when(F.col("event_type") == "error", "").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf, "events").select("event_id", safe_cast(text, "int").alias("user_id"))


# --- keys ----------------------------------------------------------------------------------


@query(
    "hash_key_md5",
    """SELECT event_id, md5(event_type || CAST(ts AS VARCHAR) ||
       coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END, '-9999')) AS play_key
    FROM events""",
)
def hash_key_md5(spark, sf):
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    key = keys.play_md5(F.col("event_type"), F.col("ts"), user)
    return table(spark, sf, "events").select("event_id", key.alias("play_key"))


def uuid5_sql(name: str) -> str:
    digest = f"sha1(unhex(repeat('00', 16)) || encode({name}))"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"substr('89ab', CAST(('0x' || substr({digest}, 17, 1)) AS INTEGER) % 4 + 1, 1) || "
        f"substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


@query(
    "hash_key_uuid5",
    f"""SELECT event_id, {uuid5_sql("(event_type || CAST(ts AS VARCHAR) || CAST(user_id AS VARCHAR))")} AS play_key
    FROM events""",
)
def hash_key_uuid5(spark, sf):
    key = keys.play_uuid(F.col("event_type"), F.col("ts"), F.col("user_id"))
    return table(spark, sf, "events").select("event_id", key.alias("play_key"))


@query(
    "surrogate_row_number",
    "SELECT row_number() OVER (ORDER BY o_orderkey) AS order_id, o_orderkey, o_custkey FROM orders",
)
def surrogate_row_number(spark, sf):
    return dense_ids(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], "order_id")
