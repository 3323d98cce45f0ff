"""Data-quality checks and load reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import roles
from driver_queries.registry import query
from driver_queries.roles import table
from starmill.functions.ndc import format_ndc
from starmill.operators import quality
from starmill.operators.aggregates import max_key_count, non_empty_flag
from starmill.operators.joins import orphan_keys
from starmill.plans.drug import reject_rules


@query(
    "dq_non_empty",
    "SELECT CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS INTEGER) AS row_flag FROM lineitem",
)
def dq_non_empty(spark, sf):
    return non_empty_flag(table(spark, sf, "lineitem"))


@query(
    "dq_max_key_count",
    """SELECT max(n) AS max_count FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def dq_max_key_count(spark, sf):
    return max_key_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_null_counts",
    f"""WITH {roles.RAW_SONGS_SQL}
    SELECT 'songs' AS table_name, 'title' AS column_name, count(*) FILTER (title IS NULL) AS n_nulls FROM raw_songs
    UNION ALL SELECT 'songs', 'artist_location', count(*) FILTER (artist_location IS NULL) FROM raw_songs
    UNION ALL SELECT 'songs', 'artist_latitude', count(*) FILTER (artist_latitude IS NULL) FROM raw_songs""",
)
def dq_null_counts(spark, sf):
    return quality.null_counts(
        roles.raw_songs(spark, sf), ["title", "artist_location", "artist_latitude"], "songs"
    )


@query(
    "dq_foreign_key",
    """SELECT c_custkey AS orphan_key, count(*) AS n_rows FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY 1""",
)
def dq_foreign_key(spark, sf):
    return orphan_keys(table(spark, sf, "customer"), "c_custkey", table(spark, sf, "events"), "user_id")


@query(
    "dq_report",
    """SELECT 'not_empty' AS check_name, 'events' AS table_name, 1::BIGINT AS expected,
              (count(*) > 0)::BIGINT AS actual, count(*) > 0 AS passed FROM events
    UNION ALL SELECT 'unique_event_id', 'events', 1, max(n), max(n) = 1
      FROM (SELECT count(*) AS n FROM events GROUP BY event_id)
    UNION ALL SELECT 'unique_l_orderkey_l_linenumber', 'lineitem', 1, max(n), max(n) = 1
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    UNION ALL SELECT 'not_null', 'orders', 0, count(*) FILTER (o_custkey IS NULL OR o_orderdate IS NULL),
              count(*) FILTER (o_custkey IS NULL OR o_orderdate IS NULL) = 0 FROM orders
    UNION ALL SELECT 'foreign_key_l_orderkey', 'lineitem', 0, count(*), count(*) = 0
      FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def dq_report(spark, sf):
    events, lines, orders = (table(spark, sf, n) for n in ("events", "lineitem", "orders"))
    return quality.check_results(
        spark,
        [
            quality.not_empty("events", events),
            quality.unique_key("events", events, ["event_id"]),
            quality.unique_key("lineitem", lines, ["l_orderkey", "l_linenumber"]),
            quality.no_nulls("orders", orders, ["o_custkey", "o_orderdate"]),
            quality.no_orphans("lineitem", lines, "l_orderkey", orders, "o_orderkey"),
        ],
    )


@query(
    "dq_reject_split",
    f"""WITH {roles.REPORT_DRUGS_SQL}
    SELECT coalesce(CASE WHEN package_ndc IS NULL THEN 'missing_code'
                WHEN {roles.ndc_sql('package_ndc')} IS NULL THEN 'invalid_code' END, 'good') AS outcome,
           safetyreportid, package_ndc
    FROM report_drugs""",
)
def dq_reject_split(spark, sf):
    drugs = roles.report_results(spark, sf).select("safetyreportid", F.inline("patient.drug"))
    rows = drugs.select("safetyreportid", F.explode_outer("openfda.package_ndc").alias("package_ndc"))
    good, rejected = quality.split_rejects(rows, reject_rules())
    return good.withColumn("reject_reason", F.lit("good")).unionByName(rejected).select(
        F.col("reject_reason").alias("outcome"), "safetyreportid", "package_ndc"
    )


@query(
    "load_report",
    f"""WITH {roles.RAW_EVENTS_SQL}
    SELECT 'plays' AS table_name, count(*) AS rows_in, count(*) FILTER (page = 'NextSong') AS rows_out,
           count(*) FILTER (page <> 'NextSong') AS rejected FROM raw_events
    UNION ALL SELECT 'codes', count(*), count(*) FILTER ({roles.ndc_sql(f"({roles.code_sql('p_partkey')})")} IS NOT NULL),
           count(*) FILTER ({roles.ndc_sql(f"({roles.code_sql('p_partkey')})")} IS NULL) FROM part""",
)
def load_report(spark, sf):
    log = roles.events_log(spark, sf)
    part = table(spark, sf, "part")
    valid = format_ndc(roles.code(F.col("p_partkey"))).isNotNull()
    return quality.load_report({"plays": (log, F.col("page") == "NextSong"), "codes": (part, valid)})
