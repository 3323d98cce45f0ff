"""The given tables in the roles of the raw inputs, as DataFrames and as SQL.

part = song catalogue and drug labels; lineitem with part = app log; lineitem = drug prices;
orders = adverse-event reports with nested drugs and reactions; events = play history.
Every role keeps all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.ndc import format_ndc
from starmill.functions.timeparts import to_epoch_millis
from starmill.operators.joins import lookup_join
from starmill.plans.music import normalise_events


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- song catalogue ------------------------------------------------------------------------

RAW_SONGS_SQL = """raw_songs AS (
  SELECT 'S' || CAST(p_partkey AS VARCHAR) AS song_id,
         p_name || ' ' || CAST(p_partkey // 64 AS VARCHAR) AS title,
         'A' || split_part(p_brand, '#', 2) || '-' || CAST(p_partkey // 256 AS VARCHAR) AS artist_id,
         p_brand || ' ' || CAST(p_partkey // 256 AS VARCHAR) AS artist_name,
         CASE WHEN p_size <= 10 THEN NULL WHEN p_size <= 20 THEN '' ELSE p_type END AS artist_location,
         CASE WHEN p_size <= 30 THEN NULL ELSE p_size * 1.5::DOUBLE END AS artist_latitude,
         CASE WHEN p_size <= 30 THEN NULL ELSE p_size * -2.5::DOUBLE END AS artist_longitude,
         p_retailprice AS duration,
         CASE WHEN p_size > 25 THEN 1970 + p_size ELSE 0 END AS year,
         p_partkey
  FROM part)"""


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return part.select(
        F.expr("concat('S', p_partkey)").alias("song_id"),
        F.expr("concat(p_name, ' ', p_partkey div 64)").alias("title"),
        F.expr("concat('A', split_part(p_brand, '#', 2), '-', p_partkey div 256)").alias("artist_id"),
        F.expr("concat(p_brand, ' ', p_partkey div 256)").alias("artist_name"),
        F.when(size <= 10, None).when(size <= 20, "").otherwise(F.col("p_type")).alias("artist_location"),
        F.when(size > 30, size * F.lit(1.5)).alias("artist_latitude"),
        F.when(size > 30, size * F.lit(-2.5)).alias("artist_longitude"),
        F.col("p_retailprice").alias("duration"),
        F.when(size > 25, size + 1970).otherwise(0).alias("year"),
        "p_partkey",
    )


# --- app log -------------------------------------------------------------------------------

RAW_EVENTS_SQL = (
    RAW_SONGS_SQL
    + """, raw_events AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 'Home' ELSE 'NextSong' END AS page,
         CASE WHEN l_linestatus = 'F' THEN 'paid' ELSE 'free' END AS level,
         CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         'City ' || CAST(l_suppkey // 10 AS VARCHAR) AS location,
         title || CASE WHEN l_discount = 0 THEN ' (live)' ELSE '' END AS song,
         artist_name AS artist, duration AS length,
         make_timestamp(1000 * (epoch_ms(l_shipdate)
           + (l_orderkey * 1009 + l_partkey * 7919 + l_linenumber * 97) % 86400000)) AS start_time,
         CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN NULL ELSE CAST(l_suppkey AS INTEGER) END AS user_id,
         l_orderkey AS session_id, l_linenumber AS item_in_session,
         'First' || CAST(l_suppkey AS VARCHAR) AS first_name,
         'Last' || CAST(l_suppkey AS VARCHAR) AS last_name,
         'agent ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS user_agent
  FROM lineitem JOIN raw_songs ON l_partkey = p_partkey),
plays AS (SELECT * FROM raw_events WHERE page = 'NextSong' AND start_time IS NOT NULL)"""
)


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log: source spelling, epoch milliseconds, an empty user id when logged out."""
    songs = raw_songs(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), "title", "artist_name", "duration")
    # short values, in case the lines have to move
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.expr("l_linestatus = 'F'").alias("paid"), F.expr("l_returnflag = 'N'").alias("home"),
        F.expr("l_returnflag = 'N' and l_tax = 0").alias("nobody"), F.expr("l_discount = 0").alias("live"),
        F.expr("cast(l_quantity as int)").alias("agent"),
    )
    rows = lookup_join(lines, songs, ["l_partkey"])
    offset = F.expr("(l_orderkey * 1009 + l_partkey * 7919 + l_linenumber * 97) % 86400000")
    return rows.select(
        F.col("artist_name").alias("artist"),
        F.expr("concat('First', l_suppkey)").alias("firstName"),
        F.expr("if(l_suppkey % 2 = 0, 'F', 'M')").alias("gender"),
        F.col("l_linenumber").alias("itemInSession"),
        F.expr("concat('Last', l_suppkey)").alias("lastName"),
        F.col("duration").alias("length"),
        F.expr("if(paid, 'paid', 'free')").alias("level"),
        F.expr("concat('City ', l_suppkey div 10)").alias("location"),
        F.expr("if(home, 'Home', 'NextSong')").alias("page"),
        F.col("l_orderkey").alias("sessionId"),
        F.expr("concat(title, if(live, ' (live)', ''))").alias("song"),
        (to_epoch_millis(F.col("l_shipdate")) + offset).alias("ts"),
        F.expr("concat('agent ', agent)").alias("userAgent"),
        F.expr("if(nobody, '', cast(l_suppkey as string))").alias("userId"),
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log with plain names and types."""
    return normalise_events(app_log(spark, sf_dir))


# --- play history (events) -----------------------------------------------------------------

HISTORY_SQL = """history AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 THEN 'paid' ELSE 'free' END AS level
  FROM events)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        k.alias("k"), F.when(k >= 50, "paid").otherwise("free").alias("level"),
    )


# --- drug codes ----------------------------------------------------------------------------


def code_sql(n: str) -> str:
    """A package code made from a number, in one of three layouts or without hyphens."""
    d = f"lpad(CAST({n} AS VARCHAR), 10, '0')"
    return (
        f"CASE ({n}) % 4 "
        f"WHEN 0 THEN substr({d},1,4) || '-' || substr({d},5,4) || '-' || substr({d},9,2) "
        f"WHEN 1 THEN substr({d},1,5) || '-' || substr({d},6,3) || '-' || substr({d},9,2) "
        f"WHEN 2 THEN substr({d},1,5) || '-' || substr({d},6,4) || '-' || substr({d},10,1) "
        f"ELSE {d} END"
    )


def code(n: Column) -> Column:
    digits = F.lpad(n.cast("string"), 10, "0")
    layout = n % 4
    first = F.when(layout == 0, 4).otherwise(5)
    second = F.when(layout == 1, 3).otherwise(4)
    hyphened = F.concat_ws(
        "-",
        F.substring(digits, F.lit(1), first),
        F.substring(digits, first + 1, second),
        F.substring(digits, first + second + 1, F.lit(10)),
    )
    return F.when(layout == 3, digits).otherwise(hyphened)


def ndc_sql(c: str) -> str:
    """Eleven digits of a package code, or NULL."""
    return (
        f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{4}}-[0-9]{{2}}') THEN '0' || replace({c}, '-', '') "
        f"WHEN regexp_full_match({c}, '[0-9]{{5}}-[0-9]{{3}}-[0-9]{{2}}') "
        f"THEN substr({c},1,5) || '0' || substr({c},7,3) || substr({c},11,2) "
        f"WHEN regexp_full_match({c}, '[0-9]{{5}}-[0-9]{{4}}-[0-9]') "
        f"THEN substr({c},1,5) || substr({c},7,4) || '0' || substr({c},12,1) END"
    )


# --- drug documents ------------------------------------------------------------------------

LABELS_SQL = f"""label_codes AS (
  SELECT p_name, p_type, p_brand, p_size,
         unnest([{code_sql('p_partkey')}, {code_sql('p_partkey + 1')}]) AS package_ndc
  FROM part WHERE p_size > 10
  UNION ALL SELECT p_name, p_type, p_brand, p_size, NULL FROM part WHERE p_size <= 10),
drug_labels AS (
  SELECT p_name AS active_ingredient, p_type || ' in use' AS adverse_reactions,
         CASE WHEN p_size <= 5 THEN NULL ELSE p_brand END AS brand_name,
         CAST(NULL AS VARCHAR) AS drug_interactions, {ndc_sql('package_ndc')} AS formatted_ndc,
         CASE WHEN p_size <= 5 THEN NULL ELSE p_type END AS generic_name,
         p_name || ' ' || p_type AS indications_and_usage, package_ndc, '' AS warnings
  FROM label_codes)"""


def label_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label record per part; some lack the code block, some have an empty code list."""
    codes = F.when(F.col("p_size") > 10, F.array(code(F.col("p_partkey")), code(F.col("p_partkey") + 1)))
    openfda = F.struct(
        F.coalesce(codes, F.array().cast("array<string>")).alias("package_ndc"),
        F.array("p_type").alias("generic_name"),
        F.array("p_brand").alias("brand_name"),
    )
    return table(spark, sf_dir, "part").select(
        F.array("p_name").alias("active_ingredient"),
        F.array(F.col("p_type"), F.lit("in use")).alias("adverse_reactions"),
        F.lit(None).cast("array<string>").alias("drug_interactions"),
        F.array("p_name", "p_type").alias("indications_and_usage"),
        F.array().cast("array<string>").alias("warnings"),
        F.when(F.col("p_size") > 5, openfda).alias("openfda"),
    )


REPORT_DRUGS_SQL = f"""report_drugs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, package_ndc
  FROM (SELECT o_orderkey, unnest([{code_sql('o_custkey')}, {code_sql('o_custkey + 1')}]) AS package_ndc FROM orders
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {code_sql('o_custkey')} END FROM orders)),
drug_events AS (
  SELECT DISTINCT safetyreportid, package_ndc, {ndc_sql('package_ndc')} AS formatted_ndc
  FROM report_drugs WHERE {ndc_sql('package_ndc')} IS NOT NULL)"""

REACTIONS_SQL = """reactions AS (
  SELECT reactionmeddrapt, CAST(o_orderkey AS VARCHAR) AS safetyreportid
  FROM (SELECT o_orderkey, o_orderpriority AS reactionmeddrapt FROM orders
        UNION ALL
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Fatigue' WHEN 'O' THEN '' END FROM orders)
  WHERE reactionmeddrapt <> '')"""

SAFETY_REPORTS_SQL = """safety_reports AS (
  SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS safetyreportid,
         o_orderstatus = 'F' AS patientdeath,
         CAST(o_orderdate AS DATE) AS receiptdate, CAST(o_orderdate AS DATE) AS receivedate,
         CAST(NULL AS BOOLEAN) AS seriousnesscongenitalanomali,
         o_orderstatus = 'F' AS seriousnessdeath,
         CASE WHEN o_totalprice > 400000 THEN TRUE END AS seriousnessdisabling,
         o_orderpriority = '1-URGENT' AS seriousnesshospitalization,
         o_orderpriority = '2-HIGH' AS seriousnesslifethreatening
  FROM orders)"""


def report_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per order, with arrays of drugs and reactions made from the row itself."""
    date_text = F.date_format("o_orderdate", "yyyyMMdd")
    block = "struct<package_ndc: array<string>>"
    both = F.struct(F.array("own_code", "next_code").alias("package_ndc")).cast(block)
    one = F.struct(F.array("own_code").alias("package_ndc")).cast(block)
    drugs = F.array(
        F.struct(both.alias("openfda")),
        F.struct(F.when(F.col("o_orderstatus") != "P", one).alias("openfda")),
    )
    second = F.when(F.col("o_orderstatus") == "F", "Fatigue").when(F.col("o_orderstatus") == "O", "")
    reactions = F.array(
        F.struct(F.col("o_orderpriority").alias("reactionmeddrapt")), F.struct(second.alias("reactionmeddrapt"))
    )
    death = F.when(F.col("o_orderstatus") == "F", F.struct(date_text.alias("patientdeathdate")))

    def digit(condition: Column) -> Column:
        return F.when(condition, "1").otherwise("2")

    orders = table(spark, sf_dir, "orders").withColumns(
        {"own_code": code(F.col("o_custkey")), "next_code": code(F.col("o_custkey") + 1)}
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("safetyreportid"),
        date_text.alias("receivedate"),
        date_text.alias("receiptdate"),
        digit(F.col("o_orderpriority") == "1-URGENT").alias("seriousnesshospitalization"),
        digit(F.col("o_orderstatus") == "F").alias("seriousnessdeath"),
        digit(F.col("o_orderpriority") == "2-HIGH").alias("seriousnesslifethreatening"),
        F.when(F.col("o_totalprice") > 400000, "1").alias("seriousnessdisabling"),
        F.lit(None).cast("string").alias("seriousnesscongenitalanomali"),
        F.struct(death.alias("patientdeath"), drugs.alias("drug"), reactions.alias("reaction")).alias("patient"),
    )


PRICING_SQL = f"""pricing AS (
  SELECT l_shipdate AS as_of_date, l_shipdate AS effective_date,
         coalesce({ndc_sql(f'({code_sql("l_partkey")})')}, lpad(CAST(l_partkey AS VARCHAR), 11, '0')) AS ndc,
         l_extendedprice AS nadac_per_unit, l_linestatus AS otc
  FROM lineitem)"""


def raw_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price record per line, dated by its ship date."""
    number = F.col("l_partkey")
    day = F.col("l_shipdate").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        day.alias("as_of_date"),
        day.alias("effective_date"),
        day.alias("corresponding_generic_drug_effective_date"),
        F.coalesce(format_ndc(code(number)), F.lpad(number.cast("string"), 11, "0")).alias("ndc"),
        F.col("l_extendedprice").alias("nadac_per_unit"),
        F.col("l_linestatus").alias("otc"),
    )
