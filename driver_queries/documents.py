"""Nested and drifting documents, written as JSON lines and read without a schema."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries import roles
from driver_queries.registry import query
from driver_queries.roles import table
from starmill.operators.relational import relational
from starmill.session import scratch_path
from starmill.sources import drift

# --- nested reports ------------------------------------------------------------------------


def report_tables(spark, sf):
    """The reports as JSON, their shape inferred, as flat tables."""
    path = scratch_path(spark, "report-lines")
    roles.report_results(spark, sf).write.json(path)
    return relational(spark.read.json(path), ["safetyreportid"], "reports")


@query(
    "documents_relational",
    """SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, strftime(o_orderdate, '%Y%m%d') AS receivedate,
           strftime(o_orderdate, '%Y%m%d') AS receiptdate,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') END AS "patient.patientdeath.patientdeathdate"
    FROM orders""",
)
def documents_relational(spark, sf):
    """Structs in structs as dotted columns."""
    reports = report_tables(spark, sf)["reports"]
    return reports.select("safetyreportid", "receivedate", "receiptdate", "`patient.patientdeath.patientdeathdate`")


@query(
    "documents_relational_codes",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, CAST(drug AS INTEGER) AS "patient.drug#",
           CAST(place AS INTEGER) AS "patient.drug.openfda.package_ndc#", code AS value
    FROM (SELECT o_orderkey, 0 AS drug, 0 AS place, {roles.code_sql('o_custkey')} AS code FROM orders
          UNION ALL SELECT o_orderkey, 0, 1, {roles.code_sql('o_custkey + 1')} FROM orders
          UNION ALL SELECT o_orderkey, 1, 0, {roles.code_sql('o_custkey')} FROM orders WHERE o_orderstatus <> 'P')""",
)
def documents_relational_codes(spark, sf):
    """Arrays of values in arrays of structs, with the places of both."""
    return report_tables(spark, sf)["reports.patient.drug.openfda.package_ndc"]


@query(
    "documents_relational_reactions",
    """SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, CAST(place AS INTEGER) AS "patient.reaction#", reactionmeddrapt
    FROM (SELECT o_orderkey, 0 AS place, o_orderpriority AS reactionmeddrapt FROM orders
          UNION ALL
          SELECT o_orderkey, 1, CASE o_orderstatus WHEN 'F' THEN 'Fatigue' WHEN 'O' THEN '' END FROM orders)""",
)
def documents_relational_reactions(spark, sf):
    return report_tables(spark, sf)["reports.patient.reaction"]


# --- drifting orders -----------------------------------------------------------------------

ORDER = (
    T.StructType().add("o_orderkey", "long").add("o_custkey", "long").add("o_totalprice", "double")
    .add("o_orderpriority", "string").add("ship", T.StructType().add("day", "string").add("status", "string"))
)


def order_lines(spark, sf):
    """Three deliveries: as declared; without a field and with two new ones; with another type and broken lines."""
    path = scratch_path(spark, "order-lines")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    ship = F.struct(day, F.col("o_orderstatus").alias("status"))
    carried = F.struct(day, F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 10).alias("carrier"))
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    priced = F.concat(F.lit("USD "), F.col("o_custkey")).alias("o_totalprice")
    keys = ["o_orderkey", "o_custkey"]
    text = (
        F.when(F.col("delivery") == 0, F.to_json(F.struct(*keys, price, priority, ship.alias("ship"))))
        .when(F.col("delivery") == 1, F.to_json(F.struct(*keys, price, F.col("o_clerk_no").alias("clerk"), carried.alias("ship"))))
        .when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit('{"o_orderkey": '), "o_orderkey"))
        .otherwise(F.to_json(F.struct(*keys, priced, priority, ship.alias("ship"))))
    )
    orders = table(spark, sf, "orders").withColumns(
        {"delivery": F.col("o_orderkey") % 3, "o_clerk_no": F.col("o_custkey") % 100}
    )
    orders.select("delivery", text.alias("value")).write.partitionBy("delivery").text(path)
    return drift.read_lines(spark, path)


@query(
    "drifting_documents",
    """SELECT CASE WHEN NOT bad THEN o_orderkey END AS o_orderkey, CASE WHEN NOT bad THEN o_custkey END AS o_custkey,
           CASE WHEN delivery < 2 THEN o_totalprice END AS o_totalprice,
           CASE WHEN NOT bad AND delivery <> 1 THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN NOT bad THEN strftime(o_orderdate, '%Y-%m-%d') END AS "ship.day",
           CASE WHEN NOT bad THEN o_orderstatus END AS "ship.status",
           CASE WHEN delivery = 1 THEN CAST(o_custkey % 100 AS VARCHAR) END AS rest_clerk,
           CASE WHEN delivery = 1 THEN CAST(o_custkey % 10 AS VARCHAR) END AS rest_carrier,
           CASE WHEN delivery = 2 AND NOT bad THEN '"USD ' || CAST(o_custkey AS VARCHAR) || '"' END AS rest_price,
           CASE WHEN bad THEN '{"o_orderkey": ' || CAST(o_orderkey AS VARCHAR) END AS bad_line
    FROM (SELECT *, o_orderkey % 3 AS delivery, o_orderkey % 3 = 2 AND o_orderkey % 7 = 0 AS bad FROM orders)""",
)
def drifting_documents(spark, sf):
    """Every field of every line is in a declared column, in the rest, or in the broken line."""
    staged = drift.stage_drifting(order_lines(spark, sf), ORDER)
    rest = {"rest_clerk": "clerk", "rest_carrier": "ship.carrier", "rest_price": "o_totalprice"}
    return staged.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "`ship.day`", "`ship.status`",
        *[F.try_element_at(drift.REST, F.lit(path)).alias(name) for name, path in rest.items()],
        F.col(drift.BAD_LINE).alias("bad_line"),
    )


@query(
    "drift_report",
    """WITH lines AS (SELECT o_orderkey % 3 AS delivery, o_orderkey % 3 = 2 AND o_orderkey % 7 = 0 AS bad FROM orders),
    found AS (
      SELECT 1 AS delivery, 'new' AS kind, 'clerk' AS path, 'number' AS found UNION ALL SELECT 1, 'new', 'ship.carrier', 'number'
      UNION ALL SELECT 1, 'absent', 'o_orderpriority', NULL UNION ALL SELECT 2, 'retyped', 'o_totalprice', 'string')
    SELECT 'delivery=' || CAST(delivery AS VARCHAR) AS file, kind, path, found, count(*) AS n_lines
    FROM found JOIN lines USING (delivery) WHERE NOT bad GROUP BY ALL
    UNION ALL SELECT 'delivery=2', 'skipped', NULL, NULL, count(*) FROM lines WHERE bad HAVING count(*) > 0""",
)
def drift_report(spark, sf):
    """What each delivery holds beside what is declared."""
    delivery = F.regexp_extract(drift.FILE, "delivery=[0-9]+", 0)
    return drift.drift_report(order_lines(spark, sf), ORDER, delivery)
