"""Drug tables and the queries across them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries import roles
from driver_queries.registry import query
from driver_queries.roles import table
from starmill.operators import history
from starmill.operators.aggregates import snapshot_probe
from starmill.operators.setops import conform
from starmill.plans import drug, scheduled
from starmill.schemas import RAW_PRICING
from starmill.session import scratch_path
from starmill.sinks.colocated import count_colocated, write_colocated
from starmill.sinks.tables import write_table
from starmill.sources.files import read_documents, read_table
from starmill.sources.snapshots import snapshots


@query("drug_labels", f"WITH {roles.LABELS_SQL} SELECT * FROM drug_labels")
def drug_labels(spark, sf):
    return drug.build_labels(roles.label_results(spark, sf))


@query("ndc_events", f"WITH {roles.REPORT_DRUGS_SQL} SELECT * FROM drug_events")
def ndc_events(spark, sf):
    return drug.build_drug_events(roles.report_results(spark, sf))


@query("drug_reactions", f"WITH {roles.REACTIONS_SQL} SELECT * FROM reactions")
def drug_reactions(spark, sf):
    return drug.build_reactions(roles.report_results(spark, sf))


@query("safety_reports", f"WITH {roles.SAFETY_REPORTS_SQL} SELECT * FROM safety_reports")
def safety_reports(spark, sf):
    return drug.build_safety_reports(roles.report_results(spark, sf))


@query("documents_read", f"WITH {roles.SAFETY_REPORTS_SQL} SELECT * FROM safety_reports")
def documents_read(spark, sf):
    """Reports written as nested documents of at most 4096, one a file, and read again."""
    path = scratch_path(spark, "documents")
    reports = roles.report_results(spark, sf)
    number = F.expr("cast(safetyreportid as bigint) div 4096")
    documents = reports.groupBy(number.alias("document")).agg(F.collect_list(F.struct(*reports.columns)).alias("results"))
    documents.write.partitionBy("document").json(path)
    schema = T.StructType().add("results", T.ArrayType(reports.schema))
    return drug.build_safety_reports(read_documents(spark, path, schema))


@query(
    "pricing_updates",
    f"WITH {roles.PRICING_SQL} SELECT ndc, as_of_date, nadac_per_unit, otc FROM pricing WHERE as_of_date IS NOT NULL",
)
def pricing_updates(spark, sf):
    """A first load, several unseen snapshots at once, and the same again."""
    base = scratch_path(spark, "prices")
    database = "starmill_" + base.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    prices = conform(roles.raw_pricing(spark, sf), RAW_PRICING)
    seen = F.col("as_of_date").cast("timestamp_ntz")
    scheduled.run_drug_warehouse(
        spark, roles.label_results(spark, sf), roles.report_results(spark, sf),
        prices.filter(seen < F.lit("1997-01-01").cast("timestamp_ntz")), f"{base}/house", database,
    )
    later = prices.filter(seen < F.lit("1999-01-01").cast("timestamp_ntz"))
    for delivery in (later, prices, prices):
        stored = scheduled.update_pricing(spark, delivery, f"{base}/house", database)
    return stored.select("ndc", "as_of_date", "nadac_per_unit", "otc")


@query("snapshot_probe", "SELECT count(o_orderdate) AS row_count, max(o_orderdate) AS max_as_of FROM orders")
def snapshot_probe_query(spark, sf):
    return snapshot_probe(table(spark, sf, "orders"), "o_orderdate")


@query(
    "latest_snapshot",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def latest_snapshot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return snapshots(orders, "o_orderdate", latest_only=True)


PRICE_COLUMNS = "ndc, as_of_date, effective_date, nadac_per_unit, otc"


@query("drug_prices", f"WITH {roles.PRICING_SQL} SELECT {PRICE_COLUMNS} FROM pricing")
def drug_prices(spark, sf):
    return drug.build_pricing(roles.raw_pricing(spark, sf)).select(*PRICE_COLUMNS.split(", "))


@query(
    "drug_prices_latest",
    f"""WITH {roles.PRICING_SQL} SELECT {PRICE_COLUMNS} FROM pricing
    WHERE as_of_date = (SELECT max(as_of_date) FROM pricing)""",
)
def drug_prices_latest(spark, sf):
    return drug.build_pricing(roles.raw_pricing(spark, sf), latest_only=True).select(*PRICE_COLUMNS.split(", "))


NDC_SQL = """ndc AS (
  SELECT formatted_ndc AS ndc FROM drug_labels WHERE formatted_ndc IS NOT NULL UNION SELECT ndc FROM pricing)"""


@query("ndc_bridge", f"WITH {roles.LABELS_SQL}, {roles.PRICING_SQL}, {NDC_SQL} SELECT ndc FROM ndc")
def ndc_bridge(spark, sf):
    labels = drug.build_labels(roles.label_results(spark, sf))
    return drug.build_ndc(labels, drug.build_pricing(roles.raw_pricing(spark, sf)))


def warehouse(spark, sf, *inputs):
    """The six tables; the named inputs are staged once, the others stay unread."""
    base = scratch_path(spark, "drug")
    raw = {
        "labels": roles.label_results(spark, sf),
        "reports": roles.report_results(spark, sf),
        "pricing": roles.raw_pricing(spark, sf),
    }
    for name in inputs:
        write_table(raw[name], f"{base}/{name}")
        raw[name] = read_table(spark, f"{base}/{name}", raw[name].schema)
    return drug.build_warehouse(raw["labels"], raw["reports"], raw["pricing"])


@query(
    "bridge_join",
    f"""WITH {roles.LABELS_SQL}, {roles.PRICING_SQL}, {NDC_SQL}, {roles.REPORT_DRUGS_SQL},
    e AS (SELECT formatted_ndc AS ndc, count(*) AS n_events FROM drug_events GROUP BY 1),
    p AS (SELECT ndc, count(*) AS n_prices, min(nadac_per_unit) AS min_price, max(nadac_per_unit) AS max_price,
                 max_by(nadac_per_unit, (as_of_date, nadac_per_unit)) AS latest_price FROM pricing GROUP BY 1),
    l AS (SELECT formatted_ndc AS ndc, count(*) AS n_labels, min(brand_name) AS brand_name,
                 min(generic_name) AS generic_name FROM drug_labels WHERE formatted_ndc IS NOT NULL GROUP BY 1)
    SELECT * FROM ndc JOIN e USING (ndc) JOIN p USING (ndc) JOIN l USING (ndc)""",
)
def bridge_join(spark, sf):
    w = warehouse(spark, sf, "labels", "reports", "pricing")
    return drug.bridge_join(w["ndc"], w["drug_events"], w["pricing"], w["labels"])


@query(
    "report_join",
    f"""WITH {roles.SAFETY_REPORTS_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.REACTIONS_SQL},
    d AS (SELECT safetyreportid, count(*) AS n_drugs FROM drug_events GROUP BY 1),
    r AS (SELECT safetyreportid, count(*) AS n_reactions FROM reactions GROUP BY 1)
    SELECT * FROM safety_reports JOIN d USING (safetyreportid) JOIN r USING (safetyreportid)""",
)
def report_join(spark, sf):
    w = warehouse(spark, sf, "reports")
    return drug.report_join(w["safety_reports"], w["drug_events"], w["reactions"])


@query(
    "report_join_stored",
    f"""WITH {roles.SAFETY_REPORTS_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.REACTIONS_SQL},
    d AS (SELECT safetyreportid, count(*) AS n_drugs FROM drug_events GROUP BY 1),
    r AS (SELECT safetyreportid, count(*) AS n_reactions FROM reactions GROUP BY 1)
    SELECT * FROM safety_reports JOIN d USING (safetyreportid) JOIN r USING (safetyreportid)""",
)
def report_join_stored(spark, sf):
    """The same from three tables stored in the same buckets: no rows are moved."""
    w = warehouse(spark, sf, "reports")
    base = scratch_path(spark, "colocated")
    mark = base.rsplit("-", 1)[1]
    names = {n: f"{n}_{mark}" for n in ("safety_reports", "drug_events", "reactions")}
    stored = write_colocated(
        {names["safety_reports"]: w["safety_reports"]}, {names[n]: w[n] for n in ("drug_events", "reactions")},
        base, "safetyreportid", 8,
    )
    many = {"n_drugs": stored[names["drug_events"]], "n_reactions": stored[names["reactions"]]}
    return count_colocated(spark, stored[names["safety_reports"]], many, "safetyreportid")


@query(
    "report_drug_lines",
    f"""WITH {roles.SAFETY_REPORTS_SQL}, {roles.REPORT_DRUGS_SQL}
    SELECT safetyreportid, package_ndc, formatted_ndc, receivedate, seriousnessdeath
    FROM drug_events JOIN safety_reports USING (safetyreportid)""",
)
def report_drug_lines(spark, sf):
    w = warehouse(spark, sf, "reports")
    rows = drug.drugs_of_reports(w["drug_events"], w["safety_reports"])
    return rows.select("safetyreportid", "package_ndc", "formatted_ndc", "receivedate", "seriousnessdeath")


@query(
    "reaction_trend",
    f"""WITH {roles.LABELS_SQL}, {roles.SAFETY_REPORTS_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.REACTIONS_SQL},
    b AS (SELECT DISTINCT formatted_ndc, brand_name FROM drug_labels
          WHERE formatted_ndc IS NOT NULL AND brand_name IS NOT NULL)
    SELECT brand_name, reactionmeddrapt, CAST(date_trunc('month', receivedate) AS DATE) AS period, count(*) AS n
    FROM drug_events JOIN b USING (formatted_ndc) JOIN safety_reports USING (safetyreportid)
    JOIN reactions USING (safetyreportid) GROUP BY 1, 2, 3""",
)
def reaction_trend(spark, sf):
    w = warehouse(spark, sf, "labels", "reports")
    return drug.reaction_trend(w["drug_events"], w["reactions"], w["safety_reports"], w["labels"])


@query(
    "drug_profile",
    f"""WITH {roles.LABELS_SQL}, {roles.PRICING_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.REACTIONS_SQL}
    SELECT formatted_ndc AS ndc, 'brand' AS section, brand_name AS entry, count(*) AS n FROM drug_labels
    WHERE formatted_ndc IS NOT NULL AND brand_name IS NOT NULL GROUP BY 1, 3
    UNION ALL
    SELECT ndc, 'price_year', CAST(year(as_of_date) AS VARCHAR), count(*) FROM pricing GROUP BY 1, 3
    UNION ALL
    SELECT formatted_ndc, 'reaction', reactionmeddrapt, count(*)
    FROM drug_events JOIN reactions USING (safetyreportid) GROUP BY 1, 3""",
)
def drug_profile(spark, sf):
    w = warehouse(spark, sf, "labels", "reports", "pricing")
    return drug.drug_profile(w["labels"], w["pricing"], w["drug_events"], w["reactions"])


LABEL_TEXTS_SQL = " UNION ALL ".join(
    f"""SELECT formatted_ndc AS ndc, '{c}' AS section, {c} AS entry, CAST(NULL AS TIMESTAMP) AS dated,
        CAST(NULL AS DOUBLE) AS amount FROM drug_labels WHERE formatted_ndc IS NOT NULL AND {c} <> ''"""
    for c in drug.LABEL_TEXTS
)


@query(
    "drug_details",
    f"""WITH {roles.LABELS_SQL}, {roles.PRICING_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.SAFETY_REPORTS_SQL}
    {LABEL_TEXTS_SQL}
    UNION ALL SELECT ndc, 'price', NULL, as_of_date, nadac_per_unit FROM pricing
    UNION ALL SELECT formatted_ndc, 'event', safetyreportid, CAST(receivedate AS TIMESTAMP), NULL
    FROM drug_events JOIN safety_reports USING (safetyreportid)""",
)
def drug_details(spark, sf):
    w = warehouse(spark, sf, "labels", "reports", "pricing")
    return drug.drug_details(w["labels"], w["pricing"], w["drug_events"], w["safety_reports"])


def report_deliveries(spark, sf):
    """All reports; those of a death come twice, and open ones are followed up without reactions."""
    reports = roles.report_results(spark, sf)
    deadly = reports.filter("patient.patientdeath IS NOT NULL")
    second = F.get("patient.reaction", F.lit(1))["reactionmeddrapt"]
    later = reports.filter("patient.patientdeath IS NULL").filter(second == "").withColumns({
        "receiptdate": F.lit("29991231"),
        "patient": F.col("patient").withField("reaction", F.slice("patient.reaction", 1, 0)),
    })
    return reports.unionByName(deadly).unionByName(later)


@query(
    "rejected_reports",
    """SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, 'repeated_report' AS reason, CAST(1 AS BIGINT) AS n
    FROM orders WHERE o_orderstatus IN ('F', 'O')
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'missing_reactions', CAST(1 AS BIGINT)
    FROM orders WHERE o_orderstatus = 'O'""",
)
def rejected_reports(spark, sf):
    return drug.rejected_reports(report_deliveries(spark, sf))


@query(
    "report_versions",
    f"""WITH {roles.SAFETY_REPORTS_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.REACTIONS_SQL},
    d AS (SELECT safetyreportid, count(*) AS n_drugs FROM drug_events GROUP BY 1),
    r AS (SELECT safetyreportid, count(*) AS n_reactions FROM reactions GROUP BY 1),
    o AS (SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid FROM orders WHERE o_orderstatus <> 'O')
    SELECT * FROM safety_reports JOIN d USING (safetyreportid) JOIN r USING (safetyreportid)
    JOIN o USING (safetyreportid)""",
)
def report_versions(spark, sf):
    """Repeated reports count once, and the last version's reactions hold."""
    path = scratch_path(spark, "reports")
    deliveries = report_deliveries(spark, sf)
    write_table(deliveries, path)
    w = drug.build_warehouse(
        roles.label_results(spark, sf), read_table(spark, path, deliveries.schema), roles.raw_pricing(spark, sf)
    )
    return drug.report_join(w["safety_reports"], w["drug_events"], w["reactions"])


@query(
    "drug_event_ids",
    f"""WITH {roles.REPORT_DRUGS_SQL}
    SELECT formatted_ndc, count(*) AS n, max(drug_event_id) - min(drug_event_id) + 1 AS span,
           min(drug_event_id) AS first_id
    FROM (SELECT formatted_ndc, row_number() OVER (ORDER BY formatted_ndc) AS drug_event_id FROM drug_events)
    GROUP BY 1""",
)
def drug_event_ids(spark, sf):
    """The ids of one code are consecutive; which row has which is free, so runs are compared."""
    numbered = drug.number_rows("drug_events", drug.build_drug_events(roles.report_results(spark, sf)))
    return numbered.groupBy("formatted_ndc").agg(
        F.count(F.lit(1)).alias("n"),
        (F.max("drug_event_id") - F.min("drug_event_id") + 1).alias("span"),
        F.min("drug_event_id").alias("first_id"),
    )


# --- price history -------------------------------------------------------------------------

# a snapshot a month, which holds the greatest price of each code in that month
PRICE_HISTORY_SQL = f"""{roles.PRICING_SQL},
price_list AS (SELECT ndc, date_trunc('month', as_of_date)::TIMESTAMP AS month, max((nadac_per_unit, otc)) AS state
               FROM pricing WHERE as_of_date IS NOT NULL GROUP BY ALL),
months AS (SELECT month, lead(month) OVER (ORDER BY month) AS next_month, row_number() OVER (ORDER BY month) AS pos
           FROM (SELECT DISTINCT month FROM price_list)),
listed AS (SELECT *, lag(pos) OVER w AS pos_before, lag(state) OVER w AS state_before FROM price_list JOIN months USING (month)
           WINDOW w AS (PARTITION BY ndc ORDER BY pos)),
runs AS (SELECT *, sum(CASE WHEN pos_before + 1 = pos AND state_before IS NOT DISTINCT FROM state THEN 0 ELSE 1 END)
         OVER (PARTITION BY ndc ORDER BY pos) AS run FROM listed),
history AS (SELECT ndc, any_value(state)[1] AS nadac_per_unit, any_value(state)[2] AS otc, min(month) AS valid_from,
                   CASE WHEN max(pos) < (SELECT max(pos) FROM months) THEN max(next_month) END AS valid_to
            FROM runs GROUP BY ndc, run)"""
OLD, NEW = "1996-03-15", "1997-09-01"


def _held(day: str) -> str:
    return f"valid_from <= TIMESTAMP '{day}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{day}')"


def price_intervals(spark, sf):
    prices = drug.build_pricing(roles.raw_pricing(spark, sf))
    month = F.date_trunc("month", "as_of_date").cast("timestamp_ntz")
    return history.validity(prices.withColumn("month", month), ["ndc"], "month", ["nadac_per_unit", "otc"])


@query("price_history", f"WITH {PRICE_HISTORY_SQL} SELECT * FROM history")
def price_history(spark, sf):
    """Each code's prices with the months in which they held."""
    return price_intervals(spark, sf)


@query("price_as_of", f"WITH {PRICE_HISTORY_SQL} SELECT ndc, nadac_per_unit, otc FROM history WHERE {_held(OLD)}")
def price_as_of(spark, sf):
    """The price list of a past day."""
    when = F.lit(OLD).cast("timestamp_ntz")
    return history.as_of(price_intervals(spark, sf), when).select("ndc", "nadac_per_unit", "otc")


@query(
    "price_changes",
    f"""WITH {PRICE_HISTORY_SQL},
    old AS (SELECT * FROM history WHERE {_held(OLD)}), new AS (SELECT * FROM history WHERE {_held(NEW)})
    SELECT ndc, CASE WHEN old.valid_from IS NULL THEN 'insert' WHEN new.valid_from IS NULL THEN 'close' ELSE 'change' END AS change,
           old.nadac_per_unit AS old_nadac_per_unit, new.nadac_per_unit AS new_nadac_per_unit,
           old.otc AS old_otc, new.otc AS new_otc
    FROM old FULL JOIN new USING (ndc)
    WHERE old.valid_from IS NULL OR new.valid_from IS NULL OR (old.nadac_per_unit, old.otc) <> (new.nadac_per_unit, new.otc)""",
)
def price_changes(spark, sf):
    """What was inserted, changed and closed between two days."""
    days = [F.lit(d).cast("timestamp_ntz") for d in (OLD, NEW)]
    return history.changes(price_intervals(spark, sf), ["ndc"], ["nadac_per_unit", "otc"], *days)


# --- leading reactions ---------------------------------------------------------------------


@query(
    "leading_reactions",
    f"""WITH {roles.SAFETY_REPORTS_SQL}, {roles.REPORT_DRUGS_SQL}, {roles.REACTIONS_SQL},
    counts AS (SELECT formatted_ndc, reactionmeddrapt, CAST(date_trunc('month', receivedate) AS DATE) AS period, count(*) AS n
               FROM drug_events JOIN safety_reports USING (safetyreportid) JOIN reactions USING (safetyreportid)
               WHERE receivedate IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT formatted_ndc, period, CAST(row_number() OVER (PARTITION BY formatted_ndc, period
               ORDER BY n DESC, reactionmeddrapt) AS INTEGER) AS rank, reactionmeddrapt, n FROM counts),
    calendar AS (SELECT formatted_ndc, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period
                 FROM counts GROUP BY formatted_ndc)
    SELECT * FROM ranked WHERE rank <= 3
    UNION ALL SELECT formatted_ndc, period, 0, NULL, 0 FROM calendar ANTI JOIN counts USING (formatted_ndc, period)""",
)
def leading_reactions(spark, sf):
    """The three reactions named most with each code in each month, months without any among them."""
    w = warehouse(spark, sf, "reports")
    return drug.leading_reactions(w["drug_events"], w["reactions"], w["safety_reports"])
