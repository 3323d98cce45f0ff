"""Label, adverse-event and pricing documents to the drug tables (PIPE-5 to PIPE-8, JN-8, JN-9)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.clean import flag, parse_date, parse_timestamp
from starmill.functions.ndc import format_ndc, is_ndc
from starmill.functions.nested import explode_structs, explode_values
from starmill.operators.aggregates import trend
from starmill.operators.dedupe import last_per_key
from starmill.operators.filters import drop_incomplete, require_text, require_values
from starmill.operators.joins import fits_broadcast, lookup_join
from starmill.operators.setops import union_distinct
from starmill.operators.surrogate import dense_ids
from starmill.schemas import DRUG_TABLES
from starmill.session import scratch_path
from starmill.sources.snapshots import snapshots

SERIOUSNESS = [
    "seriousnesscongenitalanomali", "seriousnessdeath", "seriousnessdisabling",
    "seriousnesshospitalization", "seriousnesslifethreatening",
]

LABEL_SECTIONS = ["active_ingredient", "adverse_reactions", "drug_interactions", "indications_and_usage", "warnings"]
LABEL_NAMES = ["brand_name", "generic_name"]
LABEL_TEXTS = [*LABEL_SECTIONS, *LABEL_NAMES]


# --- tables --------------------------------------------------------------------------------


def build_labels(results: DataFrame) -> DataFrame:
    """One row per label and package code; a label without codes keeps one row."""
    texts = [F.array_join(F.col(s), " ").alias(s) for s in LABEL_SECTIONS]
    names = [F.array_join(F.col(f"openfda.{n}"), " ").alias(n) for n in LABEL_NAMES]
    flat = results.select(*texts, *names, F.col("openfda.package_ndc").alias("codes"))
    rows = explode_values(flat, "codes", "package_ndc", LABEL_TEXTS)
    return rows.withColumn("formatted_ndc", format_ndc(F.col("package_ndc")))


def latest_reports(results: DataFrame) -> DataFrame:
    """One version per report: the last received, whole with its drugs and reactions.

    A report delivered again, or followed up, then counts once; its other columns decide between
    versions of one date. Reports without an id cannot be told apart and stay out. The ids
    alone are counted first: most reports have one version and are neither sorted nor moved.
    """
    spark = results.sparkSession
    known = results.filter(F.col("safetyreportid").isNotNull())
    counts = known.groupBy("safetyreportid").agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.filter(F.col("_n") > 1).select("safetyreportid")
    if repeated.isEmpty():
        return known
    path = scratch_path(spark, "repeated-reports")
    repeated.write.parquet(path)
    repeated = spark.read.schema(repeated.schema).parquet(path)
    if not fits_broadcast(repeated):  # then all reports have to move in any case
        return last_per_key(known, ["safetyreportid"], ["receiptdate"])
    marks = F.broadcast(repeated)
    versions = known.join(marks, "safetyreportid", "left_semi").select(*known.columns)
    once = known.join(marks, "safetyreportid", "left_anti").select(*known.columns)
    return once.unionByName(last_per_key(versions, ["safetyreportid"], ["receiptdate"]))


def build_drug_events(results: DataFrame) -> DataFrame:
    """Distinct (report, package code) pairs whose code is valid, over all documents.

    Invalid codes are left out before the shuffle, and each code is written out in full
    after it.
    """
    drugs = explode_structs(results.select("safetyreportid", "patient.drug"), "drug", ["safetyreportid"])
    flat = drugs.select("safetyreportid", F.col("openfda.package_ndc").alias("codes"))
    rows = explode_values(flat, "codes", "package_ndc", ["safetyreportid"])
    valid = drop_incomplete(rows).filter(is_ndc(F.col("package_ndc")))
    return valid.distinct().withColumn("formatted_ndc", format_ndc(F.col("package_ndc")))


def build_reactions(results: DataFrame) -> DataFrame:
    """One row per reaction named in a report; nameless ones are left out."""
    rows = explode_structs(results.select("safetyreportid", "patient.reaction"), "reaction", ["safetyreportid"])
    return require_text(rows.select("reactionmeddrapt", "safetyreportid"), ["reactionmeddrapt"])


def build_safety_reports(results: DataFrame, one_version: bool = False) -> DataFrame:
    """Distinct report headers with dates and flags; with ``one_version`` ids are known to be unique."""
    headers = results.select(
        "safetyreportid",
        F.col("patient.patientdeath").isNotNull().alias("patientdeath"),
        parse_date(F.col("receiptdate")).alias("receiptdate"),
        parse_date(F.col("receivedate")).alias("receivedate"),
        *[flag(F.col(c)).alias(c) for c in SERIOUSNESS],
    )
    return headers if one_version else headers.distinct()


def build_pricing(raw: DataFrame, latest_only: bool = False) -> DataFrame:
    """Price records with parsed dates: every snapshot, or the newest only."""
    dates = ["as_of_date", "effective_date", "corresponding_generic_drug_effective_date"]
    parsed = raw.withColumns({c: parse_timestamp(F.col(c)) for c in dates})
    return snapshots(parsed, "as_of_date", latest_only)


def build_ndc(labels: DataFrame, pricing: DataFrame) -> DataFrame:
    """The bridge: every valid code of labels and prices once."""
    codes = [require_values(labels.select(F.col("formatted_ndc").alias("ndc")), ["ndc"])]
    codes.append(require_values(pricing.select("ndc"), ["ndc"]))
    return union_distinct(*codes)


def build_warehouse(
    label_results: DataFrame, report_results: DataFrame, raw_pricing: DataFrame
) -> dict[str, DataFrame]:
    """The six tables. Pass staged parquet: the report documents feed three of them."""
    report_results = latest_reports(report_results)
    labels = build_labels(label_results)
    pricing = build_pricing(raw_pricing)
    return {
        "labels": labels,
        "pricing": pricing,
        "ndc": build_ndc(labels, pricing),
        "drug_events": build_drug_events(report_results),
        "reactions": build_reactions(report_results),
        "safety_reports": build_safety_reports(report_results, one_version=True),
    }


def number_rows(name: str, df: DataFrame, start: int = 1) -> DataFrame:
    """Add the table's IDENTITY column, counted from ``start`` in the order of the declared sort key.

    A hash of the row breaks ties, so many rows with one code still spread over partitions.
    """
    table = DRUG_TABLES[name]
    hashed = df.withColumn("_hash", F.xxhash64(*[F.col(c) for c in df.columns]))
    return dense_ids(hashed, [*table.sort_by, "_hash"], table.key[0], start).drop("_hash")


# --- queries -------------------------------------------------------------------------------


def price_summary(pricing: DataFrame) -> DataFrame:
    """Per code: number of prices, lowest, highest and newest price."""
    newest = F.max(F.struct("as_of_date", "nadac_per_unit"))
    return pricing.groupBy("ndc").agg(
        F.count(F.lit(1)).alias("n_prices"),
        F.min("nadac_per_unit").alias("min_price"),
        F.max("nadac_per_unit").alias("max_price"),
        newest.getField("nadac_per_unit").alias("latest_price"),
    )


def label_summary(labels: DataFrame) -> DataFrame:
    """Per code: number of labels and the first brand and generic name in alphabetical order."""
    return (
        require_values(labels, ["formatted_ndc"])
        .groupBy(F.col("formatted_ndc").alias("ndc"))
        .agg(
            F.count(F.lit(1)).alias("n_labels"),
            F.min("brand_name").alias("brand_name"),
            F.min("generic_name").alias("generic_name"),
        )
    )


def event_summary(drug_events: DataFrame) -> DataFrame:
    """Per code: number of (report, package) pairs."""
    return drug_events.groupBy(F.col("formatted_ndc").alias("ndc")).agg(F.count(F.lit(1)).alias("n_events"))


def bridge_join(ndc: DataFrame, drug_events: DataFrame, pricing: DataFrame, labels: DataFrame) -> DataFrame:
    """Codes known to all three sources, with each source's summary.

    Each side is summed up to one row per code before the joins: the rows of one code in
    three tables are never multiplied.
    """
    result = ndc
    for side in (event_summary(drug_events), price_summary(pricing), label_summary(labels)):
        result = result.join(side, "ndc")
    return result


def report_join(safety_reports: DataFrame, drug_events: DataFrame, reactions: DataFrame) -> DataFrame:
    """Report headers with the number of drugs and reactions, for reports that have both."""
    drugs = drug_events.groupBy("safetyreportid").agg(F.count(F.lit(1)).alias("n_drugs"))
    named = reactions.groupBy("safetyreportid").agg(F.count(F.lit(1)).alias("n_reactions"))
    return safety_reports.join(drugs, "safetyreportid").join(named, "safetyreportid")


def drugs_of_reports(drug_events: DataFrame, safety_reports: DataFrame) -> DataFrame:
    """Drug events with their report header; reports are unique, so no event is repeated."""
    return lookup_join(drug_events, safety_reports, ["safetyreportid"])


def _reaction_counts(reactions: DataFrame) -> DataFrame:
    return reactions.groupBy("safetyreportid", "reactionmeddrapt").agg(F.count(F.lit(1)).alias("_reactions"))


def reaction_trend(
    drug_events: DataFrame, reactions: DataFrame, safety_reports: DataFrame, labels: DataFrame,
    attribute: str = "brand_name", unit: str = "MONTH",
) -> DataFrame:
    """How often a reaction is reported with a drug attribute, per period.

    Both sides are counted per report first: (attribute, number of drugs) and (reaction,
    number of mentions); the product of the counts stands for the pairs.
    """
    attributes = require_values(
        labels.select("formatted_ndc", attribute), ["formatted_ndc", attribute]
    ).distinct()
    drugs = (
        lookup_join(drug_events, attributes, ["formatted_ndc"])
        .groupBy("safetyreportid", attribute)
        .agg(F.count(F.lit(1)).alias("_drugs"))
    )
    # a report has at most one row per attribute here, and one per reaction on the other side
    dated = drugs.join(safety_reports.select("safetyreportid", "receivedate"), "safetyreportid")
    pairs = dated.join(_reaction_counts(reactions), "safetyreportid")
    weighted = pairs.withColumn("_pairs", F.col("_drugs") * F.col("_reactions"))
    return trend(weighted, [attribute, "reactionmeddrapt"], F.col("receivedate"), unit, weight="_pairs")


def leading_reactions(
    drug_events: DataFrame, reactions: DataFrame, safety_reports: DataFrame, k: int = 3, unit: str = "MONTH"
) -> DataFrame:
    """The ``k`` reactions most often reported with each code in each period, with a row for empty periods.

    Columns: formatted_ndc, period, rank, reactionmeddrapt, n. Equal counts rank by name. Codes run from
    their first to their last period; a period without reports has rank 0, no reaction and n 0.

    Pairs are counted per (code, reaction, period) before anything is ranked, and each task keeps the
    first ``k`` of a code and period before the shuffle, so no task holds all of a code's reactions.
    """
    rank_of = ["formatted_ndc", "period"]
    drugs = drug_events.groupBy("safetyreportid", "formatted_ndc").agg(F.count(F.lit(1)).alias("_drugs"))
    dated = drugs.join(safety_reports.select("safetyreportid", "receivedate"), "safetyreportid")
    pairs = dated.join(_reaction_counts(reactions), "safetyreportid")
    weighted = pairs.withColumn("_pairs", F.col("_drugs") * F.col("_reactions"))
    counts = trend(weighted, ["formatted_ndc", "reactionmeddrapt"], F.col("receivedate"), unit, weight="_pairs")
    path = scratch_path(counts.sparkSession, "reaction-counts")
    counts.filter(F.col("period").isNotNull()).write.parquet(path)
    counts = counts.sparkSession.read.schema(counts.schema).parquet(path)
    order = Window.partitionBy(*rank_of).orderBy(F.desc("n"), "reactionmeddrapt")
    leading = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    spans = counts.groupBy("formatted_ndc").agg(F.min("period").alias("_first"), F.max("period").alias("_last"))
    step = F.expr(f"interval 1 {unit}")
    calendar = spans.select("formatted_ndc", F.explode(F.sequence("_first", "_last", step)).alias("period"))
    empty = calendar.join(counts.select(*rank_of).distinct(), rank_of, "left_anti").select(
        *rank_of, F.lit(0).alias("rank"), F.lit(None).cast("string").alias("reactionmeddrapt"), F.lit(0).cast("long").alias("n")
    )
    return leading.select(*rank_of, "rank", "reactionmeddrapt", "n").unionByName(empty)


def drug_profile(
    labels: DataFrame, pricing: DataFrame, drug_events: DataFrame, reactions: DataFrame
) -> DataFrame:
    """Everything known about each code in one table: ndc, section, entry, n.

    Sections are the brand names with their labels, the prices per year and the reactions with
    their mentions. A code's profile is the rows that share its ``ndc``: written with
    ``write_clustered`` on (ndc, section, entry) they lie together and are found by one lookup,
    and no code has to fit into a single row.
    """
    brands = (
        require_values(labels, ["formatted_ndc", "brand_name"])
        .groupBy(F.col("formatted_ndc").alias("ndc"), F.col("brand_name").alias("entry"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    prices = pricing.groupBy("ndc", F.year("as_of_date").cast("string").alias("entry")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_report = drug_events.groupBy("safetyreportid", "formatted_ndc").agg(F.count(F.lit(1)).alias("_drugs"))
    mentions = (
        per_report.join(_reaction_counts(reactions), "safetyreportid")
        .groupBy(F.col("formatted_ndc").alias("ndc"), F.col("reactionmeddrapt").alias("entry"))
        .agg(F.sum(F.col("_drugs") * F.col("_reactions")).alias("n"))
    )
    sections = [
        rows.select("ndc", F.lit(section).alias("section"), "entry", "n")
        for section, rows in (("brand", brands), ("price_year", prices), ("reaction", mentions))
    ]
    return sections[0].unionByName(sections[1]).unionByName(sections[2])


def drug_details(
    labels: DataFrame, pricing: DataFrame, drug_events: DataFrame, safety_reports: DataFrame
) -> DataFrame:
    """The rows behind each code in one table: ndc, section, entry, dated, amount.

    A label gives one row per text it has, a price its date and amount, an event the number and
    the day of its report. Like the profile, a code's rows lie together once written with
    ``write_clustered`` on (ndc, section, dated), and none has to fit into one record.
    """
    none = F.lit(None)
    texts = F.inline(F.array(*[F.struct(F.lit(c).alias("section"), F.col(c).alias("entry")) for c in LABEL_TEXTS]))
    known = require_values(labels, ["formatted_ndc"]).select(F.col("formatted_ndc").alias("ndc"), texts)
    label_rows = require_text(known, ["entry"]).select(
        "*", none.cast("timestamp_ntz").alias("dated"), none.cast("double").alias("amount")
    )
    prices = require_values(pricing, ["ndc"]).select(
        "ndc", F.lit("price").alias("section"), none.cast("string").alias("entry"),
        F.col("as_of_date").alias("dated"), F.col("nadac_per_unit").cast("double").alias("amount"),
    )
    days = safety_reports.select("safetyreportid", "receivedate")
    events = drug_events.join(days, "safetyreportid").select(
        F.col("formatted_ndc").alias("ndc"), F.lit("event").alias("section"), F.col("safetyreportid").alias("entry"),
        F.col("receivedate").cast("timestamp_ntz").alias("dated"), none.cast("double").alias("amount"),
    )
    return label_rows.unionByName(prices).unionByName(events)


def rejected_reports(results: DataFrame) -> DataFrame:
    """What the load leaves out or finds incomplete: safetyreportid, reason, n.

    ``missing_id`` and ``repeated_report`` count documents that are not loaded;
    ``missing_reactions`` marks loaded reports that name none. Each id is counted down before the
    shuffle, and only the chosen versions are looked into.
    """
    counts = results.groupBy("safetyreportid").agg(F.count(F.lit(1)).alias("n"))
    missing = counts.filter(F.col("safetyreportid").isNull()).select("safetyreportid", F.lit("missing_id").alias("reason"), "n")
    repeated = counts.filter(F.col("safetyreportid").isNotNull() & (F.col("n") > 1)).select(
        "safetyreportid", F.lit("repeated_report").alias("reason"), (F.col("n") - 1).alias("n")
    )
    named = F.exists("patient.reaction", lambda r: F.coalesce(r["reactionmeddrapt"], F.lit("")) != "")
    silent = latest_reports(results).filter(~F.coalesce(named, F.lit(False))).select(
        "safetyreportid", F.lit("missing_reactions").alias("reason"), F.lit(1).cast("bigint").alias("n")
    )
    return missing.unionByName(repeated).unionByName(silent)


def reject_rules() -> Mapping[str, object]:
    """Why an exploded drug row is kept out of drug_events."""
    return {
        "missing_code": F.col("package_ndc").isNull(),
        "invalid_code": ~is_ndc(F.col("package_ndc")),
    }
