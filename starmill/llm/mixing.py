"""Mixing sources to target weights (operator 6).

Temperature mixing: the weight of a source is its share of all tokens to the power ``a``,
normalised. ``a`` is found by bisection, either for a target entropy of the weights or so that no
source is repeated more often than a limit. The weights are realised as passes over the
documents of each source. A pass deals its documents to blocks by a keyed hash, so that the block
number and the hash inside a block are the permutation, anew in each pass. The last pass of a
source stops when its budget of tokens is used: whole blocks first, then documents of one block
in order. All that decides about a document is one cut (block and hash) per source, so documents
are neither sorted nor moved.

``place`` puts all sources into one sequence: it is the part of its source's run that lies before
a block, so every stretch of the sequence holds the sources by their weights.

Defined cases: a null source is a source of its own. A source without tokens is taken once.
A null or empty text has no tokens. Repeated rows are separate documents; where the
last pass ends among equal ones, it takes as many of them as its budget needs. No rows give no rows.
More than ``MAX_SOURCES`` sources raise an error: their weights are fitted on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import query, store, table, text_or_empty, whole_row

MAX_SOURCES = 100_000
BLOCK_TOKENS = 1 << 20
SEED = 20_177


def entropy(weights: Mapping) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def weights_at(tokens: Mapping, exponent: float) -> dict:
    """Normalised powers of the shares; sources without tokens have no weight."""
    top = max(tokens.values(), default=0)
    powers = {s: (n / top) ** exponent if n else 0.0 for s, n in tokens.items()}
    total = sum(powers.values())
    return {s: p / total if total else 0.0 for s, p in powers.items()}


def repeats_at(tokens: Mapping, exponent: float, budget: float | None = None) -> dict:
    """Passes over each source. Without a budget, the least used source is passed over once."""
    rates = {s: w / tokens[s] for s, w in weights_at(tokens, exponent).items() if tokens[s]}
    if not rates:
        return {}
    scale = budget if budget is not None else 1 / min(rates.values())
    return {s: r * scale for s, r in rates.items()}


def fit_exponent(
    tokens: Mapping, max_repeats: float | None = None, target_entropy: float | None = None, budget: float | None = None
) -> float:
    """Bisect the exponent; a greater one means more weight on the large sources.

    For ``max_repeats`` the least exponent from 0 to 1 that keeps to the limit; for
    ``target_entropy`` the one from 0 to 16 whose weights have it (the nearer end if none has).
    """
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give max_repeats or target_entropy")
    if max_repeats is not None:
        low, high = 0.0, 1.0

        def flat_enough(a: float) -> bool:
            return max(repeats_at(tokens, a, budget).values(), default=0.0) <= max_repeats * (1 + 1e-12)
    else:
        low, high = 0.0, 16.0

        def flat_enough(a: float) -> bool:
            return entropy(weights_at(tokens, a)) <= target_entropy

    if flat_enough(low):
        return low
    if not flat_enough(high):
        if max_repeats is not None:
            raise ValueError("the budget repeats the sources more often than the limit at any exponent")
        return high
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if flat_enough(middle) else (middle, high)
    return high


def token_count(text: str = "text") -> Column:
    """Words between white space, the measure of a source here."""
    return F.regexp_count(text_or_empty(text), F.lit(r"\S+")).cast("long")


def _identity() -> Column:
    return F.xxhash64("row.doc_id", "row.text")


def _hash(*parts: Column) -> Column:
    return F.xxhash64(F.lit(SEED), F.col("pass"), F.col("identity"), *parts)


def _first_of_each(rows: DataFrame) -> DataFrame:
    """As many rows of each ``number`` as it needs. They are counted per written task, so no group meets in one."""
    written = store(rows.withColumn("_id", F.monotonically_increasing_id()), "copies")
    written = written.withColumn("_task", F.shiftright("_id", 33))
    counts = written.groupBy("number", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("number").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("number", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.row_number().over(Window.partitionBy("number", "_task").orderBy("_id"))
    return written.join(starts, ["number", "_task"]).filter(place <= F.col("needed")).select(*rows.columns)


def mix(docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None,
        budget: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of ``docs`` as ``row``, one for each pass that takes them, with ``pass``, ``block``,
    ``place`` (order of blocks over all sources) and ``hash`` (order in a block)."""
    spark = docs.sparkSession
    rows = docs.select(whole_row(), F.col("source").alias("origin"))
    counted = rows.groupBy("origin").agg(F.sum(token_count("row.text")).alias("tokens"))
    found = counted.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them before mixing")
    tokens = {r.origin: r.tokens for r in found}
    exponent = fit_exponent(tokens, max_repeats, target_entropy, budget)
    repeats = repeats_at(tokens, exponent, budget)
    plan = spark.createDataFrame(
        [(s, float(repeats.get(s, 1.0)), n, max(1, -(-n // block_tokens))) for s, n in tokens.items()],
        "origin string, repeats double, tokens long, blocks long",
    ).withColumns({
        "whole": F.floor(F.col("repeats") + 1e-9),
        "rest": F.floor((F.col("repeats") - F.floor(F.col("repeats") + 1e-9)) * F.col("tokens")).cast("long"),
    })

    def passed(df: DataFrame, plan: DataFrame, passes: Column) -> DataFrame:
        own = plan.withColumnRenamed("origin", "_o")
        dealt = df.join(F.broadcast(own), F.col("origin").eqNullSafe(F.col("_o"))).drop("_o")
        dealt = dealt.withColumn("identity", _identity()).withColumn("pass", F.explode(passes))
        return dealt.withColumns({"block": F.pmod(_hash(F.lit(0)), "blocks"), "hash": _hash(F.lit(1))})

    # where the last pass of each source ends: one block, and one hash in it
    partial = plan.filter(F.col("rest") > 0)
    last = passed(rows, partial, F.array(F.col("whole")))
    light = store(last.select("origin", "block", "hash", "rest", token_count("row.text").alias("n")), "last-pass")
    sums = light.groupBy("origin", "rest", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("origin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cuts = (
        starts.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("n") >= F.col("rest")))
        .groupBy("origin").agg(F.min_by("block", "start").alias("cut"), F.min("start").alias("start"))
    )
    inside = light.alias("l").join(
        F.broadcast(cuts).alias("c"),
        F.col("l.origin").eqNullSafe(F.col("c.origin")) & (F.col("block") == F.col("cut")),
    )
    # equal rows share a hash: they are one group, of which the cut takes as many as the budget needs
    alike = inside.groupBy(F.col("l.origin").alias("origin"), "rest", "start", "cut", "hash").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    in_block = Window.partitionBy("origin").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("left", F.col("rest") - F.col("start") - F.coalesce(F.sum("n").over(in_block), F.lit(0)))
    needed = F.when(F.col("n") > 0, F.ceil(F.col("left") * F.col("copies") / F.col("n"))).otherwise(F.col("copies"))
    ends = (
        alike.filter(F.col("left") > 0)
        .groupBy("origin", "cut")
        .agg(F.max(F.struct("hash", F.least(needed, F.col("copies")).alias("needed"), "copies")).alias("end"))
    )
    found_cuts = {r.origin: (r.cut, *r.end) for r in ends.collect()}  # one row per source
    cut_rows = [(n, s, *found_cuts.get(s, (-1, 0, 0, 0))) for n, s in enumerate(tokens)]
    with_cuts = plan.alias("p").join(
        spark.createDataFrame(cut_rows, "number int, origin string, cut long, cut_hash long, needed long, copies long").alias("c"),
        F.col("p.origin").eqNullSafe(F.col("c.origin")),
    ).select("p.*", "number", "cut", "cut_hash", "needed", "copies")
    dealt = passed(rows, with_cuts, F.sequence(F.lit(0).cast("long"), F.col("whole")))
    at_cut = (F.col("pass") == F.col("whole")) & (F.col("block") == F.col("cut")) & (F.col("hash") == F.col("cut_hash"))
    parted = at_cut & (F.col("needed") < F.col("copies"))
    kept = dealt.filter(
        (F.col("pass") < F.col("whole"))
        | (F.col("block") < F.col("cut"))
        | ((F.col("block") == F.col("cut")) & (F.col("hash") <= F.col("cut_hash")) & ~parted)
    )
    if any(needed < copies for _, _, _, _, needed, copies in cut_rows):
        kept = kept.unionByName(_first_of_each(dealt.filter(parted)))
    place = (F.col("pass") + F.col("block") / F.col("blocks")) / F.col("repeats")
    return kept.select("row", "pass", "block", place.alias("place"), "hash")


@query("op6_temperature_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source at least once and at most twice, flattened as far as that allows."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "row.source", token_count("row.text").alias("n_tokens"), "pass", "block", "place", "hash")
