"""Document fingerprints by consistent weighted sampling (operator 8), in DataFrame functions alone.

The terms of a text are its words with their counts as weights. For each term and each of ``K``
draws, keyed hashes give two gamma variables and a uniform one; from them come a step of the
term's weight and a value, and the draw takes the term and step with the least value. Two texts
agree in a draw with a probability equal to their generalised Jaccard similarity: the sum of the
lesser weights over the sum of the greater ones.

A draw is one 64-bit number, the value in its high bits and the sampled term and step in its low
ones, so all draws of a text are plain minima in one hash aggregate, and a third of all copies
or a very frequent word makes no group larger than a document.

``with_next`` gives each document the one after it. It deals ids to ranges of bounded size, and
the first document of a range also goes to the range before it; texts are shuffled once.

Defined cases: a null text is empty, and an empty text has a fingerprint of its own. Null ids come
last. Rows with equal ids are ordered by a hash of their texts. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import query, table, text_or_empty

K = 32
SEED = 41
ID_BITS = 24
RANGE_ROWS = 512
MAX_RANGES = 100_000  # beyond, ranges hold more rows: the table of ranges is broadcast
STEP = 40_503  # odd, so steps differ in the low bits


def terms(text: Column) -> Column:
    """term and count of the distinct words of a text."""
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        ends = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == n) | (F.get(ordered, i - 1) != F.get(ordered, i)),
        )
        return F.flatten(F.transform(F.array(ends), lambda e: F.transform(
            e, lambda end, j: F.struct(
                F.get(ordered, end - 1).alias("term"),
                (end - F.when(j == 0, 0).otherwise(F.get(e, j - 1))).alias("n"),
            )
        )))

    bound = F.transform(F.array(F.sort_array(words)), lambda w: F.when(F.size(w) > 0, runs(w)))
    return F.get(bound, F.lit(0))


def _uniform(bits: Column) -> Column:
    """(0, 1) from the low 32 bits."""
    return (bits.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) * (2.0**-32)


def draw(k: int) -> Column:
    """Value and sample of a term of hash ``term_hash`` and log weight ``log_n`` in draw ``k``, in one number."""
    one = F.xxhash64(F.lit(2 * k + SEED), "term_hash")
    two = F.xxhash64(F.lit(2 * k + 1 + SEED), "term_hash")
    r = -F.log(_uniform(one) * _uniform(F.shiftrightunsigned(one, 32)))
    c = -F.log(_uniform(two) * _uniform(F.shiftrightunsigned(two, 32)))
    beta = _uniform(F.shiftrightunsigned(one.bitwiseXOR(two), 16))
    step = F.floor(F.col("log_n") / r + beta)
    value = F.log(c) - r * (step - beta + 1)
    high = F.floor((F.least(F.greatest(value, F.lit(-127.0)), F.lit(127.0)) + 128) * 2.0**31)
    # a step is below 2^36 (the logarithm of a count over the least gamma value), so the product fits
    mixed = one.bitwiseXOR(two).bitwiseXOR(step * F.lit(STEP))
    return F.shiftleft(high, ID_BITS).bitwiseOR(mixed.bitwiseAND(F.lit((1 << ID_BITS) - 1)))


def draws(exploded: DataFrame, *key: str, k: int = K) -> DataFrame:
    """The fingerprint of each group of terms: an array of ``k`` samples; 0 in all without terms."""
    weighted = exploded.select(
        *key, F.xxhash64("term").alias("term_hash"), F.log(F.col("n").cast("double")).alias("log_n")
    )
    mask = F.lit((1 << ID_BITS) - 1)
    least = weighted.groupBy(*key).agg(*[F.min(draw(i)).alias(f"_{i}") for i in range(k)])
    samples = [F.coalesce(F.col(f"_{i}").bitwiseAND(mask), F.lit(0).cast("long")) for i in range(k)]
    return least.select(*key, F.array(*samples).alias("samples"))


def likeness(a: Column, b: Column) -> Column:
    """The share of draws in which two fingerprints agree."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.size(same) / F.size(a)


def as_text(samples: Column) -> Column:
    return F.array_join(F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s)), ID_BITS // 4, "0")), "")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id and text of each document with ``next_text``, in descending order of ids.

    Rows of a ``part`` are numbered by ``place``; its last row is the first of the next part
    (after the last part, of the first) and has ``extra`` set.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    ranges = min(MAX_RANGES, max(1, -(-n // RANGE_ROWS)))
    low, width = low or 0, max(1.0, ((high or 0) - (low or 0) + 1) / ranges)
    target = -(-n // ranges) if n else 1
    rows = rows.withColumn("range", F.coalesce(F.floor((F.col("doc_id") - low) / width), F.lit(-1)).cast("long"))
    sizes = rows.groupBy("range").agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    sizes = sizes.withColumn("split", F.ceil(F.col("rows") / (4 * target)))
    # a crowded range is dealt again, by its own ids or, if it has one id only, by the hashes
    by_id = (F.col("doc_id") - F.col("low")) / (F.col("high") - F.col("low") + 1)
    by_tie = F.col("tie") / F.lit(2.0**64) + 0.5
    inside = F.coalesce(F.when(F.col("high") > F.col("low"), by_id), by_tie) * F.col("split")
    part = F.col("range") * F.lit(1 << 20) + F.least(F.floor(inside), F.col("split") - 1)
    rows = rows.join(F.broadcast(sizes), "range").withColumn("part", part)
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("tie"))
    tops = rows.groupBy("part").agg(F.max(order).alias("top"))
    around = Window.orderBy(F.desc("part"))  # over the parts, whose number is bounded
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.withColumn("goes_to", F.coalesce(F.lag("part").over(around), F.last("part").over(whole)))
    rows = rows.join(F.broadcast(tops), "part")
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("extra"))
    other = F.struct(F.col("goes_to").alias("part"), F.lit(1).alias("extra"))
    sent = rows.withColumn("to", F.explode(F.when(order == F.col("top"), F.array(own, other)).otherwise(F.array(own))))
    sent = sent.select("doc_id", "text", "tie", F.col("to.part").alias("part"), F.col("to.extra").alias("extra"))
    down = Window.partitionBy("part").orderBy("extra", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return sent.select(
        "part", F.row_number().over(down).alias("place"), "extra", "doc_id", "text",
        F.lead("text").over(down).alias("next_text"),
    )


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id and ``samples`` of each document; rows may repeat."""
    numbered = docs.select("doc_id", text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = numbered.select("doc_id", "row", F.explode_outer(terms(F.col("text"))).alias("t"))
    return draws(rows.select("doc_id", "row", "t.*"), "doc_id", "row", k=k).drop("row")


@query("op8_consistent_weighted_sampling")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cut)"), F.expr("left(next_text, cut)"))
    rows = rows.withColumn("cut", cut).withColumn("edited", F.when(F.col("extra") == 0, edited))
    rows = rows.select(
        "part", "place", "extra", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
                          F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")))).alias("v"),
    ).filter(F.col("v.body").isNotNull())
    key = ["part", "place", "extra", "doc_id", "n_chars", "edited_sha256", "version"]
    exploded = rows.select(*key[:-1], "v.version", F.explode_outer(terms(F.col("v.body"))).alias("t"))
    prints = draws(exploded.select(*key, "t.*"), *key)
    # a document's row, its edited text's, the next document's
    along = Window.partitionBy("part").orderBy("place", "version")
    near = prints.select(
        *key, "samples", F.lead("samples", 1).over(along).alias("edited"), F.lead("samples", 2).over(along).alias("next")
    ).filter((F.col("version") == 0) & (F.col("extra") == 0))
    return near.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("samples")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("samples"), F.col("edited")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next")).alias("near_next"),
    )
