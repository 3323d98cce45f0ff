"""Hierarchical empirical Bayes for document quality (operator 4).

A logistic classifier over the words and symbol runs of a document gives its own evidence. Hosts
and paths of hosts give the rest: the soft counts of good documents are summed per path, summed
on per host and over all, and each level is a Beta posterior shrunk towards the level above. How
strongly is estimated from the data by the method of moments (how much more do hosts differ than
their sizes explain), so a sparse site stays near the global prior. A document's posterior
adds the log odds of its path, without the document's own count, to its own evidence.

The classifier is fitted on at most ``SAMPLE`` labelled documents, the ones whose hashed id is
smallest; counts and posteriors cover all documents.

Defined cases: a null or empty text has the classifier's intercept as evidence. Null hosts and
paths are groups of their own. Repeated rows count as often as they occur. Rows of ``labels``
with a null count as unlabelled, and of several labels of a document the lowest holds. Without
labels of both kinds every document's evidence is the prior of one half. No rows give no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import query, store, table, text_or_empty, whole_row
from starmill.operators.joins import lookup_join

SAMPLE = 12_000
FEATURES = 1 << 17
FIT_TASKS = 12
THRESHOLD = 0.5
EDGE = 1e-4  # classifier probabilities are kept this far from 0 and 1
PARTS = r"\p{L}+|[^\p{L}\s]+"


def _features(df: DataFrame, text: str) -> DataFrame:
    lower = F.lower(text_or_empty(text))
    words = F.array_distinct(F.regexp_extract_all(lower, F.lit(PARTS), F.lit(0)))
    return HashingTF(binary=True, numFeatures=FEATURES, inputCol="words", outputCol="features").transform(
        df.withColumn("words", words)
    )


def fit_classifier(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LogisticRegressionModel | None:
    """Fit on a bounded sample; ``labels`` has doc_id and good (0 or 1)."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("good").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("good").cast("double").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded: fit to broadcast
    texts = docs.select(F.col("doc_id"), F.col("text"))
    train = store(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
    kinds = {r.good for r in train.groupBy("good").count().collect()}
    if len(kinds) < 2:
        return None
    # a bounded sample: few tasks, or each round of the fit sends a vector of weights per task to the driver
    features = _features(train.repartition(FIT_TASKS), "text").select("features", "good")
    model = LogisticRegression(
        featuresCol="features", labelCol="good", maxIter=40, regParam=0.002, standardization=False
    )
    return model.fit(features)


def _log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def evidence(df: DataFrame, model: LogisticRegressionModel | None, text: str) -> DataFrame:
    """Add ``own``, the classifier's probability."""
    if model is None:
        return df.withColumn("own", F.lit(0.5))
    scored = model.setProbabilityCol("probability").transform(_features(df, text))
    own = vector_to_array("probability")[1]
    kept = F.least(F.greatest(own, F.lit(EDGE)), F.lit(1 - EDGE))
    return scored.withColumn("own", kept).drop("words", "features", "rawPrediction", "probability", "prediction")


def _strength(groups: DataFrame, mean: Column) -> Column:
    """Pseudo-count of a Beta prior by the method of moments.

    ``groups`` has n and good of each group; what their means differ beyond the sampling error
    of means of ``n`` is the variance of the prior.
    """
    n, share = F.col("n"), F.col("good") / F.col("n")
    spread = F.sum(n * (share - mean) * (share - mean)) / F.sum(n)
    noise = F.sum(mean * (1 - mean)) / F.sum(n)
    between = F.greatest(spread - noise, F.lit(1e-6))
    level = F.sum(n * mean) / F.sum(n)
    return F.greatest(level * (1 - level) / between - 1, F.lit(1.0))


def posteriors(scored: DataFrame) -> DataFrame:
    """Per host and path: documents, soft count, the host's posterior, strengths and the prior."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("good"))
    paths = store(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg((F.sum("good") / F.sum("n")).alias("prior"), F.sum("n").alias("all"))
    prior = total.first().prior
    if prior is None:
        prior = 0.5
    m_host = hosts.agg(_strength(hosts, F.lit(prior))).first()[0] or 1.0
    hosts = hosts.select(
        F.col("host").alias("_host"),
        ((F.col("good") + m_host * prior) / (F.col("n") + m_host)).alias("host_posterior"),
    )
    levels = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    m_path = levels.agg(_strength(levels, F.col("host_posterior"))).first()[0] or 1.0
    return levels.withColumns({"m_path": F.lit(m_path), "prior": F.lit(prior)})


def assess(docs: DataFrame, labels: DataFrame, host: Column, path: Column, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` as ``row`` with ``own``, ``site`` (its path's posterior without it),
    ``posterior`` and ``keep``."""
    model = fit_classifier(docs, labels, sample)
    # an empty name stands for null, which an equi-join would lose
    rows = docs.select(whole_row(), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    scored = evidence(rows, model, "row.text")
    levels = posteriors(scored.select("host", "path", "own"))
    joined = lookup_join(scored, levels, ["host", "path"])
    others = F.col("n") - 1 + F.col("m_path")
    site = (F.col("good") - F.col("own") + F.col("m_path") * F.col("host_posterior")) / others
    site = F.least(F.greatest(site, F.lit(EDGE)), F.lit(1 - EDGE))
    odds = _log_odds(F.col("own")) + _log_odds(F.col("site")) - _log_odds(F.col("prior"))
    return (
        joined.withColumn("site", site)
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("keep", F.col("posterior") >= THRESHOLD)
        .select("row", "host", "path", "own", "host_posterior", "site", "posterior", "keep")
    )


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents are those of good quality that are not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return table(spark, sf_dir, "labels").select("doc_id", good.cast("int").alias("good"))


def assess_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The table has a source and a language where a crawl has a host and a path."""
    return assess(docs, labels_of(spark, sf_dir), F.col("source"), F.col("lang"))


@query("op4_hierarchical_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assess_documents(spark, table(spark, sf_dir, "documents"), sf_dir)
    return out.select("row.doc_id", "host", "path", "own", "host_posterior", "site", "posterior", "keep")
