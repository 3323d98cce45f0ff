"""Nearest neighbours by multi-index hashing (operator 1).

Vectors become binary codes: the signs of learned rotations. Two rotations are fitted on a
bounded sample by alternating between the nearest corner of the cube and the rotation that comes
closest to it. A code is cut into substrings, and each substring is an index of its own. For a
radius ``r`` and ``m`` substrings, two codes that differ in at most ``r`` bits agree in one of
the substrings up to ``r // m`` bits (pigeonhole), so probing all values that near in every index
finds every code within the radius. Codes within the radius are ranked by the inner
product of the vectors in double precision.

The radius is the one within which the sample's nearest neighbours lie at the wanted recall.
Queries that find fewer than ``k`` are searched again with the radius that takes in every code.

The stated query set meets all rows in blocks: rows and queries are dealt to blocks of bounded
size, and each pair of blocks is a task with its own index, which returns ``k`` rows a query at
most. So no bucket, however common its vector, is ever gathered.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite number take no
part, nor do vectors that have not the most common length. A vector with a null id is never a
query and never found. Repeated rows of an id are separate candidates, but not for that id. A
query row that is repeated is searched once; an id with several vectors is several queries, each with
its own ranks. No rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import query, store, table

K = 20
QUERY_STEP = 20
SAMPLE = 8192  # vectors for rotations and radius
SAMPLE_QUERIES = 512
ROTATIONS = 2
TURNS = 25
SUBSTRING = 8  # bits
RECALL = 0.985
ROW_BLOCK = 16_384
QUERY_BLOCK = 1024
MOST_BUCKETS = 16
PAIRS = 1 << 18  # candidates ranked at once
SEED = 5


def query_key() -> Column:
    """Tells the queries of one id apart."""
    return F.xxhash64("embedding")


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) and dims of the vectors that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    doubles = F.col("embedding").cast("array<double>")
    some = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("embedding")
    )
    some = some.filter(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))
    lengths = some.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "dims").first()
    return some.filter(F.size("embedding") == (common.dims if common else 0))


def fit_rotation(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The rotation that brings vectors near the corners of the cube."""
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(TURNS):
        left, _, right = np.linalg.svd(np.where(x @ rotation > 0, 1.0, -1.0).T @ x)
        rotation = (left @ right).T
    return rotation


def encode(x: np.ndarray, mean: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as bytes; a byte is a substring."""
    bits = ((x - mean) @ rotations > 0).astype(np.uint8)
    return np.packbits(bits, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all codes of two blocks."""
    width = -(-a.shape[1] // 8) * 8
    a, b = (np.pad(c, ((0, 0), (0, width - c.shape[1]))).view(np.uint64) for c in (a, b))
    out = np.zeros((len(a), len(b)), np.uint16)
    for i in range(a.shape[1]):
        out += np.bitwise_count(a[:, i : i + 1] ^ b[None, :, i])
    return out


def fit(sample: np.ndarray, total: int, k: int, recall: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, rotations and radius from a sample of ``total`` vectors."""
    rng = np.random.default_rng(SEED)
    mean = sample.mean(0)
    rotations = np.concatenate([fit_rotation(sample - mean, rng) for _ in range(ROTATIONS)], axis=1)
    queries = sample[:SAMPLE_QUERIES]
    score = queries @ sample.T
    score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    # the k nearest of all are as near as this many of the sample
    near = min(len(sample) - 1, max(1, -(-k * len(sample) // total)))
    if near < 1:
        return mean, rotations, rotations.shape[1]
    found = np.argpartition(-score, near - 1, axis=1)[:, :near]
    codes = encode(sample, mean, rotations)
    far = np.take_along_axis(distances(codes[: len(queries)], codes), found, axis=1)
    return mean, rotations, int(np.quantile(far, recall, method="higher"))


class Index:
    """Rows by the values of each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.starts = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, j], minlength=256)))) for j in range(codes.shape[1])]

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows within the radius of a code.

        With ``radius = a * m + b``, a row that near is within ``a`` in one of the first ``b + 1``
        substrings or within ``a - 1`` in one of the others.
        """
        a, b = divmod(radius, len(code))
        if a >= SUBSTRING:
            rows = np.arange(len(self.codes))
        else:
            seen = np.zeros(len(self.codes), bool)
            for j, value in enumerate(code):
                own = a if j <= b else a - 1
                if own < 0:
                    continue
                if len(VALUES[own]) > MOST_BUCKETS:  # so many buckets are read faster as a column
                    seen |= NEAR[own][self.codes[:, j] ^ value]
                    continue
                for v in (VALUES[own] ^ value).astype(int):
                    seen[self.order[j][self.starts[j][v] : self.starts[j][v + 1]]] = True
            rows = np.flatnonzero(seen)
        return rows[distances(code[None], self.codes[rows])[0] <= radius]


NEAR = [np.bitwise_count(np.arange(256, dtype=np.uint8)) <= r for r in range(SUBSTRING)]
VALUES = [np.flatnonzero(near).astype(np.uint8) for near in NEAR]


def search(queries, query_ids, query_keys, vectors, ids, query_codes, index: Index, radius: int, k: int):
    """Up to ``k`` (query id and key, row id, score) per query, by descending score and ascending id."""
    out = []
    for q, query_id, key, code in zip(queries, query_ids, query_keys, query_codes, strict=True):
        rows = index.probe(code, radius)
        rows = rows[ids[rows] != query_id]
        score = np.concatenate([(vectors[rows[i : i + PAIRS]] * q).sum(1) for i in range(0, len(rows), PAIRS)] or [np.zeros(0)])
        if len(rows) > k:
            kept = score >= np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[kept], score[kept]
        best = np.lexsort((ids[rows], -score))[:k]
        out.append((np.full(len(best), query_id), np.full(len(best), key), ids[rows[best]], score[best]))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row for which ``is_query`` holds."""
    rows = store(usable(vectors), "vectors")
    total = rows.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not total:
        return rows.sparkSession.createDataFrame([], out)
    taken = rows.orderBy(F.xxhash64("embedding"), "vec_id").limit(SAMPLE).toPandas()
    mean, rotations, radius = fit(np.stack(taken["embedding"]), total, k, recall)
    query_rows = store(rows.filter(is_query).dropDuplicates(["vec_id", "embedding"]), "queries")
    row_blocks = -(-total // ROW_BLOCK)

    def searched(queries: DataFrame, radius: int) -> DataFrame:
        query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

        def blocks(own: str, n: int, other: str, m: int, side: int, df: DataFrame) -> DataFrame:
            block = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int")
            return df.select(
                block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other), F.lit(side).alias("side"), "vec_id", "embedding", query_key().alias("query_key")
            )

        sent = blocks("row_block", row_blocks, "query_block", query_blocks, 0, rows).unionByName(
            blocks("query_block", query_blocks, "row_block", row_blocks, 1, queries)
        )

        def run(group: pa.Table) -> pa.Table:
            side = group.column("side").to_numpy() == 1
            x, ids = _matrix(group.column("embedding")), group.column("vec_id").to_numpy()
            columns = [*np.zeros((3, 0), np.int64), np.zeros(0)]
            if side.any() and not side.all():
                codes = encode(x, mean, rotations)
                index = Index(codes[~side])
                keys = group.column("query_key").to_numpy()
                columns = search(x[side], ids[side], keys[side], x[~side], ids[~side], codes[side], index, radius, k)
            return pa.table(dict(zip(("query_id", "query_key", "vec_id", "score"), columns, strict=True)))

        found = "query_id long, query_key long, vec_id long, score double"
        return sent.groupBy("row_block", "query_block").applyInArrow(run, found)

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = store(ranked(searched(query_rows, radius)), "found")
    counts = first.groupBy("query_id", "query_key").agg(F.count(F.lit(1)).alias("n"))
    wanted = min(k, total - 1)
    same = (F.col("vec_id") == F.col("query_id")) & (query_key() == F.col("query_key"))
    short = query_rows.join(counts.filter(F.col("n") >= wanted), same, "left_anti")
    short = store(short, "short")
    found = first
    if not short.isEmpty():
        again = ranked(searched(short, rotations.shape[1]))
        keys = short.select(F.col("vec_id").alias("query_id"), query_key().alias("query_key"))
        found = first.join(keys, ["query_id", "query_key"], "left_anti").unionByName(again.select(*first.columns))
    return found.select("query_id", "rank", "vec_id", "score")


@query("op1_multi_index_hashing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)
