"""N-gram Jaccard self-join by MinHash banding (operator 3).

A document is the set of its runs of five words (all its words, if it has fewer). Two documents
are linked if the Jaccard similarity of their sets is at least ``threshold``.

1. One scan makes MinHash bands of every text. Rows per band and the number of bands come from
   the recall wanted at the threshold. Equal sets are one node from here on.
2. Nodes that share a band hash share a bucket. A bucket is known by its smallest node, its
   leader, and each node keeps its distinct leaders: a group of near copies has few of them,
   however many bands they share.
3. The sets of such nodes are sent to their leaders' groups. Groups with many nodes are dealt
   into blocks, and each pair of blocks is a task of its own. A pair of nodes is compared in full
   only in the group of the smallest leader both have, so it counts once.
4. Tasks return the number of links per node and a forest that connects what is linked, not the
   pairs. Classes are the components of the forests.

Words are runs of letters and digits, ASCII letters lower-cased; bytes beyond ASCII count as
letters. Defined cases: a null text is empty. Texts without a word have no n-grams; they are
linked to equal ones alone. Repeated rows are copies. Null ids are ordinary values, and a class
whose ids are all null has a null id. No rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import hash64, in_batches, query, slices, store, table, text_buffer
from starmill.llm.components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK = 256  # nodes of a block; two blocks are compared in one task
SLICE_BYTES = 1_000_000
SEED = 9

FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band that reach the recall at the threshold within the hashes."""
    for rows in range(max_hashes, 0, -1):
        missed = math.log1p(-(threshold**rows))
        bands = math.ceil(math.log(1 - recall) / missed) if missed else max_hashes + 1
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no number of bands reaches this recall")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (FACTOR, pow(FACTOR, -1, 1 << 64)):
        steps = np.full(n + 1, factor, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all documents in a row, and the n+1 places where each document's begin."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = WORD_BYTE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (first[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data] + np.uint64(1)) * power[:-1], out=total[1:])
    hashes = hash64((total[ends] - total[starts]) * inverse[starts])
    n_words = np.diff(np.searchsorted(starts, offsets))
    # a document with n words has n - words + 1 runs; one with fewer words has a single run
    n_runs = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    run_at, word_at = np.concatenate(([0], np.cumsum(n_runs))), np.concatenate(([0], np.cumsum(n_words)))
    place = np.repeat(word_at[:-1] - run_at[:-1], n_runs) + np.arange(run_at[-1])
    length = np.repeat(np.minimum(n_words, words), n_runs)
    padded = np.concatenate((hashes, np.zeros(words, np.uint64)))
    runs = length.astype(np.uint64)
    for i in range(words):
        runs = hash64(runs * np.uint64(FACTOR) + np.where(length > i, padded[place + i], np.uint64(0)))
    return runs, run_at


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct n-grams of each document."""
    for a, b in slices(offsets, SLICE_BYTES):
        runs, at = shingles(data, offsets[a : b + 1], words)
        for i in range(b - a):
            yield np.unique(runs[at[i] : at[i + 1]])


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One hash per band for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    factors = hash64(np.arange(1, bands * rows + 1, dtype=np.uint64) + np.uint64(SEED)) | np.uint64(1)
    out = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        mixed = np.full(len(sets), band, np.uint64)
        for factor in factors[band * rows : (band + 1) * rows]:
            # the high bits of a product decide its order, and all lower bits of a hash reach them
            mixed = hash64(mixed * np.uint64(FACTOR) + np.minimum.reduceat(flat * factor, starts))
        out[:, band] = mixed
    return out


def _node(found: np.ndarray, text: bytes) -> bytes:
    """128 bits that stand for a set of n-grams, or for a text that has none."""
    import xxhash

    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else xxhash.xxh3_128_digest(text, seed=SEED)


def band_documents(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, node, bands (null without n-grams), one row per document."""

    def run(batch: pa.RecordBatch):
        data, offsets = text_buffer(batch.column("text"))
        ids, hashes = batch.column("doc_id"), batch.column("text_hash")
        for a, b in slices(offsets, SLICE_BYTES):
            sets = list(sets_of(data, offsets[a : b + 1], words))
            nodes = [_node(s, data[offsets[a + i] : offsets[a + i + 1]].tobytes()) for i, s in enumerate(sets)]
            filled = [i for i, s in enumerate(sets) if len(s)]
            found: list = [None] * len(sets)
            if filled:
                for i, row in zip(filled, signatures([sets[i] for i in filled], bands, rows).view(np.int64), strict=True):
                    found[i] = row
            yield pa.RecordBatch.from_arrays(
                [ids[a:b], hashes[a:b], pa.array(nodes, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "node", "bands"],
            )

    source = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return source.mapInArrow(in_batches(run), "doc_id long, text_hash long, node binary, bands array<long>")


def _compare(sets: list[np.ndarray], sides: np.ndarray, smaller: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of a group are linked; ``sides`` tells the two blocks apart (all 0: one block),
    ``smaller`` marks the leaders below this group's that a node has as well."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    shared = np.bincount(number) > 1
    column = np.cumsum(shared) - 1
    use = shared[number]
    owner, column = owner[use], column[number[use]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), 4096):  # columns are in order
        a, b = np.searchsorted(column, (start, start + 4096))
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[a:b], column[a:b] - start] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common.astype(np.int64)
    linked = common / np.maximum(union, 1).astype(np.float64) >= threshold
    np.fill_diagonal(linked, False)
    if sides.any():
        linked &= sides[:, None] != sides[None, :]
    if smaller.shape[1]:
        held = smaller.astype(np.float32)
        linked &= (held @ held.T) == 0
    return linked


def _forest(linked: np.ndarray) -> np.ndarray:
    """The smallest place in each node's component."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(root)).min(1, initial=len(root))
        after = np.minimum(root, least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _compare_group(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        rows = {}  # repeated rows of a text are one node
        for node, weight, leader, leaders, side, grams in zip(*(group.column(i).to_pylist() for i in range(6)), strict=True):
            rows[node] = (weight, leader, leaders, side, grams)
        nodes = sorted(rows)
        weights = np.array([rows[n][0] for n in nodes], np.int64)
        below = sorted({x for n in nodes for x in rows[n][2] if x < rows[n][1]})
        place = {x: i for i, x in enumerate(below)}
        smaller = np.zeros((len(nodes), len(below)), bool)
        for i, n in enumerate(nodes):
            smaller[i, [place[x] for x in rows[n][2] if x in place]] = True
        sides = np.array([rows[n][3] for n in nodes])
        sets = [np.frombuffer(rows[n][4], np.uint64) for n in nodes]
        linked = _compare(sets, sides, smaller, threshold)
        links, root = linked @ weights, _forest(linked)
        some = np.flatnonzero(links)
        return pa.table({
            "node": pa.array([nodes[i] for i in some], pa.binary()),
            "links": pa.array(links[some], pa.int64()),
            "root": pa.array([nodes[root[i]] for i in some], pa.binary()),
        })

    return run


def _with_sets(docs: DataFrame, words: int) -> DataFrame:
    """Replace the text by its set of n-grams as bytes."""

    def run(batch: pa.RecordBatch):
        data, offsets = text_buffer(batch.column("text"))
        grams = pa.array([s.tobytes() for s in sets_of(data, offsets, words)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("weight"), batch.column("leaders"), grams],
                                         ["node", "weight", "leaders", "grams"])

    return docs.mapInArrow(in_batches(run), "node binary, weight long, leaders array<binary>, grams binary")


def link_nodes(docs: DataFrame, nodes: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links between different sets: node, links (documents linked to, copies counted), root."""
    in_buckets = nodes.filter(F.col("bands").isNotNull()).select(
        "node", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("bands") - 1), F.col("bands"))).alias("b")
    )
    in_buckets = in_buckets.select("node", F.xxhash64("b.0", "b.bands").alias("bucket"))
    leaders = in_buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"))
    members = (
        in_buckets.join(leaders.filter("n > 1"), "bucket")
        .groupBy("node").agg(F.collect_set("leader").alias("leaders"))  # one for each band at most
    )
    members = store(
        nodes.select("node", "weight", "text_hash", "doc_id").join(members, "node"), "candidates"
    )
    groups = members.select(F.explode("leaders").alias("leader")).groupBy("leader").agg(F.count(F.lit(1)).alias("size"))
    large = store(groups.filter(F.col("size") > BLOCK), "large-groups")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text", F.xxhash64("text").alias("_hash"))
    # weights count the copies; of rows with one id and text one is enough, and each task sends one
    texts = texts.dropDuplicates(["_id", "_hash"]).join(
        members, (F.col("_hash") == F.col("text_hash")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    )
    sets = _with_sets(texts.select("text", "node", "weight", "leaders"), words)
    sent = sets.withColumn("leader", F.explode("leaders")).join(large, "leader", "left")
    blocks = F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    sent = (
        sent.withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    keyed = sent.select(
        "node", "weight", "leader", "leaders", (F.col("own") > F.col("other")).cast("int").alias("side"), "grams",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    found = keyed.groupBy("leader", "low", "high").applyInArrow(
        _drop_keys(_compare_group(threshold)), "node binary, links long, root binary"
    )
    return store(found, "links")


def _drop_keys(function):
    return lambda group: function(group.select(["node", "weight", "leader", "leaders", "side", "grams"]))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (the smallest id of its class), n_links
    (other documents at the threshold or above, copies among them), class_size, and ``keep``, true
    for the document that stands for the class."""
    bands, rows = choose_bands(threshold, recall)
    banded = store(band_documents(docs, words, bands, rows), "bands")
    smallest = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    nodes = banded.groupBy("node").agg(F.min(smallest).alias("first"), F.count(F.lit(1)).alias("weight"))
    nodes = store(nodes.select("node", "weight", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")), "nodes")
    first = banded.alias("b").join(
        nodes.alias("n"),
        (F.col("b.node") == F.col("n.node")) & F.col("b.doc_id").eqNullSafe(F.col("n.doc_id"))
        & (F.col("b.text_hash") == F.col("n.text_hash")),
    )
    banded_nodes = first.select("n.*", "b.bands").dropDuplicates(["node"])
    links = link_nodes(docs, banded_nodes, words, threshold)
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "near")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(roots, "node", "left").join(counts, "node", "left")
    known = known.select(
        "node", "weight", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"),
        F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash")).alias("first"),
    )
    classes = known.groupBy("root").agg(F.min("first").alias("first"), F.sum("weight").alias("class_size"))
    known = known.select("node", "weight", "root", "links").join(classes, "root")
    out = banded.select("doc_id", "text_hash", "node").join(known, "node")
    stands = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return out.select(
        "doc_id", "text_hash", F.col("first.doc_id").alias("class_id"),
        (F.col("links") + F.col("weight") - 1).alias("n_links"), "class_size", stands.alias("keep"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their classes, each once."""
    kept = near_duplicates(docs).filter("keep").select("doc_id", "text_hash").distinct()
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_hash"]).select("row.*")


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "n_links", "class_size", "keep")
