"""SimHash near duplicates by the generalised pigeonhole principle (operator 13).

A fingerprint has a bit set if more than half of the hashes of a text's four-word runs have it.
Two texts are linked if their fingerprints differ in at most ``distance`` bits, and a class is
what links connect.

1. Equal fingerprints are one node from here on.
2. Bits are grouped into partitions, correlated ones together, by the correlations over all nodes.
3. Each partition gets a threshold of its own. If the thresholds of ``m`` partitions add up to
   ``distance - m + 1``, two fingerprints within the distance agree in some partition up to its
   threshold (-1: the partition is not looked at). Dynamic programming picks the thresholds with
   the least number of probes and expected candidates; the candidates are expected from the share
   of pairs that differ in each bit.
4. Nodes are indexed by the value of each partition and probe all values within its threshold. Of two
   values the smaller probes the greater, so a pair meets from one side only. Candidates are
   verified on all bits.
5. Values that more than ``FULL`` nodes share are not joined: their nodes and probes are dealt to
   blocks, and a task with one block of each returns a forest that connects what is linked
   there instead of all pairs.

Words lie between ASCII white space, with A-Z lower-cased. Defined cases: a text without words
(null, empty, white space) has fingerprint zero and is linked like any other; one with fewer
words than a run is one run. Texts are hashed in pieces of bounded size. Repeated rows are copies.
Null ids never name a class unless it has no other. No rows give no rows. Further columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import in_batches, query, store, table
from starmill.llm.components import components
from starmill.operators.joins import lookup_join

BITS = 64
WORDS = 4
SEED = 42
DISTANCE = 4
PIECE = 1 << 20  # bytes of a text hashed at once
PARTITIONS = (3, 2)  # numbers of partitions to choose from
CANDIDATE = 0.1  # cost of verifying a candidate, in probes
FULL = 64  # nodes of a value that are joined
BLOCK = 8192  # nodes of a block

_WHITE = re.compile(rb"[ \t-\r]")


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size."""
    at = 0
    while at < len(text):
        border = _WHITE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = border.start() if border else len(text)
        yield text[at:end].split()
        at = max(end, at + 1)


def fingerprint(text: bytes) -> int:
    """The SimHash of a UTF-8 text, as an unsigned number."""
    from xxhash import xxh64_intdigest

    ones, total, held = np.zeros(BITS, np.int64), 0, []

    def take(hashes: list[int]) -> None:
        nonlocal total
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[:] += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for words in _word_lists(text.lower()):
        words = held + words
        if len(words) >= WORDS:
            line = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))  # one past the space after each word
            starts = [0, *ends]
            take([xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(starts, ends[WORDS - 1 :], strict=False)])
            words = words[1 - WORDS :]
        held = words
    if not total and held:
        take([xxh64_intdigest(b" ".join(held), SEED)])
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint's 64 bits as a signed number."""

    def run(batch: pa.RecordBatch):
        found = [fingerprint(t.as_py() or b"") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"]
        )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return source.mapInArrow(in_batches(run), "doc_id long, fp long")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of nodes, and in how many each pair of bits is set (the diagonal: each bit)."""

    def run(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for a in range(0, len(fps), 1 << 16):
                bits = np.unpackbits(
                    np.ascontiguousarray(fps[a : a + (1 << 16)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
                ).astype(np.float32)
                both += bits.T @ bits
                n += len(bits)
        if n:
            first = np.repeat(np.arange(BITS + 1), BITS)
            second = np.tile(np.arange(BITS), BITS + 1)
            counts = np.append(both.ravel(), np.full(BITS, n)).astype(np.int64)  # the last row: all
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(counts)], ["a", "b", "n"]
            )

    both = np.zeros((BITS + 1, BITS), np.int64)
    sums = nodes.select("fp").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # a row per pair of bits
        both[row.a, row.b] = row.n
    return int(both[BITS, 0]), both[:BITS]


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt to ``parts`` partitions, each grown from a bit by those most correlated with it."""
    share = both / max(1, n)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    left, groups = list(range(len(p))), []
    for part in range(parts):
        size = -(-len(left) // (parts - part))
        first = max(left, key=lambda b: (tied[b, left].sum(), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            nearest = max(left, key=lambda b: (tied[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def chance_within(differ: np.ndarray) -> np.ndarray:
    """The chance of at most 0, 1, ... differing bits, from the chance of each."""
    exact = np.ones(1)
    for d in differ:
        exact = np.convolve(exact, (1 - d, d))
    return np.cumsum(exact)


def allocate(n: int, differ: np.ndarray, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """The thresholds of least expected cost a node, by dynamic programming over the partitions."""
    cheapest: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # thresholds + 1, summed -> cost, thresholds
    for bits in groups:
        within, after = chance_within(differ[bits]), {}
        for used, (cost, chosen) in cheapest.items():
            for t in range(-1, min(len(bits), distance - used) + 1):
                probes = sum(comb(len(bits), i) for i in range(t + 1))
                more = probes + CANDIDATE * n * within[t] if t >= 0 else 0.0
                total = used + t + 1
                if total not in after or cost + more < after[total][0]:
                    after[total] = (cost + more, [*chosen, t])
        cheapest = after
    # thresholds sum to distance - m + 1, so thresholds + 1 sum to distance + 1
    return cheapest[distance + 1]


def choose_partitions(n: int, both: np.ndarray, distance: int) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds of the least expected cost."""
    p = np.diag(both) / max(1, n)
    differ = 2 * p * (1 - p)
    plans = []
    for parts in PARTITIONS:
        groups = group_bits(n, both, parts)
        cost, thresholds = allocate(n, differ, groups, distance)
        plans.append((cost, parts, groups, thresholds))
    _, _, groups, thresholds = min(plans)
    return groups, thresholds


def _signed(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _index(nodes: DataFrame, groups: list[list[int]], thresholds: list[int], probes: bool) -> DataFrame:
    """part, value, fp: the values of each node, with ``probes`` also those greater ones within the thresholds."""
    steps = []
    for part, (bits, t) in enumerate(zip(groups, thresholds, strict=True)):
        mask = _signed(bits)
        for k in range(min(t, t if probes else 0) + 1):
            steps += [(part, mask, _signed(flip)) for flip in combinations(bits, k)]
    columns = ("part", "mask", "flip")
    rows = F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(columns, s, strict=True)]) for s in steps])
    own = F.col("fp").bitwiseAND(F.col("step.mask"))
    found = nodes.select("fp", F.explode(rows).alias("step")).withColumn("value", own.bitwiseXOR(F.col("step.flip")))
    found = found.filter((F.col("step.flip") == 0) | (F.col("value") > own))
    return found.select(F.col("step.part").cast("int").alias("part"), "value", "fp")


def connect(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects what links connect among fingerprints."""
    left, parents, children = np.unique(fps).view(np.uint64), [], []
    while len(left):
        reached, left = [left[:1]], left[1:]
        while reached and len(left):
            for node in reached.pop():
                near = np.bitwise_count(left ^ node) <= distance
                if near.any():
                    parents.append(np.full(int(near.sum()), node))
                    children.append(left[near])
                    reached.append(left[near])
                    left = left[~near]
    if not parents:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(parents).view(np.int64), np.concatenate(children).view(np.int64)


def _blockwise(own: DataFrame, probing: DataFrame, full: DataFrame, distance: int) -> DataFrame:
    """Links that connect the nodes of full values with those that probe them, found block by block."""
    key = ["part", "value"]
    asked = probing.join(full, key)
    sizes = asked.groupBy(*key).agg(F.count(F.lit(1)).alias("asking")).join(full, key)
    sizes = store(
        sizes.select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("rows"),
                     F.ceil(F.col("asking") / BLOCK).cast("int").alias("columns")), "full-values"
    )

    def dealt(side: DataFrame, block: str, blocks: str, other: str, others: str) -> DataFrame:
        return side.join(sizes, key).select(
            *key, "fp", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias(block),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other),
        )

    sent = dealt(own, "row", "rows", "column", "columns").unionByName(dealt(probing, "column", "columns", "row", "rows"))

    def run(group: pa.Table) -> pa.Table:
        a, b = connect(group.column("fp").to_numpy(), distance)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return sent.groupBy(*key, "row", "column").applyInArrow(run, "a long, b long")


def link_nodes(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: links that connect all nodes (``fp``, distinct) within ``distance`` bits of each other."""
    n, both = bit_counts(nodes)
    groups, thresholds = choose_partitions(n, both, distance)
    own = _index(nodes, groups, thresholds, probes=False)
    probing = _index(nodes, groups, thresholds, probes=True)
    counts = own.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    full = store(counts.filter(F.col("n") > FULL), "full")
    if some := not full.isEmpty():
        joined = own.join(full, ["part", "value"], "left_anti")
    else:
        joined = own
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("o.fp"))) <= distance
    same = (F.col("p.part") == F.col("o.part")) & (F.col("p.value") == F.col("o.value"))
    links = probing.alias("p").join(joined.alias("o"), same & near & (F.col("p.fp") != F.col("o.fp")))
    links = links.select(F.col("p.fp").alias("a"), F.col("o.fp").alias("b"))
    return links.unionByName(_blockwise(own, probing, full, distance)) if some else links


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp and component_id (the smallest id of the class) of every document."""
    prints = store(fingerprints(docs), "simhash")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "nodes")
    linked = store(components(link_nodes(nodes, distance), "simhash"), "linked")
    members = linked.join(nodes, linked["node"] == nodes["fp"]).select("fp", "root", "first")
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    of_linked = lookup_join(members.select("fp", "root"), least, ["root"]).select("fp", "component_id")
    copies = nodes.filter(F.col("n") > 1).join(linked, F.col("fp") == F.col("node"), "left_anti")
    classes = store(of_linked.unionByName(copies.select("fp", F.col("first").alias("component_id"))), "classes")
    named = lookup_join(prints, classes, ["fp"], "left")
    return named.select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
