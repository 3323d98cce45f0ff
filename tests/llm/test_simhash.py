"""SimHash classes against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from starmill.llm import simhash as s


def plain_fingerprint(text):
    folded = (text or "").encode().lower()
    words = folded.split()
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, prints, distance=4):
    """doc_id -> smallest id of its class; rows without an id are told apart by their place."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(((doc_id, least.get(find(i))) for i, (doc_id, _) in enumerate(rows)), key=str)


def sample(n, seed=1):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 10, 120]))) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k, t in enumerate(base):
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + k, " ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "one"), (5004, "One"), (None, base[0]), (None, "lonely thing")]
    rows += [(5005, base[1]), (5005, base[1])]
    return rows


def test_classes_of_texts(spark):
    rows = sample(60)
    frame = spark.createDataFrame(
        [(*r, 1, "x", 0) for r in rows], "doc_id long, text string, fp int, n string, component_id int"
    ).repartition(3)
    got = s.near_duplicates(frame).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == classes(rows, prints)
    want = sorted(((i, p) for (i, _), p in zip(rows, prints, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in got), key=str) == want


def near_prints(seed, groups=30, size=12, width=64):
    """Groups of fingerprints around a centre, and some alone."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(size):
            flips = rng.sample(range(width), rng.randrange(0, 6))
            prints.append(centre ^ sum(1 << b for b in flips))
    return sorted(set(prints))


def found_classes(spark, prints, links):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 4
        parent[find(a)] = find(b)
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(p)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("full", [64, 2, 0])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, full):
    """Joined, in blocks for the fuller values, and in blocks alone."""
    monkeypatch.setattr(s, "FULL", full)
    monkeypatch.setattr(s, "BLOCK", 5)
    prints = near_prints(full, groups=8, size=10)
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in s.link_nodes(nodes).collect()]
    pairs = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4]
    assert found_classes(spark, prints, links) == found_classes(spark, prints, pairs)


def test_partitions_and_thresholds_reach_every_pair():
    rng = np.random.default_rng(2)
    for n in (10, 10**6, 10**11):
        prints = rng.integers(0, 2**63, 3000).astype(np.uint64) | np.uint64(7)  # bits 0-2 never change
        bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
        groups, thresholds = s.choose_partitions(n, bits.T @ bits * n // 3000, 4)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(t + 1 for t in thresholds) == 5
        for _ in range(300):
            flips = set(rng.choice(64, 4, replace=False).tolist())
            assert any(len(flips & set(g)) <= t for g, t in zip(groups, thresholds, strict=True))
    assert len(s.choose_partitions(10**6, bits.T @ bits * 10**6 // 3000, 4)[0]) == 3
    assert len(s.choose_partitions(10**11, bits.T @ bits * 10**11 // 3000, 4)[0]) == 2


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40:50] = bits[:, :1]
    groups = s.group_bits(4000, bits.T @ bits, 3)
    assert any(set(range(40, 50)) | {0} <= set(g) for g in groups)


def test_a_large_group_of_near_copies_gives_forests(spark, monkeypatch):
    """Every two of these link, but rows stay a small multiple of the nodes."""
    monkeypatch.setattr(s, "FULL", 4)
    prints = [0b1111 << 20 ^ a ^ b for a, b in combinations([1 << i for i in range(40)], 2)]
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = s.link_nodes(nodes).collect()
    assert len(links) < 45 * len(prints) < len(prints) ** 2 / 4  # 45 probes a node at most
    assert len(found_classes(spark, prints, [(r.a, r.b) for r in links])) == 1


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 37}" for i in range(3000)) + "\n"
    monkeypatch.setattr(s, "PIECE", 50)
    assert s.fingerprint(text.encode()) == plain_fingerprint(text)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert s.near_duplicates(none).count() == 0
    assert s.near_duplicates(spark.createDataFrame([(3, "x")], "doc_id long, text string")).count() == 1
