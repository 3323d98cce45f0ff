"""Nearest neighbours, near duplicates, fingerprints and licenses against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import licenses, multi_index_hashing, near_duplicates, weighted_sampling

SCHEMA = "doc_id long, text string, source string, row string, found int"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "s", "x", 1) for i, t in texts], SCHEMA)


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10_000)}" for _ in range(n)]


# --- nearest neighbours ---


def exact(vectors, queries, k):
    out = {}
    for q in queries:
        scored = sorted((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_nearest_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    x = {i: rng.normal(size=16).round(3) for i in range(600)}
    for i in range(100, 130):  # a group of copies
        x[i] = x[100]
    rows = [(i, [float(c) for c in v], "extra") for i, v in x.items()]
    rows += [(1000, None, ""), (1001, [0.0] * 16, ""), (1002, [float("nan")] * 16, ""), (1003, [None] * 16, ""), (1004, [1.0], ""), (None, [1.0] * 16, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, side string")
    found = multi_index_hashing.nearest(df, F.col("vec_id") % 20 == 0, k=10).orderBy("query_id", "rank").collect()
    got = defaultdict(list)
    for r in found:
        got[r.query_id].append(r.vec_id)
    want = exact(x, [i for i in x if i % 20 == 0], 10)
    assert sorted(got) == sorted(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    assert got[100] == list(range(101, 111))  # copies first, ties by id


def test_few_vectors_give_all_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 1.0]), (3, [0.2, 0.1])], "vec_id long, embedding array<float>")
    found = multi_index_hashing.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert Counter(r.query_id for r in found) == {0: 2, 20: 2}
    assert multi_index_hashing.nearest(df.filter("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_queries_are_searched_once_and_each_vector_of_an_id_by_itself(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)).round(2)
    rows = [(i, v.tolist(), 7, 0) for i, v in enumerate(x)] + [(20, x[20].tolist(), 7, 0)] * 2 + [(40, (-x[40]).tolist(), 7, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id int, rank int")
    found = multi_index_hashing.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect()
    assert Counter(r.query_id for r in found) == {i: 20 if i == 40 else 10 for i in range(0, 300, 20)}
    twenty = [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 20]
    assert len(set(twenty)) == 10
    both = Counter((r["rank"], r.score > 0) for r in found if r.query_id == 40)
    assert {rank for rank, _ in both} == set(range(1, 11)) and set(both.values()) <= {1, 2}
    vectors = [(i, v) for i, v, _, _ in rows]
    want = sorted((-float(np.dot(x[20], v)), i) for i, v in vectors if i != 20)[:10]
    assert len({i for _, i in want} & set(twenty)) >= 8


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (500, 4), dtype=np.uint8)
    index = multi_index_hashing.Index(codes)
    for radius in (0, 3, 7, 11, 20, 32):
        for code in codes[:20]:
            want = np.flatnonzero(np.bitwise_count(codes ^ code).sum(1) <= radius)
            assert np.array_equal(index.probe(code, radius), want)


# --- near duplicates ---


def brute_links(texts):
    sets = {}
    for i, t in texts:
        w = re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else None
    links, parent = Counter(), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    plain = dict(texts)
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        same = (plain[a] or "") == (plain[b] or "") if x is None or y is None else len(x & y) / len(x | y) >= 0.8
        if same and (x is None) == (y is None):
            links[a] += 1
            links[b] += 1
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (links[i], root(i)) for i in sets}


@pytest.mark.parametrize("block", [4, 256])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    texts, rng = [], random.Random(3)
    for g in range(6):
        base = words(80, g)
        for _ in range(2 + 3 * g):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append((len(texts), " ".join(copy)))
    texts += [(100 + i, t) for i, t in enumerate(["", None, "", "one two", "One, two!", "...", "x " * 4000, "x " * 4000])]
    out = near_duplicates.near_duplicates(documents(spark, texts))
    got = {r.doc_id: (r.n_links, r.class_id) for r in out.collect()}
    assert got == brute_links(texts)
    kept = near_duplicates.one_of_each(documents(spark, texts))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got.values()})


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "g h i j k l"), (None, "m n o p q r")])
    assert sorted((r.doc_id or 0, r.n_links) for r in near_duplicates.near_duplicates(df).collect()) == [(0, 0), (0, 0), (1, 1), (1, 1)]
    assert near_duplicates.one_of_each(df).count() == 3
    assert near_duplicates.one_of_each(df.limit(0)).count() == 0


def test_copies_of_a_row_are_sent_once(spark, monkeypatch):
    sent, with_sets = [], near_duplicates._with_sets
    monkeypatch.setattr(near_duplicates, "_with_sets", lambda docs, words: sent.append(docs.count()) or with_sets(docs, words))
    text = " ".join(words(80, 1))
    texts = [(1, text)] * 20 + [(None, text + " more")] * 20 + [(2, text + " again")]
    out = near_duplicates.near_duplicates(documents(spark, texts)).collect()
    assert sent == [3] and len(out) == 41 and {(r.n_links, r.class_size) for r in out} == {(40, 41)}


def test_bands_reach_the_recall():
    bands, rows = near_duplicates.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= near_duplicates.MAX_HASHES


# --- fingerprints ---


def jaccard(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints_estimate_generalised_jaccard(spark, monkeypatch):
    rng = random.Random(5)
    texts = []
    for i in range(60):
        base = [f"t{rng.randrange(40)}" for _ in range(200)]
        texts.append((2 * i, " ".join(base)))
        texts.append((2 * i + 1, " ".join(base[: 10 + 3 * i] + [f"u{rng.randrange(40)}" for _ in range(190 - 3 * i)])))
    prints = {r.doc_id: r.samples for r in weighted_sampling.fingerprint(documents(spark, texts), k=128).collect()}
    plain = dict(texts)
    errors = [
        sum(x == y for x, y in zip(prints[2 * i], prints[2 * i + 1])) / 128 - jaccard(plain[2 * i], plain[2 * i + 1])
        for i in range(60)
    ]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_registered_draws_are_unbiased_and_as_close_as_their_number_allows(spark):
    rng = random.Random(12)
    texts = []
    for i in range(150):
        base = [f"t{i}x{rng.randrange(40)}" for _ in range(120)]
        texts += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[: 120 - i // 2] + [f"u{i}x{rng.randrange(40)}" for _ in range(i // 2)]))]
    prints = {r.doc_id: r.samples for r in weighted_sampling.fingerprint(documents(spark, texts)).collect()}
    plain = dict(texts)
    k = weighted_sampling.K
    errors = [
        sum(x == y for x, y in zip(prints[2 * i], prints[2 * i + 1])) / k - jaccard(plain[2 * i], plain[2 * i + 1])
        for i in range(150)
    ]
    spread = 0.5 / k**0.5  # the standard error at one half, the greatest
    assert all(len(p) == k for p in prints.values())
    assert abs(np.mean(errors)) < 3 * spread / 150**0.5 and np.std(errors) < 1.2 * spread and np.abs(errors).max() < 4.5 * spread


def test_steps_of_tiny_gamma_values_do_not_overflow(spark):
    """A weight so great that each step is as long as that of the least gamma value."""
    rows = spark.range(2000).select(F.xxhash64(F.concat(F.lit("t"), "id")).alias("term_hash"), F.lit(3e10).alias("log_n"))
    found = rows.select(*[weighted_sampling.draw(k).alias(f"d{k}") for k in range(weighted_sampling.K)]).collect()
    assert len({r.d0 for r in found}) == 2000 and all(d >= 0 for r in found for d in r)


def test_each_document_meets_the_next_one(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "RANGE_ROWS", 7)
    texts = [(i * i, " ".join(words(5 + i, i))) for i in range(90)] + [(-5, ""), (10**12, None), (None, "last one")]
    rows = [r for r in weighted_sampling.with_next(documents(spark, texts)).collect() if not r.extra]
    order = sorted((t for t in texts if t[0] is not None), key=lambda t: -t[0]) + [(None, "last one")]
    want = {i: order[(k + 1) % len(order)][1] or "" for k, (i, _) in enumerate(order)}
    assert {r.doc_id: r.next_text for r in rows} == want


def test_op8_columns_over_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in weighted_sampling.op8(spark, sf).collect()}
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect(), reverse=True)
    prints = defaultdict(set)
    for k, (i, text) in enumerate(docs):
        other, cut = docs[(k + 1) % len(docs)].text, len(text) // 3
        edited = text[: len(text) - cut] + other[:cut]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(text) and 0 <= got[i].near_next <= 1
        prints[text].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


# --- licenses ---


def test_licenses_base_places_and_suppression(spark):
    texts = [
        (1, "Released under the MIT License. The MIT license!"),
        (2, "This work is licensed under the GNU General Public License, version 2."),
        (3, "Licensed under CC BY-NC 4.0."), (4, None), (5, ""), (6, "mit Lizenz und license"),
        (7, "SPDX-License-Identifier: Apache-2.0"), (8, "licensé under the mit licensed"), (9, "apache license " * 3000),
    ]
    found = {r.doc_id: r for r in licenses.scan(documents(spark, texts)).collect()}
    assert [x.start for x in found[1].base] == [3, 6]
    assert {x.label for x in found[2].base} == {"gpl"}
    assert {x.label for x in found[2].found} == {"gpl-2"}  # the unversioned rule lies inside
    assert {x.label for x in found[3].found} == {"cc-by-nc-4.0"}
    assert found[4].n_words == found[5].n_words == 0 and not found[6].found
    assert {x.label for x in found[7].found} == {"apache-2.0"}
    assert len(found[9].base) == 3000
    assert len(licenses.rules()) > 300


def test_license_rules_against_brute_force(spark):
    rules = licenses.rules()
    lines = [line.split(" ", 2)[2] for line in licenses.PHRASES.strip().splitlines()]
    for line in lines:  # every phrase lies within reach of its anchor
        before, after = re.sub(r"\(\?:([^|)]*)[^)]*\)\??", r"\1", line).split("#")
        assert len(before.split()) <= licenses.REACH and len(after.split()) <= licenses.REACH
    plain = [re.sub(r"\(\?: ?c\)\?|[#?]|\(\?:|\)|\[0-9]\{4\}", "", line.replace("[0-9]{4}", "2019")).replace("|", " ") for line in lines]
    rng = random.Random(8)
    names = ["mit license", "gnu general public license version 2", "licensed under cc by sa 4 0", "apache software foundation license", "cc by no derivs license"]
    texts = [" ".join(rng.choice((*plain, *names, "a word", "license", "general public", "under the")) for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    texts += [*plain, *names, "mit license " * 300]
    found = {r.doc_id: r.found for r in licenses.scan(documents(spark, list(enumerate(texts)))).collect()}
    compiled = [(n, label, priority, re.compile(pattern)) for n, _, label, priority, pattern in rules]
    keywords = set(licenses.keywords())
    for i, text in enumerate(texts):
        words, hits = text.split(), []
        for a in [j for j, w in enumerate(words) if w in keywords]:
            first = max(0, a - licenses.REACH)
            window = " ".join([*words[first:a], "#" + words[a], *words[a + 1 : a + 1 + licenses.REACH]])
            for n, label, priority, pattern in compiled:  # all rules at all anchors: no gates
                m = pattern.search(window)
                if m:
                    start = a - m[0].split("#")[0].count(" ")
                    hits.append((n, label, priority, start, start + len(m[0].split())))
        key = lambda x: (x[2], x[4] - x[3], -x[0])
        kept = {x for x in hits if not any(y[3] <= x[3] and y[4] >= x[4] and key(y) > key(x) for y in hits)}
        assert {tuple(x) for x in found[i] or []} == kept, text
    assert all(found[60 + i] for i in range(len(plain) + len(names)))  # each phrase is found by some rule
    assert len({x.number for f in found.values() for x in f or []}) > 180


def test_licenses_of_a_long_text_of_anchors(spark):
    df = documents(spark, [(1, "mit license " * 8000)])
    row = licenses.scan(df).first()
    assert len(row.base) == 8000 and len(row.found) == 8000 and {x.label for x in row.found} == {"mit"}


def test_empty_tables_give_no_rows(spark):
    none = documents(spark, []).limit(0)
    assert weighted_sampling.fingerprint(none).count() == 0
    assert licenses.scan(none).count() == weighted_sampling.with_next(none).count() == 0
