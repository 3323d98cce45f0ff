"""Ranked lexical search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from starmill.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n, total = len(counts), sum(c.total() for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in held.items()}
    out = []
    for item, text in sorted(set(items), key=str):
        found = []
        for i, c in counts:
            m = 100 - 25 + (25 * c.total() * n) // total
            score = sum(
                weights[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        found.sort()
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def corpus(n, seed=1):
    """Texts over words of very different frequency, some of them equal, empty or null."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "été", "a_b", "MIT"]
    texts = []
    for i in range(n):
        length = rng.choice([0, 1, 5, 40, 200])
        picked = [vocabulary[min(int(rng.expovariate(0.02)), len(vocabulary) - 1)] for _ in range(length)]
        texts.append((i, rng.choice([" ", "-", "\n"]).join(picked)))
    texts += [(n, None), (None, "w1 w2 w300 rare"), (n + 1, texts[3][1]), (n + 1, texts[3][1])]
    return texts


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_every_item_gets_its_best_documents(spark, monkeypatch, size):
    monkeypatch.setattr(ls, "BLOCK_POSTINGS", size)  # blocks of one document, and of many
    docs = corpus(400)
    items = [
        (1, "w1 w1 W2 w250, MIT"), (2, "w0"), (3, "nothing-here"), (4, ""), (5, None), (1, "w1 w1 W2 w250, MIT"),
        (2, "rare Été été w3 w299"), (None, "w7 w8"), (6, " ".join(f"w{i}" for i in range(300))),
    ]
    frame = spark.createDataFrame(
        [(i, t, 0, "x") for i, t in docs], "doc_id long, text string, n int, terms string"
    ).repartition(3)
    asked = spark.createDataFrame([(*i, 1.0) for i in items], "item_id long, text string, score double")
    got = result(ls.rank_documents(frame, asked))
    assert got == brute(docs, [i for i in items if i[1] is not None])


def test_items_in_several_passes(spark, monkeypatch):
    docs, items = corpus(120, 2), [(i, f"w{i} w{2 * i} w0") for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ls, "ITEM_BLOCK", 8)
    assert result(ls.rank_documents(frame, asked, k=5)) == brute(docs, items, k=5)


def test_blocks_skip_and_agree_with_adding_everything(monkeypatch):
    monkeypatch.setattr(ls, "WINDOW", 16)
    rng = np.random.default_rng(3)
    for short in (0.0, 1 / 16, 1.0):  # document at a time alone, the hybrid, term at a time alone
        monkeypatch.setattr(ls, "SHORT", short)
        n, n_terms = 500, 40
        held = rng.random((n, n_terms)) < np.linspace(0.01, 0.9, n_terms)
        document, terms = np.nonzero(held)
        counts = rng.integers(1, 6, len(terms))
        measure = rng.integers(75, 300, n)
        lists = ls.Postings(n, terms, counts, document, measure, n_terms)
        asked = rng.choice(n_terms, 12, replace=False)
        factors = rng.integers(1, 4000, 12)
        impact = np.zeros((n, n_terms), np.int64)
        impact[document, terms] = (10**9 * counts) // (1000 * counts + 12 * measure[document])
        score = impact[:, asked] @ factors
        ids = rng.permutation(n)
        best = ls.Best(10)
        ls.search_block(lists, asked, factors, best, ids, np.zeros(n, bool))
        want = sorted((-s, i) for s, i in zip(score, ids, strict=True) if s)[:10]
        assert list(zip(-best.score, best.ids, strict=True)) == want


def test_long_texts_in_pieces(monkeypatch):
    text = ("Alpha beta-GAMMA delta9 " * 50).encode()
    whole = [t for piece in ls.terms_of(text) for t in piece]
    monkeypatch.setattr(ls, "PIECE", 7)
    assert [t for piece in ls.terms_of(text) for t in piece] == whole == plain_terms_bytes(text)
    assert list(ls.terms_of(b"")) == []


def plain_terms_bytes(text):
    return [t.encode() for t in plain_terms(text.decode())]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ls.rank_documents(none, items).count() == 0
    assert ls.rank_documents(some, items.limit(0)).count() == 0
    assert ls.rank_documents(some, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_equals_its_sql(spark):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({ls.OP11_SQL})").fetchall()
    assert result(ls.op11(spark, sf)) == sorted(want, key=str)
