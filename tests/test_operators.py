"""Operators against plain Python on small tables, hot keys and NULLs included."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmill.operators import aggregates, dedupe, filters, joins, quality, setops, surrogate, upserts
from starmill.sources.snapshots import snapshots


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- joins ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Facts of which a third share key 1 and a quarter have no key; two lookup rows for key 1."""
    rnd = random.Random(7)
    fact = []
    for i in range(3000):
        u = rnd.random()
        key = 1 if u < 0.34 else None if u < 0.6 else rnd.randrange(2, 400)
        fact.append((i, key, rnd.choice("ab")))
    dim = [(k, t, f"{k}{t}") for k in range(1, 300) for t in "ab"] + [(1, "a", "again"), (None, "a", "never")]
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("on", [["k"], ["k", "t"]])
def test_salted_join_equals_brute_force(spark, skewed, how, on):
    fact, dim = skewed
    f = spark.createDataFrame(fact, "id int, k int, t string")
    d = spark.createDataFrame(dim, "k int, t string, v string").select(*on, "v")
    want = Counter()
    for i, k, t in fact:
        hits = [v for dk, dt, v in dim if k is not None and dk == k and (on == ["k"] or dt == t)]
        for v in hits or ([None] if how == "left" else []):
            want[(i, k, t, v)] += 1
    got = joins.salted_join(f, d, on, how).select("id", "k", "t", "v")
    assert rows(got) == want
    assert rows(joins.lookup_join(f, d, on, how).select("id", "k", "t", "v")) == want


def test_hot_keys_are_found_and_spread(spark, skewed):
    fact = spark.createDataFrame(skewed[0], "id int, k int, t string")
    assert sorted(tuple(r)[0] or 0 for r in joins.hot_keys(fact, ["k"], 0.1)) == [0, 1]
    salts = fact.filter("k = 1").select(F.pmod(F.xxhash64("id", "k", "t"), F.lit(joins.MIN_SALTS)).alias("s"))
    biggest = salts.groupBy("s").count().agg(F.max("count")).first()[0]
    assert biggest < salts.count() / 8


def test_salts_follow_the_partitions(spark, skewed, monkeypatch):
    assert joins.hot_share(200) == joins.HOT_SHARE and joins.hot_share(2000) == 4 / 2000
    assert joins.hot_share(10**6) == 1 / joins.MAX_HOT
    monkeypatch.setattr(joins, "_partitions", lambda df: 600)
    f = spark.createDataFrame(skewed[0], "id int, k int, t string")
    d = spark.createDataFrame([(1, "one"), (2, "two")], "k int, v string")
    joined = joins.salted_join(f, d, ["k"], "left")
    assert joined.count() == 3000
    assert joined.filter("k = 1").count() == joined.filter("v = 'one'").count() == f.filter("k = 1").count()


def test_no_hot_key_gives_a_plain_join(spark, capsys):
    f = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    d = spark.range(500).select(F.col("id").alias("k"), F.lit(2).alias("y"))
    joined = joins.salted_join(f, d, ["k"], "left")
    assert joined.count() == 1000
    joined.explain()
    assert "_salt" not in capsys.readouterr().out


def test_broadcast_only_within_the_bound(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=999)
    assert not joins.fits_broadcast(df, max_bytes=100_000)
    assert joins.fits_broadcast(df.limit(0))


def test_orphan_keys(frame):
    child = frame([(1,), (1,), (2,), (3,), (None,)], "k int")
    parent = frame([(2,), (2,), (9,)], "p int")
    assert rows(joins.orphan_keys(child, "k", parent, "p")) == Counter({(1, 2): 1, (3, 1): 1})


# --- dedupe and upserts --------------------------------------------------------------------


def test_first_and_last_per_key(frame):
    df = frame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, None, "n"), (2, 1, "m")], "k int, o int, v string")
    assert rows(dedupe.first_per_key(df, ["k"], ["o"])) == Counter({(1, 3, "a"): 1, (2, None, "n"): 1})
    assert rows(dedupe.last_per_key(df, ["k"], ["o"])) == Counter({(1, 5, "b"): 1, (2, 1, "m"): 1})
    assert dedupe.first_per_key(df, ["k"], ["o"]).columns == df.columns


def test_latest_attributes(frame):
    df = frame(
        [(1, 10, "Ann", "free"), (1, 20, "Anne", "paid"), (1, 15, "Ann", "free"), (2, 1, "Bo", "paid")],
        "id int, ts int, name string, level string",
    )
    got = dedupe.latest_attributes(df, ["id"], "ts", ["level"], ["name"]).select("id", "name", "level", "ts")
    assert rows(got) == Counter({(1, "Ann", "paid", 20): 1, (2, "Bo", "paid", 1): 1})


@pytest.fixture(params=[True, False], ids=["small batch", "large batch"])
def batch_size(request, monkeypatch):
    monkeypatch.setattr(upserts, "fits_broadcast", lambda *_, **__: request.param)


def test_insert_if_absent(frame, batch_size):
    table = frame([(1, "old"), (2, "old")], "k int, v string")
    batch = frame([(2, "new"), (3, "x"), (3, "a")], "k int, v string")
    merged = upserts.insert_if_absent(table, batch, ["k"])
    assert rows(merged) == Counter({(1, "old"): 1, (2, "old"): 1, (3, "a"): 1})
    assert rows(upserts.insert_if_absent(merged, batch, ["k"])) == rows(merged)


@pytest.mark.parametrize("few", [True, False], ids=["few batch keys", "many batch keys"])
@pytest.mark.parametrize("fits", [lambda n: True, lambda n: n <= 2, lambda n: False], ids=["small", "few new", "large"])
def test_absent_rows(spark, frame, monkeypatch, few, fits):
    monkeypatch.setattr(upserts, "few_keys", lambda *_: few)
    monkeypatch.setattr(upserts, "fits_broadcast", lambda df: fits(df.count()))
    known = frame([(1, "a"), (None, "n"), (2, None), (3, "c")], "k int, t string")
    batch = [(1, "a", 1), (1, "b", 2), (1, "b", 3), (None, "n", 4), (None, None, 5), (2, None, 6), (3, "c", 7)]
    got = upserts.absent_rows(known, frame(batch, "k int, t string, v int"), ["k", "t"])
    assert got.columns == ["k", "t", "v"]
    assert rows(got) == Counter([(1, "b", 2), (1, "b", 3), (None, None, 5)])


@pytest.mark.parametrize("fits", [True, False])
def test_only_rows_of_repeated_keys_are_moved(frame, monkeypatch, fits):
    monkeypatch.setattr(dedupe, "fits_broadcast", lambda *_: fits)
    schema = "k int, t string, o int, v string"
    items = [(1, "a", 2, "x"), (1, "a", 1, "y"), (1, None, 1, "z"), (None, None, 1, "q"), (None, None, None, "p"), (2, "a", 3, "m")]
    df = frame(items, schema)
    repeated = dedupe.repeated_keys(df, ["k", "t"])
    assert repeated.count() == 2
    got = dedupe.first_of_repeated(df, ["k", "t"], repeated, ["o"])
    assert got.columns == df.columns and rows(got) == rows(dedupe.first_per_key(df, ["k", "t"], ["o"]))
    assert dedupe.repeated_keys(df, ["v"]) is None and dedupe.first_of_repeated(df, ["v"], None) is df


def test_few_keys(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), "id")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    assert joins.few_keys(df, ["k"]) and not joins.few_keys(df, ["id"])


def test_merge_latest(frame, batch_size):
    schema = "id int, name string, level string, ts int"
    table = frame([(1, "Ann", "free", 10), (2, "Bo", "paid", 10), (4, "Di", "free", 10)], schema)
    batch = frame(
        [(1, "Anne", "paid", 20), (1, "Anna", "free", 15), (2, "B", "free", 5), (3, "Cy", "free", 1),
         (3, "C", "paid", 2), (4, "D", "paid", 10)],
        schema,
    )
    merged = upserts.merge_latest(table, batch, ["id"], "ts", ["level"])
    want = Counter({
        (1, "Ann", "paid", 20): 1,  # level follows the time, the name stays
        (2, "Bo", "paid", 10): 1,  # an older row changes nothing
        (3, "Cy", "paid", 2): 1,  # a new user: first name, last level
        (4, "Di", "free", 10): 1,  # at the same time the table wins
    })
    assert rows(merged.select("id", "name", "level", "ts")) == want
    again = upserts.merge_latest(merged, batch, ["id"], "ts", ["level"])
    assert rows(again.select("id", "name", "level", "ts")) == want


# --- aggregates and filters ----------------------------------------------------------------


def test_share_of_total(frame):
    df = frame([("paid", 1), ("paid", 2), ("free", 3), (None, None)], "level string, id int")
    assert rows(aggregates.share_of_total(df, "level", "id")) == Counter(
        {("paid", 2, 66): 1, ("free", 1, 33): 1, (None, 0, 0): 1}
    )
    exact = {r["level"]: r["percent"] for r in aggregates.share_of_total(df, "level", "id", exact=True).collect()}
    assert exact["paid"] == pytest.approx(200 / 3)


def test_count_by_joined_keeps_unmatched_rows(frame):
    fact = frame([(1, "a"), (2, "a"), (3, "b"), (4, None), (None, "a")], "id int, k string")
    dim = frame([("a", 7)], "k string, w int")
    assert rows(aggregates.count_by_joined(fact, dim, "k", ["w"], "id")) == Counter({(7, 2): 1, (None, 2): 1})


def test_probes_and_flags(frame):
    df = frame([(1, "2020"), (1, "2021"), (2, None)], "k int, d string")
    assert tuple(aggregates.snapshot_probe(df, "d").first()) == (2, "2021")
    assert aggregates.max_key_count(df, ["k"]).first()[0] == 2
    assert aggregates.non_empty_flag(df).first()[0] == 1
    assert aggregates.non_empty_flag(df.filter("k > 9")).first()[0] == 0
    assert rows(aggregates.count_per(df, ["k"])) == Counter({(1, 2): 1, (2, 1): 1})
    assert rows(snapshots(df, "d", latest_only=True)) == Counter({(1, "2021"): 1})
    assert snapshots(df, "d").count() == 3


def test_filters(frame):
    df = frame([(1, "a"), (2, ""), (3, None), (None, "b")], "k int, t string")
    assert filters.require_values(df, ["k", "t"]).count() == 2
    assert filters.require_text(df, ["t"]).count() == 2
    assert filters.drop_incomplete(df).count() == 2
    assert filters.keep_type(df, "t", "a").count() == 1
    assert filters.lookup(df, k=2, t="").count() == 1
    times = frame([(datetime(2020, 1, d),) for d in (1, 2, 3)], "ts timestamp_ntz")
    assert filters.in_period(times, "ts", "2020-01-01", "2020-01-03").count() == 2


def test_trend_weighted(frame):
    df = frame([("x", datetime(2020, 1, 3), 2), ("x", datetime(2020, 1, 9), 3)], "a string, ts timestamp_ntz, n int")
    assert aggregates.trend(df, ["a"], F.col("ts"), weight="n").first()["n"] == 5
    assert aggregates.trend(df, ["a"], F.col("ts")).first()["n"] == 2


# --- sets, keys ----------------------------------------------------------------------------


def test_unions(frame):
    a = frame([(1, "x"), (1, "x")], "k int, t string")
    b = frame([("y", 2)], "t string, k int")
    c = frame([(3,)], "k int")
    assert setops.append_aligned(a, b, c).count() == 4
    assert (3, None) in rows(setops.append_aligned(a, b, c))
    assert rows(setops.union_distinct(a.select("k"), c, c)) == Counter({(1,): 1, (3,): 1})
    assert setops.sorted_columns(b.select("t", "k")).columns == ["k", "t"]
    conformed = setops.conform(c, a.schema)
    assert conformed.schema == a.schema and rows(conformed) == Counter({(3, None): 1})


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_dense_ids(spark, partitions):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), F.lit("x").alias("v"))
    got = surrogate.dense_ids(df, ["k"], "n", partitions=partitions)
    assert got.columns == ["n", "k", "v"]
    assert sorted((r["k"], r["n"]) for r in got.collect()) == [(i, i + 1) for i in range(1000)]


def test_dense_ids_with_one_hot_value(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    got = [r["n"] for r in surrogate.dense_ids(df, ["k", "id"], "n", start=0, partitions=6).collect()]
    assert sorted(got) == list(range(900))


def test_unordered_ids(spark):
    assert surrogate.unordered_ids(spark.range(100), "n").select("n").distinct().count() == 100


# --- quality -------------------------------------------------------------------------------


def test_checks_really_compare(spark, frame):
    df = frame([(1, "a"), (1, None)], "k int, t string")
    parent = frame([(2,)], "p int")
    good = [quality.not_empty("t", df), quality.no_nulls("t", df, ["k"])]
    assert all(r["passed"] for r in quality.run_checks(spark, good))
    for bad in (
        quality.not_empty("t", df.limit(0)),
        quality.unique_key("t", df, ["k"]),
        quality.no_nulls("t", df, ["k", "t"]),
        quality.no_orphans("t", df, "k", parent, "p"),
    ):
        with pytest.raises(quality.QualityError, match="expected"):
            quality.run_checks(spark, [*good, bad])


def test_checks_as_sql(spark, frame):
    frame([(1,), (2,)], "k int").createOrReplaceTempView("two_rows")
    check = quality.Check("rows", "SELECT count(*) FROM {}", "two_rows", 2)
    assert quality.run_checks(spark, [check])[0]["actual"] == 2
    with pytest.raises(quality.QualityError):
        quality.run_checks(spark, [quality.Check("rows", "SELECT count(*) FROM {}", "two_rows", 3)])


def test_an_empty_table_fails_only_the_check_that_it_is_not_empty(spark, frame):
    empty = frame([], "k int")
    result = quality.check_results(spark, [quality.unique_key("t", empty, ["k"])]).first()
    assert result["actual"] == 1 and result["passed"] is True
    result = quality.check_results(spark, [quality.not_empty("t", empty)]).first()
    assert result["passed"] is False


def test_rejects_and_report(frame):
    df = frame([(1, "a"), (2, None), (None, None)], "k int, t string")
    rules = {"no_key": F.col("k").isNull(), "no_text": F.col("t").isNull()}
    good, rejected = quality.split_rejects(df, rules)
    assert rows(good) == Counter({(1, "a"): 1})
    assert rows(rejected) == Counter({(2, None, "no_text"): 1, (None, None, "no_key"): 1})
    report = quality.load_report({"x": (df, F.col("k").isNotNull()), "y": (good, F.lit(True))})
    assert rows(report) == Counter({("x", 3, 2, 1): 1, ("y", 1, 1, 0): 1})
    assert rows(quality.null_counts(df, ["k", "t"], "x")) == Counter({("x", "k", 1): 1, ("x", "t", 2): 1})
