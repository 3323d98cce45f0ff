"""Merges by directory and inserts by key bitmaps: rows, untouched files, failures, plans."""

import os
import random

import pytest
from pyspark.sql import functions as F

from starmill.operators.upserts import insert_if_absent, merge_latest
from starmill.session import scratch_path
from starmill.sinks import hashed, known_keys, paths
from starmill.sinks import tables as sinks

USERS = "user_id int, name string, level string, seen long"


def files_of(path):
    """Each data file by directory, with what tells a rewritten one apart."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                full = os.path.join(folder, name)
                found.setdefault(os.path.basename(folder), set()).add((name, os.stat(full).st_mtime_ns))
    return found


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def user_rows(rng, n, ids):
    return [(rng.choice(ids), f"n{rng.randrange(4)}", rng.choice(["free", "paid"]), rng.randrange(10**6)) for _ in range(n)]


@pytest.fixture
def users(spark, frame):
    path = scratch_path(spark, "users")
    hashed.create_hashed(spark, path, frame([], USERS).schema, ["user_id"], 8)
    return path


def test_merges_equal_the_whole_merge_and_leave_other_files(spark, frame, users):
    rng = random.Random(1)
    want = frame([], USERS)
    for ids in ([*range(200), None], [7] * 50 + list(range(190, 220)), [3], [None, 5]):  # one hot, one NULL key
        batch = frame(user_rows(rng, 300, ids), USERS)
        before = files_of(users)
        touched = hashed.merge_touched(spark, batch, users, "seen", ["level"])
        want = spark.createDataFrame(merge_latest(want, batch, ["user_id"], "seen", ["level"]).select(*want.columns).collect(), USERS)
        assert rows_of(hashed.read_hashed(spark, users).select(*want.columns)) == rows_of(want)
        after = files_of(users)
        for name, files in before.items():
            if name.startswith(hashed.DIRECTORY) and int(name.split("=")[1]) not in touched:
                assert after[name] == files
    assert len(touched) <= 2
    assert set(after) <= {f"{hashed.DIRECTORY}={i}" for i in range(8)} | {"_layout"}


def test_merging_a_batch_again_changes_nothing(spark, frame, users):
    batch = frame([(1, "a", "free", 5), (1, "b", "paid", 9), (2, "c", "free", 1)], USERS)
    for _ in range(2):
        hashed.merge_touched(spark, batch, users, "seen", ["level"])
        assert rows_of(hashed.read_hashed(spark, users)) == [(1, "a", "paid", 9), (2, "c", "free", 1)]
    hashed.merge_touched(spark, batch.limit(0), users, "seen", ["level"])
    assert hashed.read_hashed(spark, users).count() == 2


def test_a_merge_that_fails_while_moving_is_finished_by_the_next(spark, frame, users, monkeypatch):
    first = frame([(i, "a", "free", 1) for i in range(50)], USERS)
    hashed.merge_touched(spark, first, users, "seen", ["level"])
    moved = []

    def fails(spark, source, target):
        if len(moved) == 3:
            raise OSError("gone")
        moved.append(target)
        real(spark, source, target)

    real = paths.replace
    monkeypatch.setattr(paths, "replace", fails)
    with pytest.raises(OSError):
        hashed.merge_touched(spark, frame([(i, "b", "paid", 2) for i in range(50)], USERS), users, "seen", ["level"])
    monkeypatch.setattr(paths, "replace", real)
    hashed.merge_touched(spark, frame([(99, "z", "free", 3)], USERS), users, "seen", ["level"])
    want = [(i, "a", "paid", 2) for i in range(50)] + [(99, "z", "free", 3)]
    assert rows_of(hashed.read_hashed(spark, users)) == sorted(want, key=str)
    assert not paths.exists(spark, f"{users}/_pending")


def test_a_merge_that_fails_while_writing_leaves_the_table(spark, frame, users, monkeypatch):
    hashed.merge_touched(spark, frame([(1, "a", "free", 1)], USERS), users, "seen", ["level"])

    def writes_a_part(df, path, **options):
        paths.make(spark, f"{path}/{hashed.DIRECTORY}=0")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(hashed, "write_table", writes_a_part)
        with pytest.raises(RuntimeError):
            hashed.merge_touched(spark, frame([(1, "a", "paid", 2)], USERS), users, "seen", ["level"])
    hashed.finish_merge(spark, users)
    assert rows_of(hashed.read_hashed(spark, users)) == [(1, "a", "free", 1)]


def test_a_merge_reads_only_its_directories(spark, frame, users):
    hashed.merge_touched(spark, frame([(i, "a", "free", 1) for i in range(100)], USERS), users, "seen", ["level"])
    read = hashed.read_hashed(spark, users, with_directory=True).filter(F.col(hashed.DIRECTORY).isin([3]))
    assert {os.path.basename(os.path.dirname(f)) for f in read.inputFiles()} > {f"{hashed.DIRECTORY}=3"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hash_directory" in plan or "hash_directory#" in plan.split("PartitionFilters")[1]
    scanned = read.select(F.input_file_name()).distinct().collect()
    assert all(f"{hashed.DIRECTORY}=3" in r[0] for r in scanned)


# --- key bitmaps ---

EVENTS = "id long, at int, kind string"


def test_inserts_by_bitmaps_equal_inserts_by_keys(spark, frame):
    rng = random.Random(2)
    path, want = scratch_path(spark, "events"), frame([], EVENTS)
    ids = [None, -1, 0, 1, 7, 8, 32767, 32768, 32769, -32768, 2**62, -(2**62), *range(100, 160)]
    for _ in range(4):
        batch = frame([(rng.choice(ids), rng.randrange(100), rng.choice("abc")) for _ in range(60)], EVENTS)
        known_keys.append_unknown(spark, batch, path, "id", ["at", "kind"])
        want = spark.createDataFrame(insert_if_absent(want, batch, ["id"], ["at", "kind"]).collect(), EVENTS)
        got = spark.read.schema(EVENTS).parquet(path)
        assert rows_of(got) == rows_of(want)
    known_keys.append_unknown(spark, got, path, "id")
    assert spark.read.schema(EVENTS).parquet(path).count() == want.count()


def test_bitmaps_are_built_again_after_a_failed_load(spark, frame, monkeypatch):
    path = scratch_path(spark, "events")
    known_keys.append_unknown(spark, frame([(1, 1, "a"), (2, 1, "a")], EVENTS), path, "id")

    def fails(*_):
        raise RuntimeError("lost between rows and bits")

    with monkeypatch.context() as patch:
        patch.setattr(known_keys, "key_bitmaps", fails)
        with pytest.raises(RuntimeError):
            known_keys.append_unknown(spark, frame([(2, 2, "b"), (3, 2, "b")], EVENTS), path, "id")
    known_keys.append_unknown(spark, frame([(2, 2, "b"), (3, 2, "b"), (4, 2, "b")], EVENTS), path, "id")
    got = spark.read.schema(EVENTS).parquet(path)
    assert rows_of(got) == [(1, 1, "a"), (2, 1, "a"), (3, 2, "b"), (4, 2, "b")]


def test_bitmaps_are_built_for_a_table_that_has_none_and_united(spark, frame, monkeypatch):
    path = scratch_path(spark, "events")
    sinks.write_table(frame([(i, 0, "a") for i in range(40)], EVENTS), path)
    monkeypatch.setattr(known_keys, "UNITE_AFTER", 1)
    for i in range(5):
        known_keys.append_unknown(spark, frame([(j, i, "b") for j in range(30, 45 + i)], EVENTS), path, "id")
    assert spark.read.schema(EVENTS).parquet(path).count() == 49
    bits = known_keys.read_bitmaps(spark, path)
    assert bits.count() == 2  # key 0 has a block of its own
    assert known_keys.unite(bits).select(F.sum(F.bitmap_count("bits"))).first()[0] == 49


def test_a_batch_meets_bitmaps_and_not_the_table(spark, frame):
    path = scratch_path(spark, "events")
    known_keys.append_unknown(spark, frame([(i, 0, "a") for i in range(1000)], EVENTS), path, "id")
    batch = frame([(i, 1, "b") for i in range(990, 1010)], EVENTS)
    added = known_keys.unknown_rows(batch, "id", known_keys.read_bitmaps(spark, path))
    assert {r.id for r in added.collect()} == set(range(1000, 1010))
    assert {os.path.dirname(f).split("/")[-1] for f in added.inputFiles()} == {os.path.basename(path) + "_keys"}


def test_other_keys_are_refused(spark, frame):
    with pytest.raises(ValueError, match="append_new"):
        known_keys.append_unknown(spark, frame([("a",)], "id string"), scratch_path(spark, "x"), "id")
