"""Compaction, curves over several keys, counts of a write, leading reactions."""

import os
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starmill.operators.aggregates import count_per
from starmill.plans import drug
from starmill.session import scratch_path
from starmill.sinks import compaction, counted, interleaved, paths
from starmill.sinks.tables import RowCount, write_table

# --- compaction ---


def data_files(path):
    found = defaultdict(dict)
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                full = os.path.join(folder, name)
                found[os.path.basename(folder)][name] = os.stat(full).st_mtime_ns
    return found


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def scattered(spark, frame):
    """Directories with many small files, one with a single one, one for NULL, one with a name to be escaped."""
    path = scratch_path(spark, "scattered")
    rows = [(i, f"v{i}", "a b%" if i % 4 == 0 else "b" if i % 4 == 1 else None) for i in range(400)]
    frame(rows, "id int, v string, p string").repartition(7).write.partitionBy("p").parquet(path)
    frame([(1000, "x", "single")], "id int, v string, p string").write.mode("append").partitionBy("p").parquet(path)
    return path


def test_small_files_are_written_together_once(spark, scattered):
    before, rows = data_files(scattered), rows_of(spark.read.parquet(scattered))
    replaced = compaction.compact(spark, scattered, ["p"], ["id"])
    after = data_files(scattered)
    assert rows_of(spark.read.parquet(scattered)) == rows
    assert replaced == sum(len(f) for d, f in before.items() if d != "p=single") > 6
    assert all(len(files) == 1 for files in after.values()) and after["p=single"] == before["p=single"]
    assert compaction.compact(spark, scattered, ["p"]) == 0 and data_files(scattered) == after
    assert not paths.exists(spark, f"{scattered}/_compacted")


def test_rounds_and_bins_end(spark, scattered):
    rows = rows_of(spark.read.parquet(scattered))
    biggest = max(r.bytes for r in compaction.file_sizes(spark, scattered).collect())
    compaction.compact(spark, scattered, ["p"], target_bytes=3 * biggest, round_files=4)
    assert rows_of(spark.read.parquet(scattered)) == rows
    assert compaction.small_files(compaction.file_sizes(spark, scattered), 3 * biggest).count() == 0


def test_large_files_stay(spark, scattered):
    before = data_files(scattered)
    assert compaction.compact(spark, scattered, ["p"], target_bytes=10) == 0
    assert data_files(scattered) == before


def test_a_compaction_that_fails_is_finished(spark, scattered, monkeypatch):
    rows = rows_of(spark.read.parquet(scattered))
    real, removed = paths.remove, []

    def fails(spark, path):
        if "/part-" in path:
            if len(removed) == 2:
                raise OSError("gone")
            removed.append(path)
        real(spark, path)

    monkeypatch.setattr(paths, "remove", fails)
    with pytest.raises(OSError):
        compaction.compact(spark, scattered, ["p"])
    monkeypatch.setattr(paths, "remove", real)
    compaction.finish_compaction(spark, scattered)
    assert rows_of(spark.read.parquet(scattered)) == rows


# --- curves ---


def groups_met(path, column, low, high):
    """Row groups whose range of a column meets a filter, of all."""
    met = total = 0
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, name)).metadata
                for g in range(meta.num_row_groups):
                    columns = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i) for i in range(meta.num_columns)}
                    stats = columns[column].statistics
                    total += 1
                    met += not (stats.max < low or stats.min > high)
    return met, total


def test_either_filter_skips_most_row_groups(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10_000), int(rng.expovariate(0.001)), f"w{rng.randrange(500):03}") for _ in range(40_000)]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    sorted_path, curve_path = scratch_path(spark, "sorted"), scratch_path(spark, "curve")
    df.repartitionByRange(64, "a").sortWithinPartitions("a").write.parquet(sorted_path)
    interleaved.write_interleaved(df, curve_path, ["a", "b"], files=64)
    one_key, total = groups_met(sorted_path, "b", 100, 140)
    both, _ = groups_met(curve_path, "b", 100, 140)
    first, all_groups = groups_met(curve_path, "a", 5000, 5100)
    assert one_key > 0.9 * total and both <= one_key / 3 and first <= all_groups / 3
    assert rows_of(spark.read.parquet(curve_path)) == sorted(rows, key=str)


def test_any_type_and_nulls_have_a_place(spark, frame):
    rows = [(None, None, None, None), *[(f"é{i}", i % 2 == 0, i / 7, str(i)) for i in range(50)]]
    df = frame(rows, "s string, f boolean, d double, t string").withColumn("day", F.date_add(F.lit("2020-01-01"), F.length("s")))
    path = scratch_path(spark, "any")
    interleaved.write_interleaved(df, path, ["s", "f", "d", "day"])
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    interleaved.write_interleaved(df.limit(0), scratch_path(spark, "none"), ["s", "d"])
    with pytest.raises(ValueError, match="order"):
        interleaved.write_interleaved(df.select(F.array("s").alias("x")), path, ["x"])


def test_a_hot_value_spans_files(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), (F.col("id") % 5).alias("b"), "id")
    path = scratch_path(spark, "hot")
    interleaved.write_interleaved(df, path, ["a", "id"], files=16)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 4000


# --- counts ---


def test_counts_ride_on_the_write(spark, frame):
    rows = [(i, None if i % 5 == 0 else i) for i in range(100)]
    source = scratch_path(spark, "source")
    frame(rows, "id int, v int").write.parquet(source)
    df, path = spark.read.parquet(source), scratch_path(spark, "counted")
    rules = {"no value": F.col("v").isNull(), "large": F.col("v") > 90}
    found = counted.write_counted(df, path, rules, rejects=f"{path}-rejects")
    assert found == {"rows_in": 100, "rows_out": 72, "rejected": 28, "no value": 20, "large": 8}
    assert spark.read.parquet(path).count() == 72 and spark.read.parquet(path).columns == ["id", "v"]
    reasons = count_per(spark.read.parquet(f"{path}-rejects"), ["reject_reason"]).collect()
    assert {r.reject_reason: r.n for r in reasons} == {"no value": 20, "large": 8}
    assert counted.write_counted(df.limit(0), path)["rows_in"] == 0


def test_a_row_count_needs_no_second_scan(spark, frame):
    count = RowCount()
    assert count.rows == 0
    df = count.on(frame([(i,) for i in range(30)], "id int"))
    assert df._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    write_table(df, scratch_path(spark, "rows"))
    assert count.rows == 30


# --- leading reactions ---


def test_leading_reactions_of_a_hot_code(spark, frame):
    rng = random.Random(3)
    reports = [(f"r{i}", f"20{10 + rng.randrange(2)}-{rng.choice(['01', '02', '06'])}-1{rng.randrange(9)}") for i in range(300)]
    events = [(r, f"p{j}", "hot" if rng.random() < 0.7 else f"c{rng.randrange(4)}") for r, _ in reports for j in range(rng.randrange(3))]
    named = [(rng.choice("abcdefg"), r) for r, _ in reports for _ in range(rng.randrange(4))]
    headers = frame(reports, "safetyreportid string, day string").select("safetyreportid", F.to_date("day").alias("receivedate"))
    got = drug.leading_reactions(
        frame(events, "safetyreportid string, package_ndc string, formatted_ndc string"),
        frame(named, "reactionmeddrapt string, safetyreportid string"), headers, k=2,
    )
    counts, month = Counter(), {r: d[:7] for r, d in reports}
    for r, _, code in events:
        for reaction, other in named:
            if other == r:
                counts[code, month[r], reaction] += 1
    want, spans = set(), defaultdict(set)
    for code, m, _ in counts:
        spans[code].add(m)
    for code, months in spans.items():
        m = min(months)
        while m <= max(months):
            ranked = sorted((-n, reaction) for (c, o, reaction), n in counts.items() if (c, o) == (code, m))[:2]
            want |= {(code, m, i + 1, reaction, -n) for i, (n, reaction) in enumerate(ranked)} or {(code, m, 0, None, 0)}
            year, number = int(m[:4]), int(m[5:])
            m = f"{year + number // 12}-{number % 12 + 1:02}"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # each task's first k, then those of all
    rows = got.collect()
    assert {(r[0], r[1].strftime("%Y-%m"), *r[2:]) for r in rows} == want and len(rows) == len(want)
