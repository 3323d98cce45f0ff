"""Incremental loads: deliveries with copies, and runs with nothing new."""

from collections import Counter

from starmill.streaming.incremental import append_stream, append_stream_within, latest_stream, new_files


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_append_stream(spark, frame, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = frame([], "k int, v string").schema

    def run():
        append_stream(new_files(spark, source, schema), out, ["k"], mark).awaitTermination()
        return rows(spark.read.parquet(out))

    frame([(1, "a"), (2, "b"), (2, "b")], "k int, v string").write.json(source)
    first = run()
    assert first == Counter({(1, "a"): 1, (2, "b"): 1})
    assert run() == first
    frame([(1, "late copy"), (2, "x"), (3, "c")], "k int, v string").write.mode("append").json(source)
    assert run() == first + Counter({(3, "c"): 1})


def test_append_stream_survives_a_lost_checkpoint(spark, frame, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = frame([(1, "a"), (2, "b")], "k int, v string")
    df.write.json(source)
    for attempt in ("one", "two"):  # everything is delivered again
        append_stream(new_files(spark, source, df.schema), out, ["k"], str(tmp_path / attempt)).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_append_stream_within(spark, frame, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    df = spark.sql("SELECT id AS k, timestamp_seconds(1541105830 + id) AS ts FROM range(5)")
    df.union(df).write.parquet(source)
    stream = new_files(spark, source, df.schema, "parquet")
    append_stream_within(stream, out, ["k"], mark, "ts", "1 hour").awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(df)


def test_latest_stream(spark, frame, tmp_path):
    source, base, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "id int, level string, ts int"
    for batch in ([(1, "free", 1), (1, "paid", 3)], [(1, "free", 2), (2, "free", 1)], [(2, "paid", 9)]):
        df = frame(batch, schema)
        df.write.mode("append").json(source)
        latest_stream(
            new_files(spark, source, df.schema), "stream_levels", base, ["id"], "ts", ["level"], mark
        ).awaitTermination()
    assert rows(spark.table("stream_levels")) == Counter({(1, "paid", 3): 1, (2, "paid", 9): 1})
    spark.sql("DROP TABLE stream_levels")
