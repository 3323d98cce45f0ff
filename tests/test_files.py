"""Readers, writers, layouts and load modes."""

import json
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries import loads
from starmill import schemas
from starmill.operators.dedupe import last_per_key
from starmill.session import scratch_path
from starmill.sinks import tables as sinks
from starmill.sources import files


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def song(i, **changes):
    return {
        "song_id": f"S{i}", "title": f"Title {i}", "artist_id": f"A{i % 2}", "artist_name": f"Name {i % 2}",
        "artist_location": "", "artist_latitude": None, "artist_longitude": 1.5, "duration": 100.25 + i,
        "num_songs": 1, "year": 0, **changes,
    }


@pytest.fixture
def song_tree(tmp_path):
    for i, folder in enumerate(["A/A/A", "A/A/B", "A/B/C"]):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / f"TR{i}.json").write_text(json.dumps(song(i)))
    (tmp_path / "A" / "notes.txt").write_text("not a song")
    return str(tmp_path)


def test_json_tree(spark, song_tree):
    df = files.read_json_tree(spark, song_tree, schemas.RAW_SONGS)
    assert {r["song_id"] for r in df.collect()} == {"S0", "S1", "S2"}
    assert df.filter("artist_location = ''").count() == 3  # JSON keeps empty text
    assert tuple(files.count_files(df).first()) == (3, 3)


def test_csv_tree(spark, tmp_path):
    header = "artist,song,length\n"
    (tmp_path / "2018-11-01-events.csv").write_text(header + '"A ""quoted"" name, with comma",x,1.5\n')
    (tmp_path / "2018-11-02-events.csv").write_text(header + ",y,\n")
    schema = schemas._schema(artist="string", song="string", length="double")
    df = files.read_csv_tree(spark, str(tmp_path), schema)
    assert rows(df) == Counter({('A "quoted" name, with comma', "x", 1.5): 1, (None, "y", None): 1})


def test_documents(spark, tmp_path):
    report = {"safetyreportid": "1", "patient": {"drug": [{"openfda": {"package_ndc": ["1234-5678-90"]}}]}}
    (tmp_path / "a.json").write_text(json.dumps({"meta": 1, "results": [report, {"safetyreportid": "2"}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"results": [{"safetyreportid": "3"}]}, indent=1))
    df = files.read_documents(spark, str(tmp_path), schemas.RAW_REPORT_DOCUMENT)
    assert {r["safetyreportid"] for r in df.collect()} == {"1", "2", "3"}
    assert df.filter("patient IS NULL").count() == 2
    assert "seriousnessdeath" in df.columns  # absent everywhere, still a column


def test_pipe_csv_round_trip(spark, frame, tmp_path):
    data = [(1, 'a|b "quoted" \\ back', "x"), (2, "line\nbreak\r\nend ", None), (3, " spaces ", "long text"), (4, "", "e")]
    df = frame(data, "id int, text string, note string")
    sinks.write_pipe_csv(df, str(tmp_path / "p"))
    back = files.read_pipe_csv(spark, str(tmp_path / "p"), df.schema, {"note": 4}, multi_line=True)
    got = {r["id"]: (r["text"], r["note"]) for r in back.collect()}
    assert got[1] == ('a|b "quoted" \\ back', "x")
    assert got[2] == ("line\nbreak\r\nend ", None)
    assert got[3] == (" spaces ", "long")


def test_slim_csv(spark, frame, tmp_path):
    df = frame([("a,b", 1, "unused")], "artist string, n int, other string")
    sinks.write_slim_csv(df.coalesce(1), str(tmp_path / "s"), ["n", "artist"])
    text = next((tmp_path / "s").glob("*.csv")).read_text()
    assert text == 'n,artist\n1,"a,b"\n'


def test_stage_renders_the_run_date_and_clears_the_target(spark, tmp_path):
    folder = tmp_path / "log" / "2018" / "11"
    folder.mkdir(parents=True)
    (folder / "2018-11-01-events.json").write_text(json.dumps({"page": "Home", "ts": 5, "userId": "7"}))
    template = str(tmp_path / "log") + "/{execution_date.year}/{execution_date.month}"
    mapping = {"kind": "page", "user_id": "userId"}
    for _ in range(2):
        staged = files.stage(
            spark, template, date(2018, 11, 30), schemas.RAW_EVENTS, "json", mapping=mapping, to=str(tmp_path / "st")
        )
    assert rows(staged) == Counter({("Home", "7"): 1})
    with pytest.raises(ValueError, match="unknown format"):
        files.stage(spark, template, date(2018, 11, 30), schemas.RAW_EVENTS, "xml")


def test_partitioned_write_and_typed_read(spark, frame, tmp_path, capsys):
    df = frame([("S1", 2001), ("S2", 2001), ("S3", 0)], "song_id string, year int")
    path = str(tmp_path / "songs")
    sinks.write_table(df, path, partition_by=["year"], sort_by=["song_id"])
    back = files.read_table(spark, path, df.schema)
    assert back.schema["year"].dataType.simpleString() == "int"
    assert rows(back.select("song_id", "year")) == rows(df)
    back.filter("year = 2001").explain()
    assert "PartitionFilters: [isnotnull(year" in capsys.readouterr().out


def test_load_modes(spark, frame, tmp_path):
    df = frame([(1, "a")], "k int, v string")
    path = str(tmp_path / "d")
    sinks.load_dimension(df, path, mode="insert")
    sinks.load_dimension(df, path, mode="insert")
    assert files.read_table(spark, path).count() == 2
    sinks.load_dimension(df, path)
    assert files.read_table(spark, path).count() == 1
    sinks.load_fact(df.select("v", "k"), path, df.schema)
    assert rows(files.read_table(spark, path).select("k", "v")) == Counter({(1, "a"): 2})
    with pytest.raises(KeyError):
        sinks.load_dimension(df, path, mode="replace")


def test_partition_load_touches_only_its_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    october = frame([(1, 2018, 10), (2, 2018, 10)], "k int, year int, month int")
    november = frame([(3, 2018, 11)], "k int, year int, month int")
    late = frame([(4, 2018, 10), (2, 2018, 10), (5, 2018, 12)], "k int, year int, month int")
    for batch in (october, november, october, october.filter("k = 2"), late, late):
        sinks.load_partitions(batch, path, ["k"], ["year", "month"], ["k"])
    got = files.read_table(spark, path, october.schema).select("k", "month")
    assert rows(got) == Counter({(1, 10): 1, (2, 10): 1, (3, 11): 1, (4, 10): 1, (5, 12): 1})


def test_partition_load_completes_new_rows_only(spark, frame, tmp_path):
    path, seen = str(tmp_path / "t"), []

    def complete(new):
        seen.append(new.count())
        return new.withColumn("v", F.concat("k", F.lit("!"))).select("k", "v", "n", "year")

    def load(items):
        batch = frame(items, "k string, n int, year int")
        sinks.load_partitions(
            batch, path, ["k"], ["year"], complete=complete, finish=lambda df: df.withColumn("n", F.col("n") * 10)
        )
        return rows(spark.read.parquet(path).select("k", "v", "n", "year"))

    first = {("a", "a!", 10, 1): 1, (None, None, 20, 1): 1, ("c", "c!", 30, 2): 1}
    assert load([("a", 1, 1), ("a", 4, 1), (None, 2, 1), (None, 3, 1), ("c", 3, 2)]) == first
    late = {("d", "d!", 10, 2): 1, ("e", "e!", 50, None): 1}
    for _ in range(2):
        assert load([("c", 9, 2), ("d", 1, 2), ("d", 2, 2), ("e", 5, None), (None, 7, 1)]) == first | late
    assert seen == [5, 3, 0]


def test_small_and_unique_tables_are_bucketed(spark, frame, tmp_path):
    for n in (1, 25, 100):
        df = spark.range(n).select(F.col("id").alias("report"))
        sinks.write_bucketed(df, "small_b", str(tmp_path / f"small{n}"), ["report"], 4)
        assert spark.table("small_b").count() == n
        spark.sql("DROP TABLE small_b")


def test_null_keys_are_appended_once(spark, frame, tmp_path):
    batch = frame([(None, "a"), (1, "b")], "k int, v string")
    for _ in range(3):
        sinks.append_new(spark, batch, str(tmp_path / "n"), ["k"])
    assert spark.read.parquet(str(tmp_path / "n")).count() == 2


def test_csv_columns_in_another_order_are_an_error(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("song,artist\nx,y\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_csv_tree(spark, str(tmp_path / "c"), T.StructType.fromDDL("artist string, song string")).collect()


def test_append_new_is_idempotent(spark, frame, tmp_path):
    path = str(tmp_path / "a")
    first, second = frame([(1, "x"), (1, "x")], "k int, v string"), frame([(1, "y"), (2, "z")], "k int, v string")
    for batch in (first, second, second, first):
        sinks.append_new(spark, batch, path, ["k"])
    assert rows(spark.read.parquet(path)) == Counter({(1, "x"): 1, (2, "z"): 1})


def test_upsert_into_catalog_table(spark, frame, tmp_path):
    schema = "id int, level string, ts int"
    for batch in ([(1, "free", 1), (2, "free", 1)], [(1, "paid", 2)], [(1, "paid", 2), (2, "paid", 0)]):
        sinks.upsert_latest_into(spark, frame(batch, schema), "levels", str(tmp_path / "l"), ["id"], "ts", ["level"])
    assert rows(spark.table("levels")) == Counter({(1, "paid", 2): 1, (2, "free", 1): 1})
    spark.sql("DROP TABLE levels")


def test_last_write_wins_per_primary_key(spark, frame, tmp_path):
    df = frame([(1, 2, "old", 1), (1, 2, "new", 2), (1, 1, "x", 1)], "s int, i int, v string, w int")
    path = str(tmp_path / "q")
    sinks.upsert_last_write(df, path, ["s"], ["i"], ["w"])
    assert rows(files.read_table(spark, path).select("s", "i", "v")) == Counter({(1, 2, "new"): 1, (1, 1, "x"): 1})


@pytest.mark.parametrize("distinct", [False, True])
def test_last_write_wins_moves_rows_once_unless_a_key_is_hot(spark, tmp_path, monkeypatch, distinct):
    moved_twice, write = [], sinks.write_clustered
    monkeypatch.setattr(sinks, "write_clustered", lambda df, path, *rest: moved_twice.append(path) or write(df, path, *rest))
    even = spark.range(4000).select(
        F.when(F.col("id") % 500 > 0, F.col("id") % 500).alias("s"), (F.col("id") % 2).alias("i"),
        F.col("id").cast("string").alias("v"), F.col("id").alias("w"),
    )
    hot = even.withColumn("s", F.when(F.col("w") % 4 == 0, F.col("s")).otherwise(7))
    for name, df in (("even", even), ("hot", hot)):
        path = str(tmp_path / name)
        expected = {}
        for r in df.collect():
            if (r.s, r.i) not in expected or r.w > expected[r.s, r.i].w:
                expected[r.s, r.i] = r
        sinks.upsert_last_write(df.union(df), path, ["s"], ["i"], ["w"], distinct=distinct)
        found = files.read_table(spark, path)
        assert rows(found) == Counter(tuple(r) for r in expected.values())
    assert moved_twice == [str(tmp_path / "hot")]
    ranged = last_per_key(even.repartitionByRange("s", "i").distinct(), ["s", "i"], ["w"])
    assert ranged._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_raw_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "RAW_ROWS", 100)
    df = spark.range(0, 1000, 1, 2).select(F.col("id").cast("int").alias("n"), F.lit("one, \"two\"").alias("t"))
    loads.raw_files(df).json(str(tmp_path / "j/2018/11"))
    loads.raw_files(df).option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    for name, end in (("j/2018/11", "*.json.gz"), ("c", "*.csv.gz")):
        assert len(list((tmp_path / name).glob(end))) == 10
    assert rows(files.read_json_tree(spark, str(tmp_path / "j"), df.schema)) == rows(df)
    assert rows(files.read_csv_tree(spark, str(tmp_path / "c"), df.schema)) == rows(df)
    staged = files.stage(spark, str(tmp_path / "j/2018"), date(2018, 11, 1), df.schema, "json", to=str(tmp_path / "s"))
    assert rows(staged) == rows(df)


def test_clustered_write_splits_a_hot_key_and_keeps_order(spark, tmp_path):
    df = spark.range(8000).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    path = str(tmp_path / "c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_clustered(df, path, ["k"], ["i"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = [
        (r["lo"], r["hi"], r["n"])
        for r in spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.min("i").alias("lo"), F.max("i").alias("hi"), F.count("i").alias("n"))
        .collect()
    ]
    assert len(spans) == 4
    assert all(hi - lo + 1 == n for lo, hi, n in spans)


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, capsys):
    for name in ("events_b", "reports_b"):
        df = spark.range(200).select(F.col("id").alias("report"), F.lit(name).alias(name))
        sinks.write_bucketed(df, name, str(tmp_path / name), ["report"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("events_b").join(spark.table("reports_b"), "report")
        assert joined.count() == 200
        joined.explain()
        assert "Exchange" not in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("events_b", "reports_b"):
            spark.sql(f"DROP TABLE {name}")


def test_a_hot_key_is_not_bucketed(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("report"))
    with pytest.raises(ValueError, match="too many rows for one bucket"):
        sinks.write_bucketed(df, "hot_b", str(tmp_path / "hot"), ["report"], 4)
    assert not spark.catalog.tableExists("hot_b")


def test_create_and_drop_declared_tables(spark, tmp_path):
    everything = {**schemas.MUSIC_TABLES, **schemas.QUERY_FIRST_TABLES, **schemas.DRUG_TABLES}
    for _ in range(2):
        schemas.create_tables(spark, everything, str(tmp_path))
    for name, table in everything.items():
        assert spark.table(name).count() == 0
        assert set(spark.table(name).columns) == set(table.schema.names)
    schemas.drop_tables(spark, everything)
    assert not any(spark.catalog.tableExists(name) for name in everything)


def test_filters_and_columns_reach_the_scan(spark, frame, tmp_path, capsys):
    path = str(tmp_path / "f")
    sinks.write_table(frame([(1, "a", 2.0)], "k int, page string, v double"), path)
    spark.read.parquet(path).filter("page = 'NextSong'").select("k").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(page,NextSong)" in plan
    assert "ReadSchema: struct<k:int,page:string>" in plan


def test_scratch_folder_is_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_broken_lines_are_errors_or_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"song": "x", "length": 1.5}\n{"song": "y", "len\n{"song": "z"}\n')
    schema = T.StructType.fromDDL("song string, length double")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_json_tree(spark, str(tmp_path / "in"), schema).collect()
    mapping = {"title": "song"}
    staged = files.stage(
        spark, str(tmp_path / "in"), date(2018, 11, 1), schema, "json", mapping=mapping,
        to=str(tmp_path / "staged"), on_bad="keep",
    )
    good, bad = files.split_bad_rows(staged)
    assert sorted(r["title"] for r in good.collect()) == ["x", "z"] and good.columns == ["title"]
    assert [r[files.BAD_ROW] for r in bad.collect()] == ['{"song": "y", "len']
    with pytest.raises(ValueError, match="on_bad"):
        files.read_json_tree(spark, str(tmp_path / "in"), schema, on_bad="drop")


def test_csv_rows_of_another_width_are_errors_or_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("artist,length\nx,1.5\ny,2.5,3\n")
    schema = T.StructType.fromDDL("artist string, length double")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_tree(spark, str(tmp_path), schema).collect()


def test_broken_document_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"results": [{"safetyreportid": "3"}')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_documents(spark, str(tmp_path), schemas.RAW_REPORT_DOCUMENT).collect()
