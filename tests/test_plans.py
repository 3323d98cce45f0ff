"""Whole jobs on small hand-made inputs, run twice."""

import json
import time
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from driver_queries import QUERIES
from starmill.operators import quality
from starmill.plans import drug, music, query_first, scheduled
from starmill.schemas import RAW_EVENTS, RAW_EVENTS_CSV, RAW_LABEL_DOCUMENT, RAW_PRICING, RAW_REPORT_DOCUMENT, RAW_SONGS
from starmill.sources import files


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def song(i, title, artist, duration, **changes):
    return {
        "song_id": f"S{i}", "title": title, "artist_id": f"A-{artist}", "artist_name": artist,
        "artist_location": "", "artist_latitude": None, "artist_longitude": None, "duration": duration,
        "num_songs": 1, "year": 0, **changes,
    }


SONGS = [
    song(1, "Blue", "Ann", 200.5, year=2001),
    song(2, "Blue", "Bob", 180.0, artist_location="Oslo", artist_latitude=59.9),
    song(3, "Blue", "Ann", 200.5),  # the same title, artist and length again
    song(4, "Red", "Ann", 99.25, artist_location=None),
    song(5, "Orphan", None, 10.0, artist_id="A-none"),
]


def event(ts, user, song=None, artist=None, length=None, page="NextSong", level="free", item=0, **changes):
    return {
        "page": page, "ts": ts, "userId": user, "song": song, "artist": artist, "length": length, "level": level,
        "firstName": f"F{user}", "lastName": f"L{user}", "gender": "F", "itemInSession": item, "sessionId": 9,
        "location": "X", "userAgent": "ua", "auth": "in", "method": "PUT", "status": 200, "registration": 1.5e12,
        **changes,
    }


NOV = 1541105830796
EVENTS = [
    event(NOV, "8", "Blue", "Ann", 200.5, item=1),
    event(NOV + 1000, "8", "Blue", "Bob", 180.0, level="paid", item=2),
    event(NOV + 2000, "10", "Blue", "Nobody", 1.0, item=3),
    event(NOV + 3000, "10", "Unknown", "Ann", 99.25, item=4),
    event(NOV + 4000, "10", page="Home", level="paid"),
    event(NOV + 5000, "", page="Home"),
]


@pytest.fixture
def raw(spark, tmp_path):
    def read(items, schema, name):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.json").write_text("\n".join(json.dumps(i) for i in items))
        return files.read_json_tree(spark, str(folder), schema)

    return read(EVENTS, RAW_EVENTS, "log"), read(SONGS, RAW_SONGS, "songs")


@pytest.fixture
def plays(raw):
    return music.plays_of(music.normalise_events(raw[0]))


def test_normalised_events(raw):
    events = music.normalise_events(raw[0])
    assert events.filter("user_id IS NULL").count() == 1
    first = events.orderBy("start_time").first()
    assert first["start_time"] == datetime(2018, 11, 1, 20, 57, 10, 796000)
    assert music.plays_of(events).count() == 4


def test_catalogue(raw):
    songs, artists = music.build_catalogue(raw[1])
    assert songs.count() == 5
    got = {r["artist_id"]: r for r in artists.collect()}
    assert set(got) == {"A-Ann", "A-Bob"}  # an artist needs a name
    assert got["A-Ann"]["location"] == "N/A" and got["A-Ann"]["latitude"] == 0.0
    assert got["A-Bob"]["location"] == "Oslo" and got["A-Bob"]["latitude"] == 59.9
    assert music.artists_distinct(raw[1], impute=False).count() == 4


def test_users(raw, plays):
    got = {r["user_id"]: r["level"] for r in music.build_users(plays).collect()}
    assert got == {8: "paid", 10: "free"}
    assert music.users_distinct(music.normalise_events(raw[0])).count() == 3
    assert music.users_distinct(music.normalise_events(raw[0]), page=None).count() == 4


def test_first_match_never_repeats_a_play(raw, plays):
    got = music.fact_first_match(plays, *music.build_catalogue(raw[1]))
    assert [(r["item_in_session"], r["song_id"]) for r in got.orderBy("item_in_session").collect()] == [
        (1, "S1"), (2, "S2"), (3, None), (4, None),
    ]


def test_title_join_fans_out(raw, plays):
    got = music.fact_inner_title(plays, raw[1], ["start_time", "user_id"])
    assert got.count() == 9  # three plays of "Blue", three songs called so


def test_three_key_join(raw, plays):
    got = music.fact_three_key(plays, raw[1])
    assert Counter(r["song_id"] for r in got.collect()) == Counter({"S1": 1, "S3": 1, "S2": 1})


def test_length_can_be_compared_in_whole_seconds(raw, plays):
    longer = plays.withColumn("length", F.col("length") + 0.25)
    assert music.fact_three_key(longer, raw[1]).count() == 0
    assert music.fact_three_key(longer.filter("artist = 'Bob'"), raw[1], scale=0).count() == 1


def test_left_chain(raw, plays):
    got = music.fact_left_chain(
        plays, music.songs_distinct(raw[1]), music.artists_distinct(raw[1]), ["item_in_session"]
    ).collect()
    by_item = {}
    for r in got:
        by_item.setdefault(r["item_in_session"], set()).add((r["song_id"], r["artist_id"]))
    assert by_item[1] == {("S1", "A-Ann"), ("S2", "A-Ann"), ("S3", "A-Ann")}  # the name match wins
    assert by_item[3] == {("S1", "A-Ann"), ("S2", "A-Bob"), ("S3", "A-Ann")}  # no name match: the song's artist
    assert by_item[4] == {(None, "A-Ann")}


def test_star_join(raw):
    star = music.build_star(music.normalise_events(raw[0]), raw[1])
    joined = music.join_all(star)
    assert rows(joined.select("title", "name", "first_name", "weekday")) == Counter(
        {("Blue", "Ann", "F8", 3): 1, ("Blue", "Bob", "F8", 3): 1}
    )


def write_lines(folder, name, items):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(i) for i in items))


def test_scheduled_run_twice(spark, tmp_path):
    log, songs, house = tmp_path / "log", tmp_path / "song_data", str(tmp_path / "house")
    write_lines(log / "2018" / "11", "2018-11-01-events.json", EVENTS)
    for s in SONGS[:4]:
        write_lines(songs / "A" / s["song_id"], "TR.json", [s])
    spark.sql("CREATE DATABASE IF NOT EXISTS star_test")
    template = str(log) + "/{execution_date.year}/{execution_date.month}"

    def run(day):
        star = scheduled.run(spark, day, template, str(songs), house, database="star_test")
        return {name: rows(df.select(*sorted(df.columns))) for name, df in star.items()}

    first = run(date(2018, 11, 1))
    assert {name: sum(r.values()) for name, r in first.items()} == {
        "songs": 4, "artists": 2, "users": 2, "time": 4, "songplays": 4,
    }
    assert run(date(2018, 11, 1)) == first

    december = event(NOV + 35 * 86400000, "10", "Red", "Ann", 99.25, level="paid")
    write_lines(log / "2018" / "12", "2018-12-01-events.json", [december])
    second = run(date(2018, 12, 1))
    assert sum(second["songplays"].values()) == 5 and sum(second["time"].values()) == 5
    by_weekday = spark.sql("""
        SELECT t.weekday, count(p.songplay_id) AS n FROM star_test.songplays p
        LEFT JOIN star_test.time t ON p.start_time = t.start_time GROUP BY t.weekday ORDER BY t.weekday""")
    assert [tuple(r) for r in by_weekday.collect()] == [(3, 5)]
    levels = {r["user_id"]: r["level"] for r in spark.table("star_test.users").collect()}
    assert levels == {8: "paid", 10: "paid"}
    spark.sql("DROP DATABASE star_test CASCADE")


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return {f for f in files.split() if f.endswith(".data") and "/shuffle_" in f}


def gone(spark, before):
    """Whether the shuffle files that came since go, which happens in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


def test_scheduled_load_report_leaves_no_shuffles(spark, tmp_path):
    parts = [(i, f"name {i}", "Brand#11", "TYPE", 40, 900.5 + i) for i in range(1, 4)]
    spark.createDataFrame(
        parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ).write.parquet(f"{tmp_path}/part.parquet")
    lines = [
        (1, 1, 10, 1, 5.0, 0.0, 0.0, "N", "O", datetime(2000, 1, 1)), (1, 2, 11, 2, 6.0, 0.0, 0.1, "R", "F", datetime(2000, 1, 2)),
        (2, 2, 11, 1, 7.0, 0.1, 0.0, "A", "O", datetime(2000, 2, 1)), (2, 2, 11, 1, 7.0, 0.1, 0.0, "A", "O", datetime(2000, 2, 1)),
        (3, 3, None, 1, 8.0, 0.1, 0.0, "A", "O", datetime(2000, 2, 2)), (4, 9, 12, 1, 8.0, 0.1, 0.0, "A", "O", datetime(2000, 2, 2)),
    ]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = shuffle_files(spark)
    report = rows(QUERIES["scheduled_load_report"](spark, str(tmp_path)))
    assert gone(spark, before)
    first = {("songs", 3, 3), ("artists", 3, 1), ("users", 5, 1), ("time", 5, 3), ("songplays", 5, 2)}
    again = {(name, n, 1 if name == "users" else 0) for name, n, _ in first}
    assert report == Counter([(1, *r) for r in first] + [(2, *r) for r in again])


def test_scheduled_run_leaves_no_shuffles_and_joins_new_plays_only(spark, tmp_path, monkeypatch):
    log, songs, house = tmp_path / "log", tmp_path / "songs", str(tmp_path / "house")
    twice = [event(NOV, "8", "Blue", "Ann", 200.5, item=0), event(NOV, "8", "None", item=5), event(NOV, "8", item=6)]
    write_lines(log, "e.json", EVENTS + twice)
    write_lines(songs, "s.json", SONGS[:4])
    joined = []
    complete = music.complete_plays
    monkeypatch.setattr(music, "complete_plays", lambda new, *them: joined.append(new.count()) or complete(new, *them))
    spark.sql("CREATE DATABASE star_lean")

    def run():
        return rows(scheduled.run(spark, date(2018, 11, 1), str(log), str(songs), house, "star_lean")["songplays"])

    before = shuffle_files(spark)
    first = run()
    assert gone(spark, before)
    assert run() == first
    # a title that is missing has the same key as one called None
    assert joined == [6, 0] and sum(first.values()) == 5
    events = spark.createDataFrame([{f: e[f] for f in RAW_EVENTS.names} for e in EVENTS + twice], RAW_EVENTS)
    catalogue = spark.createDataFrame(SONGS[:4], RAW_SONGS)
    fact = music.build_star(music.normalise_events(events), catalogue)["songplays"].filter("song_id IS NOT NULL")
    assert rows(fact.select(*scheduled.MUSIC_TABLES["songplays"].schema.names)) <= first
    spark.sql("DROP DATABASE star_lean CASCADE")


def test_scheduled_run_raises_on_bad_data(spark, tmp_path):
    log, songs = tmp_path / "log", tmp_path / "songs"
    write_lines(log, "e.json", [event(NOV, "8", "Blue", "Ann", 1.0, gender=None)])
    write_lines(songs, "s.json", SONGS[:1])
    spark.sql("CREATE DATABASE IF NOT EXISTS star_bad")
    with pytest.raises(quality.QualityError, match="songplays.foreign_key_user_id"):
        scheduled.run(spark, date(2018, 11, 1), str(log), str(songs), str(tmp_path / "h"), database="star_bad")
    spark.sql("DROP DATABASE star_bad CASCADE")


# --- query-first tables --------------------------------------------------------------------


def test_query_first_tables(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    names = RAW_EVENTS_CSV.names

    def line(**values):
        return ",".join(str(values.get(n, "")) for n in names)

    plays = [
        line(artist="Faithless", song="Music Matters", length=495.3073, sessionId=338, itemInSession=4, userId=50,
             firstName="Ann", lastName="Lee", ts="1.54111E+12"),
        *[
            line(artist="Down", song="Keep On", length=1.5, sessionId=182, itemInSession=item, userId=10,
                 firstName="Sylvie", lastName="Cruz")
            for item in (1, 0)
        ],
        line(sessionId=1, itemInSession=0),
    ]
    (folder / "2018-11-01-events.csv").write_text("\n".join([",".join(names), *plays]) + "\n")
    slim = query_first.slim_events(files.read_csv_tree(spark, str(folder), RAW_EVENTS_CSV))
    assert slim.count() == 3 and len(slim.columns) == 11
    base = str(tmp_path / "tables")
    query_first.load_query_tables(slim, base)
    read = {n: files.read_table(spark, f"{base}/{n}") for n in query_first.PARTITION_KEYS}
    assert rows(query_first.item_of_session(read["session_songs"], 338, 4)) == Counter(
        {("Faithless", "Music Matters", 495.3073): 1}
    )
    heard = query_first.songs_of_session(read["user_sessions"], 10, 182).collect()
    assert [tuple(r) for r in heard] == [("Down", "Keep On", "Sylvie", "Cruz")] * 2
    assert rows(query_first.listeners_of(read["song_users"], "Keep On")) == Counter({("Sylvie", "Cruz"): 1})


# --- drug warehouse ------------------------------------------------------------------------


def drug_entry(*codes, fda=True):
    return {"openfda": {"package_ndc": list(codes)}} if fda else {"medicinalproduct": "x"}


REPORTS = [
    {
        "safetyreportid": "1", "receivedate": "20180131", "receiptdate": "bad", "seriousnessdeath": "1",
        "seriousnessdisabling": "2",
        "patient": {
            "patientdeath": {"patientdeathdate": "20180130"},
            "drug": [drug_entry("1234-5678-90", "bad"), drug_entry("1234-5678-90"), drug_entry(), drug_entry(fda=False)],
            "reaction": [{"reactionmeddrapt": "Nausea"}, {"reactionmeddrapt": "Rash"}, {"reactionoutcome": "1"}],
        },
    },
    {"safetyreportid": "2", "receivedate": "20180228", "patient": {"drug": [drug_entry("12345-678-90")]}},
    {
        "safetyreportid": "3", "receivedate": "20180201",
        "patient": {"drug": [drug_entry("1234-5678-90")], "reaction": [{"reactionmeddrapt": "Rash"}]},
    },
]

LABELS = [
    {
        "warnings": ["Be", "careful"],
        "openfda": {
            "package_ndc": ["1234-5678-90", "12345-6789-01"], "brand_name": ["Aspirin"], "generic_name": ["ASA"],
        },
    },
    {"warnings": ["none"]},
]

PRICES = [
    {"ndc": "01234567890", "as_of_date": "2018-01-03T00:00:00.000", "nadac_per_unit": 0.5},
    {"ndc": "01234567890", "as_of_date": "2018-01-10T00:00:00.000", "nadac_per_unit": 0.75},
    {"ndc": "99999999999", "as_of_date": "2018-01-10T00:00:00.000", "nadac_per_unit": 2.0},
]


@pytest.fixture
def drug_inputs(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "l.json").write_text(json.dumps({"results": LABELS}))
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "a.json").write_text(json.dumps({"results": REPORTS}, indent=2))
    (tmp_path / "events" / "b.json").write_text(json.dumps({"results": REPORTS[1:2]}))  # a report again
    (tmp_path / "pricing.json").write_text("\n".join(json.dumps(p) for p in PRICES))
    return (
        files.read_documents(spark, str(tmp_path / "labels"), RAW_LABEL_DOCUMENT),
        files.read_documents(spark, str(tmp_path / "events"), RAW_REPORT_DOCUMENT),
        spark.read.schema(RAW_PRICING).json(str(tmp_path / "pricing.json")),
    )


def test_drug_tables(drug_inputs):
    w = drug.build_warehouse(*drug_inputs)
    assert rows(w["drug_events"].select("safetyreportid", "package_ndc", "formatted_ndc")) == Counter({
        ("1", "1234-5678-90", "01234567890"): 1,
        ("2", "12345-678-90", "12345067890"): 1,
        ("3", "1234-5678-90", "01234567890"): 1,
    })
    assert rows(w["reactions"]) == Counter({("Nausea", "1"): 1, ("Rash", "1"): 1, ("Rash", "3"): 1})
    header = w["safety_reports"].filter("safetyreportid = '1'").first().asDict()
    assert header["patientdeath"] is True and header["receivedate"] == date(2018, 1, 31)
    assert header["receiptdate"] is None
    assert (header["seriousnessdeath"], header["seriousnessdisabling"]) == (True, False)
    assert header["seriousnesshospitalization"] is None
    assert w["safety_reports"].count() == 3  # the repeated report counts once
    assert rows(w["labels"].select("formatted_ndc", "brand_name", "warnings")) == Counter({
        ("01234567890", "Aspirin", "Be careful"): 1, (None, "Aspirin", "Be careful"): 1, (None, None, "none"): 1,
    })
    assert rows(w["ndc"]) == Counter({("01234567890",): 1, ("99999999999",): 1})
    assert drug.build_pricing(drug_inputs[2], latest_only=True).count() == 2


def test_drug_queries(drug_inputs):
    w = drug.build_warehouse(*drug_inputs)
    bridge = drug.bridge_join(w["ndc"], w["drug_events"], w["pricing"], w["labels"]).collect()
    assert [(r["ndc"], r["n_events"], r["n_prices"], r["latest_price"], r["brand_name"]) for r in bridge] == [
        ("01234567890", 2, 2, 0.75, "Aspirin")
    ]
    report = drug.report_join(w["safety_reports"], w["drug_events"], w["reactions"])
    assert rows(report.select("safetyreportid", "n_drugs", "n_reactions")) == Counter({("1", 1, 2): 1, ("3", 1, 1): 1})
    trend = drug.reaction_trend(w["drug_events"], w["reactions"], w["safety_reports"], w["labels"])
    assert rows(trend.select("brand_name", "reactionmeddrapt", "period", "n")) == Counter({
        ("Aspirin", "Nausea", date(2018, 1, 1), 1): 1,
        ("Aspirin", "Rash", date(2018, 1, 1), 1): 1,
        ("Aspirin", "Rash", date(2018, 2, 1), 1): 1,
    })
    profile = drug.drug_profile(w["labels"], w["pricing"], w["drug_events"], w["reactions"])
    assert rows(profile.filter("ndc = '01234567890'").select("section", "entry", "n")) == Counter({
        ("brand", "Aspirin", 1): 1, ("price_year", "2018", 2): 1, ("reaction", "Nausea", 1): 1, ("reaction", "Rash", 2): 1,
    })


def test_drug_details_and_rejected_reports(spark, drug_inputs):
    w = drug.build_warehouse(*drug_inputs)
    details = drug.drug_details(w["labels"], w["pricing"], w["drug_events"], w["safety_reports"])
    own = details.filter("ndc = '01234567890'")
    assert rows(own.filter("section = 'warnings'").select("entry", "dated", "amount")) == Counter({("Be careful", None, None): 1})
    assert own.filter("section = 'price'").count() == 2
    assert rows(own.filter("section = 'event'").select("entry")) == Counter({("1",): 1, ("3",): 1})

    schema = "safetyreportid string, receiptdate string, patient struct<reaction: array<struct<reactionmeddrapt: string>>>"
    rash = ([("Rash",)],)
    reports = spark.createDataFrame(
        [("1", "20180101", rash), ("1", "20180101", rash), ("2", "20180101", rash), ("2", "20180201", ([],)),
         ("3", "20180101", ([("",), (None,)],)), ("4", None, None), (None, "20180101", rash), ("5", "20180101", rash)],
        schema,
    )
    assert rows(drug.rejected_reports(reports)) == Counter({
        ("1", "repeated_report", 1): 1, ("2", "repeated_report", 1): 1, ("2", "missing_reactions", 1): 1,
        ("3", "missing_reactions", 1): 1, ("4", "missing_reactions", 1): 1, (None, "missing_id", 1): 1,
    })


def test_drug_warehouse_written_and_updated(spark, drug_inputs, tmp_path):
    house, database = str(tmp_path / "house"), "drug_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for _ in range(2):  # a first load can be repeated
        tables = scheduled.run_drug_warehouse(spark, *drug_inputs, house, database)
    assert sorted(r["drug_event_id"] for r in tables["drug_events"].collect()) == [1, 2, 3]
    assert sorted(r["labels_id"] for r in tables["labels"].collect()) == [1, 2, 3]
    assert sorted(r["pricing_id"] for r in tables["pricing"].collect()) == [1, 2, 3]
    assert tables["drug_events"].filter("formatted_ndc IS NULL").count() == 0

    newer = [{"ndc": f"0000000000{i}", "as_of_date": "2018-01-17T00:00:00.000", "nadac_per_unit": 1.0} for i in (1, 2)]
    (tmp_path / "new.json").write_text("\n".join(json.dumps(p) for p in PRICES + newer))
    raw = spark.read.schema(RAW_PRICING).json(str(tmp_path / "new.json"))
    for _ in range(2):  # the same snapshot again adds nothing
        pricing = scheduled.update_pricing(spark, raw, house, database)
        assert sorted(r["pricing_id"] for r in pricing.collect()) == [1, 2, 3, 4, 5]
    assert spark.table(f"{database}.ndc").count() == 4
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_plays_meet_the_growing_dimensions_first(spark, frame, monkeypatch):
    order, join = [], music.lookup_join
    monkeypatch.setattr(music, "lookup_join", lambda fact, dim, on, **more: order.append(on) or join(fact, dim, on, **more))
    star = {
        "songplays": frame([("p", 5, 1, "s", "a")], "songplay_id string, start_time int, user_id int, song_id string, artist_id string"),
        "users": frame([(1, "x", "y", "F")], "user_id int, first_name string, last_name string, gender string"),
        "songs": frame([("s", "t", 1.5, 0)], "song_id string, title string, duration double, year int"),
        "artists": frame([("a", "n", "l")], "artist_id string, name string, location string"),
        "time": frame([(5, 1, 2, 3, 4)], "start_time int, hour int, day int, week int, weekday int"),
    }
    found = music.join_all(star).select("songplay_id", "title", "name", "first_name", "hour", "weekday").collect()
    assert [tuple(r) for r in found] == [("p", "t", "n", "x", 1, 4)]
    assert order == [["start_time"], ["song_id"], ["artist_id"], ["user_id"]]
