"""Scalar expressions against plain Python."""

import hashlib
import re
import uuid
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.functions import clean, keys, nested, timeparts
from starmill.functions.ndc import format_ndc, is_ndc


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_format_ndc_cases(frame):
    cases = {
        "1234-5678-90": "01234567890",
        "12345-678-90": "12345067890",
        "12345-6789-0": "12345678900",
        "12345-6789-01": None,
        "1234567890": None,
        "1234-5678-9a": None,
        " 1234-5678-90": None,
        "": None,
        "x": None,
        None: None,
    }
    df = frame([(k,) for k in cases], "code string")
    got = {r[0]: r[1] for r in df.select("code", format_ndc(F.col("code"))).collect()}
    assert got == cases


def brute_ndc(code):
    m = re.fullmatch(r"([0-9]+)-([0-9]+)-([0-9]+)", code)
    if not m or tuple(map(len, m.groups())) not in {(4, 4, 2), (5, 3, 2), (5, 4, 1)}:
        return None
    a, b, c = m.groups()
    return a.zfill(5) + b.zfill(4) + c.zfill(2)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"[0-9]{3,5}-[0-9]{3,4}-[0-9a]{1,2}", fullmatch=True), min_size=20, max_size=60))
def test_format_ndc_random(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    for code, formatted, valid in df.select("code", format_ndc(F.col("code")), is_ndc(F.col("code"))).collect():
        assert formatted == brute_ndc(code)
        assert valid == (formatted is not None)


def test_uuid5_equals_library(frame):
    names = ["", "a", "Música ñ", "x" * 500] + [f"song {i}" for i in range(60)]
    df = frame([(n,) for n in names], "name string")
    for name, key in df.select("name", keys.uuid5_nil(F.col("name"))).collect():
        assert key == str(uuid.uuid5(uuid.UUID(int=0), name))


def test_play_uuid_texts(frame):
    rows = [
        ("Song", datetime(2018, 11, 1, 21, 1, 46, 796000), "8"),
        ("Song", datetime(2018, 11, 1, 21, 1, 46), "8"),
        (None, datetime(2018, 11, 1), None),
    ]
    df = frame(rows, "song string, ts timestamp_ntz, user string")
    args = (F.col("song"), F.col("ts"), F.col("user"))
    got = [tuple(r) for r in df.select(keys.play_uuid(*args), keys.play_uuid(*args, six_digit_text=True)).collect()]

    def key(text):
        return str(uuid.uuid5(uuid.UUID(int=0), text))

    assert got == [
        (key("Song2018-11-01 21:01:46.7968"), key("Song2018-11-01 21:01:46.7960008")),
        (key("Song2018-11-01 21:01:468"), key("Song2018-11-01 21:01:468")),
        (key("2018-11-01 00:00:00"), key("None2018-11-01 00:00:00None")),
    ]


def test_play_md5(frame):
    rows = [("S1", datetime(2018, 11, 1, 0, 0, 1), 5), ("S1", datetime(2018, 11, 1, 0, 0, 1), None), (None, None, 1)]
    df = frame(rows, "song string, ts timestamp_ntz, user int")
    got = [r[0] for r in df.select(keys.play_md5(F.col("song"), F.col("ts"), F.col("user"))).collect()]
    text = "S12018-11-01 00:00:01"
    assert got == [hashlib.md5((text + end).encode()).hexdigest() for end in ("5", "-9999")] + [None]


def test_epoch(frame):
    df = frame([(1541105830796,), (-1,), (None,)], "ms bigint")
    got = [
        tuple(r)
        for r in df.select(
            timeparts.epoch_millis(F.col("ms")),
            timeparts.epoch_seconds(F.col("ms")),
            timeparts.to_epoch_millis(timeparts.epoch_millis(F.col("ms"))),
        ).collect()
    ]
    assert got[0] == (datetime(2018, 11, 1, 20, 57, 10, 796000), datetime(2018, 11, 1, 20, 57, 10), 1541105830796)
    assert got[1][2] == -1
    assert got[2] == (None, None, None)


def test_epoch_does_not_depend_on_session_zone(spark, frame):
    df = frame([(1541105830796,)], "ms bigint")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(df, timeparts.epoch_millis(F.col("ms"))) == datetime(2018, 11, 1, 20, 57, 10, 796000)
        assert one(df, timeparts.epoch_seconds(F.col("ms"))) == datetime(2018, 11, 1, 20, 57, 10)
        assert one(df, timeparts.to_epoch_millis(timeparts.epoch_millis(F.col("ms")))) == 1541105830796
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weekday_conventions(frame):
    df = frame([(date(2018, 11, 4),), (date(2018, 11, 5),)], "d date")  # Sunday, Monday
    got = [
        tuple(r)
        for r in df.select(*[timeparts.weekday(F.col("d"), c) for c in ("monday0", "sunday0", "sunday1")]).collect()
    ]
    assert got == [(6, 0, 1), (0, 1, 2)]


def test_time_parts_use_the_hour_of_the_time(frame):
    df = frame([(datetime(2018, 12, 31, 23, 5),)], "ts timestamp_ntz")
    assert tuple(df.select(*timeparts.time_parts(F.col("ts"))).first()) == (23, 31, 1, 12, 2018, 0)


def test_cleaning(frame):
    df = frame([(None, "x", "20180131"), ("", "12", "2018-01-31"), ("a", None, "20181350")], "t string, n string, d string")
    got = [
        tuple(r)
        for r in df.select(
            clean.text_or_default(F.col("t")),
            clean.or_default(F.col("t"), "d"),
            clean.safe_cast(F.col("n"), "int"),
            clean.parse_date(F.col("d")),
            clean.parse_timestamp(F.col("d")),
        ).collect()
    ]
    assert got == [
        ("N/A", "d", None, date(2018, 1, 31), None),
        ("N/A", "", 12, None, datetime(2018, 1, 31)),
        ("a", "a", None, None, None),
    ]


def test_fit_widths(frame):
    df = frame([("abcdef", "ñandú", None)], "a string, b string, c string")
    assert tuple(clean.fit_widths(df, {"a": 3, "b": 4, "c": 1, "absent": 1}).first()) == ("abc", "ñand", None)


def test_nested(frame):
    df = frame(
        [(1, ("x", ("y",)), [("p",), ("q",)], ["v", "w"]), (2, None, [], []), (3, None, None, None)],
        "id int, s struct<a: string, t: struct<b: string>>, r array<struct<c: string>>, v array<string>",
    )
    flat = nested.flatten_one_level(df)
    assert flat.columns == ["id", "s_a", "s_t", "r", "v"]
    assert [tuple(r) for r in nested.pick_paths(df, {"i": "id", "b": "s.t.b"}).collect()] == [(1, "y"), (2, None), (3, None)]
    assert [tuple(r) for r in nested.explode_structs(df, "r", ["id"]).collect()] == [(1, "p"), (1, "q")]
    assert [tuple(r) for r in nested.explode_values(df, "v", "x", ["id"]).collect()] == [
        (1, "v"), (1, "w"), (2, None), (3, None),
    ]
