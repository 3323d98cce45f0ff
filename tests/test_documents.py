"""Nested documents to flat tables, and drifting JSON without loss."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.relational import relational
from starmill.session import scratch_path
from starmill.sources import drift


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


NESTED = (
    "id int, a struct<b:struct<c:int, d:array<int>>, e:string>, "
    "xs array<struct<n:int, inner:struct<ys:array<struct<z:string, zs:array<array<int>>>>>>>, m map<string,int>"
)


def test_every_depth_becomes_a_table(frame):
    rows = [
        (1, ((10, [5, 6]), "x"), [(1, ([("p", [[1, 2], [3]]), ("q", None)],)), (2, None), None], {"k": 7}),
        (2, None, [], None),
        (3, ((None, []), None), None, {}),
    ]
    tables = relational(frame(rows, NESTED), ["id"], "t")
    assert sorted(tables) == ["t", "t.a.b.d", "t.m", "t.xs", "t.xs.inner.ys", "t.xs.inner.ys.zs", "t.xs.inner.ys.zs.value"]
    assert tables["t"].columns == ["id", "a.b.c", "a.e"]
    assert rows_of(tables["t"]) == [(1, 10, "x"), (2, None, None), (3, None, None)]
    assert rows_of(tables["t.a.b.d"]) == [(1, 0, 5), (1, 1, 6)]
    assert tables["t.xs"].columns == ["id", "xs#", "n"]
    assert rows_of(tables["t.xs"]) == [(1, 0, 1), (1, 1, 2), (1, 2, None)]  # a NULL element keeps its place
    assert rows_of(tables["t.xs.inner.ys"]) == [(1, 0, 0, "p"), (1, 0, 1, "q")]
    inner = tables["t.xs.inner.ys.zs.value"]
    assert rows_of(inner) == [(1, 0, 0, 0, 0, 1), (1, 0, 0, 0, 1, 2), (1, 0, 0, 1, 0, 3)]
    assert len(set(inner.columns)) == len(inner.columns)
    assert rows_of(tables["t.m"]) == [(1, 0, "k", 7)]


def test_tables_are_projections_that_read_only_their_columns(spark, frame):
    path = scratch_path(spark, "nested")
    frame([(1, ((10, [5]), "x"), [], {"k": 7})], NESTED).write.parquet(path)
    plan = relational(spark.read.parquet(path), ["id"])["root.a.b.d"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "xs" not in plan.split("ReadSchema")[1]


def test_clashing_names_are_refused(frame):
    with pytest.raises(ValueError, match="a.b"):
        relational(frame([(1, (2,), 3)], "id int, a struct<b:int>, `a.b` int"), ["id"])
    with pytest.raises(ValueError, match="key"):
        relational(frame([(1, [(2,)])], "id int, xs array<struct<id:int>>"), ["id"])


DECLARED = (
    T.StructType().add("id", "long").add("name", "string").add("ok", "boolean").add("tags", T.ArrayType(T.StringType()))
    .add("at", T.StructType().add("lat", "double").add("place", T.StructType().add("city", "string")))
)
FILES = {
    "a": [
        '{"id":1,"name":"x","ok":true,"tags":["t"],"at":{"lat":1.5,"place":{"city":"Oslo"}}}',
        '{"id":2,"name":null,"at":{"lat":2,"alt":3,"place":{"city":"Rome","zip":[1,2]}},"new":{"q":[1]}}',
    ],
    "b": ['{"id":"two","at":7,"tags":"t","we.ird":1}', "not json", "[1]", "", '{"ok":"maybe","at":{"lat":"far"}}'],
    "c": ["{}"],
}


@pytest.fixture
def lines(spark, tmp_path):
    for name, rows in FILES.items():
        (tmp_path / f"{name}.json").write_text("\n".join(rows) + "\n")
    return drift.read_lines(spark, str(tmp_path))


def flat(value, prefix=""):
    """Every declared or undeclared leaf of a document, as the staging names it."""
    names = {"": DECLARED, "at.": DECLARED["at"].dataType, "at.place.": DECLARED["at"].dataType["place"].dataType}
    for key, inner in value.items():
        path = prefix + key
        if isinstance(inner, dict) and path + "." in names and key in names[prefix].names:
            yield from flat(inner, path + ".")
        else:
            yield path, inner


def test_no_field_of_an_input_is_lost(lines):
    staged = drift.stage_drifting(lines, DECLARED)
    assert staged.columns == ["id", "name", "ok", "tags", "at.lat", "at.place.city", "_rest", "_bad_line"]
    whole, broken = [], []
    for row in staged.collect():
        values = row.asDict()
        rest, bad = values.pop("_rest") or {}, values.pop("_bad_line")
        if bad is not None:
            assert not rest and not any(v is not None for v in values.values())
            broken.append(bad)
        else:
            found = {k: v for k, v in values.items() if v is not None} | {k: json.loads(v) for k, v in rest.items()}
            whole.append(found)
    documents = [json.loads(line) for rows in FILES.values() for line in rows if line.startswith("{")]
    want = [{k: v for k, v in flat(d) if v is not None} for d in documents]
    by_text = lambda d: sorted(f"{k}={v if not isinstance(v, int) or isinstance(v, bool) else float(v)}" for k, v in d.items())
    assert sorted(map(by_text, want)) == sorted(map(by_text, whole))
    assert sorted(broken) == ["", "[1]", "not json"]


def test_report_per_file(lines):
    name = F.regexp_extract(drift.FILE, "([^/]*)[.]json$", 1)
    found = {tuple(r) for r in drift.drift_report(lines, DECLARED, name).collect()}
    assert found == {
        ("a", "new", "at.alt", "number", 1), ("a", "new", "at.place.zip", "array", 1), ("a", "new", "new", "object", 1),
        ("b", "retyped", "id", "string", 1), ("b", "retyped", "at", "number", 1), ("b", "retyped", "tags", "string", 1),
        ("b", "retyped", "ok", "string", 1), ("b", "retyped", "at.lat", "string", 1), ("b", "new", "we.ird", "number", 1),
        ("b", "skipped", None, None, 3), ("b", "absent", "name", None, 2), ("b", "absent", "at.place", None, 2),
        ("b", "absent", "at.place.city", None, 2),
        *[("c", "absent", n, None, 1) for n in ("id", "name", "ok", "tags", "at", "at.lat", "at.place", "at.place.city")],
    }


def test_no_files_give_no_rows(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    lines = drift.read_lines(spark, str(tmp_path))
    assert drift.stage_drifting(lines, DECLARED).count() == drift.drift_report(lines, DECLARED).count() == 0
