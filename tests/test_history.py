"""Validity intervals against a plain walk over the snapshots."""

import random

import pytest
from pyspark.sql import functions as F

from starmill.operators import history

SCHEMA = "code string, day int, price double, note string"


def plain(rows):
    """code, price, note, from, to by walking each code's snapshots in order."""
    days = sorted({r[1] for r in rows if r[1] is not None})
    following = dict(zip(days, [*days[1:], None], strict=True))
    seen = {}
    for code, day, price, note in rows:
        if day is not None:
            state = (price is not None, price or 0, note is not None, note or "", price, note)
            seen[code, day] = max(seen.get((code, day), state), state)
    out = []
    for code in {c for c, _ in seen}:
        run = None
        for day in days:
            state = seen.get((code, day))
            if run and state != run[1]:
                out.append((code, *run[1][4:], run[0], day))
                run = None
            if state and not run:
                run = (day, state)
        if run:
            out.append((code, *run[1][4:], run[0], following[days[-1]]))
    return sorted(out, key=str)


def sample(seed, codes=12, days=60):
    rng = random.Random(seed)
    rows = []
    for day in rng.sample(range(1000), days):
        for code in [None, *map(str, range(codes))]:
            if rng.random() < 0.7:
                rows.append((code, day, rng.choice([1.0, 1.0, 2.0, None]), rng.choice(["x", None])))
                if rng.random() < 0.1:
                    rows.append((code, day, 3.0, "y"))
    return rows + [("0", None, 1.0, "x")]


@pytest.mark.parametrize("stretch", [1, 3, 1024])
def test_intervals_equal_a_plain_walk(frame, monkeypatch, stretch):
    monkeypatch.setattr(history, "STRETCH", stretch)
    rows = sample(stretch)
    found = history.validity(frame(rows, SCHEMA), ["code"], "day", ["price", "note"]).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows)


def test_state_at_any_date_and_changes_between_two(frame):
    rows = sample(7)
    intervals = history.validity(frame(rows, SCHEMA), ["code"], "day", ["price", "note"])
    walked = plain(rows)
    days = sorted({r[1] for r in rows if r[1] is not None})

    def held(day):
        return {c: (p, n) for c, p, n, a, b in walked if a <= day and (b is None or b > day)}

    for day in (days[0] - 1, days[5], days[30] + 1, days[-1] + 5):
        got = history.as_of(intervals, F.lit(day), "valid_from", "valid_to").collect()
        assert {r.code: (r.price, r.note) for r in got} == held(day) and len(got) == len(held(day))
    old, new = days[10], days[40]
    found = history.changes(intervals, ["code"], ["price", "note"], F.lit(old), F.lit(new)).collect()
    a, b = held(old), held(new)
    want = {c: "insert" if c not in a else "close" if c not in b else "change" for c in a.keys() | b.keys() if a.get(c) != b.get(c)}
    assert {r.code: r.change for r in found} == want


def test_a_code_with_very_many_dates_stays_in_several_tasks(spark, frame, monkeypatch):
    monkeypatch.setattr(history, "STRETCH", 50)
    rows = [("hot", day, float(day // 3 % 2), "x") for day in range(2000)] + [("cold", 5, 1.0, "x")]
    df = history.validity(frame(rows, SCHEMA), ["code"], "day", ["price", "note"])
    assert sorted(map(tuple, df.collect()), key=str) == plain(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # only the ends of stretches are walked by code alone
    assert sum("_stretch" in line.split("], [", 1)[1] for line in windows if "], [" in line) >= 1


def test_no_rows(frame):
    assert history.validity(frame([], SCHEMA), ["code"], "day", ["price"]).count() == 0
