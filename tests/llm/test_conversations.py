"""Conversation repair against all edits of small conversations and a plain table of costs."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import product
from zlib import crc32

import pytest

from starmill.llm import conversations as c

WELL_FORMED = re.compile(r"(s?(ua)+)?")
T = c.Turn


def every_way(rows, inserts=3):
    """The best (cost, audit) by trying all edits, with up to ``inserts`` inserts before each row and at the end."""
    best = None
    for choice in product(*[("K", "Ru", "Ra", "D") for _ in rows]):
        for added in product(*[[w for k in range(inserts + 1) for w in product("ua", repeat=k)] for _ in range(len(rows) + 1)]):
            cost, audit, roles = 0, "", ""
            for i, new in enumerate(added):
                cost, audit, roles = cost + 2 * len(new), audit + "I" * len(new), roles + "".join(new)
                if i == len(rows):
                    continue
                row, edit = rows[i], choice[i]
                if row.must_go and edit != "D":
                    break
                audit += edit[0]
                cost += {"K": 0, "R": 2, "D": 3}[edit[0]] + (row.truncated and edit != "D")
                roles += "" if edit == "D" else row.role[:1] or "?" if edit == "K" else edit[1]
            else:
                if WELL_FORMED.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def by_table(rows):
    """The same from a table over rows and ends, filled in order."""
    table = {(0, c.START): (0, "")}
    for place in range(len(rows) + 1):
        for _ in range(4):  # inserts stay at the place
            for end in range(4):
                if (place, end) in table:
                    cost, audit = table[place, end]
                    to = (place, c.DUE[end])
                    table[to] = min(table.get(to, (1e9, "")), (cost + 2, audit + "I"))
        if place < len(rows):
            row = rows[place]
            for end in range(4):
                if (place, end) not in table:
                    continue
                cost, audit = table[place, end]
                steps = [("D", 3, end)]
                if not row.must_go:
                    steps.append(("R", 2 + row.truncated, c.DUE[end]))
                    if (end, row.role[:1]) in c.AFTER:
                        steps.append(("K", 0 + row.truncated, c.AFTER[end, row.role[:1]]))
                for edit, price, after in steps:
                    to = (place + 1, after)
                    table[to] = min(table.get(to, (1e9, "")), (cost + price, audit + edit))
    return min(table[len(rows), e] for e in c.COMPLETE if (len(rows), e) in table)


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", " ", "User"]
    return [
        T(rng.choices(roles, (6, 6, 2, 1, 1, 1, 1))[0], f"t{i}.", rng.random() < 0.15, rng.random() < 0.2)
        for i in range(n)
    ]


def test_search_finds_the_best_of_all_edits():
    rng = random.Random(4)
    for n in (1, 2):
        for _ in range(25):
            rows = some_rows(rng, n)
            assert c.cheapest(rows, c.START, c.COMPLETE) == every_way(rows), rows
    assert c.cheapest([], c.START, c.COMPLETE) == (0, "")


def test_search_equals_the_table():
    rng = random.Random(5)
    for _ in range(400):
        rows = some_rows(rng, rng.randrange(1, 30))
        assert c.cheapest(rows, c.START, c.COMPLETE) == by_table(rows), rows


@pytest.mark.parametrize("segment", [1, 3, 8])
def test_segments_change_nothing(segment):
    rng = random.Random(segment)
    for _ in range(60):
        rows = some_rows(rng, rng.randrange(1, 40))
        whole, cut = c.Repair(), c.Repair(segment)
        for row in rows:
            whole.add(row)
            cut.add(row)
        cost, audit, digest = whole.result()
        assert cut.result() == (cost, audit, digest)
        lines = list(c.repaired(rows, c.START, audit))
        assert digest == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert WELL_FORMED.fullmatch("".join(line[0] for line in lines))


def test_long_conversation_of_many_segments():
    rng = random.Random(8)
    rows = some_rows(rng, 1500)
    repair = c.Repair()
    for row in rows:
        repair.add(row)
    assert repair.result()[:2] == by_table(rows)


def expected(rows):
    """The contract's columns, row by row in plain Python."""
    kept, ids = defaultdict(list), set()
    for conv_id, turn, role, text in rows:
        ids.add(conv_id)
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv_id] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = set()
    for conv_id in ids:
        mine = sorted(kept[conv_id], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, marks, counts = set(), [], [], [0, 0, 0]
        for turn, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\f\r")
            blank, again = not bare, (role, text) in seen
            cut = not blank and not again and bare[-1] not in ".!?"
            seen.add((role, text))
            counts = [counts[0] + blank, counts[1] + (again and not blank), counts[2] + cut]
            turns += [] if turn is None else [turn]
            marks.append(T(role, text, blank or again, cut))
        pairs = [a.role[:1] + b.role[:1] for a, b in zip(marks, marks[1:], strict=False)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = by_table(marks)
        lines = list(c.repaired(marks, c.START, audit))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv_id, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return out


def test_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = c.op12(spark, sf).collect()
    assert {tuple(r) for r in got} == expected(rows) and len(got) == len({r.conv_id for r in rows})


def test_odd_rows(spark):
    rng = random.Random(9)
    rows = [(i, j, rng.choice(["user", "assistant", None, "system"]), rng.choice(["Hi.", "a", "", None, " \t", "Q? "]))
            for i in range(60) for j in range(rng.randrange(1, 8))]
    rows += [(None, 0, "user", "x."), (None, None, "assistant", "y."), (100, None, "user", "a."), (100, None, "user", "a.")]
    rows += [(101, 5, "user", "é\n."), (101, 5, "assistant", "b" * 200_000 + "."), (102, 3, "user", "u."), (102, 900, "assistant", "v ")]
    rows += [(200 + i, 7, "user", "only") for i in range(40)]  # some of these lose their only row
    frame = spark.createDataFrame(
        [(*r, True, 1) for r in rows], "conv_id long, turn long, role string, text string, present boolean, cost int"
    ).repartition(5)
    got = c.repair_conversations(c.damaged(frame)).collect()
    assert {tuple(r) for r in got} == expected(rows) and len(got) == len({r[0] for r in rows})
    assert any(r.audit == "" and r.cost == 0 for r in got)


def test_no_rows_and_one_shuffle(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    repaired = c.repair_conversations(c.damaged(none))
    assert repaired.count() == 0
    plan = repaired._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
