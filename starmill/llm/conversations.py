"""Repair of the turn structure of conversations by bidirectional Dijkstra (operator 12).

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. The edits of its
rows form a lattice: a node is a place between rows and what the repaired turns so far end in.
Keeping a row costs 0, giving it the role that is due 2, deleting it 3, inserting an empty turn
of the role that is due 2; a truncated row that stays costs 1 more, and blank and repeated rows
must go. A search from the start and one from the end settle nodes by cost, and among equal
costs by the least audit (the initials of the edits). They stop when the two heaps together cost
more than the best crossing, so all crossings of equal cost are complete; the least of
the concatenated audits wins.

Two audits of equal cost between the same nodes are never prefixes of each other, since the longer
one would have paid for its additional inserts. So the least audit is made of least parts, and
conversations can be cut: those of more than ``SEGMENT`` rows are searched segment by segment,
between all ends that a segment can have. What is kept between segments is a cost, an audit and
a running hash for each of four ends, so a conversation of any length goes through a task as
a stream and is never gathered.

Spark damages, marks and sorts the rows with DataFrame functions in one shuffle by conversation. The
rows of one conversation are one sequence for the hash that is asked for, so they pass through one
task; they are sorted there on disk if need be.

Defined cases: a null role or text counts as one space, and so does a null id or turn in the
text that decides the damage. Null turns come first; rows of one turn are ordered by role and
text. A null ``conv_id`` is a conversation of its own. Repeated rows are repeated turns. A
conversation without rows gives zeros, an empty audit and the hash of the empty text. No rows give no
rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import query, table

SEGMENT = 512  # rows searched at once
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\f\r"
OUT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)

# what the repaired turns end in
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
AFTER = {  # (end, initial of a kept row) -> end
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
COMPLETE = (START, ASSISTANT)


class Turn(NamedTuple):
    role: str
    text: str
    must_go: bool = False
    truncated: bool = False


def _forward(rows: list[Turn], place: int, end: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """Edits out of a node: initial, cost, node."""
    yield "I", INSERT, (place, DUE[end])
    if place < len(rows):
        row = rows[place]
        yield "D", DELETE, (place + 1, end)
        if not row.must_go:
            more = TRUNCATED if row.truncated else 0
            yield "R", REROLE + more, (place + 1, DUE[end])
            kept = AFTER.get((end, row.role[:1]))
            if kept is not None:
                yield "K", KEEP + more, (place + 1, kept)


def _backward(rows: list[Turn], place: int, end: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """Edits into a node."""
    for before, due in DUE.items():
        if due == end:
            yield "I", INSERT, (place, before)
    if place:
        row = rows[place - 1]
        yield "D", DELETE, (place - 1, end)
        if not row.must_go:
            more = TRUNCATED if row.truncated else 0
            for before, due in DUE.items():
                if due == end:
                    yield "R", REROLE + more, (place - 1, before)
                if AFTER.get((before, row.role[:1])) == end:
                    yield "K", KEEP + more, (place - 1, before)


def cheapest(rows: list[Turn], begin: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost, and least audit at that cost, from ``begin`` through all rows to one of ``ends``.

    Heap entries hold the rows passed before the audit. Edits without cost pass a row, so when a
    node is settled all nodes that could lower its audit at the same cost have been.
    """
    if not rows and begin in ends:
        return 0, ""
    n, far = len(rows), float("inf")
    heaps = ([(0, 0, "", (0, begin))], [(0, 0, "", (n, e)) for e in ends])
    settled: tuple[dict, dict] = ({}, {})
    best = far

    def top(side: int) -> float:
        return heaps[side][0][0] if heaps[side] else far

    while (low := top(0) + top(1)) <= best and low < far:
        side = 0 if top(0) <= top(1) else 1
        cost, passed, audit, node = heappop(heaps[side])
        own, other = settled[side], settled[1 - side]
        if node in own:
            continue
        own[node] = (cost, audit)
        for initial, price, to in (_backward if side else _forward)(rows, *node):
            if to in other:
                best = min(best, cost + price + other[to][0])
            if to not in own:
                step = passed + (to[0] != node[0])
                heappush(heaps[side], (cost + price, step, initial + audit if side else audit + initial, to))
    crossings = [
        audit + initial + settled[1][to][1]
        for node, (cost, audit) in settled[0].items()
        for initial, price, to in _forward(rows, *node)
        if to in settled[1] and cost + price + settled[1][to][0] == best
    ]
    return (int(best), min(crossings)) if crossings else None


def repaired(rows: list[Turn], begin: int, audit: str) -> Iterator[str]:
    """The lines ``role:text`` that an audit leaves of the rows."""
    end, left = begin, iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit == "D":
            continue
        end = AFTER[end, row.role[:1]] if edit == "K" else DUE[end]
        yield f"{row.role if edit == 'K' else ROLE[end]}:{row.text if row else ''}"


class _Path(NamedTuple):
    """The cheapest edits up to the end of a segment; ``before`` is the path they go on from."""

    cost: int
    audit: str
    before: _Path | None
    hasher: object
    lines: int

    def whole_audit(self) -> str:
        parts, path = [], self
        while path:
            parts.append(path.audit)
            path = path.before
        return "".join(reversed(parts))


class Repair:
    """One conversation, row by row."""

    def __init__(self, segment: int = SEGMENT):
        self.segment, self.rows = segment, []
        self.paths: dict[int, _Path] = {START: _Path(0, "", None, hashlib.sha256(), 0)}

    def add(self, row: Turn) -> None:
        if len(self.rows) == self.segment:
            self._close([(end,) for end in range(4)])
        self.rows.append(row)

    def _close(self, goals: list[tuple[int, ...]]) -> None:
        """Carry the paths through the rows at hand."""
        after = {}
        for ends in goals:
            found = []
            for begin, path in self.paths.items():
                way = cheapest(self.rows, begin, ends)
                if way:
                    found.append((path.cost + way[0], way[1], begin))
            if not found:
                continue
            least = min(cost for cost, _, _ in found)
            ties = [(audit, begin) for cost, audit, begin in found if cost == least]
            if len(ties) > 1:
                audit, begin = min(ties, key=lambda t: self.paths[t[1]].whole_audit() + t[0])
            else:
                audit, begin = ties[0]
            path = self.paths[begin]
            hasher, lines = path.hasher.copy(), path.lines
            for line in repaired(self.rows, begin, audit):
                hasher.update((b"\n" if lines else b"") + line.encode())
                lines += 1
            after[ends[0]] = _Path(least, audit, path, hasher, lines)
        self.paths, self.rows = after, []

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the repaired conversation."""
        self._close([COMPLETE])
        path = self.paths[COMPLETE[0]]
        return path.cost, path.whole_audit(), path.hasher.hexdigest()


class _Summary:
    """Counts over the rows of one conversation."""

    def __init__(self):
        self.repair = Repair()
        self.least = self.greatest = self.role = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role, text, blank, duplicate, truncated) -> None:
        if turn is not None and turn != self.greatest:
            self.least = turn if self.least is None else self.least
            self.greatest = turn
            self.turns += 1
        if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role
        duplicate = duplicate and not blank
        truncated = truncated and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.repair.add(Turn(role, text, blank or duplicate, truncated))

    def row(self, conv_id) -> tuple:
        gaps = self.greatest - self.least + 1 - self.turns if self.turns else 0
        return (conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present; dropped rows stay with ``present`` false."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = (
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    )
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.when(kind == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"),
        (kind != 0).alias("present"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, present): its faults, and its repair."""
    ordered = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    bare = F.rtrim("text", F.lit(WHITE))
    seen = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = rows.repartition("conv_id").select(
        "conv_id", "turn", "role", "text", "present", (bare == "").alias("blank"),
        (F.row_number().over(seen) > 1).alias("duplicate"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
    ).sortWithinPartitions(F.asc_nulls_first("conv_id"), *ordered)

    def run(batches):
        names = [c.split()[0] for c in OUT.split(", ")]
        types = [pa.string() if "string" in c else pa.int64() for c in OUT.split(", ")]
        current, summary = None, None
        for batch in batches:
            done = []
            for conv_id, turn, role, text, present, *faults in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if summary is None or conv_id != current:
                    if summary:
                        done.append(summary.row(current))
                    current, summary = conv_id, _Summary()
                if present:
                    summary.add(turn, role, text, *faults)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
        if summary:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(summary.row(current), types, strict=True)], names)

    return marked.mapInArrow(run, OUT)


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))
