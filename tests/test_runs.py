"""Co-located tables with hot keys, and runs that go on where they failed."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from starmill.plans import ledger
from starmill.session import scratch_path
from starmill.sinks import colocated


@pytest.mark.parametrize("hot", [1, 400])
def test_counts_of_stored_tables_with_a_hot_key(spark, frame, hot):
    heads = [(f"k{i}", i) for i in range(60)] + [(None, 99)]
    left = [(f"k{i % 60}", f"a{i}") for i in range(180)] + [("k7", f"h{i}") for i in range(hot)] + [(None, "n")] * 3
    right = [(f"k{i % 50}", f"b{i}") for i in range(100)] + [("k9", f"h{i}") for i in range(hot)] + [("lost", "x")]
    base = scratch_path(spark, "colocated")
    mark = base.rsplit("-", 1)[1]
    stored = colocated.write_colocated(
        {f"heads_{mark}": frame(heads, "k string, v int")},
        {f"left_{mark}": frame(left, "k string, a string"), f"right_{mark}": frame(right, "k string, b string")},
        base, "k", 8,
    )
    many = {"n_left": stored[f"left_{mark}"], "n_right": stored[f"right_{mark}"]}
    found = colocated.count_colocated(spark, stored[f"heads_{mark}"], many, "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    a, b = Counter(k for k, _ in left), Counter(k for k, _ in right)
    assert sorted(map(tuple, found.collect())) == sorted((k, v, a[k], b[k]) for k, v in heads if k and a[k] and b[k])
    if hot > 1:  # the hot key lies in several buckets
        sizes = many["n_left"].filter("k = 'k7'").groupBy(F.input_file_name()).count().collect()
        assert len(sizes) > 2 and max(r["count"] for r in sizes) < 0.6 * hot


def test_steps_done_are_not_run_again(spark):
    runs, seen, broken = ledger.Ledger(spark, scratch_path(spark, "ledger")), [], {"b"}

    def step(name):
        def work(day):
            if name in broken and day.day == 2:
                raise RuntimeError(name)
            seen.append((day.day, name))

        return work

    steps = {name: step(name) for name in "abc"}
    days = [date(2020, 1, d) for d in (3, 1, 2)]
    with pytest.raises(RuntimeError):
        ledger.backfill(runs, days, steps)
    assert seen == [(1, "a"), (1, "b"), (1, "c"), (2, "a")]  # none past the failed one
    broken.clear()
    assert ledger.backfill(runs, days, steps) == {days[1]: [], days[2]: ["b", "c"], days[0]: ["a", "b", "c"]}
    assert ledger.backfill(runs, days, steps) == {d: [] for d in days}
    states = Counter((r.run_date.day, r.step, r.state) for r in runs.rows().collect())
    assert states[2, "b", "failed"] == states[2, "b", "done"] == 1 and len(states) == 10
