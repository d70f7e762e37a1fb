"""Interval joins against all pairs, with a key that owns most rows."""

import random

import pytest

from tablecraft.operators.joins import interval_join, overlap_join
from tablecraft.plans import QUERIES


def random_rows(seed, n):
    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, 1, 1, 1, 2, 3])
    spans = []
    for i in range(n):
        lo = rnd.randint(-500, 500)
        hi = lo + rnd.choice([0, 1, 2, 3, 7, 8, 9, 64, 65, 300, -5])
        spans.append((key(), i, rnd.choice([lo] * 9 + [None]), rnd.choice([hi] * 9 + [None])))
    points = [(key(), i, rnd.choice([rnd.randint(-520, 900)] * 9 + [None])) for i in range(n)]
    return spans, points


END = 1 << 61


def held(a, b):
    return a[0] is not None and a[0] == b[0]


@pytest.mark.parametrize("seed", range(2))
def test_every_interval_that_holds_a_point(spark, seed):
    spans, points = random_rows(seed, 300)
    left = spark.createDataFrame(points, "k int, p int, t long")
    right = spark.createDataFrame(spans, "k int, s int, lo long, hi long")
    got = sorted((r["p"], r["s"]) for r in interval_join(left, right, ["k"], "t", "lo", "hi").collect())
    assert got == sorted(
        (p[1], s[1]) for p in points for s in spans
        if held(p, s) and None not in (p[2], s[2]) and s[2] <= p[2] < (END if s[3] is None else s[3])
    )
    assert len(got) > 500


def test_every_pair_of_overlapping_intervals_once(spark):
    spans, _ = random_rows(7, 200)
    df = spark.createDataFrame(spans, "k int, s int, lo long, hi long")
    rows = overlap_join(df, df, ["k"], "lo", "hi").collect()
    got = sorted((r["s"], r["other_s"]) for r in rows)
    ends = {s[1]: END if s[3] is None else s[3] for s in spans}
    usable = [s for s in spans if s[2] is not None and s[2] < ends[s[1]]]
    assert got == sorted(
        (a[1], b[1]) for a in usable for b in usable
        if held(a, b) and max(a[2], b[2]) < min(ends[a[1]], ends[b[1]])
    )


def test_no_range_join(spark, data):
    for name in ("interval_hits", "interval_overlaps", "interval_user_events"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_columns_of_the_points_win(spark):
    points = spark.createDataFrame([(1, 5, "p")], "k int, t long, name string")
    spans = spark.createDataFrame([(1, 0, 9, "s", 4)], "k int, lo long, hi long, name string, extra int")
    rows = interval_join(points, spans, ["k"], "t", "lo", "hi").collect()
    assert [r.asDict() for r in rows] == [{"k": 1, "t": 5, "name": "p", "lo": 0, "hi": 9, "extra": 4}]
    with pytest.raises(ValueError):
        interval_join(points.selectExpr("k", "name AS t"), spans, ["k"], "t", "lo", "hi")


def test_rows_at_all_levels_are_not_broadcast(spark):
    points = spark.range(3).selectExpr("1 AS k", "id AS t")
    spans = spark.range(3).selectExpr("1 AS k", "id AS lo", "id + id * id + 1 AS hi")
    joined = [interval_join(points, spans, ["k"], "t", "lo", "hi"), overlap_join(spans, spans, ["k"], "lo", "hi")]
    assert [df.count() for df in joined] == [4, 5]
    for df in joined:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
