"""Compares of stored frames: equal to the plain compare, and little is read."""

import random

import pytest

from tablecraft.operators.compare import compare
from tablecraft.sources import digests

DDL = "`k` int, `v` string, `x` double, `t` timestamp, `b` binary"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).selectExpr("k", "v", "x", "t", "b")


def some_rows(n, seed=3):
    draw = random.Random(seed)
    return [
        (draw.choice([None, 1, 1, 1, i]), draw.choice([None, "", "a|b", f"v{i}"]), draw.choice([None, 0.5, -0.0]),
         None, draw.choice([None, b"\xff", b"\xfe"]))
        for i in range(n)
    ]


ROWS = some_rows(300)
CASES = {
    "equal, other order": (ROWS, ROWS[::-1]),
    "one row changed": (ROWS, ROWS[:-1] + [(ROWS[-1][0], "changed", 1.0, None, None)]),
    "one copy more": (ROWS, ROWS + ROWS[:1]),
    "null for text": ([(1, None, None, None, None)], [(1, "\\N", None, None, None)]),
    "values moved between columns": ([(1, "2", None, None, None)], [(2, "1", None, None, None)]),
    "bytes that are no text": ([(1, "a", 0.0, None, b"\xff")], [(1, "a", 0.0, None, b"\xfe")]),
    "one side empty": (ROWS, []),
    "both empty": ([], []),
}


@pytest.mark.parametrize("case", CASES)
def test_equals_the_plain_compare(spark, tmp_path, case):
    a, b = (frame(spark, rows) for rows in CASES[case])
    digests.store_digested(a, f"{tmp_path}/a", ["k"])
    digests.store_digested(b, f"{tmp_path}/b", ["k"])
    got = digests.compare_stored(spark, f"{tmp_path}/a", f"{tmp_path}/b", DDL)
    expected = compare(a, b)
    assert got.columns == expected.columns and got.collect() == expected.collect()


def test_only_differing_ranges_are_read(spark, tmp_path):
    rows = [(i, "v", 0.0, None, None) for i in range(3000)]
    other = rows[:-1] + [(2999, "w", 0.0, None, None)]
    for name, part in (("a", rows), ("b", other), ("c", rows)):
        digests.store_digested(frame(spark, part), f"{tmp_path}/{name}", ["k"])
    assert digests.differing_parts(spark, f"{tmp_path}/a", f"{tmp_path}/c") == []
    parts = digests.differing_parts(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert len(parts) == 1
    read = digests.read_parts(spark, f"{tmp_path}/a", DDL, parts)
    assert 0 < read.count() < 60
    assert "PartitionFilters: [isnotnull(_part" in read._jdf.queryExecution().executedPlan().toString()


def test_other_layouts_are_refused(spark, tmp_path):
    a = frame(spark, ROWS)
    digests.store_digested(a, f"{tmp_path}/a", ["k"])
    digests.store_digested(a, f"{tmp_path}/b", ["v"])
    with pytest.raises(ValueError, match="stored with other"):
        digests.differing_parts(spark, f"{tmp_path}/a", f"{tmp_path}/b")
