"""Ordered functions with one group that owns most rows, plain and split."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablecraft.operators import windows as w

PART, ORDER, TIE = ["k"], ["t"], ["i"]


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 1 has two thirds of the rows, a NULL key exists, times repeat heavily."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = 1 if i % 3 else rng.choice([2, 3, None, 4])
        value = None if rng.random() < 0.2 else rng.randint(-50, 50)
        rows.append((key, rng.randint(0, 25), i, value, f"v{rng.randint(0, 9)}"))
    return spark.createDataFrame(rows, "k int, t int, i int, x long, s string").cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[2])


def same(a, b):
    assert rows_of(a) == rows_of(b.select(*a.columns))


def plain_window():
    return Window.partitionBy("k").orderBy("t", "i")


@pytest.mark.parametrize("fn", w.RANKING)
def test_ranking(skewed, small_groups, fn):
    full, peers = plain_window(), Window.partitionBy("k").orderBy("t")
    want = {
        "row_number": F.row_number().over(full),
        "rank": F.rank().over(peers),
        "dense_rank": F.dense_rank().over(peers),
        "ntile": F.ntile(7).over(full),
    }[fn].cast("long")
    same(w.ranked(skewed, fn, PART, ORDER, TIE, "out", 7), skewed.withColumn("out", want))


def test_descending_rank(skewed, small_groups):
    peers = Window.partitionBy("k").orderBy(F.desc("t"))
    for fn, want in (("rank", F.rank()), ("dense_rank", F.dense_rank())):
        got = w.ranked(skewed, fn, PART, [w.Desc("t")], TIE, "out")
        same(got, skewed.withColumn("out", want.over(peers).cast("long")))


@pytest.mark.parametrize("fn", w.NAVIGATION)
def test_navigation(skewed, small_groups, fn):
    full = plain_window()
    whole = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = {
        "lag": F.lag("x").over(full),
        "lead": F.lead("x").over(full),
        "first_value": F.first("x").over(whole),
        "last_value": F.last("x").over(whole),
        "nth_value": F.nth_value("x", 5).over(whole),
    }[fn]
    nth = 5 if fn == "nth_value" else 1
    same(w.navigate(skewed, fn, PART, ["t", "i"], "x", "out", nth), skewed.withColumn("out", want))


def test_distant_neighbours(skewed, small_groups):
    one = plain_window()
    got = w.navigate_columns(
        skewed, PART, ["t", "i"],
        {"a": ("lag", "x", 3), "b": ("lead", "s", 60), "c": ("lag", "s"), "d": ("last_value", "s")},
    )
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = skewed.select(
        "*", F.lag("x", 3).over(one).alias("a"), F.lead("s", 60).over(one).alias("b"),
        F.lag("s").over(one).alias("c"), F.last("s").over(whole).alias("d"),
    )
    same(got, want)


def test_running_total_and_carry_forward(skewed, small_groups):
    up_to = plain_window().rowsBetween(Window.unboundedPreceding, 0)
    same(
        w.running_total(skewed, PART, ["t", "i"], "x", "out"),
        skewed.withColumn("out", F.sum("x").over(up_to)),
    )
    rows = w.ordered(skewed, PART, ["t", "i"])
    assert rows.split
    same(
        rows.carry_forward(F.col("x"), "out").frame(),
        skewed.withColumn("out", F.last("x", True).over(up_to)),
    )


def test_groups_under_the_limit_are_not_split(skewed):
    assert not w.ordered(skewed, PART, ["t", "i"]).split


def test_sequence_key(skewed, small_groups):
    got = w.assign_sk(skewed, ["i"], 100, "sk").select("i", "sk").collect()
    assert sorted((r.i, r.sk) for r in got) == [(i, 101 + i) for i in range(900)]


def test_first_by_and_hot_keys(skewed, small_groups):
    first = F.first("s").over(plain_window())
    same(w.first_by(skewed, PART, ["t", "i"], "s", "out"), skewed.withColumn("out", first))


def test_per_key_join_spreads_the_hot_key(skewed, small_groups):
    per_key = skewed.groupBy("k").agg(F.max("x").alias("top"), F.count(F.lit(1)).alias("_n"))
    got = w.join_per_key(skewed, per_key, ["k"], keep_n=True)
    whole = Window.partitionBy("k")
    want = skewed.withColumn("top", F.max("x").over(whole)).withColumn("_n", F.count("*").over(whole))
    same(got, want)


@pytest.mark.parametrize("parts", [1, 17])
def test_dedup_is_the_same_for_any_layout(skewed, parts):
    base = rows_of(w.dedup_latest(skewed, PART, [F.desc("t")], [F.desc("i")]))
    again = rows_of(w.dedup_latest(skewed.repartition(parts), PART, [F.desc("t")], [F.desc("i")]))
    assert base == again
    tied = w.with_tie_monitor(skewed.repartition(parts), PART, ["t"], [F.desc("i")])
    assert {r["_dq_determinism_status"] for r in tied.collect()} <= set(w.TIE_LABELS)
    assert tied.count() == len(base)


def test_order_is_enforced(skewed):
    for call in (
        lambda: w.ranked(skewed, "rank", PART, [], TIE, "out"),
        lambda: w.navigate(skewed, "lag", PART, [], "x", "out"),
        lambda: w.dedup_latest(skewed, PART, []),
        lambda: w.ordered(skewed, PART, []),
    ):
        with pytest.raises(ValueError):
            call()


def test_dedup_limits_groups_before_the_shuffle(skewed):
    plan = w.dedup_latest(skewed, PART, [F.desc("t")], [F.desc("i")])._jdf.queryExecution().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert "Partial" in plan


def test_samples_do_not_depend_on_layout(skewed):
    a = w.sample_hash(skewed, "i", 100, 30).select("i").collect()
    b = w.sample_hash(skewed.repartition(9), "i", 100, 30).select("i").collect()
    assert sorted(a) == sorted(b) and 0 < len(a) < 900
