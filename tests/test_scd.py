"""SCD2 invariants, backfill against repeated loads, and the stream."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablecraft.functions.scalars import ts
from tablecraft.operators import quality, scd, vault, windows
from tablecraft.session import GROUP_ROWS_KEY
from tablecraft.sources import versions
from tablecraft.streaming import scd_stream

KEYS, TRACKED = ["k"], ["v"]
D1, D2, D3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def bag(df, *cols):
    return Counter(map(tuple, df.select(*cols).collect())) if cols else Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def dim(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "k int, v string")
    return scd.scd2_init(src, KEYS, D1)


@pytest.fixture(scope="module")
def second(spark):
    return spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "d"), (5, "e")], "k int, v string")


def test_change_types(dim, second):
    safe = dict(map(tuple, scd.scd2_changes(second, dim, KEYS, TRACKED).select("k", "change_type").collect()))
    plain = dict(
        map(tuple, scd.scd2_changes(second, dim, KEYS, TRACKED, False).select("k", "change_type").collect())
    )
    assert safe == {1: "NO_CHANGE", 2: "UPDATE", 3: "UPDATE", 4: "UPDATE", 5: "INSERT"}
    assert plain == {1: "NO_CHANGE", 2: "UPDATE", 3: "NO_CHANGE", 4: "NO_CHANGE", 5: "INSERT"}


@pytest.mark.parametrize("null_safe", [True, False])
def test_apply_is_delta_plus_untouched(dim, second, null_safe):
    whole = scd.scd2_apply(dim, second, KEYS, TRACKED, D2, null_safe)
    delta = scd.scd2_delta(dim, second, KEYS, TRACKED, D2, null_safe)
    closed = delta.filter("not is_current").select("sk")
    want = dim.join(closed, "sk", "left_anti").select(*dim.columns).unionByName(delta)
    assert bag(whole) == bag(want)


def test_same_source_twice_changes_nothing(dim, second):
    once = scd.scd2_apply(dim, second, KEYS, TRACKED, D2)
    assert bag(scd.scd2_apply(once, second, KEYS, TRACKED, D3)) == bag(once)


def test_missing_keys_stay_open(dim, spark):
    src = spark.createDataFrame([(1, "z")], "k int, v string")
    out = scd.scd2_apply(dim, src, KEYS, TRACKED, D2)
    assert sorted(r.k for r in scd.current(out).collect()) == [1, 2, 3, 4]


def test_duplicate_source_rows_do_not_multiply(dim, spark):
    src = spark.createDataFrame([(1, "y"), (1, "z"), (1, "z")], "k int, v string")
    out = scd.scd2_apply(dim, src, KEYS, TRACKED, D2)
    assert out.filter("k = 1").count() == 2
    assert scd.current(out).filter("k = 1").first().v == "z"


def test_point_in_time(dim, second):
    out = scd.scd2_apply(dim, second, KEYS, TRACKED, D2)
    assert dict(map(tuple, scd.as_of(out, "2024-01-15 00:00:00").select("k", "v").collect())) == {
        1: "a", 2: "b", 3: "c", 4: None
    }
    assert scd.as_of(out, D2).count() == 5
    assert scd.as_of(out, "2023-01-01 00:00:00").count() == 0


def test_invariants_hold_and_break(dim, second):
    out = scd.scd2_apply(dim, second, KEYS, TRACKED, D2)
    assert {r.failed_rows for r in quality.check_scd2(out, "d", KEYS).collect()} == {0}
    broken = out.unionByName(out.filter("k = 2"))
    bad = {r.rule: r.failed_rows for r in quality.check_scd2(broken, "d", KEYS).collect()}
    assert bad["scd2_one_current"] == 1 and bad["scd2_no_overlap"] > 0


def log_rows(seed=5, n=160):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if i % 2 else rng.randint(2, 5)
        out.append((key, rng.choice(["a", "b", None]), f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i))
    return out


def as_log(spark, data):
    df = spark.createDataFrame(data, "k int, v string, at string, id int")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def walk(data):
    """History of the log, row by row."""
    out, state = [], {}
    for key, value, at, _ in sorted(data, key=lambda r: (r[2], r[3])):
        if key in state and state[key][0] == value:
            continue
        if key in state:
            out.append((key, state[key][0], state[key][1], at, False))
        state[key] = (value, at)
    out += [(k, v, at, "9999-12-31 23:59:59", True) for k, (v, at) in state.items()]
    return Counter(out)


def history_bag(df):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return bag(
        df.withColumn("valid_from", F.date_format("valid_from", stamp)).withColumn(
            "valid_to", F.date_format("valid_to", stamp)
        ),
        "k", "v", "valid_from", "valid_to", "is_current",
    )


def test_backfill_equals_row_by_row(spark):
    data = log_rows()
    assert history_bag(scd.scd2_backfill(as_log(spark, data), KEYS, TRACKED, "at", ["id"])) == walk(data)


def test_backfill_with_split_groups(spark, small_groups):
    data = log_rows(9)
    assert history_bag(scd.scd2_backfill(as_log(spark, data), KEYS, TRACKED, "at", ["id"])) == walk(data)


def test_backfill_equals_repeated_loads(spark):
    data = [(k, v, at, i) for i, (k, v, at) in enumerate(
        [(1, "a", D1), (2, "b", D1), (1, "a", D2), (2, "c", D2), (3, "d", D2), (1, "e", D3), (2, "c", D3)]
    )]
    dim = None
    for day in (D1, D2, D3):
        src = spark.createDataFrame([(k, v) for k, v, at, _ in data if at == day], "k int, v string")
        dim = scd.scd2_init(src, KEYS, day) if dim is None else scd.scd2_apply(dim, src, KEYS, TRACKED, day)
    assert history_bag(dim) == history_bag(
        scd.scd2_backfill(as_log(spark, data), KEYS, TRACKED, "at", ["id"])
    )


def test_stream_over_many_batches(spark, tmp_path):
    data = log_rows(11, 120)
    src = tmp_path / "in"
    for i in range(4):
        as_log(spark, data[i * 30:(i + 1) * 30]).coalesce(1).write.mode("append").parquet(str(src))
    schema = as_log(spark, data[:1]).schema
    # file order follows the modification time, so batches come in time order
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    path = str(tmp_path / "out")
    last = scd_stream.scd2_stream(stream, path, str(tmp_path / "cp"), KEYS, TRACKED, "at", ["id"])
    assert last == 3
    assert history_bag(scd_stream.read_history(spark, path, last)) == walk(data)
    args = (path, str(tmp_path / "cp"), KEYS, TRACKED, "at", ["id"])
    assert scd_stream.scd2_stream(stream, *args) == last  # nothing new
    more = [(1, "q", "2024-01-02 00:00:00", 900), (9, "r", "2024-01-02 00:00:01", 901)]
    as_log(spark, more).coalesce(1).write.mode("append").parquet(str(src))
    last = scd_stream.scd2_stream(stream, *args)
    assert history_bag(scd_stream.read_history(spark, path, last)) == walk(data + more)


def test_no_batches_yet(spark, tmp_path):
    assert scd_stream.last_batch(spark, str(tmp_path / "nothing")) == -1


def test_repeated_batch_and_late_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    first = as_log(spark, [(1, "a", D1, 0), (2, "b", D2, 1)])
    second = as_log(spark, [(1, "c", D3, 2), (2, "z", D1, 3)])
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        scd_stream.apply_batch(batch, number, path, KEYS, TRACKED, "at", ["id"])
    got = history_bag(scd_stream.read_history(spark, path, 1))
    # the late row takes its place before the version that was there
    assert got == walk([(1, "a", D1, 0), (2, "z", D1, 3), (2, "b", D2, 1), (1, "c", D3, 2)])
    assert history_bag(scd_stream.read_history(spark, path, 0)) == walk([(1, "a", D1, 0), (2, "b", D2, 1)])


def test_runs_are_in_proportion_to_their_batches_and_tiers_are_merged(spark, tmp_path):
    path = str(tmp_path / "out")
    many = [(k, "a", D1, k) for k in range(2_000)]
    batches = [many, *[[(k, f"v{k}", D2, 5_000 + k)] for k in range(7)]]
    for number, data in enumerate(batches):
        scd_stream.apply_batch(as_log(spark, data), number, path, KEYS, TRACKED, "at", ["id"])
        files = versions.manifest(spark, path, number)
        runs = {(r["tier"], r["added"]): r["n"] for r in files.groupBy("tier", "added").agg(F.sum("rows").alias("n")).collect() if r["n"]}
        if number in (1, 2, 4, 5):
            assert runs[1, number] == 2  # the new point, and the one before it with its end
        assert len(runs) <= 4
    assert runs == {(2, 3): 2_003, (2, 7): 8}
    assert history_bag(scd_stream.read_history(spark, path, 7)) == walk([r for b in batches for r in b])


@pytest.mark.parametrize("seed", range(3))
def test_rows_in_any_order_give_the_history_of_their_log(spark, tmp_path, seed):
    rnd = random.Random(seed)
    data = [
        (rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice(["a", "b", None]), f"2024-01-{rnd.randint(1, 28):02d} 00:00:00", i)
        for i in range(60)
    ]
    late = data[:]
    rnd.shuffle(late)
    path = str(tmp_path / "out")
    for number in range(6):
        scd_stream.apply_batch(as_log(spark, late[number * 10 : number * 10 + 10]), number, path, KEYS, TRACKED, "at", ["id"], fan=2)
    whole = scd.scd2_backfill(as_log(spark, data), KEYS, TRACKED, "at", ["id"])
    assert history_bag(scd_stream.read_history(spark, path, 5)) == history_bag(whole)


@pytest.mark.parametrize("limit", ["1", "3"])
def test_groups_beyond_the_limit_give_the_same_history(spark, tmp_path, limit):
    rnd = random.Random(7)
    data = [(rnd.choice([None, 1, 1, 2]), rnd.choice(["a", "b", None]), f"2024-01-{rnd.randint(1, 28):02d} 00:00:00", i) for i in range(24)]
    path = str(tmp_path / "out")
    spark.conf.set(GROUP_ROWS_KEY, limit)
    try:
        for number in range(2):
            scd_stream.apply_batch(as_log(spark, data[number::2]), number, path, KEYS, TRACKED, "at", ["id"])
    finally:
        spark.conf.unset(GROUP_ROWS_KEY)
    whole = scd.scd2_backfill(as_log(spark, data), KEYS, TRACKED, "at", ["id"])
    assert history_bag(scd_stream.read_history(spark, path, 1)) == history_bag(whole)


def test_groups_are_bounded_without_computing_the_joined_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    scd_stream.apply_batch(as_log(spark, [(1, "a", D1, 0), (2, "b", D1, 1)]), 0, path, KEYS, TRACKED, "at", ["id"])
    stored = []

    def kept(df, name="cut", cut=scd_stream.cut_lineage):
        stored.append(name)
        return cut(df, name)

    def counted(*_):
        raise AssertionError("the rows were computed to count their groups")

    monkeypatch.setattr(scd_stream, "cut_lineage", kept)
    monkeypatch.setattr(windows, "group_sizes", counted)
    scd_stream.apply_batch(as_log(spark, [(1, "c", D2, 2), (3, "d", D1, 3)]), 1, path, KEYS, TRACKED, "at", ["id"])
    assert stored == ["points", "places", "ends"]
    data = [(1, "a", D1, 0), (2, "b", D1, 1), (1, "c", D2, 2), (3, "d", D1, 3)]
    assert history_bag(scd_stream.read_history(spark, path, 1)) == walk(data)


def test_a_batch_that_fails_before_publishing_is_applied_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    scd_stream.apply_batch(as_log(spark, [(1, "a", D1, 0)]), 0, path, KEYS, TRACKED, "at", ["id"])
    second = as_log(spark, [(1, "b", D2, 1)])

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", lost)
        with pytest.raises(OSError):
            scd_stream.apply_batch(second, 1, path, KEYS, TRACKED, "at", ["id"])
    assert history_bag(scd_stream.read_history(spark, path, scd_stream.last_batch(spark, path))) == walk([(1, "a", D1, 0)])
    scd_stream.apply_batch(second, 1, path, KEYS, TRACKED, "at", ["id"])
    assert history_bag(scd_stream.read_history(spark, path, 1)) == walk([(1, "a", D1, 0), (1, "b", D2, 1)])


def test_satellite_ignores_unchanged_rows(dim, second, spark):
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sat = vault.load_satellite(src, ["k"], ["v"], "hk", D1, "x")
    again = vault.load_satellite(src, ["k"], ["v"], "hk", D2, "x", sat)
    assert again.count() == 0
    changed = vault.load_satellite(second, ["k"], ["v"], "hk", D2, "x", sat)
    assert changed.count() == 4


def test_satellite_of_several_states_without_an_order_fails_when_it_is_read(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    sat = vault.load_satellite(src, ["k"], ["v"], "hk", D1, "x")
    with pytest.raises(Exception, match="several states"):
        sat.collect()
    assert vault.load_satellite(src.where("k = 2"), ["k"], ["v"], "hk", D1, "x").count() == 1


def test_link_needs_two_hubs_and_hub_inserts_new_keys_only(spark):
    src = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k int, v string")
    hub = vault.load_hub(src, ["k"], "hk", D1, "x")
    assert hub.count() == 1
    assert vault.load_hub(src, ["k"], "hk", D2, "x", hub).count() == 0
    with pytest.raises(ValueError):
        vault.load_link(src, {"hk_a": ["k"]}, "hk", D1, "x")


def test_open_end_may_be_null(spark):
    df = spark.createDataFrame([(1,)], "k int").select(
        "k", ts(D1).alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")
    )
    assert scd.as_of(df, "2030-01-01 00:00:00").count() == 1
