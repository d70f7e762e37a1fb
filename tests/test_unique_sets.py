"""Minimal unique column sets against all subsets, and sketches against exact counts."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import determinism as det
from tablecraft.plans import catalogs
from tablecraft.sources import profiles, tables


def brute(rows, names, fixed=()):
    at = {n: i for i, n in enumerate(names)}
    found = []
    for size in range(len(names) + 1):
        for s in combinations([n for n in names if n not in fixed], size):
            if any(set(u) <= set(s) for u in found):
                continue
            if len({tuple(r[at[c]] for c in [*fixed, *s]) for r in rows}) == len(rows):
                found.append(s)
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_sets_of_eight_columns(spark, seed):
    rnd = random.Random(seed)
    names = [f"c{i}" for i in range(8)]
    widths = [2, 3, 4, 5, 8, 12, 20, 40]
    rows = list({tuple(rnd.choice([None, *range(w)]) for w in widths) for _ in range(300)})
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    assert sorted(det.unique_sets(df, names)) == brute(rows, names)
    assert sorted(det.unique_sets(df, names[:6], ["c7"])) == [s for s in brute(rows, names, ("c7",)) if "c6" not in s]


def test_repeated_rows_have_no_set_and_one_row_needs_none(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert det.unique_sets(df, ["x", "y"]) == []
    assert det.unique_sets(df.limit(1), ["x", "y"]) == [()]
    assert det.unique_sets(df.where("x = 2"), ["x", "y"]) == [()]


def test_tie_breakers_that_need_two_columns(spark):
    rows = [(p, t, a, b, 0) for p in range(3) for t in range(2) for a in range(3) for b in range(3)]
    df = spark.createDataFrame(rows, "p int, t int, a int, b int, z int")
    got = det.composite_tie_breakers(df, ["p"], ["t"], ["a", "b", "z"]).collect()
    assert [(r["columns"], r["size"]) for r in got] == [(["a", "b"], 2)]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(30_000).select(
        F.col("id"), (F.col("id") % 5_000).alias("v"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("name"), F.col("id") % 7)).alias("s"),
        (F.col("id") / 10).alias("x"), F.array(F.col("id") % 11).alias("a"),
    )
    df.repartition(3).write.parquet(path)
    return df, path


def test_estimates_are_within_their_error_and_keys_are_exact(spark, table, tmp_path):
    df, path = table
    store = str(tmp_path / "profiles")
    assert profiles.update(spark, {"t": path}, store) == 3
    rows = {r["column_name"]: r for r in profiles.with_keys(spark, {"t": path}, profiles.summary(spark, {"t": path}, store)).collect()}
    for name, true in {"id": 30_000, "v": 5_000, "s": 7, "x": 30_000, "a": 11}.items():
        assert abs(rows[name]["distinct_estimate"] - true) <= true * profiles.DISTINCT_ERROR + 0.5
        assert rows[name]["is_unique"] == (name in ("id", "x"))
    assert rows["s"]["null_count"] == df.where("s IS NULL").count() and rows["s"]["quantiles"] is None
    for q, value in zip(profiles.QUANTILES, rows["id"]["quantiles"]):
        assert abs(value / 30_000 - q) <= profiles.RANK_ERROR
    assert {f["item"][:4] for f in rows["s"]["frequent"] if f["item"]} == {"name"}
    exact = {r["column_name"]: r["distinct_count"] for r in tables.profile({"t": spark.read.parquet(path)}).collect()}
    assert exact["v"] == 5_000


def test_only_new_files_are_read(spark, table, tmp_path):
    df, path = table
    store = str(tmp_path / "profiles")
    profiles.update(spark, {"t": path}, store)
    assert profiles.update(spark, {"t": path}, store) == 0
    df.where("id < 100").selectExpr("id + 30000 AS id", "v", "s", "x + 30000 AS x", "a").coalesce(1).write.mode("append").parquet(path)
    assert profiles.update(spark, {"t": path}, store) == 1
    row = profiles.summary(spark, {"t": path}, store).where("column_name = 'id'").first()
    assert row["row_count"] == 30_100 and abs(row["distinct_estimate"] - 30_100) < 30_100 * profiles.DISTINCT_ERROR


def test_unique_columns_of_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (3, "b", 2.0)], "k int, s string, x double")
    assert tables.unique_columns({"t": df, "none": df.where("k > 9")}) == {"t": {"k"}, "none": set()}


def test_of_a_derived_table_only_several_possible_keys_are_stored(spark, monkeypatch):
    stored = []

    def kept(df, name="cut"):
        stored.append((name, df.columns))
        return df

    monkeypatch.setattr(tables, "cut_lineage", kept)
    df = spark.range(50).selectExpr("id AS k", "id % 3 AS v", "concat('n', id) AS s", "id + 0.5 AS x")
    made = {"none": df.select("v"), "one": df.select("v", "k"), "more": df, "given": df}
    found = tables.unique_columns(made, derived=["none", "one", "more"])
    assert found == {"none": set(), "one": {"k"}, "more": {"k", "s", "x"}, "given": {"k", "s", "x"}}
    assert stored == [("more", ["k", "s", "x"])]


def test_the_fact_is_not_stored_to_find_that_it_has_no_key(spark, tmp_path, monkeypatch):
    day = "timestamp_ntz'1996-01-01'"
    made = {
        "customer": "id AS c_custkey; concat('c', id) AS c_name; 1 AS c_nationkey; 1.5D AS c_acctbal; 'm' AS c_mktsegment",
        "supplier": "id AS s_suppkey; 's' AS s_name; 1 AS s_nationkey; 1.5D AS s_acctbal",
        "part": "id AS p_partkey; 'p' AS p_name; 'b' AS p_brand; 't' AS p_type; 1 AS p_size; 1.5D AS p_retailprice",
        "orders": f"id AS o_orderkey; id % 4 AS o_custkey; 'F' AS o_orderstatus; 9D AS o_totalprice; {day} AS o_orderdate; '1' AS o_orderpriority",
        "lineitem": "id AS l_orderkey; id % 5 AS l_partkey; id % 2 AS l_suppkey; 3D AS l_quantity; 2D AS l_extendedprice; 0D AS l_discount",
        "events": f"id AS event_id; {day} AS ts; id % 3 AS user_id; 'a' AS event_type; 1D AS value; 'x' AS props",
    }
    for name, columns in made.items():
        spark.range(12).selectExpr(*columns.split("; ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    stored = []
    for module in (catalogs, tables):
        monkeypatch.setattr(module, "cut_lineage", lambda df, name="cut": stored.append(name) or df)
    found = catalogs.built_catalog(spark, str(tmp_path)).where("is_primary_key").collect()
    assert {(r["table_name"], r["column_name"]) for r in found if r["table_name"] in catalogs.MEASURED} == {
        ("dim_customer", "c_custkey"), ("customer", "c_custkey"), ("orders", "o_orderkey"), ("events", "event_id")
    }
    assert stored == ["dim_customer"]


def test_lookups_are_computed_only_where_the_core_leaves_a_column(spark):
    core = spark.range(50).selectExpr("id % 3 AS v", "id AS k")
    never = core.selectExpr("CAST(raise_error('computed') AS bigint) AS sk", "v")
    # 49 values on 50 rows
    assert tables.unique_columns({"t": never}, ["t"], {"t": (core.select("v"), {"sk": 49})}) == {"t": set()}
    members = spark.range(50).selectExpr("id AS d", "id + 100 AS sk")

    def found(dim, rows=core):
        whole = rows.join(dim, F.col("k") == F.col("d"), "left").select("sk", "v", "k")
        return tables.unique_columns({"t": whole}, cores={"t": (rows, {"sk": 51})})["t"]

    assert found(members) == {"sk", "k"}
    assert found(members.unionByName(members.where("d = 7"))) == set()  # the lookup repeats a row
    assert found(members.where("d > 7")) == {"k"}
    assert found(members, core.where("k > 99")) == set()


def test_the_lookups_of_the_fact_are_not_computed_to_find_that_it_has_no_key(spark, tmp_path, monkeypatch):
    day = "timestamp_ntz'1996-01-01'"
    made = {
        "customer": "id AS c_custkey; concat('c', id) AS c_name; 1 AS c_nationkey; 1.5D AS c_acctbal; 'm' AS c_mktsegment",
        "supplier": "id AS s_suppkey; 's' AS s_name; 1 AS s_nationkey; 1.5D AS s_acctbal",
        "part": "id AS p_partkey; 'p' AS p_name; 'b' AS p_brand; 't' AS p_type; 1 AS p_size; 1.5D AS p_retailprice",
        "orders": f"id AS o_orderkey; id % 4 AS o_custkey; 'F' AS o_orderstatus; 9D AS o_totalprice; {day} AS o_orderdate; '1' AS o_orderpriority",
        "lineitem": "id % 12 AS l_orderkey; id % 5 AS l_partkey; id % 2 AS l_suppkey; 3D AS l_quantity; 2D AS l_extendedprice; 0D AS l_discount",
        "events": f"id AS event_id; {day} AS ts; id % 3 AS user_id; 'a' AS event_type; 1D AS value; 'x' AS props",
    }
    for name, columns in made.items():
        lines = 40 if name == "lineitem" else 12
        spark.range(lines).selectExpr(*columns.split("; ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    fact = catalogs.fact_sales

    def never(*args):
        return fact(*args).withColumn("part_sk", F.raise_error(F.lit("computed")).cast("long"))

    monkeypatch.setattr(catalogs, "fact_sales", never)
    keys = catalogs.built_catalog(spark, str(tmp_path)).where("is_primary_key").collect()
    assert {r["column_name"] for r in keys if r["table_name"] in catalogs.MEASURED} == {
        "c_custkey", "o_orderkey", "event_id"
    }
    assert not [r for r in keys if r["table_name"] == "fact_sales"]


def test_a_join_is_computed_only_where_the_joined_tables_leave_a_column(spark):
    lines = spark.createDataFrame([(i % 10, i % 3, i) for i in range(40)], "k long, v long, w long")
    orders = spark.createDataFrame([(i, 100 + i) for i in range(10)], "o long, x long")

    def found(lines, orders, core=None):
        core = core or lines.join(orders, F.col("k") == F.col("o")).select("v", "w", "x")
        parts = [orders.select("x"), lines.select("v", "w")], tables.joined_rows(lines, orders, "k", "o")
        whole = core.selectExpr("1L AS sk", "*")
        return tables.unique_columns({"t": whole}, ["t"], {"t": (core, {"sk": 1})}, {"t": parts})["t"]

    never = lines.selectExpr("CAST(raise_error('computed') AS bigint) AS v", "w", "1L AS x")
    few = lines.withColumn("w", F.col("w") % 39)  # 39 values in 40 rows
    assert found(few, orders, never) == set()
    assert found(lines, orders) == {"w"}
    assert found(lines, orders.unionByName(orders.where("o = 3"))) == set()  # lines 3, 13, 23, 33 twice
    # lines that meet no order take their NULL and repeated values with them
    lost = spark.createDataFrame([(77, None, None), (78, 1, 5), (None, 1, 5)], "k long, v long, w long")
    assert found(lines.unionByName(lost), orders) == {"w"}
    assert found(lines.unionByName(lost), orders.where("o = 4").withColumn("x", F.lit(None).cast("long"))) == {"w"}
    assert found(lines.where("w < 2").unionByName(lost), orders) == {"v", "w", "x"}
    assert found(lines.where("w < 2").withColumn("w", F.nullif("w", F.lit(1))), orders) == {"v", "x"}
    assert found(lines, orders.where("o > 99")) == set()


def test_joined_rows_are_counted_per_key(spark):
    left = spark.createDataFrame([(k,) for k in [1, 1, 1, 2, 3, 3, None, None]], "a long")
    right = spark.createDataFrame([(k,) for k in [1, 1, 3, 4, None]], "b long")
    assert tables.joined_rows(left, right, "a", "b").collect()[0]["rows"] == 8
    assert tables.joined_rows(left, right.where("b = 4"), "a", "b").collect()[0]["rows"] == 0


def test_the_lines_do_not_meet_their_orders_to_find_that_the_fact_has_no_key(spark, tmp_path, monkeypatch):
    day = "timestamp_ntz'1996-01-01'"
    made = {
        "customer": "id AS c_custkey; concat('c', id) AS c_name; 1 AS c_nationkey; 1.5D AS c_acctbal; 'm' AS c_mktsegment",
        "supplier": "id AS s_suppkey; 's' AS s_name; 1 AS s_nationkey; 1.5D AS s_acctbal",
        "part": "id AS p_partkey; 'p' AS p_name; 'b' AS p_brand; 't' AS p_type; 1 AS p_size; 1.5D AS p_retailprice",
        "orders": f"id AS o_orderkey; id % 4 AS o_custkey; 'F' AS o_orderstatus; 9D AS o_totalprice; {day} AS o_orderdate; '1' AS o_orderpriority",
        "lineitem": "id % 13 AS l_orderkey; id % 5 AS l_partkey; id % 2 AS l_suppkey; 3D AS l_quantity; 2D AS l_extendedprice; 0D AS l_discount",
        "events": f"id AS event_id; {day} AS ts; id % 3 AS user_id; 'a' AS event_type; 1D AS value; 'x' AS props",
    }
    for name, columns in made.items():
        lines = 40 if name == "lineitem" else 12
        spark.range(lines).selectExpr(*columns.split("; ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    core = catalogs.sales_core

    def never(*args):
        return core(*args).withColumn("quantity", F.raise_error(F.lit("computed")).cast("double"))

    monkeypatch.setattr(catalogs, "sales_core", never)
    keys = catalogs.built_catalog(spark, str(tmp_path)).where("is_primary_key").collect()
    assert {r["column_name"] for r in keys if r["table_name"] in catalogs.MEASURED} == {
        "c_custkey", "o_orderkey", "event_id"
    }
    assert not [r for r in keys if r["table_name"] == "fact_sales"]
