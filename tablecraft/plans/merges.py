"""Merges into versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import scd
from tablecraft.plans import fixtures as fx
from tablecraft.plans.history import HISTORY_OUT, KEY
from tablecraft.plans.registry import query
from tablecraft.session import work_path
from tablecraft.sources import versions
from tablecraft.sources.tables import read_table

VERSION_KEY = [*KEY, "valid_from"]


@query("merge_scd2", f"WITH {fx.HISTORY_SQL} SELECT {HISTORY_OUT} FROM history")
def merge_scd2(spark, d):
    """A dimension merged incrementally: closed and new versions reach the files they touch."""
    path = work_path(spark, "merge-scd2")
    versions.create(scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), KEY, fx.DAY_1), path, VERSION_KEY)
    dim = versions.read(spark, path, VERSION_KEY)
    load = scd.scd2_delta(
        dim, fx.snapshot(spark, d, fx.DAY_2), KEY, fx.TRACKED, fx.DAY_2, unique_source=True
    )
    versions.merge(load, path, VERSION_KEY)
    return fx.with_text_stamps(versions.read(spark, path, VERSION_KEY))


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]


def _order_loads(spark, d):
    """Orders up to 1997 as first loaded, all open; then two loads of what became of them."""
    orders = read_table(spark, d, "orders", ORDER_COLUMNS)
    opened = orders.filter("o_orderdate < '1997-01-01'").withColumn("o_orderstatus", F.lit("O"))
    settled = orders.filter("o_orderdate >= '1994-07-01' AND o_orderdate < '1997-01-01'")
    late = orders.filter("o_orderdate >= '1996-10-01'").withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return opened, settled, late


ORDERS_AFTER_SQL = """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderdate >= DATE '1996-10-01' THEN lower(o_orderstatus)
              WHEN o_orderdate >= DATE '1994-07-01' THEN o_orderstatus ELSE 'O' END AS o_orderstatus,
         strftime(o_orderdate, '%Y-%m-%d') AS ordered
  FROM orders"""


def _ordered_on(df):
    return df.withColumn("ordered", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


@query("merge_runs", ORDERS_AFTER_SQL)
def merge_runs(spark, d):
    """Loads appended as runs and read over the base."""
    path = work_path(spark, "merge-runs")
    first, *loads = _order_loads(spark, d)
    versions.create(first, path, ["o_orderkey"])
    for load in loads:
        versions.merge(load, path, ["o_orderkey"], how="append")
    return _ordered_on(versions.read(spark, path, ["o_orderkey"]))


@query("merge_compacted", ORDERS_AFTER_SQL)
def merge_compacted(spark, d):
    """The same after the runs were folded into the base files that they touch."""
    path = work_path(spark, "merge-compacted")
    first, *loads = _order_loads(spark, d)
    versions.create(first, path, ["o_orderkey"])
    for load in loads:
        versions.merge(load, path, ["o_orderkey"], how="append")
    versions.compact(spark, path, ["o_orderkey"])
    return _ordered_on(versions.read(spark, path, ["o_orderkey"]))


@query(
    "merge_ignore",
    """SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderdate < DATE '1997-01-01' THEN 'O' ELSE lower(o_orderstatus) END
                AS o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS ordered FROM orders""",
)
def merge_ignore(spark, d):
    """New orders only; a known one keeps its row."""
    path = work_path(spark, "merge-ignore")
    first, _, late = _order_loads(spark, d)
    versions.create(first, path, ["o_orderkey"])
    versions.merge(late, path, ["o_orderkey"], mode="ignore")
    return _ordered_on(versions.read(spark, path, ["o_orderkey"]))


@query(
    "merge_old_version",
    """SELECT o_orderkey, o_custkey, 'O' AS o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS ordered
       FROM orders WHERE o_orderdate < DATE '1997-01-01'""",
)
def merge_old_version(spark, d):
    """The version before a merge, read after it."""
    path = work_path(spark, "merge-old")
    first, settled, _ = _order_loads(spark, d)
    versions.create(first, path, ["o_orderkey"])
    versions.merge(settled, path, ["o_orderkey"])
    return _ordered_on(versions.read(spark, path, ["o_orderkey"], 0))
