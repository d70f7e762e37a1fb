"""Inputs derived from the given tables, as DataFrames and as the same in SQL.

Every frame has a ``*_SQL`` twin: the body of a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.functions.scalars import cents, ts
from tablecraft.operators.windows import dedup_latest
from tablecraft.sources.tables import read_table

DAY_1 = "1997-01-01 00:00:00"
DAY_2 = "1999-01-01 00:00:00"
DAY_3 = "2001-01-01 00:00:00"
TRACKED = ["last_priority", "last_status"]


def snapshot(spark: SparkSession, d: str, day: str, null_value: str | None = None) -> DataFrame:
    """Customers known before ``day`` with the priority and status of their last order."""
    orders = read_table(
        spark, d, "orders",
        ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"],
    ).filter(F.col("o_orderdate") < ts(day))
    last = dedup_latest(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    customers = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    priority = F.col("o_orderpriority")
    if null_value is not None:
        priority = F.nullif(priority, F.lit(null_value))
    return customers.join(last, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        priority.alias("last_priority"),
        F.col("o_orderstatus").alias("last_status"),
    )


def snapshot_sql(day: str, null_value: str | None = None) -> str:
    priority = "o_orderpriority"
    if null_value is not None:
        priority = f"nullif(o_orderpriority, '{null_value}')"
    return f"""
      SELECT c_custkey, c_name, c_mktsegment, {priority} AS last_priority,
             o_orderstatus AS last_status
      FROM customer JOIN (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate < TIMESTAMP '{day}') ON c_custkey = o_custkey AND rn = 1"""


NULL_PRIORITY = "4-NOT SPECIFIED"
SNAPSHOTS_SQL = f"""
  snapshot_1 AS ({snapshot_sql(DAY_1)}),
  snapshot_2 AS ({snapshot_sql(DAY_2)}),
  snapshot_2_nulls AS ({snapshot_sql(DAY_2, NULL_PRIORITY)})"""

# History after an initial load of snapshot_1 and one load of snapshot_2.
HISTORY_SQL = f"""
  {SNAPSHOTS_SQL.strip()},
  pair AS (
    SELECT coalesce(a.c_custkey, b.c_custkey) AS k, a.c_custkey IS NOT NULL AS known,
           b.c_custkey IS NOT NULL AS given, a.c_name AS a_name, a.c_mktsegment AS a_seg,
           a.last_priority AS a_pri, a.last_status AS a_sta, b.c_name AS b_name,
           b.c_mktsegment AS b_seg, b.last_priority AS b_pri, b.last_status AS b_sta,
           a.last_priority IS DISTINCT FROM b.last_priority
             OR a.last_status IS DISTINCT FROM b.last_status AS differ
    FROM snapshot_1 a FULL JOIN snapshot_2 b ON a.c_custkey = b.c_custkey),
  history AS (
    SELECT k AS c_custkey, a_name AS c_name, a_seg AS c_mktsegment, a_pri AS last_priority,
           a_sta AS last_status, TIMESTAMP '{DAY_1}' AS valid_from,
           CASE WHEN given AND differ THEN TIMESTAMP '{DAY_2}'
                ELSE TIMESTAMP '9999-12-31 23:59:59' END AS valid_to,
           NOT (given AND differ) AS is_current
    FROM pair WHERE known
    UNION ALL
    SELECT k, b_name, b_seg, b_pri, b_sta, TIMESTAMP '{DAY_2}',
           TIMESTAMP '9999-12-31 23:59:59', true
    FROM pair WHERE given AND (NOT known OR differ))"""


def ledger(spark: SparkSession, d: str) -> DataFrame:
    """Orders as account transactions in cents; finished orders are debits."""
    orders = read_table(
        spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    )
    price = cents(F.col("o_totalprice"))
    return orders.select(
        F.col("o_custkey").alias("account"),
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_orderdate").alias("txn_ts"),
        F.when(F.col("o_orderstatus") == "F", -price).otherwise(price).alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


LEDGER_SQL = """
  ledger AS (
    SELECT o_custkey AS account, o_orderkey AS txn_id, o_orderdate AS txn_ts,
           CAST(CASE WHEN o_orderstatus = 'F' THEN -CAST(o_totalprice AS DECIMAL(18,2))
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS amount,
           o_orderstatus AS status
    FROM orders)"""


def defects(spark: SparkSession, d: str) -> DataFrame:
    """Orders with injected faults: lost customers, NULL and unknown status, copies."""
    orders = read_table(spark, d, "orders")
    day = F.dayofmonth("o_orderdate")
    copies = orders.filter((F.col("o_orderpriority") == "1-URGENT") & (day == 1))
    status = (
        F.when(F.col("o_totalprice") < 5000, F.lit(None))
        .when(F.col("o_totalprice") > 495000, "X")
        .otherwise(F.col("o_orderstatus"))
    )
    faulty = orders.unionByName(copies)
    return faulty.withColumn(
        "o_custkey", F.when(day == 13, F.lit(-1).cast("long")).otherwise(F.col("o_custkey"))
    ).withColumn("o_orderstatus", status)


DEFECTS_SQL = """
  defects AS (
    SELECT o_orderkey, CASE WHEN day(o_orderdate) = 13 THEN -1 ELSE o_custkey END AS o_custkey,
           CASE WHEN o_totalprice < 5000 THEN NULL WHEN o_totalprice > 495000 THEN 'X'
                ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM (SELECT * FROM orders UNION ALL
          SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND day(o_orderdate) = 1))"""


def fact_rows(spark: SparkSession, d: str) -> DataFrame:
    """Line items with quantity, price and discount in whole hundredths."""
    lines = read_table(
        spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                               "l_extendedprice", "l_discount"],
    )
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        cents(F.col("l_quantity")).alias("quantity"),
        cents(F.col("l_extendedprice")).alias("price"),
        cents(F.col("l_discount")).alias("discount"),
    )


FACT_ROWS_SQL = """
  fact_rows AS (
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(l_discount AS DECIMAL(18,2)) AS discount
    FROM lineitem)"""


def with_text_stamps(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as text, so the year 9999 survives every client."""
    for c in cols or ("valid_from", "valid_to"):
        df = df.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return df


STAMP = "%Y-%m-%d %H:%M:%S"


def stamp_sql(col: str) -> str:
    return f"strftime({col}, '{STAMP}')"
