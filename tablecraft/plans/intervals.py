"""Joins over histories that overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators.joins import interval_join, overlap_join
from tablecraft.plans.registry import query
from tablecraft.sources.tables import read_table


def _open_orders(spark, d):
    """From its date to its last shipment an order is open; those of a customer overlap."""
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_shipdate"])
    shipped = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed_at"))
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return orders.join(shipped, orders["o_orderkey"] == shipped["l_orderkey"]).select(
        F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("open_order"),
        F.col("o_orderdate").alias("opened_at"), "closed_at",
    )


OPEN_SQL = """open_orders AS (
    SELECT o_custkey AS customer, o_orderkey AS open_order, o_orderdate AS opened_at, closed_at
    FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS closed_at FROM lineitem GROUP BY 1)
      ON o_orderkey = l_orderkey)"""


@query(
    "interval_hits",
    f"""WITH {OPEN_SQL}
        SELECT o_orderkey, count(*) AS open_orders, min(open_order) AS first_open
        FROM orders JOIN open_orders ON o_custkey = customer AND opened_at <= o_orderdate
          AND o_orderdate < closed_at GROUP BY 1""",
)
def interval_hits(spark, d):
    """How many orders of its customer were open when an order came."""
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    points = orders.withColumnRenamed("o_custkey", "customer")
    hits = interval_join(points, _open_orders(spark, d), ["customer"], "o_orderdate", "opened_at", "closed_at")
    return hits.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("open_orders"), F.min("open_order").alias("first_open")
    )


@query(
    "interval_overlaps",
    f"""WITH {OPEN_SQL}
        SELECT a.customer, a.open_order, b.open_order AS other_open_order FROM open_orders a
        JOIN open_orders b ON a.customer = b.customer AND a.open_order < b.open_order
          AND greatest(a.opened_at, b.opened_at) < least(a.closed_at, b.closed_at)""",
)
def interval_overlaps(spark, d):
    """Pairs of orders of a customer that were open at once."""
    orders = _open_orders(spark, d)
    pairs = overlap_join(orders, orders, ["customer"], "opened_at", "closed_at")
    return pairs.where("open_order < other_open_order").select("customer", "open_order", "other_open_order")


@query(
    "interval_user_events",
    """SELECT a.event_id, count(*) AS within_two_days FROM events a JOIN events b
       ON a.user_id = b.user_id AND b.ts <= a.ts AND a.ts < b.ts + INTERVAL 2 DAY GROUP BY 1""",
)
def interval_user_events(spark, d):
    """Events of the same user in the two days up to each event, itself included."""
    events = read_table(spark, d, "events", ["event_id", "user_id", "ts"])
    spans = events.select(
        F.col("user_id"), F.col("event_id").alias("earlier"), F.col("ts").alias("begun"),
        (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("over"),
    )
    return interval_join(events, spans, ["user_id"], "ts", "begun", "over").groupBy("event_id").agg(
        F.count(F.lit(1)).alias("within_two_days")
    )
