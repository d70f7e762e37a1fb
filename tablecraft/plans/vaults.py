"""Data Vault loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions.scalars import hash_of
from tablecraft.operators import vault
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.sources.tables import read_table

SOURCE = "crm"


def hub_customer(spark, d):
    """Two loads of the customer hub."""
    def load(day, hub=None):
        src = fx.snapshot(spark, d, day).withColumnRenamed("c_name", "customer_bk")
        return vault.load_hub(src, ["customer_bk"], "hk_customer", day, SOURCE, hub)

    first = load(fx.DAY_1)
    return first.unionByName(load(fx.DAY_2, first))


HUB_SQL = f"""
  hub_customer AS (
    SELECT sha256(c_name) AS hk_customer, c_name AS customer_bk, min(day) AS load_date,
           'crm' AS record_source
    FROM (SELECT c_name, TIMESTAMP '{fx.DAY_1}' AS day FROM snapshot_1
          UNION ALL SELECT c_name, TIMESTAMP '{fx.DAY_2}' FROM snapshot_2)
    GROUP BY c_name)"""


@query("dv_hub_customer", f"WITH {fx.SNAPSHOTS_SQL}, {HUB_SQL} SELECT * FROM hub_customer")
def dv_hub_customer(spark, d):
    return hub_customer(spark, d)


def link_rows(orders):
    src = orders.select(
        F.col("o_orderkey").alias("order_bk"), F.col("o_custkey").alias("customer_bk")
    )
    return vault.load_link(
        src, {"hk_order": ["order_bk"], "hk_customer": ["customer_bk"]}, "hk_order_customer",
        fx.DAY_1, SOURCE,
    )


LINK_SQL = f"""
  SELECT DISTINCT sha256(CAST(o_orderkey AS VARCHAR) || '||' || CAST(o_custkey AS VARCHAR))
           AS hk_order_customer, sha256(CAST(o_orderkey AS VARCHAR)) AS hk_order,
         sha256(CAST(o_custkey AS VARCHAR)) AS hk_customer, TIMESTAMP '{fx.DAY_1}' AS load_date,
         'crm' AS record_source"""


@query("dv_link_order_customer", f"{LINK_SQL} FROM orders")
def dv_link_order_customer(spark, d):
    return link_rows(read_table(spark, d, "orders", ["o_orderkey", "o_custkey"]))


def sat_customer(spark, d):
    """Two loads of the customer satellite; the second adds changed rows only."""
    attrs = ["c_mktsegment", *fx.TRACKED]

    def load(day, sat=None):
        return vault.load_satellite(
            fx.snapshot(spark, d, day), ["c_name"], attrs, "hk_customer", day, SOURCE, sat
        )

    first = load(fx.DAY_1)
    return first.unionByName(load(fx.DAY_2, first))


DIFF_SQL = "sha256(c_mktsegment || '||' || last_priority || '||' || last_status)"
SAT_SQL = f"""
  loads AS (
    SELECT sha256(c_name) AS hk_customer, TIMESTAMP '{fx.DAY_1}' AS load_date, c_mktsegment,
           last_priority, last_status, {DIFF_SQL} AS hash_diff FROM snapshot_1
    UNION ALL SELECT sha256(c_name), TIMESTAMP '{fx.DAY_2}', c_mktsegment, last_priority,
           last_status, {DIFF_SQL} FROM snapshot_2),
  sat_customer AS (
    SELECT * EXCLUDE (before), 'crm' AS record_source FROM (
      SELECT *, lag(hash_diff) OVER (PARTITION BY hk_customer ORDER BY load_date) AS before
      FROM loads) WHERE before IS DISTINCT FROM hash_diff)"""


@query("dv_sat_customer", f"WITH {fx.SNAPSHOTS_SQL}, {SAT_SQL} SELECT * FROM sat_customer")
def dv_sat_customer(spark, d):
    return sat_customer(spark, d)


@query(
    "dv_sat_from_log",
    """SELECT hk_user, load_date, hash_diff FROM (
         SELECT sha256(CAST(user_id AS VARCHAR)) AS hk_user, ts AS load_date,
                sha256(event_type) AS hash_diff,
                lag(sha256(event_type)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
         FROM events) WHERE before IS DISTINCT FROM hash_diff""",
)
def dv_sat_from_log(spark, d):
    events = read_table(spark, d, "events", ["user_id", "ts", "event_type"])
    log = events.select(
        hash_of(["user_id"]).alias("hk_user"), F.col("ts").alias("load_date"),
        hash_of(["event_type"]).alias("hash_diff"),
    )
    return vault.satellite_from_log(log, "hk_user", "load_date")


def _lost_sql(rule, table, column, parent, child_sql, parent_sql) -> str:
    return f"""SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name,
      '{parent}' AS parent, count(*) FILTER (p IS NULL) AS failed_rows, count(*) AS total_rows
      FROM ({child_sql}) LEFT JOIN (SELECT DISTINCT * FROM ({parent_sql})) ON k = p"""


LINK_OF_DEFECTS = f"SELECT * FROM ({LINK_SQL} FROM defects)"
HUB_C, HUB_O = (
    f"SELECT sha256(CAST({c} AS VARCHAR)) AS {{0}} FROM {t}"
    for c, t in (("c_custkey", "customer"), ("o_orderkey", "orders"))
)
SAT_KEYS = "SELECT sha256(CAST(c_custkey AS VARCHAR)) AS {0} FROM snapshot_1"


@query(
    "dv_validate",
    f"WITH {fx.DEFECTS_SQL}, {fx.SNAPSHOTS_SQL} "
    + " UNION ALL ".join(
        [
            _lost_sql("link_hub", "link_order_customer", "hk_order", "hub_order",
                      f"SELECT hk_order AS k FROM ({LINK_OF_DEFECTS})", HUB_O.format("p")),
            _lost_sql("link_hub", "link_order_customer", "hk_customer", "hub_customer",
                      f"SELECT hk_customer AS k FROM ({LINK_OF_DEFECTS})", HUB_C.format("p")),
            _lost_sql("satellite_hub", "sat_customer", "hk_customer", "hub_customer",
                      SAT_KEYS.format("k"), HUB_C.format("p")),
            _lost_sql("hub_satellite", "hub_customer", "hk_customer", "sat_customer",
                      HUB_C.format("k"), SAT_KEYS.format("p")),
        ]
    ),
)
def dv_validate(spark, d):
    """Link rows of faulty orders against clean hubs, and a partial satellite."""
    def hub(table, key, name):
        src = read_table(spark, d, table, [key]).withColumnRenamed(key, "bk")
        return vault.load_hub(src, ["bk"], name, fx.DAY_1, SOURCE)

    hubs = {
        "hub_customer": (hub("customer", "c_custkey", "hk_customer"), "hk_customer"),
        "hub_order": (hub("orders", "o_orderkey", "hk_order"), "hk_order"),
    }
    links = {
        "link_order_customer": (
            link_rows(fx.defects(spark, d)), {"hk_order": "hub_order", "hk_customer": "hub_customer"}
        )
    }
    sat = vault.load_satellite(
        fx.snapshot(spark, d, fx.DAY_1), ["c_custkey"], fx.TRACKED, "hk_customer", fx.DAY_1, SOURCE
    )
    return vault.check_vault(hubs, links, {"sat_customer": (sat, "hk_customer", "hub_customer")})
