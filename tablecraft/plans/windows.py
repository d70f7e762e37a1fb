"""Window functions and determinism audits."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tablecraft.functions.scalars import units
from tablecraft.operators import determinism as det
from tablecraft.operators import windows as w
from tablecraft.operators.star import opening_closing
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.sources.tables import read_table, rows

LATEST_SQL = """SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders"""


@query("dedup_latest", f"SELECT * REPLACE (CAST(rn AS INTEGER) AS rn) FROM ({LATEST_SQL}) WHERE rn = 1")
def dedup_latest(spark, d):
    return w.dedup_latest(
        read_table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate")], [F.desc("o_orderkey")]
    )


@query(
    "tie_monitor",
    """SELECT o_orderkey, o_custkey, o_orderdate, CAST(rn AS INTEGER) AS rn, _dq_tie_count,
              CASE WHEN _dq_tie_count > 1 THEN 'TIE_RESOLVED' ELSE 'NO_TIE' END
                AS _dq_determinism_status
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                         ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn,
                    count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS _dq_tie_count
             FROM orders) WHERE rn = 1""",
)
def tie_monitor(spark, d):
    return w.with_tie_monitor(
        read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
        ["o_custkey"], ["o_orderdate"], [F.desc("o_orderkey")],
    )


@query(
    "first_value_region",
    """SELECT c_custkey, c_nationkey, first_value(c_name) OVER (
         PARTITION BY c_nationkey ORDER BY c_custkey) AS representative FROM customer""",
)
def first_value_region(spark, d):
    customer = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_name"])
    return w.first_by(customer, ["c_nationkey"], ["c_custkey"], "c_name", "representative").drop(
        "c_name"
    )


@query(
    "rank_family",
    """SELECT o_orderkey,
              row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
                AS row_no,
              rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS rank_no,
              dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS dense_no,
              ntile(4) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
                AS quartile FROM orders""",
)
def rank_family(spark, d):
    df = read_table(spark, d, "orders", ["o_orderkey", "o_orderpriority", "o_orderdate"])
    df = w.rank_columns(
        df, ["o_orderpriority"], ["o_orderdate"], ["o_orderkey"],
        {"row_no": "row_number", "rank_no": "rank", "dense_no": "dense_rank", "quartile": "ntile"},
        buckets=4,
    )
    return df.select("o_orderkey", "row_no", "rank_no", "dense_no", "quartile")


@query(
    "nav_family",
    """SELECT event_id,
              lag(event_type) OVER s AS prev_type, lead(event_type) OVER s AS next_type,
              first_value(event_type) OVER g AS first_type,
              last_value(event_type) OVER g AS last_type,
              nth_value(event_type, 3) OVER g AS third_type
       FROM events
       WINDOW s AS (PARTITION BY user_id ORDER BY ts, event_id),
              g AS (PARTITION BY user_id ORDER BY ts, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def nav_family(spark, d):
    df = read_table(spark, d, "events", ["event_id", "user_id", "ts", "event_type"])
    kind = "event_type"
    df = w.navigate_columns(
        df, ["user_id"], ["ts", "event_id"],
        {"prev_type": ("lag", kind), "next_type": ("lead", kind), "first_type": ("first_value", kind),
         "last_type": ("last_value", kind), "third_type": ("nth_value", kind, 3)},
    )
    return df.select("event_id", "prev_type", "next_type", "first_type", "last_type", "third_type")


@query(
    "surrogate_sequence",
    """SELECT 1000 + row_number() OVER (ORDER BY c_name, c_custkey) AS customer_sk, c_custkey
       FROM customer""",
)
def surrogate_sequence(spark, d):
    customer = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    return w.assign_sk(customer, ["c_name", "c_custkey"], 1000, "customer_sk").drop("c_name")


BALANCE_SQL = f"""
  WITH {fx.LEDGER_SQL}
  SELECT account, txn_id, CAST(sum(amount) OVER (PARTITION BY account ORDER BY txn_ts, txn_id
           ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance FROM ledger"""


@query("running_balance", BALANCE_SQL)
def running_balance(spark, d):
    out = w.running_total(fx.ledger(spark, d), ["account"], ["txn_ts", "txn_id"], "amount", "balance")
    return out.select("account", "txn_id", units(F.col("balance")).alias("balance"))


@query(
    "opening_closing",
    f"""WITH {fx.LEDGER_SQL}, m AS (
          SELECT account, strftime(txn_ts, '%Y-%m') AS month, sum(amount) AS net
          FROM ledger GROUP BY 1, 2),
        c AS (SELECT *, sum(net) OVER (PARTITION BY account ORDER BY month
                ROWS UNBOUNDED PRECEDING) AS closing FROM m)
        SELECT account, month, CAST(closing - net AS DOUBLE) AS opening,
               CAST(closing AS DOUBLE) AS closing, CAST(net AS DOUBLE) AS net_change FROM c""",
)
def opening_closing_query(spark, d):
    ledger = fx.ledger(spark, d).withColumn("month", F.date_format("txn_ts", "yyyy-MM"))
    out = opening_closing(ledger, ["account"], "month", "amount")
    return out.select(
        "account", "month", *[units(F.col(c)).alias(c) for c in ("opening", "closing", "net_change")]
    )


# --------------------------------------------------------------- determinism


@query(
    "audit_order",
    """SELECT count(*) AS order_groups, count(*) FILTER (n > 1) AS tie_groups,
              CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_affected,
              max(n) AS largest_group, count(*) FILTER (n > 1) = 0 AS is_deterministic
       FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)""",
)
def audit_order(spark, d):
    return det.audit_order(
        read_table(spark, d, "orders", ["o_custkey", "o_orderdate"]), ["o_custkey"], ["o_orderdate"]
    )


CANDIDATES = ["o_orderkey", "o_totalprice", "o_orderpriority"]


@query(
    "rank_tie_breakers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS candidate, count(*) AS distinct_rows,
                   (SELECT count(*) FROM orders) AS total_rows,
                   count(*) = (SELECT count(*) FROM orders) AS is_unique
            FROM (SELECT DISTINCT o_custkey, o_orderdate, {c} FROM orders)"""
        for c in CANDIDATES
    ),
)
def rank_tie_breakers(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_orderdate", *CANDIDATES])
    return det.rank_tie_breakers(orders, ["o_custkey"], ["o_orderdate"], CANDIDATES)


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
ORDER_REST = ["o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderkey"]


def _sets_sql(table: str, columns: list[str], fixed: list[str], out: str) -> str:
    """Minimal unique sets by counting every subset."""
    parts = []
    for size in range(1, len(columns) + 1):
        for s in combinations(columns, size):
            names = "[" + ", ".join(f"'{c}'" for c in s) + "]"
            parts.append(
                f"SELECT {names} AS s, {size} AS n, (SELECT count(*) FROM (SELECT DISTINCT "
                f"{', '.join([*fixed, *s])} FROM {table})) = (SELECT count(*) FROM {table}) AS u"
            )
    return f"""WITH sets AS ({' UNION ALL '.join(parts)})
        SELECT list_aggregate(s, 'string_agg', ',') AS {out}, CAST(n AS INTEGER) AS size FROM sets a
        WHERE u AND NOT EXISTS (SELECT 1 FROM sets b WHERE b.u AND b.n < a.n AND list_has_all(a.s, b.s))"""


@query("composite_keys", _sets_sql("lineitem", LINE_COLUMNS, [], "key_columns"))
def composite_keys(spark, d):
    """Every minimal set of columns that identifies a line item."""
    lines = read_table(spark, d, "lineitem", LINE_COLUMNS)
    found = det.unique_sets(lines, LINE_COLUMNS)
    return rows(spark, [(",".join(s), len(s)) for s in found], "key_columns string, size int")


@query("composite_tie_breakers", _sets_sql("orders", ORDER_REST, ["o_custkey", "o_orderdate"], "columns"))
def composite_tie_breakers(spark, d):
    """Columns that make the orders of a customer and day distinct, alone or together."""
    orders = read_table(spark, d, "orders", ["o_custkey", "o_orderdate", *ORDER_REST])
    found = det.composite_tie_breakers(orders, ["o_custkey"], ["o_orderdate"], ORDER_REST)
    return found.select(F.array_join("columns", ",").alias("columns"), "size")


@query(
    "seeded_sample",
    """SELECT c_custkey, CAST(('0x' || substring(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT
                              % 100 AS BIGINT) AS sample_bucket FROM customer
       WHERE ('0x' || substring(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 10""",
)
def seeded_sample(spark, d):
    return w.sample_hash(read_table(spark, d, "customer", ["c_custkey"]), "c_custkey", 100, 10)
