"""Scans, sinks, filters, joins, aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions.scalars import (
    avg_cents,
    band,
    cents,
    contains_ci,
    differs,
    ts,
    units,
    wide_sum,
)
from tablecraft.operators import aggregates as agg
from tablecraft.operators import joins, setops
from tablecraft.operators.projections import (
    apply_mappings,
    derive_entity,
    exclude_values,
    project,
    since,
)
from tablecraft.operators.windows import sample_mod
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.session import cut_lineage, work_path
from tablecraft.sources.sinks import materialise, upsert, write_fact
from tablecraft.sources.tables import read_table, rows, run_stages

# --------------------------------------------------------------- scans, sinks


@query("scan_prune", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_prune(spark, d):
    return read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])


STATUS_NAMES = [("F", "finished"), ("O", "open"), ("P", "pending")]


@query(
    "inline_rows",
    """SELECT status_name, count(*) AS orders
       FROM orders JOIN (VALUES ('F','finished'),('O','open'),('P','pending'))
            v(status, status_name) ON o_orderstatus = status
       GROUP BY status_name""",
)
def inline_rows(spark, d):
    names = rows(spark, STATUS_NAMES, "status string, status_name string")
    counts = read_table(spark, d, "orders", ["o_orderstatus"]).groupBy("o_orderstatus").count()
    return (
        counts.join(names, F.col("o_orderstatus") == F.col("status"))
        .groupBy("status_name")
        .agg(F.sum("count").alias("orders"))
    )


@query(
    "stage_chain",
    """WITH order_totals AS (
         SELECT o_custkey, o_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t
         FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
       SELECT o_custkey, count(*) AS orders, CAST(sum(t) AS DOUBLE) AS total
       FROM order_totals GROUP BY o_custkey""",
)
def stage_chain(spark, d):
    built = run_stages(
        {
            "items": lambda s: fx.fact_rows(spark, d)
            .groupBy("l_orderkey")
            .agg(F.sum("price").alias("t")),
            "order_totals": lambda s: read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
            .join(s["items"], F.col("o_orderkey") == F.col("l_orderkey")),
            "final": lambda s: s["order_totals"]
            .groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("orders"), units(wide_sum(F.col("t"))).alias("total")),
        }
    )
    return built["final"]


UPSERT_TARGET = f"t AS ({fx.snapshot_sql(fx.DAY_1)}), c AS ({fx.snapshot_sql(fx.DAY_2)})"


@query(
    "upsert_replace",
    f"WITH {UPSERT_TARGET} SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM c) "
    "UNION ALL SELECT * FROM c",
)
def upsert_replace(spark, d):
    return upsert(
        fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2), ["c_custkey"], "replace"
    )


@query(
    "upsert_ignore",
    f"WITH {UPSERT_TARGET} SELECT * FROM t UNION ALL "
    "SELECT * FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM t)",
)
def upsert_ignore(spark, d):
    return upsert(
        fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2), ["c_custkey"], "ignore"
    )


@query(
    "materialise_roundtrip",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def materialise_roundtrip(spark, d):
    source = read_table(spark, d, "customer")
    staged = materialise(source, "staging", "stg_customer", "")
    table = staged.select("c_custkey", "c_name", "c_mktsegment")
    return materialise(table, "business", "customer", work_path(spark, "materialise"))


@query(
    "fact_partition_pruned_read",
    """SELECT strftime(o_orderdate, '%Y-%m') AS fact_month, count(*) AS orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '1998-01' GROUP BY 1""",
)
def fact_partition_pruned_read(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    fact = write_fact(orders, work_path(spark, "fact"), "o_orderdate", "o_orderkey")
    return (
        fact.filter(F.col("fact_month") >= "1998-01")
        .groupBy("fact_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            units(F.sum(cents(F.col("o_totalprice")))).alias("total"),
        )
    )


# ------------------------------------------------------- projections, filters


@query("filter_status", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def filter_status(spark, d):
    orders = read_table(spark, d, "orders")
    return orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@query(
    "filter_date_range",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'",
)
def filter_date_range(spark, d):
    return since(read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"]), "o_orderdate",
                 "1999-01-01")


@query(
    "filter_not_in",
    f"WITH {fx.DEFECTS_SQL} SELECT o_orderkey, o_orderstatus FROM defects "
    "WHERE o_orderstatus NOT IN ('P', 'X')",
)
def filter_not_in(spark, d):
    faulty = exclude_values(fx.defects(spark, d), "o_orderstatus", ["P", "X"])
    return faulty.select("o_orderkey", "o_orderstatus")


BANDS = [(2_000_000, "Premium"), (1_500_000, "High Value"), (500_000, "Standard")]


@query(
    "segment_banding",
    """SELECT o_custkey, CAST(t AS DOUBLE) AS total,
              CASE WHEN t >= 2000000 THEN 'Premium' WHEN t >= 1500000 THEN 'High Value'
                   WHEN t >= 500000 THEN 'Standard' ELSE 'Low Value' END AS segment
       FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
             FROM orders GROUP BY o_custkey)""",
)
def segment_banding(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"])
    totals = orders.groupBy("o_custkey").agg(F.sum(cents(F.col("o_totalprice"))).alias("t"))
    return totals.select(
        "o_custkey", units(F.col("t")).alias("total"),
        band(units(F.col("t")), BANDS, "Low Value").alias("segment"),
    )


@query(
    "null_safe_diff",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT a.c_custkey, a.last_priority AS before, b.last_priority AS after
        FROM snapshot_2 a JOIN snapshot_2_nulls b ON a.c_custkey = b.c_custkey
        WHERE a.last_priority IS DISTINCT FROM b.last_priority""",
)
def null_safe_diff(spark, d):
    a = fx.snapshot(spark, d, fx.DAY_2).select("c_custkey", F.col("last_priority").alias("before"))
    b = fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY).select(
        "c_custkey", F.col("last_priority").alias("after")
    )
    return a.join(b, "c_custkey").filter(differs(F.col("before"), F.col("after")))


CUSTOMER_ATTRIBUTES = [
    {"name": "customer_id", "ordinal": 1},
    {"name": "customer_name", "ordinal": 2},
    {"name": "segment_code", "ordinal": 3},
    {"name": "source_system", "ordinal": 4},
    {"name": "c_nationkey", "ordinal": 5},
    {"name": "has_debt", "ordinal": 6, "expression": "c_acctbal < 0"},
]
CUSTOMER_MAPPINGS = [
    {"target": "customer_id", "mapping_type": "direct", "source": "c_custkey"},
    {"target": "customer_name", "mapping_type": "derived", "transformation": "TRIM(UPPER(c_name))"},
    {"target": "segment_code", "mapping_type": "derived",
     "transformation": "UPPER(SUBSTRING(c_mktsegment, 1, 3))"},
    {"target": "source_system", "mapping_type": "constant", "transformation": "'crm'"},
]


@query(
    "mapping_projection",
    """SELECT c_custkey AS customer_id, trim(upper(c_name)) AS customer_name,
              upper(substring(c_mktsegment, 1, 3)) AS segment_code, 'crm' AS source_system,
              c_nationkey, c_acctbal < 0 AS has_debt FROM customer""",
)
def mapping_projection(spark, d):
    return apply_mappings(read_table(spark, d, "customer"), CUSTOMER_ATTRIBUTES, CUSTOMER_MAPPINGS)


@query(
    "mapping_aggregation",
    """SELECT c_mktsegment AS segment, count(*) AS customers,
              CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
       FROM customer GROUP BY c_mktsegment""",
)
def mapping_aggregation(spark, d):
    attributes = [
        {"name": "segment", "ordinal": 1},
        {"name": "customers", "ordinal": 2},
        {"name": "balance", "ordinal": 3},
    ]
    mappings = [
        {"target": "segment", "mapping_type": "rename", "source": "c_mktsegment"},
        {"target": "customers", "mapping_type": "aggregation", "transformation": "count(1)"},
        {"target": "balance", "mapping_type": "aggregation",
         "transformation": "cast(sum(cast(c_acctbal as decimal(18,2))) as double)"},
    ]
    return apply_mappings(read_table(spark, d, "customer"), attributes, mappings)


@query(
    "project_transforms",
    "SELECT c_custkey, lower(c_name) AS c_name, c_acctbal >= 0 AS c_acctbal FROM customer",
)
def project_transforms(spark, d):
    return project(
        read_table(spark, d, "customer"),
        ["c_custkey", "c_name", "c_acctbal"],
        {"c_name": "lower(c_name)", "c_acctbal": "c_acctbal >= 0"},
    )


@query(
    "derive_order_line",
    """SELECT o_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS customer_id,
              CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))
                   AS DOUBLE) AS line_total
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def derive_order_line(spark, d):
    money_sql = "cast({} as decimal(18,2))"
    return derive_entity(
        {"orders": read_table(spark, d, "orders"), "lineitem": read_table(spark, d, "lineitem")},
        [
            {"name": "order_id", "expression": "o_orderkey"},
            {"name": "line_no", "expression": "l_linenumber"},
            {"name": "customer_id", "expression": "o_custkey"},
            {"name": "line_total",
             "expression": f"cast({money_sql.format('l_quantity')} * "
                           f"{money_sql.format('l_extendedprice')} as double)"},
        ],
        [("orders", "lineitem", [("o_orderkey", "l_orderkey")])],
    )


@query(
    "filter_contains_ci",
    "SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE '%WIDGET%'",
)
def filter_contains_ci(spark, d):
    part = read_table(spark, d, "part", ["p_partkey", "p_name"])
    return part.filter(contains_ci(F.col("p_name"), "widget"))


@query(
    "sample_mod",
    """SELECT c_custkey, c_name, mod(c_custkey, 100) AS sample_bucket FROM customer
       WHERE mod(c_custkey, 100) < 10""",
)
def sample_mod_query(spark, d):
    return sample_mod(read_table(spark, d, "customer", ["c_custkey", "c_name"]), "c_custkey", 100, 10)


# ---------------------------------------------------------------------- joins


@query(
    "join_customer_orders",
    """SELECT c_custkey, c_name, o_orderkey, o_orderdate
       FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def join_customer_orders(spark, d):
    customers = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


@query(
    "left_change_join",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT b.c_custkey, a.last_priority AS old_priority, b.last_priority AS new_priority
        FROM snapshot_2 b LEFT JOIN snapshot_1 a ON a.c_custkey = b.c_custkey""",
)
def left_change_join(spark, d):
    old = fx.snapshot(spark, d, fx.DAY_1).select(
        "c_custkey", F.col("last_priority").alias("old_priority")
    )
    new = fx.snapshot(spark, d, fx.DAY_2).select(
        "c_custkey", F.col("last_priority").alias("new_priority")
    )
    return new.join(old, "c_custkey", "left")


@query(
    "anti_no_orders",
    """SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
         SELECT 1 FROM orders WHERE o_custkey = c.c_custkey
           AND o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def anti_no_orders(spark, d):
    customers = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    recent = since(read_table(spark, d, "orders", ["o_custkey", "o_orderdate"]), "o_orderdate",
                   "2001-01-01")
    return joins.missing(customers, recent.select(F.col("o_custkey").alias("c_custkey")),
                         ["c_custkey"])


@query(
    "fk_orphans",
    f"""WITH {fx.DEFECTS_SQL} SELECT o_orderkey, o_custkey FROM defects
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def fk_orphans(spark, d):
    faulty = fx.defects(spark, d).select("o_orderkey", "o_custkey")
    known = read_table(spark, d, "customer", ["c_custkey"])
    return joins.missing(faulty, known.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


@query(
    "join_any_equi",
    """SELECT c_custkey, o_orderkey, o_custkey
       FROM orders JOIN customer ON o_custkey = c_custkey OR o_orderkey = c_custkey""",
)
def join_any_equi(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    customers = read_table(spark, d, "customer", ["c_custkey"])
    return joins.join_any(orders, customers, [("o_custkey", "c_custkey"), ("o_orderkey", "c_custkey")])


@query(
    "aligned_join",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT a.c_custkey, a.last_priority AS a_last_priority, b.last_priority AS b_last_priority
        FROM snapshot_1 a JOIN snapshot_2_nulls b ON a.c_custkey = b.c_custkey""",
)
def aligned_join(spark, d):
    from tablecraft.operators.compare import aligned

    cols = ["c_custkey", "last_priority"]
    return aligned(
        fx.snapshot(spark, d, fx.DAY_1).select(*cols),
        fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY).select(*cols),
        ["c_custkey"],
    )


@query(
    "role_playing_dates",
    """SELECT year(o_orderdate) AS order_year, year(l_shipdate) AS ship_year, count(*) AS lines
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""",
)
def role_playing_dates(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_shipdate"])
    days = (
        orders.select(F.to_date("o_orderdate").alias("day"))
        .unionByName(lines.select(F.to_date("l_shipdate").alias("day")))
        .distinct()
        .select("day", F.year("day").cast("long").alias("year"))
    )
    fact = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.to_date("o_orderdate").alias("order_day"), F.to_date("l_shipdate").alias("ship_day")
    )
    # count per pair of days first, so the calendar meets few rows
    fact = fact.groupBy("order_day", "ship_day").agg(F.count(F.lit(1)).alias("n"))
    roles = joins.join_roles(
        fact, days, {"order": "order_day", "ship": "ship_day"}, "day", ["year"]
    )
    return roles.groupBy("order_year", "ship_year").agg(F.sum("n").alias("lines"))


@query(
    "asof_join",
    f"""WITH {fx.HISTORY_SQL}
        SELECT o_orderkey, o_custkey, h.last_priority, h.last_status
        FROM orders LEFT JOIN history h ON o_custkey = h.c_custkey
             AND o_orderdate >= h.valid_from AND o_orderdate < h.valid_to""",
)
def asof_join(spark, d):
    from tablecraft.plans.history import customer_history

    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    # built by two loads, read by the size check and by the join
    history = cut_lineage(customer_history(spark, d)).withColumnRenamed("c_custkey", "o_custkey")
    return joins.as_of_join(
        orders, history, ["o_custkey"], "o_orderdate", fx.TRACKED, ["o_orderkey"]
    ).drop("o_orderdate")


KEY_EDGES_SQL = """
  edges AS (
    SELECT DISTINCT 'p' || l_partkey AS source, 's' || l_suppkey AS target FROM lineitem
    UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
    UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)"""
NODES_SQL = """
  nodes AS (
    SELECT 'p' || p_partkey AS node, p_name AS name FROM part
    UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation
    UNION ALL SELECT 'r' || r_regionkey, r_name FROM region)"""


def _key(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def key_edges(spark, d, distinct=True):
    """Key graph: part to supplier (from line items), supplier to nation, nation to region."""
    lines = read_table(spark, d, "lineitem", ["l_partkey", "l_suppkey"])
    if distinct:
        lines = lines.distinct()
    suppliers = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    nations = read_table(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    return (
        lines.select(_key("p", "l_partkey").alias("source"), _key("s", "l_suppkey").alias("target"))
        .unionByName(
            suppliers.select(
                _key("s", "s_suppkey").alias("source"), _key("n", "s_nationkey").alias("target")
            )
        )
        .unionByName(
            nations.select(
                _key("n", "n_nationkey").alias("source"), _key("r", "n_regionkey").alias("target")
            )
        )
    )


def key_nodes(spark, d):
    parts = [("part", "p", "p_partkey", "p_name"), ("supplier", "s", "s_suppkey", "s_name"),
             ("nation", "n", "n_nationkey", "n_name"), ("region", "r", "r_regionkey", "r_name")]
    out = None
    for table, prefix, key, name in parts:
        one = read_table(spark, d, table, [key, name]).select(
            _key(prefix, key).alias("node"), F.col(name).alias("name")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "edges_resolved",
    f"""WITH {KEY_EDGES_SQL}, {NODES_SQL}
        SELECT e.source, e.target, a.name AS source_name, b.name AS target_name
        FROM edges e JOIN nodes a ON e.source = a.node JOIN nodes b ON e.target = b.node""",
)
def edges_resolved(spark, d):
    return joins.resolve_edges(key_edges(spark, d), key_nodes(spark, d), "node", "name")


@query(
    "join_fanout",
    """WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
            r AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1)
       SELECT CAST((SELECT sum(n) FROM l) AS BIGINT) AS left_rows,
              CAST((SELECT sum(n) FROM r) AS BIGINT) AS right_rows,
              (SELECT max(n) FROM l) AS max_left, (SELECT max(n) FROM r) AS max_right,
              CAST((SELECT sum(l.n * r.n) FROM l JOIN r ON l.k = r.k) AS BIGINT) AS out_rows""",
)
def join_fanout(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_orderkey"]).withColumnRenamed("l_orderkey", "k")
    orders = read_table(spark, d, "orders", ["o_orderkey"]).withColumnRenamed("o_orderkey", "k")
    return joins.join_fanout(lines, orders, ["k"])


# ----------------------------------------------------------------- aggregates


ORDER_SUMMARY_SQL = """
  SELECT c_custkey, c_name, c_mktsegment, n AS order_count, CAST(t AS DOUBLE) AS total_revenue,
         CAST((CAST(t * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DOUBLE) / 100 AS avg_order_value,
         a AS first_order_date, b AS last_order_date,
         date_diff('day', a, b) AS customer_lifetime_days
  FROM customer JOIN (
    SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t,
           min(o_orderdate) AS a, max(o_orderdate) AS b
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON c_custkey = o_custkey"""


def _summary(spark, d):
    return agg.order_summary(
        read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"]),
        read_table(
            spark, d, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
        ),
        "F",
    )


@query("order_summary", ORDER_SUMMARY_SQL)
def order_summary(spark, d):
    return _summary(spark, d)


@query(
    "order_totals",
    """SELECT o_orderkey, o_custkey,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2)))
                   AS DOUBLE) AS order_total
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       WHERE o_orderstatus NOT IN ('P') GROUP BY o_orderkey, o_custkey""",
)
def order_totals(spark, d):
    orders = exclude_values(
        read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]),
        "o_orderstatus", ["P"],
    )
    totals = (
        fx.fact_rows(spark, d)
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("price") * F.col("quantity")).alias("t"))
    )
    return orders.join(totals, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_custkey", units(F.col("t"), 4).alias("order_total")
    )


@query(
    "distinct_orders_per_customer",
    """SELECT o_custkey, count(DISTINCT o_orderkey) AS order_count
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey""",
)
def distinct_orders_per_customer(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    lines = read_table(spark, d, "lineitem", ["l_orderkey"])
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .groupBy("o_custkey")
        .agg(F.countDistinct("o_orderkey").alias("order_count"))
    )


@query(
    "rounded_metrics",
    """SELECT o_custkey, CAST(t AS DOUBLE) AS total_amount,
              CAST((CAST(t * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DOUBLE) / 100 AS avg_order_value
       FROM (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
             FROM orders GROUP BY o_custkey)""",
)
def rounded_metrics(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"])
    totals = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("t")
    )
    return totals.select(
        "o_custkey", units(F.col("t")).alias("total_amount"),
        avg_cents(F.col("t"), F.col("n")).alias("avg_order_value"),
    )


@query(
    "ratio_metrics",
    """SELECT o_orderpriority,
              CAST((CAST(t * 100 AS HUGEINT) * 2 + k) // (2 * k) AS DOUBLE) / 100
                AS revenue_per_customer,
              CAST((CAST(t * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DOUBLE) / 100
                AS revenue_per_order
       FROM (SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS k,
                    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
             FROM orders GROUP BY o_orderpriority)""",
)
def ratio_metrics(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_totalprice", "o_orderpriority"])
    # one row per priority and customer first: distinct counting then needs no second copy
    per = orders.groupBy("o_orderpriority", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("t")
    )
    out = per.groupBy("o_orderpriority").agg(
        F.sum("n").alias("n"), wide_sum(F.col("t")).alias("t"), F.count(F.lit(1)).alias("k")
    )
    return out.select(
        "o_orderpriority",
        avg_cents(F.col("t"), F.col("k")).alias("revenue_per_customer"),
        avg_cents(F.col("t"), F.col("n")).alias("revenue_per_order"),
    )


COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "global_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED),
)
def global_counts(spark, d):
    parts = [
        read_table(spark, d, t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count"
        )
        for t in COUNTED
    ]
    return setops.safe_union(parts)


@query(
    "conditional_counts",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT CAST(sum(CASE WHEN a.last_priority IS DISTINCT FROM b.last_priority THEN 1 ELSE 0 END)
                    AS BIGINT) AS last_priority_diff,
               CAST(sum(CASE WHEN a.last_status IS DISTINCT FROM b.last_status THEN 1 ELSE 0 END)
                    AS BIGINT) AS last_status_diff
        FROM snapshot_1 a JOIN snapshot_2_nulls b ON a.c_custkey = b.c_custkey""",
)
def conditional_counts(spark, d):
    from tablecraft.operators.compare import aligned

    pairs = aligned(
        fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY),
        ["c_custkey"],
    )
    return agg.conditional_counts(
        pairs, {f"{c}_diff": differs(F.col(f"a_{c}"), F.col(f"b_{c}")) for c in fx.TRACKED}
    )


@query(
    "duplicate_groups",
    """SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def duplicate_groups(spark, d):
    return agg.duplicates(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "tie_count",
    """SELECT count(*) AS tie_count FROM (SELECT 1 FROM orders
       GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)""",
)
def tie_count(spark, d):
    return agg.tie_count(read_table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"])


@query("distinct_pairs", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(spark, d):
    return read_table(spark, d, "lineitem", ["l_partkey", "l_suppkey"]).distinct()


@query(
    "measures_additive",
    """SELECT l_returnflag, l_linestatus, count(*) AS row_count,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
       FROM lineitem GROUP BY 1, 2""",
)
def measures_additive(spark, d):
    lines = read_table(
        spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"]
    ).select(
        "l_returnflag", "l_linestatus",
        cents(F.col("l_quantity")).alias("quantity"), cents(F.col("l_extendedprice")).alias("price"),
    )
    out = agg.rollup_measures(lines, ["l_returnflag", "l_linestatus"], additive=["quantity", "price"])
    return out.withColumn("quantity", units(F.col("quantity"))).withColumn(
        "price", units(F.col("price"))
    )


MONTH_BALANCE_SQL = f"""
  WITH {fx.LEDGER_SQL}, b AS (
    SELECT account, txn_id, txn_ts, sum(amount) OVER (PARTITION BY account ORDER BY txn_ts, txn_id
             ROWS UNBOUNDED PRECEDING) AS balance FROM ledger),
  m AS (
    SELECT strftime(txn_ts, '%Y-%m') AS month, account,
           arg_max(balance, {{'t': txn_ts, 'i': txn_id}}) AS balance, count(*) AS n
    FROM b GROUP BY 1, 2)
  SELECT month, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(balance) AS DOUBLE) AS balance
  FROM m GROUP BY month"""


@query("measures_semi_additive", MONTH_BALANCE_SQL)
def measures_semi_additive(spark, d):
    from tablecraft.operators.windows import running_total

    balances = running_total(
        fx.ledger(spark, d), ["account"], ["txn_ts", "txn_id"], "amount", "balance"
    ).withColumn("month", F.date_format("txn_ts", "yyyy-MM"))
    out = agg.rollup_measures(
        balances, ["month"], semi_additive={"balance": (["account"], ["txn_ts", "txn_id"])}
    )
    return out.withColumn("balance", units(F.col("balance")))


@query(
    "measures_non_additive",
    """SELECT l_returnflag, count(*) AS row_count,
              CAST(sum(CAST(l_extendedprice * 100 AS BIGINT)) AS DOUBLE)
                / CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS price_rate
       FROM lineitem GROUP BY 1""",
)
def measures_non_additive(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_returnflag", "l_quantity", "l_extendedprice"]).select(
        "l_returnflag",
        F.col("l_quantity").cast("long").alias("quantity"),
        cents(F.col("l_extendedprice")).alias("price_cents"),
    )
    return agg.rollup_measures(lines, ["l_returnflag"], ratios={"price_rate": ("price_cents", "quantity")})


@query(
    "rollup_calendar",
    """SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
              month(o_orderdate) AS month,
              CAST(grouping_id(year(o_orderdate), quarter(o_orderdate), month(o_orderdate))
                   AS BIGINT) AS level_id,
              count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders
       GROUP BY ROLLUP (year(o_orderdate), quarter(o_orderdate), month(o_orderdate))""",
)
def rollup_calendar(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderdate", "o_totalprice"])
    # rolled up from one row per month, so the grouping sets copy months, not orders
    months = orders.groupBy(
        F.year("o_orderdate").cast("long").alias("year"),
        F.quarter("o_orderdate").cast("long").alias("quarter"),
        F.month("o_orderdate").cast("long").alias("month"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("t"))
    return agg.rollup_hierarchy(
        months, ["year", "quarter", "month"],
        [F.sum("n").alias("orders"), units(wide_sum(F.col("t"))).alias("total")],
    )


@query(
    "rollup_geo",
    """SELECT r_name, n_name, CAST(grouping_id(r_name, n_name) AS BIGINT) AS level_id,
              count(*) AS customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
       GROUP BY ROLLUP (r_name, n_name)""",
)
def rollup_geo(spark, d):
    per = read_table(spark, d, "customer", ["c_nationkey"]).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n")
    )
    geo = (
        per.join(read_table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return agg.rollup_hierarchy(geo, ["r_name", "n_name"], [F.sum("n").alias("customers")])


# ---------------------------------------------------------------- sorts, top-k


@query("order_by_revenue", ORDER_SUMMARY_SQL + " ORDER BY total_revenue DESC, c_custkey")
def order_by_revenue(spark, d):
    return _summary(spark, d).orderBy(F.desc("total_revenue"), "c_custkey")


@query(
    "top_k",
    "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10",
)
def top_k(spark, d):
    part = read_table(spark, d, "part", ["p_partkey", "p_name", "p_retailprice"])
    return agg.top_k(part, [F.desc("p_retailprice")], ["p_partkey"], 10)


@query(
    "order_by_layer",
    """SELECT o_orderkey, o_orderpriority,
              CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 1 ELSE 2 END
                   AS BIGINT) AS sort_rank
       FROM orders ORDER BY sort_rank, o_orderkey""",
)
def order_by_layer(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderpriority"])
    return agg.order_by_list(orders, "o_orderpriority", ["1-URGENT", "5-LOW"], ["o_orderkey"])


# ------------------------------------------------------------- set operations


def _pair(spark, d):
    """Order lines of finished and of open orders as (part, supplier) rows, with copies."""
    lines = read_table(spark, d, "lineitem", ["l_partkey", "l_suppkey", "l_linestatus"])
    finished = lines.filter(F.col("l_linestatus") == "F").drop("l_linestatus")
    open_ = lines.filter(F.col("l_linestatus") == "O").drop("l_linestatus")
    return finished, open_


PAIR_SQL = """
  f AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F'),
  o AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O')"""


@query(
    "except_counts",
    f"""WITH {PAIR_SQL}
        SELECT (SELECT count(*) FROM (SELECT * FROM f EXCEPT SELECT * FROM o)) AS a_minus_b,
               (SELECT count(*) FROM (SELECT * FROM o EXCEPT SELECT * FROM f)) AS b_minus_a""",
)
def except_counts(spark, d):
    a, b = _pair(spark, d)
    rows_ = setops.diff_rows(a, b)
    side = F.col("_diff_source")
    return rows_.agg(
        F.count(F.when(side == "SOURCE_ONLY", 1)).alias("a_minus_b"),
        F.count(F.when(side == "TARGET_ONLY", 1)).alias("b_minus_a"),
    )


@query("except_rows", f"WITH {PAIR_SQL} SELECT * FROM f EXCEPT SELECT * FROM o")
def except_rows(spark, d):
    return setops.minus(*_pair(spark, d))


@query("except_all_counts", f"WITH {PAIR_SQL} SELECT * FROM f EXCEPT ALL SELECT * FROM o")
def except_all_counts(spark, d):
    return setops.minus_all(*_pair(spark, d))


@query(
    "diff_rows",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT 'SOURCE_ONLY' AS _diff_source, * FROM
          (SELECT * FROM snapshot_1 EXCEPT SELECT * FROM snapshot_2_nulls)
        UNION ALL SELECT 'TARGET_ONLY', * FROM
          (SELECT * FROM snapshot_2_nulls EXCEPT SELECT * FROM snapshot_1)""",
)
def diff_rows(spark, d):
    return setops.diff_rows(
        fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY)
    )


@query(
    "union_all_versions",
    f"""WITH {fx.SNAPSHOTS_SQL} SELECT *, TIMESTAMP '{fx.DAY_1}' AS loaded FROM snapshot_1
        UNION ALL SELECT *, TIMESTAMP '{fx.DAY_2}' FROM snapshot_2""",
)
def union_all_versions(spark, d):
    return fx.snapshot(spark, d, fx.DAY_1).withColumn("loaded", ts(fx.DAY_1)).unionByName(
        fx.snapshot(spark, d, fx.DAY_2).withColumn("loaded", ts(fx.DAY_2))
    )


@query(
    "safe_union",
    """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""",
)
def safe_union(spark, d):
    frames = [
        read_table(spark, d, t).select(
            F.col(f"{p}_acctbal").alias("balance"),
            F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nation"),
        )
        for t, p in (("customer", "c"), ("supplier", "s"))
    ]
    return setops.safe_union(frames)


@query(
    "upsert_ordered",
    """WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
       SELECT c_custkey AS key, coalesce(o_orderpriority, c_mktsegment) AS value
       FROM customer LEFT JOIN c ON c_custkey = o_custkey""",
)
def upsert_ordered(spark, d):
    target = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value")
    )
    changes = read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("value"),
        "o_orderdate", "o_orderkey",
    )
    return upsert(target, changes, ["key"], "replace",
                  order=[F.desc("o_orderdate"), F.desc("o_orderkey")])
