"""Stage-by-stage regression compare over two versions of a flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions.scalars import avg_cents, band, units
from tablecraft.operators import compare as cmp
from tablecraft.operators.projections import exclude_values
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.session import work_path
from tablecraft.sources import digests
from tablecraft.sources.tables import read_table, run_stages

THRESHOLDS_A = [(1_750_000, "Premium"), (1_300_000, "High Value"), (600_000, "Standard")]
THRESHOLDS_B = [(1_750_000, "Premium"), (1_400_000, "High Value"), (600_000, "Standard")]


def flow(spark, d, thresholds, store=()):
    """order_totals, customer_metrics and final over orders, line items and customers."""
    orders = exclude_values(
        read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]),
        "o_orderstatus", ["P"],
    )
    lines = fx.fact_rows(spark, d).groupBy("l_orderkey").agg(F.sum("price").alias("order_total"))
    customers = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])

    def metrics(s):
        grouped = s["order_totals"].groupBy("o_custkey").agg(
            F.countDistinct("o_orderkey").alias("order_count"),
            F.sum("order_total").alias("t"),
            F.min("o_orderdate").alias("first_order_date"),
            F.max("o_orderdate").alias("last_order_date"),
        )
        return grouped.select(
            "o_custkey", "order_count", units(F.col("t")).alias("total_amount"),
            avg_cents(F.col("t"), F.col("order_count")).alias("avg_order_value"),
            "first_order_date", "last_order_date",
        )

    return run_stages(
        {
            "order_totals": lambda s: orders.join(
                lines, F.col("o_orderkey") == F.col("l_orderkey")
            ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "order_total"),
            "customer_metrics": metrics,
            "final": lambda s: customers.join(
                s["customer_metrics"], F.col("c_custkey") == F.col("o_custkey")
            )
            .drop("o_custkey")
            .withColumn("customer_segment", band(F.col("total_amount"), thresholds, "Low Value")),
        },
        store=store,
    )


def _final_sql(high: int) -> str:
    return f"""SELECT c_custkey, c_name, c_mktsegment, order_count, total_amount, avg_order_value,
      first_order_date, last_order_date,
      CASE WHEN total_amount >= 1750000 THEN 'Premium' WHEN total_amount >= {high}
           THEN 'High Value' WHEN total_amount >= 600000 THEN 'Standard' ELSE 'Low Value' END
        AS customer_segment
      FROM customer JOIN customer_metrics ON c_custkey = o_custkey"""


FLOW_SQL = f"""
  order_totals AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS order_total
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus NOT IN ('P')
    GROUP BY 1, 2, 3, 4),
  customer_metrics AS (
    SELECT o_custkey, count(DISTINCT o_orderkey) AS order_count,
           CAST(sum(order_total) AS DOUBLE) AS total_amount,
           CAST((CAST(sum(order_total) * 100 AS HUGEINT) * 2 + count(*)) // (2 * count(*)) AS DOUBLE)
             / 100 AS avg_order_value,
           min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date
    FROM order_totals GROUP BY o_custkey),
  final_a AS ({_final_sql(1300000)}),
  final_b AS ({_final_sql(1400000)})"""


def _compare_sql(name: str, a: str, b: str) -> str:
    return f"""SELECT '{name}' AS cte_name,
      (SELECT count(*) FROM {a}) AS rows_source, (SELECT count(*) FROM {b}) AS rows_target,
      (SELECT count(*) FROM (SELECT * FROM {a} EXCEPT SELECT * FROM {b}))
        AS except_source_vs_target,
      (SELECT count(*) FROM (SELECT * FROM {b} EXCEPT SELECT * FROM {a}))
        AS except_target_vs_source"""


def _verdict_sql(body: str) -> str:
    return f"""SELECT *, except_source_vs_target + except_target_vs_source AS total_differences,
      CASE WHEN except_source_vs_target + except_target_vs_source = 0 THEN 'PASS' ELSE 'FAIL' END
        AS status FROM ({body})"""


STAGES_SQL = " UNION ALL ".join(
    [
        _compare_sql("order_totals", "order_totals", "order_totals"),
        _compare_sql("customer_metrics", "customer_metrics", "customer_metrics"),
        _compare_sql("final", "final_a", "final_b"),
    ]
)


# every stage is read by the next one and by its compare
STORED = ("order_totals", "customer_metrics", "final")


def _finals(spark, d, store=()):
    return tuple(flow(spark, d, t, store)["final"] for t in (THRESHOLDS_A, THRESHOLDS_B))


def _flows(spark, d):
    return tuple(flow(spark, d, t, STORED) for t in (THRESHOLDS_A, THRESHOLDS_B))


@query(
    "compare_frames",
    f"WITH {FLOW_SQL} SELECT * EXCLUDE (cte_name) FROM "
    f"({_verdict_sql(_compare_sql('final', 'final_a', 'final_b'))})",
)
def compare_frames(spark, d):
    return cmp.compare(*_finals(spark, d))


@query(
    "compare_skip_columns",
    f"WITH {FLOW_SQL}, a AS (SELECT * EXCLUDE (customer_segment) FROM final_a), "
    "b AS (SELECT * EXCLUDE (customer_segment) FROM final_b) SELECT * EXCLUDE (cte_name) FROM "
    f"({_verdict_sql(_compare_sql('final', 'a', 'b'))})",
)
def compare_skip_columns(spark, d):
    a, b = _finals(spark, d)
    return cmp.compare(a, b, skip=["customer_segment"])


DIFF_SQL = """
  d AS (SELECT 'SOURCE_ONLY' AS _diff_source, * FROM
          (SELECT * FROM final_a EXCEPT SELECT * FROM final_b)
        UNION ALL SELECT 'TARGET_ONLY', * FROM
          (SELECT * FROM final_b EXCEPT SELECT * FROM final_a))"""


@query(
    "compare_sample",
    f"WITH {FLOW_SQL}, {DIFF_SQL} SELECT * FROM d ORDER BY ALL LIMIT 25",
)
def compare_sample(spark, d):
    return cmp.diff_sample(*_finals(spark, d), n=25)


@query(
    "diff_sample_bounded",
    f"WITH {FLOW_SQL}, {DIFF_SQL} SELECT * FROM d ORDER BY ALL LIMIT 10",
)
def diff_sample_bounded(spark, d):
    return cmp.diff_sample(*_finals(spark, d))


@query(
    "compare_columns",
    f"""WITH {FLOW_SQL} SELECT 'customer_segment' AS column_name, count(*) AS difference_count
        FROM final_a a JOIN final_b b ON a.c_custkey = b.c_custkey
        WHERE a.customer_segment IS DISTINCT FROM b.customer_segment HAVING count(*) > 0""",
)
def compare_columns(spark, d):
    return cmp.column_diffs(*_finals(spark, d, ("final",)), keys=["c_custkey"])


LINES_SQL = """
  a AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
        WHERE l_linestatus = 'F'),
  b AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
        WHERE l_linestatus = 'O')"""


@query(
    "compare_columns_repeated_keys",
    f"""WITH {LINES_SQL}, p AS (
          SELECT a.l_returnflag AS x1, b.l_returnflag AS y1, a.l_linestatus AS x2,
                 b.l_linestatus AS y2
          FROM a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)
        SELECT * FROM (
          SELECT 'l_returnflag' AS column_name,
                 count(*) FILTER (x1 IS DISTINCT FROM y1) AS difference_count FROM p
          UNION ALL SELECT 'l_linestatus', count(*) FILTER (x2 IS DISTINCT FROM y2) FROM p)
        WHERE difference_count > 0""",
)
def compare_columns_repeated_keys(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    lines = read_table(spark, d, "lineitem", cols)
    return cmp.column_diffs(
        lines.filter(F.col("l_linestatus") == "F"), lines.filter(F.col("l_linestatus") == "O"),
        ["l_orderkey", "l_linenumber"],
    )


@query("compare_stages", f"WITH {FLOW_SQL} {_verdict_sql(STAGES_SQL)}")
def compare_stages(spark, d):
    results, _ = cmp.compare_stages(*_flows(spark, d))
    return results.drop("note")


PAIRS_SQL = """SELECT a.customer_segment AS source_value, b.customer_segment AS target_value,
  count(*) AS occurrence_count FROM final_a a JOIN final_b b ON a.c_custkey = b.c_custkey
  WHERE a.customer_segment IS DISTINCT FROM b.customer_segment
  GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""


@query("investigate_column", f"WITH {FLOW_SQL} {PAIRS_SQL}")
def investigate_column(spark, d):
    return cmp.investigate(*_finals(spark, d), ["c_custkey"], "customer_segment")["pairs"]


@query(
    "value_pairs",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT a.last_priority AS source_value, b.last_priority AS target_value,
               count(*) AS occurrence_count
        FROM snapshot_1 a JOIN snapshot_2_nulls b ON a.c_custkey = b.c_custkey
        WHERE a.last_priority IS DISTINCT FROM b.last_priority GROUP BY 1, 2
        ORDER BY 3 DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 20""",
)
def value_pairs(spark, d):
    return cmp.value_pairs(
        fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY),
        ["c_custkey"], "last_priority",
    )


@query(
    "compare_summary",
    f"""WITH {FLOW_SQL}, r AS ({_verdict_sql(STAGES_SQL)})
        SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS passed,
               count(*) FILTER (status = 'FAIL') AS failed,
               count(*) FILTER (status = 'ERROR') AS errors,
               CASE WHEN count(*) FILTER (status IN ('FAIL', 'ERROR')) = 0
                    THEN 'ALL REGRESSION TESTS PASSED' ELSE 'REGRESSION FAILURES DETECTED' END
                 AS verdict FROM r""",
)
def compare_summary(spark, d):
    results, _ = cmp.compare_stages(*_flows(spark, d))
    return cmp.summarise(results)


@query(
    "key_coverage",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT count(*) FILTER (a.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL)
                 AS aligned_keys,
               count(*) FILTER (b.c_custkey IS NULL) AS source_only_keys,
               count(*) FILTER (a.c_custkey IS NULL) AS target_only_keys
        FROM snapshot_1 a FULL JOIN snapshot_2 b ON a.c_custkey = b.c_custkey""",
)
def key_coverage(spark, d):
    return cmp.key_coverage(
        fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2), ["c_custkey"]
    )


def _days_sql(kind: str) -> str:
    return f"""SELECT DISTINCT 'day_' || strftime(ts, '%Y-%m-%d %H:%M') AS stage FROM events
      WHERE event_type = '{kind}'"""


@query(
    "stage_inventory",
    f"""WITH a AS ({_days_sql('purchase')}), b AS ({_days_sql('error')})
       SELECT coalesce(a.stage, b.stage) AS stage,
              CASE WHEN a.stage IS NOT NULL AND b.stage IS NOT NULL THEN 'common'
                   WHEN a.stage IS NOT NULL THEN 'only_a' ELSE 'only_b' END AS presence
       FROM a FULL JOIN b ON a.stage = b.stage""",
)
def stage_inventory(spark, d):
    """Two daily flows with one stage per minute in which they have something to do."""
    events = read_table(spark, d, "events", ["ts", "event_type"])
    stage = F.concat(F.lit("day_"), F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("stage")
    names = [
        events.filter(F.col("event_type") == kind).select(stage).distinct()
        for kind in ("purchase", "error")
    ]
    return cmp.stage_inventory(*names)


@query(
    "compare_stored",
    f"WITH {FLOW_SQL} SELECT * EXCLUDE (cte_name) FROM "
    f"({_verdict_sql(_compare_sql('final', 'final_a', 'final_b'))})",
)
def compare_stored(spark, d):
    """Both ends of the flow stored with checksum trees; only differing ranges are read."""
    a, b = _finals(spark, d)
    ddl = ", ".join(f"`{c}` {kind}" for c, kind in a.dtypes)
    folders = []
    for df in (a, b):
        folders.append(work_path(spark, "digested"))
        digests.store_digested(df, folders[-1], [a.columns[0]])
    return digests.compare_stored(spark, *folders, ddl)
