"""Data-quality rules over tables with injected defects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import cents
from tablecraft.operators import determinism as det
from tablecraft.operators import quality as dq
from tablecraft.operators import scd
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.sources.tables import read_table


def row_rule_sql(rule: str, table: str, col: str, severity: str, bad: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{table}' AS table_name, '{col}' AS column_name,
      '{severity}' AS severity, count(*) FILTER ({bad}) AS failed_rows, count(*) AS total_rows
      FROM {table}"""


def unique_sql(table: str, cols: str) -> str:
    return f"""SELECT 'unique' AS rule, '{table}' AS table_name, '{cols}' AS column_name,
      'error' AS severity, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS failed_rows,
      CAST(sum(n) AS BIGINT) AS total_rows
      FROM (SELECT count(*) AS n FROM {table} GROUP BY {cols})"""


def fk_sql(table: str, col: str, parent: str, key: str) -> str:
    return f"""SELECT 'relationships' AS rule, '{table}' AS table_name, '{col}' AS column_name,
      'error' AS severity, count(*) FILTER ({col} IS NOT NULL AND p IS NULL) AS failed_rows,
      count(*) AS total_rows
      FROM {table} LEFT JOIN (SELECT DISTINCT {key} AS p FROM {parent}) ON {col} = p"""


def _with(*bodies: str) -> str:
    return f"WITH {fx.DEFECTS_SQL} " + " UNION ALL ".join(bodies)


@query(
    "dq_not_null",
    _with(
        row_rule_sql("not_null", "defects", "o_orderkey", "error", "o_orderkey IS NULL"),
        row_rule_sql("not_null", "defects", "o_orderstatus", "error", "o_orderstatus IS NULL"),
    ),
)
def dq_not_null(spark, d):
    rules = [dq.not_null("o_orderkey"), dq.not_null("o_orderstatus")]
    return dq.run_row_rules(fx.defects(spark, d), "defects", rules)


@query(
    "dq_unique",
    _with(unique_sql("defects", "o_orderkey"), unique_sql("lineitem", "l_orderkey,l_linenumber")),
)
def dq_unique(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"])
    return dq.check_unique(fx.defects(spark, d), "defects", ["o_orderkey"]).unionByName(
        dq.check_unique(lines, "lineitem", ["l_orderkey", "l_linenumber"])
    )


@query(
    "dq_accepted_values",
    _with(
        row_rule_sql("accepted_values", "defects", "o_orderstatus", "error",
                     "o_orderstatus NOT IN ('F', 'O', 'P')")
    ),
)
def dq_accepted_values(spark, d):
    return dq.run_row_rules(
        fx.defects(spark, d), "defects", [dq.accepted_values("o_orderstatus", ["F", "O", "P"])]
    )


@query(
    "dq_fk",
    _with(fk_sql("defects", "o_custkey", "customer", "c_custkey"),
          fk_sql("lineitem", "l_orderkey", "orders", "o_orderkey")),
)
def dq_fk(spark, d):
    a = dq.check_fk(
        fx.defects(spark, d), "defects", ["o_custkey"],
        read_table(spark, d, "customer", ["c_custkey"]), ["c_custkey"],
    )
    b = dq.check_fk(
        read_table(spark, d, "lineitem", ["l_orderkey"]), "lineitem", ["l_orderkey"],
        read_table(spark, d, "orders", ["o_orderkey"]), ["o_orderkey"],
    )
    return a.unionByName(b)


NAME_PATTERN = "^Customer#[0-9]{9}$"
SHORT_CODE = "^[A-Z]{2,9}$"


@query(
    "dq_pattern",
    " UNION ALL ".join(
        row_rule_sql("pattern", "customer", col, "error", f"NOT regexp_matches({col}, '{p}')")
        for col, p in (("c_name", NAME_PATTERN), ("c_mktsegment", SHORT_CODE))
    ),
)
def dq_pattern(spark, d):
    customer = read_table(spark, d, "customer", ["c_name", "c_mktsegment"])
    rules = [dq.pattern("c_name", NAME_PATTERN), dq.pattern("c_mktsegment", SHORT_CODE)]
    return dq.run_row_rules(customer, "customer", rules)


@query(
    "dq_email_pattern",
    row_rule_sql("pattern", "documents", "text", "error",
                 f"NOT regexp_matches(text, '{dq.PATTERNS['email_address'].strip('^$')}')"),
)
def dq_email_pattern(spark, d):
    """Documents without an e-mail address anywhere in the text."""
    documents = read_table(spark, d, "documents", ["text"])
    anywhere = dq.PATTERNS["email_address"].strip("^$")
    return dq.run_row_rules(documents, "documents", [dq.pattern("text", anywhere)])


@query(
    "dq_length",
    " UNION ALL ".join(
        [
            row_rule_sql("length", "documents", "text", "warning", "length(text) > 2000"),
            row_rule_sql("length", "documents", "lang", "warning", "length(lang) > 2"),
        ]
    ),
)
def dq_length(spark, d):
    documents = read_table(spark, d, "documents", ["text", "lang"])
    return dq.run_row_rules(
        documents, "documents", [dq.max_length("text", 2000), dq.max_length("lang", 2)]
    )


@query(
    "dq_decimal_fit",
    """SELECT 'decimal_fit' AS rule, 'orders' AS table_name, 'o_totalprice' AS column_name,
              'warning' AS severity,
              count(*) FILTER (try_cast(o_totalprice AS DECIMAL(7,2)) IS NULL OR
                CAST(try_cast(o_totalprice AS DECIMAL(7,2)) AS DOUBLE) <> o_totalprice)
                AS failed_rows, count(*) AS total_rows FROM orders""",
)
def dq_decimal_fit(spark, d):
    orders = read_table(spark, d, "orders", ["o_totalprice"])
    return dq.run_row_rules(orders, "orders", [dq.decimal_fit("o_totalprice", 7, 2)])


@query(
    "dq_range",
    " UNION ALL ".join(
        [
            row_rule_sql("range", "lineitem", "l_discount", "error",
                         "l_discount < 0 OR l_discount > 0.05"),
            row_rule_sql("range", "lineitem", "l_quantity", "error",
                         "l_quantity < 1 OR l_quantity > 45"),
        ]
    ),
)
def dq_range(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_discount", "l_quantity"])
    rules = [dq.value_range("l_discount", 0, 0.05), dq.value_range("l_quantity", 1, 45)]
    return dq.run_row_rules(lines, "lineitem", rules)


@query(
    "dq_derived_total",
    """SELECT 'derived_total' AS rule, 'orders' AS table_name, 'total' AS column_name,
              'warning' AS severity,
              count(*) FILTER (abs(CAST(o_totalprice AS DECIMAL(18,2)) - coalesce(s, 0)) > 1000)
                AS failed_rows, count(*) AS total_rows
       FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
                              FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def dq_derived_total(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    return dq.check_total(
        orders.withColumn("total", cents(F.col("o_totalprice"))), "orders", "o_orderkey", "total",
        fx.fact_rows(spark, d), "l_orderkey", F.col("price"), tolerance=100_000,
    )


@query(
    "dq_derived_row",
    row_rule_sql("derived", "documents", "n_chars", "warning", "abs(n_chars - length(text)) > 0"),
)
def dq_derived_row(spark, d):
    documents = read_table(spark, d, "documents", ["text", "n_chars"])
    return dq.run_row_rules(
        documents, "documents",
        [dq.derived("n_chars", F.length("text").cast("long"), severity="warning")],
    )


PAIRS = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("lineitem", "l_partkey", "lineitem", "l_suppkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
]


def _cardinality_sql(left: str, lk: str, right: str, rk: str) -> str:
    return f"""SELECT '{left}.{lk}' AS left_key, '{right}.{rk}' AS right_key, *,
      CASE WHEN max_left <= 1 AND max_right <= 1 THEN 'one_to_one' WHEN max_left <= 1
           THEN 'one_to_many' WHEN max_right <= 1 THEN 'many_to_one' ELSE 'many_to_many' END
        AS cardinality
      FROM (SELECT (SELECT max(n) FROM (SELECT count(*) AS n FROM {left} GROUP BY {lk})) AS max_left,
                   (SELECT max(n) FROM (SELECT count(*) AS n FROM {right} GROUP BY {rk}))
                     AS max_right)"""


@query("dq_cardinality", " UNION ALL ".join(_cardinality_sql(*p) for p in PAIRS))
def dq_cardinality(spark, d):
    out = None
    for left, lk, right, rk in PAIRS:
        one = dq.measure_cardinality(
            read_table(spark, d, left, [lk]), read_table(spark, d, right, [rk]), [lk], [rk]
        ).select(F.lit(f"{left}.{lk}").alias("left_key"), F.lit(f"{right}.{rk}").alias("right_key"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "dq_scd2_invariants",
    f"""WITH {fx.SNAPSHOTS_SQL}, h AS (
          SELECT c_custkey, TIMESTAMP '{fx.DAY_1}' AS f FROM snapshot_1
          UNION ALL SELECT c_custkey, TIMESTAMP '{fx.DAY_2}' FROM snapshot_2),
        k AS (SELECT c_custkey, count(*) AS n FROM h GROUP BY 1),
        o AS (SELECT count(*) FILTER (lead_f IS NOT NULL) AS overlap, count(*) AS n FROM
              (SELECT lead(f) OVER (PARTITION BY c_custkey ORDER BY f) AS lead_f FROM h))
        SELECT 'scd2_one_current' AS rule, 'history' AS table_name, 'c_custkey' AS column_name,
               'error' AS severity, count(*) FILTER (n <> 1) AS failed_rows,
               count(*) AS total_rows FROM k
        UNION ALL SELECT 'scd2_no_overlap', 'history', 'c_custkey', 'error', overlap, n FROM o
        UNION ALL SELECT 'scd2_from_before_to', 'history', 'valid_from', 'error', 0, n FROM o""",
)
def dq_scd2_invariants(spark, d):
    """A history whose second load forgot to close the versions of the first."""
    first = scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), ["c_custkey"], fx.DAY_1)
    second = scd.scd2_init(fx.snapshot(spark, d, fx.DAY_2), ["c_custkey"], fx.DAY_2)
    return dq.check_scd2(first.unionByName(second), "history", ["c_custkey"])


SUITE = {
    "defects": {
        "primary_key": ["o_orderkey"],
        "columns": {
            "o_orderstatus": {"not_null": True, "values": ["F", "O", "P"], "length": 1},
            "o_orderpriority": {"pattern": "^[1-5]-[A-Z ]+$"},
            "o_totalprice": {"range": (2000, 490000)},
        },
        "foreign_keys": [(["o_custkey"], "customer", ["c_custkey"])],
    },
    "lineitem": {
        "columns": {
            "l_returnflag": {"not_null": True, "values": ["A", "N"]},
            "l_discount": {"range": (0, 0.08)},
        },
        "foreign_keys": [(["l_orderkey"], "orders", ["o_orderkey"])],
    },
    "customer": {"primary_key": ["c_custkey"], "columns": {"c_name": {"pattern": NAME_PATTERN}}},
}
SUITE_SQL = _with(
    row_rule_sql("not_null", "defects", "o_orderkey", "error", "o_orderkey IS NULL"),
    row_rule_sql("not_null", "defects", "o_orderstatus", "error", "o_orderstatus IS NULL"),
    row_rule_sql("accepted_values", "defects", "o_orderstatus", "error",
                 "o_orderstatus NOT IN ('F', 'O', 'P')"),
    row_rule_sql("length", "defects", "o_orderstatus", "warning", "length(o_orderstatus) > 1"),
    row_rule_sql("pattern", "defects", "o_orderpriority", "error",
                 "NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')"),
    row_rule_sql("range", "defects", "o_totalprice", "error",
                 "o_totalprice < 2000 OR o_totalprice > 490000"),
    unique_sql("defects", "o_orderkey"),
    fk_sql("defects", "o_custkey", "customer", "c_custkey"),
    row_rule_sql("not_null", "lineitem", "l_returnflag", "error", "l_returnflag IS NULL"),
    row_rule_sql("accepted_values", "lineitem", "l_returnflag", "error",
                 "l_returnflag NOT IN ('A', 'N')"),
    row_rule_sql("range", "lineitem", "l_discount", "error", "l_discount < 0 OR l_discount > 0.08"),
    fk_sql("lineitem", "l_orderkey", "orders", "o_orderkey"),
    row_rule_sql("not_null", "customer", "c_custkey", "error", "c_custkey IS NULL"),
    unique_sql("customer", "c_custkey"),
    row_rule_sql("pattern", "customer", "c_name", "error",
                 f"NOT regexp_matches(c_name, '{NAME_PATTERN}')"),
)


def suite(spark, d) -> DataFrame:
    tables = {t: read_table(spark, d, t) for t in ("lineitem", "customer", "orders")}
    return dq.run_suite(tables | {"defects": fx.defects(spark, d)}, SUITE)


@query("dq_suite", SUITE_SQL)
def dq_suite(spark, d):
    return suite(spark, d)


@query(
    "dq_severity_summary",
    f"""SELECT severity, count(*) AS rules, count(*) FILTER (failed_rows > 0) AS failed_rules,
               CAST(sum(failed_rows) AS BIGINT) AS failed_rows FROM ({SUITE_SQL}) GROUP BY 1""",
)
def dq_severity_summary(spark, d):
    return dq.severity_summary(suite(spark, d))


@query(
    "findings_summary",
    f"""WITH f AS ({SUITE_SQL})
        SELECT 'type' AS dimension, rule AS value, CAST(sum(failed_rows) AS BIGINT) AS findings
        FROM f GROUP BY rule
        UNION ALL SELECT 'source', table_name, CAST(sum(failed_rows) AS BIGINT) FROM f
        GROUP BY table_name
        UNION ALL SELECT 'total', 'all', CAST(sum(failed_rows) AS BIGINT) FROM f""",
)
def findings_summary(spark, d):
    return det.findings_summary(
        suite(spark, d).select(
            F.col("rule").alias("finding_type"), F.col("table_name").alias("source"),
            F.col("failed_rows").alias("n"),
        )
    )
