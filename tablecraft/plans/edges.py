"""Cases the given rows do not have: NULL keys, equal times, repeated and unmatched rows.

The inputs are the whole given tables with NULLs, copies and coarser times put in by rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions import scalars as s
from tablecraft.functions.scalars import as_double, cents_to_money, money
from tablecraft.operators import aggregates as agg
from tablecraft.operators import compare as cmp
from tablecraft.operators import credit, joins, lineage, scd, star, vault
from tablecraft.operators.windows import running_total
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.session import cut_lineage, work_path
from tablecraft.sources.sinks import materialise_scd2, upsert
from tablecraft.sources.tables import read_table


@query(
    "measures_null_dimension",
    f"""WITH {fx.LEDGER_SQL},
          b AS (SELECT nullif(status, 'F') AS status, account, txn_ts, txn_id, amount,
                       sum(amount) OVER (PARTITION BY account ORDER BY txn_ts, txn_id
                                         ROWS UNBOUNDED PRECEDING) AS balance FROM ledger),
          l AS (SELECT status, account, arg_max(balance, {{'t': txn_ts, 'i': txn_id}}) AS x
                FROM b GROUP BY 1, 2)
        SELECT t.status, t.row_count, t.amount, CAST(x AS DOUBLE) AS balance
        FROM (SELECT status, count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS amount
              FROM b GROUP BY 1) t
        JOIN (SELECT status, sum(x) AS x FROM l GROUP BY 1) u ON t.status IS NOT DISTINCT FROM u.status""",
)
def measures_null_dimension(spark, d):
    balances = running_total(
        fx.ledger(spark, d), ["account"], ["txn_ts", "txn_id"], "amount", "balance"
    ).withColumn("status", F.nullif("status", F.lit("F")))
    out = agg.rollup_measures(
        balances, ["status"], ["amount"], {"balance": (["account"], ["txn_ts", "txn_id"])}
    )
    return out.select(
        "status", "row_count", s.units(F.col("amount")).alias("amount"),
        s.units(F.col("balance")).alias("balance"),
    )


@query(
    "running_balance_decimal",
    f"""WITH {fx.LEDGER_SQL}
        SELECT account, txn_id, CAST(sum(amount) OVER (PARTITION BY account ORDER BY txn_ts, txn_id
                 ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS balance FROM ledger""",
)
def running_balance_decimal(spark, d):
    ledger = fx.ledger(spark, d).withColumn("amount", cents_to_money(F.col("amount")))
    return running_total(ledger, ["account"], ["txn_ts", "txn_id"], "amount", "balance").select(
        "account", "txn_id", "balance"
    )


ODD_ORDERS_SQL = """
  odd_orders AS (SELECT o_orderkey, o_orderdate,
    CASE WHEN day(o_orderdate) <> 13 THEN o_custkey END AS o_custkey FROM orders),
  odd_history AS (
    SELECT c_custkey, last_priority, last_status, valid_from, valid_to FROM history
    UNION ALL SELECT CASE WHEN c_custkey % 7 > 0 THEN c_custkey END, 'none', 'X', valid_from,
      CASE WHEN c_custkey % 7 > 0 THEN valid_from ELSE valid_to END FROM history)"""


@query(
    "asof_join_nulls",
    f"""WITH {fx.HISTORY_SQL}, {ODD_ORDERS_SQL}
        SELECT o_orderkey, o_custkey, h.last_priority, h.last_status
        FROM odd_orders LEFT JOIN odd_history h ON o_custkey = h.c_custkey
             AND o_orderdate >= h.valid_from AND o_orderdate < h.valid_to""",
)
def asof_join_nulls(spark, d):
    """Facts and versions without a key, and versions without a length at the start of real ones."""
    from tablecraft.plans.history import customer_history

    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).withColumn(
        "o_custkey", F.when(F.dayofmonth("o_orderdate") != 13, F.col("o_custkey"))
    )
    history = cut_lineage(customer_history(spark, d)).select(
        F.col("c_custkey").alias("o_custkey"), *fx.TRACKED, "valid_from", "valid_to"
    )
    real = F.col("o_custkey") % 7 > 0
    odd = history.select(
        F.when(real, F.col("o_custkey")).alias("o_custkey"), F.lit("none").alias("last_priority"),
        F.lit("X").alias("last_status"), "valid_from",
        F.when(real, F.col("valid_from")).otherwise(F.col("valid_to")).alias("valid_to"),
    )
    return joins.as_of_join(
        orders, history.unionByName(odd), ["o_custkey"], "o_orderdate", fx.TRACKED, ["o_orderkey"]
    ).drop("o_orderdate")


@query(
    "scd2_backfill_ties",
    f"""WITH coarse AS (SELECT user_id, event_type, event_id, date_trunc('day', ts) AS ts FROM events),
          log AS (SELECT * FROM coarse QUALIFY row_number() OVER (
                    PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
          starts AS (SELECT * FROM log QUALIFY event_type IS DISTINCT FROM
                       lag(event_type) OVER (PARTITION BY user_id ORDER BY ts)
                     OR row_number() OVER (PARTITION BY user_id ORDER BY ts) = 1),
          spans AS (SELECT user_id, event_type, ts AS valid_from,
                           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM starts)
        SELECT user_id, event_type, {fx.stamp_sql('valid_from')} AS valid_from,
               {fx.stamp_sql("coalesce(nxt, TIMESTAMP '9999-12-31 23:59:59')")} AS valid_to,
               nxt IS NULL AS is_current FROM spans""",
)
def scd2_backfill_ties(spark, d):
    """Several changes of a key at one time: days instead of times."""
    log = read_table(spark, d, "events", ["user_id", "event_type", "ts", "event_id"]).withColumn(
        "ts", F.date_trunc("day", "ts").cast("timestamp_ntz")
    )
    return fx.with_text_stamps(scd.scd2_backfill(log, ["user_id"], ["event_type"], "ts", ["event_id"]))


def _ratio_sql(top: str, bottom: str) -> str:
    return f"CAST(({top} * 20000 + {bottom}) // (2 * {bottom}) AS DOUBLE) / 10000"


@query(
    "ltv_unmatched",
    f"""WITH l AS (SELECT CASE WHEN o_custkey % 5 = 0 THEN -o_custkey WHEN o_custkey % 5 > 1 THEN o_custkey
                         END AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t FROM orders GROUP BY 1)
        SELECT coalesce(k, c_custkey) AS c_custkey, CAST(t AS DOUBLE) AS secured_loans,
               CASE WHEN c_custkey IS NOT NULL AND k IS NOT NULL
                    THEN {_ratio_sql('CAST(t * 100 AS HUGEINT)', '100000000')} END AS loan_to_value
        FROM customer FULL JOIN l ON c_custkey = k""",
)
def ltv_unmatched(spark, d):
    """Loans without collateral or key, and collateral without loans."""
    key = F.col("o_custkey")
    loans = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"]).select(
        F.when(key % 5 == 0, -key).when(key % 5 > 1, key).alias("c_custkey"),
        money(F.col("o_totalprice")).alias("loan"),
    )
    homes = read_table(spark, d, "customer", ["c_custkey"]).withColumn(
        "property_value", F.lit("1000000.00").cast("decimal(18,2)")
    )
    out = credit.ltv(loans, homes, "c_custkey", "loan", "property_value")
    return out.select(
        "c_custkey", as_double(F.col("secured_loans")).alias("secured_loans"),
        as_double(F.col("loan_to_value")).alias("loan_to_value"),
    )


@query(
    "dti_unmatched",
    """WITH l AS (SELECT o_custkey AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t FROM orders
                  GROUP BY 1),
          i AS (SELECT c_custkey + 40 AS k, sum(CAST(c_acctbal AS DECIMAL(18,2)) + 10000) AS i
                FROM customer GROUP BY 1)
       SELECT coalesce(l.k, i.k) AS household, CAST(t AS DOUBLE) AS loan_amount,
              CAST(i AS DOUBLE) AS household_income,
              CASE WHEN l.k IS NOT NULL AND i.k IS NOT NULL THEN
                CAST((CAST(t * 100 AS HUGEINT) * 20000 + CAST(i * 100 AS HUGEINT))
                  // (2 * CAST(i * 100 AS HUGEINT)) AS DOUBLE) / 10000 END AS debt_to_income
       FROM l FULL JOIN i ON l.k = i.k""",
)
def dti_unmatched(spark, d):
    """Households with loans and no income row, and the other way round."""
    loans = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"]).select(
        F.col("o_custkey").alias("household"), money(F.col("o_totalprice")).alias("loan")
    )
    members = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"]).select(
        (F.col("c_custkey") + 40).alias("household"),
        (money(F.col("c_acctbal")) + F.lit(10000)).alias("income"),
    )
    out = credit.dti(loans, credit.household_income(members, "household", "income"), "household", "loan")
    return out.select(
        "household", *[as_double(F.col(c)).alias(c) for c in ("loan_amount", "household_income", "debt_to_income")]
    )


@query(
    "exposure_unmatched",
    """WITH f AS (SELECT o_orderkey AS k, o_orderstatus AS c, CAST(o_totalprice AS DECIMAL(18,2)) AS x
                  FROM orders WHERE o_orderpriority <> '5-LOW'
                  UNION ALL SELECT o_orderkey, 'Z', 1 FROM orders WHERE o_orderpriority = '1-URGENT'),
          a AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS y
                FROM lineitem GROUP BY 1),
          p AS (SELECT coalesce(c, 'UNKNOWN') AS c, y
                FROM a LEFT JOIN (SELECT k, min(c) AS c FROM f GROUP BY 1) m ON a.k = m.k),
          t AS (SELECT c, x, NULL AS y FROM f UNION ALL SELECT c, NULL, y FROM p)
       SELECT c AS class, CAST(sum(x) AS DOUBLE) AS outstanding, CAST(sum(y) AS DOUBLE) AS carrying
       FROM t GROUP BY 1""",
)
def exposure_unmatched(spark, d):
    """Instruments in two classes, and accounting rows without an instrument."""
    orders = read_table(
        spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    )
    amount = money(F.col("o_totalprice"))
    fin = orders.filter(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("instrument"), F.col("o_orderstatus").alias("class"),
        amount.alias("outstanding"),
    ).unionByName(
        orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
            F.col("o_orderkey").alias("instrument"), F.lit("Z").alias("class"),
            F.lit(1).cast("decimal(18,2)").alias("outstanding"),
        )
    )
    acc = read_table(spark, d, "lineitem", ["l_orderkey", "l_extendedprice"]).select(
        F.col("l_orderkey").alias("instrument"), money(F.col("l_extendedprice")).alias("carrying")
    )
    out = credit.exposure_by(fin, acc, ["instrument"], ["class"], ["outstanding", "carrying"])
    return out.select("class", *[as_double(F.col(c)).alias(c) for c in ("outstanding", "carrying")])


@query(
    "reports_repeated",
    f"""WITH {fx.DEFECTS_SQL}
        SELECT o_orderkey, o_orderstatus, count(*) AS rows, o_orderstatus IS NOT NULL AS is_complete
        FROM defects GROUP BY 1, 2 HAVING count(*) > 1 OR o_orderstatus IS NULL""",
)
def reports_repeated(spark, d):
    return credit.repeated_reports(fx.defects(spark, d), ["o_orderkey", "o_orderstatus"])


@query(
    "upsert_repeated",
    """WITH t AS (SELECT o_orderkey % 1000 AS k, max(o_orderkey) AS v FROM orders
                  WHERE o_orderkey % 3 = 0 GROUP BY 1),
          c AS (SELECT o_custkey % 2000 AS k, o_orderkey AS v FROM orders
                QUALIFY row_number() OVER (PARTITION BY o_custkey % 2000 ORDER BY o_orderkey DESC) = 1)
       SELECT * FROM t WHERE k NOT IN (SELECT k FROM c) UNION ALL SELECT * FROM c""",
)
def upsert_repeated(spark, d):
    """Many changes of one key: the last one counts."""
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    target = orders.filter(F.col("o_orderkey") % 3 == 0).groupBy(
        (F.col("o_orderkey") % 1000).alias("k")
    ).agg(F.max("o_orderkey").alias("v"))
    changes = orders.select((F.col("o_custkey") % 2000).alias("k"), F.col("o_orderkey").alias("v"))
    return upsert(target, changes, ["k"], "replace", [F.desc("v")])


@query(
    "mask_short",
    """SELECT n_nationkey, n_name, repeat('*', CASE WHEN length(n_name) > 7 THEN length(n_name) - 7
                ELSE length(n_name) END) || CASE WHEN length(n_name) > 7 THEN right(n_name, 7) ELSE '' END
                AS masked FROM nation""",
)
def mask_short(spark, d):
    """Texts no longer than what a mask shows stay hidden."""
    return read_table(spark, d, "nation", ["n_nationkey", "n_name"]).withColumn(
        "masked", s.mask_partial(F.col("n_name"), 7)
    )


ODD_KEYS_SQL = """
  odd_keys AS (SELECT o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN 'a||b'
         WHEN '4-NOT SPECIFIED' THEN 'a' ELSE 'a\\' END AS x,
    CASE o_orderpriority WHEN '3-MEDIUM' THEN 'c' WHEN '4-NOT SPECIFIED' THEN 'b||c'
         WHEN '5-LOW' THEN '|b' ELSE o_orderstatus END AS y,
    o_totalprice AS z FROM orders)"""


def _text_sql(col: str) -> str:
    return rf"coalesce(replace(replace({col}, '\', '\\'), '|', '\|'), '\N')"


def hash_sql(*cols: str) -> str:
    return "sha256(" + " || '||' || ".join(map(_text_sql, cols)) + ")"


def odd_keys(spark, d):
    """Keys with NULL, empty text, the separator and the escape."""
    orders = read_table(
        spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    )
    p = F.col("o_orderpriority")
    return orders.select(
        "o_orderkey",
        F.when(p == "1-URGENT", None).when(p == "2-HIGH", "").when(p == "3-MEDIUM", "a||b")
        .when(p == "4-NOT SPECIFIED", "a").otherwise("a\\").alias("x"),
        F.when(p == "3-MEDIUM", "c").when(p == "4-NOT SPECIFIED", "b||c").when(p == "5-LOW", "|b")
        .otherwise(F.col("o_orderstatus")).alias("y"),
        F.col("o_totalprice").alias("z"),
    )


@query(
    "hash_keys_odd",
    f"WITH {ODD_KEYS_SQL} SELECT o_orderkey, {hash_sql('x', 'y')} AS hash_key FROM odd_keys",
)
def hash_keys_odd(spark, d):
    return odd_keys(spark, d).select("o_orderkey", s.hash_of(["x", "y"]).alias("hash_key"))


@query(
    "dv_hub_odd_keys",
    f"""WITH {ODD_KEYS_SQL} SELECT DISTINCT {hash_sql('x', 'y')} AS hk, x, y,
          TIMESTAMP '{fx.DAY_1}' AS load_date, 'crm' AS record_source
        FROM odd_keys WHERE x IS NOT NULL AND y IS NOT NULL""",
)
def dv_hub_odd_keys(spark, d):
    return vault.load_hub(odd_keys(spark, d), ["x", "y"], "hk", fx.DAY_1, "crm")


@query(
    "dv_sat_odd_keys",
    f"""WITH {ODD_KEYS_SQL} SELECT {hash_sql('x', 'y')} AS hk, TIMESTAMP '{fx.DAY_1}' AS load_date,
          o_orderkey, {hash_sql('CAST(o_orderkey AS VARCHAR)')} AS hash_diff, 'crm' AS record_source
        FROM (SELECT x, y, max(o_orderkey) AS o_orderkey FROM odd_keys
              WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2)""",
)
def dv_sat_odd_keys(spark, d):
    """Many states of one key: the first in the given order is loaded."""
    return vault.load_satellite(
        odd_keys(spark, d), ["x", "y"], ["o_orderkey"], "hk", fx.DAY_1, "crm",
        order=[F.desc("o_orderkey")],
    )


@query(
    "dv_validate_odd_keys",
    """SELECT * FROM (VALUES ('satellite_hub', 'sat', 'hk', 'hub', CAST(0 AS BIGINT)),
                             ('hub_satellite', 'hub', 'hk', 'sat', CAST(0 AS BIGINT)))
       AS t(rule, table_name, column_name, parent, failed_rows)""",
)
def dv_validate_odd_keys(spark, d):
    """A fresh load of odd keys is clean."""
    hubs = {"hub": (dv_hub_odd_keys(spark, d), "hk")}
    sats = {"sat": (dv_sat_odd_keys(spark, d), "hk", "hub")}
    return vault.check_vault(hubs, {}, sats).drop("total_rows")


@query(
    "dv_rejected_keys",
    f"WITH {ODD_KEYS_SQL} SELECT count(*) AS rows FROM odd_keys WHERE x IS NULL OR y IS NULL",
)
def dv_rejected_keys(spark, d):
    return vault.rejected(odd_keys(spark, d), ["x", "y"]).agg(F.count(F.lit(1)).alias("rows"))


def _two_flows(spark, d):
    """Stages that pass, differ, differ in type, and fail only when they run."""
    base = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])
    moved = base.withColumn("c_nationkey", F.when(F.col("c_custkey") % 10 == 0, 0).otherwise(F.col("c_nationkey")))
    text = base.select("c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    number = base.select("c_custkey", F.expr("CAST(c_name AS INT)").alias("c_nationkey"))
    plain = base.select("c_custkey", "c_nationkey")
    a = {"same": base, "moved": base, "typed": plain, "broken": plain, "last": plain}
    b = {"same": base, "moved": moved, "typed": text, "broken": number, "last": plain}
    return a, b


CHANGED_SQL = "SELECT count(*) FROM customer WHERE c_custkey % 10 = 0 AND c_nationkey <> 0"


@query(
    "compare_stages_errors",
    f"""WITH n AS (SELECT count(*) AS n FROM customer), d AS (SELECT ({CHANGED_SQL}) AS d)
        SELECT 'same' AS cte_name, 'PASS' AS status, n AS rows_source, n AS rows_target,
               CAST(0 AS BIGINT) AS total_differences FROM n
        UNION ALL SELECT 'moved', 'FAIL', n, n, 2 * d FROM n, d
        UNION ALL SELECT 'typed', 'ERROR', NULL, NULL, NULL
        UNION ALL SELECT 'broken', 'ERROR', NULL, NULL, NULL
        UNION ALL SELECT 'last', 'PASS', n, n, 0 FROM n""",
)
def compare_stages_errors(spark, d):
    results, _ = cmp.compare_stages(*_two_flows(spark, d))
    return results.select("cte_name", "status", "rows_source", "rows_target", "total_differences")


@query(
    "compare_stage_columns",
    f"SELECT 'moved' AS stage, 'c_nationkey' AS column_name, ({CHANGED_SQL}) AS difference_count",
)
def compare_stage_columns(spark, d):
    """Column summaries: only of stages with differences."""
    keys = dict.fromkeys(("same", "moved", "typed", "broken"), ["c_custkey"])
    _, columns = cmp.compare_stages(*_two_flows(spark, d), keys)
    parts = [df.select(F.lit(name).alias("stage"), "*") for name, df in columns.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


INVESTIGATED_SQL = """
  a AS (SELECT l_suppkey % 100 AS k, l_returnflag AS x FROM lineitem WHERE l_linestatus = 'F'),
  b AS (SELECT l_suppkey % 100 AS k, nullif(l_returnflag, 'A') AS y FROM lineitem
        WHERE l_linestatus = 'O'),
  na AS (SELECT k, x, count(*) AS n FROM a GROUP BY ALL),
  nb AS (SELECT k, y, count(*) AS m FROM b GROUP BY ALL),
  p AS (SELECT na.k, x, y, n * m AS c FROM na JOIN nb ON na.k = nb.k WHERE x IS DISTINCT FROM y)"""


def _investigated(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_suppkey", "l_returnflag", "l_linestatus"])
    key, status = (F.col("l_suppkey") % 100).alias("k"), F.col("l_linestatus")
    return cmp.investigate(
        lines.filter(status == "F").select(key, F.col("l_returnflag").alias("flag")),
        lines.filter(status == "O").select(key, F.nullif("l_returnflag", F.lit("A")).alias("flag")),
        ["k"], "flag", 30,
    )


@query("investigate_count", f"WITH {INVESTIGATED_SQL} SELECT CAST(sum(c) AS BIGINT) AS diff_count FROM p")
def investigate_count(spark, d):
    return _investigated(spark, d)["count"]


@query(
    "investigate_samples",
    f"""WITH {INVESTIGATED_SQL}
        SELECT k, x AS source_flag, y AS target_flag
        FROM (SELECT k, x, y, unnest(generate_series(1, least(c, 30))) FROM p)
        ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 30""",
)
def investigate_samples(spark, d):
    return _investigated(spark, d)["samples"]


@query(
    "lineage_hop_edges",
    """WITH e AS (
         SELECT DISTINCT 's' || l_suppkey AS source, 'p' || l_partkey AS target, 'derived' AS mapping_type
         FROM lineitem
         UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, 'rename' FROM supplier
         UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, 'direct' FROM nation),
       r AS (SELECT 'p' || p_partkey AS root FROM part),
       one AS (SELECT root, source, target, mapping_type FROM r JOIN e ON target = root),
       two AS (SELECT DISTINCT root, e.source, e.target, e.mapping_type FROM one JOIN e ON e.target = one.source),
       three AS (SELECT DISTINCT root, e.source, e.target, e.mapping_type FROM two JOIN e ON e.target = two.source)
       SELECT *, CAST(1 AS BIGINT) AS depth FROM one UNION ALL SELECT *, 2 FROM two
       UNION ALL SELECT *, 3 FROM three""",
)
def lineage_hop_edges(spark, d):
    """What every hop upstream of each part carries."""
    lines = read_table(spark, d, "lineitem", ["l_suppkey", "l_partkey"])
    supplier = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    nation = read_table(spark, d, "nation", ["n_nationkey", "n_regionkey"])

    def edges(df, far, near, kind):
        return df.select(
            F.concat(F.lit(far[0]), F.col(far[1])).alias("source"),
            F.concat(F.lit(near[0]), F.col(near[1])).alias("target"), F.lit(kind).alias("mapping_type"),
        )

    every = (
        edges(lines, ("s", "l_suppkey"), ("p", "l_partkey"), "derived").distinct()
        .unionByName(edges(supplier, ("n", "s_nationkey"), ("s", "s_suppkey"), "rename"))
        .unionByName(edges(nation, ("r", "n_regionkey"), ("n", "n_nationkey"), "direct"))
    )
    roots = read_table(spark, d, "part", ["p_partkey"]).select(
        F.concat(F.lit("p"), F.col("p_partkey")).alias("root")
    )
    return lineage.hop_edges(every, roots, 3, ["mapping_type"])


@query(
    "txn_reversals",
    f"""WITH {fx.LEDGER_SQL},
          r AS (SELECT account, txn_id, amount, CASE WHEN status = 'P' THEN txn_id - 1 END AS o FROM ledger)
        SELECT r.account, r.txn_id, CAST(x.amount AS DOUBLE) AS original_amount,
               CASE WHEN o IS NULL THEN NULL WHEN x.amount IS NULL THEN 'MISSING'
                    WHEN x.amount + r.amount = 0 THEN 'FULL' ELSE 'PARTIAL' END AS reversal_status
        FROM r LEFT JOIN ledger x ON x.txn_id = o""",
)
def txn_reversals(spark, d):
    """Reversals looked up in the transactions: each pending order reverses the one before it."""
    ledger = (
        fx.ledger(spark, d)
        .withColumn("amount", cents_to_money(F.col("amount")))
        .withColumn("original_id", F.when(F.col("status") == "P", F.col("txn_id") - 1))
    )
    out = star.derive_transactions(
        ledger, "account", ["txn_ts", "txn_id"], "amount", original="original_id", txn="txn_id"
    )
    return out.select(
        "account", "txn_id", as_double(F.col("original_amount")).alias("original_amount"), "reversal_status"
    )


@query(
    "materialise_scd2",
    f"WITH {fx.HISTORY_SQL} SELECT c_custkey, last_priority, last_status, is_current FROM history",
)
def materialise_scd2_query(spark, d):
    """A first load, then a merge that reads the version before it."""
    path = work_path(spark, "scd2-table")
    first = scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), ["c_custkey"], fx.DAY_1)
    one = materialise_scd2(first, path, 1)
    merged = scd.scd2_apply(one, fx.snapshot(spark, d, fx.DAY_2), ["c_custkey"], fx.TRACKED, fx.DAY_2)
    two = materialise_scd2(merged, path, 2)
    return two.select("c_custkey", *fx.TRACKED, "is_current")
