"""Star schemas, balances, calendar and credit measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions.scalars import (
    as_double,
    cents,
    cents_to_money,
    money,
    ts,
    units,
    wide_sum,
)
from tablecraft.operators import credit, star
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.plans.scalars import calendar_sql
from tablecraft.session import cut_lineage
from tablecraft.sources.tables import joined_rows, read_table, rows

DIM_ATTRS = ["c_name", "c_mktsegment", "last_priority"]


@query(
    "build_dim_customer",
    """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey, c_name,
              c_mktsegment, c_nationkey FROM customer""",
)
def build_dim_customer(spark, d):
    return star.build_dim(
        read_table(spark, d, "customer"), ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"],
        sk="customer_sk",
    )


@query(
    "build_dim_customer_scd2",
    f"""WITH {fx.SNAPSHOTS_SQL}
        SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey, c_name,
               c_mktsegment, last_priority, '{fx.DAY_1}' AS valid_from,
               '9999-12-31 23:59:59' AS valid_to, true AS is_current,
               sha256(CAST(c_custkey AS VARCHAR) || '||{fx.DAY_1}') AS version_key
        FROM snapshot_1""",
)
def build_dim_customer_scd2(spark, d):
    dim = star.build_dim(
        fx.snapshot(spark, d, fx.DAY_1), ["c_custkey"], DIM_ATTRS, scd=2, as_of=fx.DAY_1,
        sk="customer_sk",
    )
    return fx.with_text_stamps(dim)


def fact_members(spark, d):
    """Members of the fact's dimensions by surrogate key, which stands beside the natural one.

    They are stored, so Spark knows which are small enough to broadcast.
    """
    def members(src, key, sk):
        return cut_lineage(star.build_dim(src, [key], [], sk=sk), "members")

    return {
        "customer_sk": members(fx.snapshot(spark, d, fx.DAY_1), "c_custkey", "customer_sk"),
        "part_sk": members(read_table(spark, d, "part", ["p_partkey"]), "p_partkey", "part_sk"),
        "supplier_sk": members(read_table(spark, d, "supplier", ["s_suppkey"]), "s_suppkey", "supplier_sk"),
    }


def _order_columns():
    return {
        "o_orderkey": F.col("o_orderkey"),
        "date_key": F.date_format("o_orderdate", "yyyyMMdd").cast("long"),
    }


def _sales(spark, d, orders):
    return fx.fact_rows(spark, d).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _sales_measures():
    return {
        "quantity": units(F.col("quantity")),
        "sales_amount": units(F.col("price")),
        "discount_rate": units(F.col("discount")),
    }


def _dated_orders(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return star.build_fact(orders, {}, measures={}, degenerate=_order_columns())


def sales_core(spark, d):
    """The rows of the fact before its lookups, each of which keeps every row at least once."""
    return star.build_fact(
        _sales(spark, d, _dated_orders(spark, d)), {}, measures=_sales_measures(),
        degenerate={"date_key": F.col("date_key")},
    )


def sales_join(spark, d):
    """What ``sales_core`` joins: the dates of the orders, the measures of the lines, the number of rows."""
    lines, orders = fx.fact_rows(spark, d), _dated_orders(spark, d)
    measures = star.build_fact(lines, {}, measures=_sales_measures())
    return [orders.select("date_key"), measures], joined_rows(lines, orders, "l_orderkey", "o_orderkey")


def fact_sales(spark, d, members=None):
    """Line items with surrogate keys; customers unknown on day 1 get the unknown member.

    The orders, fewer than their lines, take the keys of their customers before they meet
    the lines. ``members`` are the ``fact_members``, where they are stored already.
    """
    members = members or fact_members(spark, d)
    orders = star.build_fact(
        read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
        {"customer_sk": (members["customer_sk"], "o_custkey", "c_custkey", "customer_sk")},
        measures={},
        degenerate=_order_columns(),
    )
    fact = star.build_fact(
        _sales(spark, d, orders),
        {
            "part_sk": (members["part_sk"], "l_partkey", "p_partkey", "part_sk"),
            "supplier_sk": (members["supplier_sk"], "l_suppkey", "s_suppkey", "supplier_sk"),
        },
        measures=_sales_measures(),
        degenerate={"customer_sk": F.col("customer_sk"), "date_key": F.col("date_key")},
    )
    return fact.select("customer_sk", "part_sk", "supplier_sk", "date_key", "quantity", "sales_amount", "discount_rate")


FACT_SQL = f"""
  fact_sales AS (
    SELECT coalesce(c.sk, -1) AS customer_sk, coalesce(p.sk, -1) AS part_sk,
           coalesce(s.sk, -1) AS supplier_sk,
           CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
           CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS sales_amount,
           CAST(discount AS DOUBLE) AS discount_rate
    FROM fact_rows JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) AS sk
               FROM snapshot_1) c ON o_custkey = c.k
    LEFT JOIN (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey) AS sk
               FROM part) p ON l_partkey = p.k
    LEFT JOIN (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_suppkey) AS sk
               FROM supplier) s ON l_suppkey = s.k)"""


@query(
    "build_fact_sales",
    f"WITH {fx.SNAPSHOTS_SQL}, {fx.FACT_ROWS_SQL}, {FACT_SQL} SELECT * FROM fact_sales",
)
def build_fact_sales(spark, d):
    return fact_sales(spark, d)


RATES = [("USD", "0.920000"), ("GBP", "1.170000")]
CURRENCY = {"F": "USD", "O": "GBP"}


@query(
    "txn_derivations",
    f"""WITH {fx.LEDGER_SQL}, r AS (
          SELECT *, CASE status WHEN 'F' THEN 0.92::DECIMAL(18,6)
                                WHEN 'O' THEN 1.17::DECIMAL(18,6) END AS rate FROM ledger)
        SELECT account, txn_id, CAST(greatest(amount, 0) AS DOUBLE) AS amount_credit,
               CAST(greatest(-amount, 0) AS DOUBLE) AS amount_debit,
               CAST(round(amount * rate, 2) AS DOUBLE) AS amount_eur,
               status = 'P' AS reversal_flag,
               CAST(sum(amount) OVER (PARTITION BY account ORDER BY txn_ts, txn_id
                 ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance_after
        FROM r""",
)
def txn_derivations(spark, d):
    status = F.col("status")
    currency = F.when(status == "F", "USD").when(status == "O", "GBP").otherwise("XXX")
    ledger = (
        fx.ledger(spark, d)
        .withColumn("amount", cents_to_money(F.col("amount")))
        .withColumn("currency_code", currency)
        .withColumn("original_id", F.when(status == "P", F.col("txn_id")))
    )
    rates = rows(spark, RATES, "currency_code string, rate string").select(
        "currency_code", F.col("rate").cast("decimal(18,6)").alias("exchange_rate")
    )
    out = star.derive_transactions(
        ledger, "account", ["txn_ts", "txn_id"], "amount", rates, original="original_id"
    )
    return out.select(
        "account", "txn_id", "reversal_flag",
        *[as_double(F.col(c)).alias(c)
          for c in ("amount_credit", "amount_debit", "amount_eur", "balance_after")],
    )


MONEY_COLUMNS = [
    "balance_opening", "balance_closing", "balance_minimum", "balance_maximum",
    "total_credits", "total_debits", "net_change", "overdraft_used",
]


def _snapshot_sql(first: str, last: str) -> str:
    return f"""WITH t AS (
         SELECT user_id, event_id, ts, CAST(ts AS DATE) AS day,
                CAST(CASE WHEN event_type IN ('purchase', 'signup') THEN value
                          WHEN event_type = 'error' THEN -value ELSE 0 END AS DECIMAL(18,2)) AS a
         FROM events),
       b AS (SELECT *, sum(a) OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS UNBOUNDED PRECEDING) AS bal FROM t),
       g AS (SELECT user_id, day, arg_max(bal, {{'t': ts, 'i': event_id}}) AS closing,
                    min(bal) AS low, max(bal) AS high, sum(bal) AS s, count(*) AS n,
                    count(*) FILTER (a > 0) AS nc, count(*) FILTER (a < 0) AS nd,
                    coalesce(sum(a) FILTER (a > 0), 0) AS c,
                    coalesce(sum(-a) FILTER (a < 0), 0) AS d
             FROM b GROUP BY 1, 2),
       days AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM t),
                  (SELECT max(day) FROM t), INTERVAL 1 DAY)) AS DATE) AS day),
       grid AS (SELECT u.user_id, days.day, g.* EXCLUDE (user_id, day)
                FROM (SELECT user_id, min(day) AS since FROM t GROUP BY 1) u
                JOIN days ON days.day >= u.since
                LEFT JOIN g ON g.user_id = u.user_id AND g.day = days.day),
       f AS (SELECT *, last_value(closing IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day
               ROWS UNBOUNDED PRECEDING) AS cc FROM grid),
       o AS (SELECT *, coalesce(lag(cc) OVER (PARTITION BY user_id ORDER BY day), 0) AS op,
                    coalesce(cc, 0) AS cl FROM f),
       x AS (SELECT *, CAST((op + coalesce(s, 0)) * 100 AS HUGEINT) AS cents,
                    coalesce(n, 0) + 1 AS m FROM o)
       SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CAST(op AS DOUBLE) AS balance_opening,
              CAST(cl AS DOUBLE) AS balance_closing,
              CAST(least(op, coalesce(low, op)) AS DOUBLE) AS balance_minimum,
              CAST(greatest(op, coalesce(high, op)) AS DOUBLE) AS balance_maximum,
              CAST(CASE WHEN cents < 0 THEN -((-cents * 2 + m) // (2 * m))
                        ELSE (cents * 2 + m) // (2 * m) END AS DOUBLE) / 100 AS balance_average,
              coalesce(n, 0) AS transaction_count, coalesce(nc, 0) AS credit_count,
              coalesce(nd, 0) AS debit_count, CAST(coalesce(c, 0) AS DOUBLE) AS total_credits,
              CAST(coalesce(d, 0) AS DOUBLE) AS total_debits,
              CAST(coalesce(c, 0) - coalesce(d, 0) AS DOUBLE) AS net_change,
              CAST(greatest(-cl, 0) AS DOUBLE) AS overdraft_used, cl < 0 AS is_overdrawn
       FROM x WHERE day BETWEEN {first} AND {last}"""


def _snapshot(spark, d, first=None, last=None):
    events = read_table(spark, d, "events", ["user_id", "event_id", "ts", "event_type", "value"])
    kind = F.col("event_type")
    amount = (
        F.when(kind.isin("purchase", "signup"), F.col("value"))
        .when(kind == "error", -F.col("value"))
        .otherwise(F.lit(0.0))
    )
    txn = events.select("user_id", "event_id", "ts", money(amount).alias("amount"))
    begin, end = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    out = star.daily_snapshot(
        txn, "user_id", "ts", ["ts", "event_id"], "amount", first or str(begin), last or str(end)
    )
    for c in MONEY_COLUMNS:
        out = out.withColumn(c, as_double(F.col(c)))
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("daily_snapshot", _snapshot_sql("(SELECT min(day) FROM t)", "(SELECT max(day) FROM t)"))
def daily_snapshot(spark, d):
    return _snapshot(spark, d)


@query("daily_snapshot_period", _snapshot_sql("DATE '2024-01-05'", "DATE '2024-01-20'"))
def daily_snapshot_period(spark, d):
    """A period within the activity: balances are carried in, later accounts are left out."""
    return _snapshot(spark, d, "2024-01-05", "2024-01-20")


@query(
    "dormant_customers",
    """SELECT c_custkey, last_activity, last_activity IS NULL OR last_activity
                <= TIMESTAMP '2000-08-01' AS is_dormant
       FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_activity FROM orders
                                GROUP BY 1) ON c_custkey = o_custkey""",
)
def dormant_customers(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_orderdate"]).withColumnRenamed(
        "o_custkey", "c_custkey"
    )
    return star.status_flags(
        read_table(spark, d, "customer", ["c_custkey"]), orders, "c_custkey", "o_orderdate",
        "2001-08-01 00:00:00",
    )


@query(
    "below_minimum",
    f"""WITH {fx.LEDGER_SQL}
        SELECT account, CAST(b AS DOUBLE) AS balance, b < 0 AS is_overdrawn,
               b < 250000 AS is_below_minimum
        FROM (SELECT account, sum(amount) AS b FROM ledger GROUP BY 1)""",
)
def below_minimum(spark, d):
    totals = fx.ledger(spark, d).groupBy("account").agg(F.sum("amount").alias("b"))
    flagged = star.below_minimum(totals, "b", F.lit(25_000_000))
    return flagged.select(
        "account", units(F.col("b")).alias("balance"), (F.col("b") < 0).alias("is_overdrawn"),
        "is_below_minimum",
    )


HOLIDAYS = {"01-01": "New Year", "12-25": "Christmas Day"}
TODAY = "1998-06-15"


@query(
    "date_dimension",
    f"""WITH days AS (SELECT CAST(unnest(generate_series(
          (SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
          (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY)) AS DATE) AS dy),
        c AS (SELECT dy, {calendar_sql('dy')},
          CASE strftime(dy, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '12-25'
               THEN 'Christmas Day' END AS holiday_name FROM days)
        SELECT * EXCLUDE (dy), strftime(dy, '%Y-%m-%d') AS date_value,
               holiday_name IS NOT NULL AS is_holiday,
               NOT is_weekend AND holiday_name IS NULL AS is_business_day,
               dy = DATE '{TODAY}' AS is_current_day,
               date_trunc('month', dy) = date_trunc('month', DATE '{TODAY}') AS is_current_month,
               year(dy) = 1998 AS is_current_year FROM c""",
)
def date_dimension(spark, d):
    """Calendar over the dates the orders span."""
    bounds = read_table(spark, d, "orders", ["o_orderdate"]).agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.max("o_orderdate")).alias("last_day"),
    )
    out = star.date_dim(bounds, 4, HOLIDAYS, TODAY)
    return out.withColumn("date_value", F.date_format("date_value", "yyyy-MM-dd"))


@query(
    "star_revenue_by_nation_year",
    """SELECT n_name, year(o_orderdate) AS order_year,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))
                       * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       GROUP BY 1, 2""",
)
def star_revenue_by_nation_year(spark, d):
    # revenue per order first: the joins then move one row per order
    per_order = fx.fact_rows(spark, d).groupBy("l_orderkey").agg(
        F.sum(F.col("price") * (F.lit(100) - F.col("discount"))).alias("r")
    )
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).withColumn(
        "order_year", F.year("o_orderdate").cast("long")
    )
    return star.star_query(
        per_order,
        [
            (orders, "l_orderkey", "o_orderkey"),
            (read_table(spark, d, "customer", ["c_custkey", "c_nationkey"]), "o_custkey", "c_custkey"),
            (read_table(spark, d, "nation", ["n_nationkey", "n_name"]), "c_nationkey", "n_nationkey"),
        ],
        ["n_name", "order_year"],
        [units(wide_sum(F.col("r")), 4).alias("revenue")],
    )


@query(
    "star_unmatched",
    f"""WITH {fx.DEFECTS_SQL}
        SELECT 'customer' AS dimension, count(*) AS fact_rows,
               count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer))
                 AS unmatched_rows FROM defects
        UNION ALL SELECT 'part', count(*),
               count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem""",
)
def star_unmatched(spark, d):
    a = star.star_unmatched(
        fx.defects(spark, d),
        {"customer": (read_table(spark, d, "customer"), "o_custkey", "c_custkey")},
    )
    b = star.star_unmatched(
        read_table(spark, d, "lineitem", ["l_partkey"]),
        {"part": (read_table(spark, d, "part"), "l_partkey", "p_partkey")},
    )
    return a.unionByName(b)


@query(
    "grain_check",
    """SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS grain_groups,
              count(*) FILTER (n > 1) AS duplicate_groups, count(*) FILTER (n > 1) = 0 AS is_unique
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def grain_check(spark, d):
    return star.check_grain(
        read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"]),
        ["l_orderkey", "l_linenumber"],
    )


# --------------------------------------------------------------------- credit


def ratio_sql(top: str, bottom: str) -> str:
    """Ratio of two cent amounts, half up to four digits."""
    return f"CAST(({top} * 20000 + {bottom}) // (2 * {bottom}) AS DOUBLE) / 10000"


def _loans(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"])
    return orders.select(
        F.col("o_custkey").alias("c_custkey"), money(F.col("o_totalprice")).alias("loan")
    )


@query(
    "ltv",
    f"""SELECT c_custkey, CAST(t AS DOUBLE) AS secured_loans,
               {ratio_sql('CAST(t * 100 AS HUGEINT)', '100000000')} AS loan_to_value
        FROM customer JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
                            FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def ltv(spark, d):
    homes = read_table(spark, d, "customer", ["c_custkey"]).withColumn(
        "property_value", F.lit("1000000.00").cast("decimal(18,2)")
    )
    out = credit.ltv(_loans(spark, d), homes, "c_custkey", "loan", "property_value")
    return out.select(
        "c_custkey", as_double(F.col("secured_loans")).alias("secured_loans"),
        as_double(F.col("loan_to_value")).alias("loan_to_value"),
    )


INCOME_SQL = """
  income AS (SELECT c_nationkey, sum(CAST(c_acctbal AS DECIMAL(18,2)) + 10000) AS i,
                    count(*) AS members FROM customer GROUP BY 1)"""


def _incomes(spark, d):
    members = read_table(spark, d, "customer", ["c_nationkey", "c_acctbal"]).select(
        "c_nationkey", (money(F.col("c_acctbal")) + F.lit(10000)).alias("income")
    )
    return credit.household_income(members, "c_nationkey", "income")


@query(
    "household_income",
    f"WITH {INCOME_SQL} SELECT c_nationkey, CAST(i AS DOUBLE) AS household_income, members FROM income",
)
def household_income(spark, d):
    return _incomes(spark, d).withColumn("household_income", as_double(F.col("household_income")))


@query(
    "dti",
    f"""WITH {INCOME_SQL}, l AS (
          SELECT c_nationkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
        SELECT c_nationkey, CAST(t AS DOUBLE) AS loan_amount,
               {ratio_sql('CAST(t * 100 AS HUGEINT)', 'CAST(i * 100 AS HUGEINT)')}
                 AS debt_to_income
        FROM l JOIN income USING (c_nationkey)""",
)
def dti(spark, d):
    per_customer = _loans(spark, d).groupBy("c_custkey").agg(F.sum("loan").alias("loan"))
    loans = per_customer.join(
        read_table(spark, d, "customer", ["c_custkey", "c_nationkey"]), "c_custkey"
    )
    out = credit.dti(loans, _incomes(spark, d), "c_nationkey", "loan")
    return out.select(
        "c_nationkey", as_double(F.col("loan_amount")).alias("loan_amount"),
        as_double(F.col("debt_to_income")).alias("debt_to_income"),
    )


@query(
    "default_status",
    """WITH s AS (
         SELECT l_orderkey, l_linenumber,
                date_diff('day', l_shipdate, TIMESTAMP '2001-12-01') > 90 AS late,
                l_returnflag = 'R' AS doubt FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN late AND doubt THEN 'DEFAULT_BOTH'
                   WHEN late THEN 'DEFAULT_MORE_THAN_90_DAYS'
                   WHEN doubt THEN 'DEFAULT_UNLIKELY_TO_PAY' ELSE 'NOT_IN_DEFAULT' END
                AS default_status FROM s""",
)
def default_status(spark, d):
    lines = read_table(
        spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"]
    )
    state = credit.default_status(
        F.col("l_shipdate"), F.col("l_returnflag") == "R", ts("2001-12-01 00:00:00")
    )
    return lines.select("l_orderkey", "l_linenumber", state.alias("default_status"))


@query(
    "reporting_snapshot",
    f"""WITH {fx.LEDGER_SQL}, m AS (
          SELECT account, strftime(txn_ts, '%Y-%m') AS reporting_month, sum(amount) AS net,
                 count(*) AS n FROM ledger GROUP BY 1, 2)
        SELECT account, reporting_month, CAST(net AS DOUBLE) AS net_change, n AS transactions
        FROM m WHERE reporting_month = '1998-06'""",
)
def reporting_snapshot(spark, d):
    month = F.date_format("txn_ts", "yyyy-MM")
    reports = fx.ledger(spark, d).withColumn("reporting_month", month)
    one = credit.snapshot_for(reports, "reporting_month", F.lit("1998-06"))
    return one.groupBy("account", "reporting_month").agg(
        units(F.sum("amount")).alias("net_change"), F.count(F.lit(1)).alias("transactions")
    )


@query(
    "exposure_by",
    """WITH f AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
                         CAST(o_totalprice AS DECIMAL(18,2)) AS outstanding FROM orders),
       a AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS carrying,
                    sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)))
                      AS impairment FROM lineitem GROUP BY 1)
       SELECT o_orderstatus, o_orderpriority, CAST(sum(outstanding) AS DOUBLE) AS outstanding,
              CAST(sum(carrying) AS DOUBLE) AS carrying, CAST(sum(impairment) AS DOUBLE) AS impairment
       FROM f LEFT JOIN a ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def exposure_by(spark, d):
    fin = read_table(
        spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    ).select(
        F.col("o_orderkey").alias("instrument"), "o_orderstatus", "o_orderpriority",
        cents(F.col("o_totalprice")).alias("outstanding"),
    )
    acc = fx.fact_rows(spark, d).select(
        F.col("l_orderkey").alias("instrument"), F.col("price").alias("carrying"),
        (F.col("price") * F.col("discount")).alias("impairment"),
    )
    amounts = ["outstanding", "carrying", "impairment"]
    out = credit.exposure_by(
        fin, acc, ["instrument"], ["o_orderstatus", "o_orderpriority"], amounts
    )
    return out.select(
        "o_orderstatus", "o_orderpriority", units(F.col("outstanding")).alias("outstanding"),
        units(F.col("carrying")).alias("carrying"), units(F.col("impairment"), 4).alias("impairment"),
    )
