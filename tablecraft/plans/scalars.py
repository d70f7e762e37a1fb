"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions import scalars as s
from tablecraft.plans.registry import query
from tablecraft.sources.tables import read_table


@query(
    "scalar_string",
    """SELECT c_custkey, trim(upper(c_name)) AS upper_name, lower(c_mktsegment) AS lower_segment,
              substring(c_name, 1, 10) AS prefix FROM customer""",
)
def scalar_string(spark, d):
    customer = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return customer.select(
        "c_custkey",
        F.trim(F.upper("c_name")).alias("upper_name"),
        F.lower("c_mktsegment").alias("lower_segment"),
        F.substring("c_name", 1, 10).alias("prefix"),
    )


@query(
    "scalar_concat",
    """SELECT event_id, event_type || ':' || CAST(user_id AS VARCHAR) AS label,
              upper(substring(event_type, 1, 1)) || lower(substring(event_type, 2)) AS title
       FROM events""",
)
def scalar_concat(spark, d):
    events = read_table(spark, d, "events", ["event_id", "event_type", "user_id"])
    return events.select(
        "event_id",
        F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")).alias("label"),
        s.title_words(F.col("event_type")).alias("title"),
    )


# Words of a part name against the words of its type and name together.
@query(
    "token_overlap",
    r"""WITH w AS (
          SELECT p_partkey, list_distinct(regexp_split_to_array(lower(p_name), '[_\s]+')) AS a,
                 list_distinct(regexp_split_to_array(lower(p_type || ' ' || p_name), '[_\s]+')) AS b
          FROM part)
        SELECT p_partkey, CAST(len(a) AS BIGINT) AS name_words, CAST(len(b) AS BIGINT) AS all_words,
               CAST(len(list_intersect(a, b)) AS BIGINT) AS overlap FROM w""",
)
def token_overlap(spark, d):
    part = read_table(spark, d, "part", ["p_partkey", "p_name", "p_type"])
    a = s.words(F.col("p_name"))
    b = s.words(F.concat_ws(" ", "p_type", "p_name"))
    return part.select(
        "p_partkey",
        F.size(a).cast("long").alias("name_words"),
        F.size(b).cast("long").alias("all_words"),
        s.word_overlap(a, b).cast("long").alias("overlap"),
    )


@query(
    "scalar_regex",
    """SELECT p_partkey, regexp_matches(p_name, 'ring|rod') AS found,
              regexp_matches(p_name, '^(?:red|blue)') AS anchored FROM part""",
)
def scalar_regex(spark, d):
    part = read_table(spark, d, "part", ["p_partkey", "p_name"])
    return part.select(
        "p_partkey",
        s.regex_search(F.col("p_name"), "ring|rod").alias("found"),
        s.regex_match(F.col("p_name"), "red|blue").alias("anchored"),
    )


@query(
    "scalar_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, mod(l_partkey, 7) AS bucket,
              CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                         * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DOUBLE) AS net,
              CAST(CAST(l_quantity AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE)
                AS plus
       FROM lineitem""",
)
def scalar_math(spark, d):
    lines = read_table(
        spark, d, "lineitem",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_quantity",
         "l_tax"],
    )
    net = s.money(F.col("l_extendedprice")) * (F.lit(1) - s.money(F.col("l_discount")))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.pmod(F.col("l_partkey"), F.lit(7)).cast("long").alias("bucket"),
        s.as_double(F.round(net, 2)).alias("net"),
        s.as_double(s.money(F.col("l_quantity")) + s.money(F.col("l_tax"))).alias("plus"),
    )


@query(
    "scalar_date",
    """SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2001-12-31') AS age_days,
              strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders""",
)
def scalar_date(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return orders.select(
        "o_orderkey",
        s.days_between(F.col("o_orderdate"), s.ts("2001-12-31 00:00:00")).alias("age_days"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
    )


def calendar_sql(day: str) -> str:
    """Calendar columns of a DuckDB date expression, fiscal year from April."""
    f = f"CAST({day} + INTERVAL 9 MONTH AS DATE)"
    first = f"CAST(date_trunc('year', {f}) - INTERVAL 9 MONTH AS DATE)"
    return f"""
      CAST(strftime({day}, '%Y%m%d') AS BIGINT) AS date_sk, isodow({day}) AS day_of_week,
      day({day}) AS day_of_month, dayofyear({day}) AS day_of_year, week({day}) AS week_of_year,
      month({day}) AS month_number, monthname({day}) AS month_name,
      substring(monthname({day}), 1, 3) AS month_name_short, quarter({day}) AS quarter_number,
      'Q' || quarter({day}) AS quarter_name, year({day}) AS year_number,
      strftime({day}, '%Y-%m') AS year_month,
      strftime({day}, '%Y') || '-Q' || quarter({day}) AS year_quarter, dayname({day}) AS day_name,
      substring(dayname({day}), 1, 3) AS day_name_short, isodow({day}) >= 6 AS is_weekend,
      year({f}) AS fiscal_year, quarter({f}) AS fiscal_quarter, month({f}) AS fiscal_month,
      CAST(date_diff('day', {first}, {day}) // 7 + 1 AS BIGINT) AS fiscal_week"""


@query(
    "scalar_calendar",
    f"SELECT o_orderkey, {calendar_sql('dy')} "
    "FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dy FROM orders)",
)
def scalar_calendar(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    day = F.to_date("o_orderdate")
    return orders.select(
        "o_orderkey", *[c.alias(n) for n, c in s.calendar_parts(day).items()]
    )


@query(
    "scalar_cast_sentinel",
    """SELECT o_orderkey, strftime(CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00'
                 AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS stamped,
              strftime(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END,
                TIMESTAMP '9999-12-31 23:59:59'), '%Y-%m-%d %H:%M:%S') AS valid_to FROM orders""",
)
def scalar_cast_sentinel(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"])
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 12:30:00"))
    end = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return orders.select(
        "o_orderkey",
        F.date_format(text.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("stamped"),
        F.date_format(s.open_end(end), "yyyy-MM-dd HH:mm:ss").alias("valid_to"),
    )


@query(
    "hash_keys",
    """SELECT c_custkey, sha256(c_name) AS hash_key,
              sha256(c_mktsegment || '||' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR))
                AS hash_diff FROM customer""",
)
def hash_keys(spark, d):
    customer = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    return customer.select(
        "c_custkey",
        s.hash_of(["c_name"]).alias("hash_key"),
        s.hash_of(["c_mktsegment", s.money(F.col("c_acctbal"))]).alias("hash_diff"),
    )


@query(
    "mask_pii",
    """SELECT c_custkey, sha256(c_name) AS name_hash,
              repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) AS name_partial
       FROM customer""",
)
def mask_pii(spark, d):
    customer = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    return customer.select(
        "c_custkey",
        s.mask_hash(F.col("c_name")).alias("name_hash"),
        s.mask_partial(F.col("c_name")).alias("name_partial"),
    )


@query(
    "scalar_case_coalesce",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O'
                THEN 'open' ELSE 'other' END AS state,
              coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'none') AS priority
       FROM orders""",
)
def scalar_case_coalesce(spark, d):
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    status = F.col("o_orderstatus")
    return orders.select(
        "o_orderkey",
        F.when(status == "F", "done").when(status == "O", "open").otherwise("other").alias("state"),
        F.coalesce(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")), F.lit("none")).alias(
            "priority"
        ),
    )
