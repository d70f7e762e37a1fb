"""Star schemas: dimensions, facts, calendar, balances and star checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import avg_money, calendar_parts, ts
from tablecraft.operators.scd import scd2_init
from tablecraft.operators.windows import Ordered, assign_sk, ordered

UNKNOWN_MEMBER = -1


def build_dim(
    src: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    scd: int = 1,
    as_of: str | None = None,
    sk: str = "sk",
) -> DataFrame:
    """Dimension rows: sequence key, natural key, attributes, history for type 2."""
    rows = src.select(*keys, *attrs)
    if scd == 2:
        rows = scd2_init(rows, keys, as_of, sk="version_key")
    return assign_sk(rows, [*keys, *(["valid_from"] if scd == 2 else [])], out=sk)


def build_fact(
    src: DataFrame,
    lookups: Mapping[str, tuple[DataFrame, str, str, str]],
    measures: Mapping[str, Column],
    degenerate: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fact rows: surrogate key per lookup, degenerate columns and measures.

    ``lookups``: output column -> (dimension, source key, dimension key,
    dimension surrogate). A key without a member gets the unknown member -1.
    """
    degenerate = degenerate or {}
    out = src.select(
        *[F.col(spec[1]).alias(f"_k_{name}") for name, spec in lookups.items()],
        *[c.alias(n) for n, c in degenerate.items()],
        *[c.alias(n) for n, c in measures.items()],
    )
    for name, (dim, _, dim_key, dim_sk) in lookups.items():
        members = dim.select(F.col(dim_key).alias(f"_d_{name}"), F.col(dim_sk).alias(f"_s_{name}"))
        out = out.join(members, out[f"_k_{name}"] == members[f"_d_{name}"], "left")
    found = [
        F.coalesce(f"_s_{name}", F.lit(UNKNOWN_MEMBER)).cast("long").alias(name) for name in lookups
    ]
    return out.select(*found, *degenerate, *measures)


def derive_transactions(
    df: DataFrame,
    account: str,
    order: Sequence[str],
    amount: str,
    rates: DataFrame | None = None,
    currency: str = "currency_code",
    original: str | None = None,
    txn: str | None = None,
) -> DataFrame:
    """Credit and debit split, EUR amount, running balance and reversal flag.

    ``rates``: (currency, rate to EUR). Without a rate the EUR amount is NULL.
    ``original`` names the column with the reversed transaction, if any. With ``txn``,
    the column that identifies a transaction, the reversed one is looked up in ``df``:
    its amount as ``original_amount``, and ``reversal_status`` says whether it exists
    and the amounts cancel (FULL, PARTIAL, MISSING; NULL for other rows).
    """
    zero = F.lit(0).cast("decimal(18,2)")
    value = F.col(amount)
    split = df.withColumn("amount_credit", F.when(value > 0, value).otherwise(zero)).withColumn(
        "amount_debit", F.when(value < 0, -value).otherwise(zero)
    )
    if rates is not None:
        factor = rates.select(F.col(currency).alias("_c"), F.col("exchange_rate"))
        split = split.join(factor, split[currency] == factor["_c"], "left").drop("_c")
        split = split.withColumn(
            "amount_eur", F.round(value * F.col("exchange_rate"), 2).cast("decimal(18,2)")
        )
    if original is not None:
        split = split.withColumn("reversal_flag", F.col(original).isNotNull())
    if original is not None and txn is not None:
        # few rows reverse another one: only these meet the transactions
        reversing = df.filter(F.col(original).isNotNull()).select(F.col(original).alias("_o")).distinct()
        found = df.join(reversing, F.col(txn) == F.col("_o")).groupBy("_o").agg(
            F.sum(value).alias("original_amount")
        )
        split = split.join(found, F.col(original) == F.col("_o"), "left").drop("_o")
        known = F.col("original_amount").isNotNull()
        split = split.withColumn("original_amount", F.col("original_amount").cast("decimal(28,2)")).withColumn(
            "reversal_status",
            F.when(F.col("reversal_flag") & ~known, "MISSING")
            .when(F.col("reversal_flag") & (F.col("original_amount") + value == 0), "FULL")
            .when(F.col("reversal_flag"), "PARTIAL"),
        )
    return ordered(split, [account], order).running_sum(value, "balance_after").frame()


def daily_snapshot(
    txn: DataFrame,
    account: str,
    ts_col: str,
    order: Sequence[str],
    amount: str,
    first_day: Column | str,
    last_day: Column | str,
) -> DataFrame:
    """One row per account and day with opening, closing and activity measures.

    Transactions become balances, balances become one row per active day; only
    then is the calendar spread out, so the carry-forward window of an account
    holds days and not transactions. The spine runs from an account's first
    active day, or from ``first_day`` if that is later, to ``last_day``; the balance
    before ``first_day`` is carried in, and an account that starts after ``last_day``
    has no rows.
    """
    value = F.col(amount)
    balances = ordered(txn, [account], order).running_sum(value, "_after").frame()
    days = balances.withColumn("day", F.to_date(ts_col)).groupBy(account, "day").agg(
        F.max_by("_after", F.struct(*order)).alias("_closing"),
        F.min("_after").alias("_low"),
        F.max("_after").alias("_high"),
        F.sum("_after").alias("_sum_after"),
        F.count(F.lit(1)).alias("_count"),
        F.sum(F.when(value > 0, 1).otherwise(0)).alias("_n_credit"),
        F.sum(F.when(value < 0, 1).otherwise(0)).alias("_n_debit"),
        F.sum(F.when(value > 0, value)).alias("_credits"),
        F.sum(F.when(value < 0, -value)).alias("_debits"),
    )
    begin = F.lit(first_day).cast("date") if isinstance(first_day, str) else first_day
    end = F.lit(last_day).cast("date") if isinstance(last_day, str) else last_day
    bounded = days.withColumn("_begin", begin).withColumn("_end", end)
    start = F.greatest("_first", "_begin")
    spine = (
        bounded.groupBy(account)
        .agg(F.min("day").alias("_first"), F.min("_begin").alias("_begin"), F.min("_end").alias("_end"))
        .filter(start <= F.col("_end"))
        .select(account, F.explode(F.sequence(start, F.col("_end"))).alias("day"))
    )
    # the balance before the first day stands on the day before it
    earlier = (
        bounded.filter(F.col("day") < F.col("_begin"))
        .groupBy(account)
        .agg(F.max_by("_closing", "day").alias("_closing"), F.date_sub(F.min("_begin"), 1).alias("day"))
    )
    grid = (
        spine.join(days, [account, "day"], "left")
        .withColumn("_shown", F.lit(True))
        .unionByName(earlier.withColumn("_shown", F.lit(False)), allowMissingColumns=True)
    )
    # at most one row per calendar day in a group, so no group needs splitting
    by_day = Ordered(grid, (account,), ("day",), split=False)
    carried = by_day.carry_forward(F.col("_closing"), "_carried").lag(
        F.col("_carried"), "_previous"
    )
    zero = F.lit(0).cast("decimal(18,2)")
    money = "decimal(28,2)"
    opening = F.coalesce("_previous", zero).cast(money)
    closing = F.coalesce("_carried", zero).cast(money)
    credits, debits = F.coalesce("_credits", zero), F.coalesce("_debits", zero)
    return carried.frame().filter("_shown").select(
        account,
        "day",
        opening.alias("balance_opening"),
        closing.alias("balance_closing"),
        F.least(opening, F.coalesce("_low", opening)).cast(money).alias("balance_minimum"),
        F.greatest(opening, F.coalesce("_high", opening)).cast(money).alias("balance_maximum"),
        avg_money(
            (opening + F.coalesce("_sum_after", zero)).cast("decimal(30,2)"),
            F.coalesce("_count", F.lit(0)) + 1,
        ).alias("balance_average"),
        F.coalesce("_count", F.lit(0)).cast("long").alias("transaction_count"),
        F.coalesce("_n_credit", F.lit(0)).cast("long").alias("credit_count"),
        F.coalesce("_n_debit", F.lit(0)).cast("long").alias("debit_count"),
        credits.cast(money).alias("total_credits"),
        debits.cast(money).alias("total_debits"),
        (credits - debits).cast(money).alias("net_change"),
        F.greatest(-closing, zero).cast(money).alias("overdraft_used"),
        (closing < 0).alias("is_overdrawn"),
    )


def opening_closing(
    ledger: DataFrame, part: Sequence[str], period: str, amount: str
) -> DataFrame:
    """Opening and closing balance per group and active period.

    Amounts are summed per period first; the window then holds periods.
    """
    sums = ledger.groupBy(*part, period).agg(F.sum(amount).alias("net_change"))
    closed = ordered(sums, part, [period]).running_sum(F.col("net_change"), "closing").frame()
    return closed.withColumn("opening", F.col("closing") - F.col("net_change"))


def status_flags(
    accounts: DataFrame,
    activity: DataFrame,
    key: str,
    ts_col: str,
    as_of: str,
    months: int = 12,
) -> DataFrame:
    """Accounts with their last activity and whether it is ``months`` or more ago."""
    last = activity.groupBy(F.col(key).alias("_k")).agg(F.max(ts_col).alias("last_activity"))
    limit = F.add_months(F.to_date(ts(as_of)), -months)
    return (
        accounts.join(last, accounts[key] == last["_k"], "left")
        .drop("_k")
        .withColumn(
            "is_dormant",
            F.col("last_activity").isNull() | (F.to_date("last_activity") <= limit),
        )
    )


def below_minimum(snapshot: DataFrame, balance: str, minimum: Column) -> DataFrame:
    return snapshot.withColumn("is_below_minimum", F.coalesce(F.col(balance) < minimum, F.lit(False)))


def date_dim(
    bounds: DataFrame,
    fiscal_month: int = 4,
    holidays: Mapping[str, str] | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Calendar dimension for each day between ``first_day`` and ``last_day`` of ``bounds``."""
    holidays = holidays or {}
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_value"))
    out = days.select("date_value", *[
        c.alias(n) for n, c in calendar_parts(F.col("date_value"), fiscal_month).items()
    ])
    name = F.lit(None).cast("string")
    for day, label in holidays.items():
        name = F.when(F.date_format("date_value", "MM-dd") == day, label).otherwise(name)
    out = out.withColumn("holiday_name", name)
    out = out.withColumn("is_holiday", F.col("holiday_name").isNotNull())
    out = out.withColumn("is_business_day", ~F.col("is_weekend") & ~F.col("is_holiday"))
    if as_of is not None:
        today = F.lit(as_of).cast("date")
        day = F.col("date_value")
        out = (
            out.withColumn("is_current_day", day == today)
            .withColumn("is_current_month", F.trunc(day, "month") == F.trunc(today, "month"))
            .withColumn("is_current_year", F.year(day) == F.year(today))
        )
    return out


def star_query(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str]],
    by: Sequence[str],
    measures: Sequence[Column],
) -> DataFrame:
    """Grouped measures of a fact joined to its dimensions.

    ``dims``: (dimension, fact key, dimension key). Spark broadcasts the
    dimensions that are small enough.
    """
    joined = fact
    for dim, fact_key, dim_key in dims:
        joined = joined.join(dim, F.col(fact_key) == F.col(dim_key))
    return joined.groupBy(*by).agg(*measures)


def star_unmatched(
    fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]]
) -> DataFrame:
    """Fact rows without a member, per dimension: (dimension, fact key, dimension key).

    Fact rows are counted per key first, so the join sees each key once.
    """
    parts = []
    for name, (dim, fact_key, dim_key) in dims.items():
        per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
        members = dim.select(F.col(dim_key).alias("_d")).distinct()
        joined = per_key.join(members, per_key["_k"] == members["_d"], "left")
        lost = F.sum(F.when(F.col("_d").isNull(), F.col("n")).otherwise(0))
        parts.append(
            joined.agg(
                F.coalesce(lost, F.lit(0)).cast("long").alias("unmatched_rows"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("fact_rows"),
            ).select(F.lit(name).alias("dimension"), "fact_rows", "unmatched_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def check_grain(fact: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Is the declared grain unique?"""
    groups = fact.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("grain_groups"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("long").alias("duplicate_groups"),
    ).withColumn("is_unique", F.col("duplicate_groups") == 0)
