"""Credit-reporting measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import days_between
from tablecraft.operators.windows import join_nullsafe

# Default states.
NOT_IN_DEFAULT = "NOT_IN_DEFAULT"
DEFAULT_UNLIKELY_TO_PAY = "DEFAULT_UNLIKELY_TO_PAY"
DEFAULT_MORE_THAN_90_DAYS = "DEFAULT_MORE_THAN_90_DAYS"
DEFAULT_BOTH = "DEFAULT_BOTH"
PAST_DUE_DAYS = 90


def _ratio(top: Column, bottom: Column) -> Column:
    """Ratio with four digits, NULL without a base."""
    exact = top.cast("decimal(20,4)") / bottom.cast("decimal(18,2)")
    return F.when(bottom != 0, F.round(exact, 4).cast("decimal(18,4)"))


def _outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join in which NULL keys meet."""
    other = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys],
        F.lit(True).alias("_right"),
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(other[f"_r_{k}"])
    key = {k: F.when(F.col("_right"), F.col(f"_r_{k}")).otherwise(left[k]).alias(k) for k in keys}
    return left.join(other, cond, "full").select(
        *[key.get(c, left[c]) for c in left.columns], *[c for c in right.columns if c not in keys]
    )


def ltv(
    loans: DataFrame, collateral: DataFrame, key: str, loan: str, value: str
) -> DataFrame:
    """Loans secured by a collateral relative to its value.

    Collateral without loans and loans without collateral stay, with a NULL ratio;
    a NULL key is a collateral like any other. ``collateral`` holds a key once.
    """
    secured = loans.groupBy(key).agg(F.sum(loan).alias("secured_loans"))
    joined = _outer(collateral, secured, [key])
    return joined.withColumn("loan_to_value", _ratio(F.col("secured_loans"), F.col(value)))


def household_income(members: DataFrame, household: str, income: str) -> DataFrame:
    """Combined income of the members of a household."""
    return members.groupBy(household).agg(
        F.sum(income).alias("household_income"), F.count(F.lit(1)).alias("members")
    )


def dti(loans: DataFrame, incomes: DataFrame, household: str, loan: str) -> DataFrame:
    """Loans of a household relative to its income; NULL where either is missing."""
    owed = loans.groupBy(household).agg(F.sum(loan).alias("loan_amount"))
    return _outer(owed, incomes, [household]).withColumn(
        "debt_to_income", _ratio(F.col("loan_amount"), F.col("household_income"))
    )


def default_status(due: Column, unlikely: Column, as_of: Column) -> Column:
    """One of four default states from days past due and unlikeliness to pay."""
    late = F.coalesce(days_between(due, as_of) > PAST_DUE_DAYS, F.lit(False))
    doubt = F.coalesce(unlikely, F.lit(False))
    return (
        F.when(late & doubt, DEFAULT_BOTH)
        .when(late, DEFAULT_MORE_THAN_90_DAYS)
        .when(doubt, DEFAULT_UNLIKELY_TO_PAY)
        .otherwise(NOT_IN_DEFAULT)
    )


def snapshot_for(df: DataFrame, date_col: str, date: Column) -> DataFrame:
    """Rows of one reporting date."""
    return df.filter(F.col(date_col) == date)


def repeated_reports(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Composite keys reported more than once, with their rows; none in a valid report.

    A key with a NULL part is not complete and is returned too.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter((F.col("rows") > 1) | ~whole)
        .withColumn("is_complete", whole)
    )


UNKNOWN_CLASS = "UNKNOWN"


def exposure_by(
    fin: DataFrame, acc: DataFrame | None, keys: Sequence[str], by: Sequence[str],
    amounts: Sequence[str],
) -> DataFrame:
    """Summed amounts by class.

    ``fin`` has the classes and may have several rows of a key in several classes;
    ``acc`` has amounts per key. The amounts of ``acc`` go to the smallest class of
    their key, once; those of keys that ``fin`` does not have go to UNKNOWN_CLASS.
    Both sides are summed per key before they meet, and NULL keys meet.
    """
    mine = [c for c in amounts if c in fin.columns]
    total = fin.groupBy(*by).agg(*[F.sum(c).alias(c) for c in mine])
    if acc is None:
        return total
    others = [c for c in amounts if c not in fin.columns]
    classes = fin.groupBy(*keys).agg(F.min(F.struct(*by)).alias("_class"))
    per_key = acc.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in others])
    named = join_nullsafe(per_key, classes.withColumn("_known", F.lit(True)), list(keys))
    placed = named.select(
        *[F.when(F.col("_known"), F.col(f"_class.{c}")).otherwise(UNKNOWN_CLASS).alias(c) for c in by], *others
    )
    both = total.unionByName(
        placed.groupBy(*by).agg(*[F.sum(c).alias(c) for c in others]), allowMissingColumns=True
    )
    return both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in amounts])
