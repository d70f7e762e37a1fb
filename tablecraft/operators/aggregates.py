"""Grouped aggregates, roll-ups, additive rules and deterministic top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import any_of, avg_cents, cents, days_between, units
from tablecraft.operators.windows import join_nullsafe

# Name parts that tell how a measure may be summed and which
# function fits it, tested in this order.
NON_ADDITIVE_PARTS = ["ratio", "rate", "pct", "percent", "avg"]
SEMI_ADDITIVE_PARTS = ["balance", "inventory", "headcount"]
AGGREGATION_PARTS = [
    ("COUNT", ["count", "cnt"]),
    ("AVG", ["avg", "average"]),
    ("MAX", ["max"]),
    ("MIN", ["min"]),
]
DEFAULT_AGGREGATION = "SUM"


def order_summary(customers: DataFrame, orders: DataFrame, status: str) -> DataFrame:
    """Order metrics per customer.

    Orders are summed per customer key before the join, so the join moves one
    row per customer and a customer with many orders stays cheap.
    """
    price = cents(F.col("o_totalprice"))
    metrics = (
        orders.filter(F.col("o_orderstatus") == status)
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum(price).alias("_total"),
            F.min("o_orderdate").alias("first_order_date"),
            F.max("o_orderdate").alias("last_order_date"),
        )
    )
    joined = customers.join(metrics, customers["c_custkey"] == metrics["o_custkey"])
    return joined.select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "order_count",
        units(F.col("_total")).alias("total_revenue"),
        avg_cents(F.col("_total"), F.col("order_count")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        days_between(F.col("first_order_date"), F.col("last_order_date")).alias(
            "customer_lifetime_days"
        ),
    )


def duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Groups of ``cols`` with more than one row."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def tie_count(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number of (partition, order) groups with ties."""
    return duplicates(df, [*partition, *order]).agg(F.count(F.lit(1)).alias("tie_count"))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One pass, one count per condition."""
    return df.agg(
        *[
            F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long").alias(name)
            for name, cond in conditions.items()
        ]
    )


def rollup_hierarchy(df: DataFrame, levels: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Totals at every level of a hierarchy, with ``level_id`` = grouping id."""
    return df.rollup(*levels).agg(F.grouping_id().cast("long").alias("level_id"), *aggs)


def measure_type(name: Column) -> Column:
    lower = F.lower(name)
    return (
        F.when(any_of([lower.contains(p) for p in NON_ADDITIVE_PARTS]), "non_additive")
        .when(any_of([lower.contains(p) for p in SEMI_ADDITIVE_PARTS]), "semi_additive")
        .otherwise("additive")
    )


def measure_aggregation(name: Column, parity: bool = False) -> Column:
    """Function from the name. Whole words count; ``parity`` accepts any substring."""
    lower = F.lower(name)
    result = F.lit(DEFAULT_AGGREGATION)
    for label, parts in reversed(AGGREGATION_PARTS):
        if parity:
            hit = any_of([lower.contains(p) for p in parts])
        else:
            hit = lower.rlike(rf"(?:^|_)(?:{'|'.join(parts)})(?:_|$)")
        result = F.when(hit, label).otherwise(result)
    return result


def rollup_measures(
    fact: DataFrame,
    dims: Sequence[str],
    additive: Sequence[str] = (),
    semi_additive: Mapping[str, tuple[Sequence[str], Sequence[str]]] | None = None,
    ratios: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Roll-up that respects additivity.

    Additive measures are summed. A semi-additive measure names (entity columns,
    order columns): its last value per entity and group is summed over entities.
    A ratio names (numerator, denominator) and is recomputed from their sums.
    """
    semi_additive, ratios = semi_additive or {}, ratios or {}
    summed = list(dict.fromkeys([*additive, *[c for pair in ratios.values() for c in pair]]))
    out = fact.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(c).alias(f"_s_{c}") for c in summed]
    )
    cols = [*dims, "row_count", *[F.col(f"_s_{c}").alias(c) for c in additive]]
    for name, (top, bottom) in ratios.items():
        cols.append(
            F.when(
                F.col(f"_s_{bottom}") != 0,
                F.col(f"_s_{top}").cast("double") / F.col(f"_s_{bottom}").cast("double"),
            ).alias(name)
        )
    out = out.select(*cols)
    for name, (entity, order) in semi_additive.items():
        last = fact.groupBy(*dims, *entity).agg(F.max_by(name, F.struct(*order)).alias(name))
        # a NULL dimension is a group like any other
        out = join_nullsafe(out, last.groupBy(*dims).agg(F.sum(name).alias(name)), list(dims))
    return out


def top_k(df: DataFrame, order: Sequence[Column], tie: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in a unique order; each task keeps ``n`` rows at most."""
    return df.orderBy(*order, *tie).limit(n)


def order_by_list(
    df: DataFrame, col: str, values: Sequence[str], then: Sequence[str]
) -> DataFrame:
    """Sort by a listed rank; other values come last."""
    rank = F.lit(len(values))
    for i, value in reversed(list(enumerate(values))):
        rank = F.when(F.col(col) == value, i).otherwise(rank)
    return df.withColumn("sort_rank", rank.cast("long")).orderBy("sort_rank", *then)

