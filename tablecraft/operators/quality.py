"""Data-quality rules as one findings table.

Every rule gives: rule, table_name, column_name, severity, failed_rows,
total_rows. Rules that look at one row at a time share one scan per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import open_end
from tablecraft.operators.windows import ordered

FINDING_COLUMNS = ["rule", "table_name", "column_name", "severity", "failed_rows", "total_rows"]

# Domain patterns and value lists.
PATTERNS = {
    "currency_code": r"^[A-Z]{3}$",
    "country_code": r"^[A-Z]{2}$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{1,30}$",
    "bic": r"^[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}([A-Z0-9]{3})?$",
    "email_address": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
}
RANGES = {"interest_rate": (-0.1, 1.0), "percentage": (0, 100)}


@dataclass(frozen=True)
class RowRule:
    """A rule decided by one row: ``bad`` is true where it fails."""

    rule: str
    column: str
    bad: Column
    severity: str = "error"


def not_null(col: str, severity: str = "error") -> RowRule:
    return RowRule("not_null", col, F.col(col).isNull(), severity)


def accepted_values(col: str, values: Sequence, severity: str = "error") -> RowRule:
    """NULL is left to the not_null rule."""
    return RowRule("accepted_values", col, ~F.col(col).isin(*values), severity)


def pattern(col: str, regex: str, severity: str = "error") -> RowRule:
    return RowRule("pattern", col, ~F.col(col).rlike(regex), severity)


def max_length(col: str, length: int, severity: str = "warning") -> RowRule:
    return RowRule("length", col, F.length(col) > length, severity)


def decimal_fit(col: str, precision: int, scale: int, severity: str = "warning") -> RowRule:
    """The value survives a cast to DECIMAL(precision, scale) unchanged."""
    fitted = F.col(col).try_cast(f"decimal({precision},{scale})")
    bad = F.col(col).isNotNull() & (
        fitted.isNull() | (fitted.cast("double") != F.col(col).cast("double"))
    )
    return RowRule("decimal_fit", col, bad, severity)


def value_range(col: str, low=None, high=None, severity: str = "error") -> RowRule:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(col) < low)
    if high is not None:
        bad = bad | (F.col(col) > high)
    return RowRule("range", col, bad, severity)


def derived(col: str, expected: Column, tolerance=0, severity: str = "error") -> RowRule:
    """The stored value equals its derivation within the tolerance."""
    return RowRule("derived", col, F.abs(F.col(col) - expected) > tolerance, severity)


def run_row_rules(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of a table in one aggregate over one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[
            F.coalesce(F.sum(F.when(r.bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"_f{i}")
            for i, r in enumerate(rules)
        ],
    )
    findings = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.rule).alias("rule"),
                    F.lit(table).alias("table_name"),
                    F.lit(r.column).alias("column_name"),
                    F.lit(r.severity).alias("severity"),
                    F.col(f"_f{i}").alias("failed_rows"),
                )
                for i, r in enumerate(rules)
            ]
        )
    )
    return counted.select("total_rows", findings.alias("f")).select("f.*", "total_rows")


def _finding(counted: DataFrame, rule: str, table: str, column: str, severity: str) -> DataFrame:
    return counted.select(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        F.coalesce("failed_rows", F.lit(0)).cast("long").alias("failed_rows"),
        F.coalesce("total_rows", F.lit(0)).cast("long").alias("total_rows"),
    )


def check_unique(
    df: DataFrame, table: str, cols: Sequence[str], severity: str = "error", rule: str = "unique"
) -> DataFrame:
    """Rows that share their key with another row."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    counted = groups.agg(
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("failed_rows"),
        F.sum("n").alias("total_rows"),
    )
    return _finding(counted, rule, table, ",".join(cols), severity)


def check_fk(
    child: DataFrame,
    table: str,
    child_cols: Sequence[str],
    parent: DataFrame,
    parent_cols: Sequence[str],
    severity: str = "error",
) -> DataFrame:
    """Child rows with a full key that no parent has.

    Child rows are counted per key first, so the join sees each key once.
    """
    per_key = child.groupBy(*child_cols).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(
        *[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_cols)]
    ).distinct()
    known = known.withColumn("_found", F.lit(True))
    cond, full = F.lit(True), F.lit(True)
    for i, c in enumerate(child_cols):
        cond = cond & (per_key[c] == known[f"_p{i}"])
        full = full & per_key[c].isNotNull()
    lost = full & F.col("_found").isNull()
    counted = per_key.join(known, cond, "left").agg(
        F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("failed_rows"),
        F.sum("n").alias("total_rows"),
    )
    return _finding(counted, "relationships", table, ",".join(child_cols), severity)


def check_total(
    parent: DataFrame,
    table: str,
    key: str,
    col: str,
    details: DataFrame,
    detail_key: str,
    amount: Column,
    tolerance=0,
    severity: str = "warning",
) -> DataFrame:
    """A stored total equals the sum of its details; no details count as 0."""
    sums = details.groupBy(F.col(detail_key).alias("_k")).agg(F.sum(amount).alias("_sum"))
    joined = parent.join(sums, parent[key] == sums["_k"], "left")
    bad = F.abs(F.col(col) - F.coalesce("_sum", F.lit(0))) > tolerance
    counted = joined.agg(
        F.sum(F.when(bad, 1).otherwise(0)).alias("failed_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    return _finding(counted, "derived_total", table, col, severity)


def measure_cardinality(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]
) -> DataFrame:
    """Cardinality of a relationship from the largest key group on either side."""
    names = [f"_k{i}" for i in range(len(left_keys))]

    def side(df: DataFrame, keys: Sequence[str], mine: str, other: str) -> DataFrame:
        return (
            df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
            .agg(F.count(F.lit(1)).alias(mine))
            .withColumn(other, F.lit(0).cast("long"))
        )

    merged = (
        side(left, left_keys, "l", "r")
        .unionByName(side(right, right_keys, "r", "l"))
        .groupBy(*names)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    top = merged.agg(F.max("l").alias("max_left"), F.max("r").alias("max_right"))
    one_l, one_r = F.col("max_left") <= 1, F.col("max_right") <= 1
    return top.withColumn(
        "cardinality",
        F.when(one_l & one_r, "one_to_one")
        .when(one_l, "one_to_many")
        .when(one_r, "many_to_one")
        .otherwise("many_to_many"),
    )


def check_scd2(history: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """SCD2 invariants: one current row per key, no overlap, from before to."""
    timed = history.withColumn("_to", open_end(F.col("valid_to")))
    single = timed.groupBy(*keys).agg(
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("c"),
        F.count(F.lit(1)).alias("n"),
    )
    current = single.agg(
        F.sum(F.when(F.col("c") != 1, 1).otherwise(0)).alias("failed_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    following = ordered(timed, keys, ["valid_from", "_to"]).lead(F.col("valid_from"), "_next")
    per_row = following.frame().agg(
        F.sum(F.when(F.col("_next") < F.col("_to"), 1).otherwise(0)).alias("overlap"),
        F.sum(F.when(F.col("valid_from") >= F.col("_to"), 1).otherwise(0)).alias("order"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    key = ",".join(keys)
    return reduce(
        DataFrame.unionByName,
        [
            _finding(current, "scd2_one_current", table, key, "error"),
            _finding(
                per_row.withColumnRenamed("overlap", "failed_rows"),
                "scd2_no_overlap", table, key, "error",
            ),
            _finding(
                per_row.withColumnRenamed("order", "failed_rows"),
                "scd2_from_before_to", table, "valid_from", "error",
            ),
        ],
    )


def run_suite(tables: Mapping[str, DataFrame], spec: Mapping[str, Mapping]) -> DataFrame:
    """All declared rules of all tables as one findings table.

    Per table: ``columns`` {column: constraints}, ``primary_key`` [columns],
    ``foreign_keys`` [(child columns, parent table, parent columns)]. Column
    constraints: not_null, values, pattern, length, decimal, range.
    """
    parts = []
    for name, declared in spec.items():
        df = tables[name]
        key = list(declared.get("primary_key", ()))
        rules = [not_null(c) for c in key]
        for col, limits in declared.get("columns", {}).items():
            if limits.get("not_null") and col not in key:
                rules.append(not_null(col))
            if "values" in limits:
                rules.append(accepted_values(col, limits["values"]))
            if "pattern" in limits:
                rules.append(pattern(col, limits["pattern"]))
            if "length" in limits:
                rules.append(max_length(col, limits["length"]))
            if "decimal" in limits:
                rules.append(decimal_fit(col, *limits["decimal"]))
            if "range" in limits:
                rules.append(value_range(col, *limits["range"]))
        if rules:
            parts.append(run_row_rules(df, name, rules).select(*FINDING_COLUMNS))
        if key:
            parts.append(check_unique(df, name, key))
        for child_cols, parent, parent_cols in declared.get("foreign_keys", ()):
            parts.append(check_fk(df, name, child_cols, tables[parent], parent_cols))
    return reduce(DataFrame.unionByName, parts)


def severity_summary(findings: DataFrame) -> DataFrame:
    """Failed rules and rows per severity."""
    return findings.groupBy("severity").agg(
        F.count(F.lit(1)).alias("rules"),
        F.sum(F.when(F.col("failed_rows") > 0, 1).otherwise(0)).cast("long").alias("failed_rules"),
        F.sum("failed_rows").alias("failed_rows"),
    )
