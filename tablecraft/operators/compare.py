"""Regression compare of frames and of staged flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.functions.scalars import differs
from tablecraft.operators.setops import diff_rows, tag_counts
from tablecraft.session import cut_lineage

RESULT_SCHEMA = (
    "cte_name string, status string, rows_source long, rows_target long, "
    "except_source_vs_target long, except_target_vs_source long, "
    "total_differences long, note string"
)


def compare(a: DataFrame, b: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """One row: row counts, distinct rows missing on either side, PASS or FAIL.

    Both sides go through one tagged aggregation instead of two counts and two
    EXCEPTs; copies are combined before the shuffle.
    """
    a, b = a.drop(*skip), b.drop(*skip)
    if set(a.columns) != set(b.columns):
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    other = dict(b.dtypes)
    types = {c: (kind, other[c]) for c, kind in a.dtypes if kind != other[c]}
    if types:
        raise ValueError(f"types differ: {types}")
    only_a = F.sum(F.when(F.col("n_b") == 0, 1).otherwise(0))
    only_b = F.sum(F.when(F.col("n_a") == 0, 1).otherwise(0))
    counts = tag_counts(a, b).agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).cast("long").alias("rows_source"),
        F.coalesce(F.sum("n_b"), F.lit(0)).cast("long").alias("rows_target"),
        F.coalesce(only_a, F.lit(0)).cast("long").alias("except_source_vs_target"),
        F.coalesce(only_b, F.lit(0)).cast("long").alias("except_target_vs_source"),
    )
    total = F.col("except_source_vs_target") + F.col("except_target_vs_source")
    return counts.withColumn("total_differences", total).select(
        F.when(total == 0, "PASS").otherwise("FAIL").alias("status"), *counts.columns,
        "total_differences",
    )


def diff_sample(a: DataFrame, b: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` differing rows, ordered by every column."""
    rows = diff_rows(a, b)
    return rows.orderBy(*rows.columns).limit(n)


def aligned(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of both sides that share the key; value columns as a_x and b_x."""
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in values])
    right = b.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(c).alias(f"b_{c}") for c in values]
    )
    cond = F.lit(True)
    for k in keys:
        pair = left[k].eqNullSafe(right[f"_r_{k}"]) if null_safe else left[k] == right[f"_r_{k}"]
        cond = cond & pair
    return left.join(right, cond).drop(*[f"_r_{k}" for k in keys])


def _unique(df: DataFrame, keys: Sequence[str]) -> bool:
    return df.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty()


def _no_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def column_diffs(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns that differ on aligned rows, with the number of differing pairs.

    Unique keys: one join, one aggregate, all columns at once. Repeated keys:
    the pairs are counted, not built: per key and column, all pairs minus the
    pairs with equal values, which needs only counts per value.
    """
    keys = list(keys)
    values = [c for c in a.columns if c not in keys]
    if not values:
        return a.select(
            F.lit("").alias("column_name"), F.lit(0).cast("long").alias("difference_count")
        ).limit(0)
    if _unique(a, keys) and _unique(b, keys):
        pairs = aligned(a, b, keys)
        counted = pairs.agg(
            *[
                F.sum(F.when(differs(F.col(f"a_{c}"), F.col(f"b_{c}")), 1).otherwise(0)).alias(c)
                for c in values
            ]
        )
        cells = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"`{c}`").cast("long").alias("difference_count"),
                    )
                    for c in values
                ]
            )
        )
        result = counted.select(cells.alias("x")).select("x.*")
    else:
        result = _repeated_key_diffs(a, b, keys, values)
    return result.filter(F.col("difference_count") > 0).orderBy(
        F.desc("difference_count"), "column_name"
    )


# Columns per grouping-set pass: the grouping id has one bit per column.
COLUMNS_PER_PASS = 24


def _repeated_key_diffs(
    a: DataFrame, b: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """Differing pairs per column from the counts of each value under each key."""
    wide = "decimal(19,0)"
    parts = []
    for start in range(0, len(values), COLUMNS_PER_PASS):
        some = values[start : start + COLUMNS_PER_PASS]
        cols = [*keys, *some]
        both = (
            _no_null_key(a, keys)
            .select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
            .unionByName(
                _no_null_key(b, keys).select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
            )
        )
        sets = [[F.col(k) for k in [*keys, c]] for c in some]
        per_value = both.groupingSets(sets, *[F.col(c) for c in cols]).agg(
            F.sum("_a").alias("_a"), F.sum("_b").alias("_b"),
            F.grouping_id().alias("_set"),
        )
        per_key = per_value.groupBy(*keys, "_set").agg(
            (
                F.sum("_a").cast(wide) * F.sum("_b").cast(wide)
                - F.sum(F.col("_a").cast(wide) * F.col("_b").cast(wide))
            ).alias("d")
        )
        name = F.lit(None).cast("string")
        for i, c in enumerate(some):
            # every value column but this one is rolled up
            bits = (1 << len(some)) - 1 - (1 << (len(some) - 1 - i))
            name = F.when(F.col("_set") == bits, c).otherwise(name)
        parts.append(
            per_key.groupBy(name.alias("column_name")).agg(
                F.sum("d").cast("long").alias("difference_count")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def key_coverage(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys on both sides and on one side only."""
    found = tag_counts(
        _no_null_key(a.select(*keys), keys).distinct(), _no_null_key(b.select(*keys), keys).distinct()
    )
    both = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    return found.agg(
        F.sum(F.when(both, 1).otherwise(0)).cast("long").alias("aligned_keys"),
        F.sum(F.when(F.col("n_b") == 0, 1).otherwise(0)).cast("long").alias("source_only_keys"),
        F.sum(F.when(F.col("n_a") == 0, 1).otherwise(0)).cast("long").alias("target_only_keys"),
    )


def value_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], col: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent (source value, target value) pairs of a differing column.

    Works on the distinct values of each key: a key with v source and w target values
    gives v * w pairs, however many rows it has.
    """
    pairs = _pair_counts(a, b, keys, col)
    return pairs.orderBy(
        F.desc("occurrence_count"), F.asc_nulls_last("source_value"), F.asc_nulls_last("target_value")
    ).limit(n)


def _pair_counts(a: DataFrame, b: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Pair frequencies from counts per key and value, so copies are never paired."""
    keys = list(keys)

    def counted(df: DataFrame, value: str, n: str) -> DataFrame:
        return (
            _no_null_key(df, keys)
            .groupBy(*keys, F.col(col).alias(value))
            .agg(F.count(F.lit(1)).cast("decimal(38,0)").alias(n))
        )

    # stored, so that the partition of a key with most of the values can be split
    left = cut_lineage(counted(a, "source_value", "n_a"), "values")
    right = cut_lineage(counted(b, "target_value", "n_b"), "values")
    joined = left.join(right, keys)
    return (
        joined.filter(differs(F.col("source_value"), F.col("target_value")))
        .groupBy("source_value", "target_value")
        .agg(F.sum(F.col("n_a") * F.col("n_b")).cast("long").alias("occurrence_count"))
    )


def investigate(
    a: DataFrame, b: DataFrame, keys: Sequence[str], col: str, n: int = 20
) -> dict[str, DataFrame]:
    """Differences of one column: their number, the ``n`` most frequent value pairs and
    the first ``n`` differing rows.

    The number comes from counts per key and value. For the rows, the smallest n + 1
    values of a key on each side are enough: at most one source value has no other
    value to differ from.
    """
    keys = list(keys)
    total = F.coalesce(F.sum("difference_count"), F.lit(0)).cast("long")

    def smallest(df: DataFrame, value: str, copies: str) -> DataFrame:
        counted = _no_null_key(df, keys).groupBy(*keys, F.col(col).alias(value)).agg(
            F.count(F.lit(1)).alias(copies)
        )
        first = Window.partitionBy(*keys).orderBy(value)
        return counted.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= n + 1).drop("_at")

    source, target = f"source_{col}", f"target_{col}"
    times = F.least(F.lit(n).cast("decimal(38,0)"), F.col("_a").cast("decimal(19,0)") * F.col("_b"))
    samples = (
        smallest(a, source, "_a")
        .join(smallest(b, target, "_b"), keys)
        .filter(differs(F.col(source), F.col(target)))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long"))))
        .orderBy(*keys, source, target)
        .select(*keys, source, target)
        .limit(n)
    )
    return {
        "count": _repeated_key_diffs(a, b, keys, [col]).agg(total.alias("diff_count")),
        "pairs": value_pairs(a, b, keys, col, n),
        "samples": samples,
    }


def stage_inventory(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stage names as common, only_a or only_b; inputs have ``stage``."""
    left = a.select("stage", F.lit(True).alias("in_a"))
    right = b.select("stage", F.lit(True).alias("in_b"))
    place = (
        F.when(F.col("in_a") & F.col("in_b"), "common")
        .when(F.col("in_a"), "only_a")
        .otherwise("only_b")
    )
    return left.join(right, "stage", "full").select("stage", place.alias("presence"))


def compare_stages(
    flow_a: Mapping[str, DataFrame],
    flow_b: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] | None = None,
    only_common: bool = True,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Compare stage by stage, in the order of ``flow_a``.

    Each stage runs by itself and gives one row, so a stage that fails, when it is
    planned or when it runs, is an ERROR row and the rest goes on. A stage without a
    counterpart is SKIPPED. Stages with a key and differences also get a column
    summary, one row per differing column; one that fails is left out.
    """
    spark = next(iter(flow_a.values())).sparkSession
    keys = {name.lower(): cols for name, cols in (keys or {}).items()}
    rows, summaries = [], {}
    for name, frame in flow_a.items():
        if name not in flow_b:
            if not only_common:
                rows.append((name, "SKIPPED", *[None] * 5, "Not present in target query"))
            continue
        try:
            found = compare(frame, flow_b[name]).first()
        except (PySparkException, Py4JJavaError, ValueError) as error:
            rows.append((name, "ERROR", *[None] * 5, str(error).splitlines()[0]))
            continue
        rows.append((name, *found, None))
        if found["status"] == "FAIL" and name.lower() in keys:
            try:
                differing = column_diffs(frame, flow_b[name], keys[name.lower()]).take(len(frame.columns))
            except (PySparkException, Py4JJavaError, ValueError):
                continue
            summaries[name] = spark.createDataFrame(
                differing, "column_name string, difference_count long"
            )
    return spark.createDataFrame(rows, RESULT_SCHEMA), summaries


def summarise(results: DataFrame) -> DataFrame:
    """Totals of a stage compare and the overall verdict."""

    def n(status: str):
        return F.sum(F.when(F.col("status") == status, 1).otherwise(0)).cast("long")

    totals = results.agg(
        F.count(F.lit(1)).alias("total"),
        n("PASS").alias("passed"),
        n("FAIL").alias("failed"),
        n("ERROR").alias("errors"),
    )
    clean = (F.col("failed") == 0) & (F.col("errors") == 0)
    return totals.withColumn(
        "verdict",
        F.when(clean, "ALL REGRESSION TESTS PASSED").otherwise("REGRESSION FAILURES DETECTED"),
    )
