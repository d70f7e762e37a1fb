"""Audits of orders and tie-breakers on data."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import regex_match
from tablecraft.sources.tables import SKETCH_ERROR, SKETCH_LOG

# Tie-breaker name patterns, best first, matched from the start
# of the name without regard to case.
TIE_BREAKER_PATTERNS = [
    r".*_source_row_id$",
    r".*_row_id$",
    r"^row_id$",
    r".*_load_timestamp$",
    r".*_load_ts$",
    r"^load_ts$",
    r"^created_at$",
    r".*_file_row_number$",
    r"^surrogate_key$",
    r"^sk$",
    r".*_sk$",
    r"^id$",
    r".*_id$",
]


def audit_order(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Is (partition, order) unique? Groups, tie groups and rows affected."""
    groups = df.groupBy(*partition, *order).agg(F.count(F.lit(1)).alias("n"))
    tied = F.col("n") > 1
    return groups.agg(
        F.count(F.lit(1)).alias("order_groups"),
        F.sum(F.when(tied, 1).otherwise(0)).cast("long").alias("tie_groups"),
        F.sum(F.when(tied, F.col("n")).otherwise(0)).cast("long").alias("rows_affected"),
        F.max("n").alias("largest_group"),
    ).withColumn("is_deterministic", F.col("tie_groups") == 0)


def suggest_tie_breakers(catalog: DataFrame) -> DataFrame:
    """Catalog columns fit to break ties, with the number of the best pattern."""
    name = F.lower("column_name")
    priority = F.lit(None).cast("long")
    for i, p in reversed(list(enumerate(TIE_BREAKER_PATTERNS, start=1))):
        priority = F.when(regex_match(name, p), i).otherwise(priority)
    return catalog.withColumn("priority", priority.cast("long")).filter(
        F.col("priority").isNotNull()
    )


def rank_tie_breakers(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], candidates: Sequence[str]
) -> DataFrame:
    """Which candidate makes (partition, order, candidate) unique?

    One pass turns each row into one row per candidate; copies are combined
    before the shuffle.
    """
    fixed = F.struct(*partition, *order)
    probe = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("candidate"),
                    F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("")).alias("value"),
                )
                for c in candidates
            ]
        )
    )
    groups = (
        df.select(fixed.alias("k"), probe.alias("p"))
        .groupBy("p.candidate", "k", "p.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return groups.groupBy("candidate").agg(
        F.count(F.lit(1)).alias("distinct_rows"), F.sum("n").alias("total_rows")
    ).withColumn("is_unique", F.col("distinct_rows") == F.col("total_rows"))


def unique_sets(
    df: DataFrame, candidates: Sequence[str], fixed: Sequence[str] = (), most: int | None = None
) -> list[tuple[str, ...]]:
    """Minimal sets of ``candidates`` that make rows unique, together with ``fixed``.

    The lattice of sets is searched by size. A set that holds a unique one is not looked at,
    nor any set if all candidates together are not unique, nor one whose columns have too
    few values to tell the rows apart. The sets of a size are sketched in one pass; those
    with about as many values as rows are counted exactly, copies combined before the
    shuffle. NULL is a value. One row per size and per set so counted reaches the driver.
    """
    candidates, fixed = list(candidates), list(fixed)
    sized = _sketched(df, [(), *[(c,) for c in candidates], tuple(candidates)], fixed)
    rows, about = sized[None], {k: v for k, v in sized.items() if k is not None}
    slack = 1 + 4 * SKETCH_ERROR
    if rows <= 1:
        return [()]
    whole = tuple(candidates)
    possible = [s for s in ((), whole) if about[s] * slack >= rows]
    proved = _proved(df, possible, fixed)
    if () in proved:
        return [()]
    if whole not in proved:
        return []
    found: list[tuple[str, ...]] = []
    for size in range(1, min(most or len(candidates), len(candidates)) + 1):
        sets = [
            s
            for s in combinations(candidates, size)
            if not any(set(u) <= set(s) for u in found)
            and prod(about[c,] for c in s) * slack**size >= rows
        ]
        if not sets:
            continue
        known = {s: about[s] for s in sets if s in about}
        known |= _sketched(df, [s for s in sets if s not in known], fixed)
        found += _proved(df, [s for s in sets if s == whole or known[s] * slack >= rows], fixed, {whole})
    return found


def _sketched(df: DataFrame, sets: Sequence[tuple[str, ...]], fixed: Sequence[str]) -> dict:
    """Rows (under None) and the estimated number of values of each set, in one pass."""
    if not sets:
        return {}

    def hashed(columns: Sequence[str]) -> Column:
        # a hash passes over NULLs, so which columns are NULL is hashed with them
        return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())]) if columns else F.lit(0)

    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.hll_sketch_estimate(F.hll_sketch_agg(hashed([*fixed, *s]), SKETCH_LOG)).alias(f"s{i}")
            for i, s in enumerate(sets)
        ],
    ).first()
    return {None: row["rows"]} | {s: row[f"s{i}"] for i, s in enumerate(sets)}


def _proved(df: DataFrame, sets: Sequence[tuple[str, ...]], fixed: Sequence[str], known: Collection = ()) -> list:
    """The sets under which, with ``fixed``, no two rows are equal; exact, all in one job."""
    open_ = [(i, s) for i, s in enumerate(sets) if s not in known]
    parts = [
        (df.groupBy(*fixed, *s) if fixed or s else df.groupBy(F.lit(1))).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n").alias("n")).select(F.lit(i).alias("i"), "n")
        for i, s in open_
    ]
    largest = {r["i"]: r["n"] for r in reduce(DataFrame.unionByName, parts).take(len(parts))} if parts else {}
    return [s for i, s in enumerate(sets) if s in known or largest[i] == 1]


def composite_tie_breakers(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], candidates: Sequence[str], most: int | None = None
) -> DataFrame:
    """Smallest sets of ``candidates`` that make (partition, order, set) unique, as rows."""
    fixed = list(dict.fromkeys([*partition, *order]))
    left = [c for c in candidates if c not in fixed]
    found = unique_sets(df, left, fixed, most)
    data = [(list(s), len(s), i) for i, s in enumerate(sorted(found, key=len), start=1)]
    return df.sparkSession.createDataFrame(data, "columns array<string>, size int, preference int")


def findings_summary(findings: DataFrame) -> DataFrame:
    """Totals by type and by source, and overall, in one pass."""
    g = F.grouping_id()
    return (
        findings.groupingSets(
            [[F.col("finding_type")], [F.col("source")], []], F.col("finding_type"), F.col("source")
        )
        .agg(g.alias("_g"), F.sum("n").cast("long").alias("findings"))
        .select(
            F.when(F.col("_g") == 1, "type")
            .when(F.col("_g") == 2, "source")
            .otherwise("total")
            .alias("dimension"),
            reduce(
                lambda a, b: F.coalesce(a, b), [F.col("finding_type"), F.col("source"), F.lit("all")]
            ).alias("value"),
            "findings",
        )
    )
