"""Set operations over whole rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


COPIES_PER_CHUNK = 10_000


class UnionShapeError(ValueError):
    """Frames whose columns cannot be put under one another."""


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b``."""
    return a.subtract(b)


def minus_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` beyond the copies ``b`` has.

    Copies are counted per side before the shuffle, so a row repeated over a
    third of the data travels once per task. The copies are written again in
    chunks that are spread over the tasks.
    """
    extra = tag_counts(a, b).withColumn("_n", F.col("n_a") - F.col("n_b")).filter(F.col("_n") > 0)
    one = F.lit(1).cast("long")
    chunk = F.explode(F.sequence(one, F.ceil(F.col("_n") / COPIES_PER_CHUNK)))
    chunks = (
        extra.withColumn("_chunk", chunk)
        .withColumn(
            "_n",
            F.least(
                F.lit(COPIES_PER_CHUNK).cast("long"),
                F.col("_n") - (F.col("_chunk") - 1) * COPIES_PER_CHUNK,
            ),
        )
        .repartition("_chunk", *a.columns)
        .drop("_chunk")
    )
    return chunks.withColumn("_copy", F.explode(F.sequence(one, F.col("_n")))).select(*a.columns)


def tag_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every distinct row with its number of copies on each side, one shuffle."""
    cols = a.columns
    both = a.select("*", F.lit(1).alias("n_a"), F.lit(0).alias("n_b")).union(
        b.select(*cols).select("*", F.lit(0), F.lit(1))
    )
    return both.groupBy(*cols).agg(
        F.sum("n_a").cast("long").alias("n_a"), F.sum("n_b").cast("long").alias("n_b")
    )


def diff_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with SOURCE_ONLY or TARGET_ONLY in front."""
    label = F.when(F.col("n_b") == 0, "SOURCE_ONLY").otherwise("TARGET_ONLY")
    return (
        tag_counts(a, b)
        .filter((F.col("n_a") == 0) | (F.col("n_b") == 0))
        .select(label.alias("_diff_source"), *a.columns)
    )


def safe_union(frames: Sequence[DataFrame], strict: bool = True) -> DataFrame:
    """Union by name. ``strict`` wants the same column set in every frame."""
    for i, df in enumerate(frames):
        if len(set(df.columns)) != len(df.columns):
            raise UnionShapeError(f"frame {i} repeats a column name: {df.columns}")
        if strict and len(df.columns) != len(frames[0].columns):
            raise UnionShapeError(
                f"frame {i} has {len(df.columns)} columns, frame 0 has {len(frames[0].columns)}"
            )
        if strict and set(df.columns) != set(frames[0].columns):
            raise UnionShapeError(f"frame {i} has other columns than frame 0: {df.columns}")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=not strict), frames)
