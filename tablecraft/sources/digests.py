"""Stored frames with a tree of checksums, so that equal ones are compared unread.

Rows lie in ranges of their key's hash. A leaf of the tree is the number of rows of a
range and two sums of row hashes, which do not depend on the order of rows and count
copies; a node is the sum of its sixteen children. A compare goes down from the root
through differing nodes only, and reads the rows of differing leaves only. A digest
decides what is read, the rows decide the result; equal digests of different rows need
a collision of 120 bits.

Defined cases: NULL keys share a range; an empty frame has a tree of no nodes; frames
stored with other columns, types, keys or depth are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.functions.scalars import hash_of
from tablecraft.operators import compare as cmp

FAN_BITS = 4  # children of a node: 16
DEPTH = 2  # levels below the root: 256 ranges
PART = "_part"
NODE = "level int, node int, n long, lane_a decimal(38,0), lane_b decimal(38,0), layout string"


def _row_hash(df: DataFrame) -> Column:
    """Hash of the row by column name; binary values and times in full."""
    exact = {"binary": F.hex, "timestamp": F.unix_micros}
    return hash_of([exact.get(kind, lambda c: c)(F.col(f"`{c}`")) for c, kind in sorted(df.dtypes)])


def _lane(row_hash: str, first: int) -> Column:
    return F.sum(F.conv(F.substring(row_hash, first, 15), 16, 10).cast("decimal(28,0)"))


def store_digested(df: DataFrame, folder: str, keys: Sequence[str], depth: int = DEPTH) -> None:
    """Write ``df`` by ranges of the hash of ``keys``, and its tree.

    Ranges that hold many rows, as of a hot key, are split over tasks when written.
    """
    layout = f"{sorted(df.dtypes)} {sorted(keys)} {depth}"
    hashed = F.xxhash64(*[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in sorted(keys)])
    part = F.shiftrightunsigned(hashed, 64 - FAN_BITS * depth).cast("int")
    df.withColumn(PART, part).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{folder}/rows")
    rows = df.sparkSession.read.schema(f"{_ddl(df)}, {PART} int").parquet(f"{folder}/rows")
    leaves = rows.select(PART, _row_hash(df).alias("_hash")).groupBy(PART).agg(
        F.count(F.lit(1)).alias("n"), _lane("_hash", 1).alias("lane_a"), _lane("_hash", 16).alias("lane_b")
    )
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    up = F.expr(f"shiftright({PART}, {FAN_BITS} * ({depth} - level))")
    nodes = leaves.select("*", levels).groupBy("level", up.alias("node")).agg(
        F.sum("n").alias("n"),
        *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("lane_a", "lane_b")],
    )
    nodes.withColumn("layout", F.lit(layout)).write.partitionBy("level").parquet(f"{folder}/tree")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _nodes(spark: SparkSession, folder: str, level: int, parents: list[int] | None) -> DataFrame:
    nodes = spark.read.schema(NODE).parquet(f"{folder}/tree").where(F.col("level") == level)
    if parents is None:
        return nodes
    return nodes.where(F.shiftright("node", FAN_BITS).isin(parents))


def differing_parts(spark: SparkSession, a: str, b: str, depth: int = DEPTH) -> list[int]:
    """Ranges whose rows differ between the two folders; at most 16 to the ``depth``."""
    found: list[int] | None = None
    for level in range(depth + 1):
        both = _nodes(spark, a, level, found).withColumn("_side", F.lit(1)).unionByName(
            _nodes(spark, b, level, found).withColumn("_side", F.lit(-1))
        )
        differ = both.groupBy("node").agg(
            *[F.sum(F.col(c) * F.col("_side")).alias(c) for c in ("n", "lane_a", "lane_b")],
            F.count_distinct("layout").alias("layouts"),
        )
        rows = differ.where("n <> 0 or lane_a <> 0 or lane_b <> 0 or layouts > 1").collect()
        if any(r["layouts"] > 1 for r in rows):
            raise ValueError("the frames were stored with other columns, types, keys or depth")
        found = sorted(r["node"] for r in rows)
        if not found:
            break
    return found


def read_parts(spark: SparkSession, folder: str, ddl: str, parts: list[int]) -> DataFrame:
    """Rows of the given ranges; other ranges are not opened."""
    rows = spark.read.schema(f"{ddl}, {PART} int").parquet(f"{folder}/rows")
    kept = rows.where(F.col(PART).isin(parts)) if parts else rows.where(F.lit(False))
    return kept.drop(PART)


def compare_stored(spark: SparkSession, a: str, b: str, ddl: str, depth: int = DEPTH) -> DataFrame:
    """The row that ``compare`` returns, from digests and the rows of differing ranges."""
    parts = differing_parts(spark, a, b, depth)
    found = cmp.compare(read_parts(spark, a, ddl, parts), read_parts(spark, b, ddl, parts))

    def total(folder: str, name: str) -> DataFrame:
        return _nodes(spark, folder, 0, None).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))

    # one row each, put side by side by a constant key
    sizes = total(a, "_a").withColumn("_one", F.lit(1)).join(total(b, "_b").withColumn("_one", F.lit(1)), "_one")
    return found.withColumn("_one", F.lit(1)).join(sizes, "_one").select(
        *[{"rows_source": F.col("_a").alias(c), "rows_target": F.col("_b").alias(c)}.get(c, F.col(c))
          for c in found.columns]
    )
