"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablecraft.session import work_path

ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "binary": pa.binary(),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor costs no recomputation."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_texts(
    docs: DataFrame, columns: list[str], per_text: Callable[[str | None], tuple], schema: str,
    start: Callable[[], Callable] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` and what ``per_text`` returns for each text.

    ``start`` builds ``per_text`` once per task, for functions that hold tables.
    Rows go through one by one as Arrow batches; no row is moved.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [ARROW[part.split()[1]] for part in schema.split(", ")]
    kept = docs.select(*columns, "text")
    out = ", ".join([f"{c} {kept.schema[c].dataType.simpleString()}" for c in columns] + [schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start() if start else per_text
        for batch in batches:
            for piece in pieces(batch):
                found = [apply(t) for t in piece.column("text").to_pylist()]
                arrays = [piece.column(c) for c in columns]
                arrays += [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *names])

    return kept.mapInArrow(run, out)


def pieces(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batch in slices, so that decoded texts of few rows are held at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def rank_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with a gapless ``name`` from 0 in the given order, stored.

    Rows are ranged over the order, numbered inside each range, and shifted by the
    counts of the ranges before; that table has one row per range. ``order`` should
    end in something unique, else equal rows share a range.
    """
    ranged = store(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_range",
        (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return store(
        ranged.withColumn(name, inside.cast("long") - 1)
        .join(F.broadcast(before), "_range")  # one row per range
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_range", "_before"),
        "ranked",
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b).

    Large-star and small-star rounds: every round replaces edges by edges to the
    smallest neighbour, until nothing changes. The number of edges does not grow and
    each round is written to the shared folder. Only nodes with an edge are returned.
    A hub gathers no list: minima are combined before the shuffle. The minima are stored
    and never broadcast, since files of edges are a fraction of what a broadcast holds; so
    Spark splits the partition of a hub when its edges meet them.
    """
    current = store(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        now = state(current)
        if now == before:
            break
        before = now
        larger = store(star(current, larger=True), "larger")
        current = store(star(larger, larger=False), "edges")
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select("b", "b").distinct()
    )


def state(edges: DataFrame) -> tuple:
    """The number of distinct edges and a checksum that does not depend on their order."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on (a, b): neighbours are tied to the smallest of a node's neighbourhood.

    Large star ties the larger neighbours of each node, small star the smaller ones
    and the node itself. Edges come back as (larger, smaller).
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    if not larger:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
        "a", F.least("a", "_m").alias("m")
    )
    least = store(least, "least")
    tied = both.hint("merge").join(least, "a")
    if larger:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", "m")
        )
    return out.where("a <> b").distinct()
