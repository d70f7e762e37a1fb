"""Upserts, layer materialisation and partitioned fact writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.operators.windows import dedup_latest

VIEW_LAYERS = ("source", "staging")


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    mode: str = "replace",
    order: Sequence[str | Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows of ``target`` after ``changes`` by key.

    ``replace``: a change overwrites the row of its key. ``ignore``: a key that
    exists keeps its row. ``order`` ranks several changes of one key; the first
    in that order wins. Without it a key may come once only, which is checked unless
    ``unique`` says so; equal changes count as one.
    """
    if mode not in ("replace", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    keys = list(keys)
    if order:
        changes = dedup_latest(changes, keys, order).drop("rn")
    changes = changes.select(*target.columns)
    if not order and not unique:
        changes = changes.distinct()
        if not changes.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError("several changes of one key need an order")
    if mode == "replace":
        kept = target.join(changes.select(*keys), keys, "left_anti")
        return kept.select(*target.columns).unionByName(changes)
    fresh = changes.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def materialise(
    df: DataFrame, layer: str, name: str, path: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Staging layers become a temp view, later layers a Parquet table."""
    if layer in VIEW_LAYERS:
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_scd2(
    history: DataFrame, path: str, version: int, partition_by: Sequence[str] = ("is_current",)
) -> DataFrame:
    """Incremental layer table: ``history`` as version ``version`` of the table at ``path``.

    A merge reads the version before it, so a version never overwrites what it was
    made from. Readers take the newest; the one before the last is deleted.
    """
    spark = history.sparkSession
    target = f"{path}/version={version}"
    history.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version - 2}")
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(history.schema).parquet(target)


def write_fact(df: DataFrame, path: str, date_col: str, order_col: str) -> DataFrame:
    """Month-partitioned fact table.

    Rows are ranged over (month, date, key), so a month of any size is written
    by several tasks, and each task touches few month folders.
    """
    monthly = df.withColumn("fact_month", F.date_format(date_col, "yyyy-MM"))
    (
        monthly.repartitionByRange("fact_month", date_col, order_col)
        .write.mode("overwrite")
        .partitionBy("fact_month")
        .parquet(path)
    )
    return df.sparkSession.read.schema(monthly.schema).parquet(path)
