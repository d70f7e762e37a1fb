"""Column profiles from sketches that are kept per file and merged.

A file is read once, all columns in one pass: rows, NULLs, a HyperLogLog sketch of the
values, a quantile sketch of numbers and times, and the values met most. The rows of a
profile folder belong to a file by its path, size and time, so a table that gains a file is
brought up to date by reading this file, and files that are gone drop out. Merging the
sketches of a table's files costs as much as there are files, not rows.

Estimates of distinct values are within ``DISTINCT_ERROR`` and ranks of quantiles within
``RANK_ERROR`` of the truth (three standard errors of sketches of this size). Whether a
column is a key is never estimated: columns that the sketch leaves as candidates, without
NULLs and with about as many values as rows, are counted exactly, the others can not be.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.sources.tables import distinct_counts, value_key

LOG_SIZE = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_SIZE / 2)
QUANTILE_SIZE = 200
RANK_ERROR = 0.0265
TRACKED = 64  # values that the sketch of frequent ones follows
FILE = ["file", "size", "changed"]


def _path(column: str) -> Column:
    """Paths as one text, however many slashes follow the scheme."""
    plain = F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([a-z0-9]+):/+", "$1:/")


def list_files(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, file, size, changed) of every Parquet file; no content is read."""
    parts = [
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.lit(name).alias("table_name"),
            F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("file"),
            F.col("length").alias("size"), F.col("modificationTime").alias("changed"),
        )
        for name, path in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _ranked(field: T.StructField) -> Column | None:
    """The value as a number where it has an order that quantiles can show."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.NumericType):
        return col.cast("double")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return None


def profile_files(spark: SparkSession, table: str, files: list[str]) -> DataFrame:
    """One row per file and column of ``files``, from one pass over them."""
    df = spark.read.parquet(*files)
    aggregates, cells = [F.count(F.lit(1)).alias("rows")], []
    for i, field in enumerate(df.schema.fields):
        key, ranked = value_key(field), _ranked(field)
        aggregates += [
            F.count(F.col(f"`{field.name}`")).alias(f"n{i}"),
            F.hll_sketch_agg(F.when(key.isNotNull(), F.xxhash64(key)), LOG_SIZE).alias(f"hll{i}"),
            F.call_function("approx_top_k_accumulate", key.cast("string"), F.lit(TRACKED)).alias(f"top{i}"),
        ]
        if ranked is not None:
            # NaN has no rank
            aggregates.append(F.kll_sketch_agg_double(F.when(~F.isnan(ranked), ranked), QUANTILE_SIZE).alias(f"kll{i}"))
        cells.append(
            F.struct(
                F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(i + 1).alias("ordinal"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                F.col(f"hll{i}").alias("hll"),
                (F.col(f"kll{i}") if ranked is not None else F.lit(None).cast("binary")).alias("kll"),
                F.col(f"top{i}").alias("top"),
            )
        )
    per_file = df.select(
        "*", _path("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_modification_time").alias("_changed"),
    )
    found = per_file.groupBy("_file", "_size", "_changed").agg(*aggregates)
    return found.select(
        F.lit(table).alias("table_name"), F.col("_file").alias("file"), F.col("_size").alias("size"),
        F.col("_changed").alias("changed"), "rows", F.explode(F.array(*cells)).alias("cell"),
    ).select("table_name", *FILE, "rows", "cell.*")


def _stored(spark: SparkSession, store: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(store)


def update(spark: SparkSession, tables: Mapping[str, str], store: str) -> int:
    """Profile the files that ``store`` does not know yet; returns their number.

    The names of new files reach the driver, which has to name them to read them.
    """
    listed = list_files(spark, tables)
    known = _stored(spark, store)
    if known is not None:
        listed = listed.join(known.select(*FILE).distinct(), FILE, "left_anti")
    fresh: dict[str, list[str]] = {}
    for row in listed.select("table_name", "file").collect():
        fresh.setdefault(row["table_name"], []).append(row["file"])
    if fresh:
        parts = [profile_files(spark, table, sorted(files)) for table, files in fresh.items()]
        reduce(DataFrame.unionByName, parts).coalesce(len(parts)).write.mode("append").parquet(store)
    return sum(map(len, fresh.values()))


QUANTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def summary(spark: SparkSession, tables: Mapping[str, str], store: str, top: int = 3) -> DataFrame:
    """Per column: rows, NULLs, estimated distinct values, quantiles and frequent values."""
    known = spark.read.parquet(store).join(list_files(spark, tables).select(*FILE), FILE, "left_semi")
    merged = known.groupBy("table_name", "column_name", "data_type", "ordinal").agg(
        F.sum("rows").alias("row_count"), F.sum("nulls").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("distinct_estimate"),
        F.kll_merge_agg_double("kll").alias("kll"),
        F.call_function("approx_top_k_combine", F.col("top"), F.lit(TRACKED)).alias("top"),
    )
    ranks = F.array(*[F.lit(q) for q in QUANTILES])
    filled = F.col("kll").isNotNull() & (F.kll_sketch_get_n_double("kll") > 0)
    return merged.select(
        "table_name", "column_name", "data_type", "ordinal", "row_count", "null_count", "distinct_estimate",
        F.when(filled, F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("top"), F.lit(top)).alias("frequent"),
    )


def possible_keys(profiled: DataFrame) -> DataFrame:
    """Columns that may be keys: no NULL, and within the error as many values as rows."""
    return profiled.where(
        (F.col("row_count") > 0) & (F.col("null_count") == 0)
        & (F.col("distinct_estimate") * (1 + DISTINCT_ERROR) >= F.col("row_count"))
    )


def with_keys(spark: SparkSession, tables: Mapping[str, str], profiled: DataFrame) -> DataFrame:
    """``profiled`` with ``is_unique``, exact: candidates are counted, a column each in a pass.

    One row per candidate column reaches the driver.
    """
    candidates: dict[str, list[str]] = {}
    for row in possible_keys(profiled).select("table_name", "column_name").collect():
        candidates.setdefault(row["table_name"], []).append(row["column_name"])
    parts = []
    for table, columns in candidates.items():
        df = spark.read.option("recursiveFileLookup", "true").parquet(tables[table])
        counted = distinct_counts(df, [f for f in df.schema.fields if f.name in columns])
        parts.append(counted.select(F.lit(table).alias("table_name"), "column_name", "distinct_count"))
    if not parts:
        return profiled.withColumn("is_unique", F.lit(False))
    exact = reduce(DataFrame.unionByName, parts)
    return profiled.join(exact, ["table_name", "column_name"], "left").withColumn(
        "is_unique", F.coalesce(F.col("distinct_count") == F.col("row_count"), F.lit(False))
    )
