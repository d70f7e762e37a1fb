"""Versioned table folders: a merge writes the files it touches, and publishes once.

``data/<id>/`` holds Parquet files that are never changed. ``log/version=N/`` is the manifest
of version N, itself Parquet: one row per file with its range of keys, its rows and bytes,
the version that added it, and its tier. Tier 0 is the base, whose files have disjoint
ranges; higher tiers are runs of later changes, of which the newest row of a key counts.

A merge rewrites only base files whose range holds a changed key (``rewrite``), or adds a
run in proportion to the changes (``append``), which ``compact`` later folds into the base
files it touches. A version is published by renaming its finished manifest. The rename
fails if the version exists, so of two writers one gets ``VersionConflict``; a writer that
is lost before it leaves files that no manifest names, which ``vacuum`` deletes. The file
system must rename folders atomically, as HDFS and shared POSIX folders do.

Keys are unique and never NULL. Only file names reach the driver, as they do for any table
that Spark reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablecraft.operators.windows import dedup_latest, ordered
from tablecraft.session import cut_lineage

BASE = 0
ADDED = "_added"
RELATIVE = r".*/(data/[^/]+/.+)$"


class VersionConflict(RuntimeError):
    """Another writer published the version first; read the newest one and merge again."""


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def latest(spark: SparkSession, path: str) -> int:
    """Number of the newest version, -1 if there is none."""
    pattern, fs = _fs(spark, f"{path}/log/version=*")
    found = fs.globStatus(pattern) or []
    return max((int(s.getPath().getName().partition("=")[2]) for s in found), default=-1)


def manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(file, lo, hi, rows, bytes, tier, added, ddl); the row without a file carries the columns."""
    return spark.read.parquet(f"{path}/log/version={version}")


def publish(files: DataFrame, path: str, version: int) -> None:
    """Make ``files`` the manifest of ``version``, all at once or not at all."""
    spark = files.sparkSession
    ready = f"{path}/staged/{uuid.uuid4().hex}"
    files.coalesce(1).write.parquet(ready)  # one small row per file
    source, fs = _fs(spark, ready)
    target, _ = _fs(spark, f"{path}/log/version={version}")
    fs.mkdirs(target.getParent())
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.toUri(), spark._jsc.hadoopConfiguration()
    )
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    if fs.exists(target):
        raise VersionConflict(f"version {version} of {path} exists")
    try:
        context.rename(source, target, plain)
    except Exception as error:
        if fs.exists(target):
            raise VersionConflict(f"version {version} of {path} exists") from error
        raise


def _name() -> Column:
    return F.regexp_extract("_metadata.file_path", RELATIVE, 1).alias("file")


def write_files(
    df: DataFrame, path: str, keys: Sequence[str], within: str | None = None, newest: str | None = None
) -> str:
    """Write ``df`` ranged over ``keys`` into a new folder, whose name is returned.

    The rows of a file are in the order of ``keys``. ``within`` names a column whose values
    never share a file; it is not stored. Of several rows of a key the one with the largest
    value of ``newest`` is kept, without this column.
    """
    folder = f"data/{uuid.uuid4().hex}"
    order = [*([within] if within else []), *keys]
    ranged = df.repartitionByRange(*order)
    if newest:  # the rows of a key are in one range
        ranged = dedup_latest(ranged, keys, [F.desc(newest)]).drop("rn", newest)
    writer = ranged.sortWithinPartitions(*order).write
    (writer.partitionBy(within) if within else writer).parquet(f"{path}/{folder}")
    return folder


def file_rows(
    spark: SparkSession, path: str, folder: str, schema: StructType, keys: Sequence[str], tier: int, version: int
) -> DataFrame:
    """The manifest rows of a folder of ``write_files``: ranges of keys, rows and bytes of its files.

    The rows of a file are in order, so its range is its first and its last row, and no
    column is read to count them.
    """
    read = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/{folder}")
    at = F.col("_metadata.row_index")
    sizes = cut_lineage(
        read.groupBy(F.col("_metadata.file_path").alias("p")).agg(
            F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes")
        ),
        "file-sizes",
    )
    key = F.struct(*[F.col(k) for k in keys]).alias("k")
    ends = read.select(_name(), F.col("_metadata.file_path").alias("p"), at.alias("i"), key).join(
        sizes.select("p", "rows", "bytes", F.explode(F.array_distinct(F.array(F.lit(0).cast("long"), F.col("rows") - 1))).alias("i")),
        ["p", "i"],
    )
    return ends.groupBy("file").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi"), F.max("rows").alias("rows"), F.max("bytes").alias("bytes")
    ).select(
        "*", F.lit(tier).alias("tier"), F.lit(version).cast("long").alias("added"),
        F.lit(None).cast("string").alias("ddl"),
    )


def add_files(
    df: DataFrame, path: str, keys: Sequence[str], tier: int, version: int, within: str | None = None
) -> DataFrame:
    """Write ``df`` and return its manifest rows."""
    folder = write_files(df, path, keys, within)
    stored = StructType([f for f in df.schema.fields if f.name != within])
    return file_rows(df.sparkSession, path, folder, stored, keys, tier, version)


def create(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Version 0: ``df`` ranged over its unique ``keys``."""
    files = add_files(df, path, keys, BASE, 0)
    publish(with_schema(files, df.schema), path, 0)
    return 0


def with_schema(files: DataFrame, schema: StructType) -> DataFrame:
    """Manifest rows and the one that carries the columns, which tables without files need."""
    head = files.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in files.schema.fields if f.name != "ddl"],
        F.lit(schema.json()).alias("ddl"),
    )
    return files.unionByName(head)


def schema_of(files: DataFrame) -> StructType:
    return StructType.fromJson(json.loads(files.where("file IS NULL").first()["ddl"]))


def read_files(spark: SparkSession, path: str, schema: StructType, files: DataFrame, *extra: Column) -> DataFrame:
    """Rows of ``files``, with what ``extra`` says about the file of each row."""
    names = [f"{path}/{r['file']}" for r in files.where("file IS NOT NULL").select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema).select("*", *[F.lit(None).alias("file") for _ in extra])
    return spark.read.schema(schema).parquet(*names).select(*schema.names, *extra)


def _latest_changes(spark: SparkSession, path: str, schema: StructType, files: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The newest row of every key in the runs, None without runs."""
    runs = files.where(F.col("tier") > BASE)
    versions = [r["added"] for r in runs.select("added").distinct().orderBy("added").collect()]
    if not versions:
        return None
    parts = [
        read_files(spark, path, schema, runs.where(F.col("added") == v)).withColumn(ADDED, F.lit(v)) for v in versions
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return dedup_latest(rows, list(keys), [F.desc(ADDED)]).select(*schema.names)


def read(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """The rows of a version, the newest unless named."""
    files = manifest(spark, path, latest(spark, path) if version is None else version)
    schema = schema_of(files)
    base = read_files(spark, path, schema, files.where(F.col("tier") == BASE))
    changes = _latest_changes(spark, path, schema, files, keys)
    if changes is None:
        return base
    return base.join(changes.select(*keys), list(keys), "left_anti").select(*schema.names).unionByName(changes)


def file_of_keys(rows: DataFrame, files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the ``file`` whose range holds their key, or would hold it.

    Files and rows are put in one line by key and the last file start is carried forward;
    a key before all files belongs to the first one.
    """
    start = F.struct(*[F.col(k) for k in keys])
    row = F.struct(*[F.col(c) for c in rows.columns])
    line = files.select(
        F.col("lo").alias("_k"), F.lit(0).alias("_side"), F.col("file").alias("_file"),
        F.lit(None).cast(row_type(rows)).alias("_row"),
    ).unionByName(
        rows.select(start.alias("_k"), F.lit(1).alias("_side"), F.lit(None).cast("string").alias("_file"), row.alias("_row"))
    )
    carried = ordered(line, [], ["_k", "_side"]).carry_forward(F.col("_file"), "_at").frame()
    first = files.agg(F.min_by("file", "lo").alias("_first"))
    return (
        carried.where("_side = 1")
        .join(F.broadcast(first), F.lit(True), "left")  # one row
        .select("_row.*", F.coalesce("_at", "_first", F.lit("")).alias("file"))
    )


def row_type(rows: DataFrame) -> StructType:
    return StructType(rows.schema.fields)


def _rewritten(
    spark: SparkSession, path: str, files: DataFrame, schema: StructType, changes: DataFrame,
    keys: Sequence[str], mode: str, version: int,
) -> DataFrame:
    """The manifest after ``changes`` are merged into the base files that they touch."""
    base = files.where((F.col("tier") == BASE) & F.col("file").isNotNull())
    placed = cut_lineage(file_of_keys(changes.select(*schema.names), base, keys), "placed")
    touched = cut_lineage(placed.select("file").distinct(), "touched")
    held = base.join(touched, "file", "left_semi")
    old = read_files(spark, path, schema, held, _name())
    if mode == "replace":
        old = old.join(placed.select(*keys), list(keys), "left_anti").select(*placed.columns)
        rows = old.unionByName(placed)
    else:
        rows = old.unionByName(placed.join(old.select(*keys), list(keys), "left_anti").select(*placed.columns))
    # rows of one old file share no file with those of another, so ranges stay disjoint
    slots = rows.withColumn("_slot", F.md5("file")).drop("file")
    fresh = add_files(slots, path, keys, BASE, version, within="_slot")
    kept = files.join(touched.withColumn("_hit", F.lit(True)), "file", "left").where("_hit IS NULL").drop("_hit")
    return kept.unionByName(fresh)


def merge(
    changes: DataFrame, path: str, keys: Sequence[str], mode: str = "replace", how: str = "rewrite",
    onto: int | None = None,
) -> int:
    """Merge rows with unique ``keys`` into the newest version, or into version ``onto``.

    ``replace`` overwrites the row of a key, ``ignore`` keeps it; other keys are inserted.
    Returns the version published.
    """
    if mode not in ("replace", "ignore") or how not in ("rewrite", "append"):
        raise ValueError(f"unknown merge {mode!r}, {how!r}")
    if mode == "ignore" and how == "append":
        raise ValueError("a run of changes always replaces")
    spark = changes.sparkSession
    keys = list(keys)
    at = latest(spark, path) if onto is None else onto
    files = manifest(spark, path, at)
    schema = schema_of(files)
    if how == "append":
        run = add_files(changes.select(*schema.names), path, keys, 1, at + 1)
        publish(files.unionByName(run), path, at + 1)
        return at + 1
    runs = _latest_changes(spark, path, schema, files, keys)
    if runs is not None:  # earlier runs first, so that no old row outlives a rewrite
        fresh = changes.select(*schema.names)
        if mode == "replace":
            changes = runs.join(fresh.select(*keys), keys, "left_anti").select(*schema.names).unionByName(fresh)
        else:
            raise ValueError("compact the runs before a merge that ignores known keys")
    after = _rewritten(spark, path, files.where("tier IS NULL OR tier = 0"), schema, changes, keys, mode, at + 1)
    publish(after, path, at + 1)
    return at + 1


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Fold all runs into the base files they touch; returns the newest version."""
    at = latest(spark, path)
    files = manifest(spark, path, at)
    schema = schema_of(files)
    runs = _latest_changes(spark, path, schema, files, keys)
    if runs is None:
        return at
    base = files.where("tier IS NULL OR tier = 0")
    publish(_rewritten(spark, path, base, schema, runs, list(keys), "replace", at + 1), path, at + 1)
    return at + 1


def written_bytes(spark: SparkSession, path: str, version: int) -> tuple[int, int]:
    """(bytes that the version added, bytes of all its files)."""
    row = manifest(spark, path, version).agg(
        F.sum(F.when(F.col("added") == version, F.col("bytes"))).alias("new"), F.sum("bytes").alias("all")
    ).first()
    return int(row["new"] or 0), int(row["all"] or 0)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions before the newest ``keep`` and folders that no kept manifest names.

    Returns the number of folders deleted. No writer may be at work meanwhile.
    """
    last = latest(spark, path)
    kept = [v for v in range(max(0, last - keep + 1), last + 1)]
    folder = F.regexp_extract("file", r"^data/([^/]+)/", 1)
    named = reduce(DataFrame.unionByName, [manifest(spark, path, v).select(folder.alias("f")) for v in kept])
    used = {r["f"] for r in named.distinct().collect()}
    removed = 0
    for pattern, spared in (("data/*", used), ("log/version=*", {f"version={v}" for v in kept}), ("staged/*", set())):
        glob, fs = _fs(spark, f"{path}/{pattern}")
        for status in fs.globStatus(glob) or []:
            if status.getPath().getName() not in spared:
                fs.delete(status.getPath(), True)
                removed += 1
    return removed
