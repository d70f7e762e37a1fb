"""Session helpers: UTC session, shared work folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}

# Rows one task may hold for one window group before the group is split.
GROUP_ROWS_KEY = "tablecraft.maxGroupRows"
GROUP_ROWS_DEFAULT = 2_000_000


def local_session(cores: int | str = 8, partitions: int | None = None, **conf) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablecraft")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting; a cluster must name one,
    since a folder of one machine is lost with that machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tablecraft-")
    return _local_dirs[app]


def work_dir(spark: SparkSession) -> str:
    """The folder of this application within the shared folder."""
    return f"{shared_dir(spark)}/tablecraft/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of this application."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Store ``df`` in the shared folder, so a lost executor costs no recomputation.

    The copy is Parquet: what reads it reads only its columns, filters reach the
    files, and the planner knows the written size.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_work(spark: SparkSession) -> None:
    """Delete what this application stored; frames that read it can not be used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def group_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_KEY, str(GROUP_ROWS_DEFAULT)))
