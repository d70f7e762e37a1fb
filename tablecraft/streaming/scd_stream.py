"""Incremental SCD2 over a stream, one micro-batch at a time, as tiers of sorted runs.

The state is a versioned folder (``sources.versions``) of change points: one row per key and
time with the state that holds from then on, whether it starts a version of the history
(it differs from the state before it), and if so until when. Batch N publishes version N:
one run with the points that are new and the few old ones that they alter, since a late
row ends the version it falls into and may join the one after it. Only keys of the batch are
looked up, and of those only the version that holds the batch's first time and what is
later. A run is in proportion to its batch; when ``fan`` runs of a tier have gathered they
are merged into one of the next tier, so a point is written once per tier and the
number of runs grows with the logarithm of the number of batches.

The newest row of a key and time counts. A repeated batch finds its version published and
changes nothing; a batch that fails before it publishes has written files that nothing
names. The version before the last stays readable.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tablecraft.functions.scalars import sentinel
from tablecraft.operators.windows import Ordered, dedup_latest, group_sizes, join_nullsafe, ordered
from tablecraft.session import cut_lineage, group_limit
from tablecraft.sources import versions
from tablecraft.sources.versions import ADDED

FAN = 4
STARTS, UNTIL, LOW, OLD = "_starts", "_until", "_low", "_old"


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the newest batch in the folder, -1 if there is none."""
    return versions.latest(spark, path)


def _columns(schema: StructType, role: str) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("role") == role]


def _with_roles(schema: StructType, roles: dict[str, Sequence[str]]) -> StructType:
    role_of = {c: role for role, columns in roles.items() for c in columns}
    return StructType([StructField(f.name, f.dataType, True, {"role": role_of.get(f.name, "")}) for f in schema.fields])


Runs = dict[tuple[int, int], str]  # the folder of each run by (tier, batch)


def _state(spark: SparkSession, path: str, version: int) -> tuple[Runs, StructType]:
    """The runs of a version and their columns; one row per file reaches the driver."""
    rows = versions.manifest(spark, path, version).select("tier", "added", "file", "ddl").collect()
    runs = {(r["tier"], r["added"]): r["file"].rpartition("/")[0] for r in rows if r["file"]}
    return runs, StructType.fromJson(json.loads(next(r["ddl"] for r in rows if r["ddl"])))


def _read(spark: SparkSession, path: str, schema: StructType, runs: Runs) -> DataFrame:
    """The rows of some runs with the batch that wrote them."""
    parts = [
        spark.read.schema(schema).parquet(f"{path}/{folder}").withColumn(ADDED, F.lit(added).cast("long"))
        for (_, added), folder in sorted(runs.items())
    ]
    if not parts:
        return spark.createDataFrame([], schema).withColumn(ADDED, F.lit(0).cast("long"))
    return reduce(DataFrame.unionByName, parts)


def _newest(rows: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    return dedup_latest(rows, [*keys, ts_col], [F.desc(ADDED)]).drop("rn")


def _collapsed(points: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts_col: str, tie: Sequence[str]) -> DataFrame:
    """One row per key and time: the last in the order of ``tie``, without it the largest state."""
    state = F.struct(*[F.col(c).alias(c) for c in [*tracked, *tie]])
    last = F.max_by(state, F.struct(*[F.col(c) for c in tie])) if tie else F.max(state)
    old = [F.max(OLD).alias(OLD)] if OLD in points.columns else []
    return points.groupBy(*keys, ts_col).agg(last.alias("_s"), *old).select(*keys, ts_col, "_s.*", *([OLD] if old else []))


def _touched(runs: DataFrame, points: DataFrame, keys: Sequence[str], ts_col: str) -> tuple[DataFrame, DataFrame]:
    """Of the keys of ``points`` the rows from the version that holds their first time on.

    With them come the stored places among which they are, one row per key and time.
    """
    low = points.groupBy(*keys).agg(F.min(ts_col).alias(LOW))
    near = (F.col(ts_col) >= F.col(LOW)) | (F.col(STARTS) & (F.col(UNTIL) >= F.col(LOW)))
    # a row may have been replaced by one that is not near, so the newest one of each place is read
    places = cut_lineage(
        join_nullsafe(runs.select(*keys, ts_col, STARTS, UNTIL), low, keys, "inner").where(near)
        .select(*keys, ts_col, LOW).distinct(),
        "places",
    )
    found = join_nullsafe(runs, places, [*keys, ts_col], "inner")
    return _newest(found, keys, ts_col).where(near).drop(LOW, ADDED), places


def _with_ends(rows: Ordered, keys: Sequence[str], ts_col: str, state: Column) -> DataFrame:
    """The points, whether they start a version, and if so until when."""
    before = rows.lag(F.struct(state.alias("s")), "_before")
    marked = before.df.withColumn(STARTS, F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(state)).drop("_before")
    if not rows.split:  # the next start is the last one met from the end of the group, in the same task
        later = Window.partitionBy(*keys).orderBy(F.desc(ts_col)).rowsBetween(Window.unboundedPreceding, -1)
        following = F.last(F.when(F.col(STARTS), F.col(ts_col)), ignorenulls=True).over(later)
        return marked.withColumn(UNTIL, F.when(F.col(STARTS), F.coalesce(following, sentinel())))
    begun = rows.with_df(marked.where(STARTS)).lead(F.col(ts_col), UNTIL).df.withColumn(UNTIL, F.coalesce(UNTIL, sentinel()))
    others = marked.where(~F.col(STARTS)).withColumn(UNTIL, F.lit(None).cast(begun.schema[UNTIL].dataType))
    return begun.unionByName(others)


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    fan: int = FAN,
) -> None:
    """Merge one batch of changes into the folder; a batch that is in it already changes nothing."""
    spark = batch.sparkSession
    keys, tracked, tie = list(keys), list(tracked), [t for t in tie if t not in tracked]
    last = versions.latest(spark, path)
    if last >= batch_id:
        return
    points = cut_lineage(_collapsed(batch.select(*keys, ts_col, *tracked, *tie), keys, tracked, ts_col, tie), "points")
    values = [*tracked, *tie]
    runs: Runs = {}
    sizes = None
    if last >= 0:
        runs, schema = _state(spark, path, last)
        old, places = _touched(_read(spark, path, schema, runs), points, keys, ts_col)
        known = old.withColumn(OLD, F.struct(*[F.col(c) for c in [*values, STARTS, UNTIL]])).drop(STARTS, UNTIL)
        # the points are among the new ones and the places, so these bound their groups
        sizes = group_sizes(points.select(*keys).unionByName(places.select(*keys)), keys)
        points = points.unionByName(known, allowMissingColumns=True)
        if sizes[1] <= group_limit(spark):
            points = points.repartition(*keys)  # as the windows below need them, so that they move once
        points = _collapsed(points, keys, tracked, ts_col, tie)
    state = F.struct(*[F.col(c) for c in tracked])
    every = _with_ends(ordered(points, keys, [ts_col], sizes), keys, ts_col, state)
    now = F.struct(*[F.col(c) for c in [*values, STARTS, UNTIL]])
    stored = [*keys, ts_col, *values, STARTS, UNTIL]
    if last >= 0:
        every = every.where(F.col(OLD).isNull() | ~F.col(OLD).eqNullSafe(now))
    every = cut_lineage(every.select(*stored), "ends")  # read to sample its ranges and to write them
    if last < 0:
        schema = _with_roles(every.schema, {"key": keys, "tracked": tracked, "at": [ts_col], "tie": tie})
    after = _merged(spark, path, schema, runs | {(1, batch_id): versions.write_files(every, path, [*keys, ts_col])}, fan)
    kept = versions.manifest(spark, path, last) if last >= 0 else None
    gone = [folder for run, folder in runs.items() if after.get(run) != folder]
    fresh = [
        versions.file_rows(spark, path, folder, schema, [*keys, ts_col], tier, added)
        for (tier, added), folder in after.items()
        if runs.get((tier, added)) != folder
    ]
    if kept is not None:
        files = reduce(DataFrame.unionByName, fresh, kept.where(_not_in(gone)))
    else:
        files = versions.with_schema(reduce(DataFrame.unionByName, fresh), schema)
    versions.publish(files, path, batch_id)
    if gone:
        versions.vacuum(spark, path)


def _not_in(folders: Sequence[str]) -> Column:
    """Manifest rows outside ``folders``; the row that carries the columns stays."""
    return F.coalesce(~F.regexp_extract("file", "^(data/[^/]+)/", 1).isin(*folders), F.lit(True)) if folders else F.lit(True)


def _merged(spark: SparkSession, path: str, schema: StructType, runs: Runs, fan: int) -> Runs:
    """``runs`` after every tier of ``fan`` or more became one run of the next tier."""
    keys, ts_col = _columns(schema, "key"), _columns(schema, "at")[0]
    tier = 1
    while any(t >= tier for t, _ in runs):
        full = {run: folder for run, folder in runs.items() if run[0] == tier}
        if len(full) >= fan:
            one = versions.write_files(_read(spark, path, schema, full), path, [*keys, ts_col], newest=ADDED)
            runs = {run: folder for run, folder in runs.items() if run not in full}
            runs[tier + 1, max(added for _, added in full)] = one
        tier += 1
    return runs


def scd2_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    fan: int = FAN,
) -> int:
    """Run the stream over what is available; returns the newest batch number."""
    merged = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, path, keys, tracked, ts_col, tie, fan)
        merged.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return max(merged) if merged else last_batch(stream.sparkSession, path)


def read_history(spark: SparkSession, path: str, last: int) -> DataFrame:
    """All versions of all keys after batch ``last``."""
    runs, schema = _state(spark, path, last)
    keys, tracked, (ts_col,) = (_columns(schema, role) for role in ("key", "tracked", "at"))
    rows = _read(spark, path, schema, runs)
    if len(runs) > 1:
        rows = _newest(rows, keys, ts_col)
    return rows.where(STARTS).select(
        *keys, *tracked, F.col(ts_col).alias("valid_from"), F.col(UNTIL).alias("valid_to"),
        (F.col(UNTIL) == sentinel()).alias("is_current"),
    )
