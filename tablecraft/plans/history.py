"""Slowly changing dimensions and the incremental stream."""

from __future__ import annotations



from pyspark.sql import functions as F

from tablecraft.operators import scd
from tablecraft.plans import fixtures as fx
from tablecraft.plans.registry import query
from tablecraft.session import work_path
from tablecraft.sources.tables import read_table, stream_table
from tablecraft.streaming.scd_stream import read_history, scd2_stream

KEY = ["c_custkey"]


def customer_history(spark, d):
    """Initial load of snapshot_1 and one load of snapshot_2."""
    first = scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), KEY, fx.DAY_1)
    return scd.scd2_apply(
        first, fx.snapshot(spark, d, fx.DAY_2), KEY, fx.TRACKED, fx.DAY_2, unique_source=True
    )


HISTORY_OUT = f"""c_custkey, c_name, c_mktsegment, last_priority, last_status,
  {fx.stamp_sql('valid_from')} AS valid_from, {fx.stamp_sql('valid_to')} AS valid_to, is_current,
  sha256(CAST(c_custkey AS VARCHAR) || '||' || {fx.stamp_sql('valid_from')}) AS sk"""


@query(
    "scd2_init",
    f"""WITH history AS (SELECT *, TIMESTAMP '{fx.DAY_1}' AS valid_from,
          TIMESTAMP '9999-12-31 23:59:59' AS valid_to, true AS is_current
        FROM ({fx.snapshot_sql(fx.DAY_1)})) SELECT {HISTORY_OUT} FROM history""",
)
def scd2_init(spark, d):
    return fx.with_text_stamps(scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), KEY, fx.DAY_1))


CHANGES = """
  SELECT b.c_custkey, CASE WHEN a.c_custkey IS NULL THEN 'INSERT' WHEN {test} THEN 'UPDATE'
                           ELSE 'NO_CHANGE' END AS change_type
  FROM snapshot_2_nulls b LEFT JOIN snapshot_1 a ON a.c_custkey = b.c_custkey"""


def _changes(spark, d, null_safe):
    dim = scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), KEY, fx.DAY_1)
    src = fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY)
    return scd.scd2_changes(src, scd.current(dim), KEY, fx.TRACKED, null_safe).select(
        "c_custkey", "change_type"
    )


@query(
    "scd2_changes",
    f"WITH {fx.SNAPSHOTS_SQL} "
    + CHANGES.format(
        test="a.last_priority IS DISTINCT FROM b.last_priority "
        "OR a.last_status IS DISTINCT FROM b.last_status"
    ),
)
def scd2_changes(spark, d):
    return _changes(spark, d, True)


@query(
    "scd2_changes_plain",
    f"WITH {fx.SNAPSHOTS_SQL} "
    + CHANGES.format(
        test="a.last_priority != b.last_priority OR a.last_status != b.last_status"
    ),
)
def scd2_changes_plain(spark, d):
    return _changes(spark, d, False)


@query("scd2_apply", f"WITH {fx.HISTORY_SQL} SELECT {HISTORY_OUT} FROM history")
def scd2_apply(spark, d):
    return fx.with_text_stamps(customer_history(spark, d))


@query(
    "scd2_delta",
    f"""WITH {fx.HISTORY_SQL} SELECT {HISTORY_OUT} FROM history
        WHERE NOT is_current OR valid_from = TIMESTAMP '{fx.DAY_2}'""",
)
def scd2_delta(spark, d):
    dim = scd.scd2_init(fx.snapshot(spark, d, fx.DAY_1), KEY, fx.DAY_1)
    src = fx.snapshot(spark, d, fx.DAY_2)
    return fx.with_text_stamps(
        scd.scd2_delta(dim, src, KEY, fx.TRACKED, fx.DAY_2, unique_source=True)
    )


@query("scd2_current", f"WITH {fx.HISTORY_SQL} SELECT {HISTORY_OUT} FROM history WHERE is_current")
def scd2_current(spark, d):
    return fx.with_text_stamps(scd.current(customer_history(spark, d)))


@query(
    "scd2_as_of",
    f"""WITH {fx.HISTORY_SQL} SELECT {HISTORY_OUT} FROM history
        WHERE valid_from <= TIMESTAMP '1998-06-01' AND TIMESTAMP '1998-06-01' < valid_to""",
)
def scd2_as_of(spark, d):
    return fx.with_text_stamps(scd.as_of(customer_history(spark, d), "1998-06-01 00:00:00"))


@query(
    "scd1_apply",
    f"""WITH {fx.SNAPSHOTS_SQL} SELECT * FROM snapshot_2
        UNION ALL SELECT * FROM snapshot_1 WHERE c_custkey NOT IN (SELECT c_custkey FROM snapshot_2)""",
)
def scd1_apply(spark, d):
    return scd.scd1_apply(fx.snapshot(spark, d, fx.DAY_1), fx.snapshot(spark, d, fx.DAY_2), KEY)


STATE_SQL = f"""
  WITH log AS (
    SELECT user_id, event_type, ts, event_id,
           lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
  starts AS (SELECT * FROM log WHERE rn = 1 OR event_type IS DISTINCT FROM before),
  spans AS (
    SELECT user_id, event_type, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM starts)
  SELECT user_id, event_type, {fx.stamp_sql('valid_from')} AS valid_from,
         {fx.stamp_sql("coalesce(nxt, TIMESTAMP '9999-12-31 23:59:59')")} AS valid_to,
         nxt IS NULL AS is_current FROM spans"""


@query("scd2_backfill", STATE_SQL)
def scd2_backfill(spark, d):
    log = read_table(spark, d, "events", ["user_id", "event_type", "ts", "event_id"])
    return fx.with_text_stamps(
        scd.scd2_backfill(log, ["user_id"], ["event_type"], "ts", ["event_id"])
    )


@query("scd2_stream_events", STATE_SQL)
def scd2_stream_events(spark, d):
    stream = stream_table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    path = work_path(spark, "scd-stream")
    last = scd2_stream(
        stream, path, work_path(spark, "scd-checkpoint"),
        ["user_id"], ["event_type"], "ts", ["event_id"],
    )
    return fx.with_text_stamps(read_history(spark, path, last))


@query("scd2_stream_batches", STATE_SQL)
def scd2_stream_batches(spark, d):
    """All events in four batches by time, some of them a batch late."""
    events = read_table(spark, d, "events", ["user_id", "event_type", "ts", "event_id"])
    number = F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("event_id") % 17 == 0, 1).otherwise(0)
    numbered = events.withColumn("batch", F.least(number, F.lit(3)).cast("int"))
    source, path, checkpoint = (work_path(spark, f"scd-{part}") for part in ("source", "batches", "checkpoint"))
    for batch in range(4):
        # all files written since the run before are one micro-batch
        numbered.filter(F.col("batch") == batch).drop("batch").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        last = scd2_stream(stream, path, checkpoint, ["user_id"], ["event_type"], "ts", ["event_id"])
    return fx.with_text_stamps(read_history(spark, path, last))


@query(
    "scd2_missing_current",
    f"""WITH {fx.HISTORY_SQL}, s3 AS ({fx.snapshot_sql(fx.DAY_3)})
        SELECT c_custkey FROM s3 WHERE c_custkey NOT IN
          (SELECT c_custkey FROM history WHERE is_current)""",
)
def scd2_missing_current(spark, d):
    return scd.missing_current(
        fx.snapshot(spark, d, fx.DAY_3), customer_history(spark, d), KEY
    ).select("c_custkey")


