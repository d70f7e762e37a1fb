"""Slowly changing dimensions as DataFrame rewrites with an explicit ``as_of``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import any_of, differs, hash_of, open_end, sentinel, ts
from tablecraft.operators.windows import dedup_latest, ordered

HISTORY_COLUMNS = ["valid_from", "valid_to", "is_current"]


def _stamp(as_of: str | Column) -> Column:
    return ts(as_of) if isinstance(as_of, str) else as_of


def scd2_init(src: DataFrame, keys: Sequence[str], as_of: str | Column, sk: str = "sk") -> DataFrame:
    """Initial load: every row open from ``as_of``."""
    versions = src.withColumn("valid_from", _stamp(as_of))
    return (
        versions.withColumn(sk, hash_of([*keys, "valid_from"]))
        .withColumn("valid_to", sentinel())
        .withColumn("is_current", F.lit(True))
    )


def _changed(tracked: Sequence[str], null_safe: bool) -> Column:
    if null_safe:
        return any_of([differs(F.col(c), F.col(f"_cur_{c}")) for c in tracked])
    return any_of([F.coalesce(F.col(c) != F.col(f"_cur_{c}"), F.lit(False)) for c in tracked])


def scd2_changes(
    src: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    null_safe: bool = True,
) -> DataFrame:
    """Source rows with ``change_type`` INSERT, UPDATE or NO_CHANGE.

    ``null_safe=False`` compares with plain inequality, which overlooks a change
    to or from NULL.
    """
    known = current.select(
        *keys, *[F.col(c).alias(f"_cur_{c}") for c in tracked], F.lit(True).alias("_known")
    )
    change = (
        F.when(F.col("_known").isNull(), "INSERT")
        .when(_changed(tracked, null_safe), "UPDATE")
        .otherwise("NO_CHANGE")
    )
    return (
        src.join(known, list(keys), "left")
        .withColumn("change_type", change)
        .drop("_known", *[f"_cur_{c}" for c in tracked])
    )


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def as_of(dim: DataFrame, stamp: str | Column) -> DataFrame:
    """The versions valid at a point in time."""
    point = _stamp(stamp)
    return dim.filter((F.col("valid_from") <= point) & (point < open_end(F.col("valid_to"))))


def _one_per_key(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows reduced to one per key; the order covers all columns."""
    rest = [c for c in src.columns if c not in keys]
    return dedup_latest(src, keys, [F.desc_nulls_last(c) for c in rest or keys]).drop("rn")


def scd2_delta(
    dim: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: str | Column,
    null_safe: bool = True,
    sk: str = "sk",
    unique_source: bool = False,
) -> DataFrame:
    """Closed versions and new versions of one load; the rest is not returned."""
    if not unique_source:
        src = _one_per_key(src, keys)
    changes = scd2_changes(src, current(dim), keys, tracked, null_safe)
    updated = changes.filter(F.col("change_type") == "UPDATE").select(*keys)
    closed = (
        current(dim)
        .join(updated, list(keys), "left_semi")
        .withColumn("valid_to", _stamp(as_of))
        .withColumn("is_current", F.lit(False))
    )
    fresh = changes.filter(F.col("change_type").isin("INSERT", "UPDATE")).drop("change_type")
    opened = scd2_init(fresh, keys, as_of, sk)
    return closed.select(*dim.columns).unionByName(opened.select(*dim.columns))


def scd2_apply(
    dim: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: str | Column,
    null_safe: bool = True,
    sk: str = "sk",
    unique_source: bool = False,
) -> DataFrame:
    """The dimension after one load. Keys missing from the source stay open.

    The current rows meet the source in one outer join; each pair yields its one
    or two versions, so the load shuffles each side once.
    """
    if not unique_source:
        src = _one_per_key(src, keys)
    stamp = _stamp(as_of)
    payload = [c for c in dim.columns if c not in [*keys, *HISTORY_COLUMNS, sk]]
    live = current(dim).select(*keys, F.struct(*dim.columns).alias("_dim"))
    new = src.select(*keys, F.struct(*payload).alias("_src"))
    pair = live.join(new, list(keys), "full")
    known, given = F.col("_dim").isNotNull(), F.col("_src").isNotNull()
    if null_safe:
        differ = any_of([differs(F.col(f"_dim.{c}"), F.col(f"_src.{c}")) for c in tracked])
    else:
        differ = any_of(
            [F.coalesce(F.col(f"_dim.{c}") != F.col(f"_src.{c}"), F.lit(False)) for c in tracked]
        )
    update = known & given & differ
    types = {f.name: f.dataType for f in dim.schema.fields}

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in dim.columns])

    kept = version({c: F.col(f"_dim.{c}") for c in dim.columns})
    closed = version(
        {c: F.col(f"_dim.{c}") for c in dim.columns}
        | {"valid_to": stamp, "is_current": F.lit(False)}
    )
    opened = version(
        {k: F.col(k) for k in keys}
        | {c: F.col(f"_src.{c}") for c in payload}
        | {
            "valid_from": stamp,
            "valid_to": sentinel(),
            "is_current": F.lit(True),
            sk: hash_of([*keys, stamp]),
        }
    )
    versions = (
        F.when(update, F.array(closed, opened)).when(known, F.array(kept)).otherwise(F.array(opened))
    )
    live_after = pair.select(F.explode(versions).alias("v")).select("v.*")
    return dim.filter(~F.col("is_current")).unionByName(live_after)


def scd1_apply(
    dim: DataFrame, src: DataFrame, keys: Sequence[str], unique_source: bool = False
) -> DataFrame:
    """Latest values win, no history."""
    if not unique_source:
        src = _one_per_key(src, keys)
    kept = dim.join(src.select(*keys), list(keys), "left_anti").select(*dim.columns)
    return kept.unionByName(src.select(*dim.columns))


def scd2_backfill(
    log: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts_col: str, tie: Sequence[str] = ()
) -> DataFrame:
    """History of a whole change log at once; equals loading it row by row.

    Rows that repeat the state before them are merged into it. Of several changes of a
    key at one time the last in the order of ``tie`` counts (the largest state without
    ``tie``), so every version has a length.
    """
    state = F.struct(*[F.col(c).alias(c) for c in tracked])
    last = F.max_by(state, F.struct(*[F.col(t) for t in tie])) if tie else F.max(state)
    log = log.groupBy(*keys, ts_col).agg(last.alias("_state")).select(*keys, ts_col, "_state.*")
    rows = ordered(log, keys, [ts_col])
    before = rows.lag(F.struct(state.alias("s")), "_before")
    starts = before.df.filter(
        F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(state)
    ).drop("_before")
    closed = rows.with_df(starts).lead(F.col(ts_col), "_next").frame()
    return closed.select(
        *keys,
        *tracked,
        F.col(ts_col).alias("valid_from"),
        F.coalesce("_next", sentinel()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def missing_current(src: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key has no current version."""
    return src.join(current(dim).select(*keys), list(keys), "left_anti")


