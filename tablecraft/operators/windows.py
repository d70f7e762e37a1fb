"""Ordered windows that hold up when one group owns most of the rows.

A window gives each group to one task. Where the largest group is small that is
the best plan. Beyond ``tablecraft.maxGroupRows`` the rows are ranged over
(group, order) instead, so a large group spans many segments; every segment is
computed on its own, and what it needs from the segments before it (a count, a
sum, the last row) comes from a carry table. Only a group that crosses a segment
border needs a carry row, so that table has fewer rows than there are segments.
Both ways give the same rows and the same types. Without a group there is nothing
but the order, and rows are always ranged over it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.session import cut_lineage, group_limit

SEGMENT = "_segment"
_POS = "_pos"
_CARRY = "_carry"

RANKING = ("row_number", "rank", "dense_rank", "ntile")
NAVIGATION = ("lag", "lead", "first_value", "last_value", "nth_value")


@dataclass(frozen=True)
class Desc:
    """A descending order column for functions that also need the plain value."""

    name: str


def _cols(items: Sequence) -> list[Column]:
    """Order columns: a name is ascending, ``Desc`` descending, a Column as given."""
    return [
        F.desc(i.name) if isinstance(i, Desc) else F.col(i) if isinstance(i, str) else i
        for i in items
    ]


def _plain(item: str | Desc) -> Column:
    return F.col(item.name if isinstance(item, Desc) else item)


def _direct(item: str | Desc, name: str) -> Column:
    return F.desc(name) if isinstance(item, Desc) else F.asc(name)


def group_sizes(df: DataFrame, part: Sequence[str]) -> tuple[int, int]:
    """(rows, rows of the largest group); counted with map-side combining."""
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    return int(row["total"] or 0), int(row["largest"] or 0)


def join_nullsafe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which NULL keys meet; the keys of ``left`` are kept."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    cond = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys], F.lit(True)
    )
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def join_per_key(
    df: DataFrame, per_key: DataFrame, keys: Sequence[str], n: str = "_n", keep_n: bool = False
) -> DataFrame:
    """Attach one row per key to many rows, also where a key owns most of them.

    ``per_key`` holds every key of ``df`` once, with its number of rows in ``n``. It
    is stored first: against a plain table, Spark splits the partition of a key that
    owns most rows, which it does not against an aggregate, and it knows the size
    when it chooses how to join.
    """
    values = [c for c in per_key.columns if c not in keys and (keep_n or c != n)]
    stored = cut_lineage(per_key.select(*keys, *values), "per-key")
    return join_nullsafe(df, stored, keys).select(*df.columns, *values)


@dataclass(frozen=True)
class Ordered:
    """Rows with a group and an order; ``split`` says groups span segments."""

    df: DataFrame
    part: tuple[str, ...]
    order: tuple
    split: bool

    def _group(self) -> list[str]:
        return [*self.part, SEGMENT] if self.split else list(self.part)

    def window(self):
        return Window.partitionBy(*self._group()).orderBy(*_cols(self.order))

    def with_df(self, df: DataFrame) -> "Ordered":
        """Same grouping over changed or filtered rows."""
        return replace(self, df=df)

    def frame(self) -> DataFrame:
        return self.df.drop(SEGMENT)

    def _with_carry(self, carry: DataFrame) -> DataFrame:
        """Attach the carry; it has at most one row per segment border."""
        return join_nullsafe(self.df, carry, [*self.part, SEGMENT])

    def _across(self):
        return Window.partitionBy(*self.part).orderBy(SEGMENT)

    def running_sum(self, value: Column, out: str) -> "Ordered":
        frame = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if not self.split:
            return self.with_df(self.df.withColumn(out, F.sum(value).over(frame)))
        before = self._across().rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            self.df.groupBy(*self._group())
            .agg(F.sum(value).alias("_total"))
            .withColumn(_CARRY, F.sum("_total").over(before))
            .filter(F.col(_CARRY).isNotNull())
            .drop("_total")
        )
        joined = self._with_carry(carry)
        local = F.sum(value).over(frame)
        total = F.when(
            local.isNotNull() | F.col(_CARRY).isNotNull(),
            F.coalesce(local, F.lit(0)) + F.coalesce(F.col(_CARRY), F.lit(0)),
        )
        # the type of a plain window, whose range the total never needs to leave
        kind = joined.select(local.alias("x")).schema["x"].dataType
        return self.with_df(joined.withColumn(out, total.cast(kind)).drop(_CARRY))

    def row_number(self, out: str) -> "Ordered":
        if not self.split:
            numbered = self.df.withColumn(out, F.row_number().over(self.window()).cast("long"))
            return self.with_df(numbered)
        return self.running_sum(F.lit(1).cast("long"), out)

    def _neighbour(self, value: Column, out: str, forward: bool) -> "Ordered":
        shift = F.lead if forward else F.lag
        wrapped = F.struct(value.alias("v"))
        if not self.split:
            moved = shift(wrapped, 1).over(self.window())
            return self.with_df(self.df.withColumn(out, moved.getField("v")))
        placed = self.df.withColumn(_POS, F.row_number().over(self.window()))
        edge = F.min_by if forward else F.max_by
        carry = (
            placed.groupBy(*self._group())
            .agg(edge(wrapped, F.col(_POS)).alias("_edge"))
            .withColumn(_CARRY, shift("_edge", 1).over(self._across()))
            .filter(F.col(_CARRY).isNotNull())
            .drop("_edge")
        )
        joined = self._with_carry(carry)
        local = shift(wrapped, 1).over(self.window())
        moved = F.coalesce(local, F.col(_CARRY)).getField("v")
        return self.with_df(joined.withColumn(out, moved).drop(_CARRY))

    def lag(self, value: Column, out: str) -> "Ordered":
        return self._neighbour(value, out, forward=False)

    def lead(self, value: Column, out: str) -> "Ordered":
        return self._neighbour(value, out, forward=True)

    def carry_forward(self, value: Column, out: str) -> "Ordered":
        """Latest non-null value up to and including the row."""
        frame = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = F.last(value, ignorenulls=True).over(frame)
        if not self.split:
            return self.with_df(self.df.withColumn(out, local))
        placed = self.df.withColumn(_POS, F.row_number().over(self.window()))
        before = self._across().rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            placed.groupBy(*self._group())
            .agg(F.max_by(value, F.when(value.isNotNull(), F.col(_POS))).alias("_edge"))
            .withColumn(_CARRY, F.last("_edge", ignorenulls=True).over(before))
            .filter(F.col(_CARRY).isNotNull())
            .drop("_edge")
        )
        joined = self._with_carry(carry)
        return self.with_df(
            joined.withColumn(out, F.coalesce(local, F.col(_CARRY))).drop(_CARRY)
        )


def ordered(
    df: DataFrame, part: Sequence[str], order: Sequence[str | Column], sizes: tuple[int, int] | None = None
) -> Ordered:
    """Prepare ``df`` for ordered functions; splits groups beyond the row limit.

    Without a group the rows are always split. ``order`` must be unique inside a group. The segments are stored, because a
    segment number read twice from a shuffle could differ between the reads. ``sizes`` are
    the ``group_sizes``, or bounds above them, where they are known without computing ``df``.
    """
    if not order:
        raise ValueError("an ordered window needs an order")
    spark = df.sparkSession
    limit = group_limit(spark)
    total = 0
    if part:
        total, largest = sizes or group_sizes(df, part)
        if largest <= limit:
            return Ordered(df, tuple(part), tuple(order), split=False)
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / limit))
    ranged = df.repartitionByRange(segments, *_cols(part), *_cols(order))
    stored = cut_lineage(ranged.withColumn(SEGMENT, F.spark_partition_id()))
    return Ordered(stored, tuple(part), tuple(order), split=True)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie: Sequence[str | Column] = (),
) -> DataFrame:
    """First row per key in a unique order, with ``rn`` = 1.

    Spark limits the group before the shuffle, so each task ships at most one
    row per key.
    """
    if not order:
        raise ValueError("a deterministic dedup needs an order")
    w = Window.partitionBy(*keys).orderBy(*_cols(order), *_cols(tie))
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)


TIE_LABELS = ("TIE_RESOLVED", "NO_TIE")


def with_tie_monitor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str | Column],
    labels: tuple[str, str] = TIE_LABELS,
    descending: bool = True,
) -> DataFrame:
    """Deduplicated rows with the number of rows that shared the winning order."""
    direction = F.desc if descending else F.asc
    kept = dedup_latest(df, keys, [direction(o) for o in order], tie)
    shared = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_dq_tie_count"))
    return join_nullsafe(kept, shared, [*keys, *order], "inner").withColumn(
        "_dq_determinism_status",
        F.when(F.col("_dq_tie_count") > 1, labels[0]).otherwise(labels[1]),
    )


def first_by(
    df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, out: str
) -> DataFrame:
    """Every row with the value of ``col`` in the first row of its group.

    The first value is an aggregate, combined before the shuffle; it is joined
    back, so a large group stays spread over its tasks.
    """
    first = df.groupBy(*part).agg(
        F.min_by(col, F.struct(*order)).alias(out), F.count(F.lit(1)).alias("_n")
    )
    return join_per_key(df, first, part)


def rank_columns(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str | Desc],
    tie: Sequence[str | Desc],
    columns: Mapping[str, str],
    buckets: int | None = None,
) -> DataFrame:
    """Several ranking columns, output name -> function, over one ordering."""
    unknown = set(columns.values()) - set(RANKING)
    if unknown:
        raise ValueError(f"unknown ranking functions {sorted(unknown)}")
    if not order:
        raise ValueError("ranking functions need an order")
    rows = ordered(df, part, [*order, *tie])
    if not rows.split:
        full = rows.window()
        peers = Window.partitionBy(*part).orderBy(*_cols(order))
        values = {
            "row_number": lambda: F.row_number().over(full),
            "rank": lambda: F.rank().over(peers),
            "dense_rank": lambda: F.dense_rank().over(peers),
            "ntile": lambda: F.ntile(buckets).over(full),
        }
        return df.select("*", *[values[fn]().cast("long").alias(o) for o, fn in columns.items()])
    wanted = set(columns.values())
    names = [f"_o{i}" for i in range(len(order))]
    out = rows.row_number("_rn").frame().select("*", *[_plain(o).alias(n) for o, n in zip(order, names)])
    if wanted & {"rank", "dense_rank"}:
        # one row per group and order value, with the first position of that value
        values = out.groupBy(*part, *names).agg(
            F.min("_rn").alias("_rank"), F.count(F.lit(1)).alias("_n")
        )
        if "dense_rank" in wanted:
            directed = [_direct(o, n) for o, n in zip(order, names)]
            values = ordered(values, part, directed).row_number("_dense").frame()
        out = join_per_key(out, values, [*part, *names])
    if "ntile" in wanted:
        per_group = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
        out = join_per_key(out, per_group, part, keep_n=True)
        small, extra = F.expr(f"_n div {buckets}"), F.expr(f"_n % {buckets}")
        wide = extra * (small + 1)
        out = out.withColumn(
            "_tile",
            F.when(
                F.col("_rn") <= wide, F.floor((F.col("_rn") - 1) / (small + 1)) + 1
            ).otherwise(extra + F.floor((F.col("_rn") - 1 - wide) / small) + 1),
        )
    source = {"row_number": "_rn", "rank": "_rank", "dense_rank": "_dense", "ntile": "_tile"}
    return out.select(
        *df.columns, *[F.col(source[fn]).cast("long").alias(o) for o, fn in columns.items()]
    )


def ranked(
    df: DataFrame,
    fn: str,
    part: Sequence[str],
    order: Sequence[str | Desc],
    tie: Sequence[str | Desc],
    out: str,
    buckets: int | None = None,
) -> DataFrame:
    """ROW_NUMBER, RANK, DENSE_RANK or NTILE with an enforced order."""
    return rank_columns(df, part, order, tie, {out: fn}, buckets)


def navigate_columns(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str | Column],
    columns: Mapping[str, tuple],
) -> DataFrame:
    """Several navigation columns, output name -> (function, column[, n]), over one ordering.

    LAG and LEAD look ``n`` rows away (1 unless given); FIRST, LAST and NTH look
    at the whole group.
    """
    unknown = {spec[0] for spec in columns.values()} - set(NAVIGATION)
    if unknown:
        raise ValueError(f"unknown navigation functions {sorted(unknown)}")
    if not order:
        raise ValueError("navigation functions need an order")
    rows = ordered(df, part, order)
    if not rows.split:
        one = rows.window()
        whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        values = {
            "lag": lambda col, n=1: F.lag(col, n).over(one),
            "lead": lambda col, n=1: F.lead(col, n).over(one),
            "first_value": lambda col: F.first(col).over(whole),
            "last_value": lambda col: F.last(col).over(whole),
            "nth_value": lambda col, n: F.nth_value(col, n).over(whole),
        }
        return df.select("*", *[values[fn](*args).alias(o) for o, (fn, *args) in columns.items()])
    picked = {
        "first_value": lambda col: F.min_by(col, "_rn"),
        "last_value": lambda col: F.max_by(col, "_rn"),
        "nth_value": lambda col, n: F.max(F.when(F.col("_rn") == n, F.col(col))),
    }
    per_group = {o: picked[fn](*args) for o, (fn, *args) in columns.items() if fn in picked}
    distant = []
    for o, (fn, *args) in columns.items():
        if fn in picked:
            continue
        if len(args) == 1 or args[1] == 1:
            rows = getattr(rows, fn)(F.col(args[0]), o)
        else:
            distant.append((o, args[0], args[1] if fn == "lag" else -args[1]))
    if distant:
        # (group, position) is unique, so this join spreads a large group evenly
        placed = rows.row_number("_rn").df
        for o, col, shift in distant:
            other = placed.select(*part, (F.col("_rn") + shift).alias("_rn"), F.col(col).alias(o))
            placed = join_nullsafe(placed, other, [*part, "_rn"])
        rows = rows.with_df(placed.drop("_rn"))
    if not per_group:
        return rows.frame().select(*df.columns, *columns)
    numbered = rows.row_number("_rn").frame()
    groups = numbered.groupBy(*part).agg(
        *[value.alias(o) for o, value in per_group.items()], F.count(F.lit(1)).alias("_n")
    )
    return join_per_key(numbered, groups, part).select(*df.columns, *columns)


def navigate(
    df: DataFrame,
    fn: str,
    part: Sequence[str],
    order: Sequence[str | Column],
    col: str,
    out: str,
    nth: int = 1,
) -> DataFrame:
    """LAG, LEAD, FIRST_VALUE, LAST_VALUE or NTH_VALUE with an enforced order.

    ``nth`` is the position for NTH_VALUE and the distance for LAG and LEAD.
    """
    spec = (fn, col) if fn in ("first_value", "last_value") else (fn, col, nth)
    return navigate_columns(df, part, order, {out: spec})


def assign_sk(
    df: DataFrame, keys: Sequence[str], start: Column | int = 0, out: str = "sk"
) -> DataFrame:
    """Sequence keys start+1, start+2, ... over all key columns in order."""
    numbered = ordered(df, [], list(keys)).row_number(out).frame()
    base = F.lit(start) if isinstance(start, int) else start
    return numbered.withColumn(out, (F.col(out) + base).cast("long"))


def running_total(
    df: DataFrame, part: Sequence[str], order: Sequence[str | Column], amount: str, out: str
) -> DataFrame:
    """Balance after each row."""
    return ordered(df, part, order).running_sum(F.col(amount), out).frame()


def sample_mod(df: DataFrame, key: str, buckets: int, keep: int) -> DataFrame:
    """Deterministic sample: key modulo ``buckets`` below ``keep``, in key order."""
    bucket = F.pmod(F.col(key), F.lit(buckets)).cast("long")
    return df.withColumn("sample_bucket", bucket).filter(F.col("sample_bucket") < keep).orderBy(key)


def sample_hash(df: DataFrame, key: str, buckets: int, keep: int) -> DataFrame:
    """Deterministic sample by the md5 of the key; same rows on every run."""
    digest = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8)
    bucket = F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(buckets)).cast("long")
    return df.withColumn("sample_bucket", bucket).filter(F.col("sample_bucket") < keep)
