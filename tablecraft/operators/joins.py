"""Join shapes: enrichment, anti joins, alternatives, roles, as-of and fan-out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.functions.scalars import open_end
from tablecraft.operators.windows import ordered

LAST_TICK = 1 << 61  # an open end


def missing(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has no match (NOT EXISTS)."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def join_any(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Join on ``a = b OR c = d OR ...`` as one equi-join per alternative.

    A pair of rows met by an earlier alternative is left out of the later ones,
    so every pair appears once, as in the OR join.
    """
    result = None
    for i, (a, b) in enumerate(pairs):
        branch = left.join(right, left[a] == right[b])
        for pa, pb in pairs[:i]:
            branch = branch.filter(~F.coalesce(F.col(pa) == F.col(pb), F.lit(False)))
        result = branch if result is None else result.unionByName(branch)
    return result


def join_roles(
    fact: DataFrame, dim: DataFrame, roles: Mapping[str, str], dim_key: str, cols: Sequence[str]
) -> DataFrame:
    """One dimension joined once per role; its columns get the role as a prefix."""
    out = fact
    for role, fact_key in roles.items():
        side = dim.select(
            F.col(dim_key).alias(f"_{role}_key"), *[F.col(c).alias(f"{role}_{c}") for c in cols]
        )
        out = out.join(side, out[fact_key] == side[f"_{role}_key"], "left").drop(f"_{role}_key")
    return out


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: Sequence[str],
    tie: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Each fact with the version where ``valid_from <= ts < valid_to``.

    Versions of one key must not overlap; versions of no length are left out. A NULL
    key or time meets no version. Both sides are put in one time line per key and the
    latest version is carried forward, so the work is linear also where one key has
    most of the facts and many versions.
    """
    version = F.struct(
        *[F.col(c).alias(c) for c in cols],
        F.col(valid_from).alias("_from"),
        open_end(F.col(valid_to)).alias("_to"),
    )
    fact_row = F.struct(*[F.col(c) for c in facts.columns])
    lasting = history.filter(F.col(valid_from) < open_end(F.col(valid_to))).dropna(subset=list(keys))
    time_line = lasting.select(
        *keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_side"), version.alias("_version")
    ).unionByName(
        facts.select(
            *keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), *[F.col(c).alias(f"_k_{c}") for c in tie],
            fact_row.alias("_fact"),
        ),
        allowMissingColumns=True,
    )
    order = ["_t", "_side", *[f"_k_{c}" for c in tie]]
    carried = (
        ordered(time_line, keys, order).carry_forward(F.col("_version"), "_latest").frame()
    ).filter(F.col("_side") == 1)
    hit = F.col("_t") < F.col("_latest._to")
    for k in keys:
        hit = hit & F.col(k).isNotNull()
    return carried.select(
        "_fact.*", *[F.when(hit, F.col(f"_latest.{c}")).alias(c) for c in cols]
    )


def _tick(df: DataFrame, column: str) -> Column:
    """Times, dates and whole numbers as whole numbers on a line."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    raise ValueError(f"{column}: intervals are over times, dates or whole numbers, not {kind.simpleString()}")


def _leveled(intervals: DataFrame, keys: Sequence[str], lo: str, hi: str) -> DataFrame:
    """``_lo``, ``_hi`` and the ``_level`` of each interval: the smallest with length <= 2^level.

    An open end is the last moment; intervals without a length or with a NULL key are left out.
    """
    end = F.coalesce(_tick(intervals, hi), F.lit(LAST_TICK))
    length = F.col("_hi") - F.col("_lo")
    return (
        intervals.dropna(subset=list(keys))
        .withColumns({"_lo": _tick(intervals, lo), "_hi": end})
        .where("_lo < _hi")
        .withColumn("_level", F.when(length == 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int"))
    )


def _levels(leveled: DataFrame) -> list[int]:
    """The levels in use, 63 at most."""
    return sorted(r["_level"] for r in leveled.select("_level").distinct().collect())


def _at_blocks(leveled: DataFrame, level: Column | str) -> DataFrame:
    """One row per block that an interval touches at a level no smaller than its own: two at most."""
    blocks = F.sequence(F.expr(f"shiftright(_lo, {level})"), F.expr(f"shiftright(_hi - 1, {level})"))
    return leveled.withColumn("_block", F.explode(blocks))


def interval_join(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, lo: str = "valid_from", hi: str = "valid_to"
) -> DataFrame:
    """Each point with every interval of its key that holds it, ``lo <= at < hi``; they may overlap.

    Time is cut into blocks of 2^level. An interval belongs to the level just above its
    length, where it touches two blocks at most, and fills more than a quarter of what it
    touches; a point lies in one block of each level in use. So the join is one of equal
    keys, levels and blocks, which also spreads a key that owns most rows, and what it finds
    beside the hits is in proportion to them. Columns of the intervals that the points have
    too keep the values of the points. Neither side is broadcast: the planner sees the size
    before the rows are multiplied by levels and blocks.
    """
    keys = list(keys)
    leveled = _leveled(intervals, keys, lo, hi)
    levels = _levels(leveled)
    extra = [c for c in intervals.columns if c not in points.columns]
    side = _at_blocks(leveled, "_level").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_level", "_block", "_lo", "_hi",
        *[F.col(c).alias(f"_i_{c}") for c in extra],
    )
    each = F.array(*[F.lit(v) for v in levels]).cast("array<int>")
    placed = (
        points.withColumn("_at", _tick(points, at))
        .withColumn("_plevel", F.explode(each))
        .withColumn("_pblock", F.expr("shiftright(_at, _plevel)"))
    )
    same = (F.col("_plevel") == F.col("_level")) & (F.col("_pblock") == F.col("_block"))
    for i, k in enumerate(keys):
        same = same & (placed[k] == side[f"_k{i}"])
    return (
        placed.hint("merge").join(side, same)
        .where("_lo <= _at AND _at < _hi")
        .select(*points.columns, *[F.col(f"_i_{c}").alias(c) for c in extra])
    )


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], lo: str = "valid_from", hi: str = "valid_to"
) -> DataFrame:
    """Pairs of intervals of one key that share a moment: columns of ``right`` begin with ``other_``.

    Of a pair the shorter level is looked up at the longer one, where both touch two
    blocks at most; a pair is taken in the block where the later of the two begins, so once.
    Neither side is broadcast, as in ``interval_join``.
    """
    keys = list(keys)
    a, b = _leveled(left, keys, lo, hi), _leveled(right, keys, lo, hi)
    levels = sorted(set(_levels(a)) | set(_levels(b)))
    each = F.array(*[F.lit(v) for v in levels]).cast("array<int>")

    def renamed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])

    def climbing(df: DataFrame, own: bool) -> DataFrame:
        """At every level in use from its own on, or from the next one on."""
        up = F.filter(each, lambda v: v >= F.col("_level") if own else v > F.col("_level"))
        return _at_blocks(df.withColumn("_on", F.explode(up)), "_on")

    def resting(df: DataFrame) -> DataFrame:
        return _at_blocks(df.withColumn("_on", F.col("_level")), "_on")

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = renamed(x, "a_"), renamed(y, "b_")
        same = (x["a__on"] == y["b__on"]) & (x["a__block"] == y["b__block"])
        for k in keys:
            same = same & (x[f"a_{k}"] == y[f"b_{k}"])
        later = F.greatest("a__lo", "b__lo")
        return (
            x.hint("merge").join(y, same)
            .where((later < F.least("a__hi", "b__hi")) & (F.expr("shiftright(greatest(a__lo, b__lo), a__on)") == F.col("a__block")))
            .select(
                *[F.col(f"a_{c}").alias(c) for c in left.columns],
                *[F.col(f"b_{c}").alias(f"other_{c}") for c in right.columns if c not in keys],
            )
        )

    return met(climbing(a, own=True), resting(b)).unionByName(met(resting(a), climbing(b, own=False)))


def resolve_edges(
    edges: DataFrame,
    nodes: DataFrame,
    node_key: str,
    node_name: str,
    node: Column | str | None = None,
) -> DataFrame:
    """Edges with the names of both ends, optionally those that touch a node."""
    if node is not None:
        edges = edges.filter((F.col("source") == node) | (F.col("target") == node))
    ends = {}
    for end in ("source", "target"):
        ends[end] = nodes.select(
            F.col(node_key).alias(end), F.col(node_name).alias(f"{end}_name")
        )
    return edges.join(ends["source"], "source").join(ends["target"], "target")


def join_fanout(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Size of a join without running it: rows, largest key groups, output rows."""
    keys = list(keys)
    sides = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("l"), F.lit(0).cast("long").alias("r"))
    sides = sides.unionByName(
        right.groupBy(*keys).agg(F.lit(0).cast("long").alias("l"), F.count(F.lit(1)).alias("r"))
    )
    usable = F.lit(True)
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    per_key = sides.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    pairs = F.when(usable, F.col("l").cast("decimal(38,0)") * F.col("r"))
    return per_key.agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.max("l").alias("max_left"),
        F.max("r").alias("max_right"),
        F.coalesce(F.sum(pairs), F.lit(0)).cast("long").alias("out_rows"),
    )


def enrich_mappings(mapping: DataFrame, entity: DataFrame, attribute: DataFrame) -> DataFrame:
    """Mappings with the names of source entity, source and target attribute."""
    ent = entity.select(
        F.col("entity_id").alias("source_entity_id"), F.col("name").alias("source_entity_name")
    )
    src = attribute.select(
        F.col("attribute_id").alias("source_attribute_id"), F.col("name").alias("source_attr_name")
    )
    tgt = attribute.select(
        F.col("attribute_id").alias("target_attribute_id"), F.col("name").alias("target_attr_name")
    )
    return (
        mapping.join(ent, "source_entity_id", "left")
        .join(src, "source_attribute_id", "left")
        .join(tgt, "target_attribute_id", "left")
    )
