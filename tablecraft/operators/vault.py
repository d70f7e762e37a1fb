"""Data Vault loads and checks on hash keys.

One rule for business keys with a NULL part holds in hubs, links and satellites: they
are no keys, such rows are not loaded, and ``rejected`` returns them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions.scalars import differs, hash_of, ts
from tablecraft.operators.windows import dedup_latest, ordered


def rejected(src: DataFrame, bk: Sequence[str]) -> DataFrame:
    """Rows that no load takes, as a part of their business key is NULL."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in bk])
    return src.filter(~whole)


def load_hub(
    src: DataFrame,
    bk: Sequence[str],
    hash_key: str,
    as_of: str,
    source: str,
    hub: DataFrame | None = None,
) -> DataFrame:
    """New hub rows: one per business key the hub does not have."""
    keys = src.select(*bk).dropna(subset=list(bk)).distinct()
    rows = keys.select(
        hash_of(list(bk)).alias(hash_key),
        *bk,
        ts(as_of).alias("load_date"),
        F.lit(source).alias("record_source"),
    )
    return rows if hub is None else rows.join(hub.select(hash_key), hash_key, "left_anti")


def load_link(
    src: DataFrame,
    hubs: Mapping[str, Sequence[str]],
    hash_key: str,
    as_of: str,
    source: str,
    link: DataFrame | None = None,
) -> DataFrame:
    """New link rows: a hash over all business keys and one hash per hub."""
    if len(hubs) < 2:
        raise ValueError("a link connects at least two hubs")
    parts = [c for bk in hubs.values() for c in bk]
    keys = src.select(*parts).dropna(subset=parts).distinct()
    rows = keys.select(
        hash_of(parts).alias(hash_key),
        *[hash_of(list(bk)).alias(name) for name, bk in hubs.items()],
        ts(as_of).alias("load_date"),
        F.lit(source).alias("record_source"),
    )
    return rows if link is None else rows.join(link.select(hash_key), hash_key, "left_anti")


def load_satellite(
    src: DataFrame,
    bk: Sequence[str],
    attrs: Sequence[str],
    hash_key: str,
    as_of: str,
    source: str,
    sat: DataFrame | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """New satellite rows: keys whose attribute hash differs from the latest one.

    ``order`` ranks several rows of one key; the first in that order is its state.
    Without it a key may come once only, else the load raises. Equal rows of a key
    are one state.
    """
    hashed = src.dropna(subset=list(bk)).select(
        hash_of(list(bk)).alias("_hk"), hash_of(list(attrs)).alias("_diff"), "*"
    )
    if order:
        hashed = dedup_latest(hashed, ["_hk"], list(order), ["_diff"]).drop("rn")
    else:
        # checked where the rows are read, so the source is not run a second time for it
        whole = F.struct(F.col("_diff"), *[F.col(a).alias(f"a{i}") for i, a in enumerate(attrs)])
        hashed = hashed.groupBy("_hk").agg(F.min(whole).alias("_s"), F.max("_diff").alias("_other"))
        several = F.raise_error(F.lit("several states of one key need an order")).cast("string")
        hashed = hashed.select(
            "_hk", F.when(F.col("_s._diff") == F.col("_other"), F.col("_s._diff")).otherwise(several).alias("_diff"),
            *[F.col(f"_s.a{i}").alias(a) for i, a in enumerate(attrs)],
        )
    rows = hashed.select(
        F.col("_hk").alias(hash_key),
        ts(as_of).alias("load_date"),
        *attrs,
        F.col("_diff").alias("hash_diff"),
        F.lit(source).alias("record_source"),
    )
    if sat is None:
        return rows
    latest = (
        sat.groupBy(hash_key)
        .agg(F.max_by("hash_diff", "load_date").alias("_latest"))
    )
    return (
        rows.join(latest, hash_key, "left")
        .filter(differs(F.col("hash_diff"), F.col("_latest")))
        .drop("_latest")
    )


def satellite_from_log(
    log: DataFrame, hash_key: str, load_date: str, diff: str = "hash_diff"
) -> DataFrame:
    """Satellite rows of many snapshots at once: rows whose hash changed."""
    before = ordered(log, [hash_key], [load_date, diff]).lag(F.col(diff), "_before").frame()
    return before.filter(differs(F.col(diff), F.col("_before"))).drop("_before")


def check_vault(
    hubs: Mapping[str, tuple[DataFrame, str]],
    links: Mapping[str, tuple[DataFrame, Mapping[str, str]]],
    satellites: Mapping[str, tuple[DataFrame, str, str]],
) -> DataFrame:
    """Hash keys without their hub, and hub keys without a satellite row.

    ``hubs``: name -> (rows, hash column). ``links``: name -> (rows, {hash column:
    hub}). ``satellites``: name -> (rows, hash column, hub). Hashes are counted
    per key before each join.
    """

    def lost(child, column, parent, parent_column, rule, table, parent_name):
        per_key = child.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
        known = parent.select(F.col(parent_column).alias("_k")).distinct()
        known = known.withColumn("_found", F.lit(True))
        joined = per_key.join(known, "_k", "left")
        return joined.agg(
            F.coalesce(
                F.sum(F.when(F.col("_found").isNull(), F.col("n")).otherwise(0)), F.lit(0)
            ).cast("long").alias("failed_rows"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        ).select(
            F.lit(rule).alias("rule"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent_name).alias("parent"),
            "failed_rows",
            "total_rows",
        )

    parts = []
    for name, (rows, refs) in links.items():
        for column, hub in refs.items():
            parent, parent_column = hubs[hub]
            parts.append(lost(rows, column, parent, parent_column, "link_hub", name, hub))
    for name, (rows, column, hub) in satellites.items():
        parent, parent_column = hubs[hub]
        parts.append(lost(rows, column, parent, parent_column, "satellite_hub", name, hub))
        parts.append(lost(parent, parent_column, rows, column, "hub_satellite", hub, name))
    return reduce(DataFrame.unionByName, parts)
