"""Filters and metadata-driven projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def since(df: DataFrame, col: str, date: str) -> DataFrame:
    """Rows on or after a date; the filter reaches the Parquet scan."""
    return df.filter(F.col(col) >= F.lit(date).cast("timestamp_ntz"))


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """NOT IN: a NULL value drops the row as well."""
    return df.filter(~F.col(col).isin(*values))


def project(
    df: DataFrame, cols: Sequence[str], transforms: Mapping[str, str] | None = None
) -> DataFrame:
    """Listed columns, some replaced by an expression."""
    transforms = transforms or {}
    return df.select(*[F.expr(transforms.get(c, c)).alias(c) for c in cols])


def apply_mappings(
    df: DataFrame, attributes: Sequence[Mapping], mappings: Sequence[Mapping]
) -> DataFrame:
    """Target rows from attribute metadata and attribute mappings.

    ``attributes``: name, ordinal, optional expression. ``mappings``: target,
    mapping_type (direct, rename, derived, constant, aggregation), source,
    transformation. Without a mapping the attribute's own expression applies,
    else the column of the same name. An aggregation groups by the other columns.
    """
    by_target = {m["target"]: m for m in mappings}
    if len(by_target) < len(mappings):
        raise ValueError("two mappings have one target")
    plain, aggregates, names = [], [], []
    for attr in sorted(attributes, key=lambda a: a["ordinal"]):
        name, mapping = attr["name"], by_target.get(attr["name"])
        kind = mapping["mapping_type"] if mapping else None
        if kind in ("direct", "rename") and mapping.get("source"):
            text = mapping["source"]
        elif kind in ("derived", "constant", "aggregation") and mapping.get("transformation"):
            text = mapping["transformation"]
        elif mapping is None and attr.get("expression"):
            text = attr["expression"]
        else:
            text = name
        (aggregates if kind == "aggregation" else plain).append(F.expr(text).alias(name))
        names.append(name)
    if not aggregates:
        return df.select(*plain)
    return df.groupBy(*plain).agg(*aggregates).select(*names)


def derive_entity(
    frames: Mapping[str, DataFrame],
    attributes: Sequence[Mapping],
    relationships: Sequence[tuple[str, str, Sequence[tuple[str, str]]]],
) -> DataFrame:
    """A derived entity over its sources, joined on their relationship keys.

    ``relationships``: (left source, right source, key pairs), in either direction.
    Every source after the first needs one, so no source is multiplied without a key;
    further ones between joined sources restrict the rows.
    """
    names = list(frames)
    joined = frames[names[0]].alias(names[0])
    present = {names[0]}
    for left, right, pairs in relationships:
        fresh = [x for x in (left, right) if x not in present]
        if len(fresh) > 1 or not pairs:
            raise ValueError(f"no usable key joins {left} and {right} to {sorted(present)}")
        cond = F.lit(True)
        for a, b in pairs:
            cond = cond & (F.col(f"{left}.{a}") == F.col(f"{right}.{b}"))
        if fresh:
            joined = joined.join(frames[fresh[0]].alias(fresh[0]), cond)
            present.add(fresh[0])
        else:
            joined = joined.filter(cond)
    if present != set(names):
        raise ValueError(f"sources without a relationship: {sorted(set(names) - present)}")
    return joined.select(
        *[F.expr(a.get("expression") or a["name"]).alias(a["name"]) for a in attributes]
    )
