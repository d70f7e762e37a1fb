"""Labelled samples of a bounded size, chosen by hash, for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 1 << 24


def by_hash(rows: DataFrame, key: str, most: int, seed: str) -> DataFrame:
    """About ``most`` rows of ``rows``: those whose key hashes below a cut."""
    total = rows.count()
    cut = min(WIDTH, -(-most * WIDTH // max(total, 1)))
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(WIDTH)) < cut)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))
