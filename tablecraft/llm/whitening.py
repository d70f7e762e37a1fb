"""Embedding whitening: distinct vectors with multiplicities as fit weights.

Entries are put on a grid of whole numbers, so equal vectors are found by equality.
Identical grid vectors are grouped first; the fit gives each distinct vector its count or
one as weight. The covariance is a weighted, centred matrix product per block of rows,
added up by Spark; its eigenvectors are found on the driver, which holds a matrix of
dimension by dimension and never rows. Every distinct vector is whitened once and joined
back to the rows that have it; that table is stored before the join, so a vector that
a third of the rows share is split between tasks.

Defined cases: rows whose vector is null or has null, NaN or infinite entries are dropped.
Entries beyond 2^44 grid steps count as 2^44. Vectors of another length than most
distinct vectors have (of equal counts the greater length) are dropped too, since no
covariance is defined with them. Components without variance, within rounding, are not
returned, so a table without rows or with one distinct vector gives none. A deviation
beyond 2^63 - 1 is null. Null and repeated ids are kept as they are; other columns are
left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import store

SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 16
CLAMP = float(1 << 44)
BLOCK = 2_048  # rows of one matrix product


@dataclass
class Fit:
    """What the fit keeps: sizes, sums, and the whitening matrix (dimension x components)."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    matrix: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def on_grid(vectors: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``x``, the grid vector as bytes of 8 per entry; unusable rows go."""
    kept = vectors.select(*[F.col(f"`{c}`") for c in columns], F.col("embedding").alias("x"))
    fields = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(columns))
            flat = lists.flatten()
            entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            lengths = np.where(lists.is_null(), 0, lists.value_lengths().fill_null(0)).astype(np.int64)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
            usable = ~np.asarray(lists.is_null()) & (bad[ends] == bad[ends - lengths])
            steps = np.clip(np.floor(np.where(np.isfinite(entries), entries, 0.0) * SCALE), -CLAMP, CLAMP)
            grid = steps.astype("<i8") + OFFSET
            keys = [
                grid[end - size : end].tobytes() for end, size, ok in zip(ends, lengths, usable) if ok
            ]
            rows = batch.filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[: len(columns)], pa.array(keys, pa.binary())], names=[*columns, "x"]
            )

    return kept.mapInArrow(run, f"{fields}, x binary" if columns else "x binary")


def grid_rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i8").reshape(-1, dims)


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, BLOCK):
        yield batch.slice(at, BLOCK)


def distinct_vectors(grid: DataFrame) -> DataFrame:
    """Each grid vector once, with its ``copies``; stored."""
    return store(grid.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct_vectors")


def usual_length(distinct: DataFrame) -> int:
    """The number of entries that most distinct vectors have; one row reaches the driver."""
    sizes = distinct.groupBy(F.length("x").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max_by("bytes", F.struct("n", "bytes")).alias("bytes")).first()
    return (most["bytes"] or 0) // 8


def weight_of(weights: str) -> Column:
    if weights not in ("one", "count"):
        raise ValueError(f"unknown weights {weights!r}")
    return (F.lit(1) if weights == "one" else F.col("copies")).cast("long").alias("w")


def column_sums(distinct: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Exact weighted size and sums; one row per dimension reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, [0] * dims
        for batch in batches:
            for block in blocks(batch):
                x, w = grid_rows(block, dims), block.column("w").to_pylist()
                # heavy weights leave 64 bits: sums in whole numbers of any size
                whole = np.asarray(w, dtype=object) if max(w, default=0) > 64 else np.asarray(w)
                total += int(sum(w))
                part = (x * whole[:, None]).sum(axis=0)
                sums = [a + int(b) for a, b in zip(sums, part)]
        if total:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(-1, dims), pa.int32()),
                    pa.array([str(v) for v in (total, *sums)], pa.string()),
                ],
                names=["d", "v"],
            )

    parts = distinct.mapInArrow(run, "d int, v string")
    rows = parts.groupBy("d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    found = {r["d"]: int(r["v"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dims)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, from exact whole numbers where they fit 64 bits."""
    floors = np.array([s // n for s in sums], dtype=np.int64)
    rests = np.array([(s % n) / n for s in sums])
    return (x - floors).astype(np.float64) - rests


def products(rows: DataFrame, width: int, of_block) -> np.ndarray:
    """The sum over all rows of weighted products of ``of_block``'s columns, width x width.

    Each task adds up its blocks and sends one matrix, which Spark adds entry by entry;
    width * width numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for block in blocks(batch):
                values, w = of_block(block), block.column("w").to_numpy().astype(np.float64)
                total += (values * w[:, None]).T @ values
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"]
        )

    out = np.zeros((width, width))
    parts = rows.mapInArrow(run, "i int, j int, v double")
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def fit(distinct: DataFrame, dims: int, weights: str = "one", components: int = COMPONENTS) -> Fit:
    """Eigenvectors of the weighted covariance of the distinct vectors, over root eigenvalues."""
    rows = distinct.where(F.length("x") == dims * 8).select("x", weight_of(weights))
    n, sums = column_sums(rows, dims) if dims else (0, [])
    if not n:
        return Fit(0, sums, np.zeros(0), 0.0, np.zeros((dims, 0)))
    total = products(rows, dims, lambda block: centred(grid_rows(block, dims), n, sums))
    values, vectors = np.linalg.eigh(total / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(total / n))
    # either sign is an eigenvector: the largest entry is positive, whatever the order of sums
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)])
    real = int(np.sum(values > max(trace, 0.0) * dims * 1e-13))
    keep = min(components, real)
    matrix = vectors[:, :keep] / np.sqrt(values[:keep])
    return Fit(n, sums, values[:keep], trace, matrix)


def identity_error(distinct: DataFrame, fitted: Fit, weights: str = "one") -> float:
    """Largest entry of the whitened covariance minus the identity, measured on the vectors."""
    dims, width = fitted.matrix.shape
    n, sums, matrix = fitted.n, fitted.sums, fitted.matrix
    rows = distinct.where(F.length("x") == dims * 8).select("x", weight_of(weights))

    def whitened(block: pa.RecordBatch) -> np.ndarray:
        values = centred(grid_rows(block, dims), n, sums) @ matrix
        # a last column of ones gives the sums, and with them the means
        return np.hstack([values, np.ones((len(values), 1))])

    total = products(rows, width + 1, whitened) / n
    mean = total[:width, width]
    return float(np.abs(total[:width, :width] - np.outer(mean, mean) - np.eye(width)).max(initial=0.0))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2, exact; null beyond 64 bits."""
    reach = max((max(abs(n * int(x[:, d].min()) - s), abs(n * int(x[:, d].max()) - s)) for d, s in enumerate(sums)), default=0)
    if len(sums) * reach * reach < 1 << 63 and n * int(np.abs(x).max(initial=0)) < 1 << 63:
        gaps = n * x - np.array(sums, dtype=np.int64)
        return (gaps * gaps).sum(axis=1).tolist()
    gaps = n * x.astype(object) - np.array(sums, dtype=object)
    return [v if v < 1 << 63 else None for v in (gaps * gaps).sum(axis=1).tolist()]


def whiten_distinct(distinct: DataFrame, fitted: Fit) -> DataFrame:
    """(x, deviation, whitened array) of every distinct vector, stored."""
    dims = fitted.matrix.shape[0]
    n, sums, matrix = fitted.n, fitted.sums, fitted.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                if block.num_rows:
                    x = grid_rows(block, dims)
                    values = centred(x, n, sums) @ matrix
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.column("x"),
                            pa.array(deviations(x, n, sums), pa.int64()),
                            pa.array(list(values), pa.list_(pa.float64())),
                        ],
                        names=["x", "deviation", "whitened"],
                    )

    usual = distinct.where(F.length("x") == dims * 8).select("x")
    return store(usual.mapInArrow(run, "x binary, deviation long, whitened array<double>"), "whitened")


def whiten(
    vectors: DataFrame, key: str = "vec_id", weights: str = "one", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable row and component: its whitened value and the figures of the fit."""
    grid = on_grid(vectors, [key])
    distinct = distinct_vectors(on_grid(vectors, []))
    fitted = fit(distinct, usual_length(distinct), weights, components)
    width = len(fitted.values)
    error = identity_error(distinct, fitted, weights) if width else 0.0
    if width:
        table = whiten_distinct(distinct, fitted)
    else:
        table = distinct.select("x", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    shares = F.array(*[F.lit(float(v)) for v in fitted.explained]).cast("array<double>")
    return (
        grid.join(table, "x")
        .select(F.col(f"`{key}`"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            F.col(f"`{key}`"),
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(fitted.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(shares, F.col("at") + 1).alias("explained") if width else F.lit(0.0).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
