"""SimHash near-copies by tables of distances to reference fingerprints.

A fingerprint has one bit per position, 1 where more than half of the hashes of a
text's word shingles have it. Two fingerprints are linked at up to ``distance``
differing bits, and the links' components are the groups.

References have bits in one block of the fingerprint only. The distances to the
references of one block differ by no more than the bits that differ in that block, and
the blocks share no bits; so if at most ``distance`` bits differ, at most ``distance``
blocks have unequal distance vectors, and the others agree. With ``distance + equal``
blocks, each choice of ``equal`` of them is a bucket key: the distances of those blocks.
Linked fingerprints meet under at least one key. Within a bucket, pairs whose distances
to any reference differ by more than ``distance`` are discarded, and the rest is verified
on the bits. A bucket gives the edges of a spanning forest, not its pairs. Buckets are
dealt out in chunks of bounded size, every pair of chunks a task of its own, so none
grows with the data.

No side of a join is broadcast: the planner sees a table before its rows are multiplied
by keys, or the size of its files, which is a fraction of what a broadcast holds. What a
key owns once is stored before it meets the key's rows, so that a common key is split.

The pipeline's stage (``keep_one``) keeps one row of every group.

Defined cases: a null text is an empty one; texts without words have fingerprint zero
and link like any other; shorter texts are hashed as one sequence; equal fingerprints
are one node, so copies cost nothing; null doc_ids are not smaller than any id, and a
group of null ids has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.common import components, map_texts, pieces, store

SEED = 42
REFERENCES = 8  # per block
CHUNK = 2048  # fingerprints of a bucket that meet in one task, per side


def shingles(text: str | None, words: int) -> list[bytes]:
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return [b" ".join(found)] if found else []
    return [b" ".join(t) for t in zip(*(found[i:] for i in range(words)))]


def fingerprint64(text: str | None) -> int:
    """The 64 bits of a text by three-word shingles, as a signed number."""
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(s, seed) for s in shingles(text, 3)], dtype=np.uint64)
    return int(majority(hashes.reshape(-1, 1))[0])


def majority(hashes: np.ndarray) -> np.ndarray:
    """Per column of 64-bit hashes, the bits set in over half of the rows."""
    n, width = hashes.shape
    counts = np.zeros(64 * width, dtype=np.int64)
    for at in range(0, n, 4096):
        part = np.ascontiguousarray(hashes[at : at + 4096]).view(np.uint8).reshape(-1, 8 * width)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n, bitorder="little").view(np.int64)


def block_bits(blocks: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each block of a 64-bit fingerprint."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=8)
def references(blocks: int) -> np.ndarray:
    """REFERENCES fingerprints per block, from a fixed seed; bits of one block each."""
    draw = np.random.default_rng(SEED)
    return np.array(
        [
            [int(draw.integers(0, 1 << size)) << first for _ in range(REFERENCES)]
            for first, size in block_bits(blocks)
        ],
        dtype=np.uint64,
    )


def distances(fingerprints: np.ndarray, blocks: int) -> np.ndarray:
    """Table of distances: fingerprint x block x reference, within the block's bits."""
    masks = np.array([((1 << n) - 1) << a for a, n in block_bits(blocks)], dtype=np.uint64)
    own = fingerprints[:, None] & masks[None, :]
    return np.bitwise_count(own[:, :, None] ^ references(blocks)[None, :, :]).astype(np.uint8)


def bucket_keys(fingerprints: np.ndarray, blocks: int, equal: int) -> np.ndarray:
    """fingerprint x choice of blocks: a hash of the choice and its distances."""
    table = distances(fingerprints, blocks)
    packed = np.ascontiguousarray(table).view(np.uint64)[:, :, 0]  # eight distances of a byte each
    out = []
    for number, choice in enumerate(combinations(range(blocks), equal)):
        key = np.full(len(fingerprints), number + 1, dtype=np.uint64)
        for block in choice:
            key = (key ^ packed[:, block]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            key *= np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(32)
        out.append(key)
    return np.stack(out, axis=1)


def links(nodes: DataFrame, distance: int, equal: int, blocks: int | None = None) -> DataFrame:
    """Edges (a, b) of a spanning forest per bucket, over ``nodes`` (fp, more array<long>).

    ``more`` holds further words of wider fingerprints; bits of all words count, and
    every word gives keys of its own.
    """
    blocks = blocks or distance + equal

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in pieces(batch)):
            fp = piece.column("fp").to_numpy(zero_copy_only=False).reshape(-1, 1)
            more = piece.column("more").flatten().to_numpy(zero_copy_only=False).reshape(len(fp), -1)
            words = np.hstack([fp, more.astype(np.int64)]).view(np.uint64)
            keys = np.hstack(
                [bucket_keys(words[:, w], blocks, equal) + np.uint64(w) for w in range(words.shape[1])]
            )
            at = pa.array(np.repeat(np.arange(len(fp)), keys.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), piece.column("fp").take(at), piece.column("more").take(at)],
                names=["key", "fp", "more"],
            )

    dealt = nodes.select("fp", "more").mapInArrow(deal, "key long, fp long, more array<long>")
    crowds = store(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "crowds")
    chunk = F.pmod(F.xxhash64("fp", "more"), F.col("chunks"))
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (
        dealt.hint("merge").join(crowds, "key")
        .withColumn("chunks", F.ceil(F.col("n") / F.lit(CHUNK)))
        .withColumn("chunk", chunk)
        # the pairs of chunks (i <= j) that this chunk is part of
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select(
            "key",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            "chunk",
            F.struct("fp", "more").alias("node"),
        )
        # else the pairs of a key stay in one task; by number, as few bytes can be long work
        .repartition(tasks, "key", "i", "j")
        .groupBy("key", "i", "j")
        .agg(
            F.collect_list(F.when(F.col("chunk") == F.col("i"), F.col("node"))).alias("left"),
            F.collect_list(F.when(F.col("chunk") != F.col("i"), F.col("node"))).alias("right"),
        )
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                edges = forest(words_of(one.column("left")), words_of(one.column("right")), distance, blocks)
                if len(edges[0]):
                    yield pa.RecordBatch.from_arrays(
                        [as_lists(edges[0]), as_lists(edges[1])], names=["a", "b"]
                    )

    return met.mapInArrow(match, "a array<long>, b array<long>")


def words_of(column: pa.ListArray) -> np.ndarray:
    """fingerprints x words of the one list in ``column``."""
    nodes = column.flatten()
    if not len(nodes):
        return np.zeros((0, 1), dtype=np.uint64)
    first = nodes.field("fp").to_numpy(zero_copy_only=False).reshape(-1, 1)
    more = nodes.field("more").flatten().to_numpy(zero_copy_only=False).reshape(len(first), -1)
    return np.hstack([first, more.astype(np.int64)]).view(np.uint64)


def as_lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(rows.reshape(-1).view(np.int64))
    )


def forest(left: np.ndarray, right: np.ndarray, distance: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked among ``left`` and between it and ``right``."""
    if len(right):
        everyone, sides = np.vstack([left, right]), len(left)
    else:
        everyone, sides = left, len(left)
    n = len(everyone)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # distances to whole references, all blocks together
    table = distances(everyone[:, 0], blocks).sum(axis=1, dtype=np.int16)
    a, b = [], []
    for x in range(sides):
        others = np.arange(sides if len(right) else x + 1, n)
        others = others[np.abs(table[others] - table[x]).max(axis=1, initial=0) <= distance]
        differ = np.bitwise_count(everyone[others] ^ everyone[x]).sum(axis=1)
        for y in others[differ <= distance].tolist():
            p, q = root(x), root(y)
            if p != q:
                parent[q] = p
                a.append(x)
                b.append(y)
    return everyone[a], everyone[b]


def grouped(prints: DataFrame, distance: int, equal: int, blocks: int | None = None) -> DataFrame:
    """``prints`` (doc_id, fp, more, ...) stored, with component (its smallest fingerprint) and component_id.

    Copies are collapsed to their fingerprint first; links are sought among distinct
    fingerprints, each named by its smallest doc_id.
    """
    prints = store(prints, "fingerprints")
    nodes = store(prints.groupBy("fp", "more").agg(F.min("doc_id").alias("first")), "nodes")
    edges = links(nodes, distance, equal, blocks)
    found = components(edges.select("a", "b"))
    named = nodes.withColumn("node", F.concat(F.array("fp"), "more")).hint("merge").join(found, "node")
    named = store(named, "named")
    least = store(named.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    linked = store(
        named.hint("merge").join(least, "component").select("fp", "more", "component", "component_id"), "components"
    )
    alone = nodes.hint("merge").join(linked, ["fp", "more"], "left_anti").select(
        "fp", "more", F.concat(F.array("fp"), "more").alias("component"), F.col("first").alias("component_id")
    )
    return prints.hint("merge").join(store(linked.unionByName(alone), "groups"), ["fp", "more"])


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal digits and component_id; three bits or fewer link."""
    prints = map_texts(docs, ["doc_id"], lambda t: (fingerprint64(t),), "fp long").withColumn(
        "more", F.array().cast("array<long>")
    )
    return grouped(prints, distance=3, equal=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns c0, c1, ...: names may hold dots or clash with working columns."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group of near copies: the one with the smallest doc_id.

    Groups are those of ``near_copies``: components of links between fingerprints of
    three-word shingles that differ in three bits or fewer; texts without words share
    the fingerprint zero and so one group. A group is known by its smallest fingerprint,
    so repeated and null ids join nothing. A null doc_id comes after all others; of rows
    with the same id, the one whose text hash sorts first stays; of equal rows, one.
    Other columns stay as they are, whatever their names.
    """
    plain = numbered(docs)
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.xxhash64(text).cast("string"))
    keyed = plain.withColumn("key", key)
    prints = map_texts(
        keyed.select(doc_id.alias("doc_id"), "key", text.alias("text")), ["doc_id", "key"],
        lambda t: (fingerprint64(t),), "fp long",
    ).withColumn("more", F.array().cast("array<long>"))
    keepers = (
        grouped(prints, distance=3, equal=3)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
        .select("first.key")
    )
    kept = keyed.hint("merge").join(store(keepers, "keepers"), "key", "left_semi")
    first = Window.partitionBy("key").orderBy(F.xxhash64(*plain.columns))
    return (
        kept.withColumn("at", F.row_number().over(first)).where("at = 1").select(*plain.columns).toDF(*docs.columns)
    )
