"""Exact removal of word sequences that occur more than once, by fixed-block anchors.

A window of 35 words has a whole block of 18 words that starts at a multiple of 18 in
its document. So if a window occurs at two places, every one of the two has, inside it,
18 consecutive words equal to such a reference block of the other. The index holds the
non-overlapping reference blocks of all documents, as two bit tables: blocks met, and
blocks met at least twice. Every rolling 18 words of a text are looked up; a hit is a
rolling run that equals a block elsewhere. Windows around hits, and no others, can be
repeated. Their hashes (96 bits over all 35 words) are counted exactly; what is counted
once is the end of a hit's maximal extension, and what remains are maximal repeats.

The tables are sized by the number of blocks up to ``MAX_BITS``, a fixed bound on what
each task receives. Beyond it they fill up: more windows are counted than need be, up to
all of them, and the result stays the same.

Counting combines before the shuffle, so a passage that a third of all documents share
sends one row per task. A window counted once carries its place back in the aggregate
itself; nothing is joined but each document with its own such places.

Defined cases: a null text has no words; documents of fewer than 35 words keep all;
repeated rows are copies of each other; whole texts are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import pieces, store

WINDOW = 35
BLOCK = 18  # a window holds a whole aligned block while 2 * BLOCK - 1 <= WINDOW
BITS_PER_BLOCK = 32
MAX_BITS = 30  # of the table of blocks met: 128 MB
SEGMENTS = 64
PROBES = 3
LONG_WORD = 4096  # bytes; longer words are hashed one by one

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_COEFFICIENTS = np.random.default_rng(35).integers(1, 1 << 63, LONG_WORD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    kept = raw[inside]
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    offsets = np.arange(len(kept)) - np.repeat(firsts, sizes)
    terms = (kept.astype(np.uint64) + np.uint64(1)) * _COEFFICIENTS[offsets % LONG_WORD]
    out = mixed(np.add.reduceat(terms, firsts) + sizes.astype(np.uint64))
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]].tobytes())
    return out


def rolling(words: np.ndarray, size: int, factor: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(factor)
        out += words[k : k + n]
    return mixed(out)


@dataclass
class Blocks:
    """Bit tables of the blocks met, and of those met twice or more."""

    met: np.ndarray
    repeated: np.ndarray

    @staticmethod
    def look(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        live = np.arange(len(hashes))
        for at in places(hashes, len(table) * 8):
            at = at[live]
            yes = (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            out[live[~yes]] = False
            live = live[yes]
        return out

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Starts of the windows that may be repeated."""
        if len(words) < WINDOW:
            return np.zeros(0, dtype=np.int64)
        found = rolling(words, BLOCK, _MULTIPLIERS[0])
        hits = self.look(self.met, found)
        # a reference block always meets itself; it is a hit where another one is equal
        own = np.arange(0, len(found), BLOCK)
        hits[own] = hits[own] & self.look(self.repeated, found[own])
        before = np.concatenate(([0], np.cumsum(hits)))
        n = len(words) - WINDOW + 1
        inside = WINDOW - BLOCK + 1
        return np.flatnonzero(before[inside : inside + n] > before[:n])


def places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - (bits.bit_length() - 1))
    for k in range(PROBES):
        # the first bits name the segment, so that each segment fills a part of the table
        low = (hashes * np.uint64(_MULTIPLIERS[k])) >> (shift + np.uint64(6))
        yield ((hashes >> np.uint64(58)) << np.uint64(bits.bit_length() - 7)) | low


def index_blocks(docs: DataFrame) -> Blocks:
    """The bit tables of all reference blocks, filled segment by segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                rolling(w, BLOCK, _MULTIPLIERS[0])[::BLOCK]
                for piece in pieces(batch)
                for w in map(word_hashes, piece.column("text").to_pylist())
            ]
            values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"]
            )

    met = store(
        docs.select("text").mapInArrow(cut, "h long, n long").groupBy("h").agg((F.sum("n") > 1).alias("again")),
        "blocks",
    )
    wanted = max(1, met.count()) * BITS_PER_BLOCK
    bits = min(MAX_BITS, max(16, wanted.bit_length()))
    sizes = {False: 1 << bits, True: 1 << max(16, bits - 2)}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[bool, int], np.ndarray] = {}
        for batch in batches:
            hashes = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            again = batch.column("again").to_numpy(zero_copy_only=False)
            for twice, some in ((False, hashes), (True, hashes[again])):
                part = sizes[twice] // SEGMENTS
                for at in places(some, sizes[twice]):
                    segments = (at // np.uint64(part)).astype(np.int64)
                    for s in np.unique(segments).tolist():
                        table = tables.setdefault((twice, s), np.zeros(part // 8, dtype=np.uint8))
                        own = at[segments == s] - np.uint64(s * part)
                        np.bitwise_or.at(
                            table, (own >> np.uint64(3)).astype(np.int64),
                            np.uint8(1) << (own & np.uint64(7)).astype(np.uint8),
                        )
        for (twice, s), table in tables.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([twice], pa.bool_()), pa.array([s], pa.int64()), pa.array([table.tobytes()], pa.binary())],
                names=["twice", "segment", "bits"],
            )

    segment = F.shiftrightunsigned("h", 58)
    filled = met.repartition(SEGMENTS, segment).mapInArrow(fill, "twice boolean, segment long, bits binary")
    tables = {k: np.zeros(v // 8, dtype=np.uint8) for k, v in sizes.items()}
    for row in filled.toLocalIterator():  # SEGMENTS rows a table, 160 MB in all at most
        part = sizes[row["twice"]] // SEGMENTS // 8
        tables[row["twice"]][row["segment"] * part : (row["segment"] + 1) * part] = np.frombuffer(row["bits"], np.uint8)
    return Blocks(tables[False], tables[True])


def repeats(docs: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Rows (doc_id, text, _llm_once: the candidate windows met once only), and the tables."""
    shared = docs.sparkSession.sparkContext.broadcast(index_blocks(docs))
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_llm_key"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 256):
                h, c, p, row = [], [], [], []
                for at, text in enumerate(piece.column("text").to_pylist()):
                    words = word_hashes(text)
                    starts = shared.value.candidates(words)
                    if len(starts):
                        h.append(rolling(words, WINDOW, _MULTIPLIERS[1])[starts])
                        c.append(rolling(words, WINDOW, _MULTIPLIERS[2])[starts] >> np.uint64(33))
                        p.append(starts)
                        row.append(np.full(len(starts), at))
                if h:
                    rows = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(h).view(np.int64)),
                            pa.array(np.concatenate(c).astype(np.int32)),
                            piece.column("doc_id").take(rows),
                            piece.column("_llm_key").take(rows),
                            pa.array(np.concatenate(p).astype(np.int32)),
                        ],
                        names=["h", "c", "doc_id", "key", "at"],
                    )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    once = (
        keyed.mapInArrow(windows, f"h long, c int, doc_id {id_type}, key long, at int")
        .groupBy("h", "c")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.min(x).alias(x) for x in ("doc_id", "key", "at")],
        )
        .where("n = 1")
        .groupBy("doc_id", "key")
        .agg(F.collect_list("at").alias("_llm_once"))  # no longer than the document
    )
    once = once.select(F.col("doc_id").alias("_llm_id"), F.col("key").alias("_llm_other"), "_llm_once")
    same = (F.col("_llm_key") == F.col("_llm_other")) & F.col("doc_id").eqNullSafe(F.col("_llm_id"))
    return keyed.join(once, same, "left").select("doc_id", "text", "_llm_once"), shared


def covered(text: str | None, once: list[int] | None, blocks: Blocks) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and which of them a repeated window covers."""
    hashes = word_hashes(text)
    starts = np.zeros(len(hashes) + 1, dtype=np.int64)
    found = blocks.candidates(hashes)
    starts[found] = 1
    starts[np.array(once or [], dtype=np.int64)] = 0
    total = np.concatenate((np.zeros(WINDOW, np.int64), np.cumsum(starts[: len(hashes)])))
    return (text or "").encode().split(), total[WINDOW:] > total[:-WINDOW]


def deduplicate(docs: DataFrame) -> DataFrame:
    """Per document: words, words removed, and the digest of the words kept."""
    rows, shared = repeats(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = []
                for text, once in zip(piece.column("text").to_pylist(), piece.column("_llm_once").to_pylist()):
                    words, gone = covered(text, once, shared.value)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                    found.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([f[0] for f in found], pa.int64()),
                        pa.array([f[1] for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")
