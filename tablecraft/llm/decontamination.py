"""Benchmark passages found by an FM-index over each shard of documents.

Words are lower-cased ASCII letters and digits and anything beyond ASCII. A window is
ten consecutive words of a benchmark item, or the whole item where it has fewer.

A task takes the documents of its partition in shards of bounded size. Words that no
item has can not be part of a window, so they separate the shard into runs, and runs
shorter than the shortest window are left out; what remains is exact. The runs of a
shard become one sequence of word numbers, its suffixes are sorted, the
Burrows-Wheeler transform goes into a wavelet matrix, and all windows are searched
backwards at once by ranks. Rows of the index found by a window are walked back to the
next sampled suffix position, and the spans of each document are merged.

Defined cases: a null or empty text has no words, is not contaminated and keeps its
text; items without words have no windows; repeated items and repeated documents are
treated one by one; with no items nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import pieces

WINDOW = 10
# Words of one shard, and characters of benchmark text searched in one pass.
SHARD_WORDS = 300_000
PASS_CHARS = 16_000_000
SAMPLE = 8

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Windows:
    """The windows of some items as word numbers; 0 is the separator."""

    vocabulary: dict[bytes, int]
    symbols: np.ndarray  # windows x width, padded at the left with -1
    lengths: np.ndarray
    items: list[list[str]]  # the items that have the window

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def windows_of(items: list[tuple], width: int = WINDOW) -> Windows:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple, dict[str, None]] = {}
    for item_id, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if numbers:
            size = min(width, len(numbers))
            for at in range(len(numbers) - size + 1):
                found.setdefault(tuple(numbers[at : at + size]), {})[str(item_id)] = None
    symbols = np.full((len(found), width), -1, dtype=np.int64)
    for row, key in enumerate(found):
        symbols[row, width - len(key) :] = key
    return Windows(
        vocabulary,
        symbols,
        np.array([len(k) for k in found], dtype=np.int64),
        [list(ids) for ids in found.values()],
    )


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, by doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = fresh
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """How often a symbol occurs before a position, in one look per bit."""

    def __init__(self, values: np.ndarray, top: int) -> None:
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            ones = (values >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(ones))).astype(np.int32))
            self.zeros.append(len(values) - int(ones.sum()))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Occurrences of symbols[i] before ends[i]."""
        first = np.zeros(len(symbols), dtype=np.int64)
        last = ends.astype(np.int64)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            is_one = ((symbols >> bit) & 1).astype(bool)
            a, b = ones[first], ones[last]
            first = np.where(is_one, zeros + a, first - a)
            last = np.where(is_one, zeros + b, last - b)
        return last - first


class FMIndex:
    """Backward search and location over one sequence that ends in a separator."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.tree = WaveletMatrix(self.bwt, top)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.n = len(text)
        # starts of runs are sampled too, so that no walk crosses a separator
        rows = np.flatnonzero((order % SAMPLE == 0) | (self.bwt == 0))
        self.sampled = np.full(self.n, -1, dtype=np.int64)
        self.sampled[rows] = order[rows]

    def step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.starts[symbols] + self.tree.rank(symbols, rows)

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first row, row after the last) of the windows that occur."""
        live = np.arange(len(windows.lengths))
        low = np.zeros(len(live), dtype=np.int64)
        high = np.full(len(live), self.n, dtype=np.int64)
        for column in reversed(range(windows.symbols.shape[1])):
            symbols = windows.symbols[live, column]
            at = np.flatnonzero(symbols >= 0)
            low[at] = self.step(symbols[at], low[at])
            high[at] = self.step(symbols[at], high[at])
            some = high > low
            live, low, high = live[some], low[some], high[some]
        return live, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row."""
        walked = np.zeros(len(rows), dtype=np.int64)
        rows = rows.copy()
        while (open_ := np.flatnonzero(self.sampled[rows] < 0)).size:
            rows[open_] = self.step(self.bwt[rows[open_]], rows[open_])
            walked[open_] += 1
        return self.sampled[rows] + walked


def shard_hits(shard: list[list[int]], windows: Windows) -> list[dict[int, list]]:
    """Per document of the shard: {window: starts, in words}.

    ``shard`` holds the word numbers of each document, 0 for words no item has.
    """
    hits: list[dict[int, list]] = [{} for _ in shard]
    least = windows.shortest
    if not least:
        return hits
    parts, origins, owners = [], [], []
    for doc, numbers in enumerate(shard):
        known = np.array([0, *numbers, 0], dtype=np.int64)
        edges = np.flatnonzero(np.diff((known > 0).astype(np.int8)))
        for a, b in edges.reshape(-1, 2):
            if b - a >= least:
                parts.append(known[a + 1 : b + 2])  # with the separator after the run
                parts[-1][-1] = 0
                origins.append(np.arange(a, b + 1))
                owners.append(np.full(b + 1 - a, doc))
    if not parts:
        return hits
    text, origin, owner = map(np.concatenate, (parts, origins, owners))
    index = FMIndex(text, len(windows.vocabulary))
    which, low, high = index.search(windows)
    if len(which):
        sizes = high - low
        rows = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = index.locate(rows)
        for window, doc, start in zip(
            np.repeat(which, sizes).tolist(), owner[at].tolist(), origin[at].tolist()
        ):
            hits[doc].setdefault(window, []).append(start)
    return hits


def merged(hits: dict[int, list], windows: Windows) -> list[tuple[int, int]]:
    """Word spans [start, end) of a document, overlapping and touching ones joined."""
    spans = sorted(
        (start, start + int(windows.lengths[w])) for w, starts in hits.items() for start in starts
    )
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def scan(texts: list[str | None], chunks: list[Windows]) -> Iterator[tuple[int, list, set]]:
    """(words, spans, items) for each text, shard by shard."""
    shard: list[list[bytes]] = []
    size = 0

    def flush() -> Iterator[tuple[int, list, set]]:
        spans: list[list] = [[] for _ in shard]
        items: list[set] = [set() for _ in shard]
        for windows in chunks:
            number = windows.vocabulary.get
            for doc, hits in enumerate(shard_hits([[number(w, 0) for w in ws] for ws in shard], windows)):
                spans[doc] += merged(hits, windows)
                items[doc].update(i for w in hits for i in windows.items[w])
        for ws, sp, it in zip(shard, spans, items):
            yield len(ws), joined(sp), it

    for text in texts:
        words = words_of(text)
        shard.append(words)
        size += len(words)
        if size >= SHARD_WORDS:
            yield from flush()
            shard, size = [], 0
    yield from flush()


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_chunks(benchmark: DataFrame, width: int = WINDOW) -> list[DataFrame]:
    """The items in parts of at most about ``PASS_CHARS`` characters each.

    A benchmark is small beside the corpus, but nothing bounds it: each part is sent to
    all tasks and costs a pass over the documents, so a large one costs passes, not
    memory.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // PASS_CHARS) or 1
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [items.where(key == p) for p in range(parts)]


FOUND = {"n": "long", "spans": "array<struct<start:int,end:int>>", "items": "array<string>"}


def find_passages(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, cut: bool = False) -> DataFrame:
    """Every row of ``docs`` with n_words, spans (array of [start, end) words) and items.

    With ``cut`` the rows of ``docs`` come back without the spans in their text. A part
    of the benchmark is one pass in one Python process; columns may have any names.
    """
    spark = docs.sparkSession
    names = docs.columns
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    out = docs.toDF(*[f"c{i}" for i in range(len(names))])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
    found = ", ".join(f"_llm_{name} {kind}" for name, kind in FOUND.items())
    parts = benchmark_chunks(benchmark, width)
    for number, part in enumerate(parts):
        shared = spark.sparkContext.broadcast(
            windows_of([tuple(r) for r in part.sort("item_id").toLocalIterator()], width)
        )
        cutting = cut and number == len(parts) - 1

        def run(batches, shared=shared, first=number == 0, cutting=cutting):
            for batch in batches:
                for piece in pieces(batch, 1024):
                    texts = piece.column(text).to_pylist()
                    rows = list(scan(texts, [shared.value]))
                    spans = [[{"start": a, "end": b} for a, b in r[1]] for r in rows]
                    items = [sorted(r[2]) for r in rows]
                    if not first:
                        spans = [a + b for a, b in zip(piece.column("_llm_spans").to_pylist(), spans)]
                        items = [sorted({*a, *b}) for a, b in zip(piece.column("_llm_items").to_pylist(), items)]
                    kept = list(piece.columns[: len(names)])
                    if cutting:
                        yield pa.RecordBatch.from_arrays(
                            without(kept, texts, spans, text, chars), names=piece.schema.names[: len(names)]
                        )
                    else:
                        found = [
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                            pa.array(items, pa.list_(pa.string())),
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [*kept, *found], names=[*piece.schema.names[: len(names)], *(f"_llm_{n}" for n in FOUND)]
                        )

        out = out.mapInArrow(run, fields if cutting else f"{fields}, {found}")
    return out.toDF(*names, *([] if cut else [f"_llm_{n}" for n in FOUND]))


def without(
    columns: list[pa.Array], texts: list[str | None], spans: list[list[dict]], text: int, chars: int | None
) -> list[pa.Array]:
    """``columns`` with the spans cut out of the text; n_chars follows where there are any."""
    new = [cut_words(t, [(s["start"], s["end"]) for s in sp]) if sp else t for t, sp in zip(texts, spans)]
    columns[text] = pa.array(new, pa.string())
    if chars is not None:
        sizes = columns[chars].to_pylist()
        columns[chars] = pa.array(
            [len(t) if sp else n for t, sp, n in zip(new, spans, sizes)], columns[chars].type
        )
    return columns


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, words hit, items met and their digest."""
    found = find_passages(docs.select("doc_id", "text"), benchmark)
    # spans of several passes may overlap: count each word once
    ordered = F.array_sort("_llm_spans")
    hit = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["to"]))).alias("n"),
            F.greatest(s["to"], x["end"]).alias("to"),
        ),
        lambda s: s["n"].cast("long"),
    )
    return found.select(
        "doc_id",
        F.col("_llm_n").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_llm_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_llm_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def remove_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with benchmark passages cut out of the text; n_chars follows.

    The cut reaches from the first character of a hit run to its last. Documents
    without a hit keep their text as it is, empty and null texts too.
    """
    return find_passages(docs, benchmark, cut=True)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    raw = text.encode()
    plain = np.frombuffer(raw.translate(_TABLE), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], plain.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, last in joined(spans):
        out.append(raw[at : starts[first]])
        at = int(ends[last - 1])
    out.append(raw[at:])
    return b"".join(out).decode()
