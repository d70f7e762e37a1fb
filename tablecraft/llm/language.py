"""Language of a text by n-gram filters that answer for all languages at once.

One bit-sliced Bloom filter holds, at each position, a bitmask of languages. An n-gram
sets its languages' bits at three positions; the AND of the masks at those positions
gives every language that has the n-gram, and perhaps some that do not. The hits of each
language are counted over all n-grams of a text, and corrected by the language's rate of
false hits, (share of its bits that are set)^3. The highest corrected count decides.

Learned: per language, the n-grams met in the most documents of a sample, whose sizes
are parameters, so the filter's size does not depend on the corpus.

Defined cases: a null text or one without a letter is ``und`` with score 0; no n-gram
known in any language gives the most frequent language with score 0; equal counts go to
the more frequent language, then the smaller name; nothing to learn from makes all
``und``. Whole texts are counted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.common import map_texts, pieces

SAMPLE_DOCS = 6_000  # per language
GRAMS = 30_000  # kept per language
SIZE = 1 << 20  # positions of the filter
HASHES = 3
WIDTH = 1 << 30  # of the hash that the sample is cut from
SHARE = 0.002  # of a language's documents that must have the n-gram
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x3000)] + [True])


def grams(text: str | None) -> np.ndarray:
    """Hashes of all windows of three characters around a letter; other characters are spaces."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), dtype=np.uint32)
    letters = letter_table()[np.minimum(points, 0x3000)]
    s = np.where(letters, points, np.uint32(32)).astype(np.uint64)
    h = s[:-2] * np.uint64(0x9E3779B97F4A7C15)
    h += s[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += s[2:] * np.uint64(0x165667B19E3779F9)
    h = h[letters[1:-1]]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass
class Filter:
    languages: list[str]  # the most frequent first
    planes: list[np.ndarray]  # masks of up to 64 languages each
    rates: np.ndarray  # of false hits

    @classmethod
    def build(cls, languages: list[str], known: dict[str, np.ndarray]) -> Filter:
        planes, rates = [], []
        for first in range(0, len(languages), 64):
            group = languages[first : first + 64]
            kind = np.uint8 if len(group) <= 8 else np.uint64
            plane = np.zeros(SIZE, dtype=kind)
            for bit, name in enumerate(group):
                for at in positions(known.get(name, np.zeros(0, np.uint64))):
                    plane[at] |= kind(1 << bit)
            planes.append(plane)
            rates += [float(((plane >> kind(b)) & kind(1)).mean()) ** HASHES for b in range(len(group))]
        return cls(languages, planes, np.array(rates))

    def counts(self, found: np.ndarray) -> np.ndarray:
        """Hits of each language."""
        at = list(positions(found))
        out = []
        for first, plane in zip(range(0, len(self.languages), 64), self.planes):
            masks = plane[at[0]]
            for other in at[1:]:
                masks &= plane[other]
            n = min(64, len(self.languages) - first)
            if plane.dtype == np.uint8:
                tally = np.bincount(masks, minlength=256)
                out += [int(tally[(np.arange(256) >> b) & 1 == 1].sum()) for b in range(n)]
            else:
                out += [int(((masks >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(n)]
        return np.array(out, dtype=np.float64)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, share of the n-grams that the language knows)."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        found = grams(text)
        if not len(found):
            return self.languages[0], 0.0, 0.0
        shares = np.maximum((self.counts(found) / len(found) - self.rates) / (1 - self.rates), 0.0)
        best = int(np.argmax(shares))
        second = float(np.delete(shares, best).max()) if len(shares) > 1 else 0.0
        top = float(shares[best])
        return self.languages[best], top / (top + second) if top else 0.0, min(1.0, top)


def positions(found: np.ndarray):
    for k in range(HASHES):
        yield ((found >> np.uint64(20 * k)) & np.uint64(SIZE - 1)).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Filter:
    """The filter of a sample of about ``sample`` documents of each language, chosen by hash.

    Of a language with fewer documents, all are taken.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row per language
    cuts = [(name, min(WIDTH, -(-sample * WIDTH // n))) for name, n in sizes.items()]
    cut_of = docs.sparkSession.createDataFrame(cuts, "lang string, _llm_cut long")
    chosen = (
        rows.join(F.broadcast(cut_of), "lang")  # one row per language
        .where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(WIDTH)) < F.col("_llm_cut"))
        .select("lang", "text")
    )

    def count(batches):
        for batch in batches:
            tally: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                tally.setdefault(lang, []).append(np.unique(grams(text)))
            for lang, found in tally.items():
                values, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(values), pa.string()),
                    "gram": pa.array(values.view(np.int64)),
                    "n": pa.array(n.astype(np.int64)),
                })

    met = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    docs_of = chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        met.join(docs_of, "lang")
        .where((F.col("n") >= 2) | (F.col("docs") < 1000))
        .where(F.col("n") >= F.col("docs") * SHARE)
        .withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= GRAMS)
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"))
    )
    known = {r["lang"]: np.array(r["grams"], dtype=np.int64).view(np.uint64) for r in top.collect()}
    return Filter.build(sorted(sizes, key=lambda x: (-sizes[x], x)), known)


def predict(docs: DataFrame, model: Filter, columns: list[str]) -> DataFrame:
    """``columns`` of docs with lang_pred, score and known_share of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE positions, at most 8 bytes each
    return map_texts(
        docs, columns, None, "lang_pred string, score double, known_share double",
        start=lambda: shared.value.predict,
    )


def identify(docs: DataFrame) -> DataFrame:
    """Per document: held_out, lang_pred, score, known_share."""
    model = learn(docs)
    out = predict(docs.select("doc_id", "text"), model, ["doc_id"])
    return out.withColumn("held_out", held_out(F.col("doc_id")))


def keep_known(docs: DataFrame, model: Filter, least: float = 0.25) -> DataFrame:
    """Rows whose text is in a learned language: a letter, and enough of its n-grams known."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                found = [shared.value.predict(t) for t in piece.column("text").to_pylist()]
                yield piece.filter(pa.array([f[0] != UNKNOWN and f[2] >= least for f in found], pa.bool_()))

    return docs.mapInArrow(run, fields)
