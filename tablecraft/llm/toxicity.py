"""Severity of toxic text by cumulative-link ordinal regression.

P(grade >= k) = sigmoid(w . x - t_k) with one weight vector for all grades and ordered
thresholds t_1 < t_2 < ..., kept ordered as a first value and positive steps. x are
sparse word features: log(1 + count) of words that separate grades in a sample. The
expected severity is the sum of P(grade >= k).

``labels`` flags a text as toxic or not. Grades come from it by rule: 0 for texts that
are not flagged, 1 to 3 for flagged ones by the thirds of their density (per 100 words)
of marker words, the words that set flagged texts apart in the sample. Flagged texts
without any marker word are grade 1.

Fitted on the driver on a sample of bounded size, chosen by hash; every whole text is
scored on the executors. Defined cases: a null or empty text has no words and the score
of the thresholds alone; without labels all scores are 0; labels of one id that
disagree count as toxic.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import map_texts
from tablecraft.llm.sampling import by_hash, remainder

SAMPLE_DOCS = 12_000
WORDS = 4_096  # features kept
MARKERS = 256  # of the words that differ most
GRADES = 3

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Severity:
    weights: dict[bytes, float]
    thresholds: list[float]

    def predict(self, text: str | None) -> tuple[float, float, int]:
        """(expected severity, probability of any grade above 0, most likely grade)."""
        if not self.thresholds:
            return 0.0, 0.0, 0
        total = 0.0
        counts: dict[bytes, int] = {}
        weights = self.weights
        for word in words_of(text):
            if word in weights:
                counts[word] = counts.get(word, 0) + 1
        for word, n in counts.items():
            total += weights[word] * float(np.log1p(n))
        above = [1.0 / (1.0 + float(np.exp(np.clip(t - total, -50, 50)))) for t in self.thresholds]
        shares = np.append(1.0, above) - np.append(above, 0.0)
        return float(sum(above)), above[0], int(np.argmax(shares))


def standout(texts: list[Counter], flags: np.ndarray) -> list[tuple[float, bytes]]:
    """(z, word) by how the share of flagged and other texts with the word differs."""
    with_, without = Counter(), Counter()
    for words, flag in zip(texts, flags):
        (with_ if flag else without).update(words.keys())
    a, b = max(1, int(flags.sum())), max(1, int((~flags).sum()))
    out = []
    for word in with_.keys() | without.keys():
        p, q = with_[word] / a, without[word] / b
        pooled = (with_[word] + without[word] + 0.5) / (a + b + 1)
        if with_[word] + without[word] >= 3:
            out.append(((p - q) / np.sqrt(pooled * (1 - pooled) * (1 / a + 1 / b)), word))
    return sorted(out, key=lambda x: (-abs(x[0]), x[1]))


def grades_of(texts: list[Counter], flags: np.ndarray, markers: set[bytes]) -> np.ndarray:
    density = np.array(
        [100 * sum(c[w] for w in markers if w in c) / max(1, sum(c.values())) for c in texts]
    )
    out = np.zeros(len(texts), dtype=np.int64)
    if flags.any():
        cuts = np.quantile(density[flags], [i / GRADES for i in range(1, GRADES)])
        out[flags] = 1 + np.searchsorted(cuts, density[flags], side="right")
        out[flags & (density == 0)] = 1
    return out


def fit(texts: list[Counter], flags: np.ndarray, steps: int = 300, rate: float = 0.05) -> Severity:
    if not len(texts) or not flags.any():
        return Severity({}, [])
    ranked = standout(texts, flags)
    markers = {w for z, w in ranked[:MARKERS] if z > 6}
    grades = grades_of(texts, flags, markers)
    top = int(grades.max())
    vocabulary = {w: i for i, (z, w) in enumerate(ranked[:WORDS]) if abs(z) > 3}
    rows, columns, values = [], [], []
    for i, counts in enumerate(texts):
        for word, n in counts.items():
            j = vocabulary.get(word)
            if j is not None:
                rows.append(i)
                columns.append(j)
                values.append(np.log1p(n))
    rows, columns = np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64)
    values, size, n = np.array(values), len(vocabulary), len(texts)
    weights = np.zeros(size)
    # thresholds: the first, then logarithms of the steps between them
    raw = np.zeros(top)
    raw[0] = 2.0
    moments = [np.zeros(size), np.zeros(size), np.zeros(top), np.zeros(top)]
    for step in range(1, steps + 1):
        thresholds = np.cumsum(np.append(raw[0], np.exp(raw[1:])))
        linear = np.bincount(rows, weights=values * weights[columns], minlength=n)
        chance = 1 / (1 + np.exp(-np.clip(linear[:, None] - thresholds, -50, 50)))
        # likelihood of the grade: difference of neighbouring chances
        upper = np.hstack([np.ones((n, 1)), chance])
        lower = np.hstack([chance, np.zeros((n, 1))])
        at = np.arange(n)
        likely = np.maximum(upper[at, grades] - lower[at, grades], 1e-9)
        slope = chance * (1 - chance)
        padded = np.hstack([np.zeros((n, 1)), slope, np.zeros((n, 1))])
        from_upper, from_lower = padded[at, grades] / likely, padded[at, grades + 1] / likely
        by_linear = -(from_upper - from_lower)
        by_threshold = np.zeros((n, top + 2))
        by_threshold[at, grades] += from_upper
        by_threshold[at, grades + 1] -= from_lower
        by_threshold = by_threshold[:, 1 : top + 1].sum(axis=0) / n
        grad_w = np.bincount(columns, weights=values * by_linear[rows], minlength=size) / n + 1e-3 * weights
        tail = np.cumsum(by_threshold[::-1])[::-1]
        grad_t = np.append(tail[0], tail[1:] * np.exp(raw[1:]))
        for grad, value, first, second in ((grad_w, weights, 0, 1), (grad_t, raw, 2, 3)):
            moments[first] = 0.9 * moments[first] + 0.1 * grad
            moments[second] = 0.999 * moments[second] + 0.001 * grad**2
            value -= rate * (moments[first] / (1 - 0.9**step)) / (
                np.sqrt(moments[second] / (1 - 0.999**step)) + 1e-8
            )
    thresholds = np.cumsum(np.append(raw[0], np.exp(raw[1:])))
    return Severity({w: float(weights[i]) for w, i in vocabulary.items()}, [float(t) for t in thresholds])


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> Severity:
    """Fit on about ``most`` labelled rows that are not held out."""
    flags = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("_llm_id")).agg(
        F.max("toxic").alias("_llm_flag")
    )
    chosen = by_hash(flags.where(remainder(F.col("_llm_id"), 4) != 2), "_llm_id", most, "toxicity")
    texts = docs.where("text is not null").select("doc_id", "text")
    rows = texts.join(chosen, F.col("doc_id") == F.col("_llm_id"))
    counted, marks = [], []
    for row in rows.select("doc_id", "text", "_llm_flag").sort("doc_id").toLocalIterator():
        counted.append(Counter(words_of(row["text"])))
        marks.append(row["_llm_flag"] > 0)
    return fit(counted, np.array(marks, dtype=bool))


def severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: severity, score (chance of a grade above 0), grade, toxic."""
    model = learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WORDS weights
    out = map_texts(
        docs, ["doc_id"], None, "severity double, score double, grade int",
        start=lambda: shared.value.predict,
    )
    return out.withColumn("toxic", F.col("score") >= 0.5).withColumn(
        "held_out", remainder(F.col("doc_id"), 4) == 2
    )
