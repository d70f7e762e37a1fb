"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are labelled 1; the rest of the web text is unlabelled, whatever its
label. With class prior p, loss l and scores g, the risk is
p E_pos[l(g)] + max(0, E_unl[l(-g)] - p E_pos[l(-g)]); the last part estimates the
negatives' risk, and where a step would make it negative, the step goes back instead.

The prior is estimated from the sample without any negative label: see ``prior_of``.

Features of a whole text: shares of character-class trigrams, and a few ratios. Defined
cases: null and empty texts have all features 0; without positives every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import map_texts, store
from tablecraft.llm.sampling import by_hash, remainder

POSITIVES = 6_000
UNLABELLED = 6_000
CLASSES = 12
RATIOS = 8
FEATURES = CLASSES**3 + RATIOS


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of a code point below 0x3000, and of all others in the last place."""
    out = np.full(0x3001, 11, dtype=np.int64)
    for c in range(0x3000):
        ch = chr(c)
        if ch.islower():
            out[c] = 0
        elif ch.isupper():
            out[c] = 1
        elif ch.isdigit():
            out[c] = 2
        elif ch == "\n":
            out[c] = 4
        elif ch.isspace():
            out[c] = 3
        elif ch in ".,":
            out[c] = 5
        elif ch in "!?":
            out[c] = 6
        elif ch in "|/\\":
            out[c] = 7
        elif ch in "#$%&*@^~+=<>_":
            out[c] = 8
        elif ch in "'\"()-:;[]{}":
            out[c] = 9
        elif ch.isalpha():
            out[c] = 10
    return out


def features(text: str | None) -> np.ndarray:
    out = np.zeros(FEATURES, dtype=np.float32)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kinds = classes()[np.minimum(points, 0x3000)]
    n = len(kinds)
    if n >= 3:
        at = kinds[:-2] * CLASSES**2 + kinds[1:-1] * CLASSES + kinds[2:]
        out[: CLASSES**3] = np.sqrt(np.bincount(at, minlength=CLASSES**3) / (n - 2))
    words = text.split()
    lines = text.split("\n")
    if words:
        out[CLASSES**3 :] = (
            np.log1p(len(words)) / 10,
            len(set(words)) / len(words),
            min(1.0, sum(map(len, words)) / len(words) / 20),
            len(set(lines)) / len(lines),
            min(1.0, len(words) / len(lines) / 100),
            float(np.mean(kinds == 1)),
            float(np.mean(kinds == 2)),
            float(np.mean(kinds >= 6)),
        )
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def descend(weights: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    """Adam steps; ``gradient`` is called with the weights."""
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        grad = gradient(weights)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def plain(pos: np.ndarray, unl: np.ndarray, steps: int = 200) -> np.ndarray:
    def gradient(w):
        a, b = sigmoid(pos @ w) - 1, sigmoid(unl @ w)
        return pos.T @ a / len(pos) + unl.T @ b / len(unl) + 1e-3 * w

    return descend(np.zeros(pos.shape[1]), gradient, steps, 0.03)


def prior_of(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives in unlabelled text, from how a plain classifier ranks both.

    Unlabelled text is a mixture, so above any score its share is at least the prior
    times the positives' share, and just that where no negatives are. The least ratio
    over scores that leave a fifth of the positives or more is the estimate. Both sides
    of the ratio are rows that the classifier was not fitted on.
    """
    w = plain(pos[::2], unl[::2])
    trusted, mixed = np.sort(pos[1::2] @ w), np.sort(unl[1::2] @ w)
    if not len(mixed):
        return 0.5
    cuts = np.quantile(trusted, np.linspace(0, 0.8, 81))
    kept = 1 - np.searchsorted(trusted, cuts) / len(trusted)
    above = 1 - np.searchsorted(mixed, cuts) / len(mixed)
    return float(np.clip((above / kept).min(), 0.05, 0.95))


def non_negative(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.02) -> np.ndarray:
    def gradient(w):
        gp, gu = sigmoid(pos @ w), sigmoid(unl @ w)
        # logistic loss; as a negative: softplus(g)
        as_negative_unl = np.mean(np.logaddexp(0, unl @ w))
        as_negative_pos = np.mean(np.logaddexp(0, pos @ w))
        rest = unl.T @ gu / len(unl) - prior * (pos.T @ gp) / len(pos)
        if as_negative_unl - prior * as_negative_pos < 0:
            return -rest
        return prior * (pos.T @ (gp - 1)) / len(pos) + rest + 1e-4 * w

    return descend(np.zeros(pos.shape[1]), gradient, steps, rate)


@dataclass
class Quality:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the intercept
    prior: float

    def predict(self, text: str | None) -> tuple[float]:
        if not len(self.weights):
            return (0.5,)
        x = (features(text) - self.mean) / self.scale
        return (float(sigmoid(np.array(x @ self.weights[:-1] + self.weights[-1]))),)


def fit(pos: np.ndarray, unl: np.ndarray) -> Quality:
    if len(pos) < 2 or not len(unl):
        return Quality(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(0), 0.5)
    mean, scale = unl.mean(axis=0), unl.std(axis=0) + 0.02
    pos = np.hstack([(pos - mean) / scale, np.ones((len(pos), 1))])
    unl = np.hstack([(unl - mean) / scale, np.ones((len(unl), 1))])
    prior = prior_of(pos, unl)
    return Quality(mean, scale, non_negative(pos, unl, prior), prior)


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Quality:
    """Fit on about ``positives`` trusted rows and ``unlabelled`` of all rows not held out."""
    free = docs.where("text is not null").select("doc_id", "text").where(remainder(F.col("doc_id"), 3) != 1)
    trusted = (
        labels.where("quality is not null")
        .groupBy(F.col("doc_id").alias("_llm_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .where(remainder(F.col("_llm_id"), 3) != 1)
    )
    chosen = by_hash(trusted, "_llm_id", positives, "positives").select("_llm_id")
    pos = vectors(free.join(chosen, F.col("doc_id") == F.col("_llm_id")))
    return fit(pos, vectors(by_hash(free, "doc_id", unlabelled, "unlabelled")))


def vectors(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample, in the order of the ids."""
    found = store(
        map_texts(rows, ["doc_id"], lambda t: (features(t).tobytes(),), "x binary"), "features"
    )
    data = [bytes(r["x"]) for r in found.sort("doc_id", "x").toLocalIterator()]
    return np.frombuffer(b"".join(data), dtype=np.float32).reshape(-1, FEATURES)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score, predicted."""
    model = learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # three vectors of FEATURES
    out = map_texts(docs, ["doc_id"], None, "score double", start=lambda: shared.value.predict)
    return out.select(
        "doc_id",
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
