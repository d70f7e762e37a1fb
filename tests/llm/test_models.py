"""Learned scores: toxicity and quality, and the rules for all operators."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import tablecraft.llm
from tablecraft.llm import quality, toxicity
from tablecraft.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(np.argsort(np.array(scores)))
    labels = np.array(labels, dtype=bool)
    n = labels.sum()
    return (order[labels].sum() - n * (n - 1) / 2) / (n * (~labels).sum())


def labelled(spark, name):
    rows = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    return {r["doc_id"]: r[name] for r in rows}


def test_quality_on_rows_held_out(spark):
    rows = QUERIES["op6_positive_unlabelled"](spark, DATA).collect()
    true = labelled(spark, "quality")
    held = [r for r in rows if r["held_out"] and r["doc_id"] in true]
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert auc([r["score"] for r in held], [true[r["doc_id"]] for r in held]) > 0.95
    assert np.mean([r["predicted"] == true[r["doc_id"]] for r in held]) > 0.95


def test_toxicity_on_rows_held_out(spark):
    rows = QUERIES["op2_ordinal_toxicity"](spark, DATA).collect()
    true = labelled(spark, "toxic")
    held = [r for r in rows if r["held_out"] and r["doc_id"] in true]
    assert len(rows) == 1000 and all(0 <= r["severity"] <= 3 and 0 <= r["score"] <= 1 for r in rows)
    assert not any(r["toxic"] for r in held if not true[r["doc_id"]])
    assert auc([r["severity"] for r in held], [true[r["doc_id"]] for r in held]) > 0.8


def test_severity_follows_the_grades():
    draw = np.random.default_rng(1)
    texts, flags = [], []
    for i in range(600):
        words = [f"w{j}" for j in draw.integers(0, 200, 60)]
        bad = (0, 1, 3, 8)[i % 4]
        texts.append(Counter(w.encode() for w in words + ["vile"] * bad))
        flags.append(bad > 0)
    model = toxicity.fit(texts, np.array(flags))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 3
    severities = [model.predict("plain words " * 20 + "vile " * n)[0] for n in (0, 1, 3, 8)]
    assert severities == sorted(severities) and severities[0] < 0.5 and severities[3] > 2


def test_likelihood_gradient_reaches_the_thresholds():
    texts = [Counter({b"x": 1})] * 90 + [Counter({b"y": 1})] * 10
    model = toxicity.fit(texts, np.array([False] * 90 + [True] * 10))
    assert model.predict("x")[1] < 0.5 < model.predict("y")[1]


def test_prior_and_non_negative_risk():
    draw = np.random.default_rng(0)
    ones = np.ones((2000, 1))
    pos = np.hstack([draw.normal(2, 1, (2000, 1)), ones])
    unl = np.hstack([np.concatenate([draw.normal(2, 1, (1400, 1)), draw.normal(-2, 1, (600, 1))]), ones])
    prior = quality.prior_of(pos, unl)
    assert abs(prior - 0.7) < 0.12
    w = quality.non_negative(pos, unl, prior)
    assert (quality.sigmoid(np.array([[2.0, 1], [-2.0, 1]]) @ w) > 0.5).tolist() == [True, False]


@pytest.mark.parametrize("operator", [quality.scores, toxicity.severity])
def test_odd_rows_and_empty_tables(operator, odd, none, labels):
    clash = odd.withColumnRenamed("lang", "score").withColumnRenamed("source", "quality")
    assert operator(clash, labels).count() == odd.count()
    assert operator(none, labels).count() == 0
    rows = operator(odd, labels.limit(0)).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows}) == 1


def test_features_of_odd_texts():
    assert not quality.features(None).any() and not quality.features("").any()
    assert quality.features("a").any() and np.isfinite(quality.features("\n\t")).all()
    assert quality.features("漢字 é 😀" * 9).max() <= 1


# --- rules

PACKAGE = Path(tablecraft.llm.__file__).parent
SOURCE = {p.name: p.read_text() for p in PACKAGE.glob("*.py")}


@pytest.mark.parametrize("word", ["crossJoin", "localCheckpoint", ".rdd", "toPandas", "mkdtemp", "except ImportError"])
def test_words_that_do_not_scale(word):
    assert [name for name, text in SOURCE.items() if word in text] == []


def test_nothing_else_imports_this_part():
    outside = [p for p in PACKAGE.parent.rglob("*.py") if PACKAGE not in p.parents]
    assert [p for p in outside if re.search(r"tablecraft\.llm|from \.+llm", p.read_text())] == []


def test_severity_does_not_depend_on_the_spelling_of_markers():
    """70 markers early in the alphabet and 70 late ones, in texts alike otherwise."""
    texts, flags = [], []
    for i in range(600):
        own = [f"{'az'[i % 2]}{chr(97 + w // 26)}{chr(97 + w % 26)}x" for w in range(70)]
        text = own[: (30, 50, 70)[i // 2 % 3]] * (1 + i // 2 % 3) + ["filler"] * 60
        texts.append(Counter(toxicity.words_of(" ".join(text))))
        flags.append(True)
        texts += [Counter([b"filler"] * 60 + [b"other"]) for _ in range(2)]
        flags += [False] * 2
    model = toxicity.fit(texts, np.array(flags))
    for letter in "az":
        words = [f"{letter}{chr(97 + w // 26)}{chr(97 + w % 26)}x" for w in range(70)]
        assert model.predict(" ".join(words * 3 + ["filler"] * 60))[2] == 3
        assert model.predict(" ".join(words[:30] + ["filler"] * 60))[2] == 1
