"""Rules every operator keeps, checked on the source and on plans."""

import re
from pathlib import Path

import pytest

from tablecraft.plans import ORACLES, QUERIES

PACKAGE = Path(__file__).resolve().parents[1] / "tablecraft"
# the text operators keep rules of their own
SOURCE = {p: p.read_text() for p in PACKAGE.rglob("*.py") if "llm" not in p.parts}


@pytest.mark.parametrize("word", ["crossJoin", "localCheckpoint", ".rdd", "toPandas", "udf(", "monotonically_increasing_id", "F.rand("])
def test_words_that_do_not_scale(word):
    assert [p.name for p, text in SOURCE.items() if word in text] == []


def test_only_bounded_rows_reach_the_driver():
    found = {p.name: len(re.findall(r"\.collect\(\)|\.take\(", text)) for p, text in SOURCE.items()}
    # a row per differing column of a stage, per column that may be a key, per file of a version,
    # per differing range of two stored frames
    assert {name: n for name, n in found.items() if n} == {
        "compare.py": 1, "tables.py": 2, "joins.py": 1, "determinism.py": 1, "profiles.py": 2, "versions.py": 3, "scd_stream.py": 1, "digests.py": 1,
    }


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["cross_score", "join_any_equi", "asof_join", "term_auto_map"])
def test_no_pair_scans(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
