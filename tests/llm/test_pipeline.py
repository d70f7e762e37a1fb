"""The pipeline: every stage on odd rows, and the whole against its parts."""

import re

import pytest
from conftest import texts_of

import corpus_pipeline
from tablecraft.llm import decontamination, near_copies, secrets


@pytest.fixture(scope="module")
def result(spark, data):
    return {r["doc_id"]: r for r in corpus_pipeline.run(spark, data).collect()}


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near copies", "decontamination", "secrets", "tokens"
    ]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_columns_on_odd_rows(spark, odd, none, data, stage):
    out = stage(spark, odd, data)
    assert out.columns == odd.columns and 0 < out.count() <= odd.count()
    assert stage(spark, none, data).count() == 0


def test_last_stage_on_odd_rows(spark, odd, data):
    out = corpus_pipeline.encoded(spark, odd, data)
    assert out.count() == odd.count() and {"token_ids", "n_tokens", "text"} <= set(out.columns)
    assert {r["n_tokens"] for r in out.where("text = ''").collect()} == {1}
    clashing = odd.selectExpr("*", "1 AS n_tokens", "2 AS token_ids", "3 AS `a.b`", "4 AS ids", "5 AS c0")
    again = corpus_pipeline.encoded(spark, clashing, data)
    assert set(again.columns) == set(clashing.columns) and again.count() == odd.count()
    assert corpus_pipeline.encoded(spark, odd.where("doc_id > 1000"), data).count() == 0


def test_what_is_left_is_clean(spark, data, documents, result):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    windows = decontamination.windows_of(benchmark)
    texts = [r["text"] for r in result.values()]
    assert not any(n for found in decontamination.scan(texts, [windows]) for n in found[1])
    assert not any(s[0] == "assign" and not t[s[3] : s[2]].startswith("[secret") for t in texts for s in secrets.spans_of(t))
    assert len(texts) == len(set(texts))
    assert 0.8 * documents.count() < len(result) < documents.count()


def test_only_copies_go_and_texts_change_only_by_cuts(spark, documents, result):
    texts = texts_of(documents)
    kept = {k: set(re.findall(r"\w+", t)) for k, t in texts.items()}
    for key, row in result.items():
        assert set(re.findall(r"\w+", row["text"])) - {"secret"} <= kept[key] | set(re.findall(r"\w+", row["text"])) & {"secret"} or "[secret]" in row["text"]
    prints = {k: near_copies.fingerprint64(t) & (1 << 64) - 1 for k, t in texts.items()}
    for key in set(texts) - set(result):
        assert any((prints[key] ^ prints[k]).bit_count() <= 3 for k in texts if k != key), key
