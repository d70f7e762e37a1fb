"""Registered queries of the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablecraft.llm import (
    decontamination,
    language,
    multiset,
    near_copies,
    personal,
    quality,
    repeats,
    secrets,
    shards,
    tokens,
    toxicity,
    turns,
    whitening,
)
from tablecraft.llm.common import table

# A public vocabulary outside the repository; the variable names another file.
MODEL_KEY = "TABLECRAFT_PIECE_MODEL"
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def model_path() -> str:
    return os.environ.get(MODEL_KEY, MODEL_FILE)


@query("op3_language_filters")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents not held out."""
    return language.identify(table(spark, sf_dir, "documents"))


@query("op4_assignment_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the base patterns and literals of sensitive names."""
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


@query("op7_backtracking_pieces")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to."""
    return tokens.token_digests(table(spark, sf_dir, "documents"), model_path())


@query("op10_fm_index_passages")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a window of a benchmark item covers."""
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op1_label_propagation")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot, groups of equal texts kept together."""
    return shards.shard_documents(table(spark, sf_dir, "documents"))


@query("op2_ordinal_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_pivot_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy group of every document."""
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


@query("op6_positive_unlabelled")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from trusted positives and unlabelled text."""
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_block_anchors")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated runs of 35 words."""
    return repeats.deduplicate(table(spark, sf_dir, "documents"))


@query("op9_multiset_hash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset hash of every document and of its edited text."""
    return multiset.fingerprints(table(spark, sf_dir, "documents"))


@query("op11_personal_data")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: the base patterns and confirmed further kinds."""
    return personal.personal_spans(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the damage its ids decide."""
    return turns.repair_conversations(table(spark, sf_dir, "conversations"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding, fitted on each distinct vector once."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
