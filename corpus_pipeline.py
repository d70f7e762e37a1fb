"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import decontamination, language, near_copies, queries, secrets, tokens
from tablecraft.llm.common import store, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names; text of none goes."""
    return language.keep_known(docs, language.learn(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: fingerprints at three bits or fewer."""
    return near_copies.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark items; a text of spaces or nothing goes."""
    clean = decontamination.remove_passages(docs, table(spark, sf_dir, "benchmark"))
    return clean.where(F.length(F.trim("text")) > 0)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced."""
    return secrets.redact_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text in ``token_ids``, their number, and the text that they decode to.

    A null text is an empty one and has the end id only.
    """
    return tokens.round_trip(docs, queries.model_path())


STAGES = [
    ("language", known_language),
    ("near copies", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", encoded),
]

# Learned filters, fingerprints, an index search, lexing and merges are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
