"""From raw documents to token ids: language, quality, near-duplicates, mixing, encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from worklode.llm import language, piece_bpe, quality_forest, simhash, source_mix
from worklode.llm.common import table
from worklode.llm.queries import PIECES
from worklode.session import shared_dir

#: Parts of the tokens of each domain to keep: all good ones, half of the poor ones, no toxic ones.
SHARES = {"good": 1.0, "poor": 0.5, "toxic": 0.0}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the table knows; the others are rejected."""
    return language.keep_identified(docs, language.fit(docs))


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no anomalies."""
    return quality_forest.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, size=5, budget=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their rates."""
    return source_mix.keep_mixed(docs, source_mix.label_domains(table(spark, sf_dir, "labels")), SHARES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    return piece_bpe.encode_documents(docs, PIECES).select("doc_id", "n_tokens", "ids", "exact")


STAGES = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each is written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
