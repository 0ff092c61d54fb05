"""Preparation of a training corpus: each stage takes what the one before has kept.

Quality rules, exact dedup, near-dedup, mixing and encoding. The result of a stage is written as Parquet in the
folder of ``spark.checkpoint.dir`` and read again, so a lost executor costs the stage it runs in at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowmarts.llm import exact_dedup, line_quality, mixing, near_dup, sentence_pieces
from flowmarts.llm.common import read
from flowmarts.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are furniture of their source."""
    return line_quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return near_dup.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their draws, sources weighted by the square root of their size."""
    return mixing.mix(docs).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each document's text."""
    return sentence_pieces.encode(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("encoding", encoded)]

# Near-dedup and encoding have no SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of ``sf_dir``."""
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
