"""A training corpus from raw documents: toxic and poor documents go, copies go, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm import cotraining, exact_dedup, packing, shingle_join
from lakebars.llm import toxicity as toxic
from lakebars.llm.common import table, written

_MARK = "_stage_"  # before the names of columns that a stage adds and takes away again


def _without_marks(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    rows = toxic.training_rows(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxic.score_toxicity(docs, toxic.fit_toxicity(rows), prefix=_MARK)
    return _without_marks(scored.filter(F.col(f"{_MARK}predicted") == 0), docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than not."""
    rows = cotraining.training_rows(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = cotraining.score_quality(docs, cotraining.fit_quality(rows), prefix=_MARK)
    return _without_marks(scored.filter(F.col(f"{_MARK}predicted") == 1), docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: five words, a similarity of 0.8."""
    return shingle_join.one_of_each_group(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("pack", pack),
]

# Fitted models and a tokenizer: beyond SQL. tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
