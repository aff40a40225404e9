"""A training corpus from raw documents: quality, toxicity, near duplicates,
personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before
it kept, and returns the columns of documents; the last returns the packed
pieces.  Empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillmill.llm.durable import durable
from quillmill.llm.jaccard import keep_one_of_each_class
from quillmill.llm.packing import pack_documents
from quillmill.llm.privacy import sanitise
from quillmill.llm.quality import fit_quality, keep_good
from quillmill.llm.toxicity import fit_toxicity, keep_clean

TOKENIZER = "word_bpe_49k.json"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 7)."""
    return keep_good(docs, fit_quality(docs, _labels(spark, sf_dir), folds=4, held_out=2), threshold=0.7)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go (operator 5)."""
    return keep_clean(docs, fit_toxicity(docs, _labels(spark, sf_dir), folds=5, held_out=0), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that with the smallest id (operator 2)."""
    return keep_one_of_each_class(docs, n=5, percent=75)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it are replaced (operator 6)."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens (operator 1)."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), capacity=2048, end_id=1)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near duplicates", near_duplicates), ("personal data", personal_data), ("packing", packing)]

#: The classifiers are learned and the packing is a search: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
