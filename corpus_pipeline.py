"""Corpus pipeline: documents in, token ids of a clean, mixed corpus out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read back as the
next one's ``docs``. All but the last return the columns of documents; columns
beyond those pass through as they are, whatever their names. A null text is an
empty one; rows with equal id and text are one row after the second stage; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.llm import exact_dedup, mixing, quality_classifier, sentencepiece_codec, simhash
from epilake.llm.common import materialise, remainder, table
from epilake.llm.queries import new_index, vocabulary

#: SQL can't express the classifier, the fingerprints or the encoder; the
#: tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of at least 0.3)."""
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    model = quality_classifier.train(docs, labels)
    return docs.filter(quality_classifier.score(docs, model) >= quality_classifier.THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first by id of each group of equal texts."""
    return exact_dedup.deduplicated(docs, new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first by id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, whole or in part, as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document of the mix, checked by decoding."""
    return sentencepiece_codec.encode_checked(docs.select("doc_id", "source", "text"), vocabulary(spark))


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("simhash", near),
          ("mixing", mix), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
