"""One query per operator over its whole table, and the DuckDB SQL of those
that SQL can express. Registered by the driver's entry module."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.session import shared_dir

from . import (chat_format, conversation_repair, exact_dedup, hard_negatives, language_id, license_scan, mixing,
               pii, quality_classifier, quality_rules, sentencepiece_codec, simhash, url_filter)
from .common import remainder, table

#: Vocabulary file of the tokenizer queries; change it with the session
#: setting ``spark.epilake.sentencepiece.model``.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def new_index(spark: SparkSession) -> str:
    """Folder of a digest index of its own for one call, among the shared folders."""
    return f"{shared_dir(spark)}/epilake/digest-index-{uuid.uuid4().hex[:12]}"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from rows not held out."""
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    filters = language_id.train(docs.filter(~held).select("text", "lang"))
    docs = docs.select("doc_id", "text")
    got = docs.select("doc_id", held.alias("held_out"), language_id.predict(docs, filters).alias("p"))
    return got.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of each document, through a new digest index."""
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"), new_index(spark))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def vocabulary(spark: SparkSession) -> sentencepiece_codec.Vocabulary:
    path = spark.conf.get("spark.epilake.sentencepiece.model", SENTENCEPIECE_MODEL)
    return sentencepiece_codec.read_vocabulary(spark, path)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each whole text and whether they decode to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode_checked(docs, vocabulary(spark))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document's sentences amount to."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"), "has_license")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes."""
    return mixing.words_taken(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of each document and whether it is kept."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, learned from labels not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    model = quality_classifier.train(docs, labels)
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
                         quality_classifier.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality_classifier.THRESHOLD).cast("int"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of each page's address."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", pii.find(docs, pii.train(docs)).alias("p")).select("doc_id", "p.*")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and loss mask of each conversation, read back from its formatted text."""
    forged = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", forged), (-7, 1, "assistant", forged)],
                                "conv_id long, turn long, role string, text string")
    rows = chat_format.rows_of(table(spark, sf_dir, "conversations")).unionAll(chat_format.rows_of(own))
    return chat_format.digests(chat_format.format_turns(rows))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each anchor and positive among all vectors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0).drop("positive_rank")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of each conversation after its rows are damaged."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_license_scan": op4_license_scan,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality": op8_quality,
    "op9_url_filter": op9_url_filter,
    "op10_pii": op10_pii,
    "op11_chat_format": op11_chat_format,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op4_license_scan": license_scan.oracle_sql(),
    "op5_mixing": mixing.oracle_sql(),
    "op9_url_filter": url_filter.oracle_sql(),
    "op11_chat_format": chat_format.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
