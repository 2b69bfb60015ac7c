"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by the text's SHA-256, with
one row per distinct text: the digest and the id that stays. New data are
reduced to one row per digest, compared with the index by a sort-merge
anti-join (the index side is not shuffled) and what is new is appended. An
append is one Spark write, so a failed one leaves the index as it was, and
a repeated one adds nothing.

DataFrame operations only. A group of copies, however large, is combined on
the map side before its digest is shuffled; the text itself is never
shuffled here. Null text counts as empty, a null id sorts after all others,
and of rows with equal id and text one is kept. A text of any length is one
digest. An empty table leaves the index as it is and gives no rows. Other
columns pass through ``deduplicated`` as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, keep_rows, mark, materialise


#: Copies of one row that are written out together.
COPIES = 4096


def normalised(text: Column) -> Column:
    """The text with each run of white space replaced by one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """Digest index in folder ``path``; the folder outlives the session.

    ``buckets`` belongs to the stored files: reopen an index with the number
    it was created with. Ids are longs.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append_new(self, batch: DataFrame) -> None:
        """Add the digests of ``batch`` (digest, keep_id; a row per digest)
        that the index doesn't hold."""
        fresh = batch.select("digest", "keep_id").join(
            self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))


def dedup(docs: DataFrame, index_path: str, id_col: str = "doc_id", text_col: str = "text",
          batches: int = 2, buckets: int | None = None) -> DataFrame:
    """A row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    The documents go into the index at ``index_path`` in ``batches`` by
    ascending id, older ids first, so the id that stays is the smallest
    (unless an earlier call stored the text). ``group_size`` counts the rows
    of ``docs`` with the text. ``buckets`` (default: the session's shuffle
    partitions) is fixed when the index is created.
    """
    spark = docs.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows with equal id and text become one with a count
    seen = materialise(
        docs.select(F.col(id_col).cast("long").alias("id"), digest(F.col(text_col)).alias("digest"))
        .groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")), "digests")
    index = DigestIndex(spark, index_path, buckets)
    cuts = seen.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)] or [0.5])
                    ).first()[0] or []
    low = None
    for high in [*dict.fromkeys(cuts[:batches - 1]), None]:
        part = seen
        if low is not None:
            part = part.filter((F.col("id") > low) if high is not None
                               else (F.col("id") > low) | F.col("id").isNull())
        if high is not None:
            part = part.filter(F.col("id") <= high)
        # written, else the optimizer moves the anti-join below this aggregate
        # and every copy is shuffled instead of one row per digest
        index.append_new(materialise(part.groupBy("digest").agg(F.min("id").alias("keep_id")), "digest-batch"))
        low = high
    # written, so that both sides of the next join are dealt by exchanges: only
    # the id's side repeats a digest, and Spark splits such a partition
    groups = materialise(seen.groupBy("digest").agg(F.sum("n").alias("group_size"))
                         .join(index.rows().hint("merge"), "digest"), "digest-groups")
    pieces = seen.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES).cast("long"))))
    met = pieces.join(groups, "digest")
    # a row with very many copies is written out by many tasks
    met = met.filter("piece = 0").unionByName(met.filter("piece > 0").repartition("digest", "id", "piece"))
    joined = met.select(
        "id", "digest", "keep_id", "group_size",
        F.explode(F.sequence(F.col("piece") * COPIES + 1,
                             F.least(F.col("n"), (F.col("piece") + 1) * COPIES))).alias("copy"))
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest")


def deduplicated(docs: DataFrame, index_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    kept = dedup(docs, index_path, id_col, text_col).filter("kept")
    return keep_rows(docs, [mark(F.col(id_col).cast("long")), digest(F.col(text_col))],
                     kept.select(mark(F.col(id_col)), "digest"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
