"""Relational tables over JDBC: parallel export and load.

A whole-table read is split into ``num_partitions`` range queries on a
numeric ``partition_column`` so no single task reads the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_scan(spark: SparkSession, url: str, table: str, partition_column: str | None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int = 8, properties: Mapping[str, str] | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Read a table in parallel ranges of ``partition_column``. Only an
    explicit None reads it in one task (a small dimension)."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partitioned JDBC read needs lower_bound and upper_bound")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: Mapping[str, str] | None = None, batch_size: int = 10_000) -> None:
    """Write ``df`` to a table (one connection per task, batched inserts)."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
