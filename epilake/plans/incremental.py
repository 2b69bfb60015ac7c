"""Region indicators kept up to date by batches of events.

The indicators and a carry table (cases by code and year) are published
together, both by year. A batch, late days included, is counted by day; only
years from the earliest one that it touches are read, added to and rewritten.
What a code has before them comes from the carry table, so no earlier day is
read and no earlier file is touched. The result equals a full run over all
events (with the dimension columns each event came with).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.operators import indicators as ind
from epilake.session import scratch_path
from epilake.sources import versions as vs

INDICATORS, CARRY = "region_indicators", "carry"
KEYS = ("date", "year", "month", "day", "code", "name", "population")


def _changes(spark: SparkSession, daily: DataFrame, before: DataFrame | None) -> dict[str, vs.Change]:
    """Both tables' rows for all years in ``daily``; ``before`` has cases by
    code in the years before them."""
    rows = ind.running_total(daily)
    if before is not None:
        held = before.groupBy(F.col("code").alias("__code")).agg(F.sum("cases").alias("__before"))
        rows = rows.join(held, F.col("code").eqNullSafe(F.col("__code")), "left").withColumn(
            "cumulative_cases", F.col("cumulative_cases") + F.coalesce("__before", F.lit(0)))
    rows = ind.rate_per_n(rows).select(*ind.INDICATOR_COLUMNS)
    carry = daily.groupBy("code", "year").agg(F.sum("new_cases").alias("cases"))
    return {INDICATORS: vs.Change(rows, ["year"], "parts", sort_within=("date",)),
            CARRY: vs.Change(carry, ["year"], "parts")}


def add_events(spark: SparkSession, root: str, trusted: DataFrame, batch: str | None = None) -> vs.Commit:
    """Take a batch of trusted events into the tables at ``root`` (the first
    one builds them) in one commit. A batch name that was taken in before
    changes nothing, so a retried batch isn't counted twice."""
    base = vs.latest(spark, root)
    if batch is not None and batch in base.batches:
        return base
    path = scratch_path(spark, "batch-days")
    ind.daily_counts(ind.region_keys(trusted)).write.parquet(path)
    changes = spark.read.parquet(path)
    if INDICATORS not in base.tables:
        return vs.publish(spark, root, _changes(spark, changes, None), base, batch)
    # rows without a date come first in every running total
    rows, dated, first = changes.agg(F.count(F.lit(1)), F.count("year"), F.min("year")).first()
    if not rows:
        return base
    published, carry = vs.read(spark, root, INDICATORS, base), vs.read(spark, root, CARRY, base)
    before = None
    if rows == dated:
        before = carry.filter(F.col("year").isNull() | (F.col("year") < first))
        published = published.filter(F.col("year") >= first)
    path = scratch_path(spark, "changed-days")
    (published.select(*KEYS, "new_cases").unionByName(changes).groupBy(*KEYS)
     .agg(F.sum("new_cases").alias("new_cases")).write.parquet(path))
    return vs.publish(spark, root, _changes(spark, spark.read.parquet(path), before), base, batch)


def indicators(spark: SparkSession, root: str, commit: vs.Commit | None = None) -> DataFrame:
    """The published indicators."""
    return vs.read(spark, root, INDICATORS, commit)
