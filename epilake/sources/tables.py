"""Keyed tables on plain Parquet: upsert, contract check, catalog entry."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.session import scratch_path
from epilake.sources import versions as vs


def upsert_by_key(target: DataFrame, incoming: DataFrame, key: str | Sequence[str],
                  seq_col: str | None = None) -> DataFrame:
    """Insert new keys, replace the non-key columns of existing ones.

    Result = latest incoming row per key  UNION  target rows whose key is
    not incoming. Inside one batch the row with the highest ``seq_col``
    wins (last write wins); without ``seq_col`` the batch must have unique
    keys. Both sides are shuffled on the key (or the batch is broadcast when
    the planner finds it small); no key is ever gathered in one place.
    Write the result to a *new* location: Spark cannot overwrite a path it
    is reading from.
    """
    keys = [key] if isinstance(key, str) else list(key)
    batch = incoming
    if seq_col is not None:
        # last write wins per key as an aggregate (max_by combines partially
        # on the map side), so a key repeated in a third of the batch still
        # reaches the reducer as one row per task, not as one window group
        rest = [c for c in incoming.columns if c not in keys and c != seq_col]
        batch = (incoming.groupBy(*keys)
                 .agg(F.max_by(F.struct(*rest), F.struct(F.col(seq_col).isNotNull(), F.col(seq_col)))
                      .alias("__last"))  # a null sequence is the earliest, not lost
                 .select(*keys, "__last.*"))
    kept = target.join(batch.select(*keys), on=keys, how="left_anti")
    return batch.select(*target.columns).unionByName(kept)


def publish_upsert(spark: SparkSession, current_path: str, incoming: DataFrame,
                   key: str | Sequence[str], new_path: str, seq_col: str | None = None) -> str:
    """Upsert into the Parquet table at ``current_path`` and publish the
    result as a new version at ``new_path``; returns ``new_path``."""
    merged = upsert_by_key(spark.read.parquet(current_path), incoming, key, seq_col)
    merged.write.mode("errorifexists").parquet(new_path)
    return new_path


def enforced(df: DataFrame, not_null: Sequence[str] = (), max_length: Mapping[str, int] | None = None,
             what: str = "table") -> DataFrame:
    """``df`` with assertions on its columns: the write that it ends in fails
    at the first null or overlong value, without a pass of its own. Columns
    that the plan drops are not looked at."""
    lengths = dict(max_length or {})
    checked = {}
    for c in df.columns:
        expr = None
        for broken, how in ((F.col(c).isNull() if c in not_null else None, f"{what}: null {c}"),
                            (F.length(c) > lengths[c] if c in lengths else None, f"{what}: {c} too long")):
            if broken is not None:
                stop = F.raise_error(F.lit(how)).cast(df.schema[c].dataType)
                expr = F.when(broken, stop) if expr is None else expr.when(broken, stop)
        if expr is not None:
            checked[c] = expr.otherwise(F.col(c))
    return df.withColumns(checked) if checked else df


def merge_by_key(target: DataFrame, incoming: DataFrame, key: str | Sequence[str], seq_col: str,
                 unique: bool = False, what: str = "table") -> DataFrame:
    """:func:`upsert_by_key` as one aggregate: the last row per key, incoming
    ones after the target's, with ``batch_rows`` (incoming rows of the key).
    ``unique`` asserts in the same aggregate that no key comes twice."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in target.columns if c not in keys]
    order = F.struct(F.col("__new"), F.col("__seq").isNotNull(), F.col("__seq"))
    kind = incoming.schema[seq_col].dataType
    rows = (incoming.select(*keys, *rest, F.lit(1).alias("__new"), F.col(seq_col).alias("__seq"))
            .unionByName(target.select(*keys, *rest, F.lit(0).alias("__new"), F.lit(None).cast(kind).alias("__seq"))))
    merged = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__last"), F.sum("__new").alias("batch_rows"))
    if unique:
        again = F.raise_error(F.lit(f"{what}: repeated key")).cast("long")
        merged = merged.withColumn("batch_rows", F.when(F.col("batch_rows") > 1, again).otherwise(F.col("batch_rows")))
    return merged.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest], "batch_rows")


#: Partition column of a bucketed table.
BUCKET = "bucket"


def upsert_buckets(spark: SparkSession, root: str, name: str, incoming: DataFrame, key: str | Sequence[str],
                   seq_col: str, buckets: int = 64, batch: str | None = None) -> vs.Commit:
    """Upsert into a table that is kept in buckets of its key: only buckets
    that hold a key of the batch are read and rewritten, sorted by key; the
    files of the others stay as they are. The change is one commit
    (:mod:`epilake.sources.versions`); read the table with :func:`read_buckets`.

    ``buckets`` is fixed by the first batch. The last row of a key by
    ``seq_col`` counts. Keys are hashed one row each, so no bucket is hot; the
    driver sees the numbers of the buckets touched, at most ``buckets``."""
    keys = [key] if isinstance(key, str) else list(key)
    base = vs.latest(spark, root)
    if batch is not None and batch in base.batches:
        return base
    known = base.tables.get(name)
    n = known.settings["buckets"] if known else buckets
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    path = scratch_path(spark, "upsert-batch")
    incoming.withColumn(BUCKET, bucket).write.parquet(path)
    rows = spark.read.parquet(path)
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    if not touched:
        return base
    if known:
        target = vs.read(spark, root, name, base).filter(F.col(BUCKET).isin(touched))
    else:
        target = rows.drop(seq_col).limit(0)
    merged = merge_by_key(target, rows, [BUCKET, *keys], seq_col).drop("batch_rows")
    merged = merged.select(*[c for c in target.columns if c != BUCKET], BUCKET)
    change = vs.Change(merged, [BUCKET], "parts", sort_within=keys, settings={"buckets": n})
    return vs.publish(spark, root, {name: change}, base, batch)


def read_buckets(spark: SparkSession, root: str, name: str, commit: vs.Commit | None = None) -> DataFrame:
    """A table kept by :func:`upsert_buckets`."""
    return vs.read(spark, root, name, commit).drop(BUCKET)


def check_table_contract(df: DataFrame, key: str, not_null: Sequence[str] = (),
                         max_length: Mapping[str, int] | None = None) -> DataFrame:
    """One-row report of contract violations.

    Columns: ``rows``, ``null_<c>`` per NOT NULL column, ``long_<c>`` per
    length-limited string column, ``duplicate_keys`` (distinct key values
    seen more than once). Two aggregation levels -- per key (partial on the
    map side), then over keys -- and no join.
    """
    max_length = dict(max_length or {})
    per_key = df.groupBy(F.col(key).alias("__k")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in not_null],
        *[F.count_if(F.length(F.col(c)) > n).alias(f"__long_{c}") for c, n in max_length.items()])
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
        *[F.coalesce(F.sum(f"__null_{c}"), F.lit(0)).cast("bigint").alias(f"null_{c}")
          for c in not_null],
        *[F.coalesce(F.sum(f"__long_{c}"), F.lit(0)).cast("bigint").alias(f"long_{c}")
          for c in max_length],
        F.count_if(F.col("__k").isNotNull() & (F.col("__n") > 1)).alias("duplicate_keys"))


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def register_lake_table(spark: SparkSession, name: str, path: str, partitioned: bool = True,
                        database: str | None = None) -> DataFrame:
    """Register a Parquet folder as a catalog table (schema from the files,
    partitions from ``key=value`` folders) and return it.

    Re-running points an existing external table at ``path`` and takes the
    schema and partitions found there. A managed table of that name is an
    error, as replacing it would delete its data.
    """
    for ident in (name, database or "default"):
        if not _IDENT.match(ident):
            raise ValueError(f"bad identifier: {ident!r}")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not an external table")
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:  # until partitions are registered the table reads 0 rows
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)
