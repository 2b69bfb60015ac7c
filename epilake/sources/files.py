"""File sources and sinks.

Writers return nothing; the ``*_roundtrip`` style helpers used by the
query registry write and then read back, so a result can be compared with
its source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from epilake.session import scratch_path

#: Folder layout of event-level tables: one folder per day.
PARTITION_COLUMNS = ("year", "month", "day")

#: Folder layout of aggregated tables (at most one row per date x group, at
#: any data size): one folder per year, rows sorted by date inside, so a
#: month/day predicate skips row groups by their min/max statistics
#: instead of opening one tiny file per day.
AGGREGATE_PARTITION_COLUMNS = ("year",)


def scan_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True,
             rejects_col: str | None = None) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass).

    Malformed lines are kept (PERMISSIVE) with nulls; pass ``rejects_col``
    to keep the raw text of such lines in that column for counting.
    """
    if rejects_col:
        schema = StructType(list(schema.fields) + [StructField(rejects_col, StringType(), True)])
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    if rejects_col:
        reader = reader.option("columnNameOfCorruptRecord", rejects_col)
    return reader.csv(path)


def scan_partitioned_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table with ``key=value`` directories; partition columns come
    back typed (ints for year/month/day) and filters on them prune."""
    return spark.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = PARTITION_COLUMNS,
                      distribution: str = "rebalance", num_partitions: int | None = None,
                      dynamic: bool = False, max_records_per_file: int = 5_000_000,
                      sort_within: Sequence[str] = ()) -> None:
    """Publish ``df`` as Parquet partitioned by ``partition_cols``.

    ``distribution`` says how rows reach the writers:

    - ``"rebalance"`` (what the pipeline uses for every table and size): the
      REBALANCE hint shuffles on the partition columns and AQE splits an
      oversized value over several tasks and merges small ones, so files
      stay near the advisory size;
    - ``"hash"``: ``repartition(n, *cols)`` with ``n`` = the session's
      shuffle partitions; one writer per value, which AQE can't split;
    - ``"none"``: keep the current partitioning.

    Overwrite is static by default -- partitions absent from ``df``
    disappear; with ``dynamic=True`` only partitions present in ``df`` are
    replaced. ``sort_within`` orders rows inside each file (after the
    partition columns) for tight row-group statistics.
    """
    if distribution == "rebalance":
        out = df.hint("rebalance", *partition_cols)
    elif distribution == "hash":
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartition(n, *partition_cols)
    elif distribution == "none":
        out = df
    else:
        raise ValueError(f"unknown distribution {distribution!r}")
    if sort_within:
        out = out.sortWithinPartitions(*partition_cols, *sort_within)
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partition_cols).parquet(path))


def publish_result(df: DataFrame, path: str) -> None:
    """Unpartitioned Parquet result table, full overwrite."""
    df.write.mode("overwrite").parquet(path)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write only if nothing exists at ``path`` (a second call is a no-op)."""
    df.write.mode("ignore").format(fmt).save(path)


EXPORT_FORMATS = ("csv", "parquet")


def export_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Export as CSV (with header) or Parquet; any value but exactly
    ``parquet`` means CSV. Returns the format used."""
    fmt = fmt if fmt in EXPORT_FORMATS else "csv"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return fmt


def export_tables(tables: dict[str, DataFrame], base_path: str, fmt: str = "csv") -> dict[str, str]:
    """Export several tables, one Spark job each; returns name -> path."""
    out = {}
    for name, df in tables.items():
        path = f"{base_path.rstrip('/')}/{name}"
        export_table(df, path, fmt)
        out[name] = path
    return out


def _rank(df: DataFrame, columns: Sequence[str]) -> Column:
    """``columns`` as one comparable struct, nulls after values. Timestamps
    are compared as microseconds, which no time zone changes."""
    parts = []
    for i, c in enumerate(columns):
        v = F.unix_micros(c) if isinstance(df.schema[c].dataType, TimestampType) else F.col(c)
        parts += [F.col(c).isNull().alias(f"n{i}"), v.alias(f"v{i}")]
    return F.struct(*parts)


#: Distinct keys that one task may sort to find the n-th among them.
FEW_KEYS = 100_000


def _nth_key(counts: DataFrame, n: int, few: int = FEW_KEYS) -> Row | None:
    """The key ``k`` of ``counts`` (distinct ``k``, ``rows``) at or before
    which ``n`` rows lie, or None if there are fewer. Sorts the keys by range
    into a scratch table; the ranges' sums say which of them holds the n-th
    row, and that one is sorted again until it has few keys."""
    spark = counts.sparkSession
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    while True:
        path = scratch_path(spark, "key-ranges")
        (counts.repartitionByRange(parts, "k").withColumn("range", F.spark_partition_id())
         .write.parquet(path))
        ranges = spark.read.parquet(path)
        for number, rows, keys in sorted(ranges.groupBy("range").agg(F.sum("rows"), F.count("k")).collect()):
            if rows >= n:
                break
            n -= rows
        else:
            return None
        counts = ranges.filter(F.col("range") == number).select("k", "rows")
        if keys <= few:
            so_far = F.sum("rows").over(Window.orderBy("k"))
            return counts.withColumn("upto", so_far).filter(F.col("upto") >= n).agg(F.min("k")).first()[0]


def first_n_by(df: DataFrame, n: int, key: str, tie_break: Sequence[str] = (), few: int = FEW_KEYS) -> DataFrame:
    """The ``n`` rows smallest by ``key``, then by the ``tie_break`` columns
    (nulls last); exactly ``n`` rows when the input has that many.

    ``orderBy().limit(n)`` would send every split's top ``n`` rows to one
    task. Here the n-th key is found first, by Spark's range sort of the key
    columns (:func:`_nth_key`), and the rows are a plain filter up to it. The
    driver sees a count per range and one key. The sort runs when the
    DataFrame is built, as the n-th key is part of its filter; give it landed
    files or a written table, not a costly lineage.

    Where rows are still tied at the n-th key, as many of them as needed are
    taken (any of them, as SQL ``ORDER BY .. LIMIT`` does); name tie-break
    columns that make rows distinct for the same rows on every run."""
    if n <= 0:
        return df.limit(0)
    spark = df.sparkSession
    rank = _rank(df, [key, *tie_break])
    path = scratch_path(spark, "key-counts")
    df.groupBy(rank.alias("k")).agg(F.count(F.lit(1)).alias("rows")).write.parquet(path)
    counts = spark.read.parquet(path)
    value = _nth_key(counts, n, few)
    if value is None:
        return df
    kind = counts.schema["k"].dataType
    cut = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, kind)])
    strict, upto = counts.agg(F.coalesce(F.sum(F.when(F.col("k") < cut, F.col("rows"))), F.lit(0)),
                              F.sum(F.when(F.col("k") <= cut, F.col("rows")))).first()
    rows = df
    if value[1] is not None and not isinstance(df.schema[key].dataType, TimestampType):
        # implied by the n-th key; on a plain column, so that it reaches the scan
        rows = df.filter(F.col(key) <= F.lit(value[1]).cast(df.schema[key].dataType))
    if upto == n:  # always so for a unique key
        return rows.filter(rank <= cut)
    # an unordered limit: its final task stops after n - strict rows
    return rows.filter(rank < cut).unionByName(rows.filter(rank == cut).limit(n - strict))


def ingest_limit(df: DataFrame, n: int, order_col: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """First ``n`` records by ``order_col`` (:func:`first_n_by`). The same on
    every run if the column is unique or the ``tie_break`` columns tell its
    ties apart; of rows that are still tied at the n-th some are taken."""
    return first_n_by(df, n, order_col, tie_break)
