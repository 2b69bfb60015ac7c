"""Bounded reads over the published national series, and payload shaping.

Request values are bound as typed literals (never spliced into SQL text).
Date filters are also written on the year/month/day partition columns, so
a partitioned table is pruned instead of scanned.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SERVE_COLUMNS = ("date", "new_cases_national", "cumulative_cases_national",
                 "population_total", "rate_per_100k_national", "latest_date")


def _as_date(d: str | _dt.date) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def latest_summary(summary: DataFrame) -> DataFrame:
    """The single most recent national record."""
    return summary.orderBy(F.col("date").desc_nulls_last()).limit(1).select(*SERVE_COLUMNS)


def summary_by_date(summary: DataFrame, day: str | _dt.date) -> DataFrame:
    """The national record of one date, ``day`` given as ``YYYY-MM-DD``.
    The filter is on the int partition columns (zero-padded input is fine)."""
    d = _as_date(day)
    return (summary.filter((F.col("year") == d.year) & (F.col("month") == d.month)
                           & (F.col("day") == d.day))
            .limit(1).select(*SERVE_COLUMNS))


def summary_history(summary: DataFrame) -> DataFrame:
    """The whole national series in date order (no latest-date column)."""
    return summary.select(*SERVE_COLUMNS[:-1]).orderBy(F.col("date").asc_nulls_first())


def last_n_rows(summary: DataFrame, n: int = 7) -> DataFrame:
    """The ``n`` most recent records (rows, not days)."""
    return (summary.orderBy(F.col("date").desc_nulls_last()).limit(n)
            .select("date", "new_cases_national", "cumulative_cases_national"))


def partition_lower_bound(start: _dt.date) -> "F.Column":
    """Predicate on year/month/day equivalent to ``date >= start`` for rows
    whose parts come from ``date``; lets Spark prune partitions."""
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    return ((y > start.year)
            | ((y == start.year) & (m > start.month))
            | ((y == start.year) & (m == start.month) & (d >= start.day)))


def last_n_days(summary: DataFrame, n_days: int = 30, as_of: str | _dt.date | None = None) -> DataFrame:
    """Records from ``as_of - n_days`` on (``as_of`` defaults to today),
    newest first, national rate rounded to 2 places."""
    if as_of is None:
        start_col = F.date_sub(F.current_date(), n_days)
        # the year's bound folds to a constant and prunes the year folders
        rows = summary.filter((F.col("year") >= F.year(start_col)) & (F.col("date") >= start_col))
    else:
        start = _as_date(as_of) - _dt.timedelta(days=n_days)
        rows = summary.filter(partition_lower_bound(start) & (F.col("date") >= F.lit(start)))
    return (rows.select("date", "new_cases_national", "cumulative_cases_national",
                        F.round("rate_per_100k_national", 2).alias("rate_national"))
            .orderBy(F.col("date").desc_nulls_last()))


def rows_as_strings(df: DataFrame, cols: Sequence[str], out: str = "row") -> DataFrame:
    """Each row as an array of strings (null stays null), no header row."""
    return df.select(F.array(*[F.col(c).cast("string") for c in cols]).alias(out))


def rows_as_json(df: DataFrame, cols: Sequence[str], out: str = "json") -> DataFrame:
    """Each row as one JSON object (nulls written as ``null``). Per-row, so
    an unbounded result is never gathered into one value."""
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(out))


def json_envelope(df: DataFrame, name: str, cols: Sequence[str], order_col: str,
                  out: str = "body", max_rows: int = 10_000) -> DataFrame:
    """``{"<name>": [[v, ...], ...]}`` for a *bounded* result (e.g. a top-k
    or a single record), rows ordered by ``order_col``. The body is one
    value, so a result of more than ``max_rows`` rows raises an error."""
    df = df.limit(max_rows + 1)
    rows = F.array_sort(F.collect_list(F.struct(
        F.col(order_col).alias("__k"),
        F.array(*[F.col(c).cast("string") for c in cols]).alias("__v"))))
    body = F.to_json(F.struct(F.transform(F.col("__rows"), lambda r: r["__v"]).alias(name)),
                     {"ignoreNullFields": "false"})
    return df.agg(rows.alias("__rows")).select(
        F.when(F.size("__rows") <= max_rows, body)
        .otherwise(F.raise_error(F.lit(f"{name}: more than {max_rows} rows in one payload"))).alias(out))


def preview_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order (a console preview, made
    deterministic)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def row_count(df: DataFrame, rows: str = "rows", columns: str = "columns") -> DataFrame:
    """One-row table: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias(rows)).withColumn(columns, F.lit(len(df.columns)))


def observed(df: DataFrame, name: str, conditions: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Attach a row counter, and one for each of ``conditions``, that fill
    in while ``df`` is written: counting costs no extra job (read
    ``obs.get`` after the action)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(c).alias(n) for n, c in (conditions or {}).items()]), obs


def run_sql(spark: SparkSession, query: str, **args: object) -> DataFrame:
    """Run SQL text over catalog tables / temp views with *named*
    parameters (``:name`` markers bound as typed literals, never spliced
    into the text)."""
    return spark.sql(query, args=args or None)
