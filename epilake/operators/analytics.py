"""Analytic reports over the daily indicators and the event records.

Ranking uses ``row_number`` filtered to 1, which Spark plans as a
WindowGroupLimit with a partial (map-side) step, so each task forwards at
most one row per group. Top-k uses ``orderBy(...).limit(k)``
(TakeOrderedAndProject: k rows per task, then k overall). All ties are
broken by the group code so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epilake.functions.columns import AGE_BINS, AGE_FALLBACK, bin_label, round2


def _date_lit(d: str | _dt.date) -> Column:
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d))


def latest_per_group(df: DataFrame, group: Sequence[str] = ("code",), order_col: str = "date",
                     tie_breakers: Sequence[str] = ("name",), rank_col: str | None = None) -> DataFrame:
    """Latest row per group (``order_col`` descending, nulls last; ties
    broken by ``tie_breakers`` descending)."""
    rn = rank_col or "__rn"
    w = Window.partitionBy(*group).orderBy(
        F.col(order_col).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_breakers])
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)


def top_k(df: DataFrame, by: str, k: int, tie_breaker: str = "code") -> DataFrame:
    """First ``k`` rows by ``by`` descending (nulls last), then ``tie_breaker``."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie_breaker).asc_nulls_first()).limit(k)


def top_k_latest_rate(indicators: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` regions by their latest known rate.

    Rows without a rate are removed *before* ranking, so a region whose
    last day has no rate falls back to its last day with one.
    """
    latest = latest_per_group(indicators.filter(F.col("rate_per_100k").isNotNull()))
    return top_k(latest, "rate_per_100k", k).select(
        "code", "name",
        F.col("rate_per_100k").try_cast("decimal(10,2)").alias("rate_per_100k"),
        F.col("cumulative_cases").alias("total_cases"),
        F.col("date").alias("last_date"))


def top_k_strict_latest(indicators: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` regions by the rate of their latest row; a region whose
    latest row has no rate is dropped (filter *after* ranking)."""
    latest = latest_per_group(indicators).filter(F.col("rate_per_100k").isNotNull())
    return top_k(latest, "rate_per_100k", k).select(
        "code", "name", round2("rate_per_100k").alias("rate_per_100k"),
        F.col("cumulative_cases").alias("total_cases"))


def top_k_on_date(indicators: DataFrame, year: int, month: int, day: int, k: int = 10) -> DataFrame:
    """Top ``k`` regions by rate on one day, filtered on the (partition)
    columns year/month/day so a partitioned table is pruned."""
    day_rows = indicators.filter((F.col("year") == year) & (F.col("month") == month)
                                 & (F.col("day") == day))
    return top_k(day_rows, "rate_per_100k", k).select(
        "code", "name",
        F.col("rate_per_100k").try_cast("decimal(10,2)").alias("rate_per_100k"),
        F.col("cumulative_cases").alias("total_cases"))


def monthly_trends(indicators: DataFrame) -> DataFrame:
    """Per (year, month): total new cases, distinct reporting regions, and
    the average of new cases per region-day row."""
    # two plain aggregation levels instead of a distinct aggregate (which
    # Spark expands into a copy of every row per aggregate group): per
    # region-month sums and row counts, then per month; a region is counted
    # once per month by construction, and the average is the exact ratio
    per_region = indicators.groupBy("year", "month", "code").agg(
        F.sum("new_cases").alias("__cases"), F.count(F.lit(1)).alias("__rows"))
    return (per_region.groupBy("year", "month").agg(
        F.sum("__cases").alias("monthly_cases"),
        F.count("code").alias("regions_reporting"),
        round2(F.sum("__cases") / F.sum("__rows")).alias("avg_daily_cases"))
        .orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first()))


def _events(count_col: str | None, cond: Column | None = None) -> Column:
    """Number of events (optionally those meeting ``cond``): a row count,
    or the sum of ``count_col`` over pre-aggregated rows."""
    if count_col is None:
        return F.count(F.lit(1)) if cond is None else F.count_if(cond)
    w = F.col(count_col) if cond is None else F.when(cond, F.col(count_col)).otherwise(F.lit(0))
    return F.coalesce(F.sum(w), F.lit(0)).cast("bigint")


def event_profile(events: DataFrame, cols: Sequence[str] = ("age", "sex", "status"),
                  out: str = "events") -> DataFrame:
    """Events per combination of ``cols`` (null is a value of its own).

    One event-level pass that several small reports can share: with a few
    distinct values per column the result has at most a few thousand rows
    whatever the number of events, and map-side partial aggregation keeps
    a hot combination to one row per task.
    """
    return events.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def bin_share(events: DataFrame, value_col: str = "age",
              bins: Sequence[tuple[str, float | None, float | None]] = AGE_BINS,
              fallback: str = AGE_FALLBACK, label_out: str = "age_group",
              unit_col: str | None = None, unit_value: object = None,
              count_col: str | None = None) -> DataFrame:
    """Events per bin of a numeric column (nulls excluded) and each bin's
    share of the total in percent, rounded to 2 places.

    The share is exact decimal arithmetic (``count * 100.0 / total``),
    returned as decimal(27,2). The total comes from an empty-spec window over the
    *aggregated* rows: at most ``len(bins) + 1`` rows reach that task.

    By default the value's unit is ignored (an age given in months counts
    as years); pass ``unit_col``/``unit_value`` to bin only rows in that
    unit (an addition, off by default).

    ``count_col`` names a column of pre-aggregated event counts (see
    :func:`event_profile`); rows then count with that weight.
    """
    if unit_col is not None:
        events = events.filter(F.col(unit_col) == F.lit(unit_value))
    binned = (events.filter(F.col(value_col).isNotNull())
              .groupBy(bin_label(value_col, bins, fallback).alias(label_out))
              .agg(_events(count_col).alias("total_cases")))
    share = F.round(F.col("total_cases") * F.lit(100).cast("decimal(4,1)")
                    / F.sum("total_cases").over(Window.partitionBy()), 2)
    return (binned.withColumn("share_pct", share.cast("decimal(27,2)"))
            .orderBy(F.col("total_cases").desc()))


def outcome_breakdown(events: DataFrame, label_col: str = "sex", missing_label: str = "Not reported",
                      deceased_col: str = "status", deceased_value: str = "Deceased",
                      recovered_col: str = "status", recovered_value: str = "Recovered",
                      count_col: str | None = None) -> DataFrame:
    """Per label: events, deceased, recovered and fatality percent
    (decimal(27,2)).

    Grouping is on the raw column and the missing-label fallback is applied
    afterwards, so a null group and a literal ``missing_label`` group stay
    separate rows. Comparisons are exact (case- and accent-sensitive).
    ``count_col`` as in :func:`bin_share`.
    """
    agg = events.groupBy(label_col).agg(
        _events(count_col).alias("total_cases"),
        _events(count_col, F.col(deceased_col) == F.lit(deceased_value)).alias("deceased"),
        _events(count_col, F.col(recovered_col) == F.lit(recovered_value)).alias("recovered"))
    fatality = F.round(F.col("deceased") * F.lit(100).cast("decimal(4,1)") / F.col("total_cases"), 2)
    return (agg.select(F.coalesce(F.col(label_col), F.lit(missing_label)).alias(label_col),
                       "total_cases", "deceased", "recovered",
                       fatality.cast("decimal(27,2)").alias("fatality_pct"))
            .orderBy(F.col("total_cases").desc()))


def first_threshold_date(indicators: DataFrame, threshold: int = 1000,
                         origin: str | _dt.date = "2020-03-06") -> DataFrame:
    """First date each region's cumulative count reached ``threshold``, and
    whole days since ``origin``."""
    return (indicators.filter(F.col("cumulative_cases") >= threshold)
            .groupBy("code", "name").agg(F.min("date").alias("first_date"))
            .withColumn("days_since_origin", F.datediff("first_date", _date_lit(origin)))
            .orderBy(F.col("first_date").asc_nulls_first()))


def national_daily_cases(indicators: DataFrame) -> DataFrame:
    """New cases summed over regions, one row per date."""
    return indicators.groupBy("date").agg(F.sum("new_cases").alias("new_cases_national"))


def moving_average(indicators: DataFrame, window: int = 7, calendar: bool = False) -> DataFrame:
    """Trailing ``window``-row moving average of the national daily new
    cases (rows, not calendar days: a gap in dates is not filled), rounded
    to 2 places; early rows average the rows they have.

    ``calendar=True`` (an addition, off by default) averages over the last
    ``window`` calendar days instead; a null date belongs to no such frame
    and is left out.

    The window has no partition: it runs after the aggregation, over one row
    per date whatever the number of events."""
    daily = national_daily_cases(indicators)
    if calendar:
        daily = daily.filter(F.col("date").isNotNull())
        frame = Window.orderBy(F.unix_date("date")).rangeBetween(1 - window, Window.currentRow)
    else:
        frame = Window.orderBy(F.col("date").asc_nulls_first()).rowsBetween(1 - window, Window.currentRow)
    return (daily.withColumn("moving_avg", round2(F.avg("new_cases_national").over(frame)))
            .select("date", "new_cases_national", "moving_avg")
            .orderBy(F.col("date").desc_nulls_last()))
