"""Daily indicators per group and the national roll-up.

The order is always aggregate first, window second: windows only ever see
one row per (date, group), so the largest window partition is bounded by
the number of distinct dates of one group, never by the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epilake.functions.columns import normalise_code, rate_per_n_expr

#: Output columns of the per-region daily indicator table, in order.
INDICATOR_COLUMNS = ("date", "year", "month", "day", "code", "name", "population",
                     "new_cases", "cumulative_cases", "rate_per_100k")

#: Output columns of the national daily summary, in order.
SUMMARY_COLUMNS = ("date", "year", "month", "day", "new_cases_national",
                   "cumulative_cases_national", "population_total",
                   "rate_per_100k_national", "latest_date")


def region_keys(df: DataFrame, dim_code: str = "dim_code", raw_code: str = "region_raw",
                dim_name: str = "dim_name", raw_name: str = "region_name_raw",
                code_out: str = "code", name_out: str = "name", width: int = 2) -> DataFrame:
    """Group code and name: the dimension's if the event matched, else the
    event's own (normalised) code and raw name."""
    return df.withColumns({
        code_out: F.coalesce(F.col(dim_code), normalise_code(raw_code, width)),
        name_out: F.coalesce(F.col(dim_name), F.col(raw_name)),
    })


def daily_counts(df: DataFrame, group_cols: Sequence[str] = (
        "event_date", "year", "month", "day", "code", "name", "population"),
        rename: dict[str, str] | None = None, out: str = "new_cases") -> DataFrame:
    """Events per group: ``count(*)`` grouped by ``group_cols`` (partial
    aggregation on the map side, so a hot group costs one row per task)."""
    rename = {"event_date": "date"} if rename is None else rename
    keys = [F.col(c).alias(rename.get(c, c)) for c in group_cols]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def running_total(df: DataFrame, value: str = "new_cases", partition_by: Sequence[str] = ("code",),
                  order_by: str = "date", out: str = "cumulative_cases") -> DataFrame:
    """Running sum per group ordered by date.

    The frame is written out: RANGE UNBOUNDED PRECEDING .. CURRENT ROW, so
    rows of one group with the same date are peers and share one total, and
    a null date sorts first. The window runs over one row per group and
    date and is joined back, so a group with many rows a date (events
    without a code, each with its own name) makes no large window.
    """
    keys = [*partition_by, order_by]
    w = (Window.partitionBy(*partition_by).orderBy(F.col(order_by).asc_nulls_first())
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    total = df.groupBy(*keys).agg(F.sum(value).alias("__sum")).withColumn("__total", F.sum("__sum").over(w))
    total = total.select(*[F.col(c).alias(f"__{c}") for c in keys], F.col("__total").alias(out))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(total, same).select(*df.columns, out)


def rate_per_n(df: DataFrame, value: str = "cumulative_cases", population: str = "population",
               out: str = "rate_per_100k", per: float = 100000.0) -> DataFrame:
    """``value * per / population``, null when population is null or <= 0."""
    return df.withColumn(out, rate_per_n_expr(value, population, per))


def region_daily_indicators(trusted: DataFrame) -> DataFrame:
    """Per (date, region): new cases, cumulative cases, cases per 100k."""
    daily = daily_counts(region_keys(trusted))
    return rate_per_n(running_total(daily)).select(*INDICATOR_COLUMNS)


def national_rollup(indicators: DataFrame) -> DataFrame:
    """Per date: sums of new cases, cumulative cases and population over
    the regions that reported that date (a region without events on a date
    drops out of all three sums)."""
    return indicators.groupBy("date", "year", "month", "day").agg(
        F.sum("new_cases").alias("new_cases_national"),
        F.sum("cumulative_cases").alias("cumulative_cases_national"),
        F.sum("population").alias("population_total"),
    )


def with_latest_date(df: DataFrame, date_col: str = "date", out: str = "latest_date",
                     of: DataFrame | None = None) -> DataFrame:
    """Attach the overall latest date to every row: that of ``of``, by
    default of ``df`` itself.

    Planned as an uncorrelated scalar subquery: the one-value aggregate is
    computed once (partial max per task, one final row) and inlined; no row
    of ``df`` moves.
    """
    latest = (df if of is None else of).select(F.max(date_col)).scalar()
    return df.withColumn(out, latest)


def national_rollup_dense(indicators: DataFrame) -> DataFrame:
    """Densified national roll-up (an addition, not the reference's
    semantics): every region that has reported keeps counting on later
    dates, with its last cumulative total and its population.

    Carrying each region's cumulative forward makes the national cumulative
    the running sum of national new cases, and the population the running
    sum of the populations entering on their group's first date (a null
    date sorts first). So no date x region spine is built: two per-date
    aggregates and a running sum over one row per date.
    """
    d = F.col("date")
    daily = indicators.groupBy("date", "year", "month", "day").agg(
        F.sum("new_cases").alias("new_cases_national"))
    first_seen = indicators.groupBy("code", "name", "population").agg(
        F.when(F.count_if(d.isNull()) > 0, F.lit(None).cast("date"))
         .otherwise(F.min(d)).alias("__entry"))
    entering = first_seen.groupBy("__entry").agg(F.sum("population").alias("__pop_in"))
    series = (daily.join(entering, daily["date"].eqNullSafe(entering["__entry"]), "left")
              .drop("__entry")
              .withColumn("__pop_in", F.coalesce(F.col("__pop_in"), F.lit(0))))
    so_far = (Window.orderBy(F.col("date").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    series = series.withColumns({
        "cumulative_cases_national": F.sum("new_cases_national").over(so_far),
        "population_total": F.coalesce(F.sum("__pop_in").over(so_far), F.lit(0))})
    return series.select("date", "year", "month", "day", "new_cases_national",
                         "cumulative_cases_national", "population_total")


def national_daily_summary(indicators: DataFrame, densify: bool = False) -> DataFrame:
    """National series: roll-up, rate per 100k (null where the summed
    population is 0 or null) and the latest available date.

    ``densify=True`` (an addition, off by default) uses
    :func:`national_rollup_dense` instead of the reference's sum over the
    regions that reported on each date."""
    nat = national_rollup_dense(indicators) if densify else national_rollup(indicators)
    nat = nat.withColumn(
        "rate_per_100k_national",
        F.try_divide(F.col("cumulative_cases_national") * F.lit(100000.0),
                     F.col("population_total")))
    # the series has the dates of the indicators, whose column is cheaper to
    # read than the roll-up is to repeat
    return with_latest_date(nat, of=indicators).select(*SUMMARY_COLUMNS)
