"""
worked running total (5, 12, 8, 32, 11 -> 68)."""

import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from epilake.functions.columns import bin_label, normalise_code
from epilake.operators import analytics as an
from epilake.operators import clean as cl
from epilake.operators import indicators as ind

D = dt.date

IND_SCHEMA = StructType([
    StructField("date", DateType()), StructField("year", IntegerType()),
    StructField("month", IntegerType()), StructField("day", IntegerType()),
    StructField("code", StringType()), StructField("name", StringType()),
    StructField("population", LongType()), StructField("new_cases", LongType()),
    StructField("cumulative_cases", LongType()), StructField("rate_per_100k", DoubleType()),
])


def ind_rows(spark, rows):
    full = [(d, d.year, d.month, d.day, c, n, p, new, cum, rate)
            for d, c, n, p, new, cum, rate in rows]
    return spark.createDataFrame(full, IND_SCHEMA)


def test_worked_running_total(spark):
    days = [D(2020, 3, 6 + i) for i in range(5)]
    df = spark.createDataFrame([(d, "05", v) for d, v in zip(days, [5, 12, 8, 32, 11])],
                               "date date, code string, new_cases long")
    out = ind.running_total(df).orderBy("date").collect()
    assert [r.cumulative_cases for r in out] == [5, 17, 25, 57, 68]


def test_running_total_peers_share_total(spark):
    # T4: same code and date on two rows (two raw names) -> RANGE peers
    df = spark.createDataFrame(
        [(D(2020, 1, 1), "05", "A", 1), (D(2020, 1, 2), "05", "A", 2),
         (D(2020, 1, 2), "05", "B", 3)],
        "date date, code string, name string, new_cases long")
    out = {(r.date, r.name): r.cumulative_cases for r in ind.running_total(df).collect()}
    assert out[(D(2020, 1, 2), "A")] == out[(D(2020, 1, 2), "B")] == 6


def test_running_total_null_date_first(spark):
    df = spark.createDataFrame([(None, "05", 4), (D(2020, 1, 1), "05", 1)],
                               "date date, code string, new_cases long")
    out = {r.date: r.cumulative_cases for r in ind.running_total(df).collect()}
    assert out[None] == 4 and out[D(2020, 1, 1)] == 5


def test_padding_join(spark):
    cases = spark.createDataFrame([(1, "5"), (2, "05"), (3, "11"), (4, "7")],
                                  "case_id long, region_raw string")
    dim = spark.createDataFrame([("05", "Antioquia", 100), ("11", "Bogota", 200)],
                                "code string, name string, population long")
    out = {r.case_id: r.dim_name for r in cl.enrich_left_join(
        cases, dim, "region_raw", "code", {"name": "dim_name"}).collect()}
    assert out == {1: "Antioquia", 2: "Antioquia", 3: "Bogota", 4: None}
    miss = cl.unmatched_keys(cases, dim, "region_raw", "code").collect()
    assert [(r.code, r.events) for r in miss] == [("07", 1)]


def test_normalise_code_keeps_long_codes(spark):
    df = spark.createDataFrame([(5,), (123,)], "c int")
    assert [r[0] for r in df.select(normalise_code("c")).collect()] == ["05", "123"]


def test_bad_date_is_null_not_error(spark):
    df = spark.createDataFrame([("2020-03-06",), ("2020-03-06 00:00:00",), ("6/3/2020 0:00:00",)],
                               "d string")
    out = [r.event_date for r in cl.date_parts(df, "d").collect()]
    assert out == [D(2020, 3, 6), D(2020, 3, 6), None]


def test_rate_guard(spark):
    df = spark.createDataFrame([(10, 0), (10, None), (10, 1000)], "v long, p long")
    out = [r.r for r in ind.rate_per_n(df, "v", "p", "r").collect()]
    assert out == [None, None, 1000.0]


def test_sparse_national(spark):
    # T1/T2: a region without events on a date drops out of every sum
    rows = [(D(2020, 1, 1), "A", "A", 100, 5, 5, None), (D(2020, 1, 1), "B", "B", 200, 7, 7, None),
            (D(2020, 1, 2), "A", "A", 100, 4, 9, None), (D(2020, 1, 3), "B", "B", 200, 1, 8, None)]
    out = ind.national_daily_summary(ind_rows(spark, rows)).orderBy("date").collect()
    assert [r.cumulative_cases_national for r in out] == [12, 9, 8]
    assert [r.rate_per_100k_national for r in out] == [4000.0, 9000.0, 4000.0]
    assert {r.latest_date for r in out} == {D(2020, 1, 3)}


def test_national_rate_zero_population_is_null(spark):
    # T3: all populations of a date are 0 -> null, not a division error
    rows = [(D(2020, 1, 1), "03", "Z", 0, 5, 5, None)]
    out = ind.national_daily_summary(ind_rows(spark, rows)).collect()
    assert out[0].rate_per_100k_national is None


def test_moving_average_rows_not_days(spark):
    # T15: a gap in dates is not filled
    rows = [(D(2020, 1, 1), "A", "A", 1, 10, 10, None), (D(2020, 1, 2), "A", "A", 1, 20, 30, None),
            (D(2020, 2, 1), "A", "A", 1, 60, 90, None)]
    out = an.moving_average(ind_rows(spark, rows), window=2).orderBy("date").collect()
    assert [r.moving_avg for r in out] == [10.0, 15.0, 40.0]
    out3 = an.moving_average(ind_rows(spark, rows), window=7).orderBy("date").collect()
    assert [r.moving_avg for r in out3] == [10.0, 15.0, 30.0]


def test_rank_before_vs_after_null_filter(spark):
    # T9: last day without a rate
    rows = [(D(2020, 1, 1), "A", "A", 1000, 5, 5, 500.0),
            (D(2020, 1, 2), "A", "A", None, 1, 6, None),
            (D(2020, 1, 2), "B", "B", 1000, 2, 2, 200.0)]
    df = ind_rows(spark, rows)
    lenient = {r.code for r in an.top_k_latest_rate(df, 10).collect()}
    strict = {r.code for r in an.top_k_strict_latest(df, 10).collect()}
    assert lenient == {"A", "B"} and strict == {"B"}
    a = [r for r in an.top_k_latest_rate(df, 10).collect() if r.code == "A"][0]
    assert a.last_date == D(2020, 1, 1)


def test_label_group_stays_separate(spark):
    # T7: null and a literal 'Not reported' are two groups
    df = spark.createDataFrame([(None, "x"), ("Not reported", "x"), ("F", "Deceased")],
                               "sex string, status string")
    out = an.outcome_breakdown(df).collect()
    assert len(out) == 3
    assert sorted(r.sex for r in out) == ["F", "Not reported", "Not reported"]
    f = [r for r in out if r.sex == "F"][0]
    assert f.deceased == 1 and f.fatality_pct == 100.0


def test_fractional_age_fallback(spark):
    # T6: between two closed ranges -> fallback label
    df = spark.createDataFrame([(29.5,), (17.5,), (65.0,)], "age double")
    assert [r[0] for r in df.select(bin_label("age")).collect()] == ["Unknown", "0-17", "65+"]


def test_bin_share_sums_to_100(spark):
    df = spark.range(0, 1000).select((F.col("id") % 90).cast("int").alias("age"))
    out = an.bin_share(df).collect()
    assert sum(r.total_cases for r in out) == 1000
    assert abs(float(sum(r.share_pct for r in out)) - 100.0) < 0.05


def test_first_threshold_date(spark):
    rows = [(D(2020, 3, 7), "A", "A", 1, 5, 500, None), (D(2020, 3, 8), "A", "A", 1, 1, 1001, None),
            (D(2020, 3, 9), "A", "A", 1, 1, 1002, None)]
    out = an.first_threshold_date(ind_rows(spark, rows), 1000, "2020-03-06").collect()
    assert [(r.first_date, r.days_since_origin) for r in out] == [(D(2020, 3, 8), 2)]


def test_top_k_deterministic_ties(spark):
    rows = [(D(2020, 1, 1), c, c, 1, 1, 1, 10.0) for c in ["C", "A", "B"]]
    out = [r.code for r in an.top_k_latest_rate(ind_rows(spark, rows), 2).collect()]
    assert out == ["A", "B"]


def test_moving_average_calendar_flag(spark):
    rows = [(D(2020, 1, 1), "A", "A", 1, 10, 10, None), (D(2020, 1, 2), "A", "A", 1, 20, 30, None),
            (D(2020, 2, 1), "A", "A", 1, 60, 90, None)]
    out = an.moving_average(ind_rows(spark, rows), window=7, calendar=True).orderBy("date").collect()
    assert [r.moving_avg for r in out] == [10.0, 15.0, 60.0]


def test_bin_share_unit_filter(spark):
    df = spark.createDataFrame([(6, 1), (6, 2), (40, 1)], "age int, unit int")
    assert sum(r.total_cases for r in an.bin_share(df).collect()) == 3
    out = {r.age_group: r.total_cases for r in an.bin_share(df, unit_col="unit", unit_value=1).collect()}
    assert out == {"0-17": 1, "30-49": 1}


def test_sparse_national_densified(spark):
    # T1 addition: regions keep their last cumulative total and population
    rows = [(D(2020, 1, 1), "A", "A", 100, 5, 5, None), (D(2020, 1, 1), "B", "B", 200, 7, 7, None),
            (D(2020, 1, 2), "A", "A", 100, 4, 9, None), (D(2020, 1, 3), "B", "B", 200, 1, 8, None)]
    out = ind.national_daily_summary(ind_rows(spark, rows), densify=True).orderBy("date").collect()
    assert [r.new_cases_national for r in out] == [12, 4, 1]
    assert [r.cumulative_cases_national for r in out] == [12, 16, 17]
    assert [r.population_total for r in out] == [300, 300, 300]
    assert [round(r.rate_per_100k_national, 6) for r in out] == [4000.0, round(16e5 / 300, 6), round(17e5 / 300, 6)]


def test_densified_matches_carried_forward_spine(spark):
    # brute force on the sf0.001 fixture: date spine x region, last value carried
    from epilake import queries as q
    from conftest import SF001
    indic = q.indicators(spark, SF001)
    rows = indic.select("date", "code", "name", "population", "cumulative_cases").collect()
    dates = sorted({r.date for r in rows}, key=lambda d: (d is not None, d))
    last, pop, expect = {}, {}, {}
    by_date = {}
    for r in rows:
        by_date.setdefault(r.date, []).append(r)
    for d in dates:
        for r in by_date[d]:
            g = (r.code, r.name, r.population)
            last[g] = r.cumulative_cases
            pop[g] = r.population
        expect[d] = (sum(last.values()), sum(p for p in pop.values() if p is not None))
    got = {r.date: (r.cumulative_cases_national, r.population_total)
           for r in ind.national_daily_summary(indic, densify=True).collect()}
    assert got == expect


def test_reports_from_profile_equal_event_level(spark):
    from epilake import fixture as fx
    from conftest import SF001
    cases = fx.cases(spark, SF001)
    profile = an.event_profile(cases, ("age", "sex", "status"))
    for direct, shared in [(an.bin_share(cases), an.bin_share(profile, count_col="events")),
                           (an.outcome_breakdown(cases), an.outcome_breakdown(profile, count_col="events"))]:
        assert direct.schema == shared.schema
        assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, shared.collect()))


def test_enrich_multiplies_no_event(spark):
    fact = spark.createDataFrame([(i, str(i % 5)) for i in range(50)], "id long, k string")
    dim = spark.createDataFrame([("0", "a"), ("00", "b"), ("1", "c")], "code string, name string")
    got = cl.enrich_left_join(fact, dim, "k", "code", {"name": "name"})
    assert got.count() == 50
    assert {(r.k, r.name) for r in got.collect()} == {("0", "b"), ("1", "c"), ("2", None), ("3", None), ("4", None)}


def test_large_dimension_join_spares_hopeless_rows_and_deals_hot_codes(spark):
    own = spark.newSession()
    for k, v in {"autoBroadcastJoinThreshold": "-1", "adaptive.enabled": "false", "shuffle.partitions": "16"}.items():
        own.conf.set(f"spark.sql.{k}", v)
    # a third without a code, a third of one code, a ninth unknown
    fact = own.range(0, 90_000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN '7' WHEN id % 9 = 2 THEN concat('u', id) "
              "ELSE CAST(id % 5000 AS STRING) END AS raw")
    dim = own.range(5000).selectExpr("CAST(id AS STRING) AS code", "concat('n', id) AS name")
    args = ("raw", "code", {"code": "dim_code", "name": "dim_name"})
    got, want = cl.enrich_large_dimension(fact, dim, *args), cl.enrich_left_join(fact, dim, *args)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))

    def tasks(df):
        # a column of the dimension is used, else the join is left out
        found = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n"), F.max("dim_name"))
        return sorted(r.n for r in found.collect())
    assert tasks(want)[-1] > 30_000 and tasks(got)[-1] < 10_000
    # the exchange below the join carries no hopeless row
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and plan.count("SortMergeJoin") == 1
    wide = cl.key_filter(dim, "code", 1 << 17)
    maybe = cl._maybe_known(fact, "raw", wide, 1 << 17, "m").groupBy("m").count().collect()
    counts = {r.m: r["count"] for r in maybe}
    hopeful = fact.filter("raw IS NOT NULL AND raw NOT LIKE 'u%'").count()
    assert hopeful <= counts[True] <= hopeful + 100


def test_large_dimension_join_on_odd_input(spark):
    fact = spark.createDataFrame([(1, "5"), (2, None), (3, "zz")], "id int, raw string")
    dim = spark.createDataFrame([("05", "A"), ("5", "B"), (None, "C")], "code string, name string")
    args = ("raw", "code", {"code": "dim_code", "name": "dim_name"})
    for f, d in ((fact, dim), (fact, dim.limit(0)), (fact.limit(0), dim)):
        got, want = cl.enrich_large_dimension(f, d, *args), cl.enrich_left_join(f, d, *args)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_running_total_with_many_names_of_a_null_code(spark):
    rows = [(None, D(2020, 1, 1), f"n{i}", 1) for i in range(50)] + [
        (None, None, "x", 2), (None, D(2020, 1, 2), "y", 3), ("05", D(2020, 1, 1), "A", 4)]
    df = spark.createDataFrame(rows, "code string, date date, name string, new_cases long")
    got = ind.running_total(df)
    assert got.count() == len(rows)
    totals = {(r.code, r.date): r.cumulative_cases for r in got.collect()}
    assert totals == {(None, None): 2, (None, D(2020, 1, 1)): 52, (None, D(2020, 1, 2)): 55, ("05", D(2020, 1, 1)): 4}


def test_null_population_adds_cases_not_population(spark):
    # T2: a region with null population still counts in the numerator
    rows = [(D(2020, 1, 1), "A", "A", 100, 5, 5, None), (D(2020, 1, 1), "Z", "Z", None, 7, 7, None)]
    out = ind.national_daily_summary(ind_rows(spark, rows)).collect()[0]
    assert (out.cumulative_cases_national, out.population_total) == (12, 100)
    assert out.rate_per_100k_national == 12 * 100000.0 / 100


def test_outcome_literals_are_case_sensitive(spark):
    # T8: 'deceased' is not 'Deceased'
    df = spark.createDataFrame([("F", "Deceased"), ("F", "deceased"), ("F", "Recovered "),
                                ("F", "Recovered")], "sex string, status string")
    r = an.outcome_breakdown(df).collect()[0]
    assert (r.total_cases, r.deceased, r.recovered, r.fatality_pct) == (4, 1, 1, 25.0)


def test_zero_padded_request_date_prunes_int_partitions(spark):
    # T11: '2001-03-05' (padded) matches month=3/day=5 int partition values
    from epilake.operators import serve as sv
    from epilake.session import scratch_path
    from epilake.sources import files as io
    rows = [(D(2001, 3, 5), 2001, 3, 5, 10, 10, 100, 10000.0, D(2001, 3, 6)),
            (D(2001, 3, 6), 2001, 3, 6, 1, 11, 100, 11000.0, D(2001, 3, 6))]
    df = spark.createDataFrame(rows, "date date, year int, month int, day int, new_cases_national long, "
                               "cumulative_cases_national long, population_total long, "
                               "rate_per_100k_national double, latest_date date")
    path = scratch_path(spark, "padded")
    io.write_partitioned(df, path, distribution="none")
    out = sv.summary_by_date(io.scan_partitioned_parquet(spark, path), "2001-03-05")
    assert "PartitionFilters: [" in out._jdf.queryExecution().executedPlan().toString()
    assert [r.new_cases_national for r in out.collect()] == [10]


def test_rate_decimal_overflow_is_null_not_error(spark):
    # SC2: decimal(10,2) overflow gives null instead of failing the report under ANSI
    rows = [(D(2020, 1, 1), "A", "A", 1, 5, 5_000_000, 5e11), (D(2020, 1, 1), "B", "B", 100, 1, 1, 1000.0)]
    out = {r.code: r.rate_per_100k for r in an.top_k_latest_rate(ind_rows(spark, rows), 2).collect()}
    assert out["A"] is None and float(out["B"]) == 1000.0


def test_region_indicators_scan_the_events_once(spark):
    from epilake.session import scratch_path
    path = scratch_path(spark, "once")
    spark.range(500).selectExpr(
        "CAST(id % 9 AS STRING) AS region_raw", "concat('N', id % 11) AS region_name_raw",
        "lpad(id % 9, 2, '0') AS dim_code", "concat('N', id % 9) AS dim_name", "id % 9 * 10 AS population",
        "date_add(DATE'2020-01-01', CAST(id % 40 AS INT)) AS event_date", "2020 AS year",
        "1 AS month", "1 AS day").write.parquet(path)
    df = ind.region_daily_indicators(spark.read.parquet(path))
    assert sum(r.new_cases for r in df.collect()) == 500
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "Reused" in final
