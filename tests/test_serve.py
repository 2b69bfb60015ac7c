"""Serving reads and payload shaping on literal rows."""

import datetime as dt
import json

from epilake.operators import serve as sv

D = dt.date
SUMMARY = ("date date, year int, month int, day int, new_cases_national long, "
           "cumulative_cases_national long, population_total long, "
           "rate_per_100k_national double, latest_date date")


def _summary(spark, days):
    last = max(days)
    return spark.createDataFrame(
        [(d, d.year, d.month, d.day, i + 1, 10 * (i + 1), 1000, 1000.0 * (i + 1) / 3, last)
         for i, d in enumerate(sorted(days))], SUMMARY)


def test_json_envelope_is_ordered_and_keeps_nulls(spark):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 5)], "k int, s string, v int")
    body = sv.json_envelope(df, "rows", ["k", "s", "v"], "k").first().body
    assert json.loads(body) == {"rows": [["1", "a", "5"], ["2", "b", None]]}


def test_rows_as_strings_null_stays_null(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), None)], "d date, n long")
    assert sv.rows_as_strings(df, ["d", "n"]).first().row == ["2020-01-01", None]


def test_rows_as_json_writes_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(sv.rows_as_json(df, ["a", "b"]).first().json) == {"a": 1, "b": None}


def test_latest_and_last_rows(spark):
    days = [D(2020, 1, d) for d in (3, 1, 2, 5)]
    s = _summary(spark, days)
    assert sv.latest_summary(s).first().date == D(2020, 1, 5)
    assert [r.date for r in sv.last_n_rows(s, 2).collect()] == [D(2020, 1, 5), D(2020, 1, 3)]
    assert [r.date for r in sv.summary_history(s).collect()] == sorted(days)


def test_last_n_days_as_of_and_today(spark):
    today = dt.date.today()
    days = [today - dt.timedelta(days=k) for k in (0, 5, 29, 30, 31, 60)]
    s = _summary(spark, days)
    fixed = sv.last_n_days(s, 30, today)
    assert [r.date for r in fixed.collect()] == sorted(days[:4], reverse=True)
    assert [r.date for r in sv.last_n_days(s, 30).collect()] == [r.date for r in fixed.collect()]
    assert all(r.rate_national == round(r.rate_national, 2) for r in fixed.collect())


def test_preview_and_row_count(spark):
    df = spark.createDataFrame([(2020, m) for m in (3, 1, 2)], "year int, month int")
    assert [r.month for r in sv.preview_n(df, 2, ["year", "month"]).collect()] == [1, 2]
    r = sv.row_count(df).first()
    assert (r.rows, r.columns) == (3, 2)


def test_observed_count_costs_no_extra_job(spark):
    df, obs = sv.observed(spark.range(123), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 123


def test_last_n_days_of_today_prunes_years(spark, tmp_path):
    from epilake.sources import files as io
    rows = [(dt.date(y, 1, 1), y, 1, 1, 1, 1, 1.0) for y in (2019, 2020)]
    df = spark.createDataFrame(rows, "date date, year int, month int, day int, new_cases_national long, "
                                     "cumulative_cases_national long, rate_per_100k_national double")
    io.write_partitioned(df, str(tmp_path / "s"), ("year",))
    plan = sv.last_n_days(spark.read.parquet(str(tmp_path / "s")), 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
