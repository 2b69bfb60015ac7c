"""Property tests (random inputs, brute force in plain Python)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from epilake.operators import analytics as an
from epilake.operators import indicators as ind
from epilake.sources.files import first_n_by
from epilake.sources import tables as tb

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.date(2020, 1, 1)

events = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]),
                            st.one_of(st.none(), st.integers(0, 60))),
                  min_size=1, max_size=60)


@SETTINGS
@given(rows=events)
def test_running_total_ends_at_group_total(spark, rows):
    df = spark.createDataFrame([(c, None if d is None else BASE + dt.timedelta(days=d), 1)
                                for c, d in rows], "code string, date date, n long")
    daily = df.groupBy("code", "date").agg({"n": "sum"}).withColumnRenamed("sum(n)", "new_cases")
    out = ind.running_total(daily).collect()
    last = {}
    for r in out:
        key = (r.date is not None, r.date)
        if r.code not in last or key > last[r.code][0]:
            last[r.code] = (key, r.cumulative_cases)
    totals = {}
    for c, _ in rows:
        totals[c] = totals.get(c, 0) + 1
    assert {c: v for c, (_, v) in last.items()} == totals


@SETTINGS
@given(ages=st.lists(st.one_of(st.none(), st.integers(0, 110)), min_size=1, max_size=80))
def test_shares_sum_to_100(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    out = an.bin_share(df).collect()
    n = sum(a is not None for a in ages)
    assert sum(r.total_cases for r in out) == n
    if n:
        assert abs(float(sum(r.share_pct for r in out)) - 100.0) <= 0.005 * len(out) + 1e-9


keyed = st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 99), max_size=8)


@SETTINGS
@given(target=keyed, incoming=keyed)
def test_upsert_matches_dict_update_and_is_idempotent(spark, target, incoming):
    schema = "k string, v long"
    t = spark.createDataFrame(sorted(target.items()), schema)
    i = spark.createDataFrame(sorted(incoming.items()), schema)
    once = tb.upsert_by_key(t, i, "k")
    expect = dict(target)
    expect.update(incoming)
    assert dict(map(tuple, once.collect())) == expect
    twice = tb.upsert_by_key(once, i, "k")
    assert sorted(map(tuple, twice.collect())) == sorted(expect.items())


series = st.lists(st.integers(0, 1000), min_size=1, max_size=40, unique=True)


@SETTINGS
@given(days=series, n=st.integers(1, 9))
def test_moving_averages_match_brute_force(spark, days, n):
    pts = sorted((BASE + dt.timedelta(days=d), (d * 7) % 23) for d in days)
    df = spark.createDataFrame([(d, v, d.year, d.month, d.day) for d, v in pts],
                               "date date, new_cases long, year int, month int, day int")
    rows_avg = {r.date: r.moving_avg for r in an.moving_average(df, n).collect()}
    day_avg = {r.date: r.moving_avg for r in an.moving_average(df, n, calendar=True).collect()}
    for i, (d, _) in enumerate(pts):
        frame = [v for _, v in pts[max(0, i - n + 1): i + 1]]
        assert abs(rows_avg[d] - sum(frame) / len(frame)) < 0.0051
        cal = [v for e, v in pts if d - dt.timedelta(days=n - 1) <= e <= d]
        assert abs(day_avg[d] - sum(cal) / len(cal)) < 0.0051


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=120),
       n=st.integers(1, 130))
def test_first_n_by_matches_sorted_prefix(spark, vals, n):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, k long")
    out = first_n_by(df, n, "k").collect()
    ordered = sorted(vals, key=lambda v: (v is None, v if v is not None else 0))[:n]
    assert sorted((r.k for r in out), key=lambda v: (v is None, v if v is not None else 0)) == ordered
