"""End-to-end pipeline: published tables equal the registered queries, and
a rerun gives equal tables."""

from conftest import SF001
from oracle import canon

from epilake import fixture as fx
from epilake import queries as q
from epilake.plans.pipeline import PipelineConfig, read_landed_cases, run_pipeline, step_trusted
from epilake.session import scratch_path


def _rows(df):
    return canon(df.columns, [tuple(r) for r in df.collect()])


def test_pipeline_and_rerun(spark):
    base = scratch_path(spark, "pipe")
    cfg = PipelineConfig(threshold=25, origin="1995-01-01")
    cases, dim = fx.cases(spark, SF001), fx.region_dim(spark, SF001)
    res = run_pipeline(spark, cases, dim, base, cfg)
    assert res.rows["trusted"] == 1500
    ind = spark.read.parquet(res.paths["indicators"])
    assert _rows(ind) == _rows(q.indicators(spark, SF001))
    first = {k: _rows(spark.read.parquet(p)) for k, p in res.paths.items()}
    top = spark.read.parquet(res.paths["top_regions_rate"]).orderBy("rate_per_100k", ascending=False).first()
    assert (top.code, top.total_cases, float(top.rate_per_100k)) == ("12", 49, 1225.0)
    res2 = run_pipeline(spark, cases, dim, base, cfg)
    second = {k: _rows(spark.read.parquet(p)) for k, p in res2.paths.items()}
    assert first == second


def test_unreadable_values_are_counted(spark):
    """Dates, codes and ages that the trusted step cannot use, each counted once."""
    dim = fx.region_dim(spark, SF001)
    code = dim.first().code
    path = scratch_path(spark, "landed")
    rows = [(code, "1995-01-01", "40"), (code, "1995-01-01", "forty"), (code, "1995-01-01", None),
            (code, "not a date", "4o"), ("zz", "1995-01-01", "7.5")]
    spark.createDataFrame(rows, "region_raw string, report_date string, age string").write.option("header", True).csv(path)
    res = step_trusted(spark, read_landed_cases(spark, path, keep_text=True), dim, scratch_path(spark, "counted"))
    assert res.rejects == {"bad_dates": 1, "unmatched": 1, "bad_ages": 2, "malformed_lines": 0}
    got = spark.read.parquet(res.paths["trusted"])
    assert not {"age__landed", "__malformed", "reject"} & set(got.columns)
    assert sorted((r.age for r in got.collect()), key=str) == [40.0, 7.5, None, None, None]


def test_quarantine_holds_each_fault_and_counts_add_up(spark):
    from epilake.plans.pipeline import step_refined
    base, path = scratch_path(spark, "quarantine"), scratch_path(spark, "faulty")
    lines = ["region_raw,report_date,region_name_raw,age,sex,status",
             "05,2020-03-06,A,40,F,Deceased", "5,2020-03-07,A,,M,Active", "05,,A,7,M,Active",
             "05,6/3/2020,A,40,F,Deceased", "05,2020-03-06,A,forty,F,Deceased",
             "05,2020-03-06,A,40,F,Deceased,extra", "05,2020-03-06", "zz,31/31/2020,A,4o,F,Active"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
    dim = spark.createDataFrame([("05", "Antioquia", 1000)], "code string, name string, population long")
    cfg = PipelineConfig(quarantine=True)
    res = step_trusted(spark, read_landed_cases(spark, path, keep_text=True), dim, base, cfg)
    assert res.rows == {"trusted": 3, "rejected": 5}
    assert res.rejects == {"bad_dates": 2, "unmatched": 1, "bad_ages": 2, "malformed_lines": 2}
    rejected = spark.read.parquet(res.paths["rejected"]).select("reject.*").collect()
    assert sorted(r.reason for r in rejected) == ["bad_age", "bad_date", "bad_date,bad_age", "malformed_line", "malformed_line"]
    assert all(path.rsplit("/", 1)[1] in r.file for r in rejected)
    said = {r.reason: r.record for r in rejected if r.reason != "malformed_line"}
    assert '"age":"forty"' in said["bad_age"] and '"report_date":"6/3/2020"' in said["bad_date"]
    assert sorted(r.record for r in rejected if r.reason == "malformed_line") == sorted(lines[6:8])
    trusted = spark.read.parquet(res.paths["trusted"])
    assert trusted.count() == 3 and trusted.filter("reject IS NOT NULL").count() == 0
    step_refined(spark, base, cfg, res)     # the refined step reads the trusted folder
    assert spark.read.parquet(res.paths["indicators"]).agg({"new_cases": "sum"}).first()[0] == 3
