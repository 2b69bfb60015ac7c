"""Incremental ingest: each landed file is processed exactly once."""

from epilake.schemas import CASES_SCHEMA
from epilake.session import scratch_path
from epilake.streaming.ingest import incremental_trusted


def _land(spark, path, rows):
    spark.createDataFrame(rows, CASES_SCHEMA).coalesce(1).write.mode("append") \
        .option("header", True).csv(path)


def test_incremental_ingest_exactly_once(spark):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "trusted_s", "ckpt_s"))
    dim = spark.createDataFrame([("05", "Antioquia", 1000)], "code string, name string, population long")
    _land(spark, landing, [(1, "2020-03-06", "5", "ANT", 30, "F", "Active"),
                           (2, "not a date", "99", "X", None, None, "Active")])
    incremental_trusted(spark, landing, CASES_SCHEMA, dim, out, ckpt).awaitTermination()
    first = spark.read.parquet(out)
    assert first.count() == 2
    _land(spark, landing, [(3, "2020-03-07", "05", "ANT", 40, "M", "Deceased")])
    incremental_trusted(spark, landing, CASES_SCHEMA, dim, out, ckpt).awaitTermination()
    incremental_trusted(spark, landing, CASES_SCHEMA, dim, out, ckpt).awaitTermination()  # no new files
    rows = {r.case_id: r for r in spark.read.parquet(out).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1].dim_name == "Antioquia" and rows[3].dim_name == "Antioquia"
    assert rows[2].dim_name is None and rows[2].event_date is None and rows[2].year is None


def test_incremental_ingest_one_file_per_date_per_batch(spark):
    import os
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing2", "trusted_s2", "ckpt_s2"))
    dim = spark.createDataFrame([("05", "Antioquia", 1000)], "code string, name string, population long")
    for i in range(3):  # three landed files, each with both dates
        _land(spark, landing, [(10 * i + 1, "2020-03-06", "5", "ANT", 30, "F", "Active"),
                               (10 * i + 2, "2020-03-07", "5", "ANT", 31, "M", "Active")])
    incremental_trusted(spark, landing, CASES_SCHEMA, dim, out, ckpt, num_writers=4).awaitTermination()
    assert spark.read.parquet(out).count() == 6
    per_day = [len([f for f in fs if f.endswith(".parquet")]) for d, _, fs in os.walk(out.replace("file:", ""))
               if os.path.basename(d).startswith("day=")]
    assert per_day == [1, 1]
