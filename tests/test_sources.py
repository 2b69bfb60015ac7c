"""Sources, sinks and keyed-table helpers on literal rows."""

import pytest
from pyspark.sql import functions as F

from epilake.plans import pipeline as pl
from epilake.schemas import DIM_SCHEMA
from epilake.session import scratch_path
from epilake.sources import files as io
from epilake.sources import tables as tb
from epilake.sources import versions as vs


def test_upsert_literal_and_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    incoming = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v long")
    once = tb.upsert_by_key(target, incoming, "k")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3), ("c", 4)]
    twice = tb.upsert_by_key(once, incoming, "k")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_last_in_batch_wins(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v long")
    incoming = spark.createDataFrame([("a", 5, 1), ("a", 7, 2)], "k string, v long, seq int")
    out = tb.upsert_by_key(target, incoming, "k", seq_col="seq").collect()
    assert [tuple(r) for r in out] == [("a", 7)]


def test_publish_upsert_new_version(spark):
    base = scratch_path(spark, "t_v1")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long").write.parquet(base)
    incoming = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v long")
    new = tb.publish_upsert(spark, base, incoming, "k", scratch_path(spark, "t_v2"))
    assert sorted(map(tuple, spark.read.parquet(new).collect())) == [("a", 1), ("b", 3), ("c", 4)]


def _months(spark, months):
    return spark.createDataFrame([(2020, m, 1, m * 10) for m in months],
                                 "year int, month int, day int, v long")


@pytest.mark.parametrize("dynamic,expected", [(False, [2]), (True, [1, 2])])
def test_static_vs_dynamic_overwrite(spark, dynamic, expected):
    path = scratch_path(spark, "ovw")
    io.write_partitioned(_months(spark, [1, 2]), path, distribution="hash")
    io.write_partitioned(_months(spark, [2]), path, distribution="hash", dynamic=dynamic)
    got = sorted(r.month for r in io.scan_partitioned_parquet(spark, path).collect())
    assert got == expected


def test_partitioned_write_one_file_per_day(spark):
    path = scratch_path(spark, "files")
    df = spark.range(0, 2000).select(
        F.lit(2020).alias("year"), F.lit(1).alias("month"),
        ((F.col("id") % 20) + 1).cast("int").alias("day"), F.col("id").alias("v"))
    io.write_partitioned(df, path, distribution="rebalance")
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files == 20


def test_write_if_absent_is_noop_second_time(spark):
    path = scratch_path(spark, "once")
    io.write_if_absent(spark.createDataFrame([(1,)], "x int"), path)
    io.write_if_absent(spark.createDataFrame([(2,), (3,)], "x int"), path)
    assert [r.x for r in spark.read.parquet(path).collect()] == [1]


def test_csv_keeps_padded_code(spark):
    path = scratch_path(spark, "dimcsv")
    spark.createDataFrame([("05", "Antioquia", 6677930), ("11", "Bogota", 7743955)],
                          DIM_SCHEMA).write.option("header", True).csv(path)
    out = sorted(r.code for r in io.scan_csv(spark, path, DIM_SCHEMA).collect())
    assert out == ["05", "11"]


def test_export_unknown_format_falls_back_to_csv(spark):
    path = scratch_path(spark, "exp")
    df = spark.createDataFrame([("05", "A", 1)], DIM_SCHEMA)
    assert io.export_table(df, path, "xlsx") == "csv"
    assert io.scan_csv(spark, path, DIM_SCHEMA).count() == 1
    assert io.export_table(df, scratch_path(spark, "exp"), "PARQUET") == "csv"


def test_contract_violations(spark):
    df = spark.createDataFrame(
        [("05", "A", 1), ("05", "B", 2), ("123", None, 3), (None, "C", None)], DIM_SCHEMA)
    r = tb.check_table_contract(df, "code", ("code", "name", "population"),
                                {"code": 2, "name": 100}).collect()[0]
    assert (r.rows, r.null_code, r.null_name, r.null_population, r.long_code,
            r.duplicate_keys) == (4, 1, 1, 1, 1, 1)


def test_register_lake_table_sees_new_partitions(spark):
    path = scratch_path(spark, "lake")
    io.write_partitioned(_months(spark, [1]), path, distribution="hash")
    name = "lake_" + path.rsplit("-", 1)[-1]
    assert tb.register_lake_table(spark, name, path).count() == 1
    io.write_partitioned(_months(spark, [2]), path, distribution="hash", dynamic=True)
    assert tb.register_lake_table(spark, name, path).count() == 2
    pruned = spark.table(name).filter("month = 2")
    assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString() \
        or pruned.count() == 1


def test_named_parameter_sql(spark):
    from epilake.operators.serve import run_sql
    spark.createDataFrame([(2001, 3, 5, 7)], "year int, month int, day int, v long") \
        .createOrReplaceTempView("t_params")
    out = run_sql(spark, "SELECT v FROM t_params WHERE year = :y AND month = :m AND day = :d",
                  y=2001, m=int("03"), d=5).collect()
    assert [r.v for r in out] == [7]


def test_ingest_dimension_versions(spark):
    csv1, csv2, root, out = (scratch_path(spark, n) for n in ("d1", "d2", "dimtbl", "dimexp"))
    spark.createDataFrame([("05", "A", 1), ("08", "B", 2)], DIM_SCHEMA).write.option("header", True).csv(csv1)
    spark.createDataFrame([("08", "B2", 3), ("11", "C", 4)], DIM_SCHEMA).write.option("header", True).csv(csv2)
    one, rep = pl.ingest_dimension(spark, csv1, root)
    assert rep.first().asDict() == {"rows": 2, "null_code": 0, "null_name": 0, "null_population": 0,
                                    "long_code": 0, "long_name": 0, "duplicate_keys": 0}
    pl.ingest_dimension(spark, csv2, root, export_path=out)
    want = [("05", "A", 1), ("08", "B2", 3), ("11", "C", 4)]
    assert sorted(map(tuple, pl.read_dimension(spark, root).collect())) == want
    assert sorted(map(tuple, spark.read.schema(DIM_SCHEMA).option("header", True).csv(out).collect())) == want
    assert vs.read(spark, root, pl.DIMENSION, one).count() == 2
    assert pl.ingest_dimension(spark, csv2, root, batch="b")[0].number == 3
    assert pl.ingest_dimension(spark, csv2, root, batch="b")[0].number == 3


def test_ingest_dimension_last_row_of_a_key_wins(spark):
    csv, root = (scratch_path(spark, n) for n in ("d3", "dimtbl3"))
    rows = [("05", "A", 1), ("8", "B", 2), ("5", "A2", 4), ("08", "B3", 5)]
    spark.createDataFrame(rows, DIM_SCHEMA).coalesce(1).write.option("header", True).csv(csv)
    rep = pl.ingest_dimension(spark, csv, root)[1]
    assert rep.first().duplicate_keys == 2
    assert sorted(map(tuple, pl.read_dimension(spark, root).collect())) == [("05", "A2", 4), ("08", "B3", 5)]


def test_ingest_dimension_takes_files_in_order_of_their_names(spark):
    from epilake.sources.versions import Folder
    csv, root = (scratch_path(spark, n) for n in ("d5", "dimtbl5"))
    # Spark reads the large file first
    Folder(spark, csv).write_once("code,name,population\n" + "".join(f"{i:02d},first,1\n" for i in range(99)), "a.csv")
    Folder(spark, csv).write_once("code,name,population\n07,second,2\n07,third,3\n", "b.csv")
    pl.ingest_dimension(spark, csv, root)
    got = {r.code: r.name for r in pl.read_dimension(spark, root).collect()}
    assert got["07"] == "third" and got["08"] == "first" and len(got) == 99


@pytest.mark.parametrize("row, broken", [(("05", None, 1), "null name"), (("123", "A", 1), "code too long"),
                                         (("05", "A", None), "null population"), ((None, "A", 1), "null code")])
def test_ingest_dimension_stops_on_violations(spark, row, broken):
    good, bad, root = (scratch_path(spark, n) for n in ("d4", "d4", "dimtbl4"))
    spark.createDataFrame([("05", "A", 1)], DIM_SCHEMA).write.option("header", True).csv(good)
    spark.createDataFrame([("08", "B", 1), row], DIM_SCHEMA).write.option("header", True).csv(bad)
    pl.ingest_dimension(spark, good, root)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    with pytest.raises(ValueError, match=broken):
        pl.ingest_dimension(spark, bad, root)
    failed = [j for j in set(tracker.getJobIdsForGroup(None)) - before if tracker.getJobInfo(j).status == "FAILED"]
    assert len(failed) == 1
    assert vs.latest(spark, root).number == 1
    assert [tuple(r) for r in pl.read_dimension(spark, root).collect()] == [("05", "A", 1)]


def test_merge_asserts_unique_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 1, 0), ("b", 2, 1)], "k string, v int, seq int")
    got = {r.k: (r.v, r.batch_rows) for r in tb.merge_by_key(target, batch, "k", "seq").collect()}
    assert got == {"a": (1, 0), "b": (2, 2)}
    with pytest.raises(Exception, match="repeated key"):
        tb.merge_by_key(target, batch, "k", "seq", unique=True).collect()


def test_upsert_keeps_a_row_with_null_sequence(spark):
    target = spark.createDataFrame([("a", 1), ("b", 9)], "k string, v int")
    batch = spark.createDataFrame([("a", 2, None), ("b", 3, None), ("b", 4, 1)], "k string, v int, seq int")
    got = sorted(map(tuple, tb.upsert_by_key(target, batch, "k", "seq").collect()))
    assert got == [("a", 2), ("b", 4)]


def test_register_follows_a_new_location_and_schema(spark):
    a, b = scratch_path(spark, "ra"), scratch_path(spark, "rb")
    spark.range(3).write.parquet(a)
    spark.range(7).selectExpr("id", "id * 2 AS twice").write.parquet(b)
    name = "moved_" + a.rsplit("-", 1)[-1]
    assert tb.register_lake_table(spark, name, a, partitioned=False).count() == 3
    moved = tb.register_lake_table(spark, name, b, partitioned=False)
    assert moved.columns == ["id", "twice"] and moved.count() == 7


def test_contract_report_counts_violations(spark):
    rows = [("05", "A", 1), ("05", "B", 2), ("123", "C", 3), ("08", None, 4),
            ("11", "x" * 101, None), (None, "D", 5)]
    df = spark.createDataFrame(rows, DIM_SCHEMA)
    r = tb.check_table_contract(df, "code", ("code", "name", "population"),
                                {"code": 2, "name": 100}).first()
    assert (r.rows, r.null_code, r.null_name, r.null_population) == (6, 1, 1, 1)
    assert (r.long_code, r.long_name, r.duplicate_keys) == (1, 1, 1)


def test_contract_report_on_empty_table(spark):
    r = tb.check_table_contract(spark.createDataFrame([], DIM_SCHEMA), "code", ("code",),
                                {"code": 2}).first()
    assert (r.rows, r.null_code, r.long_code, r.duplicate_keys) == (0, 0, 0, 0)
