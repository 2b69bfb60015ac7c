"""A lake folder registered in one go and followed as it changes."""

from pyspark.sql import functions as F

from epilake.session import scratch_path
from epilake.sources import crawl as cw


def report(df):
    return {r.table: r for r in df.collect()}


def ddl_count(spark, monkeypatch, work):
    said, sql = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), sql(q, *a, **k))[1])
    out = work()
    monkeypatch.undo()
    return out, [q for q in said if q.split()[0] in ("CREATE", "ALTER", "DROP", "MSCK")]


def test_crawl_follows_a_lake(spark, monkeypatch):
    root, db = scratch_path(spark, "lake"), "crawl_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    base = spark.range(60).selectExpr("id", "CAST(2000 + id % 3 AS INT) AS year", "CAST(id % 2 AS INT) AS half")
    base.write.partitionBy("year", "half").parquet(f"{root}/deep/by_date")
    spark.range(5).selectExpr("id", "'x' AS v").write.parquet(f"{root}/flat")
    named = spark.createDataFrame([(1, "a b/c"), (2, None), (3, "o'x")], "id int, town string")
    named.write.partitionBy("town").parquet(f"{root}/towns")
    got, ddl = ddl_count(spark, monkeypatch, lambda: report(cw.crawl(spark, root, db)))
    assert {t: r.action for t, r in got.items()} == {f"{db}.{n}": "created" for n in ("by_date", "flat", "towns")}
    assert got[f"{db}.by_date"].partitions_added == 6 and ddl
    assert spark.table(f"{db}.by_date").filter("year = 2001").count() == 20
    assert sorted(map(str, (r.town for r in spark.table(f"{db}.towns").collect()))) == ["None", "a b/c", "o'x"]
    assert dict(spark.table(f"{db}.by_date").dtypes)["year"] == "int"

    got, ddl = ddl_count(spark, monkeypatch, lambda: report(cw.crawl(spark, root, db)))
    assert {r.action for r in got.values()} == {"unchanged"} and ddl == []

    # a later column, new and vanished partitions, towns with quotes and null gone
    spark.range(5, 8).selectExpr("id", "'y' AS v", "id * 1.5D AS w").write.mode("append").parquet(f"{root}/flat")
    (base.filter("year <> 2000").unionByName(base.withColumn("year", F.col("year") + 10))
     .write.mode("overwrite").partitionBy("year", "half").parquet(f"{root}/deep/by_date"))
    named.filter("id = 1").write.mode("overwrite").partitionBy("town").parquet(f"{root}/towns")
    got = report(cw.crawl(spark, root, db))
    assert {r.action for r in got.values()} == {"changed"}
    assert (got[f"{db}.by_date"].partitions_added, got[f"{db}.by_date"].partitions_dropped) == (6, 2)
    assert got[f"{db}.towns"].partitions_dropped == 2 and got[f"{db}.flat"].columns_added == ["w"]
    assert spark.table(f"{db}.by_date").count() == 100 and spark.table(f"{db}.towns").count() == 1
    assert sorted((r.id, r.w) for r in spark.table(f"{db}.flat").collect())[-1] == (7, 10.5)
    got, ddl = ddl_count(spark, monkeypatch, lambda: report(cw.crawl(spark, root, db)))
    assert {r.action for r in got.values()} == {"unchanged"} and ddl == []


def test_crawl_reports_what_it_leaves_alone(spark):
    root, db = scratch_path(spark, "lake"), "crawl_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    spark.range(5).write.parquet(f"{root}/a")
    spark.range(5).selectExpr("id", "id AS k").write.partitionBy("k").parquet(f"{root}/mixed")
    spark.range(2).write.parquet(f"{root}/mixed/loose=1/other=2")
    cw.crawl(spark, root, db)
    spark.range(5).selectExpr("CAST(id AS STRING) AS id").write.mode("append").parquet(f"{root}/a")
    got = report(cw.crawl(spark, root, db))
    assert got[f"{db}.a"].action == got[f"{db}.mixed"].action == "conflict" and not spark.catalog.tableExists(f"{db}.mixed")
    assert dict(spark.table(f"{db}.a").dtypes)["id"] == "bigint"
    spark.range(0).write.mode("overwrite").parquet(f"{root}/a")
    empty = report(cw.crawl(spark, root, db))
    assert empty[f"{db}.a"].action in ("changed", "absent")
