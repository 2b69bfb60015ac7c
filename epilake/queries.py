"""Registry of named queries over the driver tables, each with the DuckDB
SQL that computes the same result (the oracle).

Every query reads whole tables (through the case-record fixture views in
``epilake.fixture``); parameters are fixed here so the Spark result and the
oracle can be compared row for row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from epilake import fixture as fx
from epilake.operators import analytics as an
from epilake.operators import clean as cl
from epilake.operators import indicators as ind
from epilake.operators import serve as sv
from epilake.plans import incremental as inc
from epilake.plans import pipeline as pl
from epilake.schemas import DIM_CONTRACT, DIM_SCHEMA
from epilake.session import scratch_path, shared_dir
from epilake.sources import crawl as cw
from epilake.sources import files as io
from epilake.sources import tables as tb
from epilake.sources import versions as vs

# Fixed parameters of the registered queries (oracle SQL uses the same).
TOP_K = 10
TOP_K_ON_DATE = 3
FIXED_DATE = "2001-03-05"
THRESHOLD = 500
ORIGIN = "1995-01-01"
MOVING_WINDOW = 7
AS_OF = "2001-08-01"
LAST_DAYS = 30
LAST_ROWS = 7
PREVIEW_ROWS = 24
INGEST_ROWS = 10_000


# ---------------------------------------------------------------- builders
def trusted(spark: SparkSession, sf: str) -> DataFrame:
    return cl.trusted_cases(fx.cases(spark, sf), fx.region_dim(spark, sf))


def indicators(spark: SparkSession, sf: str) -> DataFrame:
    return ind.region_daily_indicators(trusted(spark, sf))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """National summary from the *published* indicators (as the reference's
    summary step reads the refined table): the latest-date subquery then
    scans one small column instead of recomputing the event join."""
    return ind.national_daily_summary(published_indicators(spark, sf))


# Published (date-partitioned) tables, written once per state of the input
# files and session checkpoint folder, then read by every serving query --
# the publish-once / serve-many shape of the refined layer.
_PUBLISHED: dict[tuple, tuple[str, str]] = {}


def _input_state(spark: SparkSession, sf: str) -> tuple:
    """Files, bytes and newest change of the case-record tables (a listing;
    no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        [f"{sf.rstrip('/')}/{t}.parquet" for t in ("nation", "customer", "orders")])
    return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime")).first())


def published(spark: SparkSession, sf: str, name: str,
              build: Callable[[SparkSession, str], DataFrame],
              distribution: str = "rebalance") -> tuple[DataFrame, str]:
    """Write ``build(spark, sf)`` once per state of its input as a
    date-partitioned table, register it in the session catalog, and return ``(table, path)``.

    Reads go through the catalog's partition list, so a filter on
    year/month/day lists only the matching folders.
    """
    key = (shared_dir(spark), sf.rstrip("/"), name, _input_state(spark, sf))
    hit = _PUBLISHED.get(key)
    if hit is not None:
        table, path = hit
        try:
            df = spark.table(table)
            df.schema  # noqa: B018  (fails if the table is gone)
            return df, path
        except AnalysisException:
            pass
    path = scratch_path(spark, name)
    io.write_partitioned(build(spark, sf), path, io.AGGREGATE_PARTITION_COLUMNS,
                         distribution=distribution, sort_within=("date",))
    table = f"{name}_{path.rsplit('-', 1)[-1]}"
    df = tb.register_lake_table(spark, table, path, partitioned=True)
    _PUBLISHED[key] = (table, path)
    return df, path


def published_summary(spark: SparkSession, sf: str) -> DataFrame:
    """National summary as a date-partitioned table, read back."""
    return published(spark, sf, "national_summary", summary)[0]


def published_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Region indicators as a date-partitioned table, read back."""
    return published(spark, sf, "region_indicators", indicators)[0]


def _dim_incoming(spark: SparkSession, sf: str) -> DataFrame:
    """A revised dimension batch: every nation, population from suppliers."""
    nation = fx.table(spark, sf, "nation")
    sup = (fx.table(spark, sf, "supplier").groupBy("s_nationkey")
           .agg(F.count(F.lit(1)).alias("n")))
    return (nation.join(sup, nation.n_nationkey == sup.s_nationkey, "inner")
            .select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
                    F.col("n_name").alias("name"),
                    (F.col("n") * 1000).cast("bigint").alias("population")))


# ------------------------------------------------------------ spark queries
def q_normalise_code(spark, sf):
    t = ind.region_keys(trusted(spark, sf))
    return t.select("case_id", "code", "name")


def q_date_parts(spark, sf):
    return cl.date_parts(fx.cases(spark, sf), "report_date").select(
        "case_id", "event_date", "year", "month", "day")


def q_enrich_left_join(spark, sf):
    return trusted(spark, sf).select("case_id", "region_raw", "dim_code", "dim_name", "population")


def q_unmatched_keys(spark, sf):
    return cl.unmatched_keys(fx.cases(spark, sf), fx.region_dim(spark, sf), "region_raw", "code")


def q_trusted_cases(spark, sf):
    return trusted(spark, sf)


def q_daily_counts(spark, sf):
    return ind.daily_counts(ind.region_keys(trusted(spark, sf)))


def q_running_total(spark, sf):
    return ind.running_total(ind.daily_counts(ind.region_keys(trusted(spark, sf))))


def q_rate_per_n(spark, sf):
    daily = ind.daily_counts(ind.region_keys(trusted(spark, sf)))
    totals = daily.groupBy("code", "name", "population").agg(
        F.sum("new_cases").alias("total_cases"))
    return ind.rate_per_n(totals, "total_cases", "population", "rate_per_100k")


def q_region_daily_indicators(spark, sf):
    return indicators(spark, sf)


def q_latest_per_group(spark, sf):
    return an.latest_per_group(published_indicators(spark, sf))


def q_top_k_latest_rate(spark, sf):
    return an.top_k_latest_rate(published_indicators(spark, sf), TOP_K)


def q_top_k_strict_latest(spark, sf):
    return an.top_k_strict_latest(published_indicators(spark, sf), TOP_K)


def q_top_k_on_date(spark, sf):
    d = _dt.date.fromisoformat(FIXED_DATE)
    return an.top_k_on_date(published_indicators(spark, sf), d.year, d.month, d.day,
                            TOP_K_ON_DATE)


def q_monthly_trends(spark, sf):
    return an.monthly_trends(published_indicators(spark, sf))


def q_bin_share(spark, sf):
    return an.bin_share(fx.cases(spark, sf)).withColumn("share_pct", F.col("share_pct").cast("double"))


def q_outcome_breakdown(spark, sf):
    return an.outcome_breakdown(fx.cases(spark, sf)).withColumn("fatality_pct", F.col("fatality_pct").cast("double"))


def q_first_threshold_date(spark, sf):
    return an.first_threshold_date(published_indicators(spark, sf), THRESHOLD, ORIGIN)


def q_moving_average(spark, sf):
    return an.moving_average(published_indicators(spark, sf), MOVING_WINDOW)


def q_national_rollup(spark, sf):
    return ind.national_rollup(published_indicators(spark, sf))


def q_with_latest_date(spark, sf):
    return ind.with_latest_date(published_indicators(spark, sf))


def q_national_daily_summary(spark, sf):
    return summary(spark, sf)


def q_latest_summary(spark, sf):
    return sv.latest_summary(published_summary(spark, sf))


def q_summary_by_date(spark, sf):
    return sv.summary_by_date(published_summary(spark, sf), FIXED_DATE)


def q_summary_history(spark, sf):
    return sv.summary_history(published_summary(spark, sf))


def q_last_n_rows(spark, sf):
    return sv.last_n_rows(published_summary(spark, sf), LAST_ROWS)


def q_last_n_days(spark, sf):
    return sv.last_n_days(published_summary(spark, sf), LAST_DAYS, AS_OF)


def q_rows_as_strings(spark, sf):
    hist = sv.summary_history(published_summary(spark, sf))
    return sv.rows_as_strings(hist, ["date", "new_cases_national", "cumulative_cases_national"])


def q_rows_as_json(spark, sf):
    hist = sv.summary_history(published_summary(spark, sf))
    return sv.rows_as_json(hist, ["date", "new_cases_national", "cumulative_cases_national",
                                  "population_total"])


def q_row_count(spark, sf):
    return sv.row_count(trusted(spark, sf))


def q_preview_n(spark, sf):
    return sv.preview_n(an.monthly_trends(published_indicators(spark, sf)), PREVIEW_ROWS, ["year", "month"])


def q_ingest_limit(spark, sf):
    return io.ingest_limit(fx.cases(spark, sf), INGEST_ROWS, "case_id")


def q_scan_csv(spark, sf):
    path = scratch_path(spark, "dim_csv")
    fx.region_dim(spark, sf).write.option("header", True).csv(path)
    return io.scan_csv(spark, path, DIM_SCHEMA)


def q_scan_partitioned_parquet(spark, sf):
    return io.scan_partitioned_parquet(spark, published(spark, sf, "region_indicators", indicators)[1])


def q_write_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "trusted")
    df = trusted(spark, sf)
    io.write_partitioned(df, path)
    return io.scan_partitioned_parquet(spark, path)


def q_publish_result(spark, sf):
    path = scratch_path(spark, "monthly")
    io.publish_result(an.monthly_trends(published_indicators(spark, sf)), path)
    return spark.read.parquet(path)


def q_write_if_absent(spark, sf):
    path = scratch_path(spark, "dim_once")
    io.write_if_absent(fx.region_dim(spark, sf), path)
    io.write_if_absent(_dim_incoming(spark, sf), path)  # no-op: path exists
    return spark.read.parquet(path)


def q_upsert_by_key(spark, sf):
    base = scratch_path(spark, "dim_v1")
    fx.region_dim(spark, sf).write.parquet(base)
    new = tb.publish_upsert(spark, base, _dim_incoming(spark, sf), "code",
                            scratch_path(spark, "dim_v2"))
    return spark.read.parquet(new)


def q_ingest_dimension(spark, sf):
    """A first version from the dimension, then a landed file with unpadded
    and repeated codes, whose last row counts."""
    first, second, base = (scratch_path(spark, n) for n in ("dim_csv", "dim_csv", "dim"))
    fx.region_dim(spark, sf).write.option("header", True).csv(first)
    pl.ingest_dimension(spark, first, base)
    batch = _dim_incoming(spark, sf)
    early = batch.select(F.col("code").cast("int").cast("string").alias("code"), "name",
                         F.lit(1).cast("bigint").alias("population"), F.lit(0).alias("nr"))
    # one file: the order of its rows decides
    (early.unionByName(batch.withColumn("nr", F.lit(1))).coalesce(1).sortWithinPartitions("nr").drop("nr")
     .write.option("header", True).csv(second))
    pl.ingest_dimension(spark, second, base)
    return pl.read_dimension(spark, base)


def q_check_table_contract(spark, sf):
    return tb.check_table_contract(fx.region_dim(spark, sf), DIM_CONTRACT["key"],
                                   DIM_CONTRACT["not_null"], DIM_CONTRACT["max_length"])


def q_export_table(spark, sf):
    base = scratch_path(spark, "export")
    daily = ind.daily_counts(ind.region_keys(trusted(spark, sf)))
    paths = io.export_tables({"daily_counts": daily}, base, fmt="csv")
    return io.scan_csv(spark, paths["daily_counts"], daily.schema)


def q_register_lake_tables(spark, sf):
    path = scratch_path(spark, "summary_tbl")
    io.write_partitioned(summary(spark, sf), path, io.AGGREGATE_PARTITION_COLUMNS,
                         sort_within=("date",))
    name = "national_summary_" + path.rsplit("-", 1)[-1]
    return tb.register_lake_table(spark, name, path, partitioned=True)


def q_crawl_lake(spark, sf):
    """Three tables below one folder, registered in one go; then one gets a
    later column, one loses and gains partitions; crawled again, and a third
    time, which finds nothing to do."""
    root = scratch_path(spark, "lake")
    db = "lake_" + root.rsplit("-", 1)[-1]
    indic = published_indicators(spark, sf)
    io.write_partitioned(indic.filter("year IS NULL OR year <= 2000"), f"{root}/refined/indicators", ["year"])
    fx.region_dim(spark, sf).write.parquet(f"{root}/raw/regions")
    io.publish_result(an.monthly_trends(indic), f"{root}/refined/monthly")
    cw.crawl(spark, root, db)
    io.write_partitioned(indic.filter("year >= 1994"), f"{root}/refined/indicators", ["year"])
    _dim_incoming(spark, sf).withColumn("note", F.lit("revised")).write.mode("append").parquet(f"{root}/raw/regions")
    cw.crawl(spark, root, db)
    again = {r["action"] for r in cw.crawl(spark, root, db).collect()}
    if again != {"unchanged"}:
        raise RuntimeError(f"an unchanged lake was changed: {again}")
    return spark.sql(f"""
        SELECT 'indicators' AS source, year, count(*) AS rows, sum(new_cases) AS value, 0L AS noted
        FROM {db}.indicators GROUP BY year
        UNION ALL SELECT 'regions', CAST(NULL AS INT), count(*), sum(population), count(note) FROM {db}.regions
        UNION ALL SELECT 'monthly', year, count(*), sum(monthly_cases), 0L FROM {db}.monthly GROUP BY year""")


def q_publish_by_commit(spark, sf):
    """Two tables in one commit, then a commit that replaces some years of
    one of them; read through the latest commit."""
    root, indic = scratch_path(spark, "commits"), published_indicators(spark, sf)
    early = indic.filter("year IS NULL OR year < 1996").withColumn("new_cases", F.col("new_cases"))
    stale = indic.filter("year >= 1996").withColumn("new_cases", F.lit(0).cast("bigint"))
    vs.publish(spark, root, {"monthly": vs.Change(an.monthly_trends(indic)),
                             "indicators": vs.Change(early.unionByName(stale), ["year"])})
    vs.publish(spark, root, {"indicators": vs.Change(indic.filter("year >= 1996"), ["year"], "parts")})
    return vs.read(spark, root, "indicators")


def q_upsert_buckets(spark, sf):
    root = scratch_path(spark, "dim_buckets")
    for nr, batch in enumerate((fx.region_dim(spark, sf), _dim_incoming(spark, sf))):
        tb.upsert_buckets(spark, root, "regions", batch.withColumn("seq", F.lit(nr)), "code", "seq", buckets=8)
    return tb.read_buckets(spark, root, "regions")


def q_incremental_totals(spark, sf):
    """Most events first, then late ones of the last years, then late ones
    of all years and without a date; each batch sent twice."""
    root, events = scratch_path(spark, "totals"), trusted(spark, sf)
    late = F.col("case_id") % 5 == 0
    recent = F.coalesce(F.col("year") >= 2000, F.lit(False))
    for name, part in (("first", ~late), ("recent", late & recent), ("late", late & ~recent)):
        for _ in range(2):
            inc.add_events(spark, root, events.filter(part), batch=name)
    return inc.indicators(spark, root)


def q_compact_parts(spark, sf):
    """Indicators appended day by day of the week, then compacted."""
    root, indic = scratch_path(spark, "small_files"), published_indicators(spark, sf)
    for day in range(4):
        part = indic.filter(F.coalesce(F.col("day"), F.lit(0)) % 4 == day)
        vs.publish(spark, root, {"indicators": vs.Change(part, ["year"], "append")})
    vs.compact(spark, root, "indicators", sort_within=("date",))
    return vs.read(spark, root, "indicators")


def q_quarantine(spark, sf):
    """Landed lines, some with faults; every record with the reason, if any,
    for which it is apart from the trusted table."""
    path = scratch_path(spark, "faulty_csv")
    columns = ["case_id", "report_date", "region_raw", "region_name_raw", "age", "sex", "status"]
    fault = F.col("case_id") % 1000
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
    said["report_date"] = F.when(fault.isin(1, 5), "31/31/2020").otherwise(said["report_date"])
    said["age"] = F.when(fault.isin(2, 5), "unknown").otherwise(said["age"])
    line = F.concat_ws(",", *said.values())
    line = (F.when(fault == 3, F.concat(line, F.lit(",extra")))
            .when(fault == 4, F.concat_ws(",", said["case_id"], said["report_date"])).otherwise(line))
    fx.cases(spark, sf).select(line.alias("line")).write.text(path)
    cases = pl.read_landed_cases(spark, path, keep_text=True, columns=columns)
    res = pl.step_trusted(spark, cases, fx.region_dim(spark, sf), scratch_path(spark, "quarantined"),
                          pl.PipelineConfig(quarantine=True))
    kept, apart = (io.scan_partitioned_parquet(spark, res.paths[p]) for p in ("trusted", "rejected"))
    return kept.unionByName(apart).select("case_id", F.col("reject.reason").alias("reason"))


def q_enrich_large_dimension(spark, sf):
    return cl.trusted_cases(fx.cases(spark, sf), fx.region_dim(spark, sf), large_dim=True).select(
        "case_id", "region_raw", "dim_code", "dim_name", "population")


def _landed_cases(spark, sf, keep_text=False):
    """The cases written as a landed CSV file with a header row."""
    path = scratch_path(spark, "cases_csv")
    fx.cases(spark, sf).write.option("header", True).csv(path)
    return pl.read_landed_cases(spark, path, keep_text=keep_text)


def q_scan_cases_csv(spark, sf):
    return _landed_cases(spark, sf)


def q_run_pipeline(spark, sf):
    """The three steps from the landed CSV; what the last one published."""
    res = pl.run_pipeline(spark, _landed_cases(spark, sf, keep_text=True), fx.region_dim(spark, sf),
                          scratch_path(spark, "steps"), pl.PipelineConfig(run_analytics=False))
    return io.scan_partitioned_parquet(spark, res.paths["summary"])


def q_run_analytics(spark, sf):
    """The first two steps with the reports on; one that they published."""
    base = scratch_path(spark, "reports")
    res = pl.step_trusted(spark, fx.cases(spark, sf), fx.region_dim(spark, sf), base)
    pl.step_refined(spark, base, pl.PipelineConfig(), res)
    return spark.read.parquet(res.paths["monthly_trends"])


def q_trusted_source_columns(spark, sf):
    """The trusted step under the source's names, from a landed CSV in the
    source's layout: all its columns, those the fixture has no data for null."""
    from epilake.cli import SOURCE_LAYOUT, SOURCE_NAMES
    raw = scratch_path(spark, "source_csv")
    back = {c: n for n, c in SOURCE_LAYOUT["rename"].items()}
    (fx.cases(spark, sf).withColumnsRenamed({**back, "status": "estado"})
     .write.option("header", True).csv(raw))
    res = pl.step_trusted(spark, pl.read_landed_cases(spark, raw, SOURCE_LAYOUT["rename"], keep_text=True),
                          fx.region_dim(spark, sf), scratch_path(spark, "source_trusted"),
                          pl.PipelineConfig(**SOURCE_NAMES))
    return io.scan_partitioned_parquet(spark, res.paths["trusted"])


_PAYLOAD = ["date", "new_cases_national", "cumulative_cases_national", "population_total", "latest_date"]


def q_serving_payload(spark, sf):
    s = published_summary(spark, sf)
    latest = sv.json_envelope(sv.latest_summary(s), "latest", _PAYLOAD, "date")
    return latest.unionByName(sv.json_envelope(sv.summary_by_date(s, FIXED_DATE), "by_date", _PAYLOAD, "date"))


def q_run_sql(spark, sf):
    """SQL text with bound parameters over a registered table."""
    name = "serving_summary"
    published_summary(spark, sf).createOrReplaceTempView(name)
    return sv.run_sql(
        spark, "SELECT date, new_cases_national, cumulative_cases_national, "
               "round(rate_per_100k_national, 2) AS rate_national FROM IDENTIFIER(:name) "
               "WHERE date >= date_sub(CAST(:as_of AS DATE), :days) ORDER BY date DESC",
        name=name, as_of=AS_OF, days=LAST_DAYS)


# ------------------------------------------------------------ oracle SQL
def r2(x: str) -> str:
    """DuckDB: round a double half-up on its shortest decimal text, as
    Spark does (a plain ROUND works on the binary value)."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def dec2(x: str) -> str:
    """DuckDB: double -> DECIMAL(10,2) the way Spark casts it."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)) AS DECIMAL(10,2))"


def pct2(num: str, den: str) -> str:
    """DuckDB: exact half-up round(num * 100 / den, 2) of integers, as double."""
    return f"CAST((20000 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / 100.0"


_CODE = "lpad(CAST(region_raw AS VARCHAR), 2, '0')"
_LATEST = ("row_number() OVER (PARTITION BY code ORDER BY date DESC NULLS LAST, "
           "name DESC NULLS LAST)")
_SUMMARY_SERVE = ("date, new_cases_national, cumulative_cases_national, population_total, "
                  "rate_per_100k_national, latest_date")

# The ranges of functions/columns.py.
_BINS = """CASE WHEN age < 18 THEN '0-17' WHEN age BETWEEN 18 AND 29 THEN '18-29'
  WHEN age BETWEEN 30 AND 49 THEN '30-49' WHEN age BETWEEN 50 AND 64 THEN '50-64'
  WHEN age >= 65 THEN '65+' ELSE 'Unknown' END"""

_MONTHLY = f"""SELECT year, month, CAST(sum(new_cases) AS BIGINT) AS monthly_cases,
  count(DISTINCT code) AS regions_reporting, {r2('avg(new_cases)')} AS avg_daily_cases
FROM indicators GROUP BY year, month"""

_DAILY_COLS = "date, year, month, day, code, name, population, new_cases"

_UPSERT = """WITH incoming AS (
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name,
       CAST(n * 1000 AS BIGINT) AS population
    FROM nation JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s
     ON n_nationkey = s.s_nationkey)
  SELECT * FROM incoming
  UNION ALL SELECT * FROM region_dim d WHERE d.code NOT IN (SELECT code FROM incoming)"""

# Columns of the source's case file that the fixture has no data for.
_NOT_IN_FIXTURE = ("fecha_de_notificaci_n", "codigo_divipola_municipio", "nombre_municipio", "unidad_medida",
                   "fuente_tipo_contagio", "ubicacion", "pais_viajo_1_cod", "pais_viajo_1_nom", "recuperado",
                   "fecha_inicio_sintomas", "fecha_muerte", "fecha_diagnostico", "fecha_recuperado",
                   "tipo_recuperacion", "per_etn_", "nom_grupo_")

SQL: dict[str, str] = {
    "normalise_code": f"SELECT case_id, coalesce(dim_code, {_CODE}) AS code, "
                      "coalesce(dim_name, region_name_raw) AS name FROM trusted",
    "date_parts": "SELECT case_id, event_date, year, month, day FROM trusted",
    "enrich_left_join": "SELECT case_id, region_raw, dim_code, dim_name, population FROM trusted",
    "unmatched_keys": f"""SELECT {_CODE} AS code, count(*) AS events FROM cases c
        WHERE NOT EXISTS (SELECT 1 FROM region_dim d WHERE d.code = {_CODE}) GROUP BY 1""",
    "trusted_cases": "SELECT * FROM trusted",
    "daily_counts": f"SELECT {_DAILY_COLS} FROM daily",
    "running_total": f"SELECT {_DAILY_COLS}, cumulative_cases FROM running",
    "rate_per_n": """SELECT code, name, population, total_cases,
        CASE WHEN population > 0 THEN CAST(total_cases AS DOUBLE) * 100000.0::DOUBLE / population
        END AS rate_per_100k
      FROM (SELECT code, name, population, CAST(sum(new_cases) AS BIGINT) AS total_cases
            FROM daily GROUP BY code, name, population)""",
    "region_daily_indicators": "SELECT * FROM indicators",
    "latest_per_group": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, {_LATEST} AS rn FROM indicators)
        WHERE rn = 1""",
    "top_k_latest_rate": f"""SELECT code, name, {dec2('rate_per_100k')} AS rate_per_100k,
        cumulative_cases AS total_cases, date AS last_date
      FROM (SELECT *, {_LATEST} AS rn FROM indicators WHERE rate_per_100k IS NOT NULL)
      WHERE rn = 1 ORDER BY rate_per_100k DESC NULLS LAST, code ASC LIMIT {TOP_K}""",
    "top_k_strict_latest": f"""SELECT code, name, {r2('rate_per_100k')} AS rate_per_100k,
        cumulative_cases AS total_cases
      FROM (SELECT *, {_LATEST} AS rn FROM indicators)
      WHERE rn = 1 AND rate_per_100k IS NOT NULL
      ORDER BY rate_per_100k DESC NULLS LAST, code ASC LIMIT {TOP_K}""",
    "top_k_on_date": f"""SELECT code, name, {dec2('rate_per_100k')} AS rate_per_100k,
        cumulative_cases AS total_cases FROM indicators
      WHERE year = 2001 AND month = 3 AND day = 5
      ORDER BY rate_per_100k DESC NULLS LAST, code ASC LIMIT {TOP_K_ON_DATE}""",
    "monthly_trends": _MONTHLY,
    "bin_share": f"""SELECT age_group, total_cases,
        {pct2('total_cases', 'sum(total_cases) OVER ()')} AS share_pct
      FROM (SELECT {_BINS} AS age_group, count(*) AS total_cases FROM cases
            WHERE age IS NOT NULL GROUP BY 1)""",
    "outcome_breakdown": f"""SELECT coalesce(sex, 'Not reported') AS sex, total_cases, deceased,
        recovered, {pct2('deceased', 'total_cases')} AS fatality_pct
      FROM (SELECT sex, count(*) AS total_cases,
                   count(*) FILTER (WHERE status = 'Deceased') AS deceased,
                   count(*) FILTER (WHERE status = 'Recovered') AS recovered
            FROM cases GROUP BY sex)""",
    "first_threshold_date": f"""SELECT code, name, min(date) AS first_date,
        CAST(date_diff('day', DATE '{ORIGIN}', min(date)) AS INTEGER) AS days_since_origin
      FROM indicators WHERE cumulative_cases >= {THRESHOLD} GROUP BY code, name""",
    "moving_average": f"""SELECT date, new_cases_national, {r2('avg7')} AS moving_avg FROM (
        SELECT date, CAST(sum(new_cases) AS BIGINT) AS new_cases_national,
               avg(sum(new_cases)) OVER (ORDER BY date ASC NULLS FIRST
                   ROWS BETWEEN {MOVING_WINDOW - 1} PRECEDING AND CURRENT ROW) AS avg7
        FROM indicators GROUP BY date)""",
    "national_rollup": "SELECT * FROM national",
    "with_latest_date": "SELECT *, (SELECT max(date) FROM indicators) AS latest_date FROM indicators",
    "national_daily_summary": "SELECT * FROM summary",
    "latest_summary": f"SELECT {_SUMMARY_SERVE} FROM summary ORDER BY date DESC NULLS LAST LIMIT 1",
    "summary_by_date": f"""SELECT {_SUMMARY_SERVE} FROM summary
        WHERE year = 2001 AND month = 3 AND day = 5 LIMIT 1""",
    "summary_history": """SELECT date, new_cases_national, cumulative_cases_national,
        population_total, rate_per_100k_national FROM summary""",
    "last_n_rows": f"""SELECT date, new_cases_national, cumulative_cases_national FROM summary
        ORDER BY date DESC NULLS LAST LIMIT {LAST_ROWS}""",
    "last_n_days": f"""SELECT date, new_cases_national, cumulative_cases_national,
        {r2('rate_per_100k_national')} AS rate_national FROM summary
      WHERE date >= DATE '{AS_OF}' - INTERVAL {LAST_DAYS} DAY""",
    "rows_as_strings": """SELECT [CAST(date AS VARCHAR), CAST(new_cases_national AS VARCHAR),
        CAST(cumulative_cases_national AS VARCHAR)] AS row FROM summary""",
    "rows_as_json": """SELECT CAST(json_object('date', date, 'new_cases_national', new_cases_national,
        'cumulative_cases_national', cumulative_cases_national,
        'population_total', population_total) AS VARCHAR) AS json FROM summary""",
    "row_count": """SELECT count(*) AS rows,
        (SELECT CAST(len(json_keys(to_json(t))) AS INT) FROM trusted t LIMIT 1) AS columns FROM trusted""",
    "preview_n": f"""{_MONTHLY} ORDER BY year ASC NULLS FIRST, month ASC NULLS FIRST
        LIMIT {PREVIEW_ROWS}""",
    "ingest_limit": f"SELECT * FROM cases ORDER BY case_id LIMIT {INGEST_ROWS}",
    "scan_csv": "SELECT * FROM region_dim",
    "scan_partitioned_parquet": "SELECT * FROM indicators",
    "write_partitioned_roundtrip": "SELECT * FROM trusted",
    "publish_result": _MONTHLY,
    "write_if_absent": "SELECT * FROM region_dim",
    "upsert_by_key": _UPSERT,
    "ingest_dimension": _UPSERT,
    "check_table_contract": """SELECT CAST(count(*) AS BIGINT) AS rows,
        CAST(count(*) FILTER (WHERE code IS NULL) AS BIGINT) AS null_code,
        CAST(count(*) FILTER (WHERE name IS NULL) AS BIGINT) AS null_name,
        CAST(count(*) FILTER (WHERE population IS NULL) AS BIGINT) AS null_population,
        CAST(count(*) FILTER (WHERE length(code) > 2) AS BIGINT) AS long_code,
        CAST(count(*) FILTER (WHERE length(name) > 100) AS BIGINT) AS long_name,
        (SELECT count(*) FROM (SELECT code FROM region_dim WHERE code IS NOT NULL
                               GROUP BY code HAVING count(*) > 1)) AS duplicate_keys
      FROM region_dim""",
    "export_table": f"SELECT {_DAILY_COLS} FROM daily",
    "register_lake_tables": "SELECT * FROM summary",
    "scan_cases_csv": """SELECT CAST(case_id AS VARCHAR) AS case_id,
        CAST(report_date AS VARCHAR) AS report_date, CAST(region_raw AS VARCHAR) AS region_raw,
        region_name_raw, CAST(age AS DOUBLE) AS age, sex, status FROM cases""",
    "run_pipeline": "SELECT * FROM summary",
    "run_analytics": _MONTHLY,
    "trusted_source_columns": f"""SELECT CAST(case_id AS VARCHAR) AS id_de_caso,
        CAST(report_date AS VARCHAR) AS fecha_reporte_web, event_date AS fecha_reporte_web_date,
        year AS anio, month AS mes, day AS dia,
        CAST(region_raw AS VARCHAR) AS codigo_divipola_departamento,
        region_name_raw AS departamento_nom, CAST(age AS DOUBLE) AS edad, sex AS sexo, status AS estado,
        dim_code AS codigo_departamento, dim_name AS departamento_nombre_normalizado, population AS poblacion,
        {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NOT_IN_FIXTURE)} FROM trusted""",
    "serving_payload": "".join(
        f"""{sep}(SELECT to_json({{'{name}': [[CAST(date AS VARCHAR), CAST(new_cases_national AS VARCHAR),
        CAST(cumulative_cases_national AS VARCHAR), CAST(population_total AS VARCHAR),
        CAST(latest_date AS VARCHAR)]]}})::VARCHAR AS body FROM summary {which} LIMIT 1)"""
        for sep, name, which in (("", "latest", "ORDER BY date DESC NULLS LAST"),
                                 (" UNION ALL ", "by_date", f"WHERE date = DATE '{FIXED_DATE}'"))),
    "crawl_lake": f"""WITH incoming AS (SELECT CAST(n * 1000 AS BIGINT) AS population FROM nation
          JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON n_nationkey = s.s_nationkey)
      SELECT 'indicators' AS source, year, count(*) AS rows, CAST(sum(new_cases) AS BIGINT) AS value,
        CAST(0 AS BIGINT) AS noted FROM indicators WHERE year >= 1994 GROUP BY year
      UNION ALL SELECT 'regions', NULL, (SELECT count(*) FROM region_dim) + (SELECT count(*) FROM incoming),
        CAST((SELECT sum(population) FROM region_dim) + (SELECT sum(population) FROM incoming) AS BIGINT),
        (SELECT count(*) FROM incoming)
      UNION ALL SELECT 'monthly', year, count(*), CAST(sum(monthly_cases) AS BIGINT), 0 FROM ({_MONTHLY}) GROUP BY year""",
    "publish_by_commit": "SELECT * FROM indicators",
    "upsert_buckets": _UPSERT,
    "incremental_totals": "SELECT * FROM indicators",
    "compact_parts": "SELECT * FROM indicators",
    "quarantine": """SELECT CAST(case_id AS VARCHAR) AS case_id, CASE case_id % 1000 WHEN 1 THEN 'bad_date'
        WHEN 2 THEN 'bad_age' WHEN 5 THEN 'bad_date,bad_age' WHEN 3 THEN 'malformed_line'
        WHEN 4 THEN 'malformed_line' END AS reason FROM cases""",
    "enrich_large_dimension": "SELECT case_id, region_raw, dim_code, dim_name, population FROM trusted",
    "run_sql": f"""SELECT date, new_cases_national, cumulative_cases_national,
        {r2('rate_per_100k_national')} AS rate_national FROM summary
      WHERE date >= DATE '{AS_OF}' - INTERVAL {LAST_DAYS} DAY""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn)
}

# Row order that is part of a query's answer: columns, "-" for descending
# (nulls first ascending and last descending).
ORDER = {
    "top_k_latest_rate": "-rate_per_100k code", "top_k_strict_latest": "-rate_per_100k code",
    "top_k_on_date": "-rate_per_100k code", "monthly_trends": "year month", "preview_n": "year month",
    "bin_share": "-total_cases", "outcome_breakdown": "-total_cases", "first_threshold_date": "first_date",
    "moving_average": "-date", "summary_history": "date", "last_n_rows": "-date", "last_n_days": "-date",
    "run_sql": "-date",
}


def oracle_sql() -> dict[str, str]:
    """Oracle text per query key, with the fixture views prefixed."""
    return {k: fx.with_fixture(v) for k, v in SQL.items()}
