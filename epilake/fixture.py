"""Case-record views over the driver's TPC-H-style tables.

The driver data has no case records, so they are derived, identically in
Spark (here) and in the DuckDB oracle (``FIXTURE_SQL``):

- ``region_dim(code, name, population)``: one row per nation that has
  customers, except nations 7 and 21 (left out so that some events do not
  match); nation 3 gets population 0 (exercises the rate guard).
- ``cases``: one event per order, region = the customer's nation as an
  unpadded int; some dates, ages and sexes are nulled by fixed rules.

Both derive from whole tables; their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture (same in FIXTURE_SQL below).
MISSING_REGIONS = (7, 21)
ZERO_POPULATION_REGION = 3
POPULATION_PER_CUSTOMER = 1000
NULL_DATE_EVERY = 997
NULL_AGE_EVERY = 13
AGE_MODULUS = 97
NULL_SEX_EVERY = 7
STATUS_LABELS = {"F": "Deceased", "O": "Recovered"}
STATUS_OTHER = "Active"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed region dimension: padded string code, name, population."""
    nation = table(spark, sf_dir, "nation")
    per_nation = (table(spark, sf_dir, "customer").groupBy("c_nationkey")
                  .agg(F.count(F.lit(1)).alias("cnt")))
    joined = nation.join(per_nation, nation.n_nationkey == per_nation.c_nationkey, "inner")
    return (joined.filter(~F.col("n_nationkey").isin(*MISSING_REGIONS))
            .select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
                    F.col("n_name").alias("name"),
                    F.when(F.col("n_nationkey") == ZERO_POPULATION_REGION, F.lit(0))
                    .otherwise(F.col("cnt") * POPULATION_PER_CUSTOMER).cast("bigint")
                    .alias("population")))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event records: one per order, joined to its customer's nation."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    status = F.when(F.col("o_orderstatus") == "F", F.lit(STATUS_LABELS["F"])) \
        .when(F.col("o_orderstatus") == "O", F.lit(STATUS_LABELS["O"])) \
        .otherwise(F.lit(STATUS_OTHER))
    return j.select(
        F.col("o_orderkey").alias("case_id"),
        F.when(F.col("o_orderkey") % NULL_DATE_EVERY == 0, F.lit(None))
        .otherwise(F.to_date("o_orderdate")).alias("report_date"),
        F.col("c_nationkey").alias("region_raw"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("region_name_raw"),
        F.when(F.col("o_orderkey") % NULL_AGE_EVERY == 0, F.lit(None))
        .otherwise(F.col("o_orderkey") % AGE_MODULUS).cast("int").alias("age"),
        F.when(F.col("o_custkey") % NULL_SEX_EVERY == 0, F.lit(None))
        .when(F.col("o_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        status.alias("status"),
    )


# DuckDB text of the same two views, prefixed to every oracle query.
FIXTURE_SQL = """
region_dim AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name,
         CAST(CASE WHEN n_nationkey = 3 THEN 0 ELSE cnt * 1000 END AS BIGINT) AS population
  FROM nation JOIN (SELECT c_nationkey AS k, count(*) AS cnt FROM customer GROUP BY c_nationkey) x
       ON n_nationkey = x.k
  WHERE n_nationkey NOT IN (7, 21)
),
cases AS (
  SELECT o_orderkey AS case_id,
         CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS report_date,
         c_nationkey AS region_raw,
         'N' || CAST(c_nationkey AS VARCHAR) AS region_name_raw,
         CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 97 END AS INT) AS age,
         CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
         CASE o_orderstatus WHEN 'F' THEN 'Deceased' WHEN 'O' THEN 'Recovered' ELSE 'Active' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey
),
trusted AS (
  SELECT c.*, c.report_date AS event_date,
         CAST(year(c.report_date) AS INT) AS year, CAST(month(c.report_date) AS INT) AS month,
         CAST(day(c.report_date) AS INT) AS day,
         d.code AS dim_code, d.name AS dim_name, d.population
  FROM cases c LEFT JOIN region_dim d ON lpad(CAST(c.region_raw AS VARCHAR), 2, '0') = d.code
),
daily AS (
  SELECT event_date AS date, year, month, day,
         coalesce(dim_code, lpad(CAST(region_raw AS VARCHAR), 2, '0')) AS code,
         coalesce(dim_name, region_name_raw) AS name, population,
         count(*) AS new_cases
  FROM trusted GROUP BY ALL
),
running AS (
  SELECT date, year, month, day, code, name, population, new_cases,
         CAST(sum(new_cases) OVER (PARTITION BY code ORDER BY date ASC NULLS FIRST
              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_cases
  FROM daily
),
indicators AS (
  SELECT *,
         CASE WHEN population IS NOT NULL AND population > 0
              THEN CAST(cumulative_cases AS DOUBLE) * 100000.0::DOUBLE / population END AS rate_per_100k
  FROM running
),
national AS (
  SELECT date, year, month, day,
         CAST(sum(new_cases) AS BIGINT) AS new_cases_national,
         CAST(sum(cumulative_cases) AS BIGINT) AS cumulative_cases_national,
         CAST(sum(population) AS BIGINT) AS population_total
  FROM indicators GROUP BY date, year, month, day
),
summary AS (
  SELECT date, year, month, day, new_cases_national, cumulative_cases_national, population_total,
         CASE WHEN population_total <> 0
              THEN CAST(cumulative_cases_national AS DOUBLE) * 100000.0::DOUBLE / population_total
         END AS rate_per_100k_national,
         (SELECT max(date) FROM national) AS latest_date
  FROM national
)
"""


def with_fixture(sql_body: str) -> str:
    """Prefix an oracle query with the fixture CTEs."""
    body = sql_body.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + FIXTURE_SQL.strip() + ",\n" + body[4:].lstrip()
    return "WITH " + FIXTURE_SQL.strip() + "\n" + body
