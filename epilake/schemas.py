"""Explicit schemas and table contracts (no schema inference anywhere:
inference costs an extra pass and turns the code '05' into the int 5)."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Keyed region dimension.
DIM_SCHEMA = StructType([
    StructField("code", StringType(), True),
    StructField("name", StringType(), True),
    StructField("population", LongType(), True),
])

#: Contract of the dimension: key, NOT NULL columns, max string lengths.
DIM_CONTRACT = {
    "key": "code",
    "not_null": ("code", "name", "population"),
    "max_length": {"code": 2, "name": 100},
}

#: Raw event records as landed (codes and free text stay strings).
CASES_SCHEMA = StructType([
    StructField("case_id", LongType(), True),
    StructField("report_date", StringType(), True),
    StructField("region_raw", StringType(), True),
    StructField("region_name_raw", StringType(), True),
    StructField("age", IntegerType(), True),
    StructField("sex", StringType(), True),
    StructField("status", StringType(), True),
])
