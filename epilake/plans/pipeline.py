"""End-to-end batch pipeline: raw events -> trusted -> refined -> serving.

Layout under ``base_path`` (all Parquet)::

    trusted/cases/year=/month=/day=          event level, enriched
    refined/region_indicators/year=          per (date, region), sorted by date
    refined/analytics/<report>               six report tables
    refined/api_views/national_summary/year= per date, for serving reads

Each table is computed once and read back before anything downstream uses
it, so the event scan and join run once and the daily aggregation once
(the analytics are small jobs over the materialised indicators). Row
counts are gathered with ``observe`` during the writes, costing no extra
job.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from epilake.functions.columns import AGE_BINS, AGE_FALLBACK, as_date
from epilake.functions.columns import normalise_code as code_expr
from epilake.operators import analytics as an
from epilake.operators import clean as cl
from epilake.operators import indicators as ind
from epilake.operators.serve import observed
from epilake.schemas import DIM_CONTRACT, DIM_SCHEMA
from epilake.session import shared_dir
from epilake.sources import files as io
from epilake.sources import tables as tb
from epilake.sources import versions as vs

CONTRACT = "table contract"


@dataclass
class PipelineConfig:
    k: int = 10
    threshold: int = 1000
    origin: str | _dt.date = "2020-03-06"
    moving_window: int = 7
    run_analytics: bool = True
    dynamic_overwrite: bool = False
    densify: bool = False  # national series with carried-forward regions (addition)
    quarantine: bool = False  # rejected records apart from the trusted table (addition)
    # columns, labels and compared values of the event-level reports
    age_col: str = "age"
    age_bins: tuple[tuple[str, float | None, float | None], ...] = AGE_BINS
    age_fallback: str = AGE_FALLBACK
    label_col: str = "sex"
    missing_label: str = "Not reported"
    deceased_col: str = "status"
    deceased_value: str = "Deceased"
    recovered_col: str = "status"
    recovered_value: str = "Recovered"
    # published names: table -> folder (relative to the base path) and
    # table -> {column: published column}; unnamed ones keep the defaults
    folders: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    # published columns of the trusted table, in order (empty: all there are)
    trusted_columns: Sequence[str] = ()


@dataclass
class PipelineResult:
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)  # bad_dates, unmatched, bad_ages, malformed_lines


#: Default folder of each published table under the base path.
DEFAULT_FOLDERS = {
    "trusted": "trusted/cases",
    "indicators": "refined/region_indicators",
    "analytics": "refined/analytics",
    "summary": "refined/api_views/national_summary",
    "top_regions_rate": "top_regions_rate",
    "monthly_trends": "monthly_trends",
    "age_distribution": "age_distribution",
    "outcomes_by_sex": "outcomes_by_sex",
    "threshold_dates": "threshold_dates",
    "moving_average": "moving_average",
}


def table_paths(base_path: str, folders: Mapping[str, str] | None = None) -> dict[str, str]:
    """Where each published table lives under ``base_path`` (reports under
    the analytics folder)."""
    base = base_path.rstrip("/")
    f = {**DEFAULT_FOLDERS, **(folders or {})}
    paths = {k: f"{base}/{f[k]}" for k in ("trusted", "indicators", "analytics", "summary")}
    for k in DEFAULT_FOLDERS:
        if k not in paths:
            paths[k] = f"{paths['analytics']}/{f[k]}"
    return paths


def published_paths(base_path: str, cfg: PipelineConfig) -> dict[str, str]:
    """:func:`table_paths`; with quarantine the trusted table and the
    ``rejected`` records are two folders of one written table."""
    paths = table_paths(base_path, cfg.folders)
    if cfg.quarantine:
        paths["rejected"] = f"{paths['trusted']}/{OUTCOME}=rejected"
        paths["trusted"] += f"/{OUTCOME}=trusted"
    return paths


def _publish_names(df: DataFrame, cfg: PipelineConfig, table: str) -> DataFrame:
    """Published names; a column named None isn't published."""
    names = cfg.columns.get(table, {})
    df = df.drop(*[c for c, n in names.items() if n is None])
    names = {c: n for c, n in names.items() if n is not None}
    return df.withColumnsRenamed({c: n for c, n in names.items() if c in df.columns}) if names else df


def _read_back(spark: SparkSession, path: str, cfg: PipelineConfig, table: str) -> DataFrame:
    """A published table with its columns named as the operators expect."""
    df = io.scan_partitioned_parquet(spark, path)
    names = cfg.columns.get(table, {})
    inverse = {n: c for c, n in names.items() if n in df.columns}
    return (df.withColumnsRenamed(inverse) if inverse else df).drop(REJECT)


def _partition_names(cfg: PipelineConfig, table: str, cols: Sequence[str]) -> list[str]:
    names = cfg.columns.get(table, {})
    return [names.get(c, c) for c in cols]


#: Suffix of a number's text as landed.
LANDED = "__landed"
#: Raw text of a line whose number of fields is not the header's.
MALFORMED = "__malformed"
#: Partition column and reject column of a trusted table with quarantine.
OUTCOME, REJECT = "outcome", "reject"
REJECT_TYPE = "struct<reason:string,file:string,record:string>"


def read_landed_cases(spark: SparkSession, path: str, rename: Mapping[str, str] | None = None,
                      fmt: str = "csv", numeric: Sequence[str] = ("age",), keep_text: bool = False,
                      columns: Sequence[str] = ()) -> DataFrame:
    """Raw event records as landed: header row (or ``columns`` for files
    without one), every column read as text
    (no inference pass, codes such as ``05`` stay as written), renamed to
    the operators' column names, ``numeric`` columns cast with ``try_cast``
    (unreadable text becomes null instead of failing the job). With
    ``keep_text`` the landed text stays beside each as ``<name>__landed``, and
    the raw text of lines with too few or too many fields as
    ``__malformed``, for :func:`step_trusted` to count or set apart."""
    if fmt == "csv":
        reader = spark.read.option("header", not columns).option("mode", "PERMISSIVE")
        if keep_text or columns:
            names = list(columns) or reader.csv(path).columns
            fields = [StructField(c, StringType()) for c in names]
            if keep_text:
                # all fields are parsed, else a line's count isn't seen
                fields.append(StructField(MALFORMED, StringType()))
                reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
            reader = reader.schema(StructType(fields))
        df = reader.csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    casts = {c: F.col(c).try_cast("double") for c in numeric if c in df.columns}
    if keep_text:
        df = df.withColumns({c + LANDED: F.col(c) for c in casts}) if casts else df
    return df.withColumns(casts) if casts else df


def with_rejects(cases: DataFrame) -> DataFrame:
    """Cases read with ``keep_text``, with ``reject`` (null for a record that
    can be used): why, from which file, and the record as landed. A line with
    the wrong number of fields, a date that is there but unreadable and an
    unreadable number are reasons; a missing value and an unknown code aren't."""
    landed = [c.removesuffix(LANDED) for c in cases.columns if c.endswith(LANDED)]
    date = as_date("report_date", cases.schema["report_date"].dataType)
    bad_line = F.col(MALFORMED).isNotNull() if MALFORMED in cases.columns else F.lit(False)
    reason = F.concat_ws(
        ",", F.when(bad_line, "malformed_line"), F.when(date.isNull() & F.col("report_date").isNotNull(), "bad_date"),
        *[F.when(F.col(c).isNull() & F.col(c + LANDED).isNotNull(), f"bad_{c}") for c in landed])
    text = [F.col(c + LANDED if c in landed else c).cast("string").alias(c) for c in cases.columns
            if not c.endswith(LANDED) and c != MALFORMED]
    record = F.to_json(F.struct(*text))
    if MALFORMED in cases.columns:
        record = F.coalesce(F.col(MALFORMED), record)
    return cases.withColumn(REJECT, F.when(reason != "", F.struct(
        reason.alias("reason"), F.col("_metadata.file_path").alias("file"), record.alias("record"))))


def step_trusted(spark: SparkSession, cases: DataFrame, dim: DataFrame, base_path: str,
                 config: PipelineConfig | None = None,
                 result: PipelineResult | None = None) -> PipelineResult:
    """Step 1: enrich + date parts, event level -> partitioned write of the
    trusted table. Unreadable dates, events without a dimension row and, of
    cases read with ``keep_text``, unreadable numbers (``bad_ages``) and
    malformed lines are counted during the write (``result.rejects``).

    With ``config.quarantine`` the same write puts records that can't be used
    (:func:`with_rejects`) into a folder of their own beside the trusted
    table, so records in are trusted plus rejected; both have the column
    ``reject``, null in the trusted table."""
    cfg, res = config or PipelineConfig(), result or PipelineResult()
    paths = published_paths(base_path, cfg)
    trusted = cl.trusted_cases(with_rejects(cases) if cfg.quarantine else cases, dim)
    landed = [c.removesuffix(LANDED) for c in trusted.columns if c.endswith(LANDED)]
    conditions = {
        "bad_dates": F.col("event_date").isNull() & F.col("report_date").isNotNull(),
        "unmatched": F.col("dim_code").isNull(),
        **{f"bad_{c}s": F.col(c).isNull() & F.col(c + LANDED).isNotNull() for c in landed}}
    if MALFORMED in trusted.columns:
        conditions["malformed_lines"] = F.col(MALFORMED).isNotNull()
    counted = {**conditions, **({"rejected": F.col(REJECT).isNotNull()} if cfg.quarantine else {})}
    trusted, obs = observed(trusted, "trusted", counted)
    df = _publish_names(trusted.drop(MALFORMED, *[c + LANDED for c in landed]), cfg, "trusted")
    if cfg.trusted_columns:
        # a column that the landed file lacks is null text, so the table's
        # columns are the same whatever was landed
        df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                         for c in cfg.trusted_columns], *([REJECT] if cfg.quarantine else []))
    by = _partition_names(cfg, "trusted", io.PARTITION_COLUMNS)
    if cfg.quarantine:
        df = df.withColumn(OUTCOME, F.when(F.col(REJECT).isNull(), "trusted").otherwise("rejected"))
        by = [OUTCOME, *by]
    io.write_partitioned(df, table_paths(base_path, cfg.folders)["trusted"], by, dynamic=cfg.dynamic_overwrite)
    got = obs.get
    res.paths["trusted"], res.rows["trusted"] = paths["trusted"], got["rows"] - got.get("rejected", 0)
    if cfg.quarantine:
        res.paths["rejected"], res.rows["rejected"] = paths["rejected"], got["rejected"]
    res.rejects = {k: got[k] for k in conditions}
    return res


def step_refined(spark: SparkSession, base_path: str, config: PipelineConfig | None = None,
                 result: PipelineResult | None = None) -> PipelineResult:
    """Step 2: region indicators (materialised once, read back) and the six
    reports, each a small job over the materialised tables. The two
    event-level reports share one pre-aggregated profile: one scan of the
    trusted table, checkpointed in the shared folder."""
    cfg, res = config or PipelineConfig(), result or PipelineResult()
    paths = published_paths(base_path, cfg)
    trusted = _read_back(spark, paths["trusted"], cfg, "trusted")

    df, obs = observed(ind.region_daily_indicators(trusted), "indicators")
    io.write_partitioned(_publish_names(df, cfg, "indicators"), paths["indicators"],
                         _partition_names(cfg, "indicators", io.AGGREGATE_PARTITION_COLUMNS),
                         dynamic=cfg.dynamic_overwrite,
                         sort_within=_partition_names(cfg, "indicators", ("date",)))
    res.paths["indicators"], res.rows["indicators"] = paths["indicators"], obs.get["rows"]
    indicators = _read_back(spark, paths["indicators"], cfg, "indicators")

    if cfg.run_analytics:
        shared_dir(spark)
        cols = list(dict.fromkeys([cfg.age_col, cfg.label_col, cfg.deceased_col,
                                   cfg.recovered_col]))
        profile = an.event_profile(trusted, cols).checkpoint(eager=True)
        reports = {
            "top_regions_rate": an.top_k_latest_rate(indicators, cfg.k),
            "monthly_trends": an.monthly_trends(indicators),
            "age_distribution": an.bin_share(profile, value_col=cfg.age_col, bins=cfg.age_bins,
                                             fallback=cfg.age_fallback, count_col="events"),
            "outcomes_by_sex": an.outcome_breakdown(
                profile, label_col=cfg.label_col, missing_label=cfg.missing_label,
                deceased_col=cfg.deceased_col, deceased_value=cfg.deceased_value,
                recovered_col=cfg.recovered_col, recovered_value=cfg.recovered_value,
                count_col="events"),
            "threshold_dates": an.first_threshold_date(indicators, cfg.threshold, cfg.origin),
            "moving_average": an.moving_average(indicators, cfg.moving_window),
        }
        for name, report in reports.items():
            io.publish_result(_publish_names(report, cfg, name), paths[name])
            res.paths[name] = paths[name]
    return res


def step_summary(spark: SparkSession, base_path: str, config: PipelineConfig | None = None,
                 result: PipelineResult | None = None) -> PipelineResult:
    """Step 3: national daily summary for serving, from the published
    indicators."""
    cfg, res = config or PipelineConfig(), result or PipelineResult()
    paths = table_paths(base_path, cfg.folders)
    indicators = _read_back(spark, paths["indicators"], cfg, "indicators")
    df, obs = observed(ind.national_daily_summary(indicators, densify=cfg.densify), "summary")
    io.write_partitioned(_publish_names(df, cfg, "summary"), paths["summary"],
                         _partition_names(cfg, "summary", io.AGGREGATE_PARTITION_COLUMNS),
                         dynamic=cfg.dynamic_overwrite,
                         sort_within=_partition_names(cfg, "summary", ("date",)))
    res.paths["summary"], res.rows["summary"] = paths["summary"], obs.get["rows"]
    return res


def run_pipeline(spark: SparkSession, cases: DataFrame, dim: DataFrame, base_path: str,
                 config: PipelineConfig | None = None) -> PipelineResult:
    """All three steps in order; each reads what the previous one wrote."""
    cfg = config or PipelineConfig()
    res = step_trusted(spark, cases, dim, base_path, cfg)
    step_refined(spark, base_path, cfg, res)
    return step_summary(spark, base_path, cfg, res)


#: Name of the dimension among the tables published by commit.
DIMENSION = "dimension"


def ingest_dimension(spark: SparkSession, csv_path: str, root: str, export_path: str | None = None,
                     export_format: str = "csv", batch: str | None = None) -> tuple[vs.Commit, DataFrame]:
    """Keyed dimension ingest in one job: CSV (explicit schema, codes stay
    strings) -> keys normalised as the join does -> contract -> upsert,
    published by commit (:mod:`epilake.sources.versions`) -> optional export.

    The contract's checks are part of the writing plan: at the first missing
    or overlong value the job fails, ``ValueError`` is raised and nothing is
    published. A key repeated in the batch is replaced by its last row, by
    file name and place in the file. Returns the commit and a one-row report
    in :func:`check_table_contract`'s columns, counted during the write."""
    key, seq = DIM_CONTRACT["key"], "__seq"
    base = vs.latest(spark, root)
    scanned = io.scan_csv(spark, csv_path, DIM_SCHEMA)
    # rows of a file's split are read in order by one task
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("nr"))
    incoming = (scanned.withColumn(seq, place)
                .withColumn(key, code_expr(key, DIM_CONTRACT["max_length"][key])))
    incoming = tb.enforced(incoming, DIM_CONTRACT["not_null"], DIM_CONTRACT["max_length"], CONTRACT)
    target = (vs.read(spark, root, DIMENSION, base) if DIMENSION in base.tables
              else spark.createDataFrame([], DIM_SCHEMA))
    obs = Observation("dimension")
    merged = tb.merge_by_key(target, incoming, key, seq).observe(
        obs, F.coalesce(F.sum("batch_rows"), F.lit(0)).alias("rows"),
        F.count_if(F.col("batch_rows") > 1).alias("duplicate_keys"))
    try:
        done = vs.publish(spark, root, {DIMENSION: vs.Change(merged.drop("batch_rows"))}, base, batch)
    except (PySparkException, Py4JJavaError) as e:
        if broken := re.search(rf"{CONTRACT}: [a-z_ ]+", str(e)):
            raise ValueError(f"{csv_path} breaks the {broken.group()}") from e
        raise
    counts = {"rows": 0, "duplicate_keys": 0} if done is base else obs.get
    report = {"rows": counts["rows"], **{f"null_{c}": 0 for c in DIM_CONTRACT["not_null"]},
              **{f"long_{c}": 0 for c in DIM_CONTRACT["max_length"]}, "duplicate_keys": counts["duplicate_keys"]}
    if export_path:
        io.export_table(read_dimension(spark, root), export_path, export_format)
    return done, spark.createDataFrame([tuple(report.values())], ", ".join(f"{c} bigint" for c in report))


def read_dimension(spark: SparkSession, root: str) -> DataFrame:
    """The dimension as last published."""
    return vs.read(spark, root, DIMENSION)
