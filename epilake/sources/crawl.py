"""Register all tables below a lake folder, and follow their changes.

Spark lists the files below the folder (names, sizes and times; nothing is
read). What precedes a path's ``key=value`` folders is a table's root, named
after its last folder; the ``key=value`` folders are its partitions. Files are
aggregated to one row per partition before anything reaches the driver, and
only tables whose files have changed since the last crawl are looked at:

- a new root becomes an external table, its schema merged from the footers;
- in a known one, columns that appeared are added, partitions that appeared or
  vanished are added or dropped; the footers read are those of files newer than
  the last crawl.

A table property holds the state of the files as last seen, so an unchanged
table takes no DDL. Columns are never dropped or retyped: a table whose files
don't merge with its schema stays as it is and is reported as ``conflict``,
like one whose name belongs to another location or to a managed table, and a
root whose depths or keys of partition folders differ. Tables whose folder is
empty or gone stay, reported as ``absent``. Tables published by commit
(:mod:`epilake.sources.versions`) are left out: their files are not all current;
``point_view`` registers those.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType, StructType

from epilake.sources.versions import VERSION

STATE = "epilake.crawl.state"
NEWEST = "epilake.crawl.newest"
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"
REPORT = ("table string, root string, action string, partitions_added long, partitions_dropped long, "
          "columns_added array<string>, files long, bytes long")
#: Partitions in one ALTER TABLE.
DDL_BATCH = 500


@dataclass
class Found:
    """A table root as the listing shows it."""

    root: str
    name: str
    keys: list[str]
    mixed: bool
    files: int
    bytes: int
    newest: str
    state: str
    added: int = 0
    dropped: int = 0
    columns: list[str] = field(default_factory=list)


def list_partitions(spark: SparkSession, root: str) -> DataFrame:
    """A row per partition folder below ``root``: table root, ``spec`` (the
    ``key=value`` folders, empty for none), files, bytes, time of the newest."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
              .option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
              .filter(~F.contains("path", F.lit(f"/{VERSION}="))))
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    spec = F.regexp_extract(folder, r"((?:/[^/=]+=[^/]*)*)$", 1)
    return (listed.select(folder.alias("folder"), spec.alias("spec"), "length", "modificationTime")
            .select(F.expr("left(folder, length(folder) - length(spec))").alias("root"),
                    F.ltrim("spec", F.lit("/")).alias("spec"), "length", "modificationTime")
            .groupBy("root", "spec").agg(
                F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                F.max("modificationTime").alias("newest")))


def find_tables(partitions: DataFrame) -> list[Found]:
    """A table per root, with a fingerprint of its partitions' files."""
    keys = F.regexp_replace("spec", "=[^/]*", "")
    rows = partitions.groupBy("root").agg(
        F.min(keys).alias("keys"), (F.count_distinct(keys) > 1).alias("mixed"),
        F.sum("files").alias("files"), F.sum("bytes").alias("bytes"),
        F.date_format(F.max("newest"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("newest"),
        # order-free: a sum of hashes in decimal, which cannot overflow
        F.sum(F.xxhash64("spec", "files", "bytes", "newest").cast("decimal(38,0)")).cast("string").alias("state"))
    return [Found(r["root"], _name(r["root"]), [k for k in r["keys"].split("/") if k], r["mixed"], r["files"],
                  r["bytes"], r["newest"], r["state"]) for r in rows.orderBy("root").collect()]


def _name(root: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]+", "_", unquote(root.rstrip("/").rsplit("/", 1)[-1])).lower()


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec_sql(spec: str) -> str:
    parts = []
    for item in spec.split("/"):
        k, _, v = item.partition("=")
        parts.append(f"`{k}` = " + ("NULL" if v == NULL_VALUE else _quoted(unquote(v))))
    return f"PARTITION ({', '.join(parts)})"


def _narrowest(values: DataFrame) -> DataType:
    """Int, long or text, whichever holds all values of a partition key."""
    row = values.select(F.coalesce(F.bool_and(F.col("v").try_cast("int").cast("string") == F.col("v")), F.lit(False)),
                        F.coalesce(F.bool_and(F.col("v").try_cast("long").cast("string") == F.col("v")), F.lit(False)))
    whole, long = row.first()
    return IntegerType() if whole else LongType() if long else StringType()


def _key_types(specs: DataFrame, keys: list[str]) -> list[DataType]:
    return [_narrowest(specs.select(F.nullif(F.regexp_extract("spec", rf"(?:^|/){re.escape(k)}=([^/]*)", 1),
                                             F.lit(NULL_VALUE)).alias("v")).filter("v IS NOT NULL AND v <> ''"))
            for k in keys]


def _columns(spark: SparkSession, found: Found, after: str | None) -> StructType:
    """Columns in the footers of all files, or of those changed ``after`` a time."""
    reader = (spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.parquet"))
    if after:
        reader = reader.option("modifiedAfter", after).option("timeZone", "UTC")
    return reader.parquet(found.root).schema


def _create(spark: SparkSession, table: str, found: Found, specs: DataFrame) -> None:
    columns = [f for f in _columns(spark, found, None) if f.name not in found.keys]
    types = _key_types(specs, found.keys)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns]
    fields += [f"`{k}` {t.simpleString()}" for k, t in zip(found.keys, types)]
    by = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in found.keys)})" if found.keys else ""
    spark.sql(f"CREATE TABLE {table} ({', '.join(fields)}) USING parquet{by} LOCATION {_quoted(found.root)}")


def _follow(spark: SparkSession, table: str, found: Found, specs: DataFrame, after: str | None) -> None:
    """Add new columns; add and drop partitions. ``found`` gets the counts."""
    known = {f.name.lower(): f for f in spark.table(table).schema}
    new = []
    for f in _columns(spark, found, after) if after else []:
        have = known.get(f.name.lower())
        if have is None:
            new.append(f)
        elif have.dataType != f.dataType and f.name not in found.keys:
            raise ValueError(f"column {f.name} is {f.dataType.simpleString()}, {have.dataType.simpleString()} before")
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ("
                  + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        found.columns = [f.name for f in new]
    if not found.keys:
        return
    # as Spark writes them in its own listing: keys in order, values unescaped
    listed = specs.select("spec").distinct()
    have = spark.sql(f"SHOW PARTITIONS {table}").select(F.col("partition").alias("spec"))
    for missing, verb in ((listed.join(have, "spec", "left_anti"), "ADD IF NOT EXISTS"),
                          (have.join(listed, "spec", "left_anti"), "DROP IF EXISTS")):
        batch: list[str] = []
        for r in missing.toLocalIterator():
            batch.append(_spec_sql(r["spec"]))
            if len(batch) == DDL_BATCH:
                _alter(spark, table, verb, batch, found)
                batch = []
        if batch:
            _alter(spark, table, verb, batch, found)


def _alter(spark: SparkSession, table: str, verb: str, specs: list[str], found: Found) -> None:
    comma = " " if verb.startswith("ADD") else ", "
    spark.sql(f"ALTER TABLE {table} {verb} {comma.join(specs)}")
    if verb.startswith("ADD"):
        found.added += len(specs)
    else:
        found.dropped += len(specs)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _same_place(a: str, b: str) -> bool:
    return re.sub(r"^file:/+", "/", a.rstrip("/")) == re.sub(r"^file:/+", "/", b.rstrip("/"))


def crawl(spark: SparkSession, root: str, database: str | None = None, prefix: str = "") -> DataFrame:
    """Register and update the tables below ``root`` (in ``database``, created
    if absent); returns a report with a row per table (``REPORT``). An unchanged
    lake issues no DDL. The driver holds one row per table."""
    for ident in filter(None, (database, prefix)):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", ident):
            raise ValueError(f"bad identifier: {ident!r}")
    if database and not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    # one listing, kept for the tables' own look at their partitions
    partitions = list_partitions(spark, root).persist()
    report, seen, taken = [], set(), {}
    try:
        for found in find_tables(partitions):
            table = f"{database}.{prefix}{found.name}" if database else f"{prefix}{found.name}"
            seen.add(table)
            specs = partitions.filter((F.col("root") == found.root) & (F.col("spec") != ""))
            action = "conflict" if found.mixed or table in taken else _update(spark, table, found, specs)
            taken[table] = found.root
            report.append((table, found.root, action, found.added, found.dropped, found.columns, found.files, found.bytes))
    finally:
        partitions.unpersist()
    at = database or spark.catalog.currentDatabase()
    for t in spark.catalog.listTables(at):
        table = f"{database}.{t.name}" if database else t.name
        if t.tableType == "EXTERNAL" and t.name.startswith(prefix) and table not in seen:
            properties = _properties(spark, table)
            if STATE in properties and (place := _location(spark, table)).startswith(_plain(root)):
                report.append((table, place, "absent", 0, 0, [], 0, 0))
    return spark.createDataFrame(report, REPORT)


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path.rstrip("/")) + "/"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return re.sub(r"^file:/+", "/", rows[0]["data_type"].rstrip("/")) if rows else ""


def _update(spark: SparkSession, table: str, found: Found, specs: DataFrame) -> str:
    try:
        if not spark.catalog.tableExists(table):
            _create(spark, table, found, specs)
            if found.keys:
                spark.catalog.recoverPartitions(table)
                found.added = specs.count()
            action = "created"
        else:
            properties = _properties(spark, table)
            place = _location(spark, table)
            if spark.catalog.getTable(table).tableType != "EXTERNAL" or not _same_place(place, found.root):
                return "conflict"
            if properties.get(STATE) == found.state:
                return "unchanged"
            keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
            if keys != found.keys:
                return "conflict"
            # the merged footers of all files unless a crawl has seen some
            _follow(spark, table, found, specs, properties.get(NEWEST, "1970-01-01T00:00:00"))
            spark.catalog.refreshTable(table)
            action = "changed"
    except (ValueError, PySparkException) as e:
        found.columns = [str(e).split("\n")[0][:200]]
        return "conflict"
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_quoted(STATE)} = {_quoted(found.state)}, "
              f"{_quoted(NEWEST)} = {_quoted(found.newest)})")
    return action
