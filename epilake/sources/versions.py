"""Tables published by commit: readers see all of a change or none of it.

Under a root folder every table has ``<root>/<table>/__v=<id>/<part>/`` with
Parquet files, one ``__v`` folder per write, and ``<root>/_commits/<n>.json``
names, for each table, its columns and the versions that make up each part (a
part is a folder of partition values such as ``year=2001``; a table without
partition columns is one part). A publish writes the new files first and the
commit record last, under the next number, by a rename that fails if the
number is taken. So

- a failure before the commit leaves files that no record names, and the old
  rows readable;
- a change can take in several tables at once, and only the parts it touches;
- of two publishes from the same state one commits and the other raises
  :class:`Conflict`.

Readers resolve the latest record, or an earlier one. ``point_view`` repoints
a catalog view in one statement. ``expire`` removes what the last records
don't name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSION = "__v"
COMMITS = "_commits"


class Conflict(RuntimeError):
    """Another publish has committed since the state this one began from."""


@dataclass
class Table:
    """A table in a commit: columns, partition columns, versions by part and
    free settings."""

    schema: StructType
    by: list[str]
    parts: dict[str, list[str]]
    settings: dict = field(default_factory=dict)


@dataclass
class Commit:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"batches": self.batches, "tables": {
            n: {"schema": t.schema.jsonValue(), "by": t.by, "parts": t.parts, "settings": t.settings}
            for n, t in self.tables.items()}})

    @staticmethod
    def from_json(number: int, text: str) -> "Commit":
        d = json.loads(text)
        return Commit(number, {n: Table(StructType.fromJson(t["schema"]), t["by"], t["parts"], t["settings"])
                               for n, t in d["tables"].items()}, d["batches"])


@dataclass
class Change:
    """New rows of a table. ``mode``: ``replace`` the whole table, replace the
    ``parts`` that ``df`` has rows in, or ``append``; ``drop`` names parts that
    go without new rows. ``by`` are the partition columns, ``sort_within``
    orders rows inside files."""

    df: DataFrame
    by: Sequence[str] = ()
    mode: str = "replace"
    sort_within: Sequence[str] = ()
    drop: Sequence[str] = ()
    settings: Mapping = field(default_factory=dict)
    distribution: str = "rebalance"


class Folder:
    """Hadoop file system calls on the paths below one folder (any store that Spark reads)."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *[n for n in names if n]]))

    def names(self, *at: str) -> list[str]:
        """Names in a folder, none if it doesn't exist."""
        try:
            return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(*at)))
        except Py4JJavaError as e:
            if "FileNotFoundException" in str(e.java_exception):
                return []
            raise

    def text(self, *at: str) -> str:
        stream = self.fs.open(self.path(*at))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_once(self, text: str, *at: str) -> None:
        """Write a file that must not exist: whole under another name first,
        then renamed, which the store refuses if the name is taken."""
        draft = self.path(*at[:-1], f".{at[-1]}-{uuid.uuid4().hex[:12]}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf)
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self.path(*at), options)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "AlreadyExists" in str(e.java_exception):
                raise Conflict("/".join(at)) from e
            raise

    def delete(self, *at: str) -> None:
        self.fs.delete(self.path(*at), True)


def _numbers(folder: Folder) -> list[int]:
    return [int(n[:-5]) for n in folder.names(COMMITS) if n.endswith(".json") and n[:-5].isdigit()]


def latest(spark: SparkSession, root: str, number: int | None = None) -> Commit:
    """The latest commit (number 0 without tables if there is none), or the
    one of that ``number``."""
    folder = Folder(spark, root)
    if number is None:
        number = max(_numbers(folder), default=0)
    return Commit.from_json(number, folder.text(COMMITS, f"{number:012d}.json")) if number else Commit()


def _parts(folder: Folder, name: str, version: str, depth: int) -> list[str]:
    """Folders of partition values that a version has."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{n}".lstrip("/") for p in found
                 for n in folder.names(name, f"{VERSION}={version}", p) if "=" in n]
    return found


def write_version(root: str, name: str, change: Change) -> str:
    """Write a change's rows; no reader sees them before a commit names them."""
    version = uuid.uuid4().hex[:16]
    df = change.df
    by = list(change.by)
    if by and change.distribution == "rebalance":
        df = df.hint("rebalance", *by)
    if change.sort_within:
        df = df.sortWithinPartitions(*by, *change.sort_within)
    writer = df.write.mode("errorifexists")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(f"{root.rstrip('/')}/{name}/{VERSION}={version}")
    return version


def publish(spark: SparkSession, root: str, changes: Mapping[str, Change], base: Commit | None = None,
            batch: str | None = None) -> Commit:
    """Write the changes, then commit them together on top of ``base`` (default:
    the latest). ``batch`` names the input: if a commit up to ``base`` has
    taken it in, nothing is written and ``base`` is returned."""
    base = latest(spark, root) if base is None else base
    if batch is not None and batch in base.batches:
        return base
    folder = Folder(spark, root)
    tables = dict(base.tables)
    for name, change in changes.items():
        version = write_version(root, name, change)
        new = _parts(folder, name, version, len(change.by))
        old = tables.get(name)
        parts = {} if old is None or change.mode == "replace" else dict(old.parts)
        for p in change.drop:
            parts.pop(p, None)
        for p in new:
            parts[p] = [*parts.get(p, []), version] if change.mode == "append" else [version]
        settings = {**(old.settings if old else {}), **change.settings}
        tables[name] = Table(change.df.schema, list(change.by), parts, settings)
    done = Commit(base.number + 1, tables, base.batches + ([batch] if batch is not None else []))
    folder.write_once(done.to_json(), COMMITS, f"{done.number:012d}.json")
    return done


def read(spark: SparkSession, root: str, name: str, commit: Commit | None = None) -> DataFrame:
    """A table as of ``commit`` (default: the latest); filters on partition
    columns prune its parts."""
    commit = latest(spark, root) if commit is None else commit
    if name not in commit.tables:
        raise KeyError(f"{root} has no table {name!r}")
    table = commit.tables[name]
    base = f"{root.rstrip('/')}/{name}"
    paths = [f"{base}/{VERSION}={v}/{p}".rstrip("/") for p, versions in table.parts.items() for v in versions]
    if not paths:
        return spark.createDataFrame([], table.schema)
    schema = StructType([*table.schema.fields, StructField(VERSION, StringType())])
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*table.schema.names)


def point_view(spark: SparkSession, view: str, root: str, name: str, commit: Commit | None = None) -> None:
    """Create or repoint the catalog view ``view`` in one statement, so that
    no query finds it missing. Every version named must be current in all its
    parts, as it is after ``replace`` and ``append``; else use :func:`read`."""
    commit = latest(spark, root) if commit is None else commit
    table, folder = commit.tables[name], Folder(spark, root)
    held: dict[str, set[str]] = {}
    for p, versions in table.parts.items():
        for v in versions:
            held.setdefault(v, set()).add(p)
    for v, parts in held.items():
        if parts != set(_parts(folder, name, v, len(table.by))):
            raise ValueError(f"version {v} of {name} is current in some of its parts only")
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema)
    empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema)
    arms = [f"SELECT {columns} FROM parquet.`{folder.root}/{name}/{VERSION}={v}`" for v in held]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + (" UNION ALL ".join(arms) or f"SELECT {empty} WHERE false"))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` records and the versions that those
    don't name; returns the removed folders. Run it while nothing is being
    published: a version not yet committed is removed too."""
    folder = Folder(spark, root)
    numbers = _numbers(folder)
    last = [latest(spark, root, n) for n in numbers[max(0, len(numbers) - keep):]]
    used = {(n, v) for c in last for n, t in c.tables.items() for vs in t.parts.values() for v in vs}
    gone = []
    for n in numbers[:max(0, len(numbers) - keep)]:
        folder.delete(COMMITS, f"{n:012d}.json")
    for name in folder.names():
        if name == COMMITS:
            continue
        for v in folder.names(name):
            if v.startswith(f"{VERSION}=") and (name, v[len(VERSION) + 1:]) not in used:
                folder.delete(name, v)
                gone.append(f"{name}/{v}")
    return gone


def small_parts(spark: SparkSession, root: str, name: str, target_bytes: int, commit: Commit) -> DataFrame:
    """Files and bytes by part (``part``, ``files``, ``bytes``) of the parts
    that fewer files of ``target_bytes`` would hold, from Spark's own
    distributed listing; no content is read."""
    table = commit.tables[name]
    base = f"{root.rstrip('/')}/{name}"
    paths = [f"{base}/{VERSION}={v}/{p}".rstrip("/") for p, vs in table.parts.items() for v in vs]
    if not paths:
        return spark.createDataFrame([], "part string, files long, bytes long")
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
              .option("recursiveFileLookup", True).load(paths).select("path", "length"))
    part = F.regexp_extract("path", rf"/{VERSION}=[0-9a-f]+(?:/(.*))?/[^/]+$", 1)
    return (listed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
            .filter(F.col("files") > F.ceil(F.col("bytes") / F.lit(target_bytes))))


def compact(spark: SparkSession, root: str, name: str, target_bytes: int = 256_000_000,
            parts_at_once: int = 200, sort_within: Sequence[str] = ()) -> int:
    """Rewrite parts made of many small files into files of about
    ``target_bytes``; rows stay. Parts are rewritten ``parts_at_once`` to a
    commit, so a pass that is stopped loses at most the parts at hand, and the
    next goes on with the rest. Returns the number of parts rewritten."""
    commit = latest(spark, root)
    table = commit.tables[name]
    # files that a part's bytes fill
    need = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")
    found = (small_parts(spark, root, name, target_bytes, commit)
             .select(need.alias("need"), "part").orderBy("need", "part").collect())
    for n, alike in groupby(found, key=lambda r: r["need"]):
        names = [r["part"] for r in alike]
        for at in range(0, len(names), parts_at_once):
            some = names[at:at + parts_at_once]
            only = Table(table.schema, table.by, {p: commit.tables[name].parts[p] for p in some})
            rows = read(spark, root, name, Commit(commit.number, {name: only}))
            share = F.pmod(F.monotonically_increasing_id(), F.lit(n))
            dealt = rows.repartition(n * len(some), *table.by, share)
            commit = publish(spark, root, {name: Change(dealt, table.by, "parts", sort_within, distribution="none")},
                             commit)
    return len(found)
