"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.session import scratch_path

#: Characters that separate words, as a Java/RE2 class body.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

#: Characters handled at once by the numpy feature code; one longer text is
#: handled alone, so memory follows the longest text, not the batch.
CHUNK_CHARS = 1_000_000


def ship(spark: SparkSession) -> None:
    """Send this package's code to the session's Python workers, once a
    session (as ``--py-files`` would)."""
    context = spark.sparkContext
    if getattr(context, "_epilake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="epilake-code-"), "epilake_code.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(name)
    context._epilake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, so later
    jobs start from files that survive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def named(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores after it until none of
    ``columns`` has it (helper columns beside a caller's)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(columns: Iterable[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def mark(c: Column) -> Column:
    """A value as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))


def keep_rows(docs: DataFrame, marks: Sequence[Column], kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``marks`` are a row of ``kept`` (its columns in
    their order; no nulls, no repeats), one row for each.

    Copies combine before the one exchange that carries the rows: the join
    meets them where the aggregate has dealt them by the same columns.
    """
    mine = named(docs.columns, *[f"_mark{i}" for i in range(len(marks))])
    theirs = named([*docs.columns, *mine], *[f"_kept{i}" for i in range(len(marks))])
    rows = docs.withColumns(dict(zip(mine, marks))).dropDuplicates(mine)
    on = [F.col(a) == F.col(b) for a, b in zip(mine, theirs)]
    # merge: a broadcast of kept would grow with the data
    return rows.join(kept.toDF(*theirs).hint("merge"), on).select(*quoted(docs.columns))


def chunks(texts: Sequence[str | None], chars: int | None = None) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` holding about ``chars`` (CHUNK_CHARS) characters each."""
    chars = CHUNK_CHARS if chars is None else chars
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


def codepoints(texts: Sequence[str | None], sep: str = " ") -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each with ``sep`` before and one after the
    last, and the index where each text's separator stands (one more at the
    end). A lone surrogate passes through as its own value."""
    joined = sep + sep.join(t or "" for t in texts) + sep
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(t) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    return cp, at
