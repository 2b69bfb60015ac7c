"""Hard negatives by exact scores: GEMM in a residue number system.

A vector's components become the integers ``floor(scale * x)``. A score is
the integer inner product with an anchor. Rows and anchors are multiplied as
matrices modulo several primes below 256 in float32: residues are centred, at
most 125 in size, so a product over 1,024 dimensions stays below 2^24 and
float32 holds it exactly; longer vectors are multiplied piece by piece. The
signed scores are rebuilt by Chinese remaindering (mixed radix digits), with
as many primes as the block's own bound on its scores needs. Then an anchor's
positives are its first other rows of its label, and for each positive the
negatives are the first rows of other labels whose scores lie in a window of
shares of the positive's.

Anchors are a stated query set. They are taken in groups whose vectors fill
at most ``GROUP_BYTES``, each broadcast; all rows stream past a group twice
in Arrow batches, once for positives and once for negatives. A task keeps the
best rows per anchor only, and a window over the tasks' best gives the
result. Vectors are never shuffled; each group's result is written before
the next begins.

Rows with a null label, a null vector, or a null or non-finite component (or
one whose multiple by ``scale`` isn't finite) take no part. Rows are compared
at equal length only; empty vectors score 0. Higher scores come first, ties
by smaller id, a null id last. Repeated rows count as rows of their own, but
a row with the anchor's id is neither its positive nor its negative; anchors
alike in id, label and vector are one anchor. A pair whose score doesn't fit
a long is in no pool. An empty table, or one without anchors, gives no rows.
Extra columns aren't read, so no name clashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ship

GROUP_BYTES = 32_000_000
ROWS, ANCHORS = 2048, 1024      # block of a product
PIECE = 1024                    # dimensions of one exact float32 product
LEAST = -2**63                  # no score
PRIMES = [p for p in range(255, 2, -2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2))]


def residues(q: np.ndarray, p: int) -> np.ndarray:
    """Centred residues of whole numbers held as doubles."""
    r = np.fmod(q, p)
    half = p // 2
    r[r > half] -= p
    r[r < -half] += p
    return r.astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` of centred residues, modulo ``p`` in 0 to p - 1."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for at in range(0, a.shape[1], PIECE):
        part = a[:, at:at + PIECE] @ b[:, at:at + PIECE].T
        out += part - p * np.floor(part / p)
        out -= p * (out >= p)
    return out.astype(np.int64)


def moduli(bound: float) -> list[int] | None:
    """Primes whose product tells all whole numbers up to ``bound`` in size
    apart, or None if those below 256 don't do."""
    need, got = 2 * int(bound) + 1, 1
    for n, p in enumerate(PRIMES, 1):
        got *= p
        if got > need:
            return PRIMES[:n]
    return None


def remaindered(rests: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed whole numbers from their rests, int64 if the primes' product
    allows, else Python integers."""
    size = math.prod(primes)
    x, m = rests[0], primes[0]
    if size >= 2**62:
        x = x.astype(object)
    for r, p in zip(rests[1:], primes[1:]):
        digit = (r - x % p).astype(np.int64) * pow(m, -1, p) % p
        x = x + m * (digit if size < 2**62 else digit.astype(object))
        m *= p
    return np.where(x > size // 2, x - size, x)


class Anchors:
    """A block of anchors of one length, their residues kept by prime."""

    def __init__(self, q: np.ndarray):
        self.q = q
        self.most = float(np.abs(q).max(initial=0.0))
        self.by_prime: dict[int, np.ndarray] = {}

    def mod(self, p: int) -> np.ndarray:
        if p not in self.by_prime:
            self.by_prime[p] = residues(self.q, p)
        return self.by_prime[p]


def scores(rows: np.ndarray, anchors: Anchors) -> np.ndarray:
    """Exact inner products, rows by anchors, LEAST where one doesn't fit a long."""
    with np.errstate(over="ignore"):
        bound = 1.01 * float(np.abs(rows).sum(axis=1).max(initial=0.0)) * anchors.most
    primes = moduli(bound) if math.isfinite(bound) else None
    if primes:
        found = remaindered([product_mod(residues(rows, p), anchors.mod(p), p) for p in primes], primes)
    else:  # beyond the product of all primes below 256, about 2^346
        whole = [np.array([[int(x) for x in v] for v in m.tolist()], dtype=object).reshape(m.shape)
                 for m in (rows, anchors.q)]
        found = whole[0] @ whole[1].T
    if found.dtype == object:
        found = np.where((found < 2**63) & (found > LEAST), found, LEAST).astype(np.int64)
    return found


@dataclass
class Best:
    """The first ``n`` (score, id) of each group: higher scores first, then
    smaller ids, null ids last."""

    n: int
    group: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        g, s = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        i, z = np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        order = np.lexsort((i, z, -s, g))  # scores are above LEAST, so -s is a long
        g, s, i, z = g[order], s[order], i[order], z[order]
        first = np.flatnonzero(np.diff(g, prepend=-1)) if len(g) else np.zeros(0, np.int64)
        rank = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
        keep = rank < self.n
        self.group, self.score, self.ids, self.null = g[keep], s[keep], i[keep], z[keep]


def first_of(pool: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each column's first ``n`` scores, ties at the last one included."""
    if len(pool) > n:
        least = np.partition(pool, len(pool) - n, axis=0)[len(pool) - n]
        return np.nonzero((pool >= least) & (pool > LEAST))
    return np.nonzero(pool > LEAST)


@dataclass
class Query:
    """A group of anchors."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: list[np.ndarray]

    def blocks(self) -> Iterator[tuple[int, np.ndarray, Anchors]]:
        """(length, numbers of anchors, block)."""
        lengths = np.array([len(v) for v in self.vectors], dtype=np.int64)
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            for k in range(0, len(at), ANCHORS):
                part = at[k:k + ANCHORS]
                yield int(d), part, Anchors(np.stack([self.vectors[i] for i in part]).reshape(len(part), int(d)))


def whole_vectors(column: pa.ListArray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ``floor(scale * x)`` in one array, and where each row's begin."""
    lengths = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return np.floor(flat * scale), np.concatenate([[0], np.cumsum(lengths)])


def past(batches: Iterator[pa.RecordBatch], query: Query, n: int, scale: float,
         use: Callable[..., None]) -> list[Best]:
    """Call ``use`` (best so far, numbers of anchors, scores, ids, null ids,
    labels) for each block of rows and each block of anchors of its length;
    the best of each block of anchors."""
    blocks: dict[int, list] = {}
    for d, part, block in query.blocks():
        blocks.setdefault(d, []).append((part, block, Best(n)))
    for batch in batches:
        q, at = whole_vectors(batch.column("v"), scale)
        lengths = np.diff(at)
        ids = batch.column("id")
        null = np.asarray(ids.is_null())
        ids = np.asarray(ids.fill_null(0))
        labels = np.asarray(batch.column("label"))
        for d, found in blocks.items():
            rows = np.flatnonzero(lengths == d)
            for k in range(0, len(rows), ROWS):
                r = rows[k:k + ROWS]
                m = q[at[r][:, None] + np.arange(d)]
                for part, block, best in found:
                    use(best, part, scores(m, block), ids[r], null[r], labels[r])
    return [best for found in blocks.values() for _, _, best in found]


def positives_of(batches: Iterator[pa.RecordBatch], query: Query, n: int, scale: float) -> list[Best]:
    def use(best, part, s, ids, null, labels):
        same = (labels[:, None] == query.labels[part]) & ((ids[:, None] != query.ids[part]) | null[:, None])
        r, c = first_of(np.where(same, s, LEAST), n)
        best.add(part[c], s[r, c], ids[r], null[r])

    return past(batches, query, n, scale, use)


def negatives_of(batches: Iterator[pa.RecordBatch], query: Query, low: np.ndarray, high: np.ndarray,
                 n: int, scale: float) -> list[Best]:
    """``low`` and ``high``: anchors by positives, an empty window where there is none."""
    wide = low.shape[1]

    def use(best, part, s, ids, null, labels):
        other = (labels[:, None] != query.labels[part]) & ((ids[:, None] != query.ids[part]) | null[:, None])
        for j in range(wide):
            inside = other & (s >= low[part, j]) & (s <= high[part, j])
            r, c = first_of(np.where(inside, s, LEAST), n)
            best.add(part[c] * wide + j, s[r, c], ids[r], null[r])

    return past(batches, query, n, scale, use)


def _rows(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float) -> DataFrame:
    """Rows (id, label, v) that take part."""
    v = F.col(vector_col).cast("array<double>")
    most = 1.7976931348623157e308 / max(1.0, scale)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
    sound = F.forall("v", lambda x: F.coalesce(F.abs(x) <= most, F.lit(False)) & ~F.isnan(x))
    return rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & sound)


def _sent(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(best.group, pa.int64()), pa.array(best.score, pa.int64()),
         pa.array(best.ids, pa.int64(), mask=best.null)], names=["g", "score", "id"])


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of each group over all tasks, ranked from 1."""
    order = Window.partitionBy("g").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _group(anchors: DataFrame, scale: float) -> Query:
    table = anchors.select("id", "label", "v").orderBy("id", "label", "v").toArrow().combine_chunks()
    if not table.num_rows:
        return Query(np.zeros(0, np.int64), np.zeros(0, np.int64), [])
    q, at = whole_vectors(table.column("v").chunk(0), scale)
    return Query(np.asarray(table.column("id")), np.asarray(table.column("label")),
                 [q[a:b] for a, b in zip(at, at[1:])])


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long, positive_rank int")


def mine(df: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: float = 256.0, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """A row per anchor, positive and negative (``RESULT``). Rows of ``df``
    for which ``anchor`` holds are the anchors; one needs an id. Negatives'
    scores are from ``low`` to ``high`` hundredths of the positive's, which
    is empty for a positive scored below 0."""
    spark = df.sparkSession
    ship(spark)
    rows = _rows(df, id_col, label_col, vector_col, scale)
    chosen = materialise(_rows(df.filter(anchor & F.col(id_col).isNotNull()), id_col, label_col, vector_col, scale)
                         .distinct(), "anchors")
    size = chosen.agg(F.sum(F.size("v") * 8 + 64)).first()[0] or 0
    groups = -(-size // group_bytes)
    part = F.pmod(F.xxhash64("id", "label", "v"), F.lit(max(1, groups)))
    done = [spark.createDataFrame([], RESULT)]
    for k in range(groups):
        query = _group(chosen.filter(part == k), scale)
        shared = spark.sparkContext.broadcast(query)

        def find_positives(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from map(_sent, positives_of(batches, shared.value, positives, scale))

        # at most `positives` rows an anchor of the group
        got = _first(rows.mapInArrow(find_positives, "g long, score long, id long"), positives).collect()
        ids = np.zeros((len(query.ids), positives), dtype=object)
        of = np.zeros((len(query.ids), positives), dtype=np.int64)
        lows = np.ones_like(of)
        highs = np.zeros_like(of)
        for r in got:
            at = r["g"], r["rank"] - 1
            ids[at], of[at] = r["id"], r["score"]
            lows[at] = min(max(-(-low * r["score"] // 100), LEAST + 1), 2**63 - 1)
            highs[at] = min(max(high * r["score"] // 100, LEAST), 2**63 - 1)
        windows = spark.sparkContext.broadcast((lows, highs))

        def find_negatives(batches: Iterator[pa.RecordBatch], shared=shared, windows=windows) -> Iterator[pa.RecordBatch]:
            yield from map(_sent, negatives_of(batches, shared.value, *windows.value, negatives, scale))

        pairs = [(a * positives + j, int(query.ids[a]), None if ids[a, j] is None else int(ids[a, j]), int(of[a, j]), j + 1)
                 for a, j in sorted((r["g"], r["rank"] - 1) for r in got)]
        known = spark.createDataFrame(pairs, "g long, anchor_id long, positive_id long, positive_score long, positive_rank int")
        found = _first(rows.mapInArrow(find_negatives, "g long, score long, id long"), negatives)
        # as many rows as an anchor group has positives: within the group's bound
        done.append(materialise(found.join(F.broadcast(known), "g").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"), "positive_rank"), "hard-negatives"))
        shared.unpersist()
        windows.unpersist()
    return reduce(DataFrame.unionAll, done)


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
