"""Quality classifier: supervised subword embeddings.

A text's features are its words, pairs of neighbouring words and character
n-grams within marked words, each hashed to a bucket with a learned vector.
A pair of equal words is one feature whatever the word (as if the second
were a ditto mark), so repetition is learned once.
A document is the average of its features' vectors; a softmax layer over it
gives the class. Vectors and layer are trained together by stochastic
gradient descent in numpy.

Training reads a bounded sample of labelled rows (``Config.sample`` rows,
the first by a hash of the id), picked by id before any text is read. As
the model is linear above the average, scoring folds the layer into the
vectors: one number a bucket, so the broadcast model has a fixed size
(1 MB at 18 bits), and a document's score is the softmax of an average of
such numbers. Every whole text is scored, in pieces of bounded memory.

Null and empty texts have no features and get the model's base score. With
no labelled rows, or rows of one class only, the score is that class's
smoothed share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import chunks, codepoints, ship

THRESHOLD = 0.3


@dataclass(frozen=True)
class Config:
    sample: int = 2500          # labelled rows used for training, at most
    bits: int = 18              # log2 of the buckets
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 4 
    rate: float = 20.0          # features are averaged over thousands, so steps are long
    seed: int = 7


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _bucket(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    h = (h + np.uint64(kind)) * _STEP
    h ^= h >> np.uint64(32)
    return ((h * _STEP) >> np.uint64(64 - bits)).astype(np.int32)


def features(texts: Sequence[str | None], cfg: Config) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, document) arrays, one kind of feature at a time. Documents
    are numbered by position; those without features don't show."""
    cp, at = codepoints([t.lower() if t else t for t in texts])
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    c = np.where(space, np.uint32(32), cp).astype(np.uint64)
    doc = np.zeros(len(cp), dtype=np.int32)
    doc[at[1:-1]] = 1
    doc = np.cumsum(doc, dtype=np.int32)
    # words: sums of powers between their ends, moved to a common start
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    if len(begin):
        total = np.zeros(len(c) + 1, dtype=np.uint64)
        np.cumsum(c * _powers(_BASE, len(c)), dtype=np.uint64, out=total[1:])
        word = (total[end] - total[begin]) * _powers(_BASE_INV, len(c))[begin]
        del total
        yield _bucket(word, 1, cfg.bits), doc[begin]
        near = doc[begin[1:]] == doc[begin[:-1]]
        pair = np.where(word[1:] == word[:-1], np.uint64(0), word[:-1] * _STEP + word[1:])
        yield _bucket(pair[near], 2, cfg.bits), doc[begin[1:]][near]
    for n in cfg.ngrams:
        m = len(c) - n + 1
        if m <= 0:
            continue
        inner = np.zeros(m, dtype=bool)
        h = np.zeros(m, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(_BASE) + c[k:k + m]
            if 0 < k < n - 1:
                inner |= space[k:k + m]
        ok = np.flatnonzero(~inner)
        yield _bucket(h[ok], 16 + n, cfg.bits), doc[ok + 1]


def bags(texts: Sequence[str | None], cfg: Config) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares of all features."""
    out = []
    for t in texts:
        got = [b for b, _ in features([t], cfg)]
        ids, n = np.unique(np.concatenate(got), return_counts=True) if got else (np.zeros(0, np.int32), np.zeros(0))
        out.append((ids, (n / max(n.sum(), 1)).astype(np.float32)))
    return out


@dataclass
class Model:
    table: np.ndarray   # a bucket's part in the difference of the two classes
    base: float
    cfg: Config

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probability of class 1."""
        out = np.empty(len(texts))
        for i, j in chunks(texts):
            part = texts[i:j]
            s = np.zeros(j - i)
            n = np.zeros(j - i)
            for buckets, doc in features(part, self.cfg):
                s += np.bincount(doc, self.table[buckets], minlength=j - i)
                n += np.bincount(doc, minlength=j - i)
            out[i:j] = s / np.maximum(n, 1) + self.base
        return 1.0 / (1.0 + np.exp(-np.clip(out, -60, 60)))


def fit(texts: Sequence[str | None], labels: Sequence[int], cfg: Config = Config()) -> Model:
    """Train on the given rows, in a fixed random order."""
    y = np.asarray(labels, dtype=np.int64)
    table = np.zeros(1 << cfg.bits, dtype=np.float32)
    ones = int(y.sum())
    if not 0 < ones < len(y):
        return Model(table, math.log((ones + 1) / (len(y) - ones + 1)), cfg)
    rng = np.random.default_rng(cfg.seed)
    vec = rng.uniform(-1 / cfg.dim, 1 / cfg.dim, (1 << cfg.bits, cfg.dim)).astype(np.float32)
    out = np.zeros((2, cfg.dim), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    docs = bags(texts, cfg)
    steps, done = cfg.epochs * len(docs), 0
    for _ in range(cfg.epochs):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            rate = cfg.rate * (1 - done / steps)
            done += 1
            v = vec[ids]
            h = share @ v
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = p @ out
            out -= 0.05 * rate * np.outer(p, h)
            bias -= 0.002 * rate * p
            vec[ids] = v - rate * np.outer(share, back)
    diff = out[1] - out[0]
    return Model((vec @ diff).astype(np.float32), float(bias[1] - bias[0]), cfg)


def train(docs: DataFrame, labels: DataFrame, cfg: Config = Config(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Model:
    """Train on at most ``cfg.sample`` of the labelled rows. Of an id's
    repeated labels the largest counts; null labels don't count."""
    chosen = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(cfg.sample))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
            .join(F.broadcast(chosen), "_id").select("_id", "_t", "_y")).toPandas()
    rows = rows.sort_values(["_id", "_t"], kind="stable")
    return fit(rows["_t"].tolist(), rows["_y"].tolist(), cfg)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Column of scores of ``docs``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for part in parts:
            yield pd.Series(m.scores(part.tolist()))

    return of(F.col(text_col))
