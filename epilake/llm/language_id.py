"""Language identification by language-bitmask n-gram filters.

Each language's frequent character trigrams go into a Bloom filter. The
filters are bit-sliced: a slot holds one bit for each language, so one probe
of a trigram (the AND of its slots) returns all the languages that have it.
A text's trigrams are probed and the bits counted by language; each count
is corrected for the filter's rate of false positives, and the largest
corrected count decides.

Counting reads all training rows in parallel and sums partial counts. A
trigram is kept for a language if it makes up at least ``min_share`` of the
language's trigrams, so a language has at most 1 / min_share of them however
large the corpus, and the collected profile and broadcast filter are
bounded by that.

Letters decide, lower-cased; a run of other characters is one word end.
Null texts and texts without a letter are ``und`` with score 0. A text whose
trigrams no language has goes to the language with most training rows; so do
ties (then the lesser name). Without training rows all texts are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, codepoints, ship

UNKNOWN = "und"
HASHES = 3
#: Distinct trigrams that a counting task holds before it hands them on.
HELD = 500_000


@dataclass(frozen=True)
class Config:
    min_share: float = 2e-5     # at most 50,000 trigrams a language
    min_count: int = 2
    bits_each: int = 16         # filter slots for each trigram of the largest language


@cache
def _letters() -> np.ndarray:
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), dtype=np.bool_)


def trigrams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram keys of the texts in order, and each text's first index in
    them (one more at the end). A key is the three code points, 0 for a word end."""
    cp, at = codepoints([t.lower() if t else t for t in texts])
    starts = at.copy()
    if any(len(t.lower()) != len(t) for t in texts if t and not t.isascii()):
        lengths = np.array([len(t.lower()) if t else 0 for t in texts], dtype=np.int64)
        np.cumsum(lengths + 1, out=starts[1:])
    letter = _letters()[cp]
    c = np.where(letter, cp, 0).astype(np.uint64)
    keys = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    middle = np.flatnonzero(letter[1:-1])
    return keys[middle].view(np.int64), np.searchsorted(middle + 1, starts)


def _counted(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) of ``rows`` (lang, text), summed by task only."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}

        def settle(lang: str):
            parts = held[lang]
            keys = np.concatenate([k for k, _ in parts])
            n = np.concatenate([m for _, m in parts])
            u, back = np.unique(keys, return_inverse=True)
            held[lang] = [(u, np.bincount(back, n).astype(np.int64))]
            return len(u)

        def handed():
            for lang in list(held):
                settle(lang)
                (u, n), = held.pop(lang)
                yield pd.DataFrame({"lang": lang, "gram": u, "n": n})

        for b in batches:
            for lang, part in b.groupby("lang", sort=True):
                texts = part["text"].tolist()
                for i, j in chunks(texts):
                    held.setdefault(lang, []).append(np.unique(trigrams(texts[i:j])[0], return_counts=True))
            if sum(settle(lang) for lang in list(held)) > HELD:
                yield from handed()
        yield from handed()

    return rows.mapInPandas(run, "lang string, gram long, n long")


@dataclass
class Filters:
    """Bit-sliced Bloom filters: ``slots`` (slot, word of 64 languages)."""

    langs: list[str]            # by training rows, most first
    slots: np.ndarray
    false_rate: np.ndarray      # by language

    @staticmethod
    def build(langs: Sequence[str], grams: dict[str, np.ndarray], cfg: Config) -> Filters:
        most = max([len(grams.get(x, ())) for x in langs], default=1)
        bits = max(10, int(np.ceil(np.log2(max(1, most) * cfg.bits_each))))
        slots = np.zeros((1 << bits, (len(langs) + 63) // 64 or 1), dtype=np.uint64)
        for k, x in enumerate(langs):
            for at in Filters._places(grams.get(x, np.zeros(0, np.int64)), bits):
                slots[at, k // 64] |= np.uint64(1 << (k % 64))
        fill = np.array([((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(langs))])
        return Filters(list(langs), slots, fill ** HASHES)

    @staticmethod
    def _places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        h = keys.view(np.uint64)
        for k in range(HASHES):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
            yield (h >> np.uint64(64 - bits)).astype(np.int64)

    def languages(self, keys: np.ndarray) -> np.ndarray:
        """The mask of languages of each trigram (trigram, word)."""
        mask = None
        for at in self._places(keys, int(len(self.slots)).bit_length() - 1):
            mask = self.slots[at] if mask is None else mask & self.slots[at]
        return mask

    def decide(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for i, j in chunks(texts):
            keys, at = trigrams(texts[i:j])
            n = np.diff(at).astype(np.float64)
            fixed = np.zeros((len(self.langs), j - i))
            mask = self.languages(keys)
            total = np.zeros(len(keys) + 1, dtype=np.int64)
            for k, p in enumerate(self.false_rate):
                np.cumsum((mask[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1), dtype=np.int64, out=total[1:])
                fixed[k] = ((total[at[1:]] - total[at[:-1]]) - n * p) / max(1 - p, 1e-9)
            fixed = np.maximum(fixed, 0)
            if not self.langs:
                names += [UNKNOWN] * (j - i)
                continue
            best = fixed.argmax(axis=0)
            scores[i:j] = np.minimum(fixed.max(axis=0) / np.maximum(n, 1), 1)
            names += [self.langs[k] if m else UNKNOWN for k, m in zip(best, n)]
        return names, scores


def train(rows: DataFrame, cfg: Config = Config(), text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from rows with a language; others don't count."""
    ship(rows.sparkSession)
    rows = rows.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    size = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    langs = [r.lang for r in size.orderBy(F.desc("rows"), "lang").collect()]
    counts = (_counted(rows.filter(F.col("text").isNotNull())).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = counts.checkpoint()
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    profile = (counts.join(F.broadcast(total), "lang")
               .filter((F.col("n") >= cfg.min_share * F.col("total")) & (F.col("n") >= cfg.min_count))
               .select("lang", "gram")).toPandas()
    grams = {x: np.sort(part["gram"].to_numpy(np.int64)) for x, part in profile.groupby("lang")}
    return Filters.build(langs, grams, cfg)


def predict(docs: DataFrame, filters: Filters, text_col: str = "text") -> Column:
    """Column of structs (lang, score)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("lang string, score double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = shared.value
        for part in parts:
            names, scores = f.decide(part.tolist())
            yield pd.DataFrame({"lang": names, "score": scores})

    return of(F.col(text_col))
