"""Near-duplicates by SimHash, found through a byte-position inverted index.

A fingerprint of 64 bits is eight positional bytes. Two fingerprints that
differ in at most ``max_bits`` (2) bits share at least six of them, so of
the four 2-byte blocks at least two are wholly shared. The inverted index
therefore has a posting list for each pair of blocks and their four bytes
(six entries a fingerprint). Pairs within a posting list are tallied on
their shared positional bytes, those below six are dropped, and the rest
are verified by the bit distance.

A posting list longer than ``PAIRS_MAX`` fingerprints emits no pairs. Its
members take an exact way instead: each fingerprint is posted under itself
and its 64 one-bit neighbours, and two fingerprints within two bits share
one of these. All members of such a list are within two bits of each other,
so linking each to the least member loses no link and needs no pairs.

Equal fingerprints are one node throughout, counted before any shuffle.
Components come from alternating large-star and small-star rounds over
the links alone, each round written to the checkpoint folder.

Null text has no words; a text without words has fingerprint zero, which
links like any other. Rows with equal ids are fingerprinted on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import SPACE, keep_rows, mark, materialise, ship

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BYTES = 8
#: Posting lists up to this length emit their pairs (at most 31 a member).
PAIRS_MAX = 32

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORDS = regex.compile(f"[^{SPACE}]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text, unsigned: a bit is set if it is set in over half
    the shingles' hashes."""
    words = _WORDS.findall(text.translate(_LOWER)) if text else []
    if not words:
        return 0
    coded = " ".join(words).encode("utf-8", "surrogatepass")
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(coded, SEED)
    gaps = np.flatnonzero(np.frombuffer(coded, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(words) - shingle + 1].tolist()
    ends = np.concatenate((gaps, [len(coded)]))[shingle - 1:].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(coded[a:b], SEED) for a, b in zip(starts, ends)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):  # memory stays level on very long texts
        bits = np.unpackbits(hashes[i:i + 4096].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) long."""
    @F.pandas_udf(LongType())
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in part], dtype=np.uint64).view(np.int64))

    return of(text)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255).cast("long"))


def index(fps: DataFrame) -> DataFrame:
    """The inverted index of distinct ``fp``: rows (entry, key, fp)."""
    block = [F.shiftrightunsigned("fp", 16 * b).bitwiseAND(F.lit(0xFFFF).cast("long")) for b in range(4)]
    entries = F.array(*[
        F.struct(F.lit(n).alias("entry"), F.shiftleft(block[a], 16).bitwiseOR(block[b]).alias("key"))
        for n, (a, b) in enumerate(combinations(range(4), 2))])
    return fps.select("fp", F.explode(entries).alias("e")).select("e.entry", "e.key", "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, pairs_max: int = PAIRS_MAX) -> DataFrame:
    """Links (a, b) between distinct ``fp`` that join exactly those within
    ``max_bits`` bits (not every such pair is listed)."""
    if max_bits > 2:
        raise ValueError("two shared blocks of four are guaranteed up to two bits")
    postings = index(fps)
    # a list's length, without gathering it
    lengths = postings.groupBy("entry", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = materialise(postings.join(lengths, ["entry", "key"]), "postings")
    lists = (sized.filter(F.col("n") <= pairs_max).groupBy("entry", "key")
             .agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    pairs = (lists.select("fps", F.explode("fps").alias("a"))
             .select("a", F.explode(F.filter("fps", lambda x: x > F.col("a"))).alias("b")))
    tally = sum(((_byte(F.col("a"), i) == _byte(F.col("b"), i)).cast("int") for i in range(BYTES)), F.lit(0))
    near = (pairs.filter(tally >= BYTES - max_bits)
            .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    crowded = sized.filter(F.col("n") > pairs_max).select("fp").distinct()
    if max_bits == 2:
        flips = [F.lit(0).cast("long")] + [F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)]
        met = crowded.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(f) for f in flips])).alias("at"))
        met = met.groupBy("at").agg(F.sort_array(F.collect_list("fp")).alias("fps")).filter(F.size("fps") > 1)
        stars = met.select(F.col("fps")[0].alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    else:  # equal up to one bit: one end is the other's neighbour
        flips = [F.shiftleft(F.lit(1).cast("long"), i) for i in range(64 if max_bits else 0)]
        met = (crowded.select(F.col("fp").alias("a"), F.explode(
            F.array(*[F.col("fp").bitwiseXOR(f) for f in flips]) if flips else F.array().cast("array<bigint>")).alias("b")))
        stars = met.join(crowded.withColumnRenamed("fp", "b"), "b", "left_semi").filter("a < b")
    return near.unionByName(stars.select("a", "b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of each node of ``edges`` (a, b); the root is the least
    node of the component. Large-star and small-star by turns until nothing
    changes; each round is checkpointed."""
    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")

    def large(e: DataFrame) -> DataFrame:
        n = both(e)
        m = least(n).select("u", F.least("m", "u").alias("m"))
        return n.join(m, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        # larger end first; the larger end and its smaller neighbours move to the least of them
        d = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
        m = least(d)
        moved = d.join(m, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(m.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.hash("b", "a").cast("long"))).first()

    e = small(edges).checkpoint()
    was = state(e)
    for _ in range(max_rounds):
        e = small(large(e)).checkpoint()
        now = state(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs``: id, ``fp`` (long), ``component_id`` (the
    least id linked to it, its own included; null ids count only if there is
    no other), and the columns named in ``keep``."""
    ship(docs.sparkSession)
    rows = materialise(docs.select(F.col(id_col).alias(id_col), *keep,
                                   fingerprints(F.col(text_col), shingle).alias("fp")), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.min(id_col).alias("least_id")), "distinct-fingerprints")
    nodes = components(links(fps.select("fp"), max_bits))
    comp = (fps.join(nodes, F.col("fp") == F.col("node"), "left")
            .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    ids = comp.groupBy("root").agg(F.min("least_id").alias("component_id"))
    comp = comp.select("fp", "root").join(ids, "root").select("fp", "component_id")
    # many rows may share a fingerprint; Spark splits such a partition of the left side
    return rows.join(comp, "fp").select(id_col, *keep, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` reduced to the row with the least id of each component."""
    text_hash = F.xxhash64(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), text_hash.alias("_th"))
    found = near_duplicates(rows, "_id", "_text", shingle, max_bits, keep=("_th",))
    kept = found.filter(F.col("_id").eqNullSafe(F.col("component_id")))
    # rows with one id in one component: the least text hash stays
    kept = kept.groupBy("_id", "component_id").agg(F.min("_th").alias("_th"))
    return keep_rows(docs, [mark(F.col(id_col)), text_hash], kept.select(mark(F.col("_id")), "_th"))
