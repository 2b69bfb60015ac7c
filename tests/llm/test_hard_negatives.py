"""Hard negatives: exact scores against Python integers, results against brute force."""

import math
import random

import numpy as np
import pytest
from conftest import SF01
from oracle import compare, duck
from pyspark.sql import functions as F

from epilake.llm import hard_negatives as hn
from epilake.llm import queries

SCHEMA = "vec_id long, label int, embedding array<double>, id long, v string, g long, score string, rank int"


def test_query_equals_sql(spark):
    problems, n = compare(queries.op12_hard_negatives(spark, SF01), duck(SF01), hn.ORACLE)
    assert not problems and n


@pytest.mark.parametrize("size", [1, 160, 2.0**20, 2.0**31, 2.0**60, 2.0**136, 2.0**900])
@pytest.mark.parametrize("d", [0, 1, 64, 2500])
def test_scores_are_exact(size, d):
    rng = np.random.default_rng(d)
    a, b = (np.floor(rng.uniform(-size, size, (n, d))) for n in (9, 4))
    if d:
        a[0], b[0], b[1] = size, size, -size
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b.tolist()] for u in a.tolist()]
    got = hn.scores(a, hn.Anchors(b)).tolist()
    assert got == [[w if -2**63 < w < 2**63 else hn.LEAST for w in row] for row in want]


def test_primes():
    assert hn.PRIMES[:3] == [251, 241, 239] and hn.PRIMES[-1] == 3
    assert (hn.PRIMES[0] // 2) ** 2 * hn.PIECE < 2**24
    assert hn.moduli(10) == [251] and math.prod(hn.moduli(2.0**40)) > 2**41 and hn.moduli(2.0**400) is None


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    ok = [(i, c, [math.floor(256 * x) for x in v]) for i, c, v in rows
          if c is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)]
    out = []
    for a, label, q in sorted({(i, c, tuple(v)) for i, c, v in ok if i is not None and is_anchor(i)}):
        pool = [(sum(x * y for x, y in zip(q, v)), i, c) for i, c, v in ok if len(v) == len(q) and i != a]
        pool = sorted(((s, i, c) for s, i, c in pool if -2**63 < s < 2**63),
                      key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for ps, p, _ in [r for r in pool if r[2] == label][:positives]:
            inside = [r for r in pool if r[2] != label and low * ps <= 100 * r[0] <= high * ps]
            out += [(a, p, k, i, ps, s) for k, (s, i, _) in enumerate(inside[:negatives], 1)]
    return out


def result(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect()), key=str)


@pytest.mark.parametrize("group_bytes", [hn.GROUP_BYTES, 400])
def test_odd_rows(spark, group_bytes):
    rng = random.Random(1)
    spot = [rng.uniform(-1, 1) for _ in range(8)]
    rows = [(i, rng.choice([0, 1, 1, 2, None]), [x + rng.gauss(0, 0.3) for x in spot]) for i in range(300)]
    rows += [(1000 + i, 1, spot) for i in range(60)]                                 # one hot vector, ties
    rows += [(2000 + i, i % 3, [round(rng.uniform(-1, 1), 1)] * 3) for i in range(40)]  # another length
    rows += [(i, 2, v) for i, v in ((0, None), (3000, []), (3001, []), (3002, [float("nan")] * 8),
                                    (3003, [None] + spot[1:]), (3004, [float("inf")] * 8), (3005, [1e308] * 8),
                                    (3006, [1e30] * 8), (3010, [1e9] * 8), (3011, [9e8] * 8))]
    rows += [(None, 1, spot), (None, None, spot), rows[5], rows[5], rows[20], rows[20], (20, 0, spot)]
    df = spark.createDataFrame([(*r, 9, "clash", 9, "clash", 9) for r in rows], SCHEMA).repartition(5)
    got = hn.mine(df, F.col("vec_id") % 10 == 0, group_bytes=group_bytes)
    assert result(got) == sorted(brute(rows, lambda i: i % 10 == 0), key=str)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, [0.5], 0, "", 0, "", 0), (2, 2, [0.5], 0, "", 0, "", 0)], SCHEMA)
    assert hn.mine(df.limit(0), F.col("vec_id") >= 0).collect() == []
    assert hn.mine(df, F.col("vec_id") > 5).collect() == []
    assert hn.mine(df, F.col("vec_id") == 1).collect() == []
