"""Quality rules and robust multivariate outliers.

Each text's words, symbols, repeated lines and repeated 8-word windows are
counted within its row. Texts that fail the base rules are out. The others
are transformed into a vector (word length, symbols, repeated lines,
repeated words) and held against the bulk of their language and source: a
minimum-covariance-determinant estimate of centre and scatter, and the
Mahalanobis distance of the vector from it.

The estimate has several fixed starts (medians and absolute deviations; mean
and covariance of all rows; those of the rows nearest the medians on their
worst axis) and takes concentration steps from each: centre and scatter of the
kept rows, distances of all rows, the nearest 75 % kept, until no group's
determinant changes. Of a group's starts the one with the least determinant
counts. Each step is a map-side combined aggregation by group and start over a
narrow written table; a hot group is a partial row a task.
The scatter's inverse is a Cholesky factorisation written out as columns.
A group of fewer than ``MIN_ROWS`` rows uses its language's estimate, and
failing that the whole table's. Each axis has a least spread (``FLOOR``),
as most texts have no symbols or repeats at all.

DataFrame operations only. Null text has no words and fails the base
rules. Null languages and sources are groups like any other. Repeated rows
count each; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, materialise

WINDOW = 8
MIN_WORDS = 20
#: Rows of a group that has an estimate of its own.
MIN_ROWS = 60
KEEP = 0.75
#: Concentration steps at most, and the change of a log determinant that ends them.
STEPS, SETTLED = 12, 1e-3
STARTS = 3
#: Least standard deviation of each axis, in its transformed unit: a single
#: repeated line or passage of a short text is no outlier by itself.
FLOOR = (0.02, 0.03, 0.05, 0.1)
#: A mean word length is taken as if the text had so many more words of five letters.
PRIOR_WORDS, PRIOR_LENGTH = 50, 5.0
#: Share of a normal bulk beyond the distance at which a vector is rejected:
#: real tails are heavier than normal ones, so a far quantile.
TAIL = 1e-9
ACCURACY = 10_000
#: A group's estimate meets its rows in so many parts, so that a hot group is split.
SALTS = 32
AXES = ("x0", "x1", "x2", "x3")


def windows(hashed: Column) -> Column:
    """Hashes of the 8-word windows, in order. ``hashed`` (the words' hashes)
    is a column of the input: an expression would be computed again for each window."""
    last = F.size(hashed) - WINDOW + 1
    return F.when(last > 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                        lambda i: F.xxhash64(F.slice(hashed, i, WINDOW)))
                  ).otherwise(F.array().cast("array<bigint>"))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumns({"_text": text, "_words": F.regexp_extract_all(text, F.lit(f"({WORD})"))})
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)),
        "n_symbols": F.char_length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
        "_lines": F.filter(F.split("_text", "\n"), lambda s: s.rlike(f"[^{SPACE}]")),
        "_hashed": F.transform("_words", lambda w: F.xxhash64(w))})
    rows = rows.withColumn("_win", windows(F.col("_hashed")))
    rows = rows.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_again": F.size(F.array_distinct("_win")) < F.size("_win")})
    # only texts with a window found twice go on to say where
    rows = rows.withColumn("_at", F.when(F.col("_again"), F.array_sort(F.transform(
        "_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("_at", F.array_sort(F.transform(F.filter("_at", lambda x, k: (
        F.coalesce(F.get("_at", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_at", k + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"])))
    gap = F.aggregate(
        "_at", F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("p"), (a["n"] + F.least(p - a["p"], F.lit(WINDOW))).alias("n")))["n"]
    rows = rows.withColumn("n_repeat_words", F.coalesce(gap, F.lit(0).cast("long")))
    return rows.drop("_text", "_words", "_lines", "_hashed", "_win", "_again", "_at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vectors(rows: DataFrame) -> DataFrame:
    """The transformed statistics: log of the mean word length, square roots
    of the shares of symbols, repeated lines and repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return rows.withColumns({
        "x0": F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH) / (n + PRIOR_WORDS)),
        "x1": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "x2": F.sqrt(F.col("n_dup_lines") / n),
        "x3": F.sqrt(F.col("n_repeat_words") / n)})


def _chi2(x: float, k: int) -> float:
    """Chi-square distribution function, even degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def cutoff(tail: float = TAIL, k: int = len(AXES)) -> float:
    """Squared distance that a share of ``tail`` of normal rows is beyond (47.9
    for four axes and one in 10^9)."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        # the upper tail itself: 1 - _chi2 would lose its digits
        over = math.exp(-mid / 2) * sum((mid / 2) ** i / math.factorial(i) for i in range(k // 2))
        lo, hi = (mid, hi) if over > tail else (lo, mid)
    return hi


def consistency(keep: float, k: int) -> float:
    """What the scatter of the nearest ``keep`` of normal rows must be multiplied by."""
    lo, hi = 0.0, 100.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2(mid, k) < keep else (lo, mid)
    return keep / _chi2(lo, k + 2)


def _mahalanobis(rows: DataFrame) -> DataFrame:
    """``rows`` (axes, centre m*, factor l*) with the squared distance ``d``."""
    y: list[Column] = []
    for i in range(len(AXES)):
        r = F.col(AXES[i]) - F.col(f"m{i}")
        for j in range(i):
            r = r - F.col(f"l{i}{j}") * F.col(f"_y{j}")
        rows = rows.withColumn(f"_y{i}", r / F.col(f"l{i}{i}"))
        y.append(F.col(f"_y{i}"))
    return rows.withColumn("d", sum((v * v for v in y[1:]), y[0] * y[0])).drop(*[f"_y{i}" for i in range(len(AXES))])


def _factor(stats: DataFrame, scale: float) -> DataFrame:
    """Cholesky factor of the scatter (columns s*, centre m*), one column a step."""
    p = len(AXES)
    for i in range(p):
        for j in range(i + 1):
            v = F.col(f"s{i}{j}") * scale + (FLOOR[i] ** 2 if i == j else 0.0)
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            stats = stats.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(FLOOR[i] ** 2 * 1e-3))) if i == j
                                     else v / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in range(1, p)), F.log("l00")) * 2
    return stats.select("g", "start", *[f"m{i}" for i in range(p)],
                        *[f"l{i}{j}" for i in range(p) for j in range(i + 1)], det.alias("det"))


def _salted(small: DataFrame) -> DataFrame:
    """A table of one row per group, each repeated for every salt."""
    return small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _moments(rows: DataFrame) -> DataFrame:
    """Centre and scatter by group and start."""
    p = len(AXES)
    return rows.groupBy("g", "start").agg(
        *[F.avg(a).alias(f"m{i}") for i, a in enumerate(AXES)],
        *[F.covar_pop(AXES[i], AXES[j]).alias(f"s{i}{j}") for i in range(p) for j in range(i + 1)])


def _started(rows: DataFrame) -> DataFrame:
    """Centre and factor by group and start to begin the steps from."""
    p = len(AXES)
    mid = materialise(rows.groupBy("g").agg(
        *[F.percentile_approx(a, 0.5, ACCURACY).alias(f"m{i}") for i, a in enumerate(AXES)]), "mcd-middle")
    off = rows.join(_salted(mid), ["g", "_salt"])
    mad = materialise(off.groupBy("g").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(p)],
        *[(F.percentile_approx(F.abs(F.col(a) - F.col(f"m{i}")), 0.5, ACCURACY) * 1.4826 + FLOOR[i]).alias(f"a{i}")
          for i, a in enumerate(AXES)]), "mcd-spread")
    # the worst axis, in spreads: half of the rows are nearer than its median
    worst = F.greatest(*[F.abs(F.col(a) - F.col(f"m{i}")) / F.col(f"a{i}") for i, a in enumerate(AXES)])
    far = rows.join(_salted(mad), ["g", "_salt"]).select("g", "_salt", worst.alias("worst"), *AXES)
    half = materialise(far.groupBy("g").agg(F.percentile_approx("worst", 0.5, ACCURACY).alias("half")), "mcd-half")
    near = far.join(_salted(half), ["g", "_salt"]).filter(F.col("worst") <= F.col("half"))
    diagonal = mad.select("g", F.lit(0).alias("start"), *[f"m{i}" for i in range(p)],
                          *[(F.col(f"a{i}") * F.col(f"a{i}") if i == j else F.lit(0.0)).alias(f"s{i}{j}")
                            for i in range(p) for j in range(i + 1)])
    every = _moments(rows.withColumn("start", F.lit(1)))
    middle = _moments(near.withColumn("start", F.lit(2)))
    return materialise(_factor(diagonal.unionByName(every).unionByName(middle), 1.0), "mcd-start")


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre and factor by group of ``rows`` (g, axes, and ``_salt``, by
    default made of the axes): a row per group, of the start that ends with
    the least determinant (``det``, its logarithm)."""
    if "_salt" not in rows.columns:
        rows = rows.withColumn("_salt", _salt(*AXES))
    on = ["g", "start", "_salt"]
    scale = consistency(KEEP, len(AXES))
    now = _started(rows)
    rows = rows.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(STARTS - 1))))
    for k in range(steps):
        far = _mahalanobis(rows.join(_salted(now), on)).select(*on, "d", *AXES)
        cut = materialise(far.groupBy("g", "start").agg(F.percentile_approx("d", KEEP, ACCURACY).alias("cut")), "mcd-cut")
        near = far.join(_salted(cut), on).filter(F.col("d") <= F.col("cut"))
        after = materialise(_factor(_moments(near), scale), "mcd-step")
        change = (after.join(now.select("g", "start", F.col("det").alias("was")), ["g", "start"])
                  .agg(F.max(F.abs(F.col("det") - F.col("was")))).first()[0])
        now = after
        if k and (change is None or change < SETTLED):
            break
    names = [c for c in now.columns if c != "g"]
    best = now.groupBy("g").agg(F.min_by(F.struct(*names), F.struct("det", "start")).alias("best"))
    return best.select("g", *[F.col(f"best.{c}").alias(c) for c in names if c != "start"])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """A row per row: id, the counts, ``base_failed``, ``kept``, ``distance``
    (squared; null where the base rules fail)."""
    def name(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~"))

    rows = counts(docs.select(F.col(id_col), F.col(text_col).alias("_t"), name(lang_col).alias("_lang"),
                              name(source_col).alias("_source")), "_t").drop("_t")
    rows = vectors(rows.withColumn("base_failed", base_failed())).withColumn("_salt", _salt(id_col))
    rows = materialise(rows, "statistics")
    good = rows.filter(~F.col("base_failed"))
    size = materialise(good.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n")), "group-sizes")
    langs = size.groupBy("_lang").agg(F.sum("n").alias("n_lang"))
    pair = F.concat_ws("\x01", F.lit("s"), "_lang", "_source")
    lang = F.concat_ws("\x01", F.lit("l"), "_lang")
    groups = materialise(size.join(langs, "_lang").select(
        "_lang", "_source", F.when(F.col("n") >= MIN_ROWS, pair).when(F.col("n_lang") >= MIN_ROWS, lang)
        .otherwise(F.lit("all")).alias("g")), "groups")
    uses = {r.kind for r in groups.select(F.substring("g", 1, 1).alias("kind")).distinct().collect()}
    # each estimate is made from all the rows it stands for
    parts = [good.select(pair.alias("g"), "_salt", *AXES)]
    if "l" in uses:
        parts.append(good.select(lang.alias("g"), "_salt", *AXES))
    if "a" in uses:
        parts.append(good.select(F.lit("all").alias("g"), "_salt", *AXES))
    base = parts[0]
    for part in parts[1:]:
        base = base.unionByName(part)
    found = materialise(groups.join(estimate(base), "g"), "estimates")
    far = _mahalanobis(good.join(_salted(found), ["_lang", "_source", "_salt"]))
    out = [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = far.select(*out, (F.col("d") <= cutoff()).alias("kept"), F.col("d").alias("distance"))
    return judged.unionByName(rows.filter("base_failed").select(
        *out, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))
