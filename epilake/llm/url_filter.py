"""URL filter: rules, then a character language-model ratio.

Rules name a host and the start of a path; a rule fits the host and its
subdomains, and the longest that fits decides. The addresses that rules
allow and block are also examples: two variable-order Markov models over
characters are trained on them, one of accepted and one of rejected
addresses. A model blends its orders from 0 up to ``ORDER``: the estimate
after a context is the count in it plus ``PRIOR`` times the estimate after
the context shortened by one character, so contexts that were never seen
fall back by themselves.

An address without a rule is judged by the difference of the two models'
log-likelihoods divided by its length, against a threshold calibrated on
examples that were kept out of the counts (one in ``CALIBRATE``): the value
with the largest sum of both classes' rates of right verdicts.

DataFrame operations only. Counts are of distinct addresses, gathered once
as counts of windows of ORDER + 1 characters; each lower order sums the one
above. Null addresses and those without ``://`` have an empty host and
path, fit no rule and are judged as the empty string. Without examples of
both classes all addresses without a rule are allowed. An address of any
length is cut in one pass; repeated ones are judged once; an empty table gives
no rows; other columns aren't read.

The table of ratios has a row per window that occurs, so it grows with the
characters in use, not with the addresses (at most 65 million rows for the 36
letters and digits, far fewer in fact). Spark broadcasts it below its threshold
and shuffles the windows beyond.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: (verdict, host, path) (fixed values of the contract).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
ORDER = 4
PRIOR = 5.0
#: Chance of a character that neither model has, at order -1.
UNIFORM = 1 / 256
CALIBRATE = 5
#: Scores are calibrated in steps of 1 / BINS.
BINS = 64
EDGE = "\x02"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER), F.regexp_extract(url, parts, 2))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    return rule, verdict


def _grams(rows: DataFrame) -> DataFrame:
    """``rows`` with each window of the address (column s) as ``gram``; the
    last character is the one to be told, what stands before it the context.
    One pass over the address: a match is one character, its group the window."""
    padded = F.concat(F.lit(EDGE * ORDER), F.col("s"), F.lit(EDGE))
    window = F.lit(f"(?s)(?=(.{{{ORDER + 1}}})).")
    return rows.withColumn("gram", F.explode(F.regexp_extract_all(padded, window, 1)))


def gram_ratios(addresses: DataFrame) -> DataFrame:
    """(gram, ratio) of all windows of ``addresses`` (s, label): the log of
    the accepted over the rejected model's estimate. Rows with label
    ``allow`` or ``block`` are counted, others only need estimates."""
    top = materialise(_grams(addresses.select("s", "label")).groupBy("gram").agg(
        F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b")),
        "url-windows")
    below = None
    for k in range(ORDER + 1):
        level = (top if k == ORDER else top.groupBy(F.substring("gram", ORDER + 1 - k, k + 1).alias("gram"))
                 .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
        context = F.substring("gram", 1, k) if k else F.lit("")
        level = level.withColumn("context", context)
        total = level.groupBy("context").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
        level = level.join(total, "context")
        if below is None:
            level = level.withColumns({"qa": F.lit(UNIFORM), "qb": F.lit(UNIFORM)})
        else:
            level = level.join(below.select(F.col("gram").alias("_s"), F.col("pa").alias("qa"), F.col("pb").alias("qb")),
                               F.substring("gram", 2, k) == F.col("_s"))
        below = materialise(level.select(
            "gram", ((F.col("a") + PRIOR * F.col("qa")) / (F.col("na") + PRIOR)).alias("pa"),
            ((F.col("b") + PRIOR * F.col("qb")) / (F.col("nb") + PRIOR)).alias("pb")), f"url-order-{k}")
    return below.select("gram", F.log(F.col("pa") / F.col("pb")).alias("ratio"))


def scores(addresses: DataFrame) -> DataFrame:
    """(s, example, score) of distinct ``addresses`` that are not counted:
    length-normalised log ratio."""
    ratios = gram_ratios(addresses)
    left = addresses.filter(F.col("label").isNull()).withColumn("digest", F.unhex(F.sha2("s", 256)))
    # windows carry a digest: carrying the address would grow with the square of its length.
    # A window that most addresses share is one row of ratios; Spark splits the windows' side
    found = (_grams(left.select("digest", "s")).select("digest", "gram").join(ratios, "gram").groupBy("digest")
             .agg((F.sum("ratio") / F.count(F.lit(1))).alias("score")))
    return left.join(found, "digest").select("s", "example", "score")


def threshold(scored: DataFrame) -> float:
    """Calibrated on ``scored`` (example: allow or block): the least step
    with the most right verdicts, each class counted as a share; 0 without
    examples of both."""
    steps = (scored.filter(F.col("example").isNotNull())
             .groupBy(F.floor(F.col("score") * BINS).alias("bin"))
             .agg(F.count_if(F.col("example") == "allow").alias("a"), F.count_if(F.col("example") == "block").alias("b")))
    # one row a step: log ratios are bounded by the models' smallest estimates
    low = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    high = Window.orderBy("bin").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    right = steps.select("bin", (F.coalesce(F.sum("b").over(low), F.lit(0)) / F.sum("b").over(whole)
                                 + F.sum("a").over(high) / F.sum("a").over(whole)).alias("right"),
                         F.sum("a").over(whole).alias("na"), F.sum("b").over(whole).alias("nb"))
    best = (right.filter("na > 0 AND nb > 0").orderBy(F.desc(F.round("right", 9)), "bin").limit(1)).collect()
    return best[0].bin / BINS if best else -math.inf


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """A row per row: id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = materialise(rows.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("_v")), "urls")
    # copies of an address are one; a share of the examples calibrates
    marked = rows.select(F.concat("host", "path").alias("s"), F.col("_v").alias("example")).distinct()
    held = F.conv(F.substring(F.md5("s"), 1, 8), 16, 10).cast("long") % CALIBRATE == 0
    marked = marked.select("s", F.when(~held, F.col("example")).alias("label"),
                           F.when(held, F.col("example")).alias("example"))
    scored = materialise(scores(marked), "url-scores")
    least = threshold(scored)
    left = scored.filter(F.col("example").isNull()).select("s", "score")
    ruled = rows.filter(F.col("_v").isNotNull()).select(
        id_col, "host", "path", "rule", F.col("_v").alias("verdict"), F.lit(None).cast("double").alias("score"))
    rest = (rows.filter(F.col("_v").isNull()).withColumn("s", F.concat("host", "path")).join(left, "s")
            .select(id_col, "host", "path", "rule",
                    F.when(F.col("score") >= least, "allow").otherwise("block").alias("verdict"), "score"))
    return ruled.unionByName(rest)


def oracle_sql(rules=RULES) -> str:
    """The result of the query over ``pages`` in DuckDB."""
    def case(value) -> str:
        arms = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(what, h, p)}'"
            for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])))
        return f"CASE {arms} END"

    parts = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    levels = []
    for k in range(ORDER + 1):
        rest = f"JOIN o{k - 1} u ON substr(l.gram, 2, {k}) = u.gram" if k else ""
        qa, qb = ("u.pa", "u.pb") if k else (f"{UNIFORM}::DOUBLE",) * 2
        levels.append(f"""
l{k} AS (SELECT substr(gram, {ORDER + 1 - k}, {k + 1}) AS gram, sum(a) AS a, sum(b) AS b FROM top GROUP BY 1),
c{k} AS (SELECT substr(gram, 1, {k}) AS context, sum(a) AS na, sum(b) AS nb FROM l{k} GROUP BY 1),
o{k} AS (SELECT l.gram, (l.a + {PRIOR}::DOUBLE * {qa}) / (na + {PRIOR}::DOUBLE) AS pa,
           (l.b + {PRIOR}::DOUBLE * {qb}) / (nb + {PRIOR}::DOUBLE) AS pb
         FROM l{k} l JOIN c{k} c ON substr(l.gram, 1, {k}) = c.context {rest}),""")
    grams = (f"unnest(list_transform(generate_series(1, length(s) + 1), "
             f"lambda i: substr(repeat(chr(2), {ORDER}) || s || chr(2), i, {ORDER + 1})))")
    return f"""
WITH h AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), {parts}, 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(url, ''), {parts}, 2) AS path FROM pages),
r AS (SELECT *, host || path AS s, {case(lambda w, h, p: h + p)} AS rule, {case(lambda w, h, p: w)} AS v FROM h),
d AS (SELECT DISTINCT s, v, CAST('0x' || substr(md5(s), 1, 8) AS BIGINT) % {CALIBRATE} = 0 AS held FROM r),
m AS (SELECT s, CASE WHEN NOT held THEN v END AS label, CASE WHEN held THEN v END AS example FROM d),
g AS (SELECT *, {grams} AS gram FROM m),
top AS (SELECT gram, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b FROM g GROUP BY 1),
{"".join(levels)}
sc AS (SELECT s, example, sum(ln(pa / pb)) / count(*) AS score FROM g JOIN o{ORDER} USING (gram)
       WHERE label IS NULL GROUP BY s, example),
st AS (SELECT CAST(floor(score * {BINS}) AS BIGINT) AS bin, count(*) FILTER (example = 'allow') AS a,
         count(*) FILTER (example = 'block') AS b FROM sc WHERE example IS NOT NULL GROUP BY 1),
rt AS (SELECT bin, coalesce(sum(b) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           / sum(b) OVER () + sum(a) OVER (ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           / sum(a) OVER () AS good, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM st),
best AS (SELECT bin / {BINS}::DOUBLE AS least FROM rt WHERE na > 0 AND nb > 0 ORDER BY round(good, 9) DESC, bin LIMIT 1)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN score >= coalesce((SELECT least FROM best), '-inf'::DOUBLE)
         THEN 'allow' ELSE 'block' END) AS verdict
FROM r LEFT JOIN (SELECT s, score FROM sc WHERE example IS NULL) sc USING (s)
"""
