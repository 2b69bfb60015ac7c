"""Columns of the caller's own beside the operators' helper columns, odd rows
in every pipeline stage, and one exchange of text a stage."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import epilake.llm
from epilake.llm import (exact_dedup, language_id, license_scan, mixing, pii, quality_classifier, queries, simhash)
from epilake.llm.common import materialise

FOLDER = os.path.dirname(epilake.llm.__file__)
SOURCE = "".join(open(os.path.join(FOLDER, f)).read() for f in sorted(os.listdir(FOLDER)) if f.endswith(".py"))
#: Every name that looks like a helper column of the subpackage.
HELPERS = sorted({n.lower() for n in re.findall(r'["\'](_[a-z0-9]+)["\']', SOURCE, re.I)} | {
    "id", "n", "fp", "digest", "keep_id", "size", "start", "slot", "block", "words", "value", "ids", "score", "piece", "copy"})
PROSE = "The quick brown fox jumps over the lazy dog and runs on through the field of corn again. "


def rows():
    texts = [None, "", " ", PROSE * 4, PROSE * 4, PROSE * 4 + "extra tail", "a b c", "word " * 30_000]
    out = [(i, t, ["en", None][i % 2], ["s1", "s2", None][i % 3], i) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, "a b c", None, None, None), (None, None, "en", "s1", 1), (None, None, "en", "s1", 1)]
    return out + [(100 + i, f"{PROSE} number {i * i} of many and {'more ' * (i % 7)}", "en", "s1", 1) for i in range(90)]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def wide(spark, plain):
    """The same rows with a column of each helper name, and the id's own hash in all."""
    return plain.select("*", *[F.xxhash64(F.lit(n), "doc_id", "text").alias(n) for n in HELPERS])


def same(a, b):
    return sorted(map(str, a)) == sorted(map(str, b))


PASS_THROUGH = {
    "exact": lambda spark, docs: exact_dedup.deduplicated(docs, queries.new_index(spark)),
    "near": lambda spark, docs: simhash.one_of_each(docs),
    "mix": lambda spark, docs: mixing.mixed_documents(docs),
    "quality": lambda spark, docs: docs.filter(quality_classifier.score(
        docs, quality_classifier.fit([PROSE, "a b c"], [1, 0])) >= 0.0),
}


@pytest.mark.parametrize("name", sorted(PASS_THROUGH))
def test_columns_of_every_helper_name_pass_through(spark, plain, wide, name):
    assert len(HELPERS) > 40
    got = materialise(PASS_THROUGH[name](spark, wide), "clash")
    assert got.columns == wide.columns
    want = PASS_THROUGH[name](spark, plain)
    assert same(got.select(plain.columns).collect(), want.collect())
    if name != "mix":   # whose texts may be parts
        for n in HELPERS:
            got = got.filter(F.col(n) == F.xxhash64(F.lit(n), "doc_id", "text"))
        assert got.count() == want.count()


def fixed(spark, docs):
    filters = language_id.train(docs.select("text", "lang"))
    model = pii.SemiCrf()
    return {
        "op1": docs.select("doc_id", language_id.predict(docs, filters).alias("p")).select("doc_id", "p.*"),
        "op2": exact_dedup.dedup(docs, queries.new_index(spark)),
        "op4": license_scan.scan(docs),
        "op5": mixing.words_taken(docs),
        "op10": docs.select("doc_id", pii.find(docs, model).alias("p")).select("doc_id", "p.*"),
    }


def test_results_do_not_depend_on_other_columns(spark, plain, wide):
    a, b = fixed(spark, plain), fixed(spark, wide)
    for name in a:
        assert a[name].columns == b[name].columns, name
        assert same(a[name].collect(), b[name].collect()), name


def test_stages_on_odd_rows_and_an_empty_table(spark, plain, tmp_path):
    sf = f"file://{tmp_path}"
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(100, 190)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{sf}/labels.parquet")
    for docs in (plain, plain.limit(0)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, docs, sf), f"odd-{name}")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == plain.columns
            if not n:
                assert out.count() == 0
            docs = out
    exact = corpus_pipeline.exact(spark, plain, sf)
    norm = {re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t, *_ in rows()}
    got = exact.collect()
    assert len(got) == len(norm) and {re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in got} == norm


@pytest.mark.parametrize("name", ["exact", "near", "mix"])
def test_one_exchange_carries_the_text(spark, plain, name):
    path = materialise(plain, "texts")
    plan = PASS_THROUGH[name](spark, path)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    # an exchange whose child puts out the text
    carrying = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x
                and re.search(r"\btext#\d+|first\(text", lines[i + 1])]
    assert len(carrying) == 1, plan


def test_a_row_with_very_many_copies(spark):
    n = 3 * exact_dedup.COPIES + 7
    docs = spark.range(n).selectExpr("IF(id < 5, id, NULL) AS doc_id", "IF(id = 3, 'x', '') AS text")
    got = exact_dedup.dedup(docs, queries.new_index(spark)).groupBy("doc_id", "kept", "group_size").count().collect()
    by = {(r.doc_id, r.kept): (r["count"], r.group_size) for r in got}
    assert by == {(0, True): (1, n - 1), (1, False): (1, n - 1), (2, False): (1, n - 1), (3, True): (1, 1),
                  (4, False): (1, n - 1), (None, False): (n - 5, n - 1)}
