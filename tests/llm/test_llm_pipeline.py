"""The corpus pipeline, stage by stage, against brute force."""

import re
from collections import Counter

from brute import brute_components, brute_fingerprint, brute_groups, brute_targets
from conftest import SF01

import corpus_pipeline
from epilake.llm.common import materialise

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF01), f"test-{name}")
        seen[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    before, after = seen["quality_classifier"]
    kept = {r["doc_id"] for r in after}
    assert all(r["doc_id"] in kept for r in before if labels.get(r["doc_id"]) == 1)
    assert sum(r["doc_id"] in kept for r in before if labels.get(r["doc_id"]) == 0) <= 3
    before, after = seen["exact_dedup"]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(min(v) for v in groups.values())
    before, after = seen["simhash"]
    comp = brute_components([brute_fingerprint(r["text"]) for r in before])
    least = {}
    for r in before:
        c = comp[brute_fingerprint(r["text"])]
        least[c] = min(r["doc_id"], least.get(c, r["doc_id"]))
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())
    before, after = seen["mixing"]
    sizes, got = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in after:
        got[r["source"]] += len(WORD.findall(r["text"]))
    assert all(abs(got[s] - t) <= 1 for s, t in brute_targets(sizes).items())
    before, after = seen["sentencepiece"]
    assert len(before) == len(after) and all(r["round_trip"] and r["n_ids"] for r in after)
