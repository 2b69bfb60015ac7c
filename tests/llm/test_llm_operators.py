"""The operators of llm against brute force, on sf0.001 / sf0.01 and on a
small table of odd rows."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import brute_components, brute_fingerprint, brute_groups, brute_targets
from conftest import SF01, SF001
from oracle import compare, duck
from pyspark.sql import functions as F

from epilake.llm import (exact_dedup, language_id, license_scan, mixing, pii, quality_classifier, quality_rules,
                         queries, sentencepiece_codec, simhash, url_filter)
from epilake.session import scratch_path

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, group_size long, id string, n long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def odd_rows():
    prose = "The quick brown fox jumps over the lazy dog and runs on through the field of corn again. "
    texts = [None, "", " ", "\n\t", "a", "a  b\tc", "a b c", prose * 3, prose * 3, prose * 3, LONG, LONG + " tail",
             "mail me@example.com now", "ip 10.0.0.1 and 999.1.1.1", "日本語 テキスト", "\U0001F600 emoji", "###$$$ %%%",
             "Released under the MIT License.", "x\ny\nx\n", prose + "extra"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", None, "s0"][i % 3], i, 7, "x", 3) for i, t in enumerate(texts)]
    rows += [rows[7], (None, "a b c", None, None, None, None, None, None), (None, None, "en", "s1", 1, 1, "y", 1)]
    rows += [(100 + i, f"{prose} number {i} of many", "en", "s1", 1, 1, "z", 1) for i in range(80)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# -- oracles -----------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    problems, n = compare(queries.QUERIES[name](spark, SF001), duck(SF001), queries.ORACLES[name])
    assert not problems and n


# -- language ----------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    got = queries.op1_language_id(spark, SF01).join(docs_of(spark, SF01).select("doc_id", "text", "lang"), "doc_id").collect()
    assert len(got) == 1000
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out == (r in held) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_language_filters_by_hand():
    texts = {"aa": "abc abd abc " * 5, "bb": "xyz xyw " * 5}
    grams = {k: np.unique(language_id.trigrams([t])[0]) for k, t in texts.items()}
    f = language_id.Filters.build(["bb", "aa"], grams, language_id.Config())
    for k, g in grams.items():  # a filter never misses
        bit = f.langs.index(k)
        assert all((f.languages(g)[:, 0] >> np.uint64(bit)) & np.uint64(1))
    names, scores = f.decide(["ABD abc", "xyz!", "12 34", None, "", "İxyz xyw"])
    assert names == ["aa", "bb", "und", "und", "und", "bb"] and list(scores[2:5]) == [0, 0, 0]


def test_trigrams_count(spark):
    text = "Ab, c\nüb"
    keys, at = language_id.trigrams([text, None, "a"])
    def key(s):
        return sum((0 if c == " " else ord(c)) << k for c, k in zip(s, (42, 21, 0)))
    assert keys[at[0]:at[1]].tolist() == [key(x) for x in (" ab", "ab ", " c ", " üb", "üb ")]
    assert at[1] == at[2] and keys[at[2]:].tolist() == [key(" a ")]


# -- exact dedup -------------------------------------------------------------

def test_exact_dedup_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    groups = brute_groups(rows)
    got = exact_dedup.dedup(odd, queries.new_index(spark), batches=3).collect()
    assert len(got) == len(rows)
    least = {hashlib.sha256(k.encode()).digest(): (min([i for i in v if i is not None], default=None), len(v))
             for k, v in groups.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == least[bytes(r.digest)]
    assert sorted(bytes(r.digest) for r in got if r.kept) == sorted(least)


def test_index_survives_and_appends(spark):
    path = queries.new_index(spark)
    a = spark.createDataFrame([(5, "x"), (6, "y")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "x"), (7, "z z")], "doc_id long, text string")
    exact_dedup.dedup(a, path, buckets=4).collect()
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.dedup(b, path, buckets=4).collect()}
    assert got == {1: (5, False), 7: (7, True)}  # what is stored already stays
    assert {r.keep_id for r in exact_dedup.DigestIndex(spark, path, 4).rows().collect()} == {5, 6, 7}
    index = exact_dedup.DigestIndex(spark, path, 4)
    fresh = spark.createDataFrame([(bytes(32), 1)], "digest binary, keep_id long").groupBy("digest").agg(F.min("keep_id"))
    plan = fresh.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_deduplicated_keeps_columns(spark, odd, empty):
    got = exact_dedup.deduplicated(odd, queries.new_index(spark))
    assert got.columns == odd.columns
    assert got.count() == len(brute_groups([(r.doc_id, r.text) for r in odd.collect()]))
    assert exact_dedup.dedup(empty, queries.new_index(spark)).count() == 0


# -- sentencepiece -----------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=queries.SENTENCEPIECE_MODEL)


def test_sentencepiece_equals_library(spark, library, odd, empty):
    voc = sentencepiece_codec.Vocabulary.read(queries.SENTENCEPIECE_MODEL)
    for df in (odd, docs_of(spark, SF001)):
        texts = [r.text for r in df.collect()]
        got = sentencepiece_codec.encode_checked(df, voc)
        rows = got.collect()
        want = sorted(tuple(library.encode(t)) if t else () for t in texts)
        assert sorted(tuple(r.ids) for r in rows) == want and all(r.round_trip for r in rows)
        assert all(r.n_ids == len(r.ids) for r in rows)
        back = [r.text for r in sentencepiece_codec.decode(got.select("doc_id", "ids"), voc).collect()]
        assert sorted(back) == sorted(t or "" for t in texts)
    assert sentencepiece_codec.encode(empty, voc).count() == 0


def test_codec_keeps_a_bounded_number_of_characters(monkeypatch, library):
    from epilake.llm.sentencepiece_codec import Codec
    monkeypatch.setattr(sentencepiece_codec, "CHARS_KEPT", 2_000)
    rng = random.Random(2)
    codec = Codec(sentencepiece_codec.Vocabulary.read(queries.SENTENCEPIECE_MODEL, sentencepiece_codec.BPE))
    for _ in range(40):
        unspaced = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(rng.randrange(1, 3_000)))
        spaced = " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 70))) for _ in range(90))
        for text in (unspaced, spaced):
            got = np.frombuffer(codec.encode(text), np.int32).tolist()
            assert got == library.encode(text)
            assert codec.kept_chars == sum(map(len, codec.kept)) <= 2_000
            assert all(len(w) <= sentencepiece_codec.LONG_WORD for w in codec.kept)


def test_new_words_are_searched_together(monkeypatch, library):
    from epilake.llm.sentencepiece_codec import Codec
    rng = random.Random(6)
    alphabet = "aeinrst  EU.,;\n\t09'-éßñ²▁日\U0001F600\ud7ff"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 60))) for _ in range(3_000)] + [None, "", " ", LONG]
    texts += ["s" * 64 + " " + "s" * 65, "².² ².a", "\n\n", "▁▁ a▁b"]
    codec, alone = [Codec(sentencepiece_codec.Vocabulary.read(queries.SENTENCEPIECE_MODEL)) for _ in range(2)]
    got = codec.encode_all(texts)
    assert [np.frombuffer(g, np.int32).tolist() for g in got] == [library.encode(t) if t else [] for t in texts]
    words = sorted({w for w in codec.kept if codec.alphabet.issuperset(w)})
    assert len(words) > 3_000
    monkeypatch.setattr(sentencepiece_codec, "SLOT_BITS", 4)  # so that pairs push each other out
    small = Codec(codec.voc)
    assert small.together(words) == codec.together(words) == [alone.word(w) for w in words]
    assert codec.together([]) == []
    # one by one only what has characters without a piece
    fresh, single, word = Codec(codec.voc), [], Codec.word
    monkeypatch.setattr(Codec, "word", lambda self, w: single.append(w) or word(self, w))
    assert fresh.encode_all(texts) == got
    assert all(len(w) > sentencepiece_codec.LONG_WORD or not fresh.alphabet.issuperset(w) for w in single)


@pytest.mark.parametrize("more, part", [((), 0), (("a.",), 1), (("▁a▁",), 2)])
def test_texts_are_cut_where_no_piece_runs(more, part):
    from epilake.llm.sentencepiece_codec import PARTS, Codec, Vocabulary
    pieces = ("<unk>", "▁", "a", "b", ".", "ab", "▁a", "▁ab", "..", *more)
    voc = Vocabulary(pieces, tuple(-float(i) for i in range(len(pieces))), "x" + "n" * (len(pieces) - 1), 0)
    codec = Codec(voc)
    assert codec.words.pattern == PARTS[part].replace("{letters}", "ab")
    for text in ("ab. a.b..a", ".a.", "  ab ▁ a.", "a a a", "é.a b"):
        marked = "▁" + text.replace(" ", "▁")
        whole = np.frombuffer(Codec(voc).word(marked), np.int32).tolist()
        assert np.frombuffer(codec.encode(text), np.int32).tolist() == whole
        assert [i for i in whole if i] == [voc.pieces.index(p) for p in codec.merge(marked) if p in voc.pieces]
    ids = [np.frombuffer(Codec(Vocabulary(pieces, voc.scores, voc.kinds, 0, prefix=False)).encode(t), np.int32).tolist()
           for t in ("ab.", "b a")]
    assert ids == [[i for p in codec.merge(t) for i in [voc.pieces.index(p)]] for t in ("ab.", "b▁a")]


def test_unigram_viterbi_is_best():
    pieces = ("<unk>", "▁", "a", "b", "ab", "ba", "▁a", "bab")
    scores = (0.0, -3.0, -2.0, -2.5, -2.2, -1.9, -2.1, -4.0)
    voc = sentencepiece_codec.Vocabulary(pieces, scores, "xnnnnnnn", 0, sentencepiece_codec.UNIGRAM)
    codec = sentencepiece_codec.Codec(voc)

    def best(s):
        top = [0.0] + [-1e9] * len(s)
        for e in range(1, len(s) + 1):
            for b in range(e):
                if s[b:e] in pieces:
                    top[e] = max(top[e], top[b] + scores[pieces.index(s[b:e])])
        return top[-1]

    for text in ("a", "abab", "babab", "ab ba", "bbaab"):
        ids = np.frombuffer(codec.encode(text), np.int32).tolist()
        assert math.isclose(sum(scores[i] for i in ids), sum(best(w) for w in codec.words.findall("▁" + text.replace(" ", "▁"))))
        assert codec.decode(ids) == text


# -- licences ----------------------------------------------------------------

def test_license_rules(spark, empty):
    mit = [license_scan.SENTENCES[k].capitalize() + "." for k in ("mit-grant", "mit-notice", "mit-as-is")]
    wrapped = "\n".join(re.sub("(.{40,60}) ", "\\1\n", s) for s in mit)
    texts = ["Foo. Licensed under the Apache License, Version 2.0.\nBar", " ".join(mit), wrapped, None, "",
             "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "no licence here", mit[1]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: list(r.licenses) for r in license_scan.scan(df).collect()}
    assert got == {0: ["Apache-2.0"], 1: ["MIT"], 2: ["MIT"], 3: [], 4: [], 5: ["CC-BY-NC-4.0", "MIT"], 6: [], 7: []}
    assert license_scan.scan(empty).count() == 0


@pytest.mark.parametrize("mark, top, bottom", [(" *", "/*\n", "\n */\nint x;"), ("#", "", "\n\nimport x"), ("//", "", "\nint x;")])
def test_licenses_in_comment_blocks(spark, mark, top, bottom):
    s = license_scan.SENTENCES

    def block(*paragraphs):
        lines = f"\n{mark}\n".join(re.sub("(?m)^", f"{mark} ", re.sub("(.{40,60}) ", "\\1\n", p)) for p in paragraphs)
        return f"{top}{lines}{bottom}"

    mit = block("Copyright (c) 2020 Foo", s["mit-grant"].capitalize() + ":", s["mit-notice"].capitalize() + ".", s["mit-as-is"].upper() + ".")
    gpl = block("Copyright (C) 2020 Foo", s["gpl3-free"].capitalize() + ".", "This program comes with no warranty.")
    boxed = f"{mark} {s['mit-released']} {'=' * 3 * max(map(len, s.values()))}"
    df = spark.createDataFrame([(0, mit), (1, gpl), (2, gpl.replace("\n", "\r\n")), (3, boxed)], "doc_id int, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in license_scan.scan(df).collect()}
    assert got[0] == (["mit-grant", "mit-notice", "mit-as-is"], ["MIT"])
    assert got[1] == got[2] == (["gpl3-free"], ["GPL-3.0-or-later"])
    assert got[3] == (["mit-released"], ["MIT"])


HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software is distributed as is.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.""",
}
HEADERS["BSD-3-Clause"] = HEADERS["BSD-2-Clause"] + """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""


def wrappings(text):
    """As it is, on one line a paragraph, one word a line, wrapped in comments at 33."""
    paragraphs = [re.sub(r"\s*\n\s*(?!\d\.)", " ", p) for p in text.split("\n\n")]
    flat = "\n\n".join(paragraphs)
    return [text, flat, flat.replace(" ", "\n"),
            "\n *\n".join(re.sub("(?m)^", " * ", re.sub("(.{20,33}) ", "\\1\n", p)) for p in paragraphs)]


def test_common_headers_in_any_wrapping(spark):
    rows = [(f"{name}/{i}/{end!r}", "int a;\n\n" + t.replace("\n", end) + end) for name, text in HEADERS.items()
            for i, t in enumerate(wrappings(text)) for end in ("\n", "\r\n")]
    rows += [(f"{t}/{i}", f"{m} SPDX-License-Identifier: {t}{e}\nimport x")
             for t in license_scan.TAGS for i, (m, e) in enumerate([("//", ""), ("/*", " */"), ("#", "")])]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    for r in license_scan.scan(df).collect():
        assert r.licenses == [r.doc_id.split("/")[0]], (r.doc_id, r.sentence_ids)
    # the SQL reads them alike
    con = duck(SF001)
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows + [("none", None), ("one", "a\nb\nc")])
    got = dict(con.execute(f"SELECT doc_id, licenses FROM ({license_scan.oracle_sql()})").fetchall())
    assert got == {**{k: k.split("/")[0] for k, _ in rows}, "none": "", "one": ""}


def test_license_sentences_of_any_length(spark):
    own, rules = {"x": "mit", "y": "see x"}, [("X", ("x", "y"))]
    df = spark.createDataFrame([(1, "MIT. See X!"), (2, "MIT"), (3, "word " * 300_000 + "\nMIT.\nSee X")], "doc_id int, text string")
    got = {r.doc_id: r.licenses for r in license_scan.scan(df, sentences=own, rules=rules).collect()}
    assert got == {1: ["X"], 2: [], 3: ["X"]}


# -- mixing ------------------------------------------------------------------

@pytest.mark.parametrize("block", [7, 512])
def test_mixing_meets_targets(spark, odd, block):
    for df in (odd, docs_of(spark, SF001)):
        rows = df.select("doc_id", "source", "text").collect()
        sizes = Counter()
        for r in rows:
            sizes[r.source] += len(WORD.findall(r.text or ""))
        want = brute_targets(sizes)
        got = mixing.words_taken(df, block=block).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
            (r.doc_id is None, r.doc_id or 0, len(WORD.findall(r.text or ""))) for r in rows)
        taken = Counter()
        for r in got:
            assert 0 <= r.taken <= 3 * r.size
            taken[r.source_size] += r.taken
        totals = defaultdict(float)
        for s, n in sizes.items():
            totals[n] += round(want[s])
        assert all(abs(taken[n] - t) <= 1 for n, t in totals.items())


def test_mixed_documents_hold_the_words(spark, odd, empty):
    sizes = Counter()
    for r in odd.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    out = mixing.mixed_documents(odd, block=64)
    assert out.columns == odd.columns
    got = Counter()
    for r in out.collect():
        got[r.source] += len(WORD.findall(r.text))
    assert all(abs(got[s] - t) <= 1 for s, t in brute_targets(sizes).items())
    assert mixing.words_taken(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("block, per_shard, only", [(7, 10, "true"), (512, 1024, "source = 's1'"), (512, 2, "text is null")])
def test_blocks_hold_the_sources_streams(spark, odd, block, per_shard, only):
    df = odd.filter(only)
    placed = mixing.starts(mixing.sized(df.select(
        F.struct("doc_id", F.xxhash64("text").alias("_th")).alias("doc_id"), "source", "text")),
        F.expr("coalesce(string(doc_id.doc_id), '~' || doc_id._th)"))
    texts = {(r.doc_id, r.h): WORD.findall(r.text or "")
             for r in df.select("doc_id", F.xxhash64("text").alias("h"), "text").collect()}
    streams = defaultdict(list)
    for r in sorted(placed.filter("size > 0").collect(), key=lambda r: r.start):
        assert len(streams[r.source]) == r.start
        streams[r.source] += texts[r.doc_id.doc_id, r.doc_id._th]
    got = mixing.blocks(df, block, per_shard).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    for r in got:
        assert r.shard == r.slot // per_shard and r.n <= block
        assert r.text.split(" ") == streams[r.source][r.block * block:r.block * block + r.n]
    want = brute_targets(Counter({s: len(w) for s, w in streams.items()}))
    for s, t in want.items():
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.n for r in mine) - t) <= 1
        # a short block is the source's last or finishes the target
        assert sum(r.n < block and r.block != len(streams[s]) // block for r in mine) <= 1
        # no block twice in a pass, every block before any is taken again
        assert len({(r["pass"], r.block) for r in mine}) == len(mine)


def test_no_documents_make_no_blocks(spark, empty):
    assert mixing.blocks(empty).count() == 0


def test_slots_of_a_document_are_those_of_its_blocks(spark):
    docs = docs_of(spark, SF001)
    slots = defaultdict(set)
    for r in mixing.blocks(docs, 64).collect():
        for d in r.doc_ids:
            slots[d].add(r.slot)
    for r in mixing.words_taken(docs, block=64).collect():
        assert r.n_slots == len(slots[r.doc_id]) and r.first_slot == min(slots[r.doc_id], default=None)


def test_shards_are_written_whole_in_slot_order(spark, odd):
    path = scratch_path(spark, "shards")
    mixing.write_shards(odd, path, block=64, per_shard=50)
    rows = spark.read.parquet(path).select(F.input_file_name().alias("f"), "shard", "slot",
                                           F.monotonically_increasing_id().alias("i")).collect()
    assert len({r.shard for r in rows}) > 5 and len({(r.f, r.shard) for r in rows}) == len({r.shard for r in rows})
    last = {}
    for r in sorted(rows, key=lambda r: r.i):
        assert last.get(r.f, (-1, -1)) < (r.shard, r.slot)
        last[r.f] = (r.shard, r.slot)


def test_a_long_cut_document_is_cut_into_words_once(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    docs = spark.createDataFrame([(1, "a", long), (2, "b", "only a few words"), (3, "c", "x " * 150_000)],
                                 "doc_id long, source string, text string")
    start = time.time()
    rows = mixing.mixed_documents(docs, block=16).collect()
    took = time.time() - start
    assert any(len(r.text.split()) not in (4, 150_000, 200_000) for r in rows)
    assert took < 30, took


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 3, 17, 64, 1000, 4097):
        df = mixing.permuted(spark.range(n), "y", F.col("id"), F.lit(n).cast("long"), F.lit("k"))
        got = [r.y for r in df.orderBy("id").collect()]
        assert sorted(got) == list(range(n)) and (n < 64 or got != list(range(n)))


def test_shard_counts_sum_to_draws(spark):
    placed = mixing.starts(mixing.sized(docs_of(spark, SF01))).cache()
    slots = mixing.slots(mixing.source_targets(placed), block=16, per_shard=100).cache()
    n = slots.count()
    assert slots.agg(F.countDistinct("slot"), F.max("slot")).first() == (n, n - 1)
    counts = mixing.shard_counts(slots).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    assert sorted(r.n for r in counts)[-1] == 100 and sum(r.n for r in counts) == n


# -- simhash -----------------------------------------------------------------

def test_simhash_query_equals_brute_force(spark, odd):
    for df in (odd, docs_of(spark, SF01)):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        fps = [brute_fingerprint(t) for _, t in rows]
        comp = brute_components(fps)
        least = {}
        for (i, _), f in zip(rows, fps):
            if i is not None:
                least[comp[f]] = min(i, least.get(comp[f], i))
        got = simhash.near_duplicates(df).select("doc_id", simhash.hex16(F.col("fp")).alias("h"), "component_id").collect()
        key = lambda x: (x[0] is None, x[0] or 0, x[1])
        assert sorted([(r.doc_id, r.h, r.component_id) for r in got], key=key) == sorted(
            [(i, f"{f:016x}", least.get(comp[f])) for (i, _), f in zip(rows, fps)], key=key)


@pytest.mark.parametrize("pairs_max", [0, 2, 32])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_lose_none(spark, pairs_max, bits):
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 2**63, 12).tolist() + [0, 2**64 - 1]:
        for _ in range(60):
            f = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                f ^= 1 << int(b)
            fps.add(f)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    nodes = {r.node: r.root for r in simhash.components(simhash.links(df, bits, pairs_max)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for f, root in brute_components(fps, bits).items():
        s = int(np.uint64(f).view(np.int64))
        want[root].add(s)
        got[nodes.get(s, s)].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path(spark):
    n = 200
    df = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = simhash.components(df).collect()
    assert len(got) == n + 1 and {r.root for r in got} == {0}


def test_one_of_each(spark, odd, empty):
    got = simhash.one_of_each(odd)
    assert got.columns == odd.columns
    rows = simhash.near_duplicates(odd).collect()
    assert got.count() == len({r.component_id for r in rows})
    assert simhash.near_duplicates(empty).count() == 0


# -- quality rules -----------------------------------------------------------

def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, odd):
    for df in (odd, docs_of(spark, SF001)):
        rows = df.select("doc_id", "text").collect()
        got = quality_rules.judge(df).collect()
        key = lambda x: (x[0] is None, *[v or 0 for v in x])
        assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=key) \
            == sorted([(r.doc_id, *brute_counts(r.text)) for r in rows], key=key)
        for r in got:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_quality_rejects_outliers_only(spark):
    got = {r.doc_id: r for r in quality_rules.judge(docs_of(spark, SF01)).collect()}
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert all(r.kept for r in good) and sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_mcd_ignores_far_rows(spark):
    """The estimate of clean rows is hardly moved by a fifth of far rows, as numpy's plain one is."""
    rng = np.random.default_rng(3)
    clean = rng.multivariate_normal([1, 2, 3, 4], np.diag([1.0, 4.0, 9.0, 1.0]) + 0.5, 4000)
    far = rng.normal(60, 1, (1000, 4))
    rows = [("g", *map(float, r)) for r in np.vstack([clean, far])]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{a} double" for a in quality_rules.AXES))
    r = quality_rules.estimate(df).first()
    low = np.array([[r[f"l{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
    assert np.allclose([r[f"m{i}"] for i in range(4)], [1, 2, 3, 4], atol=0.35)
    assert np.allclose(low @ low.T, np.cov(clean.T), rtol=0.45, atol=0.8)


def brute_mcd(x):
    """(centre, scatter, log determinant by start) by plain numpy, from the same starts."""
    q = quality_rules
    floor, n = np.diag(np.square(q.FLOOR)), len(x)

    def at(values, share):  # the smallest value that a share of all is at or below
        return np.sort(values, axis=0)[max(0, math.ceil(share * n) - 1)]

    mid = at(x, 0.5)
    mad = at(np.abs(x - mid), 0.5) * 1.4826 + q.FLOOR
    worst = (np.abs(x - mid) / mad).max(axis=1)
    near = x[worst <= at(worst, 0.5)]
    found = []
    for m, s in ((mid, np.diag(mad ** 2)), (x.mean(0), np.cov(x.T, bias=True)), (near.mean(0), np.cov(near.T, bias=True))):
        s, was = s + floor, None
        for _ in range(q.STEPS):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
            kept = x[d <= at(d, q.KEEP)]
            m, s = kept.mean(0), np.cov(kept.T, bias=True) * q.consistency(q.KEEP, 4) + floor
        found.append((np.linalg.slogdet(s)[1], m, s))
    return min(found, key=lambda f: f[0])[1:] + ([f[0] for f in found],)


def test_cutoff_is_the_chi_square_quantile():
    x = quality_rules.cutoff()
    assert abs(math.exp(-x / 2) * (1 + x / 2) / quality_rules.TAIL - 1) < 1e-6 and 47 < x < 48


def test_estimate_equals_plain_concentration_from_the_same_starts(spark):
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(0, 1, (400, 4)), "b": np.vstack([rng.normal(0, 1, (200, 4)), rng.normal(7, 0.1, (80, 4))]),
              "c": np.tile([1.0, 2.0, 3.0, 4.0], (50, 1))}
    rows = [(g, *map(float, r)) for g, x in groups.items() for r in x]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{a} double" for a in quality_rules.AXES)).repartition(3)
    for r in quality_rules.estimate(df).collect():
        m, s, dets = brute_mcd(groups[r.g])
        low = np.array([[r[f"l{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
        assert np.allclose([r[f"m{i}"] for i in range(4)], m, atol=0.02) and np.allclose(low @ low.T, s, atol=0.05)
        assert abs(r.det - min(dets)) < 0.02


def test_kept_equals_brute_force(spark):
    docs = docs_of(spark, SF01)
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    rows = (quality_rules.vectors(docs.select("doc_id", "lang", "source")
            .join(spark.createDataFrame(list(got.values())).drop("distance"), "doc_id"))
            .filter("NOT base_failed").collect())
    pairs, langs = defaultdict(list), defaultdict(list)
    for r in rows:
        pairs[r.lang, r.source].append(r)
        langs[r.lang].append(r)

    def matrix(part):
        return np.array([[r[a] for a in quality_rules.AXES] for r in part])

    far = 0
    for (lang, source), part in pairs.items():
        of = part if len(part) >= quality_rules.MIN_ROWS else langs[lang] if len(langs[lang]) >= quality_rules.MIN_ROWS else rows
        m, s, _ = brute_mcd(matrix(of))
        x = matrix(part) - m
        d = np.einsum("ij,jk,ik->i", x, np.linalg.inv(s), x)
        for r, v in zip(part, d):
            mine = got[r.doc_id].distance
            assert abs(mine - v) <= 0.05 * v + 0.05
            if abs(v - quality_rules.cutoff()) > 0.1 * v:
                assert r.kept == (v <= quality_rules.cutoff())
                far += not r.kept
    assert far > 20


def test_quality_rules_empty(spark, empty):
    assert quality_rules.judge(empty).count() == 0


# -- classifier --------------------------------------------------------------

def test_classifier_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op8_quality(spark, SF01).collect()}
    assert len(got) == 1000
    held = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()
            if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(g.held_out and g.predicted == int(g.score >= 0.3) for g, _ in held)
    assert sum(g.predicted == y for g, y in held) >= 0.95 * len(held)


def test_classifier_features_by_hand():
    cfg = quality_classifier.Config(ngrams=(3,))
    kinds = list(quality_classifier.features(["ab  CD ab", None, "x x"], cfg))
    assert [(len(b), d.tolist()) for b, d in kinds] == [
        (5, [0, 0, 0, 2, 2]), (3, [0, 0, 2]), (8, [0, 0, 0, 0, 0, 0, 2, 2])]
    words = kinds[0][0].tolist()
    assert words[0] == words[2] and words[3] == words[4] and words[0] != words[1]


def test_classifier_chunks_do_not_matter(monkeypatch):
    texts = ["good words here", "bad bad bad bad", "", None, "good and fine words", "bad " * 50] * 5
    model = quality_classifier.fit(texts, [1, 0, 1, 1, 1, 0] * 5)
    a = model.scores(texts)
    monkeypatch.setattr("epilake.llm.common.CHUNK_CHARS", 10)
    assert np.allclose(a, model.scores(texts)) and a[1] < a[0] and 0 <= a.min() and a.max() <= 1
    assert quality_classifier.fit(["a"], [1]).scores(["b", None])[0] > 0.5
    assert len(quality_classifier.fit([], []).scores(["b"])) == 1


def test_classifier_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(7, 1), (7, 0), (16, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality_classifier.train(odd, labels)
    got = odd.select(quality_classifier.score(odd, model).alias("s")).collect()
    assert len(got) == odd.count() and all(0 <= r.s <= 1 for r in got)
    model = quality_classifier.train(empty, labels.limit(0))
    assert empty.select(quality_classifier.score(empty, model)).count() == 0


# -- urls --------------------------------------------------------------------

def test_url_rules(spark):
    urls = ["http://a.com/x", "https://EXAMPLE.com/en/1?q", "https://www.example.com/en/2#f", "http://b.net/es/1",
            "http://netto/es/", "http://x.net/fr/", "http://a.com", None, "no scheme", "", "x://Y.Com?://z/", "http://a.COM/\nb"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(df).collect()}
    assert got == {0: ("a.com", "/x", "com/"), 1: ("example.com", "/en/1", "example.com/en/"),
                   2: ("www.example.com", "/en/2", "www.example.com/en/"), 3: ("b.net", "/es/1", "net/es/"),
                   4: ("netto", "/es/", None), 5: ("x.net", "/fr/", "net/fr/"), 6: ("a.com", "", None),
                   7: ("", "", None), 8: ("", "", None), 9: ("", "", None), 10: ("y.com", "", None),
                   11: ("a.com", "/\nb", "com/")}


def test_url_scores_equal_brute_force(spark):
    rows = [(f"h{i % 7}.com/{'ab' * (i % 3)}{i}", "allow" if i % 2 else "block" if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(sorted(set(rows)), "s string, label string").withColumn("example", F.lit(None).cast("string"))
    got = {r.s: r.score for r in url_filter.scores(df).collect()}
    k = url_filter.ORDER
    counts = {"allow": Counter(), "block": Counter()}
    for s, label in set(rows):
        padded = url_filter.EDGE * k + s + url_filter.EDGE
        for i in range(len(s) + 1):
            if label:
                for o in range(k + 1):
                    counts[label][padded[i + k - o:i + k + 1]] += 1

    def p(label, gram):
        if not gram:
            return url_filter.UNIFORM
        context = sum(n for g, n in counts[label].items() if len(g) == len(gram) and g[:-1] == gram[:-1])
        return (counts[label][gram] + url_filter.PRIOR * p(label, gram[1:])) / (context + url_filter.PRIOR)

    todo = [s for s, label in set(rows) if label is None]
    assert set(got) == set(todo)
    for s in todo:
        padded = url_filter.EDGE * k + s + url_filter.EDGE
        want = sum(math.log(p("allow", padded[i:i + k + 1]) / p("block", padded[i:i + k + 1])) for i in range(len(s) + 1))
        assert math.isclose(got[s], want / (len(s) + 1), abs_tol=1e-9)


def test_very_long_and_odd_addresses(spark):
    # windows of whole characters, beyond the basic plane too
    df = spark.createDataFrame([("ab\U0001F600c",), ("",)], "s string")
    pad = url_filter.EDGE * url_filter.ORDER
    got = {g for r in url_filter._grams(df).collect() for g in [r.gram]}
    assert got == {(pad + s + url_filter.EDGE)[i:i + url_filter.ORDER + 1] for s in ("ab\U0001F600c", "") for i in range(len(s) + 1)}
    urls = [f"http://a{i}.{['com', 'net'][i % 2]}/{['en', 'fr', 'es'][i % 3]}/{i}" for i in range(60)]
    urls += ["http://x.org/" + "a/b" * 350_000, None, "", "no scheme", "http://x.org/p", "http://x.org/p"]
    began = time.time()
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")).collect()
    assert len(rows) == len(urls) and time.time() - began < 120
    assert {r.verdict for r in rows} <= {"allow", "block"} and len({r.verdict for r in rows if r.page_id >= 64}) == 1


def test_url_query(spark):
    rows = queries.op9_url_filter(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/pages.parquet").count()
    assert {r.verdict for r in rows} <= {"allow", "block"}
    empty = spark.createDataFrame([], "page_id long, url string, host string")
    assert url_filter.judge(empty).count() == 0


# -- personal data -----------------------------------------------------------

def brute_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(int(c) for c in reversed(d)))
        if 16 <= len(d) <= 19 and s % 10 == 0:
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def test_base_spans_of_long_octets_and_many_ats():
    zeros = "0" * 5000
    text = f"1.2.3.{zeros}1 and 1.2.3.{zeros}256"
    assert pii.base_spans(text) == [(1, 0, 5007)]
    began = time.process_time()
    assert pii.base_spans("a@" * 200_000) == []
    assert time.process_time() - began < 1


def test_base_spans_equal_patterns():
    import random
    rng = random.Random(4)
    alphabet = "0123456789 .-+()@ab%é1.2@"
    for _ in range(20_000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("4" + "0" * 5000 + "@" + "a" * 5000) == []


def test_pii_query(spark, odd, empty):
    for df in (docs_of(spark, SF001), odd):
        model = pii.train(df, pii.Config(sample=200))
        got = df.select("doc_id", "text", pii.find(df, model).alias("p")).select("doc_id", "text", "p.*").collect()
        for r in got:
            base = brute_spans(r.text or "")
            text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
            assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == c for k, _, _ in base) for c in range(4)]
            assert set(text.split(",")) <= set(r.spans.split(",")) | {""}
            assert r.n_added == len([x for x in r.spans.split(",") if x]) - len(base)
    model = pii.fit([])
    assert empty.select(pii.find(empty, model)).count() == 0


def test_field_learns_forms_beyond_the_patterns(spark):
    texts = [r.text for r in docs_of(spark, SF01).filter(F.col("text").rlike("[0-9@]")).collect()]
    model = pii.fit(texts)
    _, every = model.spans("call me at 1-563-555-5874 today")
    assert [k for k, _, _ in every] == [3]
    assert model.spans("Version 2.0 of 4.0 in 1999, page 37")[1] == []


@pytest.fixture(scope="module")
def telling(spark):
    """Texts with a digit or @: two thirds to train on, one to find spans in."""
    texts = [r.text for r in docs_of(spark, SF01.replace("sf0.01", "sf0.1")).filter(F.col("text").rlike("[0-9@]"))
             .orderBy("doc_id").collect()]
    return [t for i, t in enumerate(texts) if i % 3], texts[::3]


def recall(model, texts, form):
    """Share of the spans written in a form that the patterns miss and the model finds."""
    rng, found, total = random.Random(5), 0, 0
    for t in texts:
        base = pii.base_spans(t)
        if all(k != pii.FORMS[form][0] for k, _, _ in base):
            continue
        text, spans, _ = pii._varied(t, base, rng, (form,), 1.0, 0.0)
        seen = {(run[b][0], run[e][1]) for run in pii.stretches(text)
                for e, ends in enumerate(pii.candidates(text, run)) for b, _ in ends}
        assert {(s, e) for _, s, e in spans} <= seen
        off = {x for x in spans if x[0] == pii.FORMS[form][0]} - set(pii.base_spans(text))
        total += len(off)
        found += len(off & set(model.spans(text)[1]))
    assert total > 20, form
    return found / total


@pytest.fixture(scope="module")
def trained(telling):
    return pii.fit(telling[0], pii.Config(copies=10))


def test_each_rewritten_form_is_decoded(telling, trained):
    """Every span of the varied texts is a candidate, and decoded after training."""
    found = {form: recall(trained, telling[1], form) for form in pii.FORMS}
    assert min(found.values()) >= 0.9, found


def test_forms_not_trained_on_are_decoded(telling):
    held = ("email doubled", "ip brackets", "card dots", "phone area spaces")
    model = pii.fit(telling[0], pii.Config(copies=10, forms=tuple(f for f in pii.FORMS if f not in held)))
    found = {form: recall(model, telling[1], form) for form in held}
    assert min(found.values()) >= 0.9, found


def test_decoys_are_left_alone(trained):
    for text in ("order 4366826422043231 shipped", "host 10.0.300.1 is down", "on 2020-01-02 at 12:30", "3 @ 4.50 each",
                 "from 12/05/2021 to 1999-2000", "total 1,234,567.89 USD", "ISBN 978-3-16-148410-0", "release 3.5.1 of 2010"):
        assert trained.spans(text)[1] == [], text
    for text, kind in (("call 555-123-4567 now", 3), ("tel 0151 2345678", 3), ("10 . 0 . 0 . 1", 1), ('{"tel":"0151/2345678"}', 3),
                       ("jane7 @ example3.com", 0), ("write jane @ example.com now", 0), ("4111.1111.1111.1111", 2)):
        assert [k for k, _, _ in trained.spans(text)[1]] == [kind], text


def test_varied_texts_say_where_spans_are():
    rng = random.Random(3)
    text = "a +1 (555) 010-2000 b x.7@y.example.com, c 4111111111111111 d 1.2.3.4"
    base = pii.base_spans(text)
    assert pii._varied(text, base, rng, (), 1.0, 0.0) == (text, sorted(base, key=lambda x: x[1]), [])
    for form, (kind, write) in pii.FORMS.items():
        new, spans, news = pii._varied(text, base, rng, (form,), 1.0, 0.0)
        assert sorted(k for k, _, _ in spans) == [0, 1, 2, 3] and len(news) == 1
        assert [s for k, s, _ in spans if k == kind] == news
        assert all(new[s:e].strip() == new[s:e] for _, s, e in spans)
    new, spans, news = pii._varied(text, base, rng, tuple(pii.FORMS), 0.0, 1.0)
    assert spans == [] and len(news) == 4


@pytest.mark.parametrize("text, span", [
    ("write to jane @ example.com now", "jane @ example.com"), ("write to jane7 @ example3.com now", "jane7 @ example3.com"),
    ("phone:555-123-4567", "555-123-4567"), ('{"tel":"0151/2345678"}', "0151/2345678"),
    (" @ ".join([".".join("abcdefghijklmnopqrstuvwxyz"), "x.com"]), ".".join("abcdefghijklmnopqrstuvwxyz") + " @ x.com"),
    ("4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1")])
def test_boundaries_around_and_inside_words(text, span):
    start = text.index(span)
    crf = pii.SemiCrf()
    for run in pii.stretches(text):
        first, last = {a: i for i, (a, _) in enumerate(run)}, {b: i for i, (_, b) in enumerate(run)}
        b, e = first[start], last[start + len(span)]
        for _ in range(60):
            crf.learn(text, run, {(b, e + 1 - b): 3}, 0.2, 0.0)
    assert (3, start, start + len(span)) in [x for run in pii.stretches(text) for x in crf.best(text, run)]


def test_best_path_is_exact():
    """Decoding equals the best of all segmentations of the candidates."""
    rng = random.Random(2)
    for _ in range(40):
        text = "".join(rng.choice("a1@. -+") for _ in range(rng.randint(1, 9))) + "7"
        for run in pii.stretches(text):
            crf = pii.SemiCrf(margin=0.5)
            seg = crf.segments(text, run)
            crf.weights = {(f, c): rng.gauss(0, 1) for fs in seg.values() for f in fs for c in range(4)}

            def paths(i):
                if i == len(run):
                    yield 0.0, []
                    return
                yield from paths(i + 1)
                for (b, m), fs in seg.items():
                    if b == i:
                        for c in range(4):
                            for v, rest in paths(i + m):
                                yield v + crf.score(fs, c) - crf.margin, [(c, run[i][0], run[i + m - 1][1]), *rest]

            assert crf.best(text, run) == max(paths(0), key=lambda x: x[0])[1]


def test_a_long_run_is_one_path():
    card = "4111  1111  1111  1111"
    text = "x1 " * 4094 + card + " x1" * 10
    crf = pii.SemiCrf({("lengths4-4-4-4", 2): 5.0, ("luhn", 2): 5.0, ("letters", 2): -20.0})
    assert crf.spans(text)[1] == [(2, 3 * 4094, 3 * 4094 + len(card))]


def test_partition_function_is_exact():
    """One training step's expectation equals enumeration of all segmentations."""
    text, run = "11 22 33", [(0, 2), (3, 5), (6, 8)]
    crf = pii.SemiCrf()
    seg = crf.segments(text, run)
    feats = {k: ["f%d-%d" % k] for k in seg}
    rng = np.random.default_rng(0)
    crf.weights = {(f, c): float(rng.normal()) for fs in feats.values() for f in fs for c in range(4)}
    crf.segments = lambda *_: feats
    before = dict(crf.weights)

    def paths(i):
        if i == 3:
            yield [], 0.0
            return
        for rest, s in paths(i + 1):
            yield rest, s
        for m in range(1, 4 - i):
            for c in range(4):
                for rest, s in paths(i + m):
                    yield [((i, m), c), *rest], s + crf.score(feats[i, m], c)

    every = list(paths(0))
    z = sum(math.exp(s) for _, s in every)
    crf.learn(text, run, {}, 1.0, 0.0)
    for k, fs in feats.items():
        for c in range(4):
            p = sum(math.exp(s) for path, s in every if (k, c) in path) / z
            assert math.isclose(before[fs[0], c] - crf.weights[fs[0], c], p, abs_tol=1e-6)
