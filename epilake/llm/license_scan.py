"""Licence scan by sentence rules.

A text is cut into sentences and each is normalised (lower case, letters and
digits only, single spaces). A table of known licence sentences maps it to
an identifier. The identifiers of a text, in order, are then held against
licence rules: a rule is a sequence of identifiers and fits where the text's
known sentences have it in direct succession (other sentences may stand
between). Rules are ordered; of two that start at the same sentence the
earlier in the table wins, and a sentence belongs to one match.

DataFrame operations only, within each row: no shuffle, and the tables are
literals of fixed size. Sentences end at a line's end or at .!? before white
space; for texts with wrapped lines a second reading joins the lines of a
paragraph, so that wrapping doesn't matter, and matches of either reading
count. A line without letters or digits (a comment block's ``*``, ``#`` or
``//``) ends a paragraph. Sentences of any length are looked up. Null and
empty texts have no sentences and no licence; repeated rows are read on their
own; an empty table gives no rows; other columns aren't read. A text of any
length is cut in one pass.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised, by identifier (fixed values: licence texts).
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not "
                 "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                 "is hereby granted provided that the above copyright notice and this permission notice appear in all "
                 "copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software "
                 "including all implied warranties of merchantability and fitness",
    "apache-licensed": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this file except in "
                     "compliance with the license",
    "apache-notice": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl3-licensed": "this work is licensed under the gnu general public license version 3",
    "gpl2-licensed": "this work is licensed under the gnu general public license version 2",
    "gpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 3 of the license "
                 "or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 2 of the license "
                 "or at your option any later version",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "affero general public license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
    "lgpl3-licensed": "this work is licensed under the gnu lesser general public license version 3",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                  "lesser general public license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 2 1 of "
                   "the license or at your option any later version",
    "bsd3-licensed": "licensed under the bsd 3 clause license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are "
                          "permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and "
                  "the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
                  "and the following disclaimer in the documentation and or other materials provided with the "
                  "distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                 "or promote products derived from this software without specific prior written permission",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0-work": "this work is dedicated to the public domain under cc0 1 0",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl "
                  "2 0",
}

#: Ordered rules: licence and its sequence of sentences (fixed values).
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-header", "apache-obtain", "apache-url")),
    ("Apache-2.0", ("apache-header", "apache-copy")),
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-notice", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-notice", "apache-comply")),
    ("Apache-2.0", ("apache-licensed",)),
    ("GPL-3.0-or-later", ("gpl3-free",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("GPL-3.0", ("gpl3-licensed",)),
    ("GPL-2.0", ("gpl2-licensed",)),
    ("LGPL-3.0", ("lgpl3-licensed",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd3-licensed",)),
    ("BSD", ("bsd-redistribution",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC0-1.0", ("cc0-work",)),
    ("MPL-2.0", ("mpl-2", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2",)),
]

#: Identifiers after a tag (fixed values): such a line is a sentence of its own.
TAGS = ("MIT", "ISC", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
        "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "CC-BY-NC-4.0", "Unlicense", "Zlib", "BSL-1.0", "EPL-2.0")
# where a line ends with the colon after "free software" the sentence is two
SENTENCES |= {"free-program": "this program is free software", "free-library": "this library is free software"}
for _name in ("gpl3", "gpl2", "agpl3", "lgpl3", "lgpl21"):
    _whole = SENTENCES[f"{_name}-free"]
    _kind = "free-library" if _name.startswith("lgpl") else "free-program"
    SENTENCES[f"{_name}-rest"] = _whole.removeprefix(SENTENCES[_kind] + " ")
    RULES += [(x, (_kind, f"{_name}-rest")) for x, seq in RULES if seq == (f"{_name}-free",)]
SENTENCES |= {"spdx-" + t.lower(): "spdx license identifier " + re.sub("[^a-z0-9]+", " ", t.lower()) for t in TAGS}
RULES += [(t, ("spdx-" + t.lower(),)) for t in TAGS]

_ENDS = r"([.!?])[\x20\t]+"
#: Where a paragraph ends, once its lines are joined.
_BREAK = "\x01"
_WRAP = rf"([^.!?:\n{_BREAK}])\n"
_LETTER = r"[\p{L}\p{N}]"


def normalise(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def joined(text: Column) -> Column:
    """The text with the lines of each paragraph joined. A line without
    letters or digits ends a paragraph, as does one that ends in ``.!?:``."""
    lines = F.transform(F.split(text, "\n"), lambda s: F.when(s.rlike(_LETTER), s).otherwise(""))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), "\n\n+", _BREAK), _WRAP, "$1 ")


def sentence_ids(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known sentences of ``text``, in order."""
    known = F.create_map(*[F.lit(x) for name, s in sentences.items() for x in (s, name)])
    parts = F.split(F.regexp_replace(text, _ENDS, "$1\n"), f"[\n{_BREAK}]")
    return F.filter(F.transform(F.transform(parts, normalise), lambda w: F.try_element_at(known, w)),
                    lambda x: x.isNotNull())


def matches(ids: Column, rules: list[tuple[str, tuple[str, ...]]]) -> Column:
    """Licences of the rules that fit ``ids``, in order of the text."""
    state = F.struct(F.lit(0).alias("skip"), F.array().cast("array<string>").alias("out"))

    def step(acc, i):
        # the first rule whose sequence stands at i
        name = F.coalesce(*[F.when(F.slice(ids, i, len(seq)) == F.array(*map(F.lit, seq)), F.lit(k))
                            for k, (_, seq) in enumerate(rules)])
        length = F.element_at(F.array(*[F.lit(len(seq)) for _, seq in rules]), name + 1)
        label = F.element_at(F.array(*[F.lit(x) for x, _ in rules]), name + 1)
        taken = acc["skip"] > 0
        return F.struct(
            F.when(taken, acc["skip"] - 1).when(name.isNotNull(), length - 1).otherwise(0).alias("skip"),
            F.when(taken | name.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(label))).alias("out"))

    at = F.when(F.size(ids) > 0, F.sequence(F.lit(1), F.size(ids))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(at, state, step)["out"]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences: dict[str, str] | None = None, rules: list[tuple[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """A row per row: id, ``sentence_ids`` (known sentences in order, of the
    line reading and then those that only the joined reading has),
    ``licenses`` (distinct, sorted) and ``has_license``."""
    sentences = sentences or SENTENCES
    rules = rules or RULES
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("\r\n"), F.lit("\n"))
    rows = docs.select(F.col(id_col), sentence_ids(text, sentences).alias("_line"),
                       sentence_ids(joined(text), sentences).alias("_joined"))
    rows = rows.select(id_col, F.concat("_line", F.array_except("_joined", "_line")).alias("sentence_ids"),
                       matches(F.col("_line"), rules).alias("_a"), matches(F.col("_joined"), rules).alias("_b"))
    return rows.select(id_col, "sentence_ids",
                       F.array_sort(F.array_union("_a", "_b")).alias("licenses")).withColumn(
        "has_license", F.size("licenses") > 0)


def oracle_sql(sentences: dict[str, str] | None = None, rules=None) -> str:
    """The result of the query over ``documents`` in DuckDB."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    known = "MAP {" + ", ".join(f"'{s}': '{n}'" for n, s in sentences.items()) + "}"
    first = "CASE " + " ".join(
        "WHEN i + {n} <= len(ids) + 1 AND ids[i:i + {m}] = [{seq}] THEN {k}".format(
            n=len(seq), m=len(seq) - 1, seq=", ".join(f"'{x}'" for x in seq), k=k)
        for k, (_, seq) in enumerate(rules)) + " END"
    lengths = ", ".join(str(len(seq)) for _, seq in rules)
    labels = ", ".join(f"'{x}'" for x, _ in rules)

    def ids(text: str) -> str:
        return (rf"list_filter(list_transform(regexp_split_to_array(regexp_replace({text}, '([.!?])[\x20\t]+', "
                r"'\1' || chr(10), 'g'), '[\n\x01]'), "
                r"lambda s: known[trim(regexp_replace(lower(s), '[^\p{L}\p{N}]+', ' ', 'g'))]), lambda x: x IS NOT NULL)")

    lines = (r"array_to_string(list_transform(string_split(text, chr(10)), "
             r"lambda s: CASE WHEN regexp_matches(s, '[\p{L}\p{N}]') THEN s ELSE '' END), chr(10))")
    joined = rf"regexp_replace(regexp_replace({lines}, '\n\n+', chr(1), 'g'), '([^.!?:\n\x01])\n', '\1 ', 'g')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, replace(coalesce(text, ''), chr(13) || chr(10), chr(10)) AS text, {known} AS known FROM documents),
e AS (SELECT doc_id, {ids('text')} AS a, {ids(joined)} AS b FROM d),
l AS (SELECT doc_id, 0 AS reading, a AS ids FROM e UNION ALL SELECT doc_id, 1, b FROM e),
w AS (
  SELECT doc_id, reading, ids, 1::BIGINT AS i, []::VARCHAR[] AS got FROM l WHERE len(ids) > 0
  UNION ALL
  SELECT doc_id, reading, ids, i + coalesce([{lengths}][k + 1], 1),
         CASE WHEN k IS NULL THEN got ELSE list_append(got, [{labels}][k + 1]) END
  FROM (SELECT *, {first} AS k FROM w WHERE i <= len(ids))),
m AS (SELECT doc_id, list_sort(list_distinct(flatten(list(got)))) AS licenses FROM w WHERE i > len(ids) GROUP BY doc_id)
SELECT e.doc_id, array_to_string(list_concat(a, list_filter(list_distinct(b), lambda x: NOT list_contains(a, x))), ',') AS sentence_ids,
       array_to_string(coalesce(licenses, []), ',') AS licenses,
       len(coalesce(licenses, [])) > 0 AS has_license
FROM e LEFT JOIN m ON e.doc_id IS NOT DISTINCT FROM m.doc_id
"""
