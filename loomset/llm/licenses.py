"""Licence notices by a positional index of their rare words.

A template is a notice, or the body of a licence, in segments: short runs of words that
may stand apart.  The corpus tells how rare each template word is.  A file is looked up
by the rarest words of the segments, their anchors: an anchor at place p that its
segment has at offset o is a candidate, which starts at p - o.  The other postings of
the segment are intersected with the file at the same relative places.

A segment's mandatory key phrases have to stand there whole.  A template is found if all
its segments with a key phrase are; how much of it, by rarity, stands in place is the
score.  Phrases are templates of one segment, all of it mandatory.

All of it is DataFrame functions, and narrow: one pass counts words, a second looks up
and verifies within each row.  The index is of fixed size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import evaluate_once
from loomset.llm.words import row_key

#: The phrases that are always looked for, and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Further phrases: more licences, and finer labels.
MORE = {
    "mit license": "mit",
    "apache license version 2 0": "apache-2.0",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "gnu general public license": "gpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "gnu gpl": "gpl",
    "gpl v2": "gpl-2.0",
    "gpl v3": "gpl-3.0",
    "gplv2": "gpl-2.0",
    "gplv3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "spdx license identifier": "spdx",
}


def _gnu(label: str, name: str, version: str = "-") -> tuple[str, list[str]]:
    """The notice that the licences of this family ask for."""
    choice = f"either [version {version} of the license]" if version != "-" else "either version - of the license"
    return label, [
        "this program is free software you can redistribute it and or modify it",
        f"under the terms of the [{name}] as published by the free software foundation",
        f"{choice} or at your option any later version",
        "this program is distributed in the hope that it will be useful but without any warranty",
        "without even the implied warranty of merchantability or fitness for a particular purpose",
    ]


_AS_IS = "the software is provided as is without warranty of any kind express or implied"

#: Notices and licence texts, by segment.  Key phrases are in brackets,
#: and "-" stands for a word that is not looked at.
TEMPLATES: list[tuple[str, list[str]]] = [
    ("apache-2.0", ["licensed under - [apache license version 2 0]"]),
    ("mit", ["released under - [mit license]"]),
    ("gpl", ["licensed under - gnu [general public license]"]),
    ("gpl-3.0", ["licensed under - gnu [general public license version 3]"]),
    ("gpl-2.0", ["licensed under - gnu [general public license version 2]"]),
    ("lgpl", ["licensed under - gnu [lesser general public license]"]),
    ("agpl", ["licensed under - gnu [affero general public license]"]),
    ("bsd", ["licensed under - [bsd license]"]),
    ("mpl", ["licensed under - [mozilla public license] version 2 0"]),
    ("isc", ["licensed under - [isc license]"]),
    ("cc-by", ["[cc by]"]),
    ("cc-by-nc", ["licensed under [cc by nc] 4 0"]),
    ("cc-by-sa", ["licensed under [cc by sa] 4 0"]),
    ("cc-by-nd", ["licensed under [cc by nd] 4 0"]),
    ("reserved", ["[all rights reserved]"]),
    ("spdx", ["[spdx license identifier]"]),
    (
        "mit",
        [
            "[permission is hereby granted free of charge] to any person obtaining a copy",
            "of this software and associated documentation files the software",
            "to deal in the software without restriction including without limitation the rights",
            "to [use copy modify merge publish distribute sublicense] and or sell copies of the software",
            "the above copyright notice and this permission notice shall be included in all copies",
            _AS_IS,
            "including but not limited to the warranties of merchantability fitness for a particular purpose",
        ],
    ),
    (
        "bsd",
        [
            "[redistribution and use in source and binary forms] with or without modification are permitted",
            "redistributions of source code must retain the above copyright notice",
            "redistributions in binary form must reproduce the above copyright notice",
            "this list of conditions and the following disclaimer in the documentation",
            "this software is provided by the copyright holders and contributors as is",
        ],
    ),
    (
        "isc",
        [
            "[permission to use copy modify and or distribute this software] for any purpose",
            "with or without fee is hereby granted provided that the above copyright notice",
            "the software is provided as is and the author disclaims all warranties",
        ],
    ),
    (
        "apache-2.0",
        [
            "licensed under the [apache license version 2 0] the license",
            "you may not use this file except in compliance with the license",
            "unless required by applicable law or agreed to in writing software distributed under the license",
            "is distributed on an as is basis without warranties or conditions of any kind",
        ],
    ),
    _gnu("gpl", "gnu general public license"),
    _gnu("gpl-2.0", "gnu general public license", "2"),
    _gnu("gpl-3.0", "gnu general public license", "3"),
    _gnu("lgpl", "gnu lesser general public license"),
    _gnu("agpl", "gnu affero general public license"),
    (
        "mpl",
        [
            "this source code form is subject to the terms of the [mozilla public license] v 2 0",
            "if a copy of the mpl was not distributed with this file you can obtain one at",
        ],
    ),
    (
        "zlib",
        [
            "this software is provided as is without any express or implied warranty",
            "[in no event will the authors be held liable] for any damages",
            "permission is granted to anyone to use this software for any purpose",
        ],
    ),
    (
        "unlicense",
        [
            "[this is free and unencumbered software released into the public domain]",
            "anyone is free to copy modify publish use compile sell or distribute this software",
        ],
    ),
    ("cc-by", ["licensed under - [creative commons attribution] 4 0 international license"]),
    ("cc-by-sa", ["licensed under - [creative commons attribution sharealike] 4 0 international license"]),
    ("cc-by-nc", ["licensed under - [creative commons attribution noncommercial] 4 0 international license"]),
    ("boost", ["distributed under the [boost software license] version 1 0"]),
]

#: Anchors of a segment: its rarest words.  A segment without a key phrase is missed
#: if these are all other words in the file, and then adds nothing to the score.
ANCHORS = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Segment:
    template: int
    words: tuple[str, ...]
    #: Offsets of the key phrases' words.
    must: tuple[int, ...]


@dataclass(frozen=True)
class Template:
    label: str
    kind: str
    segments: tuple[int, ...]


def _templates() -> tuple[list[Template], list[Segment]]:
    """Phrases of both kinds, and the notices."""
    rows = [("base", label, [f"[{phrase}]"]) for phrase, label in BASE.items()]
    rows += [("more", label, [f"[{phrase}]"]) for phrase, label in MORE.items()]
    rows += [("notice", label, parts) for label, parts in TEMPLATES]
    templates, segments = [], []
    for kind, label, parts in rows:
        first = len(segments)
        for part in parts:
            words, must, inside = [], [], False
            for token in part.split():
                inside = inside or token.startswith("[")
                if inside:
                    must.append(len(words))
                words.append(token.strip("[]"))
                inside = inside and not token.endswith("]")
            segments.append(Segment(len(templates), tuple(words), tuple(must)))
        templates.append(Template(label, kind, tuple(range(first, len(segments)))))
    return templates, segments


def words_of(text: str | Column) -> Column:
    """Words of a text, A-Z lower-cased; no empty ones, and none for NULL."""
    column = F.col(text) if isinstance(text, str) else text
    low = F.translate(F.coalesce(column, F.lit("")), _UPPER, _UPPER.lower())
    # a text can only begin or end with a gap, which leaves an empty first or last word
    parts = F.split(F.regexp_replace(low, "^" + _GAP, ""), _GAP)
    last = F.element_at(parts, -1)
    return F.when(last == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def rarities(docs: DataFrame) -> dict[str, float]:
    """IDF of each template word over all rows of ``docs`` (text).

    A word that no file has counts as if one had it.  At most as many rows as there are
    template words reach the driver.
    """
    _, segments = _templates()
    known = sorted({w for s in segments for w in s.words} - {"-"})
    there = F.array_distinct(F.filter("words", lambda w: w.isin(*known)))
    # the empty word stands for the file itself
    word = F.explode(F.concat(F.array(F.lit("")), there)).alias("word")
    counted = docs.select(words_of("text").alias("words")).select(word).groupBy("word").count()
    files = dict(counted.collect())
    n = files.get("", 0) + 1
    return {w: math.log(n / files.get(w, 1)) if n > 1 else 1.0 for w in known}


def _anchors(segment: Segment, idf: dict[str, float]) -> list[int]:
    """Offsets of the rarest words; of mandatory ones the rarest alone will do."""
    where = segment.must or range(len(segment.words))
    where = [k for k in where if segment.words[k] != "-"]
    rarest = sorted(where, key=lambda k: (-idf[segment.words[k]], k))
    return rarest[: 1 if segment.must else ANCHORS]


def _literal(value: float | str) -> str:
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def _array(values: list, kind: str) -> str:
    """SQL of an array of whole numbers, fractions, words, or arrays of these."""
    inner = [_array(v, kind) if isinstance(v, list) else "NULL" if v is None else _literal(v) for v in values]
    depth = 1 + any(isinstance(v, list) for v in values)
    return f"CAST(array({', '.join(inner)}) AS {'array<' * depth}{kind}{'>' * depth})"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, n_base, first_word, last_word, base_labels, labels, score)
    for each row of ``docs`` (doc_id, text).

    n_base counts the places of the base phrases, first_word and last_word are the
    smallest and largest start (words from 0), NULL if there is none.  Labels are
    arrays, distinct and sorted; base_labels come from base phrases, labels from all.
    The score is the largest share, by IDF, of a notice whose key phrases all stand in
    the file, and 0 without one; of each segment the best place counts.  NULL texts are
    empty; equal rows have equal results; work and memory are linear in a text.
    """
    idf = rarities(docs)
    templates, segments = _templates()
    weights = [[idf.get(w, 0.0) for w in s.words] for s in segments]  # "-" weighs nothing
    postings: dict[str, list[int]] = {}
    wide, room = 1 << 12, 1 << 10  # more segments, and longer ones, than there are
    for number, s in enumerate(segments):
        for off in _anchors(s, idf):
            postings.setdefault(s.words[off], []).append((room - off) * wide + number)
    names = sorted(postings)
    index = F.expr(f"map({', '.join(f'{w!r}, {_array(postings[w], 'bigint')}' for w in names)})")

    words = docs.select("doc_id", row_key().alias("key"), words_of("text").alias("words"))
    n = F.size("words")
    at = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", i).isin(*names)))
    # a candidate is one number: where it starts, and its segment
    starts = F.flatten(
        F.transform(
            F.coalesce(at, F.array().cast("array<int>")),
            lambda i: F.transform(F.element_at(index, F.get("words", i)), lambda x: x + i.cast("bigint") * wide),
        )
    )
    looked = words.select("doc_id", "key", "words", n.cast("bigint").alias("n_words"), F.array_distinct(starts).alias("starts"))

    seg_words = F.expr(_array([list(s.words) for s in segments], "string"))
    seg_must = F.expr(_array([list(s.must) for s in segments], "int"))
    seg_idf = F.expr(_array(weights, "double"))

    def number(x: Column) -> Column:
        return (x % wide).cast("int")

    def begin(x: Column) -> Column:
        return (F.floor(x / wide) - room).cast("int")

    def stands(x: Column, k: Column) -> Column:
        same = F.get("words", begin(x) + k) == F.get(F.get(seg_words, number(x)), k)
        return F.coalesce(same, F.lit(False))

    def share(x: Column) -> Column:
        here = F.get(seg_idf, number(x))
        kept = F.transform(here, lambda v, k: F.when(stands(x, k), v).otherwise(F.lit(0.0)))
        return F.aggregate(kept, F.lit(0.0), lambda a, b: a + b)

    whole = F.filter("starts", lambda x: F.forall(F.get(seg_must, number(x)), lambda k: stands(x, k)))
    found = F.transform(
        whole, lambda x: F.struct(number(x).alias("seg"), begin(x).alias("begin"), share(x).alias("share"))
    )
    met = looked.select("doc_id", "key", "n_words", found.alias("found"))

    total = len(segments)
    best = F.transform(
        F.sequence(F.lit(0), F.lit(total - 1)),
        lambda s: F.array_max(
            F.transform(F.filter("found", lambda x: x["seg"] == s), lambda x: x["share"])
        ),
    )
    best = F.when(F.size("found") > 0, best).otherwise(F.array().cast("array<double>"))
    base = F.filter("found", lambda x: x["seg"].isin(*[s for t in templates if t.kind == "base" for s in t.segments]))
    begins = F.transform(base, lambda x: x["begin"].cast("bigint"))
    ranked = met.select("doc_id", "key", "n_words", begins.alias("begins"), best.alias("best"))

    # per template: its segments, those with key phrases, and its weight, added in one order
    parts = [list(t.segments) for t in templates]
    needed = [[s for s in t.segments if segments[s].must] for t in templates]
    heavy = []
    for t in templates:
        weight = 0.0
        for s in t.segments:
            part = 0.0
            for v in weights[s]:
                part += v
            weight += part
        heavy.append(weight if t.kind == "notice" and weight > 0 else None)

    part_of, needed_of = F.expr(_array(parts, "int")), F.expr(_array(needed, "int"))
    label_of = F.expr(_array([t.label for t in templates], "string"))
    heavy_of = F.expr(_array(heavy, "double"))
    base_size = len(BASE)
    there = F.filter(
        F.sequence(F.lit(0), F.lit(len(templates) - 1)),
        lambda t: F.forall(F.get(needed_of, t), lambda s: F.get("best", s).isNotNull()),
    )
    there = F.when(F.size("best") > 0, there).otherwise(F.array().cast("array<int>"))
    judged = ranked.select("doc_id", "key", "n_words", "begins", "best", there.alias("there"))

    def score(t: Column) -> Column:
        have = F.aggregate(
            F.get(part_of, t), F.lit(0.0), lambda a, s: a + F.coalesce(F.get("best", s), F.lit(0.0))
        )
        part = have / F.get(heavy_of, t)  # NULL for a phrase, which has no score
        return F.when(part > 1, 1.0).otherwise(F.coalesce(part, F.lit(0.0)))

    def labels(of: Column) -> Column:
        return F.array_sort(F.array_distinct(F.transform(of, lambda t: F.get(label_of, t))))

    # a filter on a result must not repeat the search below, once for each of its lambdas
    return evaluate_once(
        judged,
        ["doc_id", "key"],
        {
            "n_words": F.col("n_words"),
            "n_base": F.size("begins").cast("bigint"),
            "first_word": F.array_min("begins"),
            "last_word": F.array_max("begins"),
            "base_labels": labels(F.filter("there", lambda t: t < base_size)),
            "labels": labels(F.col("there")),
            "score": F.coalesce(F.array_max(F.transform("there", score)), F.lit(0.0)),
        },
    )
