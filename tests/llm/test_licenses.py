"""Licence texts by the positional index, against a plain version, and whole licences."""

import math
import re

import pytest

from loomset.llm import licenses
from loomset.llm.queries import QUERIES, table

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT."""
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted"
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version 3 of
the License, or (at your option) any later version."""


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def _words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _plain(texts):
    """Every template at every place of every text, with no index."""
    templates, segments = licenses._templates()
    known = {w for s in segments for w in s.words} - {"-"}
    files = [set(_words(t)) for t in texts]
    idf = {w: math.log((len(texts) + 1) / max(1, sum(w in f for f in files))) for w in known}
    rows = []
    for text in texts:
        words, best = _words(text), {}
        for number, s in enumerate(segments):
            for begin in range(-len(s.words), len(words)):
                same = [0 <= begin + k < len(words) and words[begin + k] == w for k, w in enumerate(s.words)]
                anchors = licenses._anchors(s, idf)
                if all(same[k] for k in s.must) and any(same[k] for k in anchors):
                    part = sum(idf[w] for w, hit in zip(s.words, same) if hit and w != "-")
                    best[number] = max(best.get(number, 0.0), part)
        labels, score = set(), 0.0
        for t in templates:
            if all(s in best for s in t.segments if segments[s].must):
                labels.add(t.label)
                if t.kind == "notice":
                    weight = sum(idf[w] for s in t.segments for w in segments[s].words if w != "-")
                    score = max(score, sum(best.get(s, 0.0) for s in t.segments) / weight)
        rows.append((sorted(labels), min(score, 1.0)))
    return rows


def test_whole_licences_have_their_label(spark):
    texts = [f"# Title\n{MIT}\nmore", f"/* {BSD} */", f"// {GPL}", "The GNU GPL v3", "nothing here", None]
    found = {r.doc_id: r for r in licenses.scan(_docs(spark, texts)).collect()}
    assert found[0].labels == ["mit"] and found[0].score == 1
    assert found[1].labels == ["bsd"] and 0 < found[1].score < 1
    assert found[2].labels == ["gpl", "gpl-3.0"] and found[2].base_labels == ["gpl"] and 0 < found[2].score < 1
    assert found[3].labels == ["gpl", "gpl-3.0"]
    assert [found[k].labels for k in (4, 5)] == [[], []]


def test_inserted_and_changed_words_cost_their_segment_only(spark):
    torn = MIT.replace("free of charge, to any", "free of charge, I say, to any").replace("KIND", "SORT")
    rows = licenses.scan(_docs(spark, [MIT, torn, "x"])).collect()
    score = {r.doc_id: r.score for r in rows}
    assert score[0] == 1 and 0.7 < score[1] < 1
    spoilt = MIT.replace("free of charge", "for money")
    assert {r.labels == [] for r in licenses.scan(_docs(spark, [spoilt])).collect()} == {True}


@pytest.mark.parametrize("more", [[], [BSD, GPL, f"{GPL} {MIT} {BSD}", "cc by nc cc by", "released under an mit license", None, ""]])
def test_index_finds_what_a_plain_search_finds(spark, more):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    texts = [r.text for r in docs.orderBy("doc_id").limit(60 if more else 20).collect()] + more
    found = {r.doc_id: r for r in licenses.scan(_docs(spark, texts)).collect()}
    for i, (labels, score) in enumerate(_plain(texts)):
        assert found[i].labels == labels, texts[i]
        assert found[i].score == pytest.approx(score), texts[i]


def test_long_text_of_notices(spark):
    text = " ".join([GPL, MIT] * 200)
    (row,) = licenses.scan(_docs(spark, [text])).collect()
    assert row.n_base == 200 and row.first_word == _words(GPL).index("general")
    assert row.labels == ["gpl", "gpl-3.0", "mit"]


def test_no_rows_are_shuffled_but_word_counts(spark):
    found = QUERIES["op2_license_scan"](spark, "/root/testdata/sf0.001")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
