import random
import re

import pytest

from firmbook.llm import licences
from firmbook.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = [(n, label, base, p, c, re.compile(e)) for n, label, base, p, c, _, e in licences.rules()]


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(owner, text) -> tuple:
    """The row of a text, every rule on the whole text and every two detections compared."""
    words = WORD.findall(lower(text or ""))
    line = f" {' '.join(words)} "
    base, own = [], []
    for number, label, is_base, priority, confidence, expression in RULES:
        for m in expression.finditer(line):
            start, size = line[: m.start()].count(" ") - 1, m[0].count(" ") + 1
            (base if is_base else own).append((start, start + size, priority, number, label, confidence))

    def suppressed(d):
        return any(
            e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2]
            and (e[:2] != d[:2] or e[2] > d[2] or e[3] < d[3])
            for e in own
        )

    kept = [d for d in own if not suppressed(d)]
    starts, names = [d[0] for d in base], lambda found: ",".join(sorted({d[4] for d in found}))
    return (
        owner, len(words), len(base), min(starts, default=None), max(starts, default=None),
        names(base), names(base + kept), max([d[5] for d in base + kept], default=0.0),
    )


def result(df) -> list[tuple]:
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, given):
    docs = given("documents").select("doc_id", "text").collect()
    assert result(QUERIES["op8_license_scan"](spark, "/root/testdata/sf0.001")) == sorted((brute(*r) for r in docs), key=str)


def test_notices_equal_brute_force(spark):
    rng = random.Random(8)
    names = ["MIT License", "Apache License, Version 2.0", "GNU GPL v3", "Mozilla Public License 2.0", "CC BY-NC-SA 4.0",
             "cc by nc", "new BSD license", "Creative Commons Attribution Share-Alike", "ISC licence", "the Unlicense"]
    forms = ["Licensed under the {}.", "see the {} for details", "{}", "released under the terms of the {}", "copy of {};",
             "SPDX-License-Identifier: {}", "subject to {}", "under the {}"]
    rest = ["All rights reserved", "copyright (c) 2021", "über, déjà", "license", "the", "under the MIT", "LICENSE version 2", "\x00"]
    texts = [
        " ".join(rng.choice(forms).format(rng.choice(names)) if rng.random() < 0.5 else rng.choice(rest) for _ in range(rng.randrange(12)))
        for _ in range(300)
    ]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(licences.scan(df)) == sorted((brute(*d) for d in docs), key=str)


def test_rules():
    table = licences.rules()
    assert len(table) > 300 and [r[0] for r in table] == list(range(len(table)))
    for _, _, _, _, _, key, expression in table:
        assert key and not re.search(r"[\\()|?\[\]]", key)


@pytest.mark.parametrize("expression, want", [("mit(?: x11)? licen[cs]e", ["mit", " licen", "e"]), (r"a ?b \d(?: 1(?: 0)?)? c", ["a", "b ", " c"])])
def test_literals(expression, want):
    assert licences.literals(expression) == want


def test_odd_rows(odd_docs, no_docs):
    found = licences.scan(odd_docs).collect()
    assert len(found) == 10
    empty = next(r for r in found if r.doc_id == 1)
    assert tuple(empty)[:8] == (1, 0, 0, None, None, "", "", 0.0) and empty.detections == []
    assert next(r for r in found if r.doc_id == 4).n_words == 120_000
    assert licences.scan(no_docs).count() == 0


def test_many_notices_in_one_text(spark):
    text = "Released under the MIT License. filler words " * 3000
    row = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.labels) == (21_000, 3000, 1, 20_994, "mit")
    assert len(row.detections) == 3000


def test_native(odd_docs):
    plan = licences.scan(odd_docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
