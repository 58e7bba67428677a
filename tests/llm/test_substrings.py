import hashlib
import random
import re

import pytest

from firmbook.llm import substrings
from firmbook.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs: list[tuple], size: int = 13) -> list[tuple]:
    first: dict[tuple, int] = {}
    words = {i: WORD.findall(t or "") for i, t in docs}
    for i, own in words.items():
        for k in range(len(own) - size + 1):
            window = tuple(own[k : k + size])
            first[window] = min(i, first.get(window, i))
    out = []
    for i, own in words.items():
        gone = set()
        for k in range(len(own) - size + 1):
            if first[tuple(own[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(w for n, w in enumerate(own) if n not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_query_equals_brute_force(spark, given):
    docs = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    assert result(QUERIES["op5_substring_dedup"](spark, "/root/testdata/sf0.001")) == brute(docs)


@pytest.mark.parametrize("block", [1, 500, 1 << 21])
def test_shared_passages_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    rng = random.Random(4)
    passages = [[f"p{n}{rng.randrange(90)}" for _ in range(rng.randrange(10, 60))] for n in range(12)]
    docs = []
    for i in rng.sample(range(-500, 2000), 200):
        words = [f"é{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            words += rng.choice(passages) + [f"n{rng.randrange(10**6)}"] * rng.randrange(3)
        docs.append((i, "  ".join(words) if i % 3 else "\n".join(words) + " "))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert result(substrings.removed_intervals(df)) == brute(docs)


def test_intervals_are_maximal(spark):
    words = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(words)), (2, "a b " + " ".join(words[:20]) + " c " + " ".join(words[30:45]) + " d")]
    row = substrings.removed_intervals(spark.createDataFrame(docs, "doc_id long, text string")).where("doc_id = 2").first()
    assert (row.starts, row.ends, row.n_removed) == ([2, 23], [22, 38], 35)


def test_odd_rows(odd_docs, no_docs):
    found = substrings.removed_intervals(odd_docs)
    rows = {(r.doc_id, r.n_words, r.n_removed) for r in found.collect()}
    assert found.count() == 10 and {(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 120_000, 0), (5, 120_000, 120_000), (None, 25, 0)} <= rows
    cut = substrings.without_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.dtypes == odd_docs.dtypes
    by_id = {r.doc_id: r for r in cut.collect()}
    assert by_id[1].text is None and by_id[5].text == "" and by_id[5].n_chars == 0
    before = {r.doc_id: r for r in odd_docs.collect()}
    assert by_id[4] == before[4] and by_id[8] == before[8]
    assert substrings.removed_intervals(no_docs).count() == substrings.without_repeats(no_docs).count() == 0


def test_ids_in_steps_are_dealt_to_all_ranges():
    import numpy as np

    from firmbook.llm.shared import home

    for step in (1, 7, 200, 1 << 20):
        dealt = np.bincount(home(np.arange(-20_000, 20_000) * step, 200), minlength=200)
        assert dealt.min() > 100 and dealt.max() < 320
