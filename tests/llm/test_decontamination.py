import random

import numpy as np
import pytest

from firmbook.llm import decontamination as dc
from firmbook.llm.queries import QUERIES


def smith_waterman(text: list, item: list) -> int:
    score = [[0] * (len(item) + 1) for _ in range(len(text) + 1)]
    for i, a in enumerate(text, 1):
        for j, b in enumerate(item, 1):
            same = dc.MATCH if a == b else dc.MISMATCH
            score[i][j] = max(0, score[i - 1][j - 1] + same, score[i - 1][j] + dc.GAP, score[i][j - 1] + dc.GAP)
    return max(map(max, score))


@pytest.mark.parametrize("seed", range(5))
def test_alignment_equals_the_plain_recursion(seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = [rng.randrange(5) for _ in range(rng.randrange(1, 40))]
        item = [rng.randrange(5) for _ in range(rng.randrange(1, 25))]
        score, first, last = dc.align(np.array(text), np.array(item))
        assert score == smith_waterman(text, item)
        if score:
            assert smith_waterman(text[first:last], item) == score


def test_query_finds_what_whole_alignment_finds(spark, given):
    """Against Smith-Waterman of every text with every item."""
    items = [(r.item_id, dc.normal_words(r.text)) for r in given("benchmark").collect()]
    want = set()
    for row in given("documents").collect():
        words = dc.normal_words(row.text)
        bag = set(words)
        for item_id, item in items:
            least = dc.THRESHOLD * dc.MATCH * len(item)
            if dc.MATCH * sum(w in bag for w in item) >= least and item:
                block = dc.Items([(0, " ".join(item))])
                if dc.align(block.numbers(row.text), block.words[0])[0] >= least:
                    want.add((row.doc_id, item_id))
    found = QUERIES["op1_benchmark_decontamination"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want


def cases(seed: int):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(12, 40)))) for i in range(30)]
    docs, planted = [], set()
    for i in range(300):
        words = [word() for _ in range(rng.randrange(5, 200))]
        if i % 3 == 0:
            item_id, text = rng.choice(items)
            own = text.split()
            kind = i % 4
            if kind == 1:  # every eighth word another
                own = [word() if n % 8 == 5 else w for n, w in enumerate(own)]
            if kind == 2:  # words put in
                own = [x for n, w in enumerate(own) for x in ([w, word()] if n % 6 == 5 else [w])]
            if kind == 3:
                own = [w.upper() + "!!" for w in own]
            at = rng.randrange(len(words))
            words[at:at] = own
            planted.add((i, item_id))
        docs.append((i, " ".join(words)))
    return items, docs, planted


@pytest.mark.parametrize("block, exact", [(2000, False), (7, False), (2000, True), (7, True)])
def test_edited_copies_are_found_and_clean_texts_are_not(spark, block, exact):
    items, docs, planted = cases(block)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = dc.leaks(df, benchmark, block_items=block, exact=exact).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    kept = {r.doc_id for r in dc.without_leaks(df, benchmark).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in planted}


def test_an_item_in_a_third_of_all_texts_keeps_its_seeds(spark):
    item = "the quick brown fox jumps over one lazy dog while nobody looks at it at all"
    docs = [(i, f"text {i} {item if i % 3 == 0 else 'without it'} and so on {i * 7}") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = dc.leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id for r in found.collect()} == {i for i in range(600) if i % 3 == 0}


def test_odd_rows(spark, odd_docs, no_docs, given):
    benchmark = given("benchmark")
    odd_items = spark.createDataFrame(
        [(1, None), (2, ""), (None, "a text without an id"), (3, "w1 w2 w3 w4 w5 w6"), (3, "w1 w2 w3 w4 w5 w6")], "item_id long, text string"
    )
    found = {(r.doc_id, r.item_id) for r in dc.leaks(odd_docs, odd_items).collect()}
    assert found == {(None, None), (4, 3), (5, 3)}
    assert dc.leaks(no_docs, benchmark).count() == dc.leaks(odd_docs, benchmark.where("false")).count() == 0
    kept = dc.without_leaks(odd_docs, odd_items)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, None, None, 7, 7, 8]))


def found_by_whole_alignment(docs: list, items: list) -> set:
    want = set()
    for doc_id, text in docs:
        for item_id, item in items:
            own = dc.normal_words(item)
            score = smith_waterman(dc.normal_words(text), own)
            if score >= max(dc.THRESHOLD * dc.MATCH * len(own), dc.MATCH * min(dc.SEED, len(own))):
                want.add((doc_id, item_id, score / (dc.MATCH * len(own))))
    return want


@pytest.mark.parametrize("exact", [False, True])
def test_heavily_edited_copies_equal_whole_alignment(spark, exact):
    """Every n-th word replaced, or a word put in after every n-th, beside exact copies."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(30, 42)))) for i in range(8)]
    texts = []
    for _, item in items:
        own = item.split()
        for n in (2, 3, 4, 5, 6):
            texts.append([f"x{rng.randrange(9999)}" if k % n == n - 1 else w for k, w in enumerate(own)])
        for n in (1, 2, 3):
            texts.append([x for k, w in enumerate(own) for x in ([w, "put"] if k % n == n - 1 else [w])])
        texts += [own, own, [word() for _ in range(60)]]
    docs = [(i, " ".join([*(word() for _ in range(i % 9)), *t, *(word() for _ in range(i % 7))])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = dc.leaks(df, spark.createDataFrame(items, "item_id long, text string"), exact=exact).collect()
    want = found_by_whole_alignment(docs, items)
    assert {(r.doc_id, r.item_id, r.score) for r in found} == want and len(want) > 60


@pytest.mark.parametrize("exact", [False, True])
def test_short_items_are_found_whole_inside_longer_texts(spark, exact):
    items = [(1, "Rosebud"), (2, "open sesame"), (3, "one two three")]
    docs = [(1, "he said rosebud, then died"), (2, "the cry: Open, Sesame! and so on"), (3, "open the sesame"), (4, "one two four"), (5, "at one two three")]
    found = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), exact=exact)
    assert {(r.doc_id, r.item_id, r.score) for r in found.collect()} == {(1, 1, 1.0), (2, 2, 1.0), (5, 3, 1.0)}


EDITS = {
    "replaced": lambda own, n, other: [other() if k % n == n - 1 else w for k, w in enumerate(own)],
    "put in": lambda own, n, other: [x for k, w in enumerate(own) for x in ([w, other()] if k % n == n - 1 else [w])],
    "left out": lambda own, n, other: [w for k, w in enumerate(own) if k % n != n - 1],
}


@pytest.mark.parametrize("copies", [0, 1, 50])
@pytest.mark.parametrize("rare", [0, dc.RARE_TEXTS])
def test_seeds_recall_what_exact_mode_finds(spark, monkeypatch, copies, rare):
    """Edited copies among exact ones, of words some of which are very common; rare = 0: no pair counts as rare."""
    monkeypatch.setattr(dc, "RARE_TEXTS", rare)
    rng = random.Random(copies)
    word = lambda: f"w{min(rng.randrange(400), rng.randrange(400))}" if rng.random() < 0.7 else rng.choice("the of and to in".split())
    items = [(i, " ".join(word() for _ in range(rng.randrange(20, 50)))) for i in range(25)]
    texts = [item.split() for _, item in items for _ in range(copies)]
    texts += [edit(item.split(), n, lambda: f"x{rng.randrange(10**6)}") for _, item in items for edit in EDITS.values() for n in range(2, 7)]
    texts += [[word() for _ in range(200)] for _ in range(100)]
    docs = [(i, " ".join([*(word() for _ in range(i % 40)), *t, *(word() for _ in range(i % 30))])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pairs = lambda found: {(r.doc_id, r.item_id) for r in found.collect()}
    seeded, exact = pairs(dc.leaks(df, benchmark)), pairs(dc.leaks(df, benchmark, exact=True))
    assert seeded <= exact and len(exact) > 25 * (copies + 9)
    # Where no pair counts as rare, one seed a stretch is left.
    assert len(seeded) >= (0.97 if rare else 0.9) * len(exact)
