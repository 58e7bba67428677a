import random
import re

import numpy as np
import pytest

from firmbook.llm import packing
from firmbook.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check(pieces: list, words: dict, lengths=packing.LENGTHS) -> float:
    """Every word in one place, nothing over capacity, each sequence of the smallest length; returns the share filled."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.n_words))
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert {i: n for i, n in words.items() if n} == {i: sum(n for _, n in own) for i, own in by_doc.items()}
    for own in by_doc.values():
        at = 0
        for start, n in sorted(own):
            assert start == at and n > 0
            at += n
    filled = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.position):
            assert r.position == at
            at += r.n_words
        assert {r.capacity for r in own} == {min(c for c in lengths if c >= at)}
        filled += own[0].capacity
    return sum(words.values()) / max(1, filled)


def test_query(spark, given):
    words = {r.doc_id: len(WORD.findall(r.text or "")) for r in given("documents").collect()}
    assert check(QUERIES["op10_best_fit_packing"](spark, "/root/testdata/sf0.001").collect(), words) > 0.95


@pytest.mark.parametrize("lengths, group", [((64,), 20_000), ((16, 40, 128), 50), ((1,), 100)])
def test_other_lengths(spark, lengths, group):
    rng = random.Random(group)
    words = {i: rng.choice([0, 1, 2, 15, 16, 17, rng.randrange(400)]) for i in range(300)}
    df = spark.createDataFrame([(i, "w " * n) for i, n in words.items()], "doc_id long, text string").repartition(4)
    share = check(packing.pack(df, lengths, group_pieces=group).collect(), words, lengths)
    assert share > 0.85


def plain_best_fit(sizes: list[int], length: int) -> int:
    rooms = []
    for size in sizes:
        fitting = [r for r in rooms if r >= size]
        if fitting:
            rooms.remove(best := min(fitting))
            rooms.append(best - size)
        else:
            rooms.append(length - size)
    return len(rooms)


@pytest.mark.parametrize("seed", range(4))
def test_one_length_is_plain_best_fit(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randrange(1, 101) for _ in range(500)), reverse=True)
    sequence, _, shrunk = packing.best_fit(np.array(sizes), (100,), 0)
    assert len(shrunk) == sequence.max() + 1 == plain_best_fit(sizes, 100)


def test_several_lengths_beat_the_longest_alone():
    rng = random.Random(1)
    sizes = np.array(sorted((rng.choice([600, 610, 90]) for _ in range(400)), reverse=True))
    several = packing.best_fit(sizes, (128, 640, 1024), 8)[2]
    alone = packing.best_fit(sizes, (1024,), 8)[2]
    assert sum(several) + 8 * len(several) < sum(alone) + 8 * len(alone)


def test_odd_rows(spark, odd_docs, no_docs):
    pieces = packing.pack(odd_docs).collect()
    assert sum(r.n_words for r in pieces) == 240_000 + 50 + 2 + 13
    assert {r.doc_id for r in pieces} == {4, 5, None, 7, 8}
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, lengths=())
