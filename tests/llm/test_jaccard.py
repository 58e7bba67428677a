import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from firmbook.llm import jaccard
from firmbook.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(docs: list[tuple]) -> list[tuple]:
    """doc_id, n_shingles, component_id by comparing all sets that share a shingle."""
    sets = {}
    for owner, text in docs:
        words = WORD.findall(lower(text or ""))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        sets[owner] = grams or ({tuple(words)} if words else set())
    index, parent, common = defaultdict(list), {i: i for i in sets}, Counter()
    for owner in sorted(sets):
        for gram in sets[owner]:
            index[gram].append(owner)
    for owners in index.values():
        common.update((a, b) for n, a in enumerate(owners) for b in owners[n + 1 :])

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def result(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_query_equals_brute_force(spark, given):
    docs = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()]
    assert result(QUERIES["op3_ngram_jaccard_join"](spark, "/root/testdata/sf0.001")) == brute(docs)


def edited(rng, base: list[str], share: float) -> str:
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in base)


def dense_group(seed: int, size: int = 240) -> list[tuple]:
    """Copies of a text that is not there itself, edited so that some are linked and some are not."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(400)}" for _ in range(160)]
    other = [f"c{rng.randrange(400)}" for _ in range(60)]
    line = "a line that a third of all texts begin with".split()
    docs = [edited(rng, base, rng.choice([0.005, 0.015, 0.03, 0.05])) for _ in range(size)]
    docs += [" ".join(line + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 30))]) for _ in range(size)]
    docs += [edited(rng, other[: rng.randrange(40, 60)], 0.01) for _ in range(size // 4)]
    docs += [" ".join(["was"] * rng.randrange(1, 30)) for _ in range(10)] + docs[:20]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed, group, block", [(1, 256, 1 << 21), (2, 16, 3000)])
def test_dense_groups_equal_brute_force(spark, monkeypatch, seed, group, block):
    """Many sets near the threshold; small groups and blocks, so that all of their borders are crossed."""
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "MEMBERS", group)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "POSTINGS", block)
    docs = dense_group(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(jaccard.near_duplicates(df)) == brute(docs)


def test_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(16)]  # 12 shingles
    docs = [
        (1, " ".join(base)),
        (2, " ".join(base[:13])),  # 9 of 12: linked
        (3, " ".join(base[8:] + ["q"])),  # 4 and one more
        (4, "One two THREE"),
        (5, "one two three"),  # the whole short text is one shingle
        (6, "one two four"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(jaccard.near_duplicates(df)) == [(1, 12, 1), (2, 9, 1), (3, 5, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6)]


def test_odd_rows(odd_docs, no_docs):
    found = jaccard.near_duplicates(odd_docs).collect()
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert len(found) == 10
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[4] == by_id[5] == (5000, 4) and by_id[None][1] is None and by_id[7] == (1, 7)
    assert jaccard.near_duplicates(no_docs).count() == 0
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, None, None, 7, 7, 8]))
    assert jaccard.one_of_each(no_docs).count() == 0


def one_list(component: np.ndarray) -> list[np.ndarray]:
    """Columns of the index list of a shingle: sets of 20 shingles that may share them all."""
    rep, all_of = np.arange(len(component), dtype=np.uint64), lambda x: np.full(len(component), x, np.uint64)
    return [all_of(7), rep, component.astype(np.uint64), all_of(20), all_of(20), all_of(1), rep, all_of(19)]


def pairs_of(batches) -> set:
    found = set()
    for batch in batches:
        for row in batch.to_pylist():
            found.update(zip(*(np.frombuffer(row[c], np.int64).tolist() for c in ("member", "guest"))))
    return found


def test_candidates_may_be_sent_with_the_last_pair_of_blocks():
    """725 sets make 262,450 pairs, and only the last block's bring them over 262,144."""
    columns = one_list(np.arange(725))
    cells = list(jaccard._send(0, np.zeros(725, np.uint64), columns, 1))
    assert len(pairs_of(jaccard._candidates(iter(cells)))) == 725 * 724 // 2


def test_blocks_within_one_component_are_skipped(monkeypatch):
    """A stray set among 4,000 of one component is held against each block of them, not these against each other."""
    looked, possible = [], jaccard.possible
    monkeypatch.setattr(jaccard, "possible", lambda a, b: looked.append(1) or possible(a, b))
    component = np.where(np.arange(4000) == 1234, 1234, 0)
    cells = list(jaccard._send(0, np.zeros(4000, np.uint64), one_list(component), 1))
    found = pairs_of(jaccard._candidates(iter(cells)))
    assert {frozenset(p) for p in found} == {frozenset((1234, i)) for i in range(4000) if i != 1234}
    assert len(looked) <= 2 + -(-4000 // jaccard.SKIP)


@pytest.mark.parametrize("step", [1, -1])
def test_equal_sets_are_posted_once_by_a_task(step):
    texts = [" ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))]
    none = np.zeros(0, np.uint64)

    def posted(ids: list[int]) -> list[int]:
        part = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids), "text": [texts[i % 2] for i in ids]})
        cells = [c for b in jaccard._postings(5, none, none.view(np.int64), 1)(iter([part])) for c in b.to_pylist()]
        return sorted(i for c in cells if c["kind"] == 0 for i in jaccard.unpack(c["columns"][1]).tolist())

    assert posted(list(range(600))[::step]) == posted([0, 1]) and set(posted([0, 1])) == {0, 1}


def test_ranks_of_counts_too_large_for_them_are_a_tie():
    def entry(component, reach, rank):
        columns = [np.array([x], np.uint64) for x in (component, component)] + [np.array([x]) for x in (20, reach)]
        return jaccard.Entries(*columns, np.array([rank], np.uint64), np.array([0], np.uint64), np.array([19]))

    for count, can in (((1 << 24) - 1, True), ((1 << 24) - 2, False)):
        ends_first, other = entry(1, 3, count << 40), entry(2, 20, (count << 40) + 5)
        assert jaccard.possible(ends_first, other)[0] == jaccard.possible(other, ends_first)[0] == can
