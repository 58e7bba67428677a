import random
import re
from collections import Counter

import pytest

from firmbook.llm import audit
from firmbook.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs: list[tuple], ranks: int = 200) -> list[tuple]:
    """(text, lang, source) of all rows to the operator's rows, term by term for every pair."""
    docs = [(TERM.findall((t or "").translate(LOWER)), lang or "", source or "") for t, lang, source in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        df = Counter(w for words, *_ in own for w in set(words))
        kept = [w for w, n in df.items() if n >= 3]
        counts = {s: Counter(w for words, _, src in own if src == s for w in words) for s in {d[2] for d in own}}
        every = Counter(w for words, *_ in own for w in words)

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 1) // (total + len(kept)) for w in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(every)
        for s in counts:
            pairs = [(sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept), t) for t in counts if t != s]
            more = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", more, ranks)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def result(df) -> list[tuple]:
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def rows(df) -> list[tuple]:
    return [(r["text"], r["lang"], r["source"]) for r in df.select("text", "lang", "source").collect()]


def test_query_equals_brute_force(spark, given):
    assert result(QUERIES["op13_source_divergence_audit"](spark, "/root/testdata/sf0.001")) == brute(rows(given("documents")))


def test_odd_rows(odd_docs):
    assert result(audit.audit(odd_docs)) == brute(rows(odd_docs))


def test_no_rows(no_docs):
    assert result(audit.audit(no_docs)) == []


@pytest.mark.parametrize("nodes, held", [(1, 1), (7, 5), (1 << 16, 1 << 20)])
def test_small_trees_and_flushes_equal_brute_force(spark, monkeypatch, nodes, held):
    monkeypatch.setattr(audit, "NODES", nodes)
    monkeypatch.setattr(audit, "HELD_ROWS", held)
    rng, docs = random.Random(nodes), []
    for i in range(150):
        words = [rng.choice(["Été", "a", "B", "zz", "Ünder"]) + rng.choice("abcdef") * rng.randrange(4) for _ in range(rng.randrange(40))]
        docs.append((i, rng.choice([", ", " ", "9"]).join(words), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "Ä", "c", None])))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(5)
    assert result(audit.audit(df)) == brute([d[1:] for d in docs])


def test_languages_without_kept_terms_and_with_one_source(spark):
    docs = [("one two", "x", "a"), ("three", "x", "b"), (None, "y", "only"), ("k k k", "z", "only"), ("k", "z", "only"), ("k", "z", "only")]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    found = result(audit.audit(df))
    assert found == brute(docs) == [("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)]


def test_extreme_shares_stay_exact(spark):
    # One group holds almost nothing but one term, the other almost nothing of it: f near 10**18.
    docs = [("w " * 400_000, "x", "a")] * 3 + [("v " * 400_000 + "w", "x", "b")] * 3
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert result(audit.audit(df)) == brute(docs)


def test_shared_paths_are_corrected_once():
    tree = audit._Tree()
    tree.insert([(1, 5, 2), (2, 7, 3)], 4)
    tree.insert([(1, 5, 2), (2, 7, 3), (3, 9, 4)], 6)
    assert len(tree.parent) == 3 and tree.n == [10, 10, 6]
