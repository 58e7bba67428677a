import random
import re
from collections import Counter

import numpy as np
import pytest

from firmbook.llm import phrases
from firmbook.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs: list[tuple], threshold: int = 30, ranks: int = 2000) -> list[tuple]:
    """(text, lang) of all rows to the operator's rows."""
    f, spoken = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            spoken[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        known = {p: a for p, a in own.items() if len(p) > 1 and a >= threshold}
        longer = {}
        for p, a in known.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(a, longer.get(p[i : i + k], 0))
        found = []
        for p, a in known.items():
            if 100 * longer.get(p, 0) >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:ranks], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, spoken[lang], -score))
    return sorted(out)


def result(df) -> list[tuple]:
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def rows(df) -> list[tuple]:
    return [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]


def test_query_equals_brute_force(spark, given):
    found = result(QUERIES["op11_phrase_collocations"](spark, "/root/testdata/sf0.001"))
    assert found == brute(rows(given("documents"))) and len(found) > 20


def test_odd_rows(odd_docs):
    assert result(phrases.collocations(odd_docs, threshold=2)) == brute(rows(odd_docs), 2)


def test_no_rows(no_docs):
    assert result(phrases.collocations(no_docs)) == []


@pytest.mark.parametrize("held, held_rows, ranks, threshold", [(1, 1, 3, 2), (500, 40, 20, 5), (1 << 22, 1 << 19, 2000, 30)])
def test_small_cells_and_summaries_equal_brute_force(spark, monkeypatch, held, held_rows, ranks, threshold):
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "HELD_ENTRIES", held)
    monkeypatch.setattr(phrases, "HELD_ROWS", held_rows)
    rng, docs = random.Random(held), []
    for i in range(120):
        words = [rng.choice(["new", "York", "é", "of", "the", f"w{rng.randrange(60)}"]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ".", ", ", "\n", "\x0b"]) for w in words)
        docs.append((i, text if i % 9 else None, rng.choice(["en", "de", None])))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(6)
    expected = brute([d[1:] for d in docs], threshold, ranks)
    assert expected and result(phrases.collocations(df, threshold, ranks)) == expected


def test_a_bitmap_too_small_changes_nothing(spark, given, monkeypatch):
    docs = given("documents")
    whole = sorted(map(tuple, phrases.frequent_ngrams(docs).collect()))
    assert whole == sorted(map(tuple, phrases.frequent_ngrams(docs, max_bits=10).collect()))


def test_summary_keeps_every_frequent_entry():
    rng = random.Random(1)
    keys = [rng.choice([rng.randrange(40), rng.randrange(100_000)]) for _ in range(60_000)]
    counts, threshold = Counter(keys), 30
    summary = phrases.Summary(len(keys) // threshold + 1)
    for at in range(0, len(keys), 701):
        part = Counter(keys[at : at + 701])
        summary.merge(np.array(list(part), np.uint64), np.array(list(part.values()), np.int64))
        assert len(summary.keys) <= summary.capacity and summary.lost < threshold
    assert summary.lost > 0
    assert {k for k, n in counts.items() if n >= threshold} <= set(summary.frequent(threshold).tolist())


def test_large_counts_stay_exact(spark, monkeypatch):
    # 2000000 a passes 64 bits.
    a = 7 * 10**13 + 1
    known = [("en", 0, "", 3 * a), ("en", 1, "x", a), ("en", 1, "y", a + 1), ("en", 2, "x y", a)]
    df = spark.createDataFrame(known, "lang string, size int, phrase string, f long")
    monkeypatch.setattr(phrases, "frequent_ngrams", lambda *args, **kwargs: df)
    assert result(phrases.collocations(df.selectExpr("phrase as text", "lang"))) == [("en", 1, "x y", a, a, a + 1, 3 * a, 2_000_000 * a // (2 * a + 1))]
