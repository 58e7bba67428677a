import math
import random
import re
from collections import Counter

import pytest

from firmbook.llm import rules
from firmbook.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ["[a-z]", r"[^\x00-\x7F]", "[A-Z]", r"""[.,;:!?'"()-]""", "[0-9]"]


def divergence(p: list[float], q: list[float]) -> float:
    def side(x, y):
        return sum(a * math.log2(2 * a / (a + b)) for a, b in zip(x, y) if a > 1e-12)

    return math.sqrt(max((side(p, q) + side(q, p)) / 2, 0))


def brute(docs: list[tuple]) -> list[tuple]:
    """doc_id, text, lang to the operator's rows."""
    spoken, chars = {}, {}
    for _, text, lang in docs:
        spoken.setdefault(lang, Counter()).update(WORD.findall(text or ""))
        solid = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        kinds = [len(re.findall(k, solid)) for k in KINDS]
        chars.setdefault(lang, Counter()).update(dict(enumerate([*kinds, len(solid) - sum(kinds)])))
    out = []
    for doc, text, lang in docs:
        text = text or ""
        words, solid = WORD.findall(text), re.sub(r"[\x20\x09-\x0D]", "", text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        places = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)}
        n = len(words)
        failed = n < 50 or 100 * len(places) > 50 * n
        far = False
        if n:
            total, own = sum(spoken[lang].values()), Counter(words)
            common = [w for w, k in spoken[lang].items() if k * rules.COMMON >= total]
            p, q = [own[w] / n for w in common], [spoken[lang][w] / total for w in common]
            word = divergence([*p, 1 - sum(p)], [*q, 1 - sum(q)])
            kinds = [len(re.findall(k, solid)) for k in KINDS]
            p = [k / len(solid) for k in [*kinds, len(solid) - sum(kinds)]]
            q = [chars[lang][k] / sum(chars[lang].values()) for k in range(6)]
            slack = rules.SLACK / math.sqrt(n)
            far = word > rules.MAX_WORD_DISTANCE + slack or divergence(p, q) > rules.MAX_CLASS_DISTANCE + slack
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((doc, n, len(solid), symbols, len(lines) - len(set(lines)), len(places), failed, not failed and not far))
    return sorted(out, key=repr)


def result(df) -> list[tuple]:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_query_equals_brute_force(spark, given):
    docs = [(r.doc_id, r.text, r.lang) for r in given("documents").collect()]
    found = result(QUERIES["op12_quality_rules"](spark, "/root/testdata/sf0.001"))
    assert found == brute(docs)
    assert {r[-1] for r in found} == {True, False}


def test_odd_rows(odd_docs):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.select("doc_id", "text", "lang").collect()]
    assert result(rules.judge(odd_docs)) == brute(docs)


def test_no_rows(no_docs):
    assert rules.judge(no_docs).count() == 0


def test_random_repeats(spark, docs_schema):
    rng, docs = random.Random(3), []
    for i in range(200):
        words = [f"{rng.choice('abé#')}{rng.randrange(rng.choice([2, 6, 400]))}" for _ in range(rng.randrange(120))]
        docs.append((i, "".join(w + rng.choice([" ", "  ", "\n", "\n\n", "\t", "\x0b"]) for w in words), rng.choice(["en", None]), "s", 0))
    assert result(rules.judge(spark.createDataFrame(docs, docs_schema))) == brute([d[:3] for d in docs])


def test_junk_goes_and_prose_stays(spark, given):
    folder = "/root/testdata/sf0.01"
    judged = rules.judge(given("documents", folder)).join(given("labels", folder), "doc_id").where("not base_failed")
    share = {r["quality"]: r["k"] for r in judged.groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "k").collect()}
    kept = {r["quality"]: r["k"] for r in judged.where("kept").groupBy("quality").count().withColumnRenamed("count", "k").collect()}
    assert kept[1] >= 0.99 * share[1] and kept.get(0, 0) <= 0.05 * share[0]


def test_very_repetitive_text_takes_linear_time(spark, docs_schema):
    text = "over and over again " * 100_000
    row = rules.judge(spark.createDataFrame([(1, text, "en", "a", 0)], docs_schema)).first()
    assert (row["n_words"], row["n_repeat_words"], row["kept"]) == (400_000, 400_000, False)


@pytest.mark.parametrize("name", ["op12_quality_rules"])
def test_no_python_workers(spark, plan, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
