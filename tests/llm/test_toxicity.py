import random
import zlib

import numpy as np
import pytest

from firmbook.llm import toxicity
from firmbook.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("seed", range(3))
def test_automaton_equals_edit_distance(seed):
    rng = random.Random(seed)
    terms = {"".join(rng.choices("abcd", k=rng.randrange(2, 11))) for _ in range(25)}
    automaton = toxicity.Automaton(sorted(terms))
    words = list(terms) + ["".join(rng.choices("abcde", k=rng.randrange(1, 12))) for _ in range(1500)]
    words += [w[:i] + rng.choice("abx") + w[i + rng.randrange(2) :] for w in terms for i in range(len(w))]
    for word in words:
        near = sorted((d, t) for t in terms if (d := distance(word, t)) <= toxicity.allowed(t))
        assert automaton.match(word) == ((near[0][1], near[0][0]) if near else None), word


def test_clean_words_are_no_misspellings():
    automaton = toxicity.Automaton(["moron", "idiot"], ["jerk"], {"oron", "jerkin"})
    assert automaton.match("oron") is None and automaton.match("morron") == ("moron", 1)
    assert automaton.match("jerkface") == ("jerk", -1) and automaton.match("jerkin") is None


def test_quotation_counts_less():
    automaton = toxicity.Automaton(list(toxicity.SEEDS))
    abuse = toxicity.features("you are a worthless idiot and everyone here knows it", automaton)
    spelt = toxicity.features("you are a w0rthless id1ot and everyone here knows it", automaton)
    typo = toxicity.features("you are a wortless idoit and everyone here knows it", automaton)
    quote = toxicity.features('the word "idiot" was quoted in a report about the term "moron" today', automaton)
    assert abuse[1] > 0.9 and abuse[2] == 0 and spelt[3] == abuse[1] and typo[3] > 0.4
    assert quote[1] == 0 and quote[2] > 0.9
    w = toxicity.DEFAULT
    assert min(np.dot(x, w) for x in (abuse, spelt, typo)) > np.dot(quote, w)


def test_held_out_labels(spark, given):
    labels = {r.doc_id: r.toxic for r in given("labels", FOLDER).collect()}
    rows = QUERIES["op7_toxicity"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    # Some labels are noise: toxic ones on texts without a toxic word.
    assert np.mean([p for t, p in held if t]) > 0.9 and np.mean([p for t, p in held if not t]) < 0.005


def test_held_out_labels_are_not_learned_from(spark, given):
    docs, labels = given("documents", "/root/testdata/sf0.01"), given("labels", "/root/testdata/sf0.01")
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    one, two = ({r.doc_id: r.score for r in toxicity.score(docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_odd_rows(spark, odd_docs, no_docs, given):
    labels = given("labels", "/root/testdata/sf0.01")
    assert toxicity.score(no_docs, labels).count() == 0
    found = toxicity.score(odd_docs, labels.where("false")).collect()
    assert len(found) == 10 and {r.predicted for r in found} == {0}
    texts = [(1, "you pathetic loser, worthless trash"), (2, None), (3, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(df, labels.where("false")).collect()} == {1: 1, 2: 0, 3: 0}
    twice = labels.unionByName(labels).withColumn("text", toxicity.F.lit("clash"))
    assert toxicity.score(odd_docs, twice).count() == 10
