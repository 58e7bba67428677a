"""Toxicity by misspelling-tolerant lexicon search and the context of what is found.

A lexicon of a few seed terms, and of words and word stems that labelled texts
show as toxic, is kept as a trie. Levenshtein automata of the words allowed distances run over
the trie: a state is the set of trie nodes with the edits spent, and states are
built when a text first needs them. A match counts as abuse or as quotation by
the words and marks around it; a logistic regression on these counts gives the
score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firmbook.llm.training import logistic, sigmoid

#: Terms known without labels.
SEEDS = ("idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting", "trash", "clown")
#: Words that report what someone else says.
REPORTING = frozenset("said says called calls quoted quote quotes word term insult insults wrote writes".split())
ADDRESS = frozenset("you your youre yourself u ur".split())
QUOTES = frozenset("\"“”„«»‘’'")
WINDOW = 4
#: Labelled texts that the model is fitted on, at most.
TRAIN_ROWS = 10_000
#: Learned terms, at most; the strongest.
TERMS = 400
#: Letters of a learned stem.
STEM = range(3, 9)
_WORD = re.compile(r"[^\W_](?:[\w@$*'’]*[^\W_])?")
_LEET = str.maketrans("01345@$", "oieasas")


def allowed(term: str) -> int:
    """Edits within which a word counts as a misspelling of the term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Which term a word spells, and with how many edits."""

    def __init__(self, terms: list[str], stems: list[str] = (), clean: set[str] = frozenset()):
        self.stems = frozenset(stems)
        self.stem_lengths = sorted({len(s) for s in stems})
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.budget: list[int] = [0]  # the largest allowance below a node
        for term in sorted(set(terms)):
            node, spare = 0, allowed(term)
            self.budget[0] = max(self.budget[0], spare)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.budget.append(0)
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], spare)
            self.term[node] = term
        self.clean = frozenset(clean)
        self.start = self._closed({0: 0})
        self.moves: dict[tuple, tuple] = {}
        self.known: dict[str, tuple[str, int] | None] = {}

    def _closed(self, nodes: dict[int, int]) -> tuple:
        """With letters of the term left out; a state as sorted (node, edits)."""
        waiting = list(nodes.items())
        while waiting:
            node, edits = waiting.pop()
            if nodes.get(node, 99) < edits:
                continue
            for child in self.children[node].values():
                if edits < self.budget[child] and edits + 1 < nodes.get(child, 99):
                    nodes[child] = edits + 1
                    waiting.append((child, edits + 1))
        return tuple(sorted(nodes.items()))

    def _move(self, state: tuple, letter: str) -> tuple:
        nodes: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.budget[node] and edits < nodes.get(node, 99):
                nodes[node] = edits

        for node, edits in state:
            reach(node, edits + 1)  # a letter too many
            for own, child in self.children[node].items():
                reach(child, edits + (own != letter))
        return self._closed(nodes)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its allowance and the edits, for a lower-case word; (stem, -1) for its other forms."""
        if word in self.known:
            return self.known[word]
        state = self.start
        for letter in word:
            moved = self.moves.get((state, letter))
            if moved is None:
                moved = self.moves[state, letter] = self._move(state, letter)
            state = moved
            if not state:
                break
        ends = [(e, self.term[n]) for n, e in state if self.term[n] and e <= allowed(self.term[n])]
        found = min(ends) if ends else None
        found = (found[1], found[0]) if found and (found[0] == 0 or word not in self.clean) else None
        if found is None and word not in self.clean:
            found = next(((word[:n], -1) for n in self.stem_lengths if word[:n] in self.stems), None)
        if len(self.known) > 500_000:
            self.known.clear()
        self.known[word] = found
        return found

    def near(self, words: list[str]) -> set[str]:
        """Those that the automaton takes for a misspelling or another form."""
        return {w for w in words if (m := self.match(w)) and m[1]}


FEATURES = 10


def features(text: str | None, automaton: Automaton) -> list[float]:
    """1, then evidence of exact terms, misspelt terms and other forms, each as abuse and as quotation, and its rate."""
    text = text or ""
    lowered = text.lower()
    words = _WORD.findall(lowered)
    match, sums = automaton.match, [0.0] * 6
    hits = [(n, m) for n, w in enumerate(words) if (m := match(w)) or (not w.isalpha() and (m := match(w.translate(_LEET))))]
    if hits:
        spans = [x.span() for x in _WORD.finditer(lowered)]
        for n, (_, edits) in hits:
            around = words[max(0, n - WINDOW) : n] + words[n + 1 : n + 1 + WINDOW]
            left, right = spans[n]
            before, after = lowered[max(0, left - 2) : left].strip(), lowered[right : right + 2].strip()
            quoted = 0.6 * (before[-1:] in QUOTES and before != "") + 0.6 * (after[:1] in QUOTES and after != "")
            quoted += 0.5 * any(w in REPORTING for w in around)
            quoted -= 0.5 * any(w in ADDRESS for w in around)
            quoted = min(1.0, max(0.0, quoted))
            kind = 0 if edits == 0 else 2 if edits > 0 else 4
            sums[kind] += 1 - quoted
            sums[kind + 1] += quoted
    total = sums[0] + sums[2] + sums[4]
    return [1.0, *map(math.log1p, sums), float(sums[0] >= 0.5), float(sums[4] >= 1.5), math.log1p(100 * total / (len(words) + 20))]


#: Used where labels of both kinds are missing.
DEFAULT = np.array([-3.0, 2.5, 0.0, 2.0, 0.0, 1.0, 0.0, 2.5, 0.5, 0.5])


def _rows(automaton: Automaton, beta: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py(), automaton) for t in batch.column("text")]).reshape(-1, FEATURES)
            if beta is None:
                last = pa.array(list(x), pa.list_(pa.float64()))
            else:
                last = pa.array(sigmoid(x @ beta))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), last], names=["doc_id", "mark", "last"]
            )

    return run


def held_out(doc_id: str = "doc_id"):
    """Rows that no model learns from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, mark, text of at most `rows` labelled rows that are not held out, the same ones each time."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max(label).cast("double").alias("mark"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "mark", "text")


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[Automaton, np.ndarray]:
    """The automaton and the weights, from labelled texts that are not held out."""
    texts = training_texts(docs, labels, label, rows).select("mark", "text").distinct().persist()
    try:
        words = texts.select(
            "mark", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0))).alias("word")
        )
        seen = words.groupBy("word").agg(F.sum("mark").alias("toxic"), F.count("*").alias("texts"))
        kinds = texts.groupBy().agg(F.sum("mark").alias("toxic"), F.count("*").alias("texts")).first()
        toxic, clean = kinds["toxic"] or 0, kinds["texts"] - (kinds["toxic"] or 0)
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("texts") - F.col("toxic") + 0.5) / (clean + 1))
        strong = seen.where(F.col("toxic") >= max(5, 0.01 * toxic)).where(F.length("word") > 2).withColumn("odds", odds)
        strong = strong.where("odds > 3").orderBy(F.col("odds").desc(), "word").limit(TERMS)
        terms = sorted({*SEEDS, *[r["word"] for r in strong.select("word").collect()]})
        # A stem is the beginning of many words that are each found in toxic texts rather than in clean ones.
        marked = seen.withColumn("odds", odds).where(F.length("word") >= min(STEM)).select(
            "word", ((F.col("toxic") > 1) & (F.col("odds") > 1.5)).cast("int").alias("bad"), (F.col("odds") < 0.5).cast("int").alias("good")
        )
        begun = marked.where("bad + good > 0").select(
            F.explode(F.transform(F.sequence(F.lit(min(STEM)), F.least(F.lit(max(STEM)), F.length("word"))), lambda n: F.substring("word", 1, n))).alias("stem"), "bad", "good"
        )
        begun = begun.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where("bad >= 6 and bad > good")
        strong = {r["stem"]: r["bad"] for r in begun.orderBy(F.col("bad").desc(), "stem").limit(10 * TERMS).collect()}
        # Of nested stems the longest that loses little.
        stems = [x for x, n in strong.items() if not any(len(y) > len(x) and y.startswith(x) and m >= 0.9 * n for y, m in strong.items())]
        # Words of clean texts are no misspellings or other forms, however near they are.
        bare = Automaton(terms, stems)
        usual = marked.where("good = 1")
        schema = StructType([usual.schema["word"]])

        def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = sorted(bare.near(batch.column("word").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["word"])

        automaton = Automaton(terms, stems, {r["word"] for r in usual.select("word").mapInArrow(close, schema).collect()})
        if not toxic or not clean:
            return automaton, DEFAULT
        table = (
            texts.select(F.lit(0).cast("long").alias("doc_id"), "mark", "text")
            .mapInArrow(_rows(automaton, None), "doc_id long, mark double, last array<double>")
            .toArrow()
        )
    finally:
        texts.unpersist()
    x = np.array(table.column("last").to_pylist())
    return automaton, logistic(x, table.column("mark").to_numpy())


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its text alone.

    Only labelled rows with crc32(doc_id) mod 5 not 0 are learned from, at most
    `rows` of them, equal texts with one label once; several labels of an id
    count as the largest. Without labels of both kinds the seed terms and set
    weights are used. Null and empty texts have a score too. A null id is not
    held out. Columns other than doc_id and text are not looked at.
    """
    automaton, beta = learn(docs, labels, rows=rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.0).alias("mark"), "text")
    scored = texts.mapInArrow(_rows(automaton, beta), "doc_id long, mark double, last double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("last").alias("score"),
        (F.col("last") >= 0.5).cast("int").alias("predicted"),
    )
