"""Quality by co-training: a classifier of the text and one of the metadata teach each other.

Both start from the same labelled rows. In every round each labels the rows of
an unlabelled pool that it is sure of, and the other learns from these with less
weight. At last both views are calibrated on labelled rows that neither learned
from, and one logistic regression over the two calibrated views scores all rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmbook.llm.training import logistic, sigmoid

#: Labelled rows that are learned from, and unlabelled rows of the pool, at most.
TRAIN_ROWS = 8_000
POOL_ROWS = 8_000
ROUNDS = 3
#: A pseudo-label is given from this certainty on, and counts so much.
SURE = 0.97
PSEUDO_WEIGHT = 0.3
META_BUCKETS = 48
WORD_BUCKETS = 64
_MARKS = re.compile(r"[^\w\s]{2,}")


def text_view(text: str | None) -> list[float]:
    """Of the text alone: marks, capitals, repetition, word lengths, and hashed word shapes."""
    text = text or ""
    words = text.split()
    n, chars = len(words) + 1e-9, len(text) + 1e-9
    if not words:
        return [1.0, 1.0] + [0.0] * (11 + WORD_BUCKETS)
    lowered = [w.lower() for w in words]
    most = Counter(lowered).most_common(1)[0][1]
    letters = sum(map(str.isalpha, text)) / chars
    upper = sum(map(str.isupper, text)) / chars
    alone = sum(not any(map(str.isalnum, w)) for w in words) / n
    runs = len(_MARKS.findall(text)) / n
    same = sum(a == b for a, b in zip(lowered, lowered[1:])) / n
    lines = [line for line in text.split("\n") if line.strip()]
    out = [
        1.0, 0.0, letters, upper, alone, runs, same, len(set(lowered)) / n, most / n, math.log1p(n) / 10,
        sum(map(len, words)) / n / 20, len(set(lines)) / (len(lines) + 1e-9), text.count("|") / n,
    ]
    shapes = np.zeros(WORD_BUCKETS)
    for word, count in Counter(w[-3:] for w in lowered).items():
        if not word.isalnum():
            shapes[zlib.crc32(word.encode()) % WORD_BUCKETS] += count / n
    return out + shapes.tolist()


TEXT_FEATURES = 13 + WORD_BUCKETS


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Of the metadata alone: language, source, and stated length."""
    buckets = [0.0] * META_BUCKETS
    buckets[zlib.crc32(f"lang={lang}".encode()) % 16] = 1.0
    buckets[16 + zlib.crc32(f"source={source}".encode()) % (META_BUCKETS - 16)] = 1.0
    length = math.log1p(max(0, n_chars or 0)) / 10
    return [1.0, float(n_chars is None), length, length * length, *buckets]


META_FEATURES = 4 + META_BUCKETS


def _views(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    rows = zip(*(part.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
    text = np.array([text_view(t.as_py()) for t in part.column("text")]).reshape(-1, TEXT_FEATURES)
    return text, np.array([meta_view(*r) for r in rows]).reshape(-1, META_FEATURES)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        text, meta = _views(part)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("mark"), *[pa.array(list(x), pa.list_(pa.float64())) for x in (text, meta)]],
            names=["doc_id", "mark", "text_view", "meta_view"],
        )


class Model:
    """Weights of the two views, their calibration, and of the combination."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, scale: list[np.ndarray], mixed: np.ndarray):
        self.text, self.meta, self.scale, self.mixed = text, meta, scale, mixed

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        views = [np.column_stack([np.ones(len(x)), x @ w]) @ s for x, w, s in zip((text, meta), (self.text, self.meta), self.scale)]
        both = np.column_stack([np.ones(len(text)), *views]) @ self.mixed
        return sigmoid(views[0]), sigmoid(views[1]), sigmoid(both)


#: Where labels of both kinds are missing: all documents are kept, at a score of 0.5.
NEUTRAL = Model(
    np.zeros(TEXT_FEATURES), np.zeros(META_FEATURES), [np.zeros(2), np.zeros(2)], np.zeros(3)
)


def co_train(labelled: tuple, pool: tuple, rounds: int = ROUNDS) -> Model:
    """labelled: views and marks (1: good); pool: views without marks."""
    views, mark = labelled[:2], labelled[2]
    fold = np.arange(len(mark)) % 5 == 0  # for calibration
    if len(set(mark[~fold])) < 2 or len(set(mark[fold])) < 2:
        return NEUTRAL
    taught: list[tuple] = [(np.zeros(0, int), np.zeros(0))] * 2
    weights = [np.zeros(0)] * 2
    for turn in range(rounds + 1):
        for v in (0, 1):
            rows, given = taught[v]
            x = np.concatenate([views[v][~fold], pool[v][rows]])
            y = np.concatenate([mark[~fold], given])
            w = np.concatenate([np.ones((~fold).sum()), np.full(len(rows), PSEUDO_WEIGHT)])
            weights[v] = logistic(x, y, ridge=0.1, weight=w)
        if turn == rounds:
            break
        for v in (0, 1):
            p = sigmoid(pool[v] @ weights[v])
            rows = np.flatnonzero((p >= SURE) | (p <= 1 - SURE))
            taught[1 - v] = rows, (p[rows] > 0.5).astype(float)
    logits = [views[v][fold] @ weights[v] for v in (0, 1)]
    scale = [logistic(np.column_stack([np.ones(len(z)), z]), mark[fold], ridge=0.01) for z in logits]
    calibrated = [np.column_stack([np.ones(len(z)), z]) @ s for z, s in zip(logits, scale)]
    mixed = logistic(np.column_stack([np.ones(fold.sum()), *calibrated]), mark[fold], ridge=0.01)
    return Model(weights[0], weights[1], scale, mixed)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, pool: int = POOL_ROWS) -> Model:
    """The model, from at most `rows` labelled and `pool` other rows, the same ones each time."""
    known = docs.where("doc_id is not null")
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min(label).cast("double").alias("mark"))
    order = F.xxhash64("doc_id"), "doc_id"
    chosen = marked.orderBy(*order).limit(rows)
    rest = known.select("doc_id").distinct().join(marked, "doc_id", "left_anti").orderBy(*order).limit(pool)
    wanted = chosen.unionByName(rest.withColumn("mark", F.lit(None).cast("double")))
    table = (
        _prepared(known).join(F.broadcast(wanted), "doc_id")
        .mapInArrow(_features, "doc_id long, mark double, text_view array<double>, meta_view array<double>")
        .toArrow().sort_by([("doc_id", "ascending")])
    )
    if not len(table):
        return NEUTRAL
    mark = table.column("mark").to_numpy(zero_copy_only=False)
    views = [np.array(table.column(c).to_pylist()) for c in ("text_view", "meta_view")]
    given = ~np.isnan(mark.astype(float))
    return co_train((views[0][given], views[1][given], mark[given].astype(float)), (views[0][~given], views[1][~given]))


def _prepared(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source, n_chars; columns that are not there are null."""
    kinds = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return docs.select(*[(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            columns = [pa.array(x) for x in model.scores(*_views(part))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns, part.column("row")],
                names=["doc_id", "text_score", "meta_score", "score", "row"],
            )

    return run


def _scored(docs: DataFrame, labels: DataFrame, row) -> DataFrame:
    model = learn(docs, labels)
    kept = docs.select(row.alias("row"), *[c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns])
    ready = _prepared(kept).schema
    table = kept.select(*[(F.col(f.name) if f.name in kept.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ready], "row")
    kind = table.schema["row"].dataType.simpleString()
    return table.mapInArrow(_score(model), f"doc_id long, text_score double, meta_score double, score double, row {kind}")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, meta_score, score, keep of every row; scores are chances of good quality.

    keep is score >= 0.5. Several labels of an id count as the smallest. Without
    labels of both kinds all scores are 0.5. Null texts count as empty, null
    metadata as a value of its own, missing columns as null. Rows with null or
    equal ids are scored one by one.
    """
    return _scored(docs, labels, F.lit(0)).drop("row").withColumn("keep", F.col("score") >= 0.5)


def good_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    kept = _scored(docs, labels, F.struct(*docs.columns)).where("score >= 0.5")
    return kept.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns])
