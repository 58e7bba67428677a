"""Exact k best inner products by a three-phase uniform threshold.

A vector is cut into `PARTS` parts; every task holds one score list per query
and part over its own vectors. Phase 1 gathers from each task the heads of its
lists with their exact scores; the k-th best of them is a safe cutoff t. Phase 2
sends t to all tasks: a score of t or more needs a part of at least t / PARTS,
so entries above that uniform threshold are sufficient. Phase 3 resolves the
missing parts of those entries exactly and keeps what reaches t.

Queries are taken in blocks of bounded size; a block is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmbook.llm.shared import settle, workspace

SCALE = 1024
PARTS = 4
BLOCK_QUERIES = 2048
#: Pairs of a query and a vector that a task scores at once.
TILE = 1 << 18

_FOUND = "query_no int, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part: no null id, vector or component, all finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )


def _by_length(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and whole-number vectors, for each length of vector that occurs."""
    ids = ids.to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False))
    if len(flat) and np.abs(flat).max() >= 2.0**62:
        raise OverflowError("a component is too large for whole-number scores")
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        at = (ends[rows][:, None] + np.arange(size)[None, :]).astype(np.int64)
        yield ids[rows], flat[at]


def _parts(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact partial scores, [part, query, vector]."""
    cuts = np.array_split(np.arange(queries.shape[1]), PARTS)
    largest = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if largest < 2.0**53:
        return np.stack([queries[:, c] @ vectors[:, c].T for c in cuts]).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (queries, vectors)]
    out = np.array(
        [[[sum(q[i] * v[i] for i in c) for v in whole[1]] for q in whole[0]] for c in cuts], dtype=object
    )
    if abs(out.sum(axis=0)).max(initial=0) >= 2**63:
        raise OverflowError("a score does not fit a long")
    return out.astype(np.int64)


class _Best:
    """The k best (score, smaller id first) per query of what a task has seen."""

    def __init__(self, k: int):
        self.k, self.lists = k, {}

    def add(self, no: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if no in self.lists:
            ids, scores = (np.concatenate(x) for x in zip(self.lists[no], (ids, scores)))
        keep = np.lexsort((ids, -scores))[: self.k]
        self.lists[no] = ids[keep], scores[keep]

    def batch(self) -> pa.RecordBatch:
        numbers = [np.full(len(ids), no, dtype=np.int32) for no, (ids, _) in self.lists.items()]
        columns = [numbers, [x for x, _ in self.lists.values()], [x for _, x in self.lists.values()]]
        kinds = (np.int32, np.int64, np.int64)
        flat = [np.concatenate(c).astype(kind) if c else np.zeros(0, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in flat], names=["query_no", "vec_id", "score"])


def _scan(block: dict[int, tuple], k: int, cutoff: np.ndarray | None):
    """A task's work: the heads of its lists (no cutoff), or what reaches the cutoff.

    block: by length, the queries' numbers, ids and vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            for ids, vectors in _by_length(batch.column("vec_id"), batch.column("vector")):
                numbers, own, queries = block.get(vectors.shape[1], ((), (), ()))
                step = max(1, TILE // max(1, len(numbers)))
                for at in range(0, len(ids) if len(numbers) else 0, step):
                    tile = ids[at : at + step]
                    parts = _parts(queries, vectors[at : at + step])
                    others = own[:, None] != tile[None, :]
                    for row, no in enumerate(numbers):
                        found = np.flatnonzero(others[row])
                        if cutoff is None:
                            heads = [found[np.argsort(-p[row, found], kind="stable")[:k]] for p in parts]
                            found = np.unique(np.concatenate(heads))
                        elif cutoff[no] > np.iinfo(np.int64).min:
                            enough = (parts[:, row, found].max(axis=0) * PARTS) >= cutoff[no]
                            found = found[enough]
                            found = found[parts[:, row, found].sum(axis=0) >= cutoff[no]]
                        if len(found):
                            best.add(int(no), tile[found], parts[:, row, found].sum(axis=0))
        yield best.batch()

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_no").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors with the highest whole-number inner product.

    Both tables have vec_id and embedding; components become floor(1024 * x).
    Ties go to the smaller vec_id; a query's own vec_id is no candidate. Rows
    with a null id or vector, or a null or non-finite component, take no part,
    and vectors of different lengths do not meet. A repeated vector row is a
    candidate each time; a repeated query is answered once. Other columns are
    not looked at. Scores beyond a long raise OverflowError.
    """
    spark = vectors.sparkSession
    candidates, asked = usable(vectors), usable(queries).distinct()
    folder = workspace(spark)
    asked = settle(asked, folder, "queries")
    blocks = max(1, -(-asked.count() // block_queries))
    mine = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))
    results = []
    for number in range(blocks):
        # A block is bounded, so it may pass through the driver.
        table = asked.where(mine == number).orderBy("vec_id", "vector").toArrow().combine_chunks()
        names, block, at = [], {}, 0
        for batch in table.to_batches():
            for ids, whole in _by_length(batch.column("vec_id"), batch.column("vector")):
                block[whole.shape[1]] = np.arange(at, at + len(ids)), ids, whole
                at += len(ids)
                names += ids.tolist()
        if not names:
            continue
        heads = candidates.mapInArrow(_scan(block, k, None), _FOUND)
        cutoff = np.full(len(names), np.iinfo(np.int64).min)
        for row in _ranked(heads, k).where(F.col("rank") == k).select("query_no", "score").collect():
            cutoff[row["query_no"]] = row["score"]
        resolved = _ranked(candidates.mapInArrow(_scan(block, k, cutoff), _FOUND), k)
        ids = spark.createDataFrame(list(enumerate(names)), "query_no int, query_id long")
        results.append(
            settle(
                resolved.join(F.broadcast(ids), "query_no").select("query_id", "rank", "vec_id", "score"),
                folder,
                f"block={number}",
            )
        )
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
