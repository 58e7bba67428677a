"""Repeated passages: Rabin-Karp fingerprints of every window of words, counted over all texts.

A word goes when a window of `size` words covers it whose word sequence also
starts in a document with a smaller id. Fingerprints have 64 bits, so among n
different windows about n * n / 2**65 pairs are taken for equal by mistake.

1. Every task packs the distinct fingerprints of a block of windows with the
   smallest id each occurs in, one packed cell per range of fingerprints. What
   occurs twice within a block is settled there: the later documents are told.
2. A task per range finds the smallest id of each fingerprint and tells every
   later document, again in packed cells, one per range of documents.
3. The texts meet what they were told; covered words merge into maximal
   intervals, which are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from firmbook.llm.shared import home, pack, pack_sorted, shuffle_partitions, unpack, unpack_sorted
from firmbook.llm.words import slices, split

WINDOW = 13
#: Windows that a task gathers before it packs them.
BLOCK = 1 << 21

_CELLS = "range int, told boolean, fingerprints binary, ids binary"


def _range_of(fingerprints: np.ndarray, ranges: int) -> np.ndarray:
    return ((fingerprints >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _cells(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of (range, told, fingerprints, ids), some hundred cells each."""
    fields = pa.schema(
        [("range", pa.int32()), ("told", pa.bool_()), ("fingerprints", pa.binary()), ("ids", pa.binary())]
    )
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + len(row[3])
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), fields)], schema=fields)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), fields)], schema=fields)


def _tell(fingerprints: np.ndarray, ids: np.ndarray, ranges: int) -> Iterator[tuple]:
    """Cells that tell documents which of their windows came before, one per range of documents."""
    place = home(ids, ranges)
    order = np.lexsort((fingerprints, place))
    place, fingerprints, ids = place[order], fingerprints[order], ids[order]
    cuts = np.flatnonzero(np.diff(place, prepend=-1))
    for at, to in zip(cuts, np.append(cuts[1:], len(place))):
        yield int(place[at]), True, pack_sorted(fingerprints[at:to]), pack(ids[at:to].view(np.uint64))


def _earliest(fingerprints: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints ascending, their ids, and whether an id is later than the fingerprint's smallest."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, ids = fingerprints[order], ids[order]
    if not len(order):
        return fingerprints, ids, np.zeros(0, bool)
    new = np.append(True, fingerprints[1:] != fingerprints[:-1])
    smallest = np.minimum.reduceat(ids, np.flatnonzero(new))
    return fingerprints, ids, ids > smallest[np.cumsum(new) - 1]


def _index(size: int, ranges: int) -> Callable:
    def block(fingerprints: list, ids: list) -> Iterator[tuple]:
        prints, owners, later = _earliest(np.concatenate(fingerprints), np.concatenate(ids))
        yield from _tell(prints[later], owners[later], ranges)
        prints, owners = prints[~later], owners[~later]
        first = np.append(True, prints[1:] != prints[:-1])[: len(prints)]
        prints, owners = prints[first], owners[first]
        bounds = np.searchsorted(_range_of(prints, ranges), np.arange(ranges + 1))
        for number, (at, to) in enumerate(zip(bounds[:-1], bounds[1:])):
            if at < to:
                yield number, False, pack_sorted(prints[at:to]), pack(owners[at:to].view(np.uint64))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fingerprints, ids, held = [], [], 0
        for part in slices(batches):
            owners = part.column("doc_id").to_numpy(zero_copy_only=False)
            prints, first = split(part.column("text")).windows(size)
            fingerprints.append(prints)
            ids.append(np.repeat(owners, np.diff(first)).astype(np.int64))
            held += len(prints)
            if held >= BLOCK:
                yield from block(fingerprints, ids)
                fingerprints, ids, held = [], [], 0
        if held:
            yield from block(fingerprints, ids)

    return lambda batches: _cells(cells(batches))


def _count(ranges: int) -> Callable:
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fingerprints, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for told, prints, owners, number in zip(
                batch.column("told"), batch.column("fingerprints"), batch.column("ids"), batch.column("range")
            ):
                if told.as_py():
                    yield number.as_py(), True, prints.as_py(), owners.as_py()
                else:
                    fingerprints.append(unpack_sorted(prints.as_buffer()))
                    ids.append(unpack(owners.as_buffer()).view(np.int64))
        prints, owners, later = _earliest(np.concatenate(fingerprints), np.concatenate(ids))
        yield from _tell(prints[later], owners[later], ranges)

    return lambda batches: _cells(cells(batches))


def _shipped(ranges: int) -> Callable:
    """Rows as they travel to meet what they were told, texts compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for part in slices(batches):
            ids, n = part.column("doc_id"), len(part)
            # Rows without an id are told nothing and may go anywhere.
            spread = pa.array(np.arange(n, dtype=np.int64))
            place = home(pc.coalesce(ids, spread).to_numpy(zero_copy_only=False), ranges)
            texts = [t if t is None else packer.compress(t.encode()) for t in part.column("text").to_pylist()]
            columns = [
                pa.array(place, pa.int32()),
                pa.array(np.ones(n, np.int32)),
                ids,
                part.column("rest"),
                pa.array(texts, pa.binary()),
                pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["range", "kind", "doc_id", "rest", "payload", "ids"]
            )

    return run


def covered(flagged: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals [start, end) of words that the windows starting at `flagged` cover."""
    if not len(flagged):
        return flagged, flagged
    breaks = np.flatnonzero(np.diff(flagged) > size)
    return flagged[np.append(0, breaks + 1)], flagged[np.append(breaks, len(flagged) - 1)] + size


def _kept(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words of a text outside the intervals, joined by one space."""
    words, out, at = raw.split(), [], 0
    for start, end in zip(starts.tolist(), ends.tolist()):
        out += words[at:start]
        at = end
    return b" ".join(out + words[at:])


def _by_owner(ids: list, fingerprints: list) -> tuple[np.ndarray, np.ndarray]:
    ids, fingerprints = np.concatenate(ids), np.concatenate(fingerprints)
    order = np.lexsort((fingerprints, ids))
    return ids[order], fingerprints[order]


def _resolve(size: int, finish: Callable) -> Callable:
    """Rows of one range of documents: first the cells that tell, then the texts."""

    def texts(held: list, told: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        unpacker = zstandard.ZstdDecompressor()
        raws = [b"" if packed is None else unpacker.decompress(packed) for *_, packed in held]
        words = split(pa.array(raws, pa.large_binary()).cast(pa.large_string()))
        prints, first = words.windows(size)
        out = []
        for doc, (owner, rest, packed) in enumerate(held):
            own = slice(0, 0) if owner is None else slice(*np.searchsorted(told[0], [owner, owner + 1]))
            own, flagged = told[1][own], np.zeros(0, np.int64)
            if len(own):
                mine = prints[first[doc] : first[doc + 1]]
                near = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                flagged = np.flatnonzero(own[near] == mine)
            starts, ends = covered(flagged, size)
            raw = None if packed is None else raws[doc]
            out.append((owner, rest, raw, int(words.counts[doc]), int((ends - starts).sum()), starts, ends))
        return finish(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fingerprints, ids, told = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], None
        held, size_held = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("kind", "doc_id", "rest", "payload", "ids")]
            for kind, owner, rest, payload, owners in zip(*columns):
                if kind.as_py() == 0:
                    fingerprints.append(unpack_sorted(payload.as_buffer()))
                    ids.append(unpack(owners.as_buffer()).view(np.int64))
                    continue
                if told is None:
                    told = _by_owner(ids, fingerprints)
                held.append((owner.as_py(), rest.as_py(), payload.as_py()))
                size_held += len(held[-1][2] or b"")
                if size_held > 1 << 18:
                    yield texts(held, told)
                    held, size_held = [], 0
        if held:
            yield texts(held, told)

    return run


def _digests(out: list) -> pa.RecordBatch:
    ids, _, raws, words, removed, starts, ends = zip(*out)
    kept = [hashlib.sha256(_kept(raw or b"", a, b)).hexdigest() for raw, a, b in zip(raws, starts, ends)]
    columns = [pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept)]
    columns += [pa.array([x.astype(np.int32) for x in side], pa.list_(pa.int32())) for side in (starts, ends)]
    return pa.RecordBatch.from_arrays(
        columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "starts", "ends"]
    )


def _texts(rest_type: pa.DataType) -> Callable:
    def finish(out: list) -> pa.RecordBatch:
        ids, rests, raws, _, removed, starts, ends = zip(*out)
        texts = [
            _kept(raw, a, b).decode() if n else raw if raw is None else raw.decode()
            for raw, n, a, b in zip(raws, removed, starts, ends)
        ]
        columns = [pa.array(ids, pa.int64()), pa.array(rests, rest_type)]
        columns += [pa.array(texts, pa.string()), pa.array(removed, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "rest", "text", "n_removed"])

    return finish


def _removed(rows: DataFrame, size: int, finish: Callable, schema: str) -> DataFrame:
    """rows: doc_id, text, rest."""
    ranges = shuffle_partitions(rows.sparkSession)
    told = (
        rows.where(F.col("doc_id").isNotNull())
        .select("doc_id", "text")
        .mapInArrow(_index(size, ranges), _CELLS)
        .repartitionById(ranges, F.col("range"))
        .mapInArrow(_count(ranges), _CELLS)
        .select(
            "range",
            F.lit(0).alias("kind"),
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast(rows.schema["rest"].dataType).alias("rest"),
            F.col("fingerprints").alias("payload"),
            "ids",
        )
    )
    texts = rows.mapInArrow(_shipped(ranges), told.schema)
    return (
        told.unionByName(texts)
        .repartitionById(ranges, F.col("range"))
        .sortWithinPartitions("kind")
        .mapInArrow(_resolve(size, finish), schema)
    )


def removed_intervals(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and the removed intervals of words [starts, ends).

    One row per input row. Null and empty texts have no words; texts with fewer
    than `size` words lose none. A row without an id neither loses words nor
    makes others lose them. Rows of one id do not make each other lose words.
    Columns other than doc_id and text are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(F.lit(0)).alias("rest"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, starts array<int>, ends array<int>"
    return _removed(rows, size, _digests, schema)


def without_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """`docs` with the repeated words cut out of text; the words that stay are joined by one space.

    A text that loses nothing stays as it is, null too. n_chars, where there is
    such a column, follows a changed text; all other columns are kept.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", rest.alias("rest"))
    schema = StructType(
        [*rows.select("doc_id", "rest", "text").schema.fields, StructField("n_removed", LongType())]
    )
    cut = _removed(rows, size, _texts(to_arrow_type(rows.schema["rest"].dataType)), schema)
    columns = {c: F.col(f"rest.{c}") for c in others} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in others:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("rest.n_chars"))
    return cut.select(*[columns[c].alias(c) for c in docs.columns])
