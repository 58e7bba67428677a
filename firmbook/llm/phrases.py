"""Collocations: phrases of two to four words whose parts seldom stand without each other.

1. Every task counts the n-grams (one to four words) of a stretch of texts by
   fingerprint and sends them to hash partitions in packed cells. A partition
   keeps a Misra-Gries summary: when it holds more entries than its capacity,
   all counts fall by the first count beyond it and those without any go. The
   capacity exceeds the partition's mass over the threshold, so all that is ever
   taken from one entry is less than the threshold, and each n-gram with as many
   occurrences survives. The mass is known before the first cell: its parts
   travel in rows of their own that come first.
2. A bitmap of what survived, of bounded size, goes to every executor. A second
   pass counts what it lets through, exactly and by the text of the n-gram.

Fingerprints of the first pass have 48 bits: one shared by two n-grams adds
their counts and lets both through. A stretch of texts in the second pass tells
its n-grams apart by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmbook.llm.shared import pack, pack_sorted, settle, shuffle_partitions, unpack, unpack_sorted, workspace
from firmbook.llm.words import Words, mix, slices, split

LONGEST = 4
THRESHOLD = 30
#: A longer phrase with this percentage of a phrase's occurrences takes its place.
COVERED_PERCENT = 80
RANKS = 2000
NO_LANG = "und"
#: n-grams that a task of the first pass gathers before it sends them, entries that a
#: summary takes in at once, and rows that a task of the second pass gathers.
HELD = 1 << 21
HELD_ENTRIES = 1 << 19
HELD_ROWS = 1 << 18
#: The bitmap has 32 bits for each survivor, up to 2 ** MAX_BITS; beyond that more is counted and thrown away.
MAX_BITS = 31

_ENDS_PIECE = np.zeros(256, dtype=bool)
_ENDS_PIECE[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[[0x20, 0x09]] = True
_CELLS = "range int, kind int, mass long, prints binary, counts binary"


def _lang_prints(langs: list[str]) -> np.ndarray:
    """A fingerprint of each language code, by its characters."""
    out = np.zeros(len(langs), dtype=np.uint64)
    for at, lang in enumerate(langs):
        value = np.array([len(lang) + 1], dtype=np.uint64)
        for byte in lang.encode():
            value = mix(value * np.uint64(257) + np.uint64(byte))
        out[at] = value[0]
    return out


def _ngrams(words: Words, langs: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of words the places where an n-gram begins and its fingerprints within the language."""
    n = len(words.starts)
    pieces = np.concatenate([[0], np.cumsum(_ENDS_PIECE[words.data])])
    new = np.ones(n + 1, dtype=bool)
    new[1:-1] = pieces[words.starts[1:]] != pieces[words.ends[:-1]]
    new[words.first] = True
    piece = np.cumsum(new[:-1])
    lang = np.repeat(langs, words.counts)
    for size in range(1, longest + 1):
        prints, first = words.windows(size)
        at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], np.diff(first))
        whole = piece[at + size - 1] == piece[at]
        at = at[whole]
        yield size, at, mix(prints[whole] ^ lang[at])


def _parted(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[Words, list[str], np.ndarray, Iterator]]:
    """Slices of texts: their words, the languages there, the language of each text and the n-grams."""
    for part in slices(batches):
        langs = part.column("lang").fill_null(NO_LANG).to_pylist()
        words = split(part.column("text"), lower=True, blank=_ENDS_WORD)
        kinds = {lang: at for at, lang in enumerate(dict.fromkeys(langs))}
        codes = np.array([kinds[lang] for lang in langs], dtype=np.int64)
        yield words, list(kinds), codes, _ngrams(words, _lang_prints(list(kinds))[codes], longest)


def _range_of(prints: np.ndarray, ranges: int) -> np.ndarray:
    """The partition of a 48-bit fingerprint."""
    return ((prints >> np.uint64(16)) * np.uint64(ranges)) >> np.uint64(32)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"range": pa.int32(), "kind": pa.int32(), "mass": pa.int64(), "prints": pa.binary(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))


def _summaries(ranges: int, most: int, longest: int):
    """Counted n-grams of stretches of texts, a cell for each partition, and the mass that each cell brings."""

    def cells(prints: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        # Compressed here: a batch of cells is held by both sides of a task.
        packer = zstandard.ZstdCompressor(level=1)
        keys, counts = np.unique(np.concatenate(prints), return_counts=True)
        bounds = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
        rows = []
        for number, (at, to) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if at < to:
                rows.append((number, 0, int(counts[at:to].sum()), None, None))
                packed = pack_sorted(keys[at:to]), pack(counts[at:to].astype(np.uint64))
                rows.append((number, 1, None, *map(packer.compress, packed)))
            if len(rows) >= 128:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, size = [], 0
        for _, _, _, ngrams in _parted(batches, longest):
            for _, _, found in ngrams:
                prints.append(found >> np.uint64(16))
                size += len(found)
            if size >= most:
                yield from cells(prints)
                prints, size = [], 0
        if size:
            yield from cells(prints)

    return run


class Summary:
    """A Misra-Gries summary: counts are too low by `lost` at most, which stays below the threshold."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in counted entries, those of another summary of this capacity too (its `lost` is to be added)."""
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        keys, both = keys[order], np.concatenate([self.counts, counts])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        keys, both = keys[first], np.add.reduceat(both, first) if len(first) else both
        if len(keys) > self.capacity:
            beyond = int(np.partition(both, len(keys) - self.capacity - 1)[len(keys) - self.capacity - 1])
            self.lost += beyond
            both -= beyond
            keys, both = keys[both > 0], both[both > 0]
        self.keys, self.counts = keys, both

    def frequent(self, threshold: int) -> np.ndarray:
        """Every entry that may have `threshold` occurrences."""
        return self.keys[self.counts + self.lost >= threshold]


def _survivors(threshold: int, most: int):
    """What survives in each partition; its rows come with the masses first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, mass, summary, keys, counts, size = None, 0, None, [], [], 0
        unpacker = zstandard.ZstdDecompressor()

        def taken() -> None:
            nonlocal summary, keys, counts, size
            summary = summary or Summary(mass // threshold + 1)
            if keys:
                summary.merge(np.concatenate(keys), np.concatenate(counts))
            keys, counts, size = [], [], 0

        def ended() -> pa.RecordBatch:
            taken()
            found = summary.frequent(threshold)
            columns = [pa.array([current], pa.int32()), pa.array([len(found)], pa.int64()), pa.array([pack_sorted(found)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["range", "n", "prints"])

        for batch in batches:
            for number, kind, own, prints, times in zip(*(batch.column(c) for c in ("range", "kind", "mass", "prints", "counts"))):
                if number.as_py() != current:
                    if current is not None:
                        yield ended()
                    current, mass, summary = number.as_py(), 0, None
                if kind.as_py() == 0:
                    mass += own.as_py()
                    continue
                keys.append(unpack_sorted(unpacker.decompress(prints.as_buffer())))
                counts.append(unpack(unpacker.decompress(times.as_buffer())).astype(np.int64))
                size += len(keys[-1])
                if size >= most:
                    taken()
        if current is not None:
            yield ended()

    return run


def _slices(bits: int):
    """The part of the bitmap that a partition's survivors fill, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            for prints in batch.column("prints"):
                at = unpack_sorted(prints.as_buffer()) >> np.uint64(48 - bits)
                if len(at):
                    first = int(at[0]) // 8
                    part = np.zeros(int(at[-1]) // 8 - first + 1, dtype=np.uint8)
                    _fill(part, at - np.uint64(8 * first))
                    rows.append((first, packer.compress(part.tobytes())))
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["first", "bits"])

    return run


def _fill(part: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(part, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))


def _bitmap(survivors: DataFrame, max_bits: int) -> tuple[int, np.ndarray]:
    """A bit for each stretch of fingerprints that holds a survivor: 2 ** (max_bits - 3) bytes at most."""
    n = survivors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max_bits, max(10, int(32 * n).bit_length()))
    whole, unpacker = np.zeros(1 << (bits - 3), dtype=np.uint8), zstandard.ZstdDecompressor()
    # The slices of two partitions share a byte at most: together they are as large as the bitmap.
    for row in survivors.select("prints").mapInArrow(_slices(bits), "first long, bits binary").collect():
        part = np.frombuffer(unpacker.decompress(bytes(row["bits"])), dtype=np.uint8)
        whole[row["first"] : row["first"] + len(part)] |= part
    return bits, whole


def _phrases(words: Words, at: np.ndarray, size: np.ndarray) -> pa.Array:
    """The words of each n-gram, joined by one space."""
    lengths = words.ends - words.starts
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    spaced = np.full(begin[-1], 0x20, dtype=np.uint8)
    old = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    spaced[old + np.repeat(begin[:-1], lengths)] = words.data[old + np.repeat(words.starts, lengths)]
    long = begin[at + size] - 1 - begin[at]
    offsets = np.concatenate([[0], np.cumsum(long)])
    from_ = np.arange(offsets[-1]) + np.repeat(begin[at] - offsets[:-1], long)
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(spaced[from_])]
    return pa.Array.from_buffers(pa.large_string(), len(at), buffers)


def _counted(bits: int, bitmap, held_rows: int, longest: int):
    """lang, size, phrase, f of the n-grams that the bitmap lets through; size 0 counts all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = bitmap.value
        held, size_held, spoken = [], 0, {}
        names = ["lang", "size", "phrase", "f"]

        def summed() -> pa.Table:
            table = pa.concat_tables(held).group_by(names[:3]).aggregate([("f", "sum")])
            return table.rename_columns(names)

        def sent(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for batch in table.to_batches(max_chunksize=1 << 16):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2).cast(pa.string()), batch.column(3)], names=names)

        for words, langs, codes, ngrams in _parted(batches, longest):
            for lang, n in zip(langs, np.bincount(codes, words.counts, len(langs)).tolist()):
                spoken[lang] = spoken.get(lang, 0) + int(n)
            lang_of = np.repeat(codes, words.counts)
            for size, at, prints in ngrams:
                bit = prints >> np.uint64(64 - bits)
                kept = allowed[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1
                at, prints = at[kept.view(bool)], prints[kept.view(bool)]
                _, first, n = np.unique(prints, return_index=True, return_counts=True)
                at = at[first]
                columns = [
                    pa.array(langs, pa.string()).take(pa.array(lang_of[at])),
                    pa.array(np.full(len(at), size, np.int32)),
                    _phrases(words, at, np.full(len(at), size)),
                    pa.array(n.astype(np.int64)),
                ]
                held.append(pa.table(columns, names=names))
                size_held += len(at)
            if size_held >= held_rows:
                held = [summed()]
                size_held = held[0].num_rows
                if size_held >= held_rows // 2:
                    yield from sent(held[0])
                    held, size_held = [], 0
        if held:
            yield from sent(summed())
        if spoken:
            columns = [pa.array(list(spoken), pa.string()), pa.array(np.zeros(len(spoken), np.int32)), pa.array([""] * len(spoken)), pa.array(list(spoken.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def frequent_ngrams(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, max_bits: int = MAX_BITS, folder: str | None = None
) -> DataFrame:
    """lang, size, phrase, f: the n-grams of `longest` words at most with `threshold` occurrences in their language.

    A row of size 0 and an empty phrase holds the number of words of each language.
    """
    spark, folder = docs.sparkSession, folder or workspace(docs.sparkSession)
    ranges = shuffle_partitions(spark)
    docs = docs.select("text", "lang")
    cells = docs.mapInArrow(_summaries(ranges, HELD, longest), _CELLS).repartitionById(ranges, F.col("range"))
    survivors = cells.sortWithinPartitions("range", "kind").mapInArrow(_survivors(threshold, HELD_ENTRIES), "range int, n long, prints binary")
    survivors = settle(survivors, folder, "survivors")
    bits, bitmap = _bitmap(survivors, max_bits)
    shared = spark.sparkContext.broadcast(bitmap)
    counted = docs.mapInArrow(_counted(bits, shared, HELD_ROWS, longest), "lang string, size int, phrase string, f long")
    counted = counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return settle(counted.where((F.col("f") >= threshold) | (F.col("size") == 0)), folder, "frequent")


def _joined(words: str, start: str, size: str) -> str:
    return f"array_join(slice({words}, {start}, {size}), ' ')"


def collocations(docs: DataFrame, threshold: int = THRESHOLD, ranks: int = RANKS, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the `ranks` strongest phrases of each language.

    Words are what lies between blanks and tabs, A-Z as a-z, in pieces of text
    between `.,;:!?` and line ends. A phrase is in the list with at least
    `threshold` occurrences (a), unless a longer one has `covered_percent` of
    them. Cut in two, its parts have l and r occurrences and it scores
    floor(2000000 a / (l + r)); the lowest cut counts, the first of equal ones.
    n is the number of words of the language. Ties go to more occurrences, then
    to the smaller phrase in byte order. Null texts count as empty, null
    languages as `und`; repeated rows count each time. Columns other than text
    and lang are not looked at.
    """
    spark, folder = docs.sparkSession, workspace(docs.sparkSession)
    known = frequent_ngrams(docs, threshold, folder=folder)
    phrases = known.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    ngrams = known.where("size > 0").select("lang", "phrase", "f")

    # All parts of a frequent phrase are frequent, so each is found.
    cuts = phrases.select("lang", "phrase", "a", "w", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr(_joined("w", "1", "k")).alias("left"), F.expr(_joined("w", "k + 1", "size - k")).alias("right"))
    part = lambda name, f: ngrams.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    big = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"(2000000BD * {big('a')}) div ({big('l')} + {big('r')})")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = phrases.where("size > 2").select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("part"))
    inner = inner.select("lang", "a", "w", "part", F.explode(F.expr("sequence(1, size - part + 1)")).alias("at"))
    inner = inner.groupBy("lang", F.expr(_joined("w", "at", "part")).alias("phrase")).agg(F.max("a").alias("longer"))
    scored = lowest.join(inner, ["lang", "phrase"], "left")
    covered = F.expr(f"100BD * {big('longer')} >= {int(covered_percent)}BD * {big('a')}")
    scored = scored.where(F.col("longer").isNull() | ~covered).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # The best of each of many parts first, so that no task sorts a whole language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(spark)))
    few = scored.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = few.where(F.col("rank") <= ranks).drop("salt", "rank")
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= ranks)
    spoken = known.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(spoken, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
