"""Texts that hold a test item, whole, edited or reworded in places.

Word pairs of the items are the seeds. A first scan counts the texts that have
each of them; rare ones all stay seeds, of the others the rarest of each stretch
of an item, so an item that leaked often keeps some all along. A second scan
joins texts and items on the seeds, neighbouring words of a text and such with
one word between, and aligns the pairs with enough seeds by Smith-Waterman over
words. One block of seeds, bounded in items and bytes, serves 100,000 items.

Exact mode seeks nothing: a text is aligned with an item wherever two bounds
leave the threshold in reach, the words of the item that the text has anywhere
and the best stretch of the text if each word of the item counted as a match.
Its cost grows with the number of items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmbook.llm.words import Words, mix, slices, split

MATCH, MISMATCH, GAP = 2, -1, -1
#: Least share of the highest possible score.
THRESHOLD = 0.5
#: A match also scores as much as so many words in a row, or as the whole of a shorter item.
SEED = 3
#: Items, and bytes of their texts, that are sent to all tasks at once; in exact mode fewer items.
BLOCK_ITEMS = 100_000
BLOCK_BYTES = 32 << 20
EXACT_ITEMS = 2000
#: A pair of words is rare in so many texts, or in one of so many of all texts.
RARE_TEXTS = 100
RARE_PART = 1000
#: Of so many pairs of an item in a row, the rarest that is not rare is a seed too.
STRETCH = 4
#: One in so many of an item's seeds must be in a text.
NEEDED_PART = 8
#: Bytes of aligned stretches that a task remembers.
KNOWN_BYTES = 16 << 20
#: What parts words: all of ASCII but letters and digits, and the marks at U+0080 and U+2000.
_PARTS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_MARKS = re.compile(rb"\xc2[\x80-\xbf]|\xe2[\x80\x81][\x80-\xbf]")


def normal_words(text: str | None) -> list[str]:
    """Letters and digits in lower case, without punctuation."""
    data = (text or "").lower().encode()
    if b"\xc2" in data or b"\xe2" in data:
        data = _MARKS.sub(b" ", data)
    return data.translate(_PARTS).decode().split()


class Items:
    """A block of test items: word numbers, and for each word the items that have it, how often."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [i for i, _ in rows]
        words = [normal_words(text) for _, text in rows]
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.words = [np.array([self.vocabulary[w] for w in ws], np.int64) for ws in words]
        self.lengths = np.array([len(ws) for ws in words], np.int64)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        flat = np.concatenate([*self.words, np.zeros(0, np.int64)])
        pairs, self.times = np.unique(np.stack([flat, owner]), axis=1, return_counts=True)
        self.owners = pairs[1]
        self.first = np.searchsorted(pairs[0], np.arange(len(self.vocabulary) + 1))

    def least(self, threshold: float) -> np.ndarray:
        """The score each item must reach; more than any can for one without words."""
        least = np.maximum(threshold * MATCH * self.lengths, MATCH * np.minimum(SEED, self.lengths))
        return np.where(self.lengths > 0, least, np.inf)

    def numbers(self, text: str | None) -> np.ndarray:
        words = normal_words(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))

    def able(self, words: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The items of which a text has so many words that the least score can be reached."""
        own = np.unique(words[words >= 0])
        starts, many = self.first[own], self.first[own + 1] - self.first[own]
        at = np.repeat(starts - np.cumsum(many) + many, many) + np.arange(many.sum())
        held = np.bincount(self.owners[at], self.times[at], minlength=len(self.words))
        return np.flatnonzero(MATCH * held >= least)


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and first and last + 1 word of the text."""
    place = np.arange(len(item) + 1)
    above, begun = np.zeros(len(item) + 1, np.int64), np.zeros(len(item) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(text):
        step = np.where(item == word, MATCH, MISMATCH)
        score, start = np.zeros(len(item) + 1, np.int64), np.full(len(item) + 1, i + 1)
        diagonal, start_diagonal = above[:-1] + step, np.where(above[:-1] > 0, begun[:-1], i)
        up = above[1:] + GAP
        take = diagonal >= up
        own = np.where(take, diagonal, up)
        positive = own > 0
        score[1:] = np.where(positive, own, 0)
        start[1:] = np.where(positive, np.where(take, start_diagonal, begun[1:]), i + 1)
        # A gap along the item: the best of what stands before, less its distance.
        shifted = score - GAP * place
        reach = np.maximum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == reach, place, 0))
        score, start = reach + GAP * place, start[source]
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(start[top]), i + 1)
        above, begun = score, start
    return best


def _stretches(at: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Parts of a text that can reach a score; at: places of words that the item has.

    An alignment lies whole in a part: up to each of its words, what matches
    outweighs the others, each of which costs a mismatch or a gap.
    """
    cost = -max(MISMATCH, GAP)
    level = (MATCH + cost) * np.arange(len(at)) - cost * at
    score = level - np.minimum.accumulate(level) + MATCH
    starts = np.flatnonzero(score == MATCH)
    good = np.maximum.reduceat(score, starts) >= least
    ends = np.append(starts[1:], len(at))
    return list(zip(at[starts[good]].tolist(), (at[ends[good] - 1] + 1).tolist()))


class _Aligner:
    """Alignments of stretches of texts with items; those of equal stretches are made once."""

    def __init__(self, ids: list, words: list[np.ndarray], least: np.ndarray):
        self.ids, self.words, self.least = ids, words, least
        self.known: dict[tuple, tuple] = {}
        self.size, self.out = 0, []

    def add(self, owner: int | None, words: np.ndarray, item: int, at: np.ndarray) -> None:
        """Take in a text and an item; at: places of words that the item has."""
        own, least, best = self.words[item], self.least[item], (0, 0, 0)
        for start, end in _stretches(at, least):
            part = words[start:end]
            if MATCH * int(np.isin(own, part).sum()) < least:
                continue  # no alignment can reach the threshold
            key = item, part.tobytes()
            if key not in self.known:
                if self.size > KNOWN_BYTES:
                    self.known.clear()
                    self.size = 0
                self.known[key] = align(part, own)
                self.size += len(key[1]) + 200
            score, first, last = self.known[key]
            best = max(best, (score, -(start + first), start + last))
        if best[0] >= least:
            self.out.append((owner, self.ids[item], best[0] / (MATCH * len(own)), -best[1], best[2]))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) if self.out else [[]] * 5
        self.out = []
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        names = ["doc_id", "item_id", "score", "start", "end"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _align_exact(items: Items, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = items.least(threshold)
        aligner = _Aligner(items.ids, items.words, every)
        mark = np.zeros(len(items.vocabulary) + 1, bool)  # the last one is for other words
        for batch in batches:
            for owner, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = items.numbers(text.as_py())
                for item in items.able(words, every).tolist():
                    mark[items.words[item]] = True
                    at = np.flatnonzero(mark[words])
                    mark[items.words[item]] = False
                    aligner.add(owner, words, item, at)
            yield aligner.batch()

    return run


def _normal(texts: pa.Array) -> Words:
    """The words of texts as normal_words takes them."""
    clean = []
    for text in texts.to_pylist():
        data = (text or "").lower().encode()
        if b"\xc2" in data or b"\xe2" in data:
            data = _MARKS.sub(b" ", data)
        clean.append(data.translate(_PARTS))
    return split(pa.array(clean, pa.large_binary()).cast(pa.large_string()))


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xD1342543DE82EF95) + np.uint64(1))


def _offered(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """What a text offers to seeds: its single words, its pairs and those with one word between; and whose they are."""
    hashes, doc = words.hashes(), np.repeat(np.arange(len(words.counts)), words.counts)
    prints, owners = [mix(hashes)], [doc]
    for step in (1, 2):
        same = doc[:-step] == doc[step:]
        prints.append(_pair(hashes[:-step], hashes[step:])[same])
        owners.append(doc[:-step][same])
    return np.concatenate(prints), np.concatenate(owners)


class Seeds:
    """The seeds of a block of items: sorted fingerprints, and for each the items that have it."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        words = _normal(pa.array([text for _, text in rows], pa.string()))
        hashes = words.hashes()
        self.ids = [i for i, _ in rows]
        self.words = [hashes[a:b].view(np.int64) for a, b in zip(words.first[:-1], words.first[1:])]
        self.lengths = words.counts.astype(np.int64)
        # An item of one word has that word as its seed.
        prints = [mix(w.view(np.uint64)) if len(w) == 1 else _pair(w[:-1].view(np.uint64), w[1:].view(np.uint64)) for w in self.words]
        self._set(np.concatenate([*prints, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(rows)), [len(p) for p in prints]))

    def _set(self, flat: np.ndarray, owner: np.ndarray) -> None:
        self.flat, self.owner = flat, owner
        self.prints = np.unique(flat)
        number = np.searchsorted(self.prints, flat)
        links = np.unique(np.stack([number, owner]), axis=1) if len(flat) else np.zeros((2, 0), np.int64)
        self.items = links[1]
        self.first = np.searchsorted(links[0], np.arange(len(self.prints) + 1))
        own = np.bincount(links[1], minlength=len(self.ids))
        self.needed = np.maximum(1, own // NEEDED_PART)

    def found(self, offered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the seeds among what is offered, and which seeds."""
        if not len(self.prints):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        near = np.minimum(np.searchsorted(self.prints, offered), len(self.prints) - 1)
        at = np.flatnonzero(self.prints[near] == offered)
        return at, near[at]

    def choose(self, texts: np.ndarray, total: int) -> None:
        """Keep the rare ones and, of each stretch, the rarest other; texts: how many have each of `prints`."""
        count = texts[np.searchsorted(self.prints, self.flat)]
        rare = (count > 0) & (count <= max(RARE_TEXTS, total // RARE_PART))
        place = np.arange(len(self.flat)) - np.searchsorted(self.owner, self.owner)
        stretch = self.owner * (int(self.lengths.max(initial=0)) + 1) + place // STRETCH
        other = np.flatnonzero((count > 0) & ~rare)
        order = other[np.lexsort((place[other], count[other], stretch[other]))]
        rarest = order[np.flatnonzero(np.diff(stretch[order], prepend=-1))]
        kept = rare.copy()
        kept[rarest] = True
        self._set(self.flat[kept], self.owner[kept])

    def least(self, threshold: float) -> np.ndarray:
        least = np.maximum(threshold * MATCH * self.lengths, MATCH * np.minimum(SEED, self.lengths))
        return np.where(self.lengths > 0, least, np.inf)

    def pairs(self, offered: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts and the items of which they have enough seeds."""
        at, seed = self.found(offered)
        keys = np.unique(owners[at] * np.int64(max(len(self.prints), 1)) + seed)
        doc, seed = keys // max(len(self.prints), 1), keys % max(len(self.prints), 1)
        many = self.first[seed + 1] - self.first[seed]
        links = np.repeat(self.first[seed] - np.cumsum(many) + many, many) + np.arange(many.sum())
        width = max(len(self.ids), 1)
        keys, hits = np.unique(np.repeat(doc, many) * width + self.items[links], return_counts=True)
        keys = keys[hits >= self.needed[keys % width]]
        return keys // width, keys % width


def _count_seeds(shared):
    """Texts of a task with each seed that any of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        texts = np.zeros(len(seeds.prints), np.int64)
        for part in slices(batches):
            offered, owners = _offered(_normal(part.column("text")))
            at, seed = seeds.found(offered)
            keys = np.unique(owners[at] * np.int64(max(len(texts), 1)) + seed)
            texts += np.bincount(keys % max(len(texts), 1), minlength=len(texts))[: len(texts)]
        some = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(texts[some])], names=["seed", "texts"])

    return run


def _align_seeded(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        aligner = _Aligner(seeds.ids, seeds.words, seeds.least(threshold))
        for part in slices(batches):
            words = _normal(part.column("text"))
            ids, hashes = part.column("doc_id").to_pylist(), words.hashes().view(np.int64)
            for doc, item in zip(*(x.tolist() for x in seeds.pairs(*_offered(words)))):
                own = hashes[words.first[doc] : words.first[doc + 1]]
                aligner.add(ids[doc], own, item, np.flatnonzero(np.isin(own, seeds.words[item])))
            yield aligner.batch()

    return run


_FOUND = "doc_id long, item_id long, score double, start long, end long"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    block_items: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """doc_id, item_id, score, start, end: texts and the items found in them, at their best place.

    score is the share of the highest possible alignment score; start and end
    are words (letters and digits) of the text, the first of equally good places
    and its longest match. Items without words and texts without words are never
    found; items or texts with a null id are, with a null there. A score must
    also be that of SEED words in a row, so of an item of up to SEED words the
    whole is found, in texts of any length. A repeated item is reported once for
    each row with its id, a repeated text too. Columns other than the ids and
    texts are not looked at. `exact` finds also what has too few seeds left.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    block_items = block_items or (EXACT_ITEMS if exact else BLOCK_ITEMS)
    total = items.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-total["rows"] // block_items), -(-(total["bytes"] or 0) // BLOCK_BYTES))
    found, n_texts = None, None if exact else texts.count()
    for number in range(blocks):
        # A block is bounded, so it may pass through the driver.
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        rows = sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0], r[1] or ""))
        if exact:
            block = Items(rows)
            task = _align_exact(block, threshold) if block.vocabulary else None
        else:
            task = _seeded(texts, rows, n_texts, threshold)
        if task:
            part = texts.mapInArrow(task, _FOUND)
            found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], _FOUND) if found is None else found


def _seeded(texts: DataFrame, rows: list[tuple], n_texts: int, threshold: float):
    seeds, context = Seeds(rows), texts.sparkSession.sparkContext
    if not len(seeds.prints):
        return None
    counted = texts.mapInArrow(_count_seeds(context.broadcast(seeds)), "seed long, texts long")
    # One row for each seed of the block at most.
    counted = counted.groupBy("seed").agg(F.sum("texts").alias("texts")).toArrow()
    counts = np.zeros(len(seeds.prints), np.int64)
    counts[counted.column("seed").to_numpy()] = counted.column("texts").to_numpy()
    seeds.choose(counts, n_texts)
    return _align_seeded(context.broadcast(seeds), threshold)


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the documents that hold a test item. Rows without an id stay."""
    leaked = leaks(docs, benchmark, threshold).select(F.col("doc_id").alias("_leaked")).where("_leaked is not null").distinct()
    return docs.join(leaked, docs["doc_id"] == leaked["_leaked"], "left_anti")
