"""Exact join of texts whose sets of word shingles have a Jaccard similarity of at least 3/4.

Equal sets form a class, and one member stands for it. The join of these works
by set relations:

1. Highly similar sets first. Sets that agree in a pair of min-hashes are held
   against one leader per agreement, exactly. What a leader is linked with need
   not be found again for a set linked with the leader: the set takes over the
   leader's answers, and with them its component.
2. The rest by prefix index. With all shingles in one global order, rare ones
   first, two linked sets share one of their first floor(n / 4) + 1 shingles.
   Lists of a single set are dropped, which tells how many of a set's first
   shingles another set can share at all. The other lists are sorted by set size
   and cut in blocks; two blocks are skipped when sizes, shingles left behind
   the position, or shareable shingles can't reach the overlap. Lists within one
   component are skipped as a whole, and so are two blocks within one.
3. The pairs that remain are compared by blocks of alike sets: a set's text
   travels once to each block that has candidates for it.

Shingles are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmbook.llm.components import components
from firmbook.llm.shared import home, pack, settle, shuffle_partitions, unpack, workspace
from firmbook.llm.words import mix, slices, split

SHINGLE = 5
BANDS = 4
#: Shingles that are put last in the global order, the most frequent ones; the order changes no result.
FREQUENT = 1 << 18
#: Bits of a set's fingerprint that tell equal sets from others in an index list.
TAG = np.uint64((1 << 48) - 1)
#: Sets that are compared with one copy of their leader.
MEMBERS = 64
#: Alike sets of a block.
GROUP = 256
#: Sets that one task compares with a block.
GUESTS = 1024
#: Shingles, and index entries, that a task gathers before it counts or packs them.
BLOCK = 1 << 20
POSTINGS = 1 << 18
#: Compressed texts that a task takes apart at once.
PACKED_BYTES = 1 << 18
#: Counts from here on are the same in a rank.
MANY = (1 << 24) - 1
#: Sets that a task remembers as posted.
POSTED = 1 << 18
#: Entries of an index list in a block that is skipped as one.
SKIP = 128

_DIGEST = "kind int, doc_id long, n long, hi long, lo long, bands array<long>"
_CELLS = "range int, kind int, columns array<binary>"


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of each text, ascending, and the first one of each text."""
    prints, first = split(texts, lower=True).windows(size, short=True)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((prints, owner))
    prints, owner = prints[order], owner[order]
    fresh = np.ones(len(prints), bool)
    fresh[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
    prints, owner = prints[fresh], owner[fresh]
    return prints, np.searchsorted(owner, np.arange(len(first)))


def _digests(size: int) -> Callable:
    """A row per text: set size, 128-bit fingerprint of the set, min-hash bands; and shingles that repeat in a task."""
    seeds = mix(np.arange(1, 2 * BANDS + 3, dtype=np.uint64))

    def of_texts(part: pa.RecordBatch, prints: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(first)
        some = np.flatnonzero(sizes)
        at = first[some]

        def spread(reduce: np.ufunc, values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(sizes), np.uint64)
            if len(some):
                out[some] = reduce.reduceat(values, at)
            return out

        lows = [spread(np.minimum, mix(prints ^ seed)) for seed in seeds[: 2 * BANDS]]
        bands = [mix(lows[2 * b] * np.uint64(3) + mix(lows[2 * b + 1] + np.uint64(b))) for b in range(BANDS)]
        sums = [spread(np.add, mix(prints + seed)) for seed in seeds[2 * BANDS :]]
        flat = np.stack(bands, axis=1).view(np.int64).ravel()
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), pa.array(flat))
        columns = [pa.array(np.zeros(len(sizes), np.int32)), part.column("doc_id"), pa.array(sizes.astype(np.int64))]
        columns += [pa.array(x.view(np.int64)) for x in sums]
        return pa.RecordBatch.from_arrays([*columns, bands], names=["kind", "doc_id", "n", "hi", "lo", "bands"])

    def of_shingles(held: list) -> pa.RecordBatch:
        prints, counts = np.unique(np.concatenate(held), return_counts=True)
        prints, counts = prints[counts > 1], counts[counts > 1]
        n = len(prints)
        columns = [pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.array(counts.astype(np.int64))]
        columns += [pa.array(prints.view(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "doc_id", "n", "hi", "lo", "bands"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held = [], 0
        for part in slices(batches):
            prints, first = shingle_sets(part.column("text"), size)
            yield of_texts(part, prints, first)
            held.append(prints)
            size_held += len(prints)
            if size_held >= BLOCK:
                yield of_shingles(held)
                held, size_held = [], 0
        if held:
            yield of_shingles(held)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=1)
    for part in slices(batches):
        texts = [packer.compress((t or "").encode()) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "packed"])


def _compare(size: int) -> Callable:
    """Rows of a group: its leader's text first, then the members'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, group, leader = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            rows, at = batch.to_pylist(), 0
            while at < len(rows):
                to, held = at, 0
                while to < len(rows) and held < PACKED_BYTES:
                    held += len(rows[to]["packed"])
                    to += 1
                texts = [unpacker.decompress(r["packed"]) for r in rows[at:to]]
                prints, first = shingle_sets(pa.array(texts, pa.large_binary()).cast(pa.large_string()), size)
                out = []
                for row, a, b in zip(rows[at:to], first[:-1], first[1:]):
                    own = prints[a:b]
                    if row["leads"]:
                        group, leader = (row["lead"], row["part"]), own
                    elif group == (row["lead"], row["part"]) and len(leader):
                        near = np.minimum(np.searchsorted(leader, own), len(leader) - 1)
                        common = int((leader[near] == own).sum())
                        out.append((row["doc_id"], row["lead"], len(own), len(leader), common))
                at = to
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["a", "b", "na", "nb", "common"]
                )

    return run


def overlaps(texts: DataFrame, pairs: DataFrame, size: int, folder: str, name: str) -> DataFrame:
    """a, b, na, nb, common: set sizes and overlap of each pair (a, b), b's many partners spread over tasks."""
    pairs = settle(pairs, folder, f"{name}-pairs")
    parts = F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int")
    groups = settle(pairs.groupBy("b").agg(parts.alias("parts")), folder, f"{name}-groups")
    members = pairs.join(groups, "b").select(
        F.col("a").alias("doc_id"), F.col("b").alias("lead"),
        F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("leads"),
    )
    leaders = groups.select(
        F.col("b").alias("doc_id"), F.col("b").alias("lead"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("leads"),
    )
    wanted = settle(members.unionByName(leaders), folder, f"{name}-wanted")
    packed = texts.mapInArrow(_packed, "doc_id long, packed binary")
    compared = (
        packed.join(wanted, "doc_id")
        .repartition(shuffle_partitions(texts.sparkSession), "lead", "part")
        .sortWithinPartitions("lead", "part", F.col("leads").desc())
        .mapInArrow(_compare(size), "a long, b long, na long, nb long, common long")
    )
    return settle(compared, folder, f"{name}-overlaps")


def _range_of(prints: np.ndarray, ranges: int) -> np.ndarray:
    return ((prints >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _send(kind: int, keys: np.ndarray, columns: list[np.ndarray], ranges: int) -> Iterator[pa.RecordBatch]:
    """The entries in one packed cell per range."""
    if (keys[1:] < keys[:-1]).any():
        order = np.argsort(keys, kind="stable")
        keys, columns = keys[order], [c[order] for c in columns]
    bounds = np.searchsorted(keys, np.arange(ranges + 1))
    for start in range(0, ranges, 64):
        own = [n for n in range(start, min(ranges, start + 64)) if bounds[n] < bounds[n + 1]]
        cells = [[pack(c[bounds[n] : bounds[n + 1]].view(np.uint64)) for c in columns] for n in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array([kind] * len(own), pa.int32()), pa.array(cells, pa.list_(pa.binary()))],
            names=["range", "kind", "columns"],
        )


def _receive(batches: Iterator[pa.RecordBatch], kinds: dict[int, int]) -> dict[int, list[np.ndarray]]:
    """Columns by kind; kinds: number of columns of each."""
    got = {kind: [[np.zeros(0, np.uint64)] for _ in range(width)] for kind, width in kinds.items()}
    for batch in batches:
        for kind, cells in zip(batch.column("kind").to_pylist(), batch.column("columns")):
            for held, cell in zip(got[kind], cells.values):
                held.append(unpack(cell.as_buffer()))
    return {kind: [np.concatenate(c) for c in columns] for kind, columns in got.items()}


def _postings(size: int, frequent: np.ndarray, counts: np.ndarray, ranges: int) -> Callable:
    """Prefix shingles of every set: shingle, doc_id, tag of the set, shingles left behind it in the order.

    And to the texts' homes: doc_id and a rank of the last prefix shingle in the order.
    Of equal sets a task posts one, and again only for a smaller id, so the
    smallest id of all, which stands for the set, is always posted.
    """

    def fresh(posted: dict, keys: list[tuple], ids: list[int]) -> list[bool]:
        lowest: dict[tuple, int] = {}
        for key, own in zip(keys, ids):
            lowest[key] = min(own, lowest.get(key, own))
        out = [own == lowest[key] and (key not in posted or own < posted[key]) for key, own in zip(keys, ids)]
        if len(posted) + len(lowest) > POSTED:
            posted.clear()
        posted.update((key, min(own, posted.get(key, own))) for key, own in lowest.items())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lasts, size_held, posted = [], [], 0, {}
        for part in slices(batches):
            prints, first = shingle_sets(part.column("text"), size)
            sizes = np.diff(first)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            some = np.flatnonzero(sizes)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            tags, kept = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), bool)
            if len(some):
                tags[some] = np.add.reduceat(mix(prints + np.uint64(1)), first[some])
                keys = zip(*(x.tolist() for x in (tags[some], prints[first[some]], prints[first[some + 1] - 1])))
                kept[some] = fresh(posted, list(keys), ids[some].tolist())
                tags &= TAG
            some = np.flatnonzero(kept)
            weight = np.zeros(len(prints), np.int64)
            if len(frequent) and len(prints):
                near = np.minimum(np.searchsorted(frequent, prints), len(frequent) - 1)
                weight = np.where(frequent[near] == prints, counts[near], 0)
            if weight.any():
                order = np.lexsort((weight, owner))  # stable: by weight, then fingerprint
                prints, weight = prints[order], weight[order]
            place = np.arange(len(prints)) - np.repeat(first[:-1], sizes)
            chosen = (place <= np.repeat(sizes // 4, sizes)) & kept[owner]
            left = np.repeat(sizes, sizes) - place - 1
            held.append([x[chosen] for x in (prints, ids[owner], tags[owner], left)])
            end = first[some] + sizes[some] // 4
            rank = np.minimum(weight[end], MANY).astype(np.uint64) << np.uint64(40)
            lasts.append([ids[some], rank | (prints[end] >> np.uint64(24))])
            size_held += int(chosen.sum())
            if size_held >= POSTINGS:
                yield from _block(held, lasts, ranges)
                held, lasts, size_held = [], [], 0
        if held:
            yield from _block(held, lasts, ranges)

    return run


def _block(held: list, lasts: list, ranges: int) -> Iterator[pa.RecordBatch]:
    """Entries sorted by shingle; steps of the sorted shingles pack better than themselves."""
    columns = [np.concatenate(c) for c in zip(*held)]
    held.clear()
    order = np.argsort(columns[0], kind="stable")
    for n, column in enumerate(columns):
        columns[n] = column[order]
    keys = _range_of(columns[0], ranges)
    fresh = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    steps = np.diff(columns[0], prepend=np.uint64(0))
    steps[fresh] = columns[0][fresh]
    yield from _send(0, keys, [steps, *columns[1:]], ranges)
    columns = [np.concatenate(c) for c in zip(*lasts)]
    yield from _send(2, home(columns[0], ranges), columns, ranges)


def _shared_lists(ranges: int) -> Callable:
    """Entries of shingles that several sets post, sent to their texts' homes; the rest passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            entries = batch.column("kind").to_numpy() == 0
            yield batch.filter(pa.array(~entries))
            for cells in batch.column("columns").filter(pa.array(entries)):
                steps, *others = [unpack(c.as_buffer()) for c in cells.values]
                held.append([np.cumsum(steps, dtype=np.uint64), *others])
        if not held:
            return
        columns = [np.concatenate(c) for c in zip(*held)]
        del held
        order = np.argsort(columns[0], kind="stable")
        prints, ids, tags, left = (c[order] for c in columns)
        cuts = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
        several = np.minimum.reduceat(tags, cuts) != np.maximum.reduceat(tags, cuts)
        chosen = np.repeat(several, np.diff(np.append(cuts, len(prints))))
        ids = ids[chosen]
        yield from _send(0, home(ids, ranges), [prints[chosen], ids, left[chosen]], ranges)

    return run


_KNOWN = ("rep", "component", "n", "block")


def _known_cells(ranges: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy().view(np.uint64) for c in _KNOWN]
            yield from _send(1, home(columns[0], ranges), columns, ranges)

    return run


def _with_components(ranges: int) -> Callable:
    """Entries of representatives with component, size, reach, rank and block, sent back to their shingles' ranges.

    reach: the most shingles that a set whose prefix ends no earlier can share with this one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _receive(batches, {0: 3, 1: 4, 2: 2})
        (prints, ids, left), known, (owners, ranks) = got[0], got[1], got[2]
        if not len(prints) or not len(known[0]):
            return
        order = np.argsort(known[0])
        reps, component, n, block = (c[order] for c in known)
        order = np.argsort(owners, kind="stable")
        rank = ranks[order][np.searchsorted(owners[order], reps)]
        near = np.minimum(np.searchsorted(reps, ids), len(reps) - 1)
        own = reps[near] == ids
        near, prints = near[own], prints[own]
        shared = np.bincount(near, minlength=len(reps)).astype(np.uint64)
        reach = shared + n - n // np.uint64(4) - np.uint64(1)
        columns = [prints, *[c[near] for c in (reps, component, n, reach, rank, block)], left[own]]
        yield from _send(0, _range_of(prints, ranges), columns, ranges)

    return run


@dataclass
class Entries:
    """Entries of one index list, or of several."""

    rep: np.ndarray
    component: np.ndarray
    n: np.ndarray
    reach: np.ndarray
    rank: np.ndarray
    block: np.ndarray
    left: np.ndarray

    def at(self, rows) -> Entries:
        return Entries(*[getattr(self, f.name)[rows] for f in fields(self)])

    def pairs(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Pairs of a list that can be linked, block by block: sets and their blocks.

        A component with enough entries to fill a block has blocks of its own;
        the entries of the others are blocked together. Blocks are of alike size.
        """
        _, which, many = np.unique(self.component, return_inverse=True, return_counts=True)
        alone = np.where(many[which] >= SKIP, which + 1, 0)
        order = np.lexsort((self.n, alone))
        whole, alone = self.at(order), alone[order]
        begun = np.searchsorted(alone, alone)
        starts = np.flatnonzero((np.arange(len(alone)) - begun) % SKIP == 0)
        ends, alone = np.append(starts[1:], len(alone)), alone[starts]
        least = np.minimum.reduceat(whole.n, starts)
        most, left, reach = (np.maximum.reduceat(x, starts) for x in (whole.n, whole.left, whole.reach))
        for a in range(len(starts)):
            alike = (3 * least[a:] <= 4 * most[a]) & (3 * least[a] <= 4 * most[a:])
            bound = np.minimum(1 + np.minimum(left[a], left[a:]), np.maximum(reach[a], reach[a:]))
            apart = (alone[a:] != alone[a]) | (alone[a:] == 0)
            for b in (a + np.flatnonzero(alike & apart & (7 * bound >= 3 * (least[a] + least[a:])))).tolist():
                one, two = whole.at(slice(starts[a], ends[a])), whole.at(slice(starts[b], ends[b]))
                good = possible(one.at((slice(None), None)), two.at((None, slice(None))))
                i_good, j_good = np.nonzero(np.triu(good, 1) if a == b else good)
                if len(i_good):
                    yield one.rep[i_good], two.rep[j_good], one.block[i_good], two.block[j_good]


def possible(a: Entries, b: Entries) -> np.ndarray:
    """Whether two sets can be linked that are not known to be connected."""
    # The set whose prefix ends first bounds the overlap; on a tie of ranks, or of counts too large for them, either may.
    most = np.where(a.rank < b.rank, a.reach, b.reach)
    many = np.uint64(MANY << 40)
    most = np.where((a.rank == b.rank) | (np.minimum(a.rank, b.rank) >= many), np.maximum(a.reach, b.reach), most)
    good = 7 * np.minimum(most, 1 + np.minimum(a.left, b.left)) >= 3 * (a.n + b.n)
    return good & (3 * b.n <= 4 * a.n) & (3 * a.n <= 4 * b.n) & (a.component != b.component)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sets of different components that share a prefix shingle and can be linked, by host block."""
    columns = _receive(batches, {0: 8})[0]
    order = np.argsort(columns[0], kind="stable")
    prints, rep, component, n, reach, rank, block, left = (c[order] for c in columns)
    if not len(prints):
        return
    n, reach, left = (x.astype(np.int64) for x in (n, reach, left))
    whole = Entries(rep, component, n, reach, rank, block, left)
    cuts = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    mixed = np.minimum.reduceat(component, cuts) != np.maximum.reduceat(component, cuts)
    ends = np.append(cuts[1:], len(prints))
    cuts, ends = cuts[mixed], ends[mixed]
    two = cuts[ends - cuts == 2]  # lists of two, all at once
    good = two[possible(whole.at(two), whole.at(two + 1))]
    held, size = [(rep[good], rep[good + 1], block[good], block[good + 1])], len(good)
    for at, to in zip(cuts[ends - cuts > 2], ends[ends - cuts > 2]):
        for pair in whole.at(slice(at, to)).pairs():
            held.append(pair)
            size += len(pair[0])
            if size > 1 << 18:
                yield _pairs(held)
                held, size = [], 0
    if held:
        yield _pairs(held)


def _pairs(held: list) -> pa.RecordBatch:
    """Distinct pairs as (member, guest), one row for each host block and block of guests.

    The host is the block with the higher number, so of the larger class of alike sets.
    """
    a, b, block_a, block_b = (np.concatenate(x).view(np.int64) for x in zip(*held))
    swap = (block_a < block_b) | ((block_a == block_b) & (a > b))
    host, other = np.maximum(block_a, block_b), np.minimum(block_a, block_b)
    member, guest = np.where(swap, b, a), np.where(swap, a, b)
    order = np.lexsort((member, guest, other, host))
    table = np.stack([host, other, member, guest])[:, order]
    if table.shape[1]:
        table = table[:, np.append(True, (np.diff(table) != 0).any(axis=0))]
    cuts = np.flatnonzero(np.append(True, (np.diff(table[:2]) != 0).any(axis=0))[: table.shape[1]])
    ends = np.append(cuts[1:], table.shape[1])
    cells = [[table[side, at:to].tobytes() for at, to in zip(cuts, ends)] for side in (2, 3)]
    return pa.RecordBatch.from_arrays(
        [pa.array(table[0, cuts]), pa.array(table[1, cuts]), *[pa.array(c, pa.binary()) for c in cells]],
        names=["host", "other", "member", "guest"],
    )


_MET = "host long, kind int, doc_id long, partners binary"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host and other block: a row for each member of a host in a pair, and for each guest with its partners."""

    def done(host: int, parts: list, members: set) -> pa.RecordBatch:
        pairs = np.concatenate([np.stack([np.frombuffer(x, np.int64) for x in part]) for part in parts], axis=1)
        pairs = np.unique(pairs[::-1], axis=1)  # by guest, then member
        fresh = sorted(set(pairs[1].tolist()) - members)
        members.update(fresh)
        cuts = np.flatnonzero(np.append(True, pairs[0, 1:] != pairs[0, :-1]))
        partners = [pairs[1, at:to].tobytes() for at, to in zip(cuts, np.append(cuts[1:], pairs.shape[1]))]
        n = len(fresh) + len(cuts)
        columns = [[host] * n, [0] * len(fresh) + [1] * len(cuts), fresh + pairs[0, cuts].tolist(), [None] * len(fresh) + partners]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "kind", "doc_id", "partners"]
        )

    key, parts, members = (None, None), [], set()
    for batch in batches:
        for row in batch.to_pylist():
            own = row["host"], row["other"]
            if own != key and parts:
                yield done(key[0], parts, members)
                parts = []
            if own[0] != key[0]:
                members = set()
            key = own
            parts.append((row["member"], row["guest"]))
    if parts:
        yield done(key[0], parts, members)


def _compare_blocks(size: int) -> Callable:
    """Guests against their partners in a host block; the linked pairs.

    Rows are sorted: a host's members come before its guests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()

        def sets_of(rows: list) -> list[tuple]:
            texts = [unpacker.decompress(r["packed"]) for r in rows]
            prints, first = shingle_sets(pa.array(texts, pa.large_binary()).cast(pa.large_string()), size)
            return [(r["doc_id"], prints[i:j].copy()) for r, i, j in zip(rows, first[:-1], first[1:])]

        def compared(guests: list, members: dict) -> pa.RecordBatch:
            out = []
            for row, (b, own) in zip(guests, sets_of(guests)):
                for a in np.frombuffer(row["partners"], np.int64).tolist():
                    small, large = sorted((own, members[a]), key=len)
                    near = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    if 7 * int((large[near] == small).sum()) >= 3 * (len(small) + len(large)):
                        out.append((a, b))
            columns = list(zip(*out)) if out else [[]] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        key, members = None, {}
        for batch in batches:
            rows, at = batch.to_pylist(), 0
            while at < len(rows):
                own, kind = (rows[at]["host"], rows[at]["part"]), rows[at]["kind"]
                to, held = at, 0
                while to < len(rows) and held < PACKED_BYTES and (rows[to]["host"], rows[to]["part"], rows[to]["kind"]) == (*own, kind):
                    held += len(rows[to]["packed"])
                    to += 1
                if own != key:
                    key, members = own, {}
                if kind == 0:
                    members |= dict(sets_of(rows[at:to]))
                else:
                    yield compared(rows[at:to], members)
                at = to

    return run


def block_links(texts: DataFrame, pairs: DataFrame, size: int, folder: str) -> DataFrame:
    """a, b of the candidate pairs that are linked.

    A set's text travels once for each block of the sets that it is compared with, not for each pair.
    """
    partitions = shuffle_partitions(texts.sparkSession)
    met = pairs.repartition(partitions, "host").sortWithinPartitions("host", "other").mapInArrow(_met, _MET)
    met = settle(met, folder, "met")
    # The guests of a block are dealt to as many tasks as keep a task's share bounded; each gets the block.
    parts = F.ceil(F.count("*") / F.lit(GUESTS)).cast("int")
    hosts = settle(met.where("kind = 1").groupBy("host").agg(parts.alias("parts")), folder, "hosts")
    dealt = met.join(hosts, "host").select(
        "host", "kind", "doc_id", "partners",
        F.explode(
            F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.col("parts") - 1))
            .otherwise(F.array(F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")))
        ).alias("part"),
    )
    packed = texts.mapInArrow(_packed, "doc_id long, packed binary")
    compared = (
        packed.join(dealt, "doc_id")
        .repartition(partitions, "host", "part")
        .sortWithinPartitions("host", "part", "kind")
        .mapInArrow(_compare_blocks(size), "a long, b long")
    )
    return settle(compared, folder, "met-links")


LINKED = "7 * common >= 3 * (na + nb)"


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, representative of every row.

    component_id is the smallest doc_id reachable by links, representative the
    smallest doc_id with the same set. Null and empty texts have no shingles and
    link with nothing: both are then the own doc_id. A row without an id takes
    no part, both are null. Ids are taken to be unique; equal rows give equal
    results. Columns other than doc_id and text are not looked at.
    """
    spark = docs.sparkSession
    folder, ranges = workspace(spark), shuffle_partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = texts.where(F.col("doc_id").isNotNull())
    digests = settle(texts.mapInArrow(_digests(size), _DIGEST), folder, "digests")
    sets = digests.where("kind = 0")
    full = sets.where("n > 0 and doc_id is not null")
    reps = full.groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    reps = settle(reps, folder, "reps")

    keys = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    leaders = keys.groupBy("band", "key").agg(F.min("rep").alias("lead"), F.count("*").alias("sets"))
    leaders = settle(leaders.where("sets > 1"), folder, "leaders")
    similar = settle(keys.join(leaders, ["band", "key"]), folder, "similar")
    asked = similar.where("rep <> lead").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct()
    led = overlaps(known, asked, size, folder, "led").where(LINKED).distinct()
    # A leader is smaller than its followers: two jumps along the smallest leaders
    # tie most of a component together. What they miss is only compared once more.
    up = led.groupBy("a").agg(F.min("b").alias("up"))
    for turn in range(2):
        up = settle(up, folder, f"up-{turn}")
        further = up.select(F.col("a").alias("up"), F.col("up").alias("further"))
        up = up.join(further, "up", "left").select("a", F.coalesce("further", "up").alias("up"))
    # A set's block is a bounded part of its largest min-hash group; higher numbers for larger groups.
    largest = similar.groupBy("rep").agg(F.max(F.struct("sets", "band", "key")).alias("of"))
    share = F.pmod(F.xxhash64("rep"), F.ceil(F.col("of.sets") / F.lit(GROUP)))
    rank = F.coalesce(F.log2("of.sets").cast("long"), F.lit(0).cast("long"))
    mark = F.when(F.col("of").isNull(), F.xxhash64("rep")).otherwise(F.xxhash64("of.band", "of.key", share))
    number = F.shiftleft(rank, 56).bitwiseOR(F.shiftrightunsigned(mark, 8))
    blocks = reps.select("rep").join(largest, "rep", "left").select("rep", number.alias("block"))
    placed = reps.select("rep", "n").join(up.withColumnRenamed("a", "rep"), "rep", "left").join(blocks, "rep")
    placed = settle(placed.select("rep", F.coalesce("up", "rep").alias("component"), "n", "block"), folder, "placed")

    often = digests.where("kind = 1").groupBy("hi").agg(F.sum("n").alias("n"))
    often = settle(often, folder, "often")
    levels = often.groupBy("n").agg(F.count("*").alias("shingles")).orderBy(F.col("n").desc()).limit(FREQUENT).collect()
    least, total = 1 << 62, 0
    for row in levels:
        total += row["shingles"]
        if total > FREQUENT:
            break
        least = row["n"]
    # Bounded by FREQUENT, so it may pass through the driver.
    often = often.where(F.col("n") >= least).toArrow()
    frequent = often.column("hi").to_numpy().view(np.uint64)
    order = np.argsort(frequent)
    frequent, counts = frequent[order], often.column("n").to_numpy()[order]

    homes = (
        known.mapInArrow(_postings(size, frequent, counts, ranges), _CELLS)
        .repartitionById(ranges, F.col("range"))
        .mapInArrow(_shared_lists(ranges), _CELLS)
        .unionByName(placed.select(*_KNOWN).mapInArrow(_known_cells(ranges), _CELLS))
        .repartitionById(ranges, F.col("range"))
        .mapInArrow(_with_components(ranges), _CELLS)
        .repartitionById(ranges, F.col("range"))
    )
    candidates = homes.mapInArrow(_candidates, "host long, other long, member binary, guest binary")
    links = led.select("a", "b").unionByName(block_links(known, candidates, size, folder))
    # Only links between different first components are left to follow.
    known_as = placed.groupBy("rep").agg(F.min("component").alias("component"))
    for side in ("a", "b"):
        links = links.join(known_as.select(F.col("rep").alias(side), F.col("component").alias(f"{side}_part")), side)
    apart = links.where("a_part <> b_part").select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))
    merged = components(apart, folder).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    classes = (
        reps.drop("bands").join(known_as, "rep").join(merged, "component", "left")
        .select("n", "hi", "lo", "rep", F.coalesce("whole", "component").alias("component"))
    )
    classes = settle(classes, folder, "classes")
    alone = sets.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("representative")
    )
    together = full.join(classes, ["n", "hi", "lo"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("rep").alias("representative")
    )
    return together.unionByName(alone)


def one_of_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest id. Rows without an id stay."""
    found = near_duplicates(docs, size)
    later = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_later")).distinct()
    return docs.join(later, docs["doc_id"] == later["_later"], "left_anti")
