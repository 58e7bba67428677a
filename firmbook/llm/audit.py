"""How far the sources of a language differ in their terms: exact divergences of all pairs of sources.

A group is a source within a language. It gives each kept term the share
p = 1 + floor(SCALE * (count + 1) / (sum of its counts + number of kept terms));
two groups differ in a term by f(p, q) = floor((p - q)^2 / q).

The sum of f over all terms is not made term by term for every pair. Were no
term there, all would have the share p0 of a count of 0: one product for a pair.
What a term adds in one group alone depends on its share there and on the p0 of
the other: a histogram of shares, one sum for each different p0. What is left is
the correction for terms that both groups have. Each term is a row of its
groups' shares, equal rows are one with a multiplicity, and rows in order are
inserted in a frequent-pattern tree, groups with the most terms first. The
correction for a node and an ancestor is made once for all terms below.

Ranges of the sorted rows go to tasks, so a tree holds a stretch of them, up to
NODES nodes at a time; what two trees share is only counted in both.

Sums in tasks are taken modulo 2**64. The result is below that: the sum of
f(p, q) is at most the greatest p, 10**9 + 1, times the sum of p, which is
10**9 plus twice the number of terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmbook.llm.shared import settle, shuffle_partitions, workspace
from firmbook.llm.words import slices, split

SCALE = 1_000_000_000
MIN_DOCS = 3
TERM_RANKS = 200
#: Rows of counts that a task gathers before it sends them, and nodes that a tree may have.
HELD_ROWS = 1 << 18
NODES = 1 << 16
#: Groups up to which their table, some hundred bytes each, goes to every executor.
BROADCAST_GROUPS = 200_000

_NO_LETTER = np.zeros(256, dtype=bool)
_NO_LETTER[: 0x41] = _NO_LETTER[0x5B : 0x61] = _NO_LETTER[0x7B : 0x80] = True


def _count(held_rows: int):
    """lang, source, term, n (occurrences) and docs (rows) of the texts of a task; a null term stands for the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held, size = [], 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])

        def sent(table: pa.Table) -> Iterator[pa.RecordBatch]:
            names = list(groups)
            langs, sources = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))
            for batch in table.to_batches(max_chunksize=1 << 16):
                at = batch.column("group")
                columns = [langs.take(at), sources.take(at), batch.column("term").cast(pa.string()), batch.column("n_sum"), batch.column("docs_sum")]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for part in slices(batches):
            pairs = zip(*(part.column(c).fill_null("").to_pylist() for c in ("lang", "source")))
            group = np.array([groups.setdefault(pair, len(groups)) for pair in pairs], dtype=np.int64)
            words = split(part.column("text"), lower=True, blank=_NO_LETTER)
            coded = words.strings().dictionary_encode()
            kinds = max(len(coded.dictionary), 1)
            doc = np.repeat(np.arange(len(part)), words.counts)
            keys, n = np.unique(doc * kinds + coded.indices.to_numpy(), return_counts=True)
            keys, where = np.unique(group[keys // kinds] * kinds + keys % kinds, return_inverse=True)
            columns = {
                "group": keys // kinds,
                "term": coded.dictionary.take(pa.array(keys % kinds)),
                "n": np.bincount(where, n, len(keys)).astype(np.int64),
                "docs": np.bincount(where, minlength=len(keys)).astype(np.int64),
            }
            held.append(pa.table(columns))
            size += len(keys)
            if size >= held_rows:
                held = [summed().rename_columns(["group", "term", "n", "docs"])]
                size = held[0].num_rows
                if size >= held_rows // 2:
                    yield from sent(summed())
                    held, size = [], 0
        if held:
            yield from sent(summed())
        if groups:
            langs, sources = zip(*groups)
            zeros = pa.array(np.zeros(len(groups), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.nulls(len(groups), pa.string()), zeros, zeros],
                names=["lang", "source", "term", "n", "docs"],
            )

    return run


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return ((p - q) * (p - q) // q).view(np.uint64)


class _Tree:
    """A frequent-pattern tree of rows that come in order; a node is a group and a term's share in it."""

    def __init__(self):
        self.parent, self.place, self.p, self.p0, self.n = [], [], [], [], []
        self.path: list[int] = []

    def insert(self, row: list[tuple[int, int, int]], n: int) -> None:
        same = 0
        while same < min(len(row), len(self.path)):
            node = self.path[same]
            if (self.place[node], self.p[node]) != row[same][:2]:
                break
            same += 1
        del self.path[same:]
        for place, p, p0 in row[same:]:
            self.parent.append(self.path[-1] if self.path else -1)
            self.place.append(place)
            self.p.append(p)
            self.p0.append(p0)
            self.n.append(0)
            self.path.append(len(self.parent) - 1)
        for node in self.path:
            self.n[node] += n

    def corrections(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of places (a, b) and, modulo 2**64, what the terms of both add to the divergence of a from b."""
        parent, place, p, p0 = (np.array(x, dtype=np.int64) for x in (self.parent, self.place, self.p, self.p0))
        n = np.array(self.n, dtype=np.uint64)
        width = int(place.max(initial=0)) + 1
        keys, values = [], []
        node = np.arange(len(parent))
        above = parent
        while True:
            # One step further up for every node that has an ancestor there.
            up = above >= 0
            node, above = node[up], above[up]
            if not len(node):
                break
            for a, b in ((above, node), (node, above)):
                both = _differ(p[a], p[b]) - _differ(p[a], p0[b]) - _differ(p0[a], p[b]) + _differ(p0[a], p0[b])
                keys.append(place[a] * width + place[b])
                values.append(both * n[node])
            if sum(map(len, keys)) > 1 << 20:
                keys, values = ([x] for x in _sums(keys, values))
            above = parent[above]
        keys, values = _sums(keys, values)
        return keys // width, keys % width, values


def _sums(keys: list, values: list) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys, values = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(values, first)


def _correct(nodes: int):
    """lang, a, b, more: corrections for pairs of places from rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, lang = _Tree(), None

        def sent() -> pa.RecordBatch:
            a, b, more = tree.corrections()
            columns = [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(more.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "more"])

        for batch in batches:
            paths = batch.column("path")
            ends = paths.offsets.to_pylist()
            flat = paths.values
            cells = list(zip(*(flat.field(c).to_pylist() for c in ("place", "p", "p0"))))
            for row, (own, n) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("n").to_pylist())):
                if own != lang or len(tree.parent) >= nodes:
                    if tree.parent:
                        yield sent()
                    tree, lang = _Tree(), own
                tree.insert(cells[ends[row] : ends[row + 1]], n)
        if tree.parent:
            yield sent()

    return run


def _share(count: str, total: str, terms: str):
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(19,0))) div cast({total} + {terms} as decimal(19,0))"
    )


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair`: each other source of the language and the divergence from it,
    all ranks. Part `term`: the terms that a source has more of than its
    language, by their part of that divergence, ranks to `term_ranks`. Kept are
    the terms of at least `min_docs` rows of a language. Null text, lang and
    source count as empty; every row is a document, repeated ones too; ties go
    to the smaller item in byte order. A language without kept terms has pairs
    of value 0, one with a single source no pairs. Columns other than text, lang
    and source are not looked at.
    """
    spark, folder = docs.sparkSession, workspace(docs.sparkSession)
    partials = docs.select("text", "lang", "source").mapInArrow(_count(HELD_ROWS), "lang string, source string, term string, n long, docs long")
    counts = partials.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = settle(counts, folder, "counts")

    found = counts.where("term is not null").groupBy("lang", "term")
    terms = found.agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("row"))
    terms = settle(terms.where(F.col("docs") >= min_docs).drop("docs"), folder, "terms")

    langs = terms.groupBy(F.col("lang").alias("same")).agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    own = terms.select(F.col("lang").alias("same"), F.explode("row").alias("e")).select("same", F.col("e.source").alias("from"), "e.n")
    own = own.groupBy("same", "from").agg(F.sum("n").alias("group_total"), F.count("*").alias("group_terms"))
    groups = counts.where("term is null").select("lang", "source")
    groups = groups.join(own, (F.col("lang") == F.col("same")) & (F.col("source") == F.col("from")), "left").drop("same", "from")
    groups = groups.join(langs, F.col("lang") == F.col("same"), "left").drop("same").fillna(0)
    most = Window.partitionBy("lang").orderBy(F.desc("group_terms"), "source")
    p0 = F.when(F.col("kept") > 0, _share("0L", "group_total", "kept"))
    groups = groups.withColumns({"place": F.row_number().over(most), "p0": p0})
    groups = settle(groups.drop("group_terms"), folder, "groups")
    near = F.broadcast if groups.count() <= BROADCAST_GROUPS else (lambda df: df)

    entries = terms.select("lang", "term", "total", F.explode("row").alias("e")).select("*", F.col("e.source").alias("source"), F.col("e.n").alias("n"))
    entries = entries.drop("e").join(near(groups), ["lang", "source"])
    entries = entries.withColumns({"p": _share("n", "group_total", "kept"), "q": _share("total", "lang_total", "kept")})

    order = [F.desc("value"), "item"]
    by_value = Window.partitionBy("lang", "source").orderBy(*order)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    more = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    listed = more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= term_ranks).select(*columns)

    pairs = _pairs(spark, entries, groups, near, folder)
    ranked = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(by_value)).select(*columns)
    return ranked.unionByName(listed)


def _pairs(spark, entries: DataFrame, groups: DataFrame, near, folder: str) -> DataFrame:
    """lang, source, item (another source), value: the divergence over all kept terms."""
    # Terms that two groups have.
    row = F.sort_array(F.collect_list(F.struct("place", "p", "p0")))
    paths = entries.groupBy("lang", "term").agg(row.alias("path")).groupBy("lang", "path").agg(F.count("*").alias("n"))
    paths = settle(paths, folder, "paths")
    ranged = paths.repartitionByRange(shuffle_partitions(spark), "lang", "path").sortWithinPartitions("lang", "path")
    shared = ranged.mapInArrow(_correct(NODES), "lang string, a int, b int, more long")
    shared = shared.groupBy("lang", "a", "b").agg(F.sum(F.col("more").cast("decimal(38,0)")).alias("shared"))

    # Terms that one of them has, against a count of 0 in the other.
    zeros = groups.where("p0 is not null").select("lang", F.col("p0").alias("z")).distinct()
    histogram = entries.groupBy("lang", "place", "p", "p0").agg(F.count("*").alias("n"))
    single = histogram.join(near(zeros), "lang")
    total = lambda f, f0: F.sum(F.expr(f"cast(n as decimal(19,0)) * cast({f} - {f0} as decimal(19,0))"))
    single = single.groupBy("lang", "place", "z").agg(
        total(_f("p", "z"), _f("p0", "z")).alias("away"), total(_f("z", "p"), _f("z", "p0")).alias("from")
    )
    single = settle(single, folder, "single")
    shared = settle(shared, folder, "shared")

    side = lambda name: groups.select("lang", "kept", F.col("source").alias(f"{name}_source"), F.col("place").alias(name), F.col("p0").alias(f"{name}0"))
    pairs = side("a").join(near(side("b").drop("kept")), "lang").where("a <> b")
    pairs = pairs.join(shared, ["lang", "a", "b"], "left")
    pairs = pairs.join(single.select("lang", F.col("place").alias("a"), F.col("z").alias("b0"), "away"), ["lang", "a", "b0"], "left")
    pairs = pairs.join(single.select("lang", F.col("place").alias("b"), F.col("z").alias("a0"), "from"), ["lang", "b", "a0"], "left")
    value = F.expr(
        f"coalesce(pmod(coalesce(cast(kept as decimal(19,0)) * {_f('a0', 'b0')}, 0) + coalesce(away, 0) + coalesce(from, 0)"
        " + coalesce(shared, 0), 18446744073709551616BD), 0)"
    )
    return pairs.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), value.cast("long").alias("value"))
