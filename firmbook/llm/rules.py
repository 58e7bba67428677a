"""Quality rules by divergence: how far a text's characters and common words are from those of its language.

References come from all rows of a language: the shares of six classes of
characters, and of each word that makes up at least one in `common` of all
words, with all others as one. A text is held against them by Jensen-Shannon
distance (base 2, from 0 to 1). Of a short text the distance is large by
chance, so `min_words` have to be there and the bounds widen by `slack` over
the root of the number of words.

Everything is a DataFrame expression: a row is measured where it is, only the
counts of words travel, summed before. Words are told apart by 64-bit
fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmbook.llm.shared import settle, workspace

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: A common word is at least one in so many; there are no more of them.
COMMON = 400
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.3
SLACK = 1.0
#: Languages up to which the references, some kilobytes each, go to every executor.
BROADCAST_LANGS = 5_000

_CLASSES = ("lower", "wide", "upper", "point", "digit", "others")
_MARKS = 1024
_LN2 = 0.6931471805599453


def _bind(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often it is used for each element."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def with_classes(df: DataFrame) -> DataFrame:
    """`df` with the code points of `text` by class, the array `classes`, and what no class holds as `others`."""
    # Column by column, so that each expression runs once and over ever shorter texts.
    # Java takes a class of ranges much faster than the negation of one.
    steps = {"lower": "[a-z]+", "blank": BLANK, "wide": r"[\x{80}-\x{10FFFF}]+", "upper": "[A-Z]+"}
    steps |= {"point": r"""[.,;:!?'"()-]+""", "digit": "[0-9]+"}
    left = "text"
    for name, expression in steps.items():
        df = df.withColumn(f"_not_{name}", F.regexp_replace(left, expression, ""))
        df = df.withColumn(f"_n_{name}", F.length(left) - F.length(f"_not_{name}"))
        left = f"_not_{name}"
    counts = [F.length(left) if name == "others" else F.col(f"_n_{name}") for name in _CLASSES]
    df = df.withColumns({"classes": F.array(*[n.cast("long") for n in counts]), "others": F.col(left)})
    return df.drop(*(f"_{k}_{name}" for name in steps for k in ("n", "not")))


def _prints(words: Column) -> Column:
    """A 64-bit fingerprint of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _tail(values: Column, drop: int) -> Column:
    return F.slice(values, drop + 1, F.greatest(F.size(values) - drop, F.lit(0)))


def _windows(prints: Column) -> Column:
    """A fingerprint of each window of three words."""
    pairs = F.zip_with(prints, _tail(prints, 1), lambda a, b: a.bitwiseXOR(F.shiftleft(b, 1)))
    whole = F.zip_with(pairs, _tail(prints, 2), lambda a, b: a.bitwiseXOR(F.shiftrightunsigned(b, 1)))
    return F.slice(whole, 1, F.greatest(F.size(prints) - 2, F.lit(0)))


def _neighbours(values: Column, alike) -> Column:
    """The elements of a sorted array that are like the one before or the one after; some come twice."""
    pairs = lambda s: F.zip_with(s, _tail(s, 1), lambda a, b: F.when(alike(a, b), F.array(a, b)))
    return _bind(values, lambda s: F.flatten(F.filter(pairs(s), lambda p: p.isNotNull())))


def _repeated(windows: Column) -> Column:
    """Words inside a window of three that the text holds at least twice."""
    # Plain numbers sort fast: the upper half of a fingerprint with the place below it
    # finds all windows that may be repeated, the whole fingerprint those that are.
    upper, place = F.lit(-1 << 31), F.lit((1 << 31) - 1)
    keyed = F.transform(windows, lambda h, i: h.bitwiseAND(upper).bitwiseOR(i.cast("long")))
    likely = _neighbours(F.sort_array(keyed), lambda a, b: F.shiftrightunsigned(a.bitwiseXOR(b), 31) == 0)
    at = lambda k: k.bitwiseAND(place).cast("int")
    placed = F.transform(F.array_distinct(likely), lambda k: F.struct(F.get(windows, at(k)).alias("h"), at(k).alias("i")))
    twice = F.transform(_neighbours(F.sort_array(placed), lambda a, b: a["h"] == b["h"]), lambda x: x["i"])
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    step = lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(3))).alias("n"))
    covered = F.aggregate(F.sort_array(twice), start, step, lambda s: s["n"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(covered).cast("long")


def _repeated_lines(text: Column) -> Column:
    own = _bind(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
    )
    return F.when(F.instr(text, "\n") > 0, own).otherwise(0).cast("long")


def _mark(fingerprint: Column) -> Column:
    return fingerprint.bitwiseAND(_MARKS - 1).cast("int")


def common_words(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """Of each language (`key`, its fingerprint) the fingerprints and shares of its common words.

    key, prints, shares, marks (they tell most words that are not common by one
    look), other (share of all other words). A language without words has no row.
    """
    words = docs.select(F.xxhash64("lang").alias("key"), F.explode(F.split(F.coalesce("text", F.lit("")), BLANK)).alias("word"))
    counts = words.where("word <> ''").groupBy("key", F.xxhash64("word").alias("print")).agg(F.count("*").alias("n"))
    folder = workspace(docs.sparkSession)
    counts = settle(counts, folder, "counts")
    # One row a language goes to the counts, which are not dealt by language.
    totals = settle(counts.groupBy("key").agg(F.sum("n").alias("total")), folder, "totals")
    near = F.broadcast(totals) if totals.count() <= BROADCAST_LANGS else totals
    # Of words of which each is one in `common` there are no more than `common`.
    frequent = counts.join(near, "key").where(F.col("n") * common >= F.col("total"))
    top = F.sort_array(F.collect_list(F.struct("print", (F.col("n") / F.col("total")).alias("share"))))
    found = totals.join(frequent.groupBy("key").agg(top.alias("top")), "key", "left")
    found = found.withColumn("top", F.coalesce("top", F.expr("cast(array() as array<struct<print: bigint, share: double>>)")))
    return found.select(
        "key",
        F.transform("top", lambda t: t["print"]).alias("prints"),
        F.transform("top", lambda t: t["share"]).alias("shares"),
        _bind(
            F.transform("top", lambda t: _mark(t["print"])),
            lambda taken: F.transform(F.sequence(F.lit(0), F.lit(_MARKS - 1)), lambda m: F.array_contains(taken, m)),
        ).alias("marks"),
        F.greatest(F.aggregate("top", F.lit(1.0), lambda s, t: s - t["share"]), F.lit(0.0)).alias("other"),
    )


def _part(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence, in nats."""
    side = lambda x, y: F.when(x > 0, x * F.log(2 * x / (x + y))).otherwise(0.0)
    return (side(p, q) + side(q, p)) / 2


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)) / _LN2)


def class_distance(classes: Column, chars: Column, shares: Column) -> Column:
    parts = F.zip_with(classes, shares, lambda c, q: _part(c / chars, q))
    return _distance(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x))


def word_distance(words: Column, n_words: Column, prints: Column, shares: Column, marks: Column, other: Column) -> Column:
    """Distance of word shares; a run of equal fingerprints in the sorted list is the count of one word."""
    # A common word that is absent has half its share times ln 2; one that is there, what differs from that.
    one = lambda n, q: F.struct(n.alias("n"), (_part(n / n_words, q) - q * _LN2 / 2).alias("more"))
    counted = lambda own, runs: F.zip_with(
        own,
        _bind(
            F.concat(F.transform(own, lambda h: F.array_position(runs, h)), F.array(F.size(runs).cast("long") + 1)),
            lambda starts: F.zip_with(F.slice(starts, 1, F.size(own)), _tail(starts, 1), lambda a, b: b - a),
        ),
        lambda h, n: _bind(
            F.get(shares, F.array_position(prints, h).cast("int") - 1), lambda q: F.when(q.isNotNull(), one(n, q))
        ),
    )
    parts = _bind(
        F.sort_array(F.filter(words, lambda h: F.get(marks, _mark(h)))),
        lambda runs: _bind(F.array_distinct(runs), lambda own: counted(own, runs)),
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("more"))
    add = lambda s, x: F.when(x.isNull(), s).otherwise(
        F.struct((s["n"] + x["n"]).alias("n"), (s["more"] + x["more"]).alias("more"))
    )
    rest = lambda s: _part((n_words - s["n"]) / n_words, other)
    return F.aggregate(parts, zero, add, lambda s: _distance(s["more"] + (1 - other) * _LN2 / 2 + rest(s)))


def judge(
    docs: DataFrame,
    common: int = COMMON,
    min_words: int = MIN_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    slack: float = SLACK,
) -> DataFrame:
    """One row per row of `docs`: counts, distances and whether the rules keep the text.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class_distance, word_distance, kept. base_failed: fewer than 50
    words, or more than half of them inside repeated windows of three. kept: not
    base_failed, and no distance beyond its bound plus slack / sqrt(n_words) if
    there are `min_words`. Null texts count as empty, null languages as one
    language; a text without words has null distances. Repeated rows and null
    ids are kept. Columns other than doc_id, text and lang are not looked at.
    """
    folder = workspace(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    refs = settle(common_words(docs, common), folder, "common")
    if refs.count() <= BROADCAST_LANGS:
        refs = F.broadcast(refs)
    met = docs.withColumn("key", F.xxhash64("lang")).join(refs, "key", "left")
    met = met.withColumn("words", _prints(words_of(F.col("text")))).withColumn("windows", _windows(F.col("words")))
    n_words = F.size("words")
    words = word_distance(F.col("words"), n_words, F.col("prints"), F.col("shares"), F.col("marks"), F.col("other"))
    measured = with_classes(met).select(
        "doc_id",
        "key",
        n_words.cast("long").alias("n_words"),
        F.aggregate("classes", F.lit(0).cast("long"), lambda a, n: a + n).alias("word_chars"),
        (F.length("others") - F.length(F.regexp_replace("others", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
        _repeated(F.col("windows")).alias("n_repeat_words"),
        F.when(n_words > 0, words).alias("word_distance"),
        "classes",
    )
    # The texts are read no more: a row of numbers stands for each.
    measured = settle(measured, folder, "measured")
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(_CLASSES))]
    every = sum((F.col(f"c{i}") for i in range(1, len(_CLASSES))), F.col("c0"))
    shares = F.array(*[F.try_divide(F.col(f"c{i}"), every) for i in range(len(_CLASSES))])
    chars = settle(measured.groupBy("key").agg(*sums).select("key", shares.alias("class_shares")), folder, "classes")
    if chars.count() <= BROADCAST_LANGS:
        chars = F.broadcast(chars)
    distance = class_distance(F.col("classes"), F.col("word_chars"), F.col("class_shares"))
    measured = measured.join(chars, "key", "left").withColumn("class_distance", F.when(F.col("n_words") > 0, distance))
    n, allowed = F.col("n_words"), F.lit(slack) / F.sqrt("n_words")
    far = (F.col("class_distance") > max_class_distance + allowed) | (F.col("word_distance") > max_word_distance + allowed)
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    kept = ~F.col("base_failed") & ~F.coalesce(F.when(n >= min_words, far), F.lit(False))
    return measured.withColumn("base_failed", failed).withColumn("kept", kept).drop("key", "classes", "class_shares")
