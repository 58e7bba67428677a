"""Adding labels to coded columns."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

LABEL_SUFFIX = "_descricao"
# A lookup within both bounds is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
_CODE, _LABEL = "_lookup_code", "_lookup_label"
_HOT, _KEY = "_hot_code", "_shuffle_code"
_NEAR, _NEAR_LABEL, _FAR_LABEL = "_near_code", "_near_label", "_far_label"


def unique_codes(lookup: DataFrame, key: str = "codigo", value: str = "descricao") -> DataFrame:
    """One row per code, so that a join never multiplies facts.

    Of several labels for one code the first in text order stays.
    """
    return lookup.groupBy(key).agg(F.min(value).alias(value))


def fits_broadcast(
    *tables: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Which tables of texts are within the bounds for sending them to every executor.

    Runs one job of partial counts; a row of two numbers per table comes back.
    """
    sizes = [
        table.agg(
            F.count("*").alias("n_rows"),
            F.coalesce(F.sum(_octets(table)), F.lit(0)).alias("n_bytes"),
        ).withColumn("place", F.lit(place))
        for place, table in enumerate(tables)
    ]
    found = sorted(reduce(DataFrame.unionByName, sizes).collect(), key=lambda r: r.place)
    return [size.n_rows <= max_rows and size.n_bytes <= max_bytes for size in found]


def join_lookup(
    facts: DataFrame,
    column: str,
    lookup: DataFrame,
    key: str = "codigo",
    value: str = "descricao",
    name: str | None = None,
    null_safe: bool = False,
    literal: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join a lookup; the label lands in ``<column>_descricao`` (or ``name``).

    Every fact row stays and stays single. The size of the lookup is checked by
    a small job (not for a ``literal`` one, a few rows without repeated codes):
    within ``max_rows`` and ``max_bytes`` it is broadcast, beyond them joined by
    a shuffle that spares null and hot codes. With ``null_safe`` a null code
    finds a lookup row with a null code.
    """
    pairs = lookup.select(F.col(key).alias(_CODE), F.col(value).alias(_LABEL))
    bounds = {"max_rows": max_rows, "max_bytes": max_bytes}
    small = literal or fits_broadcast(pairs, **bounds)[0]
    labels = pairs if literal else unique_codes(pairs, _CODE, _LABEL)
    return _attach(facts, column, labels, small, name or column + LABEL_SUFFIX, null_safe, bounds)


def join_lookups(
    facts: DataFrame, lookups: Mapping[str, DataFrame], null_safe: bool = False
) -> DataFrame:
    """Join several lookups one after the other, given by the column they explain.

    As :func:`join_lookup` for each, with one job to check all their sizes.
    """
    pairs = [
        lookup.select(F.col("codigo").alias(_CODE), F.col("descricao").alias(_LABEL))
        for lookup in lookups.values()
    ]
    for column, pair, small in zip(lookups, pairs, fits_broadcast(*pairs)):
        labels = unique_codes(pair, _CODE, _LABEL)
        facts = _attach(facts, column, labels, small, column + LABEL_SUFFIX, null_safe)
    return facts


def _attach(
    facts: DataFrame,
    column: str,
    labels: DataFrame,
    small: bool,
    name: str,
    null_safe: bool,
    bounds: Mapping[str, int] | None = None,
) -> DataFrame:
    labels = labels.withColumnRenamed(_LABEL, name)
    code = F.col(column)
    match = code.eqNullSafe(F.col(_CODE)) if null_safe else code == F.col(_CODE)
    if small:
        return facts.join(F.broadcast(labels), match, "left").drop(_CODE)
    # A lookup that is large only by repeated codes is small once they are single.
    if fits_broadcast(labels, **(bounds or {}))[0]:
        return facts.join(F.broadcast(labels), match, "left").drop(_CODE)
    return _shuffled(facts, code, labels, name, null_safe)


def _shuffled(facts: DataFrame, code: Column, labels: DataFrame, name: str, null_safe: bool) -> DataFrame:
    """Left join by a shuffle in which no code, nor its absence, brings more than a task's share together.

    Two passes over the facts. The first, over their codes alone, finds those on
    more than an even task's share of all rows, fewer than there are tasks. Rows
    with one of these get the few labels by a broadcast and go on without a key,
    as those without a code do; Spark spreads the rows of an outer join that
    have no key, which a test asserts.
    """
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation(f"facts-{uuid.uuid4().hex}")
    codes = facts.select(code.alias(_HOT)).observe(seen, F.count(F.lit(1)).alias("rows"))
    counts = codes.where(F.col(_HOT).isNotNull()).groupBy(_HOT).agg(F.count("*").alias("n"))
    most = counts.orderBy(F.desc("n")).limit(tasks).collect()
    hot = [row[_HOT] for row in most if row["n"] * tasks > seen.get["rows"]]

    chosen = F.col(_CODE).isin(hot) if hot else F.lit(False)
    near = labels.where(chosen | F.col(_CODE).isNull() if null_safe else chosen)
    near = near.select(F.col(_CODE).alias(_NEAR), F.col(name).alias(_NEAR_LABEL))
    match = code.eqNullSafe(F.col(_NEAR)) if null_safe else code == F.col(_NEAR)
    spread = code.isNull() | code.isin(hot) if hot else code.isNull()
    keyed = facts.join(F.broadcast(near), match, "left").withColumn(_KEY, F.when(~spread, code))
    far = labels.where(F.col(_CODE).isNotNull() & ~chosen).withColumnRenamed(name, _FAR_LABEL)
    joined = keyed.join(far, F.col(_KEY) == F.col(_CODE), "left")
    label = F.coalesce(F.col(_NEAR_LABEL), F.col(_FAR_LABEL)).alias(name)
    return joined.select(*(F.col(f"`{c}`") for c in facts.columns), label)


def _octets(table: DataFrame) -> Column:
    return reduce(add, (F.coalesce(F.octet_length(c), F.lit(0)) for c in table.columns))


def decode_codes(facts: DataFrame, domain: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_descricao`` to coded columns from one domain table.

    ``domain`` holds rows of (``coluna``, ``codigo``, ``descricao``).
    """
    return join_lookups(
        facts,
        {
            column: domain.where(F.col("coluna") == column).select("codigo", "descricao")
            for column in columns
        },
    )
