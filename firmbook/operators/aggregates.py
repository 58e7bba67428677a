"""Aggregates that Spark has no single call for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmbook.functions.values import sql_text

_PART, _CHUNK = "_part", "_chunk"


def listagg_distinct(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], sep: str = "; "
) -> DataFrame:
    """Per group and column of ``values``: its distinct values in order, as one text.

    Also gives ``n_<value>``, the number of distinct values. Nulls are left
    out; a group without any value keeps its row.

    One group may hold a large part of all rows. So duplicates go first, under
    a key that holds the value itself, then the rows are range-partitioned by
    group *and value*: a big group spreads over many tasks, each builds the
    text of its own stretch, and only these finished stretches meet in one row.
    """
    stretches = _stretches(df, keys, values, sep)
    columns: list[Column] = []
    for i, value in enumerate(values):
        mine = f"case when _i = {i} then {_CHUNK} end"
        columns += [
            F.expr(f"listagg({mine}, {sql_text(sep)}) within group (order by {_PART})").alias(value),
            F.sum(F.when(F.col("_i") == i, F.col("_n")).otherwise(0)).alias(f"n_{value}"),
        ]
    return stretches.groupBy(*keys).agg(*columns)


def _stretches(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], sep: str
) -> DataFrame:
    """Per group, value column and task: the ordered text of the values found there."""
    pairs = df.select(
        *keys,
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(i).alias("_i"), F.col(v).cast("string").alias("_v"))
                    for i, v in enumerate(values)
                )
            )
        ),
    ).distinct()
    return (
        pairs.repartitionByRange(*keys, "_i", "_v")
        .withColumn(_PART, F.spark_partition_id())
        .groupBy(*keys, "_i", _PART)
        .agg(
            F.expr(f"listagg(_v, {sql_text(sep)}) within group (order by _v)").alias(_CHUNK),
            F.count("_v").alias("_n"),
        )
    )


def duplicate_count(key: str) -> Column:
    """Rows beyond the first of each key; rows with a null key all count."""
    return F.count("*") - F.count_distinct(key)


def null_count(column: str) -> Column:
    return F.sum(F.when(F.col(column).isNull(), 1).otherwise(0))


def max_length(column: str) -> Column:
    """Length in characters of the longest text."""
    return F.max(F.char_length(column))
