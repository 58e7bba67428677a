"""Tables laid out for lookups by several columns.

A database keeps an index for each column that is looked up. Parquet keeps the
least and greatest value of each row group, which serve a column only if its
values lie together. Rows are laid along a space-filling curve: each indexed
column is cut into ranges of about equal numbers of rows, and the bits of the
range numbers are interleaved, so that a row group covers few ranges of every
column. For point lookups a Bloom filter of each row group tells which ids it
cannot hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each indexed column has 2 ** BITS ranges.
BITS = 5
#: Relative error of a range's share of all rows.
ERROR = 0.005
ROW_GROUP_BYTES = 128 * 1024 * 1024


def place_in_order(column: Column, kind: T.DataType) -> Column:
    """A number that goes up with the value; texts by their first seven bytes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(F.encode(column.cast("string"), "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Values that part each column into ranges of about equal numbers of rows: less than 2 ** bits numbers each."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    placed = df.select(*(place_in_order(F.col(f"`{c}`"), kinds[c]).alias(f"c{at}") for at, c in enumerate(columns)))
    shares = [n / 2**bits for n in range(1, 2**bits)]
    found = placed.approxQuantile([f"c{at}" for at in range(len(columns))], shares, ERROR)
    return {c: sorted(set(bounds)) for c, bounds in zip(columns, found)}


def curve(df: DataFrame, bounds: dict[str, list[float]], bits: int = BITS) -> Column:
    """The place of a row on the curve; a null lies before all values."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = []
    for name, values in bounds.items():
        at = place_in_order(F.col(f"`{name}`"), kinds[name])
        passed = [F.when(at >= F.lit(v), 1).otherwise(0) for v in values]
        number = reduce(lambda a, b: a + b, passed, F.lit(0)).cast("long")
        # A column of few values has few ranges: spread over all bits, so that its first bit parts it too.
        numbers.append(F.floor(number * F.lit(2**bits) / F.lit(len(values) + 1)).cast("long"))
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for at, number in enumerate(numbers):
            taken = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(taken, bit * len(numbers) + at))
    return out


def write_indexed(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    files: int,
    ids: Sequence[str] = (),
    ids_per_group: int = 1_000_000,
    row_group_bytes: int = ROW_GROUP_BYTES,
    compression: str = "zstd",
    mode: str = "error",
) -> None:
    """Write Parquet that a filter on any of `columns` reads little of, with Bloom filters for `ids`.

    `files` parts of the curve, of about equal numbers of rows, become a file
    each; within it rows are in order of the curve. `ids_per_group` is the
    number of different ids that a filter is made for. Costs one pass to find
    the ranges and one shuffle.
    """
    if not columns or len(columns) * BITS > 62:
        raise ValueError(f"from 1 to {62 // BITS} columns can be indexed")
    place = curve(df, range_bounds(df, columns))
    laid = df.withColumn("_curve", place).repartitionByRange(files, "_curve").sortWithinPartitions("_curve").drop("_curve")
    writer = laid.write.mode(mode).option("compression", compression).option("parquet.block.size", row_group_bytes)
    for name in ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", ids_per_group)
    writer.parquet(path)


def lookup(spark: SparkSession, path: str, column: str, values: Sequence) -> DataFrame:
    """The rows with one of a few values, by a filter that reaches the row groups."""
    return spark.read.parquet(path).where(F.col(f"`{column}`").isin(list(values)))
