"""Column types by evidence that can be added up.

What a column's values look like is counted in one pass: whole numbers, such
with a leading zero, other numbers, days, times, truth values, and how large.
Counts of two sets of files add up to those of both, so evidence can be kept
and only new files looked at. A type follows from the counts alone:

    text < number < whole number        text < time < day        text < truth value

A column has the narrowest type that all its values have. One value with a
leading zero makes a column of digits one of codes, which stay text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmbook.sources.tables import read_table_csv

EVIDENCE = "column string, n long, whole long, zeros long, digits int, low decimal(38,0), high decimal(38,0), numbers long, days long, times long, truths long"
_WHOLE = r"^-?[0-9]{1,38}$"
_ZERO = r"^-?0[0-9]+"
_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]{1,3})?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}"


def evidence(df: DataFrame) -> DataFrame:
    """One row of counts for each column of a table of texts, in one pass."""
    return df.agg(*(_counts(c).alias(f"c{at}") for at, c in enumerate(df.columns))).select(
        F.inline(F.array(*(f"c{at}" for at in range(len(df.columns)))))
    )


def _counts(name: str) -> Column:
    value = F.col(f"`{name}`")
    whole, number = value.rlike(_WHOLE), value.rlike(_NUMBER)
    day = value.rlike(_DAY) & F.try_to_date(value, "yyyy-MM-dd").isNotNull()
    time = value.rlike(_TIME) & F.try_to_timestamp(value).isNotNull()
    amount = F.when(whole, value.try_cast("decimal(38,0)"))
    many = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    return F.struct(
        F.lit(name).alias("column"),
        F.count(value).alias("n"),
        many(whole).alias("whole"),
        many(number & value.rlike(_ZERO)).alias("zeros"),
        F.max(F.when(whole, F.length(F.ltrim(value, F.lit("-"))))).alias("digits"),
        F.min(amount).alias("low"),
        F.max(amount).alias("high"),
        many(number).alias("numbers"),
        many(day).alias("days"),
        many(day | time).alias("times"),
        many(F.lower(value).isin("true", "false")).alias("truths"),
    )


def add_evidence(*found: DataFrame) -> DataFrame:
    """The evidence of several sets of files together."""
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    sums = [F.sum(c).alias(c) for c in ("n", "whole", "zeros", "numbers", "days", "times", "truths")]
    ends = [F.max("digits").alias("digits"), F.min("low").alias("low"), F.max("high").alias("high")]
    return whole.groupBy("column").agg(*sums, *ends).select(*(f.split()[0] for f in EVIDENCE.split(", ")))


def evident_types(found: DataFrame) -> dict[str, T.DataType]:
    """The type of each column; a row a column comes to the driver."""
    return {row["column"]: _type(row) for row in found.collect()}


def _type(row) -> T.DataType:
    n = row["n"]
    if not n or row["zeros"]:
        return T.StringType()
    if row["whole"] == n:
        for kind, bits in ((T.IntegerType(), 31), (T.LongType(), 63)):
            if -(2**bits) <= row["low"] and row["high"] < 2**bits:
                return kind
        return T.DecimalType(38, 0)
    if row["numbers"] == n:
        return T.DoubleType()
    if row["days"] == n:
        return T.DateType()
    if row["times"] == n:
        return T.TimestampType()
    return T.BooleanType() if row["truths"] == n else T.StringType()


def typed(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """A table of texts with its columns as the given types; text where none is given."""
    return df.select(*(F.col(f"`{c}`").cast(types.get(c, T.StringType())).alias(c) for c in df.columns))


def read_evident_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Read a CSV table with header, types by the evidence of all rows; codes stay text unasked.

    `known` is evidence of other files of the table that counts too.
    """
    texts = read_table_csv(spark, path, sep=sep, encoding=encoding, null_tokens=("",), multi_line=multi_line)
    found = evidence(texts)
    return typed(texts, evident_types(found if known is None else add_evidence(found, known)))
