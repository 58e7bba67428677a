"""Dumps whose encoding nobody states, and texts that were decoded twice.

A file is UTF-8 if all its lines are valid in it and some has a letter beyond
ASCII; bytes of latin-1 prose hardly ever are. The counts that tell add up over
lines, so one pass of partial sums looks at every line of every file.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.layout import DUMP_ENCODING, text_schema
from firmbook.sources.dumps import read_dump

UTF8 = "UTF-8"


def file_encodings(spark: SparkSession, paths: str | Sequence[str], other: str = DUMP_ENCODING) -> DataFrame:
    """file, lines, beyond_ascii, invalid, encoding of each file; a file of ASCII alone counts as `other`."""
    read = spark.read.option("lineSep", "\n").text([paths] if isinstance(paths, str) else list(paths))
    lines = read.select(F.col("_metadata.file_path").alias("file"), "value")
    # The text reader takes bytes as they are; what is no UTF-8 shows by itself.
    bad = ~F.is_valid_utf8("value")
    beyond = F.col("value").cast("binary").cast("string").rlike(r"[^\x00-\x7F]") | bad
    counted = lines.groupBy("file").agg(
        F.count("*").alias("lines"), F.count_if(beyond).alias("beyond_ascii"), F.count_if(bad).alias("invalid")
    )
    is_utf8 = (F.col("invalid") == 0) & (F.col("beyond_ascii") > 0)
    return counted.withColumn("encoding", F.when(is_utf8, UTF8).otherwise(other))


def read_any_dump(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], other: str = DUMP_ENCODING, **options) -> DataFrame:
    """As ``read_dump`` (with its ``options``) of files of which some are UTF-8 and some are in `other`.

    Costs a pass over the files before the read. The names of the files, not
    their lines, come to the driver.
    """
    groups: dict[str, list[str]] = {}
    decoded = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file")
    for row in file_encodings(spark, paths, other).select(decoded, "encoding").collect():
        groups.setdefault(row["encoding"], []).append(row["file"])
    parts = [read_dump(spark, sorted(files), columns, encoding=encoding, **options) for encoding, files in sorted(groups.items())]
    if not parts:
        names = [*columns, *([options["file_column"]] if options.get("file_column") else [])]
        return spark.createDataFrame([], text_schema(names))
    return reduce(DataFrame.unionByName, parts)


def repair_twice_decoded(text: Column) -> Column:
    """UTF-8 that was taken for latin-1 on its way, as it was meant; other texts stay.

    Such a text has only characters of latin-1, and as bytes of it is valid UTF-8
    with letters beyond ASCII. Of a text that was mistaken twice once is mended.
    """
    latin = text.rlike(r"^[\x00-\xFF]*$") & text.rlike(r"[\xC2-\xF4][\x80-\xBF]")
    meant = F.encode(F.when(latin, text), "ISO-8859-1").cast("string")
    return F.when(F.coalesce(F.is_valid_utf8(meant), F.lit(False)), meant).otherwise(text)


def repaired(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`df` with its texts (or `columns`) as :func:`repair_twice_decoded` gives them."""
    chosen = {name for name, kind in df.dtypes if kind == "string"} if columns is None else set(columns)
    return df.select(
        *(repair_twice_decoded(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns)
    )
