"""Reading the headerless registry dumps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.layout import DUMP_ENCODING, DUMP_SEPARATOR, NULL_TOKENS, text_schema

RAW_LINE = "_raw_line"


def dump_options(
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    multi_line: bool = False,
    skip_failed_files: bool = False,
    header: bool = False,
) -> dict[str, str]:
    """Options of the CSV reader, the same for batch and streaming reads."""
    options = {
        "header": str(header).lower(),
        "sep": sep,
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW_LINE,
        # With pruning on, only the selected fields are parsed and a row with
        # too many fields is no longer noticed.
        "columnPruning": "false",
        # A quoted line break needs multiLine, which makes a file unsplittable.
        "multiLine": str(multi_line).lower(),
    }
    if skip_failed_files:
        options |= {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
    return options


def dump_schema(columns: Sequence[str]):
    return text_schema([*columns, RAW_LINE])


def tidy_dump(
    raw: DataFrame,
    columns: Sequence[str],
    sep: str = DUMP_SEPARATOR,
    null_tokens: Sequence[str] = NULL_TOKENS,
    others: Sequence[str] = (),
) -> DataFrame:
    """Drop rows with too many fields, keep short ones, turn null tokens into null."""
    kept = raw.where(~has_extra_fields(columns, sep))
    return nullify_tokens(kept.select(*columns, *others), null_tokens, columns)


def read_dump(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    skip_failed_files: bool = False,
    multi_line: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Read one or many headerless dump files (paths or globs) as one all-text table.

    Columns are named by position. Rows with more fields than ``columns`` are
    dropped, rows with fewer are filled up with null. With
    ``skip_failed_files`` an unreadable file is passed over. ``file_column``
    adds the file a row came from, for :func:`rows_per_file` to count by once
    the table is stored, without parsing the dump again.
    """
    raw = (
        spark.read.schema(dump_schema(columns))
        .options(**dump_options(sep, encoding, multi_line, skip_failed_files))
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    if file_column is None:
        return tidy_dump(raw, columns, sep, null_tokens)
    named = raw.withColumn(file_column, F.col("_metadata.file_path"))
    return tidy_dump(named, columns, sep, null_tokens, others=[file_column])


def nullify_tokens(
    df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace the given texts by null in all string columns (or in ``columns``)."""
    if not tokens:
        return df
    chosen = {name for name, kind in df.dtypes if kind == "string"}
    if columns is not None:
        chosen &= set(columns)
    return df.select(
        *(
            F.when(~F.col(name).isin(*tokens), F.col(name)).alias(name)
            if name in chosen
            else F.col(name)
            for name in df.columns
        )
    )


def rows_per_file(
    df: DataFrame, total: bool = True, file_column: str = "_metadata.file_path"
) -> DataFrame:
    """Rows of each input file; the row whose ``file`` is null is the total.

    On a dump read by :func:`read_dump` these are the rows kept. On a stored
    table name the column that was written with ``file_column``.
    """
    files = df.select(F.col(file_column).alias("file"))
    counted = files.groupBy("file").agg(F.count("*").alias("n_rows"))
    if not total:
        return counted
    # The total adds up the counts, one row per file.
    return counted.rollup("file").agg(F.sum("n_rows").alias("n_rows"))


def has_extra_fields(columns: Sequence[str], sep: str) -> Column:
    """Whether a row, read with its raw line, has more fields than there are columns."""
    # The reader hands over the raw line of every row whose field count is off.
    # A quote opens a field only at its start, ends at one that is not doubled,
    # or else with the line.
    quoted = rf'(^|{re.escape(sep)})"[^"]*+(?:""[^"]*+)*+(?:"|$)'
    outside_quotes = F.regexp_replace(RAW_LINE, quoted, "$1")
    separators = F.length(outside_quotes) - F.length(
        F.replace(outside_quotes, F.lit(sep), F.lit(""))
    )
    too_long = F.col(RAW_LINE).isNotNull() & (separators >= len(columns))
    # Spark refuses a query that uses the raw line alone, as a bare count would;
    # the second test is never true and only brings in one real column.
    return too_long | F.coalesce(F.octet_length(columns[0]) < 0, F.lit(False))
