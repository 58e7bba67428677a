"""Code lookups: two text columns, ``codigo`` and ``descricao``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.functions.values import sql_text
from firmbook.layout import COMPANY_SIZES, QUALIFICATIONS, STATUS_REASONS, text_schema
from firmbook.sources.dumps import nullify_tokens

LOOKUP_COLUMNS = ("codigo", "descricao")


def read_lookup(
    spark: SparkSession,
    path: str,
    key: str = "codigo",
    value: str = "descricao",
    header: bool = False,
    encoding: str = "UTF-8",
    sep: str = ";",
) -> DataFrame:
    """Read a lookup file with its own encoding, as ``codigo`` and ``descricao``.

    A file without header holds code and label in this order; with one, ``key``
    and ``value`` name them.
    """
    reader = spark.read.options(header=header, sep=sep, encoding=encoding, escape='"')
    if not header:
        return nullify_tokens(reader.schema(text_schema(LOOKUP_COLUMNS)).csv(path))
    # No inference: without it every column of a CSV file is text.
    return nullify_tokens(
        reader.csv(path).select(F.col(key).alias("codigo"), F.col(value).alias("descricao"))
    )


def inline_lookup(spark: SparkSession, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """A few literal rows as a table."""
    rows = ", ".join(f"({sql_text(code)}, {sql_text(label)})" for code, label in pairs)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(codigo, descricao)")


def size_lookup(spark: SparkSession) -> DataFrame:
    return inline_lookup(spark, COMPANY_SIZES)


def reason_lookup(spark: SparkSession) -> DataFrame:
    return inline_lookup(spark, STATUS_REASONS)


def qualification_lookup(spark: SparkSession) -> DataFrame:
    return inline_lookup(spark, QUALIFICATIONS)
