"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.operators.aggregates import duplicate_count, max_length, null_count
from firmbook.operators.storage import MEGABYTE, dataset_bytes


def field_widths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Longest text per column (all text columns by default): (``campo``, ``max_len``), in one scan."""
    columns = [c for c, kind in df.dtypes if kind == "string"] if columns is None else list(columns)
    widths = df.agg(*(max_length(c).alias(c) for c in columns))
    return widths.unpivot([], columns, "campo", "max_len")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of rows and of nulls per column (all by default), in one scan."""
    columns = df.columns if columns is None else columns
    return df.agg(
        F.count("*").alias("total"), *(null_count(c).alias(f"{c}_null") for c in columns)
    )


def duplicate_keys(df: DataFrame, key: str = "cnpj_basico") -> DataFrame:
    """Rows beyond the first of each key; rows with a null key all count."""
    return df.agg(duplicate_count(key).alias("duplicatas"))


def dataset_inventory(spark: SparkSession, root: str, expected: Sequence[str]) -> DataFrame:
    """Expected datasets under ``root``: present or not, and their size; an empty one is present."""
    wanted = spark.range(1).select(F.explode(F.array(*map(F.lit, expected))).alias("dataset"))
    return wanted.join(dataset_bytes(spark, root), "dataset", "left").select(
        "dataset",
        F.col("n_bytes").isNotNull().alias("present"),
        F.round(F.col("n_bytes") / MEGABYTE, 2).alias("size_mb"),
    )


def first_rows(df: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` rows with all their columns, read by no more tasks than it takes.

    They pass through the driver, so ``rows`` is to be small.
    """
    return df.sparkSession.createDataFrame(df.take(rows), df.schema)


def sample_check(datasets: Mapping[str, DataFrame], rows: int = 1000) -> DataFrame:
    """Rows that can be read of the first ``rows`` of each dataset, all columns.

    A dataset that cannot be read has no ``n_rows`` but an ``error``.
    """
    found = [(name, *_sample(df, rows)) for name, df in datasets.items()]
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame(found, "dataset string, n_rows long, error string")


def _sample(df: DataFrame, rows: int) -> tuple[int | None, str | None]:
    try:
        return len(df.take(rows)), None
    except Exception as damage:  # what a reader raises depends on format and storage
        return None, f"{type(damage).__name__}: {str(damage)[:500]}"


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each dataset."""
    return _counts(datasets)


def partition_sizing(
    spark: SparkSession, root: str, dataset: str, target_mb: int = 100
) -> DataFrame:
    """Megabytes per row of a Parquet dataset in ``root``, and rows per ``target_mb``.

    The latter is a fitting ``max_records`` for ``write_parquet``.
    """
    size = dataset_bytes(spark, root).where(F.col("dataset") == dataset)
    table = spark.read.parquet(f"{root.rstrip('/')}/{dataset}")
    sized = size.withColumn("n_rows", table.agg(F.count("*")).scalar())
    mb_per_row = F.try_divide(F.col("n_bytes") / MEGABYTE, F.col("n_rows"))
    return sized.select(
        "dataset",
        F.round(F.col("n_bytes") / MEGABYTE, 1).alias("size_mb"),
        "n_rows",
        mb_per_row.alias("mb_per_row"),
        F.floor(F.try_divide(F.lit(float(target_mb)), mb_per_row)).alias("rows_per_target"),
    )


def _counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, counts)
