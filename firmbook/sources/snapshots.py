"""Choosing the latest monthly snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.operators.versions import is_versioned, manifest, read_version


def latest_snapshot(
    df: DataFrame, month_col: str, as_of: date, lookback: int = 11
) -> DataFrame:
    """Rows of the latest month that has any, going back ``lookback`` months at most.

    ``month_col`` holds ``yyyy-MM`` text and ``as_of`` counts as the first month.
    The month is found from the rows; on a stored table partitioned by month
    :func:`latest_partition` finds it without reading any.
    """
    months = [_months_back(as_of, back) for back in range(lookback)]
    window = df.where(F.col(month_col).between(months[-1], months[0]))
    newest = window.agg(F.max(month_col))
    return window.where(F.col(month_col) == newest.scalar())


def latest_partition(
    spark: SparkSession, path: str, month_col: str, as_of: date, lookback: int = 11
) -> DataFrame:
    """As :func:`latest_snapshot`, of a Parquet table partitioned by ``month_col``.

    Of a table with versions the manifest tells which months have rows. Else the
    month is the latest whose folder holds a row: of its files footers are read
    until one has any, so months written empty are passed over. Only that month
    is read.
    """
    months = [_months_back(as_of, back) for back in range(lookback)]
    if is_versioned(spark, path):
        parts = manifest(spark, path)["parts"]
        latest = next((m for m in months if m in parts and parts[m]["rows"]), None)
        return read_version(spark, path, parts=[latest] if latest else [])
    table = spark.read.parquet(path)
    for month in months:
        folder = f"{path.rstrip('/')}/{month_col}={month}"
        if _has_content(spark, folder) and not spark.read.schema(table.schema).parquet(folder).isEmpty():
            return table.where(F.col(month_col) == month)
    return table.where(F.lit(False))


def _has_content(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    names = [f for f in fs.listStatus(path) if f.getPath().getName()[0] not in "_."]
    return any(f.isDirectory() or f.getLen() > 0 for f in names)


def _months_back(day: date, back: int) -> str:
    year, month = divmod(day.year * 12 + day.month - 1 - back, 12)
    return f"{year:04d}-{month + 1:02d}"
