"""Data-quality reports from the footers of Parquet files.

A footer holds the rows of each row group and, for most columns, how many of
its values are null. The files are listed by Spark and their footers read by its
tasks; of a row group without that number, the column alone is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.operators.storage import MEGABYTE
from firmbook.sources.archives import qualified, refuse_unknown

FOOTERS = "file string, row_group int, n_rows long, n_bytes long, column string, n_null long, scanned boolean"


def row_groups(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Rows, compressed bytes and nulls of `columns` in each row group; one row a row group and column.

    Without columns one row a row group, `column` and `n_null` null. A column
    that a file lacks is null in all its rows, as Spark reads it. `scanned` tells
    that values had to be read. A file of no row group gives a row of 0 rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    for path in paths:
        refuse_unknown(qualified(spark, path))
    # The content is not selected, so the scan lists and reads nothing.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(paths)
    return files.select("path").mapInPandas(_reader(list(columns)), FOOTERS)


def _reader(columns: list[str]):
    """The per-task function, complete in itself so that executors need no package."""

    def read(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        def opened(location):
            scheme, _, rest = location.partition(":")
            if scheme == "file":
                return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
            scheme = "s3" if scheme in ("s3a", "s3n") else scheme
            store, name = fs.FileSystem.from_uri(f"{scheme}:{rest}")
            return store.open_input_file(name)

        def nulls(file, group, place, name):
            own = file.metadata.row_group(group)
            if place is None:
                return own.num_rows, False
            known = own.column(place).statistics
            if known is not None and known.has_null_count:
                return known.null_count, False
            return file.read_row_group(group, columns=[name]).column(0).null_count, True

        for batch in batches:
            rows = []
            for path in batch["path"]:
                with opened(path) as source:
                    file = pq.ParquetFile(source)
                    places = {file.schema.column(at).path: at for at in range(len(file.schema))}
                    nested = [c for c in columns if any(p.startswith(f"{c}.") for p in places) and c not in places]
                    if nested:
                        raise ValueError(f"{path}: {nested} are nested; footers do not tell their nulls")
                    for group in range(file.metadata.num_row_groups):
                        own = file.metadata.row_group(group)
                        size = sum(own.column(at).total_compressed_size for at in range(own.num_columns))
                        for name in columns or [None]:
                            found, scanned = (None, False) if name is None else nulls(file, group, places.get(name), name)
                            rows.append((path, group, own.num_rows, size, name, found, scanned))
                    if not file.metadata.num_row_groups:
                        rows += [(path, 0, 0, 0, name, 0 if name else None, False) for name in columns or [None]]
            names = ["file", "row_group", "n_rows", "n_bytes", "column", "n_null", "scanned"]
            yield pd.DataFrame(rows, columns=names).astype({"n_null": "Int64", "row_group": "int32"})

    return read


def footer_null_profile(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """As ``null_profile`` of the table at `path`: rows, and nulls of each column."""
    found = row_groups(spark, path, columns)
    total = F.coalesce(F.sum(F.when(F.col("column") == columns[0], F.col("n_rows"))), F.lit(0))
    own = lambda c: F.coalesce(F.sum(F.when(F.col("column") == c, F.col("n_null"))), F.lit(0))
    return found.agg(total.alias("total"), *(own(c).alias(f"{c}_null") for c in columns))


def footer_sizing(spark: SparkSession, path: str, target_mb: int = 100) -> DataFrame:
    """Files, rows and megabytes of the table at `path`, and rows that fill `target_mb`."""
    found = row_groups(spark, path)
    mb_per_row = F.try_divide(F.col("n_bytes") / MEGABYTE, F.col("n_rows"))
    sums = found.agg(
        F.count_distinct("file").alias("n_files"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
    )
    return sums.withColumn("rows_per_target", F.floor(F.try_divide(F.lit(float(target_mb)), mb_per_row)))
