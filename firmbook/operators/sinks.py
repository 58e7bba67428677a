"""Writing tables: CSV, Parquet, catalog tables, databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """Write CSV with header in UTF-8, replacing what was there.

    The result is a folder of part files, each with the header. Blanks are kept;
    texts with line breaks come back whole when read with ``multi_line``.
    """
    df.write.mode("overwrite").options(
        header=True,
        sep=sep,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records: int | None = None,
    mode: str = "overwrite",
    compression: str = "zstd",
) -> None:
    """Write Parquet, optionally partitioned and with a bound on rows per file.

    Rows of one partition value are brought together first, to save each task
    from writing a file per value; a value that holds much of the table is
    split over several tasks by the adaptive engine.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    table: T.StructType,
    location: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 64,
    files_per_bucket: int = 1,
) -> None:
    """Create the declared table if it is absent, and append ``df`` to it.

    Bucketing on the join key takes the place of an index: joins and groupings
    on it read the buckets side by side without a shuffle. An append adds at
    most ``files_per_bucket`` files to each bucket.
    """
    present = [field for field in table.fields if field.name in df.columns]
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in present
    )
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if bucket_by:
        ddl += f" CLUSTERED BY (`{bucket_by}`) INTO {buckets} BUCKETS"
    if location:
        ddl += f" LOCATION '{location}'"
    df.sparkSession.sql(ddl)
    rows = df.select(*(field.name for field in present))
    if bucket_by:
        # A task's rows all belong to one bucket, as its number is a multiple of theirs.
        rows = rows.repartition(files_per_bucket * buckets, bucket_by)
    rows.write.insertInto(name)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batchsize: int = 50_000,
    declared: T.StructType | None = None,
    mode: str = "append",
) -> None:
    """Insert ``df`` into a database table in batches, from all executors.

    Each partition is one transaction, the whole load is not: write to a
    staging table with ``mode="overwrite"`` and hand it on with
    :func:`publish_staged` when the target must see all rows or none.
    """
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", batchsize).options(**(properties or {}))
    if declared is not None:
        writer = writer.option("createTableColumnTypes", column_types(df, declared))
    writer.save()


def column_types(df: DataFrame, declared: T.StructType) -> str:
    """Declared types of the columns of ``df``, as the JDBC writer takes them."""
    return ", ".join(
        f"{field.name} {field.dataType.simpleString().upper()}"
        for field in declared.fields
        if field.name in df.columns
    )


def publish_staged(
    connection, staging: str, target: str, columns: Sequence[str], expected_rows: int
) -> None:
    """Move a staged load into its target in one transaction of the database.

    ``connection`` is an open connection of a Python database driver. The
    staging table must hold ``expected_rows``: a partition written twice, by a
    task tried again after its commit was lost, is found here and nothing is
    published.
    """
    names = ", ".join(columns)
    cursor = connection.cursor()
    try:
        cursor.execute(f"SELECT COUNT(*) FROM {staging}")
        found = cursor.fetchone()[0]
        if found != expected_rows:
            raise ValueError(f"{staging} holds {found} rows, expected {expected_rows}")
        cursor.execute(f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        cursor.close()
