"""Reading from a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Rows of a query run by the database.

    For a big result give a numeric ``partition_column`` with its bounds and the
    number of partitions: the executors then read ranges of it side by side.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition_column is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) part_of")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .load()
    )
