"""Sizes of stored datasets, from file listings alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEGABYTE = 1024 * 1024


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and length of all files below the given paths; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(paths if isinstance(paths, str) else list(paths))
        .select("path", "length")
    )


def dataset_names(spark: SparkSession, root: str) -> list[str]:
    """Files and folders in ``root`` itself, without hidden ones."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in fs.listStatus(path)]
    return [name for name in names if not name.startswith(("_", "."))]


def dataset_bytes(spark: SparkSession, root: str) -> DataFrame:
    """Files with content and bytes of each dataset, that is of each file or folder in ``root``."""
    names = dataset_names(spark, root)
    listed = spark.createDataFrame([(name,) for name in names], "dataset string")
    if not names:
        return listed.select("dataset", F.lit(0).cast("long").alias("n_files"), F.lit(0).cast("long").alias("n_bytes"))
    below = "/" + root.split(":", 1)[-1].strip("/") + "/"
    inside = F.substr("path", F.instr("path", below) + F.lit(len(below)))
    sizes = (
        list_files(spark, root)
        .groupBy(F.substring_index(inside, "/", 1).alias("dataset"))
        .agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
    )
    # The listing passes over empty files; their datasets are there all the same.
    return listed.join(sizes, "dataset", "left").fillna(0, ["n_files", "n_bytes"])


def compression_ratio(before: DataFrame, after: DataFrame) -> DataFrame:
    """Percent of bytes saved per dataset and, with null as dataset, in total.

    Both sides hold ``dataset`` and ``n_bytes``; only datasets on both count.
    """
    both = before.select("dataset", F.col("n_bytes").alias("before")).join(
        after.select("dataset", F.col("n_bytes").alias("after")), "dataset"
    )
    return (
        both.rollup("dataset")
        .agg(F.sum("before").alias("bytes_before"), F.sum("after").alias("bytes_after"))
        .withColumn(
            "saved_percent",
            F.round((1 - F.try_divide(F.col("bytes_after"), F.col("bytes_before"))) * 100, 1),
        )
    )
