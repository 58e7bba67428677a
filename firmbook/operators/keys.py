"""Row numbers for tables that need an id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmbook.operators.enrich import fits_broadcast
from firmbook.operators.versions import manifest, publish_part, read_version, stage_part

# The offsets of the files, some 150 bytes each, go to every executor within this bound.
BROADCAST_BYTES = 256 * 1024 * 1024
LOAD = "carga"


def number_rows(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """The rows of a Parquet table with a dense id counting from 1.

    An id is the row's place in its file plus the rows of all files before it.
    Both are facts of the written files, so ids come out the same however often
    a lost task is run again, and no row is sorted for them.
    """
    return _numbered(spark.read.parquet(path), name)


def _numbered(table: DataFrame, name: str, firsts: DataFrame | None = None) -> DataFrame:
    """Number rows by file and place; with `firsts` (LOAD, first) each load from its own first id."""
    own = [F.col("_metadata.file_path").alias("_file"), *([LOAD] if firsts is not None else [])]
    # One pass over the footers: the table of files has a row per file, not per row.
    files = table.select(*own).groupBy("_file", *own[1:]).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*own[1:]).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    if firsts is None:
        offsets = files.select("_file", offset.alias("_offset"))
    else:
        offsets = files.join(firsts, LOAD).select("_file", (offset + F.col("first") - 1).alias("_offset"))
    if fits_broadcast(files.select("_file"), max_rows=BROADCAST_BYTES // 150, max_bytes=BROADCAST_BYTES)[0]:
        offsets = F.broadcast(offsets)
    placed = table.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    return placed.join(offsets, "_file").select(
        (F.col("_offset") + F.col("_index") + 1).alias(name), *table.columns
    )


def surrogate_key(df: DataFrame, staging_path: str, name: str = "id") -> DataFrame:
    """Write ``df`` to ``staging_path`` (shared storage) and number what was written."""
    df.write.mode("overwrite").parquet(staging_path)
    return number_rows(df.sparkSession, staging_path, name)


def append_load(df: DataFrame, root: str, load: str) -> dict:
    """Add the rows of a load to the table with versions at `root` and reserve their ids.

    The ids follow the highest ever reserved there, also if that load is gone
    since. They are taken when the manifest is published, so loads that come at
    once get ranges of their own, and a load that is there already, as when a
    run is repeated after its end was not heard of, is not added again.
    """
    spark = df.sparkSession
    if load in manifest(spark, root)["parts"]:
        return manifest(spark, root)
    place = stage_part(df, root, load, LOAD)
    rows = spark.read.parquet(f"{root.rstrip('/')}/{place}").count()

    def reserve(current: dict) -> dict:
        return {"first": current.get("reserved", 0) + 1}

    return publish_part(spark, root, place, load, LOAD, reserve, once=True, reserve=rows)


def read_loads(spark: SparkSession, root: str, name: str = "id") -> DataFrame:
    """All loads with their ids, dense from 1 as long as no load was removed, and the load of each row."""
    parts = manifest(spark, root)["parts"]
    firsts = spark.createDataFrame([(k, e["notes"]["first"]) for k, e in parts.items()], f"{LOAD} string, first long")
    return _numbered(read_version(spark, root), name, firsts)
