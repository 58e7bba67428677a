"""Shards in random order: a two-pass external shuffle in DataFrame functions only.

First pass: every row goes to a shard by rendezvous hashing of its id, so one
more shard takes rows only into itself, and inside the shard to one of as many
buckets as keep a bucket within memory; the scattered rows are written to the
shared folder. Second pass: each bucket is put in Fisher-Yates order (Spark's
`shuffle`) and its rows get consecutive slots behind those of the shard's
earlier buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from firmbook.llm.shared import workspace

LAW = "key"


def row_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text and one for its end; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def shard_of(key: str, shards: int, seed: int) -> Column:
    """The shard with the highest seeded hash of (key, shard); the smaller number on a tie."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    bids = [
        F.struct(F.xxhash64(F.col(key), F.lit(seed), F.lit(s)).alias("bid"), F.lit(-s).alias("back"))
        for s in range(shards)
    ]
    best = F.greatest(*bids) if shards > 1 else bids[0]
    return (-best["back"]).cast("int")


def scatter(
    docs: DataFrame, size: str, shards: int, seed: int, bucket_bytes: int, bucket_rows: int
) -> DataFrame:
    """First pass: shard, bucket and the whole row of every row, from the shared folder.

    A bucket holds about `bucket_bytes` of `size` and `bucket_rows` rows; the
    number of a shard's buckets follows from what the shard holds. Rows of one
    id meet in one shard. The bucket also depends on where the row was written,
    so that neither null ids nor copies of one row fill a bucket; a task that
    runs again finds every row where it was.
    """
    placed = docs.select(shard_of("doc_id", shards, seed).alias("shard"), F.struct(*docs.columns).alias("row"))
    # Whole rows, texts included, are written twice; zstd keeps both near the input's size.
    path = f"{workspace(docs.sparkSession)}/scattered"
    placed.write.option("compression", "zstd").parquet(path)
    placed = docs.sparkSession.read.schema(placed.schema).parquet(path)
    # A row a shard.
    held = placed.groupBy("shard").agg(F.sum(F.col("row")[size]).alias("bytes"), F.count("*").alias("rows")).collect()
    buckets = [1] * shards
    for shard in held:
        buckets[shard["shard"]] = int(max((shard["bytes"] or 0) / bucket_bytes, shard["rows"] / bucket_rows)) + 1
    file = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)
    mark = F.xxhash64(F.lit(seed + 1), "row.doc_id", f"row.{size}", file, F.col("_metadata.row_index"))
    return placed.select("shard", F.pmod(mark, F.get(F.array(*map(F.lit, buckets)), "shard")).cast("int").alias("bucket"), "row")


def order(scattered: DataFrame, seed: int) -> DataFrame:
    """Second pass: shard, slot (gapless from 0) and the whole row, in random order."""
    filled = scattered.groupBy("shard", "bucket").agg(
        # Sorted first, so that a task that runs again starts from the same order.
        F.sort_array(F.collect_list("row")).alias("rows")
    )
    before = (
        scattered.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .groupBy("shard")
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))
        .withColumn(
            "ends",
            F.expr(
                "aggregate(counts, array(0L), (ends, x) -> concat(ends, array(element_at(ends, -1) + x.n)))"
            ),
        )
        .select("shard", F.posexplode("counts").alias("at", "own"), "ends")
        .select("shard", F.col("own.bucket").alias("bucket"), F.get("ends", "at").alias("before"))
    )
    # Nothing is shuffled after the random order is drawn: a task that is run again
    # draws whole buckets again.
    return (
        filled.join(before, ["shard", "bucket"])
        .select("shard", "before", F.posexplode(F.shuffle("rows", seed)).alias("at", "row"))
        .select("shard", (F.col("before") + F.col("at")).alias("slot"), "row")
    )


def _placed(sized: DataFrame, shards: int, seed: int, bucket_bytes: int, bucket_rows: int) -> DataFrame:
    """shard, slot and the whole row, of rows with their size and id beside them."""
    return order(scatter(sized, "size", shards, seed, bucket_bytes, bucket_rows), seed)


def write_shards(
    docs: DataFrame, path: str, shards: int = 16, seed: int = 7, bucket_bytes: int = 64 << 20, bucket_rows: int = 1 << 17
) -> None:
    """Write whole rows, texts included, as Parquet below shard=<n>, with their slot; a reader sorts by it.

    The row is one column, so no name of its own can clash. An empty table writes an empty table.
    """
    sized = docs.select(row_size().alias("size"), "doc_id", F.struct(*docs.columns).alias("doc"))
    placed = _placed(sized, shards, seed, bucket_bytes, bucket_rows)
    placed.select("shard", "slot", F.col("row.doc").alias("doc")).write.partitionBy("shard").parquet(path)


def place_rows(
    docs: DataFrame, shards: int = 16, seed: int = 7, bucket_bytes: int = 64 << 20, bucket_rows: int = 1 << 17
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: the places of the rows as written.

    The whole rows, texts included, are scattered, shuffled and written below
    shard=<n> in the shared folder; the result is read back from those files.
    A null text has size 1 and checksum 0; null ids meet in one shard; other
    columns are carried, not looked at; an empty table gives no rows.
    """
    doc = F.struct(*docs.columns).alias("doc")
    sized = docs.select(
        "doc_id",
        row_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        shard_of("doc_id", shards + 1, seed).alias("grown_shard"),
        doc,
    )
    path = f"{workspace(docs.sparkSession)}/shards"
    placed = _placed(sized, shards, seed, bucket_bytes, bucket_rows)
    placed.select("shard", "slot", F.col("row.doc").alias("doc")).write.option("compression", "zstd").partitionBy("shard").parquet(path)
    written = StructType(
        [
            StructField("slot", LongType()),
            StructField("doc", docs.select(doc).schema["doc"].dataType),
            StructField("shard", IntegerType()),
        ]
    )
    back = docs.sparkSession.read.schema(written).parquet(path)
    return back.select(
        F.col("doc.doc_id").alias("doc_id"),
        row_size("doc.text").alias("size"),
        F.crc32(F.coalesce(F.col("doc.text"), F.lit(""))).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        shard_of("doc.doc_id", shards + 1, seed).alias("grown_shard"),
    )
