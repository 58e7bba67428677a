"""Taking in dump files that may be rewritten, damaged or seen twice.

A ledger tells of every file its length, time, content hash and the batch that
holds its rows. What a reader sees are the rows of the batches that the ledger
names, so a file counts with exactly one content, its last whole one:

    <target>/rows/lote=<batch>/part-*.parquet    rows with the file they came from
    <target>/ledger                              a table with versions, one row a file

A batch writes its folder, replacing what an earlier try left there, and then
publishes the ledger. Until that moment nothing has changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firmbook.layout import DUMP_ENCODING, DUMP_SEPARATOR, NULL_TOKENS, text_schema
from firmbook.operators.enrich import fits_broadcast
from firmbook.operators.versions import is_versioned, manifest, read_version, replace_part
from firmbook.sources.archives import qualified, refuse_unknown
from firmbook.sources.dumps import read_dump

FILE, BATCH = "arquivo", "lote"
LEDGER = f"{FILE} string, bytes long, modificado timestamp, hash string, {BATCH} string, linhas long, erro string"
_LISTED = "path string, length long, modificationTime timestamp"
_CONTENT = "path string, modificationTime timestamp, length long, content binary"


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """One row for each file that was ever seen; `erro` tells of one that is damaged now."""
    place = f"{target.rstrip('/')}/ledger"
    return read_version(spark, place) if is_versioned(spark, place) else spark.createDataFrame([], LEDGER)


def read_ingested(spark: SparkSession, target: str, columns: Sequence[str]) -> DataFrame:
    """The rows of the last whole content of every file, with the file they came from."""
    root, current = target.rstrip("/"), ledger(spark, target).where(F.col(BATCH).isNotNull()).select(FILE, BATCH)
    batches = [row[BATCH] for row in current.select(BATCH).distinct().collect()]
    schema = text_schema([*columns, FILE, BATCH])
    if not batches:
        return spark.createDataFrame([], text_schema([*columns, FILE]))
    folders = [f"{root}/rows/{BATCH}={batch}" for batch in batches]
    rows = spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(*folders)
    near = F.broadcast(current) if fits_broadcast(current)[0] else current
    return rows.join(near, [FILE, BATCH], "left_semi").drop(BATCH)


def ledger_ingest(
    spark: SparkSession,
    landing: str,
    columns: Sequence[str],
    target: str,
    checkpoint: str,
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    skip_failed_files: bool = False,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take in the files in `landing` that are new or rewritten since the last run, then stop.

    New files come as a stream whose checkpoint remembers them. Files that are
    known are held against the ledger by length and time, and those that differ
    by content; the rows of a changed one take the place of its old ones. A
    compressed file is read to its end before any row of it counts: a damaged one
    ends the run, or with `skip_failed_files` is noted in the ledger, its rows
    of before stay, and it is tried again when it changes. A file that leaves
    `landing` keeps its rows. One run at a time may write to a target.
    """
    for place in (landing, target):
        refuse_unknown(qualified(spark, place))
    options = {"sep": sep, "encoding": encoding, "null_tokens": null_tokens}

    def take(files: DataFrame, batch: str) -> None:
        _take(files.sparkSession, files, batch, columns, target, skip_failed_files, options)

    listed = spark.read.schema(_CONTENT).format("binaryFile").load(landing).select("path", "length", "modificationTime")
    known = ledger(spark, target).select(FILE, "bytes", "modificado")
    moved = (F.col("length") != F.col("bytes")) | (F.col("modificationTime") != F.col("modificado"))
    changed = listed.join(known, F.col("path") == F.col(FILE)).where(moved).select(*listed.columns)
    take(changed, f"r{manifest(spark, f'{target}/ledger')['version']:08d}")

    stream = spark.readStream.schema(_CONTENT).format("binaryFile")
    if max_files_per_batch:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    arriving = stream.load(landing).select("path", "length", "modificationTime")
    query = (
        arriving.writeStream.foreachBatch(lambda files, number: take(files, f"s{number:08d}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _take(
    spark: SparkSession, files: DataFrame, batch: str, columns: Sequence[str], target: str, skip_failed_files: bool, options: dict
) -> None:
    # A row a file, so the batch's list may pass through the driver as Spark's own listing does.
    probed = files.mapInPandas(_probe, f"{_LISTED}, hash string, error string").collect()
    damaged = [f for f in probed if f["error"]]
    if damaged and not skip_failed_files:
        raise ValueError("damaged: " + ", ".join(f"{f['path']} ({f['error']})" for f in damaged[:5]))
    if not probed:
        return
    before = ledger(spark, target)
    old = {row[FILE]: row for row in before.where(F.col(FILE).isin([f["path"] for f in probed])).collect()}
    fresh = [f for f in probed if not f["error"] and (f["path"] not in old or old[f["path"]]["hash"] != f["hash"])]
    counts = {}
    if fresh:
        folder = f"{target.rstrip('/')}/rows/{BATCH}={batch}"
        rows = read_dump(spark, [f["path"] for f in fresh], columns, file_column=FILE, **options)
        # The rows' file is an encoded URI, the listed one is not.
        plain = F.url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B")))
        rows.withColumn(FILE, plain).write.mode("overwrite").parquet(folder)
        counted = spark.read.schema(text_schema([FILE])).parquet(folder).groupBy(FILE).agg(F.count("*").alias("n"))
        counts = {row[FILE]: row["n"] for row in counted.collect()}
    entries, taken = [], {f["path"] for f in fresh}
    for f in probed:
        last = old.get(f["path"])
        content = (f["hash"], batch, counts.get(f["path"], 0)) if f["path"] in taken else (last["hash"], last[BATCH], last["linhas"]) if last else (None, None, None)
        entries.append((f["path"], f["length"], f["modificationTime"], *content, f["error"]))
    new = spark.createDataFrame(entries, LEDGER)
    merged = before.join(new.select(FILE), FILE, "left_anti").select(*new.columns).unionByName(new)
    replace_part(merged.coalesce(1), f"{target.rstrip('/')}/ledger")


def remove_superseded(spark: SparkSession, target: str) -> list[str]:
    """Delete the folders of batches that the ledger no longer names; no run may be under way."""
    named = {row[BATCH] for row in ledger(spark, target).select(BATCH).distinct().collect()}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/rows")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for entry in fs.listStatus(path) if fs.exists(path) else []:
        batch = entry.getPath().getName().partition("=")[2]
        if batch not in named:
            fs.delete(entry.getPath(), True)
            gone.append(batch)
    return sorted(gone)


def _probe(batches):
    """Hash of each file's bytes, and what is wrong with a compressed one; blocks, never whole files."""
    import bz2
    import hashlib
    import zlib

    from pyarrow import fs

    def resolve(location):
        scheme, _, rest = location.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        return fs.FileSystem.from_uri(f"{scheme}:{rest}")

    class Whole:
        """Decompresses to nothing; a file of several streams is whole if the last one is."""

        def __init__(self, make):
            self.make, self.part, self.begun = make, None, False

        def feed(self, block):
            while block:
                if self.part is None or self.part.eof:
                    if self.begun and not block.strip(b"\0"):
                        return
                    self.part, self.begun = self.make(), True
                self.part.decompress(block)
                block = self.part.unused_data if self.part.eof else b""

        def fault(self):
            return None if self.part is not None and self.part.eof else "ends before its end"

    makers = {".gz": lambda: zlib.decompressobj(31), ".bz2": bz2.BZ2Decompressor}
    for batch in batches:
        hashes, errors = [], []
        for path in batch["path"]:
            store, name = resolve(path)
            digest, error = hashlib.sha256(), None
            maker = next((m for suffix, m in makers.items() if name.endswith(suffix)), None)
            whole = Whole(maker) if maker else None
            with store.open_input_stream(name, compression=None) as source:
                while block := source.read(8 * 1024 * 1024):
                    digest.update(block)
                    try:
                        if whole and not error:
                            whole.feed(block)
                    except (zlib.error, OSError, EOFError, ValueError) as damage:
                        error = f"{type(damage).__name__}: {damage}"
            if whole and not error:
                error = whole.fault()
            hashes.append(digest.hexdigest())
            errors.append(error)
        yield batch.assign(hash=hashes, error=errors)
