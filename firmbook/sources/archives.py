"""Unpacking zipped dumps to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

UNPACKED = "archive string, member string, path string, bytes long, error string"


def unpack_zips(
    spark: SparkSession, paths: str | list[str], suffix: str, out_dir: str
) -> DataFrame:
    """Unpack the archive members whose name ends in ``suffix`` (any case) into ``out_dir``.

    Returns one row per unpacked member, and one with ``error`` filled per
    archive that is damaged; the archives themselves are left alone. The work
    happens when the result is computed. Spark packs the archives into tasks by
    their size, and a member is streamed in blocks, so memory does not grow
    with it. The name of a written file follows from archive and content, and
    a file appears under it only when whole: a retried, doubled or repeated
    task finds it there and goes on. Both places are resolved as Spark resolves
    them, before any task starts; one in a store that the tasks cannot open is
    refused there.
    """
    out_dir = qualified(spark, out_dir)
    refuse_unknown(out_dir)
    for path in [paths] if isinstance(paths, str) else paths:
        refuse_unknown(qualified(spark, path))
    # Only path and length are selected: no content is read by the scan.
    archives = spark.read.format("binaryFile").load(paths).select("path", "length")
    return archives.mapInPandas(_unpacker(suffix, out_dir), UNPACKED)


# Stores that tasks open, by scheme; s3a and s3n are s3 there.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")


def qualified(spark: SparkSession, location: str) -> str:
    """A location with its scheme, as Spark's own file system completes it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


def refuse_unknown(location: str) -> None:
    """Raise for a store that tasks cannot open by themselves."""
    scheme = location.partition(":")[0]
    if scheme not in SCHEMES:
        raise ValueError(f"tasks cannot open files at a {scheme}: location")


def _unpacker(suffix: str, out_dir: str):
    """The per-task function, complete in itself so that executors need no package."""

    def unpack(batches):
        import hashlib
        import posixpath
        import uuid
        import zipfile

        import pandas as pd
        from pyarrow import fs

        def resolve(location):
            scheme, _, rest = location.partition(":")
            if scheme == "file":
                return fs.LocalFileSystem(), "/" + rest.lstrip("/")
            scheme = "s3" if scheme in ("s3a", "s3n") else scheme
            return fs.FileSystem.from_uri(f"{scheme}:{rest}")

        def is_whole(store, target, info):
            return store.get_file_info(target).size == info.file_size

        def copy(zipped, info, store, target):
            draft = f"{target}.{uuid.uuid4().hex}.part"
            try:
                with zipped.open(info) as source, store.open_output_stream(draft) as sink:
                    while block := source.read(8 * 1024 * 1024):
                        sink.write(block)
                if not is_whole(store, target, info):
                    store.move(draft, target)
            finally:
                if store.get_file_info(draft).type != fs.FileType.NotFound:
                    store.delete_file(draft)

        for batch in batches:
            for archive in batch["path"]:
                rows = []
                store, name = resolve(archive)
                out_store, folder = resolve(out_dir)
                out_store.create_dir(folder, recursive=True)
                mark = hashlib.sha256(archive.encode()).hexdigest()[:12]
                try:
                    with store.open_input_file(name) as file, zipfile.ZipFile(file) as zipped:
                        number = 0
                        for info in zipped.infolist():
                            if not info.filename.upper().endswith(suffix.upper()):
                                continue
                            number += 1
                            target = posixpath.join(
                                folder, f"{mark}-{number:02d}-{info.CRC:08x}.csv"
                            )
                            if not is_whole(out_store, target, info):
                                copy(zipped, info, out_store, target)
                            rows.append((archive, info.filename, target, info.file_size, None))
                except OSError:
                    raise  # trouble with the storage: Spark tries the task again
                except Exception as damage:
                    rows.append((archive, None, None, None, f"{type(damage).__name__}: {damage}"))
                columns = ["archive", "member", "path", "bytes", "error"]
                yield pd.DataFrame(rows, columns=columns).astype({"bytes": "Int64"})

    return unpack
