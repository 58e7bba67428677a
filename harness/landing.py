"""Files that queries read back: dumps, broken files and archives on shared storage."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _own_folder() -> str:
    # Only where the setting is absent, as in a plain local session.
    return tempfile.mkdtemp(prefix="firmbook-")


def scratch(spark: SparkSession) -> str:
    """A new folder name below the shared folder the cluster names; only a local master may go without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder()
    path, fs = _hadoop(spark, shared)
    return f"{fs.makeQualified(path).toString().rstrip('/')}/firmbook-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def land_dump(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "ISO-8859-1") -> str:
    """Write a table as a headerless dump, in latin-1 unless told otherwise."""
    df.write.mode(mode).options(
        sep=";",
        encoding=encoding,
        quoteAll=True,
        escape='"',
        header=False,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def land_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a one-column table as latin-1 lines just as they are."""
    lines.write.mode(mode).options(
        sep="\u0001",
        quote="",
        encoding="ISO-8859-1",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def dump_line(df: DataFrame, columns=None, extra: str = ""):
    """The dump line of a row as an expression: quoted fields, doubled quotes."""
    fields = [
        F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in (columns or df.columns)
    ]
    return F.concat(F.concat_ws(";", *fields), F.lit(extra))


def land_bytes(spark: SparkSession, path: str, content: bytes) -> str:
    """Write one small file from the driver."""
    target, fs = _hadoop(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(content))
    stream.close()
    return path


def land_gzip(lines: DataFrame, folder: str, name: str) -> str:
    """Write a one-column table of lines as gzip files called after the task, in place of those of that name."""

    def pack(batches):
        import gzip
        import uuid as ids

        import pandas as pd
        from pyarrow import fs
        from pyspark import TaskContext

        scheme, colon, rest = folder.partition(":")
        if colon and rest.startswith("//"):
            store, base = fs.FileSystem.from_uri(folder)
        else:
            store, base = fs.LocalFileSystem(), "/" + (rest if colon else folder).lstrip("/")
        store.create_dir(base, recursive=True)
        target = f"{base}/{name}-{TaskContext.get().partitionId():05d}.csv.gz"
        draft = f"{base}/.{ids.uuid4().hex}"
        with store.open_output_stream(draft, compression=None) as sink, gzip.GzipFile(fileobj=sink, mode="wb", mtime=0) as out:
            for batch in batches:
                for line in batch.iloc[:, 0]:
                    out.write((line + "\n").encode("latin-1"))
        store.move(draft, target)
        yield pd.DataFrame({"file": [target]})

    lines.mapInPandas(pack, "file string").count()
    return folder


def land_archives(lines: DataFrame, folder: str, member: str) -> str:
    """Zip a one-column table of lines, one archive per task, one member in each."""

    def pack(batches):
        import uuid as ids
        import zipfile

        import pandas as pd
        from pyarrow import fs
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        scheme, colon, rest = folder.partition(":")
        if colon and rest.startswith("//"):
            store, base = fs.FileSystem.from_uri(folder)
        else:
            store, base = fs.LocalFileSystem(), "/" + (rest if colon else folder).lstrip("/")
        store.create_dir(base, recursive=True)
        target = f"{base}/dump{number:05d}.zip"
        draft = f"{target}.{ids.uuid4().hex}.part"
        with store.open_output_stream(draft) as sink:
            with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as zipped:
                zipped.writestr("LEIAME.txt", "not a table")
                with zipped.open(f"K.Y{number}.D0{member}", "w", force_zip64=True) as out:
                    for batch in batches:
                        for line in batch.iloc[:, 0]:
                            out.write((line + "\n").encode("latin-1"))
        store.move(draft, target)
        yield pd.DataFrame({"archive": [target]})

    lines.mapInPandas(pack, "archive string").count()
    return folder
