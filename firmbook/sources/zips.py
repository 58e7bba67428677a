"""Dumps read straight out of their archives, without a landed copy."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from firmbook.layout import DUMP_ENCODING, DUMP_SEPARATOR, NULL_TOKENS
from firmbook.sources.archives import qualified, refuse_unknown
from firmbook.sources.dumps import dump_options, dump_schema, tidy_dump

FORMAT = "zip_lines"
#: Lines of an Arrow batch.
BATCH_LINES = 32_768


def read_zips(
    spark: SparkSession,
    paths: str | Sequence[str],
    suffix: str,
    columns: Sequence[str],
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    skip_failed_files: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """Read the archive members whose name ends in ``suffix`` (any case) as one all-text table.

    As :func:`read_dump` of the unpacked members: the same rows are kept. Each
    member is a partition and streamed from its archive whenever the table is
    computed, so a lost task reads it again; nothing is written. A damaged
    archive ends the read, or with ``skip_failed_files`` is passed over; one that
    breaks off within a member gives none of that member's rows to a finished
    table without the option. ``file_column`` adds archive and member of a row.
    """
    for path in [paths] if isinstance(paths, str) else paths:
        refuse_unknown(qualified(spark, path))
    # The listing is Spark's: globs and folders mean what they mean elsewhere.
    listed = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path")
    archives = sorted(row["path"] for row in listed.collect())
    spark.dataSource.register(_source())
    lines = (
        spark.read.format(FORMAT)
        .options(archives=json.dumps(archives), suffix=suffix, encoding=encoding, skip=str(skip_failed_files).lower())
        .load()
    )
    # As the file reader does, lines without a visible character are no rows.
    lines = lines.where(F.col("line").rlike(r"[^\x00-\x20]"))
    options = {k: v for k, v in dump_options(sep, encoding).items() if k not in ("header", "multiLine", "encoding")}
    parsed = F.from_csv("line", dump_schema(columns).simpleString()[len("struct<") : -1].replace(":", " "), options)
    raw = lines.select(F.concat_ws("!", "archive", "member").alias(file_column or "_member"), parsed.alias("row"))
    raw = raw.select("row.*", file_column or "_member")
    return tidy_dump(raw, columns, sep, null_tokens, others=[file_column] if file_column else [])


def _source():
    """The data source, complete in itself so that executors need no package."""
    batch_lines = BATCH_LINES

    class Member(InputPartition):
        def __init__(self, archive, member, error=None):
            self.archive, self.member, self.error = archive, member, error

    def opened(location):
        from pyarrow import fs

        scheme, _, rest = location.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        store, name = fs.FileSystem.from_uri(f"{scheme}:{rest}")
        return store.open_input_file(name)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.archives, self.suffix = json.loads(options["archives"]), options["suffix"].upper()
            self.encoding, self.skip = options["encoding"], options.get("skip") == "true"

        def partitions(self):
            import zipfile

            found = []
            for archive in self.archives:
                try:
                    with opened(archive) as file, zipfile.ZipFile(file) as zipped:
                        names = [i.filename for i in zipped.infolist() if i.filename.upper().endswith(self.suffix)]
                    found += [Member(archive, name) for name in names]
                except OSError:
                    raise
                except Exception as damage:
                    found.append(Member(archive, None, f"{type(damage).__name__}: {damage}"))
            return found or [Member(None, None)]

        def read(self, partition):
            import io
            import zipfile

            import pyarrow as pa

            if partition.archive is None:
                return
            if partition.error:
                if self.skip:
                    return
                raise ValueError(f"{partition.archive}: {partition.error}")

            def batch(lines):
                n = len(lines)
                columns = [pa.array([partition.archive] * n), pa.array([partition.member] * n), pa.array(lines, pa.string())]
                return pa.RecordBatch.from_arrays(columns, names=["archive", "member", "line"])

            held = []
            try:
                with opened(partition.archive) as file, zipfile.ZipFile(file) as zipped, zipped.open(partition.member) as raw:
                    # \n, \r and \r\n end a line, as they do for Spark's reader.
                    for line in io.TextIOWrapper(raw, encoding=self.encoding, errors="replace", newline=None):
                        held.append(line.removesuffix("\n"))
                        if len(held) >= batch_lines:
                            yield batch(held)
                            held = []
            except zipfile.BadZipFile:
                if not self.skip:
                    raise
            if held:
                yield batch(held)

    class ZipLines(DataSource):
        @classmethod
        def name(cls):
            return "zip_lines"

        def schema(self):
            return "archive string, member string, line string"

        def reader(self, schema):
            return Reader(self.options)

    return ZipLines
