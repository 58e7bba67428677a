"""Dumps whose quoted fields hold line breaks, read by many tasks a file.

Whether a line begins inside quotes follows from the number of quotes before it
in its file, odd or even. A first pass counts them for each range of bytes that
Spark gives to a task; the counts before a range, a row for each, tell how the
range begins. In the second pass a task puts the lines of a range together to
records; what begins in one range and ends in another is joined from its pieces,
two a range at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmbook.layout import DUMP_ENCODING, DUMP_SEPARATOR, NULL_TOKENS
from firmbook.operators.enrich import fits_broadcast
from firmbook.sources.dumps import dump_options, dump_schema, tidy_dump

#: Pieces of records: all of it, its begin, a range within it, its end.
WHOLE, BEGIN, WITHIN, END = range(4)


def read_split_dump(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    file_column: str | None = None,
) -> DataFrame:
    """As ``read_dump`` with ``multi_line``, of files that are split over tasks.

    Quotes stand around fields and doubled within them, nowhere else; a line
    ends with a line feed. A quote that is never closed takes what follows it in
    the file into one record. The encoding holds ASCII as single bytes.
    """
    lines = _lines(spark, paths)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "range").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "range", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    near = F.broadcast(ranges) if fits_broadcast(ranges.select("file"), max_rows=2_000_000, max_bytes=256 << 20)[0] else None
    if near is None:
        raise ValueError("more ranges of bytes than can be sent to all tasks; raise spark.sql.files.maxPartitionBytes")
    # The few ranges come to the lines, so these stay in the order of their file.
    begun = lines.join(near, ["file", "range"]).select("file", "range", "inside", F.col("value").cast("binary").alias("line"))
    pieces = begun.mapInArrow(_pieces, "file string, range long, kind int, record binary")
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "record")
    texts = whole.unionByName(_joined(pieces.where(F.col("kind") != WHOLE)))

    options = {k: v for k, v in dump_options(sep, encoding, multi_line=True).items() if k not in ("header", "encoding")}
    name = file_column or "_file"
    record = F.decode(F.col("record"), encoding)
    schema = ", ".join(f"`{f.name}` string" for f in dump_schema(columns).fields)
    raw = texts.select(F.col("file").alias(name), F.from_csv(record, schema, options).alias("row")).select("row.*", name)
    return tidy_dump(raw, columns, sep, null_tokens, others=[file_column] if file_column else [])


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their file and the range of bytes that they are read in."""
    read = spark.read.option("lineSep", "\n").text([paths] if isinstance(paths, str) else list(paths))
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records, and pieces of records, that the lines of each range make up."""
    key, inside, held, kind, out = None, False, [], WHOLE, []

    def ended(own: int) -> None:
        out.append((*key, own, b"\n".join(held)))
        held.clear()

    def sent() -> pa.RecordBatch:
        types = {"file": pa.string(), "range": pa.int64(), "kind": pa.int32(), "record": pa.binary()}
        columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(types.values())]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=list(types))

    for batch in batches:
        for file, start, begins, line in zip(*(batch.column(c).to_pylist() for c in ("file", "range", "inside", "line"))):
            if (file, start) != key:
                if held:
                    ended(BEGIN if kind == WHOLE else WITHIN)
                key, inside, kind = (file, start), begins, END if begins else WHOLE
            was = inside
            if line.count(b'"') % 2:
                inside = not inside
            if not was and not inside and not line.strip(bytes(range(33))):
                continue  # a blank line between records
            held.append(line)
            if not inside:
                ended(kind)
                kind = WHOLE
        if out:
            yield sent()
    if held:
        ended(BEGIN if kind == WHOLE else WITHIN)
    if out:
        yield sent()


def _joined(pieces: DataFrame) -> DataFrame:
    """The records whose pieces lie in several ranges."""
    # The end of a record stands before the begin of the next one in a range.
    order = Window.partitionBy("file").orderBy("range", F.when(F.col("kind") == BEGIN, 1).otherwise(0))
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == BEGIN).cast("int")).over(order))
    held = F.sort_array(F.collect_list(F.struct("range", "record")))
    gathered = numbered.groupBy("file", "number").agg(held.alias("parts"))
    parts = F.transform("parts", lambda p: F.hex(p["record"]))
    return gathered.select("file", F.unhex(F.array_join(parts, "0A")).alias("record"))
