"""Ingest that accounts for every line: kept, or dropped and shown."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from firmbook.layout import DUMP_ENCODING, DUMP_SEPARATOR, NULL_TOKENS
from firmbook.operators.versions import WHOLE, new_folder, publish_part, replace_part
from firmbook.sources.dumps import RAW_LINE, dump_options, dump_schema, has_extra_fields, nullify_tokens

FILE, LINES = "_file", "lines"


def accounted_ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    target: str,
    dropped: str,
    part: str = WHOLE,
    part_column: str | None = None,
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    skip_failed_files: bool = False,
    multi_line: bool = False,
    file_column: str | None = None,
) -> dict:
    """Store dumps in a table with versions, and the lines it does not keep in another; return the account.

    The dumps are parsed and written once: kept and dropped lines side by side,
    the former where the table has its files. The dropped lines are published
    first, so whoever sees the rows can see what is not among them; that table
    has `file` and `line`. The account, also in the notes of both parts, has the
    lines read, kept and dropped, counted as they were written. It is compared
    with what the files hold, and nothing is published if they differ.
    """
    raw = (
        spark.read.schema(dump_schema(columns))
        .options(**dump_options(sep, encoding, multi_line, skip_failed_files))
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    gone = has_extra_fields(columns, sep)
    lines = raw.withColumns({FILE: F.col("_metadata.file_path"), LINES: F.when(gone, "dropped").otherwise("kept")})
    lines = nullify_tokens(lines, null_tokens, columns).withColumnRenamed(FILE, file_column or FILE)

    seen = Observation(f"lines-{uuid.uuid4().hex}")
    is_dropped = (F.col(LINES) == "dropped").cast("long")
    counted = lines.observe(seen, F.count(F.lit(1)).alias("read"), F.coalesce(F.sum(is_dropped), F.lit(0)).alias("dropped"))
    place = new_folder(part, part_column)
    folder = f"{target.rstrip('/')}/{place}"
    with _both_writers_open(spark):
        counted.write.option("compression", "zstd").partitionBy(LINES).parquet(folder)
    account = {"read": int(seen.get["read"]), "dropped": int(seen.get["dropped"])}
    account["kept"] = account["read"] - account["dropped"]

    stored = spark.read.schema(lines.schema).parquet(folder)
    found = {row[LINES]: row["n"] for row in stored.groupBy(LINES).agg(F.count("*").alias("n")).collect()}
    if (found.get("kept", 0), found.get("dropped", 0)) != (account["kept"], account["dropped"]):
        raise ValueError(f"{folder} holds {found}, but the lines written were {account}")

    faulty = stored.where(F.col(LINES) == "dropped").select(F.col(file_column or FILE).alias("file"), F.col(RAW_LINE).alias("line"))
    replace_part(faulty, dropped, part, part_column, account)
    names = [*columns, *([file_column] if file_column else [])]
    if account["kept"]:
        publish_part(spark, target, f"{place}/{LINES}=kept", part, part_column, account, lines.select(*names).schema)
    else:
        replace_part(stored.select(*names).limit(0), target, part, part_column, account)
    return account


@contextmanager
def _both_writers_open(spark: SparkSession):
    """With both files of a task open at once, its lines need no sort to part them."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "2")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
