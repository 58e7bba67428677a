"""Taking in new dump files as they land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from firmbook.layout import DUMP_ENCODING, DUMP_SEPARATOR, NULL_TOKENS
from firmbook.sources.dumps import dump_options, dump_schema, tidy_dump


def incremental_ingest(
    spark: SparkSession,
    landing: str,
    columns: Sequence[str],
    target: str,
    checkpoint: str,
    sep: str = DUMP_SEPARATOR,
    encoding: str = DUMP_ENCODING,
    null_tokens: Sequence[str] = NULL_TOKENS,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append dump files that landed since the last run to a Parquet table, then stop.

    The checkpoint remembers the files already taken, so a second run without
    new files adds nothing. A file must not be rewritten in place.
    """
    reader = spark.readStream.schema(dump_schema(columns)).options(
        **dump_options(sep, encoding)
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    rows = tidy_dump(reader.csv(landing), columns, sep, null_tokens)
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
