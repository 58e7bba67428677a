"""Reading tables that carry their own header or schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmbook.layout import NULL_TOKENS, text_schema
from firmbook.operators.versions import is_versioned, read_version
from firmbook.sources.dumps import RAW_LINE, dump_options, dump_schema, has_extra_fields, nullify_tokens, tidy_dump


def header_columns(
    spark: SparkSession, path: str | Sequence[str], sep: str = ";", encoding: str = "UTF-8"
) -> list[str]:
    """Column names as the header of a CSV table states them."""
    options = {"header": True, "sep": sep, "encoding": encoding, "escape": '"'}
    return spark.read.options(**options).csv(_paths(path)).columns


def read_table_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV table with header, every column as text; null tokens become null.

    ``columns`` are chosen by the names in the header, in any order; all of them
    if it is not given. The files of one table must have the same header. A row
    shorter than the header is filled with null, a longer one ends the read with
    an error that shows it: nothing of a row is cut off unseen. Texts with line
    breaks need ``multi_line``, which makes a file unsplittable.
    """
    names = header_columns(spark, path, sep, encoding)
    raw = (
        spark.read.schema(dump_schema(names))
        .options(**dump_options(sep, encoding, multi_line, header=True), enforceSchema=False)
        .csv(_paths(path))
    )
    shown = F.concat(F.lit(f"longer than the header of {len(names)} columns: "), F.substring(RAW_LINE, 1, 500))
    checked = F.when(has_extra_fields(names, sep), F.raise_error(shown).cast("boolean")).otherwise(True)
    kept = raw.where(checked)
    return nullify_tokens(kept.select(*_chosen(names, columns)), null_tokens)


def read_lenient_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV table with header, passing over what does not fit.

    As :func:`read_table_csv`, but rows shorter than the header are filled with
    null and rows longer than the header are dropped.
    """
    names = header_columns(spark, path, sep, encoding)
    raw = (
        spark.read.schema(dump_schema(names))
        .options(**dump_options(sep, encoding, multi_line, header=True), enforceSchema=False)
        .csv(_paths(path))
    )
    return tidy_dump(raw, names, sep, null_tokens=("",)).select(*_chosen(names, columns))


def _paths(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def _chosen(names: Sequence[str], columns: Sequence[str] | None) -> Sequence[str]:
    missing = [c for c in columns or () if c not in names]
    if missing:
        raise ValueError(f"the header has no {', '.join(missing)}")
    return names if columns is None else columns


def read_inferred_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    keep_text: Sequence[str] = (),
    sep: str = ";",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV table with header, types inferred from all rows.

    Inference would turn the code ``00000001`` into the number 1; name such
    columns in ``keep_text``. It costs a pass over the data: where the columns
    are known, prefer :func:`read_table_csv`.
    """
    path = _paths(path)
    options = {
        "header": True,
        "sep": sep,
        "encoding": encoding,
        "escape": '"',
        "multiLine": multi_line,
    }
    inferred = spark.read.options(inferSchema=True, **options).csv(path).schema
    schema = T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in keep_text else f
            for f in inferred.fields
        ]
    )
    return spark.read.schema(schema).options(**options).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table, of one with versions the current one."""
    return read_version(spark, path) if is_versioned(spark, path) else spark.read.parquet(path)
