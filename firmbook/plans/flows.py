"""From landed dumps to stored, enriched and typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.functions.values import (
    amount_or_zero,
    compact_date,
    establishment_key,
)
from firmbook.layout import (
    COMPANIES,
    COMPANY_TABLE,
    ESTABLISHMENT_TABLE,
    ESTABLISHMENTS,
    PARTNERS,
)
from firmbook.operators.conform import conform
from firmbook.operators.enrich import join_lookup, join_lookups
from firmbook.operators.sinks import write_parquet
from firmbook.operators.storage import compression_ratio, dataset_bytes, dataset_names
from firmbook.operators.versions import WHOLE, replace_part
from firmbook.sources.accounting import accounted_ingest
from firmbook.sources.dumps import read_dump
from firmbook.sources.lookups import qualification_lookup, reason_lookup, size_lookup
from firmbook.sources.tables import read_lenient_csv, read_table, read_table_csv


def ingest_companies(
    spark: SparkSession, paths, target: str, month: str | None = None, **options
) -> DataFrame:
    """Store company dumps as Parquet, see :func:`_ingest`."""
    return _ingest(spark, paths, COMPANIES, target, month, options)


def ingest_establishments(
    spark: SparkSession, paths, target: str, month: str | None = None, **options
) -> DataFrame:
    """Store establishment dumps as Parquet, see :func:`_ingest`."""
    return _ingest(spark, paths, ESTABLISHMENTS, target, month, options)


def ingest_partners(
    spark: SparkSession, paths, target: str, month: str | None = None, **options
) -> DataFrame:
    """Store partner dumps as Parquet, see :func:`_ingest`."""
    return _ingest(spark, paths, PARTNERS, target, month, options)


def enrich_companies(
    companies: DataFrame, legal_natures: DataFrame, sizes: DataFrame | None = None
) -> DataFrame:
    """Add the labels of company size and legal nature."""
    sized = _join_own(companies, "porte_empresa", sizes, size_lookup)
    return join_lookup(sized, "natureza_juridica", legal_natures)


def enrich_establishments(
    establishments: DataFrame,
    cities: DataFrame,
    activities: DataFrame,
    countries: DataFrame,
    reasons: DataFrame | None = None,
) -> DataFrame:
    """Add the full id and the labels of city, activity, country and status reason."""
    labelled = join_lookups(
        establishments.withColumn("CNPJ", establishment_key()),
        {"municipio": cities, "cnae_fiscal_principal": activities, "pais": countries},
    )
    return _join_own(labelled, "motivo_situacao_cadastral", reasons, reason_lookup)


def enrich_partners(
    partners: DataFrame, countries: DataFrame, qualifications: DataFrame | None = None
) -> DataFrame:
    """Add the labels of qualification and country."""
    labelled = _join_own(partners, "qualificacao_socio", qualifications, qualification_lookup)
    return join_lookup(labelled, "pais", countries)


def _join_own(facts: DataFrame, column: str, given: DataFrame | None, own) -> DataFrame:
    """Join the given lookup, or the one this package carries."""
    if given is None:
        return join_lookup(facts, column, own(facts.sparkSession), literal=True)
    return join_lookup(facts, column, given)


# The tables whose files are known to hold uneven rows, and the one that does not.
_LENIENT = ("empresas", "socios")
_STRICT = ("estabelecimentos",)


def csv_to_parquet(
    spark: SparkSession,
    csv_root: str,
    parquet_root: str,
    encodings: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Convert the CSV tables ``<root>/<table>`` to Parquet; return the bytes saved.

    Tables: ``empresas``, ``estabelecimentos``, ``socios``, plain or enriched:
    the columns are those of the files' header, all as text. Files of one table
    must agree in it. Of the first and last, rows longer than the header are
    dropped, of the other one ends the conversion with an error. A table that is
    absent is passed over.
    """
    encodings = encodings or {}
    present = dataset_names(spark, csv_root)
    for table in (*_LENIENT, *_STRICT):
        if table not in present:
            continue
        source = {"path": f"{csv_root}/{table}", "multi_line": multi_line}
        source["encoding"] = encodings.get(table, "UTF-8")
        if table in _LENIENT:
            df = read_lenient_csv(spark, **source)
        else:
            df = read_table_csv(spark, **source, null_tokens=("",))
        write_parquet(df, f"{parquet_root}/{table}")
    return compression_ratio(
        dataset_bytes(spark, csv_root), dataset_bytes(spark, parquet_root)
    )


def load_companies(companies: DataFrame) -> DataFrame:
    """The typed company table as the database takes it (its id is given there)."""
    return conform(
        companies.select(
            "cnpj_basico",
            F.coalesce("razao_social", F.lit("")).alias("razao_social"),
            "natureza_juridica",
            "qualificacao_responsavel",
            amount_or_zero("capital_social").alias("capital_social"),
            "porte_empresa",
        ),
        COMPANY_TABLE,
    )


def load_establishments(establishments: DataFrame) -> DataFrame:
    """The typed establishment table as the database takes it (its id is given there)."""
    return conform(
        establishments.select(
            establishment_key().alias("cnpj_completo"),
            "cnpj_basico",
            "nome_fantasia",
            "situacao_cadastral",
            compact_date("data_situacao_cadastral").alias("data_situacao_cadastral"),
            "cnae_fiscal_principal",
            "logradouro",
            "numero",
            "bairro",
            "cep",
            "uf",
            "municipio",
            "email",
        ),
        ESTABLISHMENT_TABLE,
    )


def _ingest(
    spark: SparkSession, paths, columns, target: str, month: str | None, options
) -> DataFrame:
    """Read dumps (``options`` are those of ``read_dump``), store them, return the table.

    The table is replaced whole or not at all: until its last row is written,
    and if the write fails, readers see what was there (``operators.versions``).
    With ``month`` (``yyyy-MM``) the table has a part for each ``mes`` and only
    this one is replaced, for ``latest_partition`` to choose from. Nothing is
    shuffled. With the option ``file_column`` the table keeps the file of each
    row, and ``rows_per_file`` on that column tells how many rows of each file
    were kept. With the option ``dropped`` (a folder) the lines that are not
    kept go to a table there with their file, in parts alike, out of the same
    parse, and the manifest's notes state the rows read, kept and dropped.
    """
    dropped = options.pop("dropped", None)
    part = (WHOLE, None) if month is None else (month, "mes")
    if dropped is None:
        replace_part(read_dump(spark, paths, columns, **options), target, *part)
    else:
        accounted_ingest(spark, paths, columns, target, dropped, *part, **options)
    return read_table(spark, target)
