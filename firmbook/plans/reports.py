"""The named analytic reports.

Filters take the value as stored: the label by default, or the code when a
table was not decoded. Ties are broken by the group key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmbook.functions.values import company_key, decimal_comma, round_places
from firmbook.layout import (
    ACTIVE,
    COMPANY_SIZES,
    HEAD_OFFICE,
    LEGAL_PERSON,
    MICRO_COMPANY,
    SIZE_UNKNOWN,
)
from firmbook.operators.aggregates import listagg_distinct

# A report up to this many groups long is sent to every executor.
BROADCAST_GROUPS = 10_000


def corporate_groups(
    partners: DataFrame,
    companies: DataFrame,
    legal_person: str = LEGAL_PERSON,
    min_companies: int = 2,
    limit: int = 100,
) -> DataFrame:
    """Controllers (legal-person partners) of at least ``min_companies`` companies.

    Names and ids of the companies are each listed sorted, so their positions
    do not match. The winners are found first, by counting alone; texts are
    built for no one else. Ownership is made distinct before it is counted, so
    a controller with a large part of all rows is counted from partial counts.
    """
    owner = ["cnpj_cpf_socio", "nome_socio"]
    owned = partners.where(F.col("identificador_socio") == legal_person).select(
        *owner, "cnpj_basico"
    )
    winners = (
        owned.distinct()
        .join(companies.select("cnpj_basico"), "cnpj_basico", "left_semi")
        .groupBy(*owner)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_companies)
        .orderBy(F.desc("n"), *owner)
        .limit(limit)
        .select(F.col(owner[0]).alias("_id"), F.col(owner[1]).alias("_name"))
    )
    if limit <= BROADCAST_GROUPS:
        winners = F.broadcast(winners)
    same_owner = F.col(owner[0]).eqNullSafe(F.col("_id")) & F.col(owner[1]).eqNullSafe(
        F.col("_name")
    )
    members = owned.join(winners, same_owner, "left_semi").join(
        companies.select("cnpj_basico", "razao_social"), "cnpj_basico"
    )
    listed = listagg_distinct(members, owner, ["razao_social", "cnpj_basico"])
    return listed.select(
        F.col("cnpj_cpf_socio").alias("cnpj_controladora"),
        F.col("nome_socio").alias("nome_controladora"),
        F.col("n_cnpj_basico").alias("qtd_empresas_controladas"),
        F.col("razao_social").alias("empresas_controladas"),
        F.col("cnpj_basico").alias("cnpjs_controlados"),
    ).orderBy(F.desc("qtd_empresas_controladas"), "cnpj_controladora", "nome_controladora")


def companies_by_size_and_state(
    establishments: DataFrame,
    companies: DataFrame,
    head_office: str = HEAD_OFFICE,
    size_unknown: str = SIZE_UNKNOWN,
    size_column: str = "porte_empresa",
) -> DataFrame:
    """Head offices per state and company size, with the mean capital."""
    head_offices = establishments.where(F.col("identificador_matriz") == head_office)
    sized = companies.where(
        (F.col(size_column) != size_unknown) & F.col("capital_social").isNotNull()
    )
    return (
        head_offices.select(_company_of(establishments).alias("cnpj_basico"), "uf")
        .join(sized.select("cnpj_basico", size_column, "capital_social"), "cnpj_basico")
        .groupBy("uf", size_column)
        .agg(
            F.count("*").alias("quantidade"),
            round_places(F.avg(decimal_comma("capital_social"))).alias("capital_medio"),
        )
        .orderBy("uf", F.desc("quantidade"), size_column)
    )


def top_activities(
    establishments: DataFrame, active: str = ACTIVE, limit: int = 50
) -> DataFrame:
    """Main activities by number of active establishments, with distinct companies."""
    activity = "cnae_fiscal_principal"
    return (
        establishments.where(
            F.col(activity).isNotNull() & (F.col("situacao_cadastral") == active)
        )
        .groupBy(activity)
        .agg(
            F.count("*").alias("quantidade_empresas"),
            F.count_distinct(_company_of(establishments)).alias("quantidade_cnpjs_basicos"),
        )
        .orderBy(F.desc("quantidade_empresas"), activity)
        .limit(limit)
    )


def companies_by_size(companies: DataFrame, size_column: str = "porte_empresa") -> DataFrame:
    """Companies per size, most frequent first."""
    return (
        companies.groupBy(size_column)
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), size_column)
    )


def top_qualifications(companies: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent qualifications of the responsible person."""
    qualification = "qualificacao_responsavel"
    return (
        companies.where(F.col(qualification).isNotNull())
        .groupBy(qualification)
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), qualification)
        .limit(limit)
    )


def total_count(table: DataFrame) -> DataFrame:
    """Rows of a table."""
    return table.agg(F.count("*").alias("total"))


def count_by_size(
    companies: DataFrame, size: str = MICRO_COMPANY, size_column: str = "porte_empresa"
) -> DataFrame:
    """Rows of one company size.

    On a table that holds codes, pass ``size_code(label)``: the filter then
    reaches the scan, as no lookup stands between.
    """
    return total_count(companies.where(F.col(size_column) == size))


def size_code(label: str) -> str:
    """The code of a company size."""
    return next(code for code, own in COMPANY_SIZES if own == label)


def _company_of(establishments: DataFrame) -> Column:
    # The plain column keeps bucketing and statistics usable; the id prefix
    # serves tables that carry only the full id.
    if "cnpj_basico" in establishments.columns:
        return F.col("cnpj_basico")
    return company_key("CNPJ")
