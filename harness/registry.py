"""Registry tables derived from the given tables, for queries, tests and bench.

customer -> companies, orders -> establishments, lineitem -> partners, nation
and part -> lookups. Every row of a given table becomes one row. Keys are
written in base 36 to stay unique within eight characters at any scale.

Each derivation is a list of (column, Spark expression, DuckDB expression);
where one text serves both engines the second is left out.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from firmbook.layout import COMPANY_SIZES, QUALIFICATIONS, STATUS_REASONS

_NONE = "cast(null as string)"


def _base36(number: str, width: int) -> tuple[str, str]:
    return (
        f"lpad(conv(cast({number} as string), 10, 36), {width}, '0')",
        f"to_base({number}, 36, {width})",
    )


def _digits(number: str, width: int) -> tuple[str]:
    return (f"lpad(cast({number} as string), {width}, '0')",)


def _day(column: str) -> tuple[str, str]:
    return f"date_format({column}, 'yyyyMMdd')", f"strftime({column}, '%Y%m%d')"


def _case(column: str, **values: str) -> tuple[str]:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in values.items())
    return (f"case {column} {arms} end",)


_STATES = "ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETO"

COMPANY_COLUMNS = [
    ("cnpj_basico", *_base36("c_custkey", 8)),
    ("razao_social", "'Comércio \"' || c_name || '\"; Ltda'"),
    ("natureza_juridica", *_digits("c_nationkey", 4)),
    ("qualificacao_responsavel", "nullif(lpad(cast(c_custkey % 80 as string), 2, '0'), '00')"),
    (
        "capital_social",
        "case when c_acctbal >= 0 then replace(cast(cast(c_acctbal as decimal(15,2)) as string), '.', ',') end",
    ),
    (
        "porte_empresa",
        *_case("c_mktsegment", AUTOMOBILE="00", BUILDING="01", FURNITURE="03", HOUSEHOLD="05"),
    ),
    ("ente_federativo_responsavel", _NONE),
]

ESTABLISHMENT_COLUMNS = [
    ("cnpj_basico", *_base36("o_custkey", 8)),
    ("cnpj_ordem", *_base36("o_orderkey % 1679616", 4)),
    ("cnpj_dv", *_digits("o_orderkey % 97", 2)),
    # Codes that reports filter on are the given ones, so the filter reaches the scan.
    ("identificador_matriz", "o_orderpriority"),
    ("nome_fantasia", "case when o_orderstatus <> 'P' then 'Loja São José ' || cast(o_orderkey as string) end"),
    ("situacao_cadastral", "o_orderstatus"),
    (
        "data_situacao_cadastral",
        *(f"case when o_orderstatus = 'P' then '0' else {day} end" for day in _day("o_orderdate")),
    ),
    ("motivo_situacao_cadastral", *_digits("o_orderkey % 85", 2)),
    ("nome_da_cidade_no_exterior", _NONE),
    ("pais", "case when o_orderpriority = '5-LOW' then lpad(cast(o_custkey % 30 as string), 3, '0') end"),
    ("data_inicio_atividade", *_day("o_orderdate")),
    ("cnae_fiscal_principal", "nullif(lpad(cast(o_orderkey % 53 as string), 7, '0'), '0000000')"),
    ("tipo_logradouro", "'RUA'"),
    ("logradouro", "'Rua da Glória ' || o_orderpriority"),
    ("numero", "cast(o_orderkey as string)"),
    ("complemento", _NONE),
    ("bairro", "'CENTRO'"),
    ("cep", *_digits("o_orderkey * 7 % 100000000", 8)),
    ("uf", f"substring('{_STATES}', cast(o_custkey % 27 as int) * 2 + 1, 2)"),
    ("municipio", *_digits("o_custkey % 25", 4)),
    ("ddd1", "'11'"),
    ("telefone1", *_digits("o_orderkey % 100000000", 8)),
    ("ddd2", _NONE),
    ("telefone2", _NONE),
    ("dddfax", _NONE),
    ("fax", _NONE),
    ("email", "'contato' || cast(o_orderkey as string) || '@exemplo.br'"),
    ("situacao_especial", _NONE),
    ("data_situacao_especial", _NONE),
    ("cnae_fiscal_secundario", "'0000001,0000002'"),
]

PARTNER_COLUMNS = [
    ("cnpj_basico", *_base36("l_partkey", 8)),
    ("identificador_socio", "l_returnflag"),
    ("nome_socio", "'Sócio ' || cast(l_suppkey as string)"),
    ("cnpj_cpf_socio", "case when l_linenumber < 7 then lpad(cast(l_suppkey as string), 14, '0') end"),
    ("qualificacao_socio", *_digits("cast(l_quantity as int)", 2)),
    ("data_entrada_sociedade", *_day("l_shipdate")),
    ("pais", "case when l_tax > 0.04 then lpad(cast(l_suppkey % 30 as string), 3, '0') end"),
    ("representante_legal", "'***000000**'"),
    ("nome_do_representante", _NONE),
    ("qualificacao_representante", "'00'"),
    ("faixa_etaria", "cast(l_linenumber as string)"),
]

DOMAIN = [
    ("identificador_matriz", "1-URGENT", "MATRIZ"),
    ("identificador_matriz", "2-HIGH", "FILIAL"),
    ("identificador_matriz", "3-MEDIUM", "FILIAL"),
    ("situacao_cadastral", "F", "ATIVA"),
    ("situacao_cadastral", "O", "BAIXADA"),
    ("identificador_socio", "A", "PESSOA JURÍDICA"),
    ("identificador_socio", "N", "PESSOA FÍSICA"),
    *(("porte_empresa", code, label) for code, label in COMPANY_SIZES),
]

_VIEWS = {
    "companies": ("customer", COMPANY_COLUMNS),
    "establishments": ("orders", ESTABLISHMENT_COLUMNS),
    "partners": ("lineitem", PARTNER_COLUMNS),
    "legal_natures": (
        "nation",
        [("codigo", *_digits("n_nationkey", 4)), ("descricao", "'Natureza ' || n_name")],
    ),
    "cities": (
        "nation",
        [("codigo", *_digits("n_nationkey", 4)), ("descricao", "'São ' || n_name")],
    ),
    "countries": (
        "nation",
        [("codigo", *_digits("n_nationkey", 3)), ("descricao", "'País ' || n_name")],
    ),
    # Has a row per part and so repeated codes: a lookup that grows with the data.
    "activities": (
        "part",
        [("codigo", *_digits("p_size", 7)), ("descricao", "'Atividade ' || p_name")],
    ),
}


_VALUES = {
    "sizes": ("codigo, descricao", COMPANY_SIZES),
    "reasons": ("codigo, descricao", STATUS_REASONS),
    "qualifications": ("codigo, descricao", QUALIFICATIONS),
    "domain": ("coluna, codigo, descricao", DOMAIN),
}


def _row(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


class Tables:
    """The given and the derived tables under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derive(self, view: str) -> DataFrame:
        source, columns = _VIEWS[view]
        return self.given(source).selectExpr(*(f"{c[1]} as {c[0]}" for c in columns))

    companies = cached_property(lambda self: self.derive("companies"))
    establishments = cached_property(lambda self: self.derive("establishments"))
    partners = cached_property(lambda self: self.derive("partners"))
    legal_natures = cached_property(lambda self: self.derive("legal_natures"))
    cities = cached_property(lambda self: self.derive("cities"))
    countries = cached_property(lambda self: self.derive("countries"))
    activities = cached_property(lambda self: self.derive("activities"))

    @cached_property
    def domain(self) -> DataFrame:
        return self.spark.sql(view_sql("domain"))


def view_sql(view: str) -> str:
    """The derivation of a view as DuckDB SQL."""
    if view in _VALUES:
        names, rows = _VALUES[view]
        return f"select * from (values {', '.join(map(_row, rows))}) as t({names})"
    source, columns = _VIEWS[view]
    listed = ", ".join(f"{c[-1]} as {c[0]}" for c in columns)
    return f"select {listed} from {source}"


def with_views(body: str, *views: str) -> str:
    """``body`` as DuckDB SQL that may use the named views."""
    if not views:
        return body
    return "with " + ",\n".join(f"{v} as ({view_sql(v)})" for v in views) + "\n" + body
