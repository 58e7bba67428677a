"""The registered queries, each with the DuckDB SQL that must give the same result."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmbook.functions.values import (
    amount_or_zero,
    clip_text,
    company_key,
    compact_date,
    conform_value,
    decimal_comma,
    establishment_key,
    round_places,
)
from firmbook.layout import (
    COMPANIES,
    COMPANY_MEMBER,
    COMPANY_TABLE,
    ESTABLISHMENTS,
    PARTNERS,
)
from firmbook.operators.aggregates import duplicate_count, listagg_distinct, max_length, null_count
from firmbook.operators.enrich import decode_codes, join_lookup, join_lookups
from firmbook.operators.indexes import lookup, write_indexed
from firmbook.operators.keys import append_load, read_loads, surrogate_key
from firmbook.operators.sinks import save_table, write_csv, write_parquet
from firmbook.operators.storage import compression_ratio, dataset_bytes
from firmbook.operators.versions import manifest, replace_part
from firmbook.plans import flows, quality, reports
from firmbook.plans.footers import footer_null_profile
from firmbook.sources.archives import unpack_zips
from firmbook.sources.dumps import nullify_tokens, read_dump, rows_per_file
from firmbook.sources.encodings import read_any_dump, repaired
from firmbook.sources.evidence import read_evident_csv
from firmbook.sources.lookups import read_lookup, size_lookup
from firmbook.sources.records import read_split_dump
from firmbook.sources.snapshots import latest_partition, latest_snapshot
from firmbook.sources.tables import (
    read_inferred_csv,
    read_lenient_csv,
    read_table,
    read_table_csv,
)
from firmbook.sources.zips import read_zips
from firmbook.streaming.ingest import incremental_ingest
from firmbook.streaming.ledger import ledger_ingest, read_ingested
from harness.landing import (
    dump_line,
    land_archives,
    land_bytes,
    land_dump,
    land_gzip,
    land_lines,
    scratch,
)
from harness.registry import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, views: str = "", name: str | None = None):
    """Register ``function(tables)`` under its name, with its SQL over ``views``."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLE[key] = with_views(sql, *views.split())
        return function

    return register


ALL_COMPANIES = "select * from companies"

# --- sources ----------------------------------------------------------------


@query(ALL_COMPANIES, "companies")
def src_headerless_csv(t):
    path = land_dump(t.companies, scratch(t.spark))
    return read_dump(t.spark, path, COMPANIES)


@query(
    """select cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel,
              capital_social, nullif(porte_empresa, '01') as porte_empresa,
              ente_federativo_responsavel
       from companies where porte_empresa in ('00', '01', '05')""",
    "companies",
)
def src_skip_bad_lines(t):
    # Small companies get fields too many, those of unknown size a blank one
    # too many, micro companies lack the last two fields.
    size = F.col("porte_empresa")
    lines = t.companies.select(
        F.when(size == "03", dump_line(t.companies, extra=';"x";"y"'))
        .when(size.isNull(), dump_line(t.companies, extra=";"))
        .when(size == "01", dump_line(t.companies, COMPANIES[:5]))
        .otherwise(dump_line(t.companies))
    )
    return read_dump(t.spark, land_lines(lines, scratch(t.spark)), COMPANIES)


@query(
    """select cnpj_basico, case porte_empresa when '00' then null when '01' then null
              when '03' then null when '05' then 'na' else razao_social end as razao_social
       from companies""",
    "companies",
)
def src_null_tokens(t):
    size = F.col("porte_empresa")
    marked = t.companies.select(
        "cnpj_basico",
        F.when(size == "00", "NA")
        .when(size == "01", "NULL")
        .when(size == "03", "n/a")
        .when(size == "05", "na")
        .otherwise(F.col("razao_social"))
        .alias("razao_social"),
    )
    return nullify_tokens(marked)


@query(
    """select coalesce(porte_empresa, '') = '03' as dropped, cnpj_basico, count(*) over () as n_read,
              count(*) filter (where porte_empresa = '03') over () as n_dropped
       from companies""",
    "companies",
)
def src_accounted_dump(t):
    # Small companies get fields too many: each line is in the table, or shown among the dropped.
    size, root = F.col("porte_empresa"), scratch(t.spark)
    lines = t.companies.select(F.when(size == "03", dump_line(t.companies, extra=';"x"')).otherwise(dump_line(t.companies)))
    dump = land_lines(lines, f"{root}/dump")
    kept = flows.ingest_companies(t.spark, dump, f"{root}/table", "2024-01", dropped=f"{root}/dropped")
    account = manifest(t.spark, f"{root}/table")["parts"]["2024-01"]["notes"]
    dropped = read_table(t.spark, f"{root}/dropped").select(F.substring("line", 2, 8).alias("cnpj_basico"))
    both = kept.select(F.lit(False).alias("dropped"), "cnpj_basico").unionByName(dropped.select(F.lit(True).alias("dropped"), "cnpj_basico"))
    return both.withColumns({"n_read": F.lit(account["read"]).cast("long"), "n_dropped": F.lit(account["dropped"]).cast("long")})


@query(ALL_COMPANIES, "companies")
def src_multi_file(t):
    root = scratch(t.spark)
    sized = F.col("porte_empresa").isNotNull()
    land_dump(t.companies.where(sized), f"{root}/first")
    land_dump(t.companies.where(~sized), f"{root}/second")
    return read_dump(t.spark, [f"{root}/fir*", f"{root}/second/*.csv"], COMPANIES)


@query(ALL_COMPANIES, "companies")
def src_skip_failed_file(t):
    path = land_dump(t.companies, scratch(t.spark))
    land_bytes(t.spark, f"{path}/broken.csv.gz", b"this is no gzip stream")
    return read_dump(t.spark, path, COMPANIES, skip_failed_files=True)


@query(ALL_COMPANIES, "companies")
def src_zip_members(t):
    root = scratch(t.spark)
    land_archives(t.companies.select(dump_line(t.companies)), f"{root}/zip", COMPANY_MEMBER)
    land_bytes(t.spark, f"{root}/zip/damaged.zip", b"PK but no archive")
    unpacked = unpack_zips(t.spark, f"{root}/zip/*.zip", COMPANY_MEMBER, f"{root}/csv")
    unpacked.write.parquet(f"{root}/report")
    return read_dump(t.spark, f"{root}/csv", COMPANIES)


@query("""select * replace (razao_social || chr(10) || 'Filial "A"' as razao_social) from companies""", "companies")
def src_split_records(t):
    # Every record has a line break in quotes, and its file may be split anywhere.
    broken = t.companies.withColumn("razao_social", F.concat("razao_social", F.lit('\nFilial "A"')))
    return read_split_dump(t.spark, land_dump(broken, scratch(t.spark)), COMPANIES)


@query(ALL_COMPANIES, "companies")
def src_mixed_encodings(t):
    # Latin-1 and UTF-8 files in one folder; the names in one of them were decoded twice before.
    root, size = scratch(t.spark), F.coalesce("porte_empresa", F.lit("none"))
    twice = F.encode(F.col("razao_social"), "UTF-8")
    twice = t.companies.where(size == "01").withColumn("razao_social", F.decode(twice, "ISO-8859-1"))
    land_dump(t.companies.where(~size.isin("01", "03")), f"{root}/dump")
    land_dump(twice, f"{root}/dump", mode="append")
    land_dump(t.companies.where(size == "03"), f"{root}/dump", mode="append", encoding="UTF-8")
    return repaired(read_any_dump(t.spark, f"{root}/dump", COMPANIES), ["razao_social"])


@query(ALL_COMPANIES, "companies")
def src_zip_source(t):
    # Read out of the archives: no file is written but them.
    root = scratch(t.spark)
    land_archives(t.companies.select(dump_line(t.companies)), f"{root}/zip", COMPANY_MEMBER)
    land_bytes(t.spark, f"{root}/zip/damaged.zip", b"PK but no archive")
    return read_zips(t.spark, f"{root}/zip/*.zip", COMPANY_MEMBER, COMPANIES, skip_failed_files=True)


# Texts with blanks at both ends and, in some rows, a line break.
PADDED = """select * replace (case when length(nome_socio) % 3 = 0 then '  ' || nome_socio || chr(10) || 'Filho '
                                  else ' ' || nome_socio || '  ' end as nome_socio) from partners"""


def _padded_partners(t):
    name = F.col("nome_socio")
    broken = F.concat(F.lit("  "), name, F.lit("\nFilho "))
    plain = F.concat(F.lit(" "), name, F.lit("  "))
    return t.partners.withColumn("nome_socio", F.when(F.length(name) % 3 == 0, broken).otherwise(plain))


@query(PADDED, "partners")
def src_header_csv(t):
    # The file has its columns in another order than they are asked for.
    path = scratch(t.spark)
    write_csv(_padded_partners(t).select(*reversed(PARTNERS)), path)
    return read_table_csv(t.spark, path, PARTNERS, multi_line=True)


@query(
    """select cep, o_orderkey, o_totalprice, cast(o_orderdate as date) as o_orderdate
       from (select *, lpad(cast(o_orderkey * 7 % 100000000 as string), 8, '0') as cep from orders)"""
)
def src_inferred_csv(t):
    path = scratch(t.spark)
    write_csv(
        t.given("orders").select(
            F.lpad((F.col("o_orderkey") * 7 % 100000000).cast("string"), 8, "0").alias("cep"),
            "o_orderkey",
            "o_totalprice",
            F.to_date("o_orderdate").alias("o_orderdate"),
        ),
        path,
    )
    typed = read_inferred_csv(t.spark, path, keep_text=["cep"])
    return typed.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    """select cep, o_orderkey, o_totalprice, cast(o_orderdate as date) as o_orderdate
       from (select *, lpad(cast(o_orderkey * 7 % 100000000 as string), 8, '0') as cep from orders)"""
)
def src_evident_csv(t):
    # As above, but nobody says that one column holds codes.
    path = scratch(t.spark)
    cep = F.lpad((F.col("o_orderkey") * 7 % 100000000).cast("string"), 8, "0").alias("cep")
    write_csv(t.given("orders").select(cep, "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")), path)
    return read_evident_csv(t.spark, path).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    """select cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel,
              capital_social, nullif(porte_empresa, '01') as porte_empresa,
              ente_federativo_responsavel
       from companies where porte_empresa is null or porte_empresa <> '03'""",
    "companies",
)
def src_lenient_csv(t):
    size = F.col("porte_empresa")
    lines = t.companies.select(
        F.when(size == "03", dump_line(t.companies, extra=";;"))
        .when(size == "01", dump_line(t.companies, COMPANIES[:5]))
        .otherwise(dump_line(t.companies))
        .alias(";".join(COMPANIES))
    )
    path = scratch(t.spark)
    lines.write.options(header=True, sep="\u0001", quote="", encoding="ISO-8859-1").csv(path)
    return read_lenient_csv(t.spark, path, COMPANIES, encoding="ISO-8859-1")


@query(
    """select cnpj_basico, 'São ' || n_name as municipio_descricao
       from establishments left join nation on municipio = lpad(cast(n_nationkey as string), 4, '0')""",
    "establishments",
)
def src_lookup_csv(t):
    path = land_dump(t.cities, scratch(t.spark))
    cities = read_lookup(t.spark, path, encoding="ISO-8859-1")
    return join_lookup(t.establishments, "municipio", cities).select(
        "cnpj_basico", "municipio_descricao"
    )


@query(
    """select c.porte_empresa, s.descricao as porte_empresa_descricao, count(*) as total
       from companies c left join sizes s on c.porte_empresa = s.codigo group by all""",
    "companies sizes",
)
def src_inline_table(t):
    labelled = join_lookup(t.companies, "porte_empresa", size_lookup(t.spark), literal=True)
    return labelled.groupBy("porte_empresa", "porte_empresa_descricao").agg(
        F.count("*").alias("total")
    )


@query("select l_orderkey, l_linenumber, l_shipdate from lineitem")
def src_parquet(t):
    return read_table(t.spark, f"{t.folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_shipdate"
    )


@query(
    """with monthly as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as mes from orders)
       select * from monthly where mes =
       (select max(mes) from monthly where mes between '2001-04' and '2002-02')"""
)
def src_latest_snapshot(t):
    monthly = t.given("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("mes")
    )
    return latest_snapshot(monthly, "mes", date(2002, 2, 14))


@query(
    """with monthly as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as mes from orders)
       select * from monthly where mes =
       (select max(mes) from monthly where mes between '2001-04' and '2002-02')"""
)
def src_latest_partition(t):
    path = scratch(t.spark)
    monthly = t.given("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("mes")
    )
    write_parquet(monthly, path, partition_by=["mes"])
    found = latest_partition(t.spark, path, "mes", date(2002, 2, 14))
    return found.withColumn("mes", F.col("mes").cast("string"))


# --- sinks ------------------------------------------------------------------


@query(
    """select * replace ('  ' || logradouro || ' ' as logradouro, numero || chr(10) || ' fundos' as numero)
       from establishments""",
    "establishments",
)
def sink_csv(t):
    path = scratch(t.spark)
    padded = t.establishments.withColumns(
        {
            "logradouro": F.concat(F.lit("  "), "logradouro", F.lit(" ")),
            "numero": F.concat("numero", F.lit("\n fundos")),
        }
    )
    write_csv(padded, path)
    return read_table_csv(t.spark, path, multi_line=True)


@query("select * from establishments", "establishments")
def sink_parquet(t):
    path = scratch(t.spark)
    write_parquet(t.establishments, path, partition_by=["uf"], max_records=1_000_000)
    return read_table(t.spark, path)


@query(
    """select *, '2024-01' as mes from companies where porte_empresa is null
       union all select *, '2024-02' from companies""",
    "companies",
)
def sink_versioned_table(t):
    # A month is replaced, a write of it fails half-way, another month is added.
    path, sized = scratch(t.spark), F.col("porte_empresa").isNotNull()
    replace_part(t.companies.where(sized), path, "2024-01", "mes")
    replace_part(t.companies.where(~sized), path, "2024-01", "mes")
    replace_part(t.companies, path, "2024-02", "mes")
    lost = F.when(sized, F.raise_error(F.lit("lost"))).otherwise(F.col("porte_empresa"))
    try:
        replace_part(t.companies.withColumn("porte_empresa", lost), path, "2024-01", "mes")
    except Exception:
        return read_table(t.spark, path)
    raise AssertionError("the write was to fail")


TYPED_COMPANIES = """
       select substring(coalesce(cnpj_basico, ''), 1, 15) as cnpj_basico,
              substring(coalesce(razao_social, ''), 1, 200) as razao_social,
              natureza_juridica, qualificacao_responsavel,
              coalesce(cast(replace(capital_social, ',', '.') as decimal(15,2)), 0) as capital_social,
              porte_empresa
       from companies"""


@query(TYPED_COMPANIES, "companies")
def sink_typed_table(t):
    location = scratch(t.spark)
    name = "companies_" + location.rsplit("-", 1)[-1]
    save_table(
        flows.load_companies(t.companies),
        name,
        COMPANY_TABLE,
        location=location,
        bucket_by="cnpj_basico",
        buckets=8,
    )
    return t.spark.table(name).drop("data_criacao")


TYPED_INDEXES = ("uf", "municipio", "cnae_fiscal_principal", "situacao_cadastral")


# --- projections and expressions ---------------------------------------------


@query("select cnpj_basico, nome_socio, faixa_etaria from partners", "partners")
def proj_schema_by_position(t):
    unnamed = t.partners.toDF(*(f"_c{i}" for i in range(len(PARTNERS))))
    return unnamed.toDF(*PARTNERS).select("cnpj_basico", "nome_socio", "faixa_etaria")


@query(
    """select cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel,
              capital_social, porte_empresa from companies""",
    "companies",
)
def proj_select_columns(t):
    return t.companies.select(*COMPANIES[:6])


@query("select * from partners", "partners")
def proj_select_star(t):
    return t.partners.select("*")


@query(
    "select cnpj_cpf_socio as cnpj_controladora, nome_socio as nome_controladora from partners",
    "partners",
)
def proj_alias(t):
    return t.partners.select(
        F.col("cnpj_cpf_socio").alias("cnpj_controladora"),
        F.col("nome_socio").alias("nome_controladora"),
    )


@query(
    """select cnpj_basico, m.descricao as municipio_descricao, p.descricao as pais_descricao
       from establishments e left join cities m on e.municipio = m.codigo
       left join countries p on e.pais = p.codigo""",
    "establishments cities countries",
)
def proj_collision_names(t):
    both = join_lookups(t.establishments, {"municipio": t.cities, "pais": t.countries})
    return both.select("cnpj_basico", "municipio_descricao", "pais_descricao")


@query(
    """select cnpj_basico || cnpj_ordem || nullif(cnpj_dv, '00') as "CNPJ" from establishments""",
    "establishments",
)
def str_concat_key(t):
    holed = t.establishments.withColumn("cnpj_dv", F.nullif("cnpj_dv", F.lit("00")))
    return holed.select(establishment_key().alias("CNPJ"))


@query(
    "select left(cnpj_basico || cnpj_ordem || cnpj_dv, 8) as empresa from establishments",
    "establishments",
)
def str_left(t):
    return t.establishments.select(establishment_key().alias("CNPJ")).select(
        company_key().alias("empresa")
    )


@query("select cnpj_basico, replace(capital_social, ',', '.') as capital from companies", "companies")
def str_replace(t):
    return t.companies.select(
        "cnpj_basico", F.replace("capital_social", F.lit(","), F.lit(".")).alias("capital")
    )


@query(
    "select cnpj_basico, cast(length(razao_social) as int) as tamanho from companies",
    "companies",
)
def str_length(t):
    return t.companies.select("cnpj_basico", F.char_length("razao_social").alias("tamanho"))


@query(
    """select numero, coalesce(substring(nome_fantasia, 1, 11), '') as nome
       from establishments""",
    "establishments",
)
def str_truncate(t):
    return t.establishments.select("numero", clip_text("nome_fantasia", 11).alias("nome"))


@query(
    "select numero, try_cast(nome_fantasia as double) as nada, cast(cep as double) as valor from establishments",
    "establishments",
)
def cast_double(t):
    return t.establishments.select(
        "numero",
        F.col("nome_fantasia").try_cast("double").alias("nada"),
        F.col("cep").try_cast("double").alias("valor"),
    )


@query(
    "select cnpj_basico, cast(replace(capital_social, ',', '.') as double) as capital from companies",
    "companies",
)
def parse_decimal_comma(t):
    return t.companies.select("cnpj_basico", decimal_comma("capital_social").alias("capital"))


@query(
    """select cnpj_basico, ifnull(cast(replace(nullif(capital_social, ''), ',', '.') as double), 0) as capital
       from companies""",
    "companies",
)
def case_default(t):
    return t.companies.select("cnpj_basico", amount_or_zero("capital_social").alias("capital"))


@query(
    """select cnpj_basico, coalesce(try_cast(replace(capital_social, ',', '.') as double), 0.0) as capital
       from companies""",
    "companies",
)
def coalesce_zero(t):
    return t.companies.select(
        "cnpj_basico", F.coalesce(decimal_comma("capital_social"), F.lit(0.0)).alias("capital")
    )


@query("select l_orderkey, l_linenumber, round(l_extendedprice / 8, 2) as valor from lineitem")
def round_2(t):
    return t.given("lineitem").select(
        "l_orderkey", "l_linenumber", round_places(F.col("l_extendedprice") / 8).alias("valor")
    )


@query(
    """select cnpj_basico, try_cast(replace(capital_social, ',', '.') as decimal(15,2)) as capital
       from companies""",
    "companies",
)
def cast_decimal_15_2(t):
    return t.companies.select(
        "cnpj_basico", decimal_comma("capital_social").try_cast("decimal(15,2)").alias("capital")
    )


@query(
    """select numero, cast(try_strptime(data_situacao_cadastral, '%Y%m%d') as date) as data
       from establishments""",
    "establishments",
)
def cast_date(t):
    return t.establishments.select("numero", compact_date("data_situacao_cadastral").alias("data"))


TYPED_ESTABLISHMENTS = """
       select substring(coalesce(cnpj_basico || cnpj_ordem || cnpj_dv, ''), 1, 14) as cnpj_completo,
              coalesce(cnpj_basico, '') as cnpj_basico,
              substring(nome_fantasia, 1, 200) as nome_fantasia, situacao_cadastral,
              cast(try_strptime(data_situacao_cadastral, '%Y%m%d') as date) as data_situacao_cadastral,
              cnae_fiscal_principal, logradouro, substring(numero, 1, 10) as numero, bairro, cep,
              uf, municipio, email
       from establishments"""


@query(
    """select cnpj_basico, substring(razao_social, 1, 200) as razao_social,
              substring(repeat(razao_social, 9), 1, 200) as longa from companies""",
    "companies",
)
def varchar_conform(t):
    width = COMPANY_TABLE["razao_social"].dataType
    return t.companies.select(
        "cnpj_basico",
        conform_value(F.col("razao_social"), width).alias("razao_social"),
        conform_value(F.repeat("razao_social", F.lit(9)), width).alias("longa"),
    )


@query(
    """select count(*) as n_rows, min(n) as first_id, max(n) as last_id, count(distinct n) as n_ids,
              cast(sum(n) as decimal(38,0)) as sum_of_ids
       from (select row_number() over () as n from partners)""",
    "partners",
    name="surrogate_key",
)
def dense_ids(t):
    # Which row has which id is open; that they run from 1 without gaps is not.
    return surrogate_key(t.partners, scratch(t.spark)).agg(
        F.count("*").alias("n_rows"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("n_ids"),
        F.sum(F.col("id").cast("decimal(20,0)")).cast("decimal(38,0)").alias("sum_of_ids"),
    )


@query(
    """select carga, count(*) as n_rows, min(id) as first_id, max(id) as last_id, count(distinct id) as n_ids from (
         select 'jan' as carga, row_number() over () as id from partners
         union all select 'fev', row_number() over () + (select count(*) from partners) from companies
         union all select 'mar', row_number() over () + (select count(*) from partners) + (select count(*) from companies)
         from partners where identificador_socio = 'A')
       group by carga""",
    "partners companies",
)
def surrogate_key_loads(t):
    # Three loads, one of them repeated: ids go on where the last load ended.
    root, key = scratch(t.spark), ["cnpj_basico"]
    append_load(t.partners.select(*key), root, "jan")
    append_load(t.companies.select(*key), root, "fev")
    append_load(t.companies.select(*key), root, "fev")
    append_load(t.partners.where("identificador_socio = 'A'").select(*key), root, "mar")
    ids = read_loads(t.spark, root).groupBy("carga")
    return ids.agg(
        F.count("*").alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count_distinct("id").alias("n_ids")
    )


@query("select cnpj_basico, true as carimbado from companies", "companies")
def load_timestamp(t):
    # The time of the load: not before it was asked for, and the same in all rows, as the query's own is.
    asked = F.timestamp_millis(F.lit(int(time.time() * 1000)))
    stamped = F.col("data_criacao").between(asked, F.current_timestamp()) & (F.col("data_criacao") == F.current_timestamp())
    return flows.load_companies(t.companies).select("cnpj_basico", stamped.alias("carimbado"))


@query(
    """select numero, s.descricao as situacao_cadastral_descricao, m.descricao as identificador_matriz_descricao
       from establishments e
       left join domain s on s.coluna = 'situacao_cadastral' and s.codigo = e.situacao_cadastral
       left join domain m on m.coluna = 'identificador_matriz' and m.codigo = e.identificador_matriz""",
    "establishments domain",
    name="decode_codes",
)
def decoded(t):
    columns = ["situacao_cadastral", "identificador_matriz"]
    return decode_codes(t.establishments, t.domain, columns).select(
        "numero", *(f"{c}_descricao" for c in columns)
    )


@query("select cnpj_basico, razao_social from companies", "companies")
def transcode_latin1(t):
    root = scratch(t.spark)
    write_csv(read_dump(t.spark, land_dump(t.companies, f"{root}/in"), COMPANIES), f"{root}/out")
    utf8 = read_table_csv(t.spark, f"{root}/out", COMPANIES, encoding="UTF-8")
    return utf8.select("cnpj_basico", "razao_social")


# --- filters ------------------------------------------------------------------


@query("select cnpj_basico, numero from establishments where situacao_cadastral = 'F'", "establishments")
def filter_equals(t):
    return t.establishments.where(F.col("situacao_cadastral") == "F").select("cnpj_basico", "numero")


@query("select cnpj_basico, porte_empresa from companies where porte_empresa <> '00'", "companies")
def filter_not_equals(t):
    return t.companies.where(F.col("porte_empresa") != "00").select("cnpj_basico", "porte_empresa")


@query("select cnpj_basico, capital_social from companies where capital_social is not null", "companies")
def filter_is_not_null(t):
    return t.companies.where(F.col("capital_social").isNotNull()).select("cnpj_basico", "capital_social")


@query(
    """select cnpj_basico, numero from establishments
       where cnae_fiscal_principal is not null and situacao_cadastral = 'F'""",
    "establishments",
)
def filter_conjunction(t):
    return t.establishments.where(
        F.col("cnae_fiscal_principal").isNotNull() & (F.col("situacao_cadastral") == "F")
    ).select("cnpj_basico", "numero")


@query(
    """select cnpj_basico from
       (select cnpj_basico, case when porte_empresa = '00' then '' else capital_social end as capital
        from companies) where capital = '' or capital is null""",
    "companies",
)
def filter_blank_or_null(t):
    capital = F.when(F.col("porte_empresa") == "00", "").otherwise(F.col("capital_social"))
    return t.companies.where((capital == "") | capital.isNull()).select("cnpj_basico")


@query(
    """select nome_socio, count(*) as n from partners group by nome_socio
       having count(*) >= 100""",
    "partners",
)
def filter_having(t):
    return t.partners.groupBy("nome_socio").agg(F.count("*").alias("n")).where(F.col("n") >= 100)


# --- joins --------------------------------------------------------------------


@query(
    """select cnpj_basico, s.descricao as porte_empresa_descricao
       from companies left join sizes s on porte_empresa = s.codigo""",
    "companies sizes",
)
def join_lookup_left(t):
    return join_lookup(t.companies, "porte_empresa", size_lookup(t.spark), literal=True).select(
        "cnpj_basico", "porte_empresa_descricao"
    )


ENRICHED_COMPANIES = """
       select c.*, s.descricao as porte_empresa_descricao, n.descricao as natureza_juridica_descricao
       from companies c left join sizes s on c.porte_empresa = s.codigo
       left join legal_natures n on c.natureza_juridica = n.codigo"""


@query(
    f"select cnpj_basico, porte_empresa_descricao, natureza_juridica_descricao from ({ENRICHED_COMPANIES})",
    "companies sizes legal_natures",
)
def join_two_lookups(t):
    return flows.enrich_companies(t.companies, t.legal_natures).select(
        "cnpj_basico", "porte_empresa_descricao", "natureza_juridica_descricao"
    )


ENRICHED_ESTABLISHMENTS = """
       select e.*, cnpj_basico || cnpj_ordem || cnpj_dv as "CNPJ",
              m.descricao as municipio_descricao,
              a.descricao as cnae_fiscal_principal_descricao,
              p.descricao as pais_descricao,
              r.descricao as motivo_situacao_cadastral_descricao
       from establishments e
       left join cities m on e.municipio = m.codigo
       left join (select codigo, min(descricao) as descricao from activities group by codigo) a
            on e.cnae_fiscal_principal = a.codigo
       left join countries p on e.pais = p.codigo
       left join reasons r on e.motivo_situacao_cadastral = r.codigo"""
ESTABLISHMENT_VIEWS = "establishments cities activities countries reasons"


def _enriched_establishments(t):
    return flows.enrich_establishments(t.establishments, t.cities, t.activities, t.countries)


CHAIN = (
    '"CNPJ"',
    "municipio_descricao",
    "cnae_fiscal_principal_descricao",
    "pais_descricao",
    "motivo_situacao_cadastral_descricao",
)


@query(f"select {', '.join(CHAIN)} from ({ENRICHED_ESTABLISHMENTS})", ESTABLISHMENT_VIEWS)
def join_lookup_chain(t):
    return _enriched_establishments(t).select(*(c.strip('"') for c in CHAIN))


ENRICHED_PARTNERS = """
       select s.*, q.descricao as qualificacao_socio_descricao, p.descricao as pais_descricao
       from partners s left join qualifications q on s.qualificacao_socio = q.codigo
       left join countries p on s.pais = p.codigo"""


@query(
    f"""select nome_socio, cnpj_basico, qualificacao_socio_descricao, pais_descricao
        from ({ENRICHED_PARTNERS})""",
    "partners qualifications countries",
)
def join_partner_lookups(t):
    return flows.enrich_partners(t.partners, t.countries).select(
        "nome_socio", "cnpj_basico", "qualificacao_socio_descricao", "pais_descricao"
    )


@query(
    """select numero, descricao as pais_descricao from establishments
       left join (select nullif(codigo, '003') as codigo, descricao from countries) p
       on pais is not distinct from p.codigo""",
    "establishments countries",
)
def join_null_safe(t):
    holed = t.countries.withColumn("codigo", F.nullif("codigo", F.lit("003")))
    return join_lookup(t.establishments, "pais", holed, null_safe=True).select(
        "numero", "pais_descricao"
    )


@query(
    """select numero, descricao as cnae_fiscal_principal_descricao from establishments
       left join (select codigo, min(descricao) as descricao from activities group by codigo) a
       on cnae_fiscal_principal = a.codigo""",
    "establishments activities",
)
def join_fanout_guard(t):
    # The lookup repeats every code many times.
    return join_lookup(t.establishments, "cnae_fiscal_principal", t.activities).select(
        "numero", "cnae_fiscal_principal_descricao"
    )


@query(
    """select l_orderkey, l_linenumber, p_name as codigo_descricao
       from lineitem left join part on nullif(l_partkey % 1000, 7) is not null and l_partkey = p_partkey"""
)
def join_lookup_large(t):
    # Beyond the bounds, with rows without a code.
    key = F.col("l_partkey")
    facts = t.given("lineitem").select(
        "l_orderkey", "l_linenumber", F.when(key % 1000 != 7, key).cast("string").alias("codigo")
    )
    parts = t.given("part").select(
        F.col("p_partkey").cast("string").alias("codigo"), F.col("p_name").alias("descricao")
    )
    return join_lookup(facts, "codigo", parts, max_rows=10, max_bytes=1000).drop("codigo")


@query(
    """select s.cnpj_basico, s.nome_socio, e.razao_social
       from partners s join companies e on s.cnpj_basico = e.cnpj_basico""",
    "partners companies",
)
def join_inner_equi(t):
    return t.partners.join(t.companies, "cnpj_basico").select(
        "cnpj_basico", "nome_socio", "razao_social"
    )


@query(
    """select "CNPJ", razao_social from
       (select cnpj_basico || cnpj_ordem || cnpj_dv as "CNPJ" from establishments)
       join companies on left("CNPJ", 8) = cnpj_basico""",
    "establishments companies",
)
def join_inner_expression_key(t):
    ids = t.establishments.select(establishment_key().alias("CNPJ"))
    return ids.join(t.companies, company_key() == F.col("cnpj_basico")).select(
        "CNPJ", "razao_social"
    )


# --- aggregations ---------------------------------------------------------------


@query("select count(*) as total from partners", "partners")
def agg_count_all(t):
    return reports.total_count(t.partners)


@query("select count(*) as total from companies where porte_empresa = '01'", "companies")
def agg_count_filtered(t):
    return t.companies.where(F.col("porte_empresa") == "01").agg(F.count("*").alias("total"))


@query("select faixa_etaria, count(*) as n from partners group by faixa_etaria", "partners")
def agg_group_count(t):
    return t.partners.groupBy("faixa_etaria").agg(F.count("*").alias("n"))


@query(
    "select uf, situacao_cadastral, count(*) as n from establishments group by uf, situacao_cadastral",
    "establishments",
)
def agg_group_multi_key(t):
    return t.establishments.groupBy("uf", "situacao_cadastral").agg(F.count("*").alias("n"))


@query(
    "select nome_socio, count(distinct cnpj_basico) as n from partners group by nome_socio",
    "partners",
)
def agg_count_distinct(t):
    return t.partners.groupBy("nome_socio").agg(F.count_distinct("cnpj_basico").alias("n"))


@query(
    """select uf, count(distinct left(cnpj_basico || cnpj_ordem || cnpj_dv, 8)) as n
       from establishments group by uf""",
    "establishments",
)
def agg_count_distinct_expr(t):
    ids = t.establishments.select("uf", establishment_key().alias("CNPJ"))
    return ids.groupBy("uf").agg(F.count_distinct(company_key()).alias("n"))


@query(
    """select porte_empresa, round(avg(cast(replace(capital_social, ',', '.') as double)), 2) as media
       from companies group by porte_empresa""",
    "companies",
)
def agg_avg(t):
    return t.companies.groupBy("porte_empresa").agg(
        round_places(F.avg(decimal_comma("capital_social"))).alias("media")
    )


@query(
    """select cnpj_basico, listagg(distinct nome_socio, '; ' order by nome_socio) as nome_socio,
              count(distinct nome_socio) as n_nome_socio,
              listagg(distinct cnpj_cpf_socio, '; ' order by cnpj_cpf_socio) as cnpj_cpf_socio,
              count(distinct cnpj_cpf_socio) as n_cnpj_cpf_socio
       from partners group by cnpj_basico""",
    "partners",
)
def agg_listagg_distinct(t):
    return listagg_distinct(t.partners, ["cnpj_basico"], ["nome_socio", "cnpj_cpf_socio"])


@query(
    """select count(*) filter (cnpj_cpf_socio is null) as sem_id, count(*) filter (pais is null) as sem_pais
       from partners""",
    "partners",
)
def agg_conditional_sum(t):
    return t.partners.agg(
        null_count("cnpj_cpf_socio").alias("sem_id"), null_count("pais").alias("sem_pais")
    )


@query(
    """select cast(sum(n - 1) + sum(case when k is null then 1 else 0 end) as bigint) as duplicatas
       from (select cnpj_cpf_socio as k, count(*) as n from partners group by k)""",
    "partners",
)
def agg_duplicate_count(t):
    return t.partners.agg(duplicate_count("cnpj_cpf_socio").alias("duplicatas"))


@query(
    """select cast(max(length(nome_fantasia)) as int) as nome, cast(max(length(logradouro)) as int) as rua
       from establishments""",
    "establishments",
)
def agg_max_length(t):
    return t.establishments.agg(
        max_length("nome_fantasia").alias("nome"), max_length("logradouro").alias("rua")
    )


@query(
    """select cnpj_cpf_socio, count(distinct cnpj_basico) as n from partners
       group by cnpj_cpf_socio having count(distinct cnpj_basico) >= 2""",
    "partners",
)
def agg_having_distinct(t):
    return (
        t.partners.groupBy("cnpj_cpf_socio")
        .agg(F.count_distinct("cnpj_basico").alias("n"))
        .where(F.col("n") >= 2)
    )


@query(
    """select coalesce(porte_empresa, 'total') as dump, count(*) as n_rows from companies
       where porte_empresa in ('00', '01', '05') and right(natureza_juridica, 1) not in ('3', '7')
       group by rollup (porte_empresa)""",
    "companies",
)
def agg_rows_per_file(t):
    # A dump per company size. Lines of some have a field too many and are not
    # kept; those of micro companies lack the last two fields and are.
    root = scratch(t.spark)
    long = F.right("natureza_juridica", F.lit(1)).isin("3", "7")
    for size in ("00", "01", "05"):
        own = t.companies.where(F.col("porte_empresa") == size)
        line = dump_line(own, COMPANIES[:5]) if size == "01" else dump_line(own)
        extra = dump_line(own, extra=';"x";"y"')
        land_lines(own.select(F.when(long, extra).otherwise(line)), f"{root}/dump/{size}")
    # Counted on the stored table: the dump is parsed once.
    stored = flows.ingest_companies(t.spark, f"{root}/dump/*", f"{root}/table", file_column="arquivo")
    dump = F.element_at(F.split("file", "/"), -2)
    return (
        rows_per_file(stored, file_column="arquivo")
        .groupBy(F.coalesce(dump, F.lit("total")).alias("dump"))
        .agg(F.sum("n_rows").alias("n_rows"))
    )


@query(
    """select dataset, n_bytes as text_bytes, true as smaller, true as adds_up, true as percent_fits
       from (select coalesce(dataset, 'total') as dataset, cast(sum(n) as bigint) as n_bytes from (
         select 'empresas' as dataset, octet_length(encode(cnpj_basico || ';' || coalesce(porte_empresa, '') || chr(10))) as n from companies
         union all
         select 'estabelecimentos', octet_length(encode(cnpj_basico || ';' || municipio || chr(10))) from establishments)
       group by rollup (dataset))""",
    "companies establishments",
)
def agg_compression_ratio(t):
    # Two tables written in both formats and measured; SQL states the bytes of the text, without the header of each file.
    root = scratch(t.spark)
    tables = {"empresas": t.companies.select("cnpj_basico", "porte_empresa"), "estabelecimentos": t.establishments.select("cnpj_basico", "municipio")}
    for name, df in tables.items():
        write_csv(df, f"{root}/csv/{name}")
        write_parquet(df, f"{root}/parquet/{name}")
    before, after = dataset_bytes(t.spark, f"{root}/csv"), dataset_bytes(t.spark, f"{root}/parquet")
    headers = {name: len(";".join(df.columns)) + 1 for name, df in tables.items()}
    header = F.col("n_files") * F.when(F.col("dataset") == "empresas", headers["empresas"]).otherwise(headers["estabelecimentos"])
    heads = before.select(F.coalesce("dataset", F.lit("total")).alias("dataset"), header.alias("n_header"))
    heads = heads.unionByName(heads.agg(F.lit("total").alias("dataset"), F.sum("n_header").alias("n_header")))
    saved = compression_ratio(before, after).withColumn("dataset", F.coalesce("dataset", F.lit("total"))).join(heads, "dataset")
    parts = lambda c: F.sum(F.when(F.col("dataset") != "total", F.col(c))).over(Window.partitionBy(F.lit(1)))
    whole = lambda c: (F.col("dataset") != "total") | (F.col(c) == F.col(f"{c}_parts"))
    saved = saved.withColumns({f"{c}_parts": parts(c) for c in ("bytes_before", "bytes_after")})
    percent = F.round(100 - F.col("bytes_after") * 100 / F.col("bytes_before"), 1)
    return saved.select(
        "dataset",
        (F.col("bytes_before") - F.col("n_header")).alias("text_bytes"),
        (F.col("bytes_after") < F.col("bytes_before")).alias("smaller"),
        (whole("bytes_before") & whole("bytes_after")).alias("adds_up"),
        (F.abs(percent - F.col("saved_percent")) < 0.11).alias("percent_fits"),
    )


# --- order and limits -------------------------------------------------------------


@query(
    "select cep, count(*) as total from establishments group by cep order by total desc, cep",
    "establishments",
)
def sort_desc(t):
    return (
        t.establishments.groupBy("cep")
        .agg(F.count("*").alias("total"))
        .orderBy(F.desc("total"), "cep")
    )


@query(
    """select uf, porte_empresa, count(*) as n from establishments join companies using (cnpj_basico)
       group by uf, porte_empresa order by uf, n desc""",
    "establishments companies",
)
def sort_multi_key(t):
    return (
        t.establishments.join(t.companies, "cnpj_basico")
        .groupBy("uf", "porte_empresa")
        .agg(F.count("*").alias("n"))
        .orderBy("uf", F.desc("n"), "porte_empresa")
    )


@query(
    """select nome_socio, count(*) as n from partners group by nome_socio
       order by n desc, nome_socio limit 50""",
    "partners",
)
def topk(t):
    return (
        t.partners.groupBy("nome_socio")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "nome_socio")
        .limit(50)
    )


@query(TYPED_COMPANIES + " order by cnpj_basico limit 500", "companies")
def limit_rows(t):
    first = quality.first_rows(t.companies.orderBy("cnpj_basico"), 500)
    return flows.load_companies(first).drop("data_criacao")


@query("select * from establishments order by cnpj_basico, numero limit 5", "establishments")
def head_sample(t):
    return quality.first_rows(t.establishments.orderBy("cnpj_basico", "numero"), 5)


# --- set operations and incremental ingest -------------------------------------------


@query(
    "select * from partners union all select * from partners where identificador_socio = 'A'",
    "partners",
)
def union_all_append(t):
    return t.partners.unionByName(t.partners.where(F.col("identificador_socio") == "A"))


@query(ALL_COMPANIES, "companies")
def stream_incremental_ingest(t):
    root = scratch(t.spark)
    sized = F.col("porte_empresa").isNotNull()

    def take_new():
        incremental_ingest(
            t.spark, f"{root}/landing", COMPANIES, f"{root}/table", f"{root}/checkpoint"
        )

    land_dump(t.companies.where(sized), f"{root}/landing")
    take_new()
    land_dump(t.companies.where(~sized), f"{root}/landing", mode="append")
    take_new()
    take_new()  # nothing landed: adds nothing
    return read_table(t.spark, f"{root}/table")


@query(
    """select cnpj_basico, case when porte_empresa = '01' then 'antes' || capital_social else razao_social end as razao_social
       from companies where porte_empresa is not null""",
    "companies",
)
def stream_ledger_ingest(t):
    # A file is rewritten in place, one is damaged in place, one was never whole, a run is repeated.
    root = scratch(t.spark)
    landing, target = f"{root}/landing", f"{root}/table"
    sizes = ("00", "01", "03", "05")

    def land(size, df):
        land_gzip(df.select(dump_line(df)), landing, size)

    def take():
        ledger_ingest(t.spark, landing, COMPANIES, target, f"{root}/checkpoint", skip_failed_files=True)

    own = {size: t.companies.where(F.col("porte_empresa") == size) for size in sizes}
    for size in sizes:
        land(size, own[size])
    land_bytes(t.spark, f"{landing}/broken.csv.gz", b"this is no gzip stream")
    take()
    land("01", own["01"].withColumn("razao_social", F.concat(F.lit("antes"), "capital_social")))
    land_bytes(t.spark, f"{landing}/03-00000.csv.gz", b"damaged now")
    take()
    take()  # nothing changed: adds nothing
    return read_ingested(t.spark, target, COMPANIES).select("cnpj_basico", "razao_social")


# --- reports ------------------------------------------------------------------------


@query(
    """select id as cnpj_controladora, name as nome_controladora,
              count(distinct company) as qtd_empresas_controladas,
              listagg(distinct razao_social, '; ' order by razao_social) as empresas_controladas,
              listagg(distinct company, '; ' order by company) as cnpjs_controlados
       from (
         with owned as (
           select distinct cnpj_cpf_socio as id, nome_socio as name, cnpj_basico as company
           from partners semi join companies using (cnpj_basico)
           where identificador_socio = 'A'),
         winners as (
           select id, name, count(*) as n from owned group by id, name having n > 1
           order by n desc, id nulls first, name nulls first limit 100)
         select o.*, c.razao_social from owned o
         semi join winners w on o.id is not distinct from w.id and o.name is not distinct from w.name
         join companies c on o.company = c.cnpj_basico)
       group by id, name""",
    "partners companies",
)
def q_corporate_groups(t):
    return reports.corporate_groups(t.partners, t.companies, legal_person="A")


@query(
    """select uf, porte_empresa, count(*) as quantidade, round(avg(capital), 2) as capital_medio
       from establishments join (select cnpj_basico, porte_empresa,
                    cast(replace(capital_social, ',', '.') as double) as capital
             from companies where capital_social is not null and porte_empresa <> '00')
       using (cnpj_basico)
       where identificador_matriz = '1-URGENT' group by all""",
    "establishments companies",
)
def q_companies_by_size_and_state(t):
    return reports.companies_by_size_and_state(
        t.establishments, t.companies, head_office="1-URGENT", size_unknown="00"
    )


@query(
    """select cnae_fiscal_principal, cast(sum(n) as bigint) as quantidade_empresas,
              count(cnpj_basico) as quantidade_cnpjs_basicos
       from (select cnae_fiscal_principal, cnpj_basico, count(*) as n from establishments
             where situacao_cadastral = 'F' group by all)
       where cnae_fiscal_principal is not null group by cnae_fiscal_principal
       order by 2 desc, 1 limit 50""",
    "establishments",
)
def q_top_activities(t):
    return reports.top_activities(t.establishments, active="F")


@query(
    "select porte_empresa, count(*) as total from companies group by porte_empresa", "companies"
)
def q_companies_by_size(t):
    return reports.companies_by_size(t.companies)


@query(
    """select qualificacao_responsavel, count(*) as total from companies
       where qualificacao_responsavel is not null group by qualificacao_responsavel
       order by total desc, qualificacao_responsavel limit 10""",
    "companies",
)
def q_top_qualifications(t):
    return reports.top_qualifications(t.companies)


@query("select count(*) as total from companies", "companies")
def q_total_count(t):
    return reports.total_count(t.companies)


@query(
    """select count(*) as total from companies c join sizes s on c.porte_empresa = s.codigo
       where s.descricao = 'MICRO EMPRESA'""",
    "companies sizes",
)
def q_count_by_size_filter(t):
    return reports.count_by_size(t.companies, size=reports.size_code("MICRO EMPRESA"))


# --- data quality ---------------------------------------------------------------------

WIDE = ("razao_social", "natureza_juridica", "qualificacao_responsavel", "porte_empresa")
FILLED = ("cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel")


@query(
    " union all ".join(
        f"select '{c}' as campo, cast(max(length({c})) as int) as max_len from companies"
        for c in WIDE
    ),
    "companies",
)
def dq_field_widths(t):
    return quality.field_widths(t.companies, WIDE)


@query(
    "select count(*) as total, "
    + ", ".join(f"count(*) - count({c}) as {c}_null" for c in FILLED)
    + " from companies",
    "companies",
)
def dq_null_profile(t):
    return quality.null_profile(t.companies, FILLED)


@query(
    "select count(*) as total, "
    + ", ".join(f"count(*) - count({c}) as {c}_null" for c in FILLED)
    + " from companies",
    "companies",
)
def dq_footer_null_profile(t):
    # From the footers of the written table: no row of it is read.
    path = scratch(t.spark)
    write_parquet(t.companies, path)
    return footer_null_profile(t.spark, path, FILLED)


@query(
    """select cast(sum(n - 1) + sum(case when k is null then 1 else 0 end) as bigint) as duplicatas
       from (select cnpj_basico as k, count(*) as n from establishments group by k)""",
    "establishments",
)
def dq_duplicate_keys(t):
    return quality.duplicate_keys(t.establishments)


GIVEN = ("customer", "orders", "lineitem")


@query(
    """select dataset, present, round(n_bytes / 1048576, 2) as size_mb from (
         select 'lines' as dataset, true as present, sum(octet_length(encode(o_comment_like || chr(10)))) as n_bytes
         from (select lpad(cast(o_orderkey as string), 40, 'x') as o_comment_like from orders)
         union all select 'parts', true, sum(octet_length(encode(p_name || chr(10)))) from part
         union all select 'empty', true, 0
         union all select 'socios_final', false, null)"""
)
def dq_dataset_inventory(t):
    # Datasets whose bytes SQL can count: plain lines in as many files as there are tasks.
    root = scratch(t.spark)
    order = F.lpad(F.col("o_orderkey").cast("string"), 40, "x")
    t.given("orders").select(order).write.text(f"{root}/lines")
    t.given("part").select("p_name").write.text(f"{root}/parts")
    t.spark.createDataFrame([], "line string").write.text(f"{root}/empty")
    return quality.dataset_inventory(t.spark, root, ["lines", "parts", "empty", "socios_final"])


@query(
    " union all ".join(
        f"select '{name}' as dataset, least(count(*), 1000) as n_rows from {name}" for name in GIVEN
    )
)
def dq_sample_check(t):
    return quality.sample_check({name: t.given(name) for name in GIVEN}).select("dataset", "n_rows")


@query(" union all ".join(f"select '{name}' as dataset, count(*) as n_rows from {name}" for name in GIVEN))
def dq_parquet_row_counts(t):
    return quality.row_counts({name: t.given(name) for name in GIVEN})


@query("select 'lineitem.parquet' as dataset, count(*) as n_rows, true as fits, true as fills from lineitem")
def dq_partition_sizing(t):
    sizing = quality.partition_sizing(t.spark, t.folder, "lineitem.parquet", target_mb=100)
    rows, row_mb = F.col("rows_per_target"), F.col("mb_per_row")
    return sizing.select(
        "dataset",
        "n_rows",
        (rows * row_mb <= 100 * 1.000001).alias("fits"),
        ((rows + 1) * row_mb > 100 * 0.999999).alias("fills"),
    )


# --- whole flows ------------------------------------------------------------------------


@query(ALL_COMPANIES, "companies")
def ingest_companies(t):
    root = scratch(t.spark)
    return flows.ingest_companies(t.spark, land_dump(t.companies, f"{root}/dump"), f"{root}/table")


@query("select * from establishments", "establishments")
def ingest_establishments(t):
    root = scratch(t.spark)
    dump = land_dump(t.establishments, f"{root}/dump")
    return flows.ingest_establishments(t.spark, dump, f"{root}/table")


@query("select * from partners", "partners")
def ingest_partners(t):
    root = scratch(t.spark)
    return flows.ingest_partners(t.spark, land_dump(t.partners, f"{root}/dump"), f"{root}/table")


@query(ENRICHED_COMPANIES, "companies sizes legal_natures")
def enrich_companies(t):
    return flows.enrich_companies(t.companies, t.legal_natures)


@query(ENRICHED_ESTABLISHMENTS, ESTABLISHMENT_VIEWS)
def enrich_establishments(t):
    return _enriched_establishments(t)


@query(ENRICHED_PARTNERS, "partners qualifications countries")
def enrich_partners(t):
    return flows.enrich_partners(t.partners, t.countries)


@query(
    f"""select 'empresas' as dataset, * from ({ENRICHED_COMPANIES})
        union all by name select 'estabelecimentos' as dataset, * from ({ENRICHED_ESTABLISHMENTS})
        union all by name select 'socios' as dataset, * from ({ENRICHED_PARTNERS})""",
    "companies sizes legal_natures qualifications partners " + ESTABLISHMENT_VIEWS,
)
def csv_to_parquet(t):
    root = scratch(t.spark)
    tables = {
        "empresas": flows.enrich_companies(t.companies, t.legal_natures),
        "estabelecimentos": _enriched_establishments(t),
        "socios": flows.enrich_partners(t.partners, t.countries),
    }
    for name, df in tables.items():
        write_csv(df, f"{root}/csv/{name}")
    saved = flows.csv_to_parquet(t.spark, f"{root}/csv", f"{root}/parquet")
    out = None
    for name in tables:
        stored = read_table(t.spark, f"{root}/parquet/{name}").withColumn("dataset", F.lit(name))
        out = stored if out is None else out.unionByName(stored, allowMissingColumns=True)
    # The join holds back every table whose conversion saved nothing.
    return out.join(saved.where("bytes_after < bytes_before").select("dataset"), "dataset", "left_semi")


@query(TYPED_COMPANIES, "companies")
def load_companies(t):
    return flows.load_companies(t.companies).drop("data_criacao")


@query(TYPED_ESTABLISHMENTS, "establishments")
def sink_indexed_table(t):
    # Laid out for lookups by four columns and by the full id.
    path, files = scratch(t.spark), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    typed = flows.load_establishments(t.establishments).drop("data_criacao")
    write_indexed(typed, path, TYPED_INDEXES, files, ids=["cnpj_completo"])
    return read_table(t.spark, path)


@query(
    "select * from (" + TYPED_ESTABLISHMENTS + ") where cnpj_completo in (select max(cnpj_completo) from ("
    + TYPED_ESTABLISHMENTS + ")) or uf = 'SP'",
    "establishments",
)
def sink_indexed_lookup(t):
    path, files = scratch(t.spark), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    typed = flows.load_establishments(t.establishments).drop("data_criacao")
    write_indexed(typed, path, TYPED_INDEXES, files, ids=["cnpj_completo"])
    last = read_table(t.spark, path).agg(F.max("cnpj_completo")).first()[0]
    state = lookup(t.spark, path, "uf", ["SP"])
    return state.unionByName(lookup(t.spark, path, "cnpj_completo", [last]).where("uf <> 'SP' or uf is null"))


@query(TYPED_ESTABLISHMENTS, "establishments")
def load_establishments(t):
    return flows.load_establishments(t.establishments).drop("data_criacao")
