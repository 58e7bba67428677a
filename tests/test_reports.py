import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from firmbook.operators import aggregates
from firmbook.operators.aggregates import listagg_distinct
from firmbook.operators.keys import number_rows, surrogate_key
from firmbook.plans import quality, reports

PARTNER = "cnpj_basico string, identificador_socio string, nome_socio string, cnpj_cpf_socio string"


@pytest.fixture(scope="module")
def made():
    """Partners and companies; one controller and one company hold a third each."""
    chance = random.Random(11)
    companies = [(f"{i:08d}", f"Empresa {i % 90}") for i in range(120)]
    companies += [("00000007", "Outro nome"), (None, "Sem id")]
    partners = []
    for _ in range(6000):
        company = "00000003" if chance.random() < 0.33 else f"{chance.randrange(150):08d}"
        owner = 0 if chance.random() < 0.33 else chance.randrange(400)
        kind = chance.choice(["PESSOA JURÍDICA", "PESSOA JURÍDICA", "PESSOA FÍSICA", None])
        partners.append((company, kind, f"Sócio {owner % 300}", None if owner == 5 else f"{owner:014d}"))
    return partners, companies


@pytest.mark.parametrize("limit, broadcast", [(100, -1), (3, -1), (100, None), (20_000, None)])
def test_corporate_groups(spark, made, limit, broadcast):
    partners, companies = made
    names = defaultdict(set)
    for key, name in companies:
        names[key].add(name)
    groups = defaultdict(set)
    for company, kind, name, owner in partners:
        if kind == "PESSOA JURÍDICA" and company is not None and company in names:
            groups[owner, name].add(company)
    want = sorted(
        (
            (
                owner,
                name,
                len(ids),
                "; ".join(sorted(set().union(*(names[i] for i in ids)))),
                "; ".join(sorted(ids)),
            )
            for (owner, name), ids in groups.items()
            if len(ids) >= 2
        ),
        key=lambda r: (-r[2], r[0] or "", r[1]),
    )[:limit]
    if broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = reports.corporate_groups(
            spark.createDataFrame(partners, PARTNER).repartition(6),
            spark.createDataFrame(companies, "cnpj_basico string, razao_social string"),
            limit=limit,
        ).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [tuple(r) for r in got] == want


@pytest.fixture
def eager_skew_splitting(spark):
    """Thresholds low enough for small tables to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.usefixtures("eager_skew_splitting")
def test_hot_company_is_split(spark, tmp_path, plan):
    """Joins on the company key are split where one company holds a third of the rows."""
    spark.range(400_000).selectExpr(
        "case when id % 3 = 0 then '00000001' else lpad(id % 9000, 8, '0') end as cnpj_basico",
        "'PESSOA JURÍDICA' as identificador_socio",
        "concat('Sócio ', id % 150000) as nome_socio",
        "lpad(id % 150000, 14, '0') as cnpj_cpf_socio",
        "'MATRIZ' as identificador_matriz",
        "concat('U', id % 7) as uf",
    ).write.parquet(str(tmp_path / "facts"))
    spark.range(9000).selectExpr(
        "lpad(id, 8, '0') as cnpj_basico",
        "concat('Empresa ', id) as razao_social",
        "concat('P', id % 3) as porte_empresa",
        "'10,5' as capital_social",
    ).write.parquet(str(tmp_path / "companies"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    companies = spark.read.parquet(str(tmp_path / "companies"))

    groups = reports.corporate_groups(facts, companies)
    assert "SortMergeJoin(skew=true)" in plan(groups, run=True)
    assert groups.count() == 100

    sized = reports.companies_by_size_and_state(facts, companies)
    assert "SortMergeJoin(skew=true)" in plan(sized, run=True)
    assert sum(r.quantidade for r in sized.collect()) == 400_000


def test_listagg_spreads_one_group(spark):
    values = [f"v{i:05d}" for i in range(5000)]
    df = spark.createDataFrame([("k", v) for v in values * 2] + [("n", None)], "k string, v string")
    got = {r.k: r for r in listagg_distinct(df, ["k"], ["v"], sep=" '|").collect()}
    assert got["k"].v == " '|".join(values) and got["k"].n_v == 5000
    assert got["n"].v is None and got["n"].n_v == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        parts = aggregates._stretches(df, ["k"], ["v"], "; ").where("k = 'k'").collect()
        assert len(parts) == 4  # as many tasks as there are shuffle partitions
        assert max(p._n for p in parts) < 2500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_size_and_state(spark, rows):
    establishments = spark.createDataFrame(
        [("1", "MATRIZ", "SP"), ("1", "MATRIZ", "SP"), ("2", "MATRIZ", "SP"), ("3", "FILIAL", "SP"),
         ("4", "MATRIZ", "AC"), ("5", "MATRIZ", None), ("6", None, "SP"), (None, "MATRIZ", "SP")],
        "cnpj_basico string, identificador_matriz string, uf string",
    )
    companies = spark.createDataFrame(
        [("1", "DEMAIS", "10,50"), ("2", "DEMAIS", "0,25"), ("3", "DEMAIS", "1"),
         ("4", "NÃO INFORMADO", "1"), ("5", "DEMAIS", "x"), ("6", "DEMAIS", "1"), ("7", None, "1")],
        "cnpj_basico string, porte_empresa string, capital_social string",
    )
    assert rows(reports.companies_by_size_and_state(establishments, companies)) == [
        ("SP", "DEMAIS", 3, 7.08),
        (None, "DEMAIS", 1, None),
    ]


def test_full_id_instead_of_company_id(spark, rows):
    by_id = spark.createDataFrame(
        [("00000001000100", "ATIVA", "A"), ("00000001000200", "ATIVA", "A"),
         ("00000002000100", "ATIVA", "A"), ("00000002000200", "BAIXADA", "A"),
         (None, "ATIVA", "A"), ("00000003000100", "ATIVA", None), ("00000003000100", "ATIVA", "B")],
        "CNPJ string, situacao_cadastral string, cnae_fiscal_principal string",
    )
    assert [tuple(r) for r in reports.top_activities(by_id).collect()] == [("A", 4, 2), ("B", 1, 1)]
    assert [tuple(r) for r in reports.top_activities(by_id, limit=1).collect()] == [("A", 4, 2)]


def test_small_reports(spark):
    companies = spark.createDataFrame(
        [("1", "b", "05"), ("2", "b", "10"), ("3", "a", "05"), ("4", None, None), ("4", "a", "10")],
        "cnpj_basico string, porte_empresa string, qualificacao_responsavel string",
    )
    assert [tuple(r) for r in reports.companies_by_size(companies).collect()] == [
        ("a", 2), ("b", 2), (None, 1)]
    assert [tuple(r) for r in reports.top_qualifications(companies, 1).collect()] == [("05", 2)]
    assert reports.total_count(companies).first().total == 5
    assert reports.count_by_size(companies, "b").first().total == 2
    assert reports.total_count(companies.limit(0)).first().total == 0
    assert quality.duplicate_keys(companies).first().duplicatas == 1
    assert tuple(quality.null_profile(companies, ["porte_empresa"]).first()) == (5, 1)
    assert {tuple(r) for r in quality.field_widths(companies, ["cnpj_basico", "porte_empresa"]).collect()} == {
        ("cnpj_basico", 1), ("porte_empresa", 1)}


def test_filters_reach_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "e")
    spark.range(1000).selectExpr(
        "cast(id as string) as cnpj_basico", "'ATIVA' as situacao_cadastral",
        "cast(id % 7 as string) as cnae_fiscal_principal", "'MATRIZ' as identificador_matriz",
        "'wide' as logradouro",
    ).write.parquet(path)
    text = plan(reports.top_activities(spark.read.parquet(path)))
    assert "EqualTo(situacao_cadastral,ATIVA)" in text
    assert "IsNotNull(cnae_fiscal_principal)" in text
    assert "TakeOrderedAndProject(limit=50" in text
    assert "logradouro" not in text
    count = plan(reports.total_count(spark.read.parquet(path)))
    assert "ReadSchema: struct<>" in count


def test_ids_are_dense_and_stable(spark, tmp_path):
    df = spark.range(0, 5000, 1, 7).selectExpr("cast(id as string) as k")
    path = str(tmp_path / "staged")
    numbered = surrogate_key(df, path)
    ids = [r.id for r in numbered.select("id").collect()]
    assert sorted(ids) == list(range(1, 5001))
    again = number_rows(spark, path).join(numbered, ["k", "id"])
    assert again.count() == 5000
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(k" not in plan


def test_ids_in_split_files(spark, tmp_path):
    """A file of many row groups, read by several tasks."""
    path = str(tmp_path / "one")
    spark.range(0, 40_000, 1, 1).selectExpr("id as k", "uuid() as t").write.option(
        "parquet.block.size", 64 * 1024
    ).parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        numbered = number_rows(spark, path)
        assert spark.read.parquet(path).rdd.getNumPartitions() > 2
        assert numbered.where("id = k + 1").count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ids_without_broadcast(spark, tmp_path, monkeypatch):
    from firmbook.operators import keys

    monkeypatch.setattr(keys, "BROADCAST_BYTES", 0)
    df = spark.range(0, 300, 1, 3).selectExpr("id as k")
    ids = [r.id for r in surrogate_key(df, str(tmp_path / "s")).collect()]
    assert sorted(ids) == list(range(1, 301))


def test_max_length_counts_characters(spark):
    df = spark.createDataFrame([("Mãe",), (None,)], "t string")
    assert df.agg(F.max(F.char_length("t"))).first()[0] == 3
