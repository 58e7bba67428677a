import pytest
from pyspark.sql import functions as F

from firmbook.layout import COMPANIES, COMPANY_SIZES
from firmbook.operators import enrich
from firmbook.operators.enrich import decode_codes, fits_broadcast, join_lookup, unique_codes
from firmbook.plans.flows import enrich_companies, enrich_establishments, enrich_partners
from harness.registry import Tables
from places import SMALL


@pytest.fixture
def facts(spark):
    # A third of the rows on one code, some without code, one copied.
    return spark.range(3000).selectExpr(
        "id",
        """case when id % 3 = 0 then 'hot' when id % 50 = 1 then null
           else concat('c', id % 40) end as code""",
    ).unionByName(spark.createDataFrame([(1, "hot")] * 5, "id long, code string"))


@pytest.fixture
def lookup(spark):
    rows = [("hot", "Quente"), (None, "Nada")] + [(f"c{i}", f"Código {i}") for i in range(30)]
    return spark.createDataFrame(rows, "codigo string, descricao string")


@pytest.mark.parametrize("null_safe", [False, True])
def test_shuffled_join_equals_broadcast_join(facts, lookup, rows, plan, null_safe):
    small = join_lookup(facts, "code", lookup, null_safe=null_safe)
    assert "BroadcastHashJoin" in plan(small)
    big = join_lookup(facts, "code", lookup, null_safe=null_safe, max_rows=3)
    assert plan(big).count("Join") > plan(small).count("Join")
    assert big.columns == small.columns == ["id", "code", "code_descricao"]
    assert rows(big) == rows(small)
    assert big.count() == facts.count()
    label = "Nada" if null_safe else None
    assert {r[0] for r in small.where("code is null").select("code_descricao").collect()} == {label}


def test_null_and_hot_codes_stay_where_they_are(spark):
    facts = spark.range(0, 40_000, 1, 40).selectExpr(
        "id",
        """case when id % 10 < 4 then null when id % 10 < 8 then 'hot'
           when id < 2000 then 'in two partitions' else concat('c', id % 997) end as code""",
    )
    lookup = spark.range(997).selectExpr("concat('c', id) as codigo", "concat('C', id) as descricao")
    named = spark.createDataFrame([("hot", "H"), ("in two partitions", "T")], lookup.schema)
    spark.conf.set("spark.sql.shuffle.partitions", 200)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = join_lookup(facts, "code", lookup.unionByName(named), max_rows=10)
        tasks = joined.groupBy(F.spark_partition_id().alias("task"), "code").count().collect()
        hot = [r["count"] for r in tasks if r.code == "hot"]
        none = [r["count"] for r in tasks if r.code is None]
        assert len(hot) == len(none) == 40 and max(hot) == max(none) == 400
        assert sum(r["count"] for r in tasks) == 40_000
        assert joined.where("code = 'in two partitions' and code_descricao = 'T'").count() == 400
        assert joined.where("code like 'c%' and code_descricao <> upper(code)").count() == 0
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_large_lookup_scans_the_facts_once_beside_their_codes(spark, lookup, tmp_path, plan):
    path = str(tmp_path / "facts")
    spark.range(2000).selectExpr("id", "concat('c', id % 40) as code", "repeat('x', 50) as wide").write.parquet(path)
    joined = join_lookup(spark.read.parquet(path), "code", lookup, max_rows=3)
    text = plan(joined)
    assert text.count("FileScan parquet") == 1 and "InMemoryTableScan" not in text
    assert joined.columns == ["id", "code", "wide", "code_descricao"]


def test_size_check(lookup):
    assert fits_broadcast(lookup, lookup.limit(0)) == [True, True]
    assert fits_broadcast(lookup, lookup.limit(31), max_rows=31) == [False, True]
    assert fits_broadcast(lookup.limit(1), lookup, max_bytes=100) == [True, False]


def test_lookup_large_by_copies_only(spark, facts, rows, plan, monkeypatch):
    copies = spark.createDataFrame([("hot", "Quente")] * 500, "codigo string, descricao string")
    monkeypatch.setattr(enrich.fits_broadcast, "__kwdefaults__", {"max_rows": 100, "max_bytes": 10**6})
    joined = join_lookup(facts, "code", copies, max_rows=100)
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" not in plan(joined)
    assert joined.count() == facts.count()
    both = enrich.join_lookups(facts.withColumn("other", F.col("code")), {"code": copies, "other": copies})
    assert both.count() == facts.count()
    assert both.where("code_descricao = 'Quente' and other_descricao = 'Quente'").count() == 1005


def test_repeated_codes_do_not_multiply(spark, facts, rows):
    lookup = spark.createDataFrame(
        [("hot", "b"), ("hot", "a"), ("hot", None), ("c1", None)], "codigo string, descricao string"
    )
    assert rows(unique_codes(lookup)) == [("c1", None), ("hot", "a")]
    joined = join_lookup(facts, "code", lookup)
    assert joined.count() == facts.count()
    assert {r[0] for r in joined.where("code = 'hot'").select("code_descricao").collect()} == {"a"}


def test_decode_codes(spark, rows):
    facts = spark.createDataFrame([("1", "02"), ("9", None)], "kind string, state string")
    domain = spark.createDataFrame(
        [("kind", "1", "PESSOA JURÍDICA"), ("state", "02", "ATIVA"), ("state", "1", "NULA")],
        "coluna string, codigo string, descricao string",
    )
    assert rows(decode_codes(facts, domain, ["kind", "state"])) == [
        ("1", "02", "PESSOA JURÍDICA", "ATIVA"),
        ("9", None, None, None),
    ]


def test_flows_keep_rows_and_never_shuffle_facts(spark, plan):
    t = Tables(spark, SMALL)
    for facts, df in (
        (t.companies, enrich_companies(t.companies, t.legal_natures)),
        (
            t.establishments,
            enrich_establishments(t.establishments, t.cities, t.activities, t.countries),
        ),
        (t.partners, enrich_partners(t.partners, t.countries)),
    ):
        text = plan(df)
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
        assert df.count() == facts.count()
        assert len(set(df.columns)) == len(df.columns)


def test_company_sizes(spark, rows):
    made = [("x", None, "n", None, None, code, None) for code, _ in COMPANY_SIZES] + [
        ("x", None, "n", None, None, "07", None)
    ]
    companies = spark.createDataFrame(made, ", ".join(f"{c} string" for c in COMPANIES))
    natures = spark.createDataFrame([("n", "Nature")], "codigo string, descricao string")
    labels = enrich_companies(companies, natures).select(
        "porte_empresa", "porte_empresa_descricao", "natureza_juridica_descricao"
    )
    want = [(c, d, "Nature") for c, d in COMPANY_SIZES] + [("07", None, "Nature")]
    assert rows(labels) == sorted(want, key=repr)
