"""Files that a lookup by any of several columns, or by an id, reads little of."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from firmbook.operators import indexes as ix

INDEXED = ("uf", "municipio", "cnae", "nascimento")


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(200_000).select(
        F.format_string("%014d", F.pmod(F.xxhash64("id"), F.lit(10**14))).alias("cnpj_completo"),
        F.element_at(F.array(*map(F.lit, "AC BA CE DF GO MG PR RJ RS SC SP TO".split())), (F.pmod(F.hash("id"), F.lit(12)) + 1).cast("int")).alias("uf"),
        F.format_string("%04d", F.pmod(F.hash("id", F.lit(2)), F.lit(5000))).alias("municipio"),
        F.when(F.col("id") % 50 > 0, F.format_string("%07d", F.pmod(F.hash("id", F.lit(3)), F.lit(1300)))).alias("cnae"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(F.hash("id", F.lit(4)), F.lit(18_000))).alias("nascimento"),
    )


@pytest.fixture(scope="module")
def path(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("indexed") / "t")
    ix.write_indexed(table, path, INDEXED, files=128, ids=["cnpj_completo"], ids_per_group=500, row_group_bytes=8192)
    return path


def read(spark, df):
    """Rows that the scan hands on, after row groups were left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scan = leaves.apply(0)
    return scan.metrics().apply("numOutputRows").value()


def test_all_rows_are_there(spark, table, path):
    assert spark.read.parquet(path).exceptAll(table).count() == table.exceptAll(spark.read.parquet(path)).count() == 0


@pytest.mark.parametrize("column", INDEXED)
def test_a_filter_on_any_indexed_column_reads_under_a_third_of_the_row_groups(spark, table, path, column):
    for value in [r[0] for r in table.where(F.col(column).isNotNull()).select(column).distinct().orderBy(F.rand(7)).limit(8).collect()]:
        met = groups = 0
        for file in glob.glob(f"{path}/*.parquet"):
            found = pq.read_metadata(file)
            at = found.schema.names.index(column)
            for g in range(found.num_row_groups):
                stats = found.row_group(g).column(at).statistics
                groups += 1
                met += stats.has_min_max and stats.min <= value <= stats.max
        assert groups >= 500 and met < groups / 3, (value, met, groups)
        found = ix.lookup(spark, path, column, [value])
        assert found.count() == table.where(F.col(column) == value).count()


def test_one_order_serves_one_column_only(spark, table, tmp_path):
    """What the curve is for: sorted by one column, a filter on another meets every group."""
    path = str(tmp_path / "sorted")
    table.repartitionByRange(64, "uf", "municipio").sortWithinPartitions("uf", "municipio").write.parquet(path)
    met = 0
    for file in glob.glob(f"{path}/*.parquet"):
        found = pq.read_metadata(file)
        stats = found.row_group(0).column(found.schema.names.index("cnae")).statistics
        met += stats.min <= "0000700" <= stats.max
    assert met > 50


def test_an_absent_id_reads_no_row_group(spark, table, path):
    some = table.orderBy(F.rand(3)).first()["cnpj_completo"]
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        assert 0 < read(spark, ix.lookup(spark, path, "cnpj_completo", [some])) < 5_000
        absent = [f"{n:014d}" for n in (10**13 + 7, 3 * 10**13 + 1, 77)]
        assert table.where(F.col("cnpj_completo").isin(absent)).count() == 0
        assert min(read(spark, ix.lookup(spark, path, "cnpj_completo", [a])) for a in absent) == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, b int, ts timestamp")
    ix.write_indexed(empty, str(tmp_path / "e"), ["a", "b"], files=3)
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0
    nulls = spark.createDataFrame([(None, None, None), ("x", 1, None), ("", -5, None)], "a string, b int, ts timestamp")
    ix.write_indexed(nulls, str(tmp_path / "n"), ["a", "b", "ts"], files=3)
    assert spark.read.parquet(str(tmp_path / "n")).exceptAll(nulls).count() == 0
    with pytest.raises(ValueError):
        ix.write_indexed(nulls, str(tmp_path / "x"), [], files=3)
