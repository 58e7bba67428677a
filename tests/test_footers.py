"""Reports from footers equal those from the rows."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from firmbook.plans.footers import footer_null_profile, footer_sizing, row_groups
from firmbook.plans.quality import null_profile

COLUMNS = ["a", "b", "c"]


@pytest.fixture
def table(spark):
    return spark.range(1000).selectExpr("if(id % 3 = 0, null, id) as a", "cast(null as string) as b", "concat('x', id) as c")


def test_equal_without_reading_values(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.repartition(5).write.option("parquet.block.size", 1024).parquet(path)
    assert footer_null_profile(spark, path, COLUMNS).collect() == null_profile(spark.read.parquet(path), COLUMNS).collect()
    assert not row_groups(spark, path, COLUMNS).where("scanned").count()
    sizing = footer_sizing(spark, path).first()
    assert sizing["n_rows"] == 1000 and sizing["n_files"] == 5 and sizing["n_bytes"] > 0


def test_only_what_has_no_numbers_is_read(spark, table, tmp_path):
    path = tmp_path / "t"
    table.coalesce(1).write.parquet(str(path))
    plain = pa.table({"a": [1, None, None], "b": ["x", None, "y"], "c": [None, None, None]}).cast(
        pa.schema([("a", pa.int64()), ("b", pa.string()), ("c", pa.string())])
    )
    pq.write_table(plain, path / "none.parquet", write_statistics=False)
    pq.write_table(plain.select(["a"]), path / "short.parquet")
    found = footer_null_profile(spark, str(path), COLUMNS).first()
    assert tuple(found) == (1006, 334 + 4, 1000 + 1 + 3, 3 + 3)
    read = {(r["file"].rsplit("/", 1)[1], r["column"]) for r in row_groups(spark, str(path), COLUMNS).where("scanned").collect()}
    assert read == {("none.parquet", c) for c in COLUMNS}


def test_empty_and_nested(spark, tmp_path):
    spark.createDataFrame([], "a int, s struct<x: int>").write.parquet(str(tmp_path / "e"))
    assert tuple(footer_null_profile(spark, str(tmp_path / "e"), ["a"]).first()) == (0, 0)
    assert footer_sizing(spark, str(tmp_path / "e")).first()["rows_per_target"] is None
    with pytest.raises(Exception, match="nested"):
        row_groups(spark, str(tmp_path / "e"), ["s"]).count()
