"""Places that tasks on other machines must see."""

import datetime
from types import SimpleNamespace

import pytest

from firmbook.sources import archives
from firmbook.sources.dumps import rows_per_file
from firmbook.plans import flows, reports
from firmbook.sources.snapshots import latest_partition
from harness import landing


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master, fails in (("yarn", True), ("local-cluster[2,1,1024]", True), ("spark://x:7077", True)):
        spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            landing.scratch(spark)


def test_archive_places_are_resolved_on_the_driver(spark, tmp_path, monkeypatch):
    assert archives.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert archives.qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
    monkeypatch.setattr(archives, "SCHEMES", ("hdfs",))
    with pytest.raises(ValueError, match="file: location"):
        archives.unpack_zips(spark, str(tmp_path / "*.zip"), ".CSV", str(tmp_path / "out"))


def test_latest_partition_reads_one_month(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(30).selectExpr("id", "concat('2024-0', id % 3 + 1) as mes").write.partitionBy("mes").parquet(path)
    (tmp_path / "t" / "mes=2024-05").mkdir()
    (tmp_path / "t" / "mes=2024-05" / "empty.parquet").write_text("")
    found = latest_partition(spark, path, "mes", datetime.date(2024, 6, 1))
    assert found.count() == 10 and {r.mes for r in found.collect()} == {"2024-03"}
    assert latest_partition(spark, path, "mes", datetime.date(2020, 1, 1)).count() == 0


def test_rows_kept_per_file_from_the_stored_table(spark, tmp_path):
    dump = tmp_path / "dump"
    dump.mkdir()
    good = ";".join("1234567")
    (dump / "a.csv").write_text(f"{good}\n{good};8\n1;2\n")
    (dump / "b.csv").write_text(f"{good}\n")
    table = flows.ingest_companies(spark, str(dump), str(tmp_path / "t"), file_column="arquivo")
    assert "arquivo" in table.columns and table.count() == 3
    counted = {(r.file or "total").rsplit("/", 1)[-1]: r.n_rows for r in rows_per_file(table, file_column="arquivo").collect()}
    assert counted == {"a.csv": 2, "b.csv": 1, "total": 3}


def test_size_filter_reaches_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "c")
    spark.createDataFrame([("01",), ("03",)], "porte_empresa string").write.parquet(path)
    counted = reports.count_by_size(spark.read.parquet(path), reports.size_code("MICRO EMPRESA"))
    assert "EqualTo(porte_empresa,01)" in plan(counted) and counted.first()[0] == 1
