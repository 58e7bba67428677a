"""Ids that go on from load to load, and dumps read out of their archives."""

import io
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from firmbook.operators import versions as v
from firmbook.operators.keys import append_load, read_loads
from firmbook.sources.dumps import read_dump
from firmbook.sources.zips import read_zips

ABC = ["a", "b", "c"]


def ids(spark, root):
    return {(r["carga"], r["k"]): r["id"] for r in read_loads(spark, root).collect()}


def load(spark, rows, start=0):
    return spark.range(start, start + rows, numPartitions=3).withColumnRenamed("id", "k")


def test_ids_are_dense_unique_and_unchanged(spark, tmp_path):
    root = str(tmp_path / "t")
    append_load(load(spark, 7), root, "jan")
    first = ids(spark, root)
    assert sorted(first.values()) == list(range(1, 8))
    append_load(load(spark, 5), root, "fev")
    append_load(load(spark, 50), root, "fev")  # repeated, whatever it brings now
    append_load(load(spark, 0), root, "empty")
    append_load(load(spark, 2), root, "mar")
    both = ids(spark, root)
    assert sorted(both.values()) == list(range(1, 15))
    assert {k: n for k, n in both.items() if k[0] == "jan"} == first
    v.remove_part(spark, root, "mar")
    append_load(load(spark, 1), root, "abr")  # numbers of a removed load do not come back
    assert ids(spark, root)[("abr", 0)] == 15


def test_loads_at_once_get_ranges_of_their_own(spark, tmp_path):
    root = str(tmp_path / "t")
    threads = [threading.Thread(target=append_load, args=(load(spark, n + 1), root, f"l{n}")) for n in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(ids(spark, root).values()) == list(range(1, 16))


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zipped:
        for name, content in members.items():
            zipped.writestr(name, content)


def test_zip_members_give_the_rows_of_the_unpacked_dump(spark, tmp_path, rows):
    content = ['"1";"São";"x"', "short", "1;2;3;4", '"open;quote;x', "", "   ", 'a;"q""q";NULL', "\x01", '"a;b";;"c"']
    members = {f"K{n}.EMPRECSV": ending.join(content).encode("latin-1") + ending.encode() * n for n, ending in enumerate(["\n", "\r\n", "\r"])}
    archive(tmp_path / "a.zip", {"LEIAME.txt": b"no;table;here\n", **members})
    archive(tmp_path / "b.zip", {"x.emprecsv": b"only;one;row"})
    (tmp_path / "csv").mkdir()
    for name, data in [*members.items(), ("x", b"only;one;row")]:
        (tmp_path / "csv" / f"{name}.csv").write_bytes(data)
    want = read_dump(spark, str(tmp_path / "csv"), ABC)
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    found = read_zips(spark, str(tmp_path / "*.zip"), "EMPRECSV", ABC)
    assert rows(found) == rows(want) and len(rows(want)) > 9
    assert found.select("b").count() == want.count()
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before
    named = read_zips(spark, str(tmp_path / "b.zip"), "EMPRECSV", ABC, file_column="de")
    assert [r["de"].rsplit("/", 1)[1] for r in named.collect()] == ["b.zip!x.emprecsv"]
    assert read_zips(spark, str(tmp_path / "*.zip"), "NONE", ABC).count() == 0
    assert found.rdd.getNumPartitions() == 4


def test_damaged_archives(spark, tmp_path):
    archive(tmp_path / "a.zip", {"a.csv": b"1;2;3\n" * 1000})
    (tmp_path / "b.zip").write_bytes(b"PK but no archive")
    with pytest.raises(Exception):
        read_zips(spark, str(tmp_path / "*.zip"), "csv", ABC).count()
    assert read_zips(spark, str(tmp_path / "*.zip"), "csv", ABC, skip_failed_files=True).count() == 1000
