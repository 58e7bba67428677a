"""Quoted line breaks in files that several tasks read."""

import random

import pytest
from pyspark.sql import functions as F

from firmbook.sources.dumps import read_dump
from firmbook.sources.records import read_split_dump

ABC = ["a", "b", "c"]


def write(path, rng, rows):
    def field():
        kind = rng.randrange(6)
        text = "".join(rng.choice(["x", "ç", " ", ";", "\n", '""', "\n\n", "São"]) for _ in range(rng.randrange(rng.choice([3, 60]))))
        return ["", "plain", '"quoted"', '""', f'"{text}"', "NULL"][kind] if kind != 4 else f'"{text}"'

    lines = [";".join(field() for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for _ in range(rows)]
    path.write_bytes(("\n".join(x for x in lines if x.strip()) + rng.choice(["", "\n", "\n\n"])).encode("latin-1"))


@pytest.mark.parametrize("seed, split", [(1, 64), (2, 200), (3, 1000), (4, 1 << 20)])
def test_split_files_equal_the_unsplit_read(spark, tmp_path, rows, seed, split):
    rng = random.Random(seed)
    for n in range(3):
        write(tmp_path / f"{n}.csv", rng, 120)
    want = rows(read_dump(spark, str(tmp_path), ABC, multi_line=True))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name, value in zip(names, (split, 1)):
        spark.conf.set(name, value)
    try:
        found = read_split_dump(spark, str(tmp_path), ABC)
        assert rows(found) == want and len(want) > 150
        tasks = spark.read.text(str(tmp_path / "0.csv")).rdd.getNumPartitions()
        assert tasks > 5 or split > 1000
        named = read_split_dump(spark, str(tmp_path), ABC, file_column="file")
        assert named.groupBy(F.substring_index("file", "/", -1)).count().count() == 3
    finally:
        for name in names:
            spark.conf.unset(name)


def test_a_record_longer_than_many_ranges(spark, tmp_path, rows):
    long = "\n".join(f"line {n}" for n in range(400))
    (tmp_path / "a.csv").write_text(f'1;"{long}";x\n2;"{long}";y\n3;z;z\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        found = rows(read_split_dump(spark, str(tmp_path), ABC))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [("1", long, "x"), ("2", long, "y"), ("3", "z", "z")]


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_split_dump(spark, str(tmp_path), ABC).count() == 0
