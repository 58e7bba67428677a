"""Files of two encodings in one folder, and texts decoded twice."""

from pyspark.sql import functions as F

from firmbook.sources.encodings import file_encodings, read_any_dump, repair_twice_decoded, repaired

ABC = ["a", "b", "c"]


def test_mixed_folder(spark, tmp_path, rows):
    (tmp_path / "latin.csv").write_bytes('"1";"São José";"ção"\n"2";"plain";"x"\n'.encode("latin-1"))
    (tmp_path / "utf 8.csv").write_bytes('"3";"São José";"ção"\n"4";"€ ñ";"x"\n'.encode())
    (tmp_path / "ascii.csv").write_bytes(b"5;b;c\n")
    # Valid UTF-8 by its first lines only.
    (tmp_path / "late.csv").write_bytes('"6";"São";"x"\n'.encode() + '"7";"São";"x"\n'.encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    found = {r["file"].rsplit("/", 1)[1]: (r["encoding"], r["invalid"]) for r in file_encodings(spark, str(tmp_path)).collect()}
    assert found == {"latin.csv": ("ISO-8859-1", 1), "utf%208.csv": ("UTF-8", 0), "ascii.csv": ("ISO-8859-1", 0), "late.csv": ("ISO-8859-1", 1)}
    read = rows(read_any_dump(spark, str(tmp_path), ABC))
    assert read == [
        ("1", "São José", "ção"), ("2", "plain", "x"), ("3", "São José", "ção"), ("4", "€ ñ", "x"), ("5", "b", "c"),
        ("6", "SÃ£o", "x"), ("7", "São", "x"),
    ]
    named = read_any_dump(spark, str(tmp_path / "empty.csv"), ABC, file_column="file")
    assert named.columns == [*ABC, "file"] and named.count() == 0


def test_repair(spark):
    texts = ["São", "SÃ£o", "Ã", "€ Ã£", "", None, "CafÃ© â\x82¬5", "Â", "plain", "ÃÂ£"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(repair_twice_decoded(F.col("t"))).collect()]
    assert found == ["São", "São", "Ã", "€ Ã£", "", None, "Café €5", "Â", "plain", "ÃÂ£"]
    both = spark.createDataFrame([("SÃ£o", "SÃ£o", 1)], "a string, `b.c` string, n int")
    assert repaired(both).first()[:] == ("São", "São", 1) and repaired(both, ["a"]).first()[:] == ("São", "SÃ£o", 1)
