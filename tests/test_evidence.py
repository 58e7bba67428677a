import datetime
import decimal

from firmbook.sources.evidence import add_evidence, evidence, evident_types, read_evident_csv


def types(df):
    return {c: t.simpleString() for c, t in evident_types(evidence(df)).items()}


def test_the_narrowest_type_of_all_values(spark):
    rows = [
        ("0001", "12", "1.5", "2024-01-05", "2024-01-05 10:00:00", "true", "3000000000", "9" * 30, "x", None, "1", "2024-02-30", "-7", "0"),
        ("0002", None, "-2e3", "2024-02-06", "2024-01-05", "FALSE", "1", "1", "1", None, "a", "2024-01-01", "07", "0.5"),
    ]
    names = "code n real day time truth long huge text none mixed badday padded zero".split()
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))
    assert types(df) == {
        "code": "string", "n": "int", "real": "double", "day": "date", "time": "timestamp", "truth": "boolean", "long": "bigint",
        "huge": "decimal(38,0)", "text": "string", "none": "string", "mixed": "string", "badday": "string", "padded": "string", "zero": "double",
    }


def test_evidence_adds_up(spark):
    rows = [("1", "2024-01-01", "5"), ("2", "x", "06"), ("3000000000", "2024-01-01 00:00:00", "7"), (None, None, "8")]
    schema = "a string, `b.c` string, d string"
    whole = spark.createDataFrame(rows, schema)
    parts = [evidence(spark.createDataFrame([r], schema)) for r in rows]
    assert sorted(map(tuple, add_evidence(*parts).collect())) == sorted(map(tuple, evidence(whole).collect()))
    assert types(whole) == {"a": "bigint", "b.c": "string", "d": "string"}


def test_read(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('code;n;when;big\n0001;12;2024-01-05;"1"\n0002;;2024-02-06;12345678901234567890\n')
    df = read_evident_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["string", "int", "date", "decimal(38,0)"]
    assert df.first()[:] == ("0001", 12, datetime.date(2024, 1, 5), decimal.Decimal(1))
    # Other files of the table had something else in it.
    known = evidence(spark.createDataFrame([("x", "1.5", None, None)], "code string, n string, when string, big string"))
    assert [t for _, t in read_evident_csv(spark, str(path), known=known).dtypes] == ["string", "double", "date", "decimal(38,0)"]
    (tmp_path / "empty.csv").write_text("a;b\n")
    assert [t for _, t in read_evident_csv(spark, str(tmp_path / "empty.csv")).dtypes] == ["string", "string"]
