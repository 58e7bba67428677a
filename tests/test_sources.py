import gzip
import io
import random
import zipfile
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from firmbook.layout import COMPANY_MEMBER, NULL_TOKENS
from firmbook.sources.archives import unpack_zips
from firmbook.sources.dumps import read_dump, rows_per_file
from firmbook.sources.lookups import (
    inline_lookup,
    qualification_lookup,
    read_lookup,
    reason_lookup,
    size_lookup,
)
from firmbook.sources.snapshots import latest_snapshot
from firmbook.sources.tables import read_inferred_csv, read_lenient_csv, read_table_csv

ABC = ("a", "b", "c")


@pytest.fixture
def dump(tmp_path):
    def write(*lines, name="dump.csv", end="\n"):
        path = tmp_path / name
        path.write_bytes(end.join([*lines, ""]).encode("latin-1"))
        return str(path)

    return write


def test_uneven_rows(spark, dump, rows):
    path = dump(
        '"1";"Mãe; Cia";"c"',
        '"2";"short"',
        '"3";"b";"c";"long"',
        '"4";"b";"c";""',
        "5;b;c;",
        '"6";"a ""q"" z";"c"',
        "",
        "   ",
        '"7";"back\\";" c "',
        '8;a"b;c;d"e',
        '"9";"open;d;e',
    )
    df = read_dump(spark, path, ABC)
    assert rows(df) == [
        ("1", "Mãe; Cia", "c"),
        ("2", "short", None),
        ("6", 'a "q" z', "c"),
        ("7", "back\\", " c "),
        ("9", "open;d;e", None),
    ]
    # What is selected must not change which rows there are.
    assert df.count() == 5
    assert {r.b for r in df.select("b").collect()} == {'a "q" z', "Mãe; Cia", "back\\", "short", "open;d;e"}
    assert df.select("c").distinct().count() == 3


def test_windows_line_ends_and_empty_file(spark, dump, rows, tmp_path):
    dump('"1";"x";"y"', '"2";"x";"y"', name="a.csv", end="\r\n")
    (tmp_path / "empty.csv").touch()
    assert rows(read_dump(spark, str(tmp_path / "*.csv"), ABC)) == [
        ("1", "x", "y"),
        ("2", "x", "y"),
    ]


def test_null_tokens(spark, dump, rows):
    path = dump(*(f'"{token}";"na";"Null"' for token in NULL_TOKENS))
    assert rows(read_dump(spark, path, ABC)) == [(None, "na", "Null")] * len(NULL_TOKENS)
    kept = read_dump(spark, path, ABC, null_tokens=())
    assert kept.where(F.col("a") == "NA").count() == 1


def test_quoted_line_break(spark, dump, rows):
    path = dump('"1";"two', 'lines";"c"', '"2";"b";"c"')
    assert rows(read_dump(spark, path, ABC, multi_line=True)) == [
        ("1", "two\nlines", "c"),
        ("2", "b", "c"),
    ]


def test_same_rows_as_pandas(spark, dump):
    """Random uneven, quoted, blank and token-laden lines, read by both."""
    chance = random.Random(5)
    pieces = ["x", "", "NA", "null", 'say ""hi""', "a;b", "Ação", " pad ", "0001", "n/a", "é;;"]

    def field():
        if chance.random() < 0.1:
            return chance.choice(['mid"dle', 'two"in"it', 'end"', '""', "7"])
        text = chance.choice(pieces)
        quoted = ";" in text or '"' in text or chance.random() < 0.6
        return f'"{text}"' if quoted else text

    lines = ['"first";"b";"c"']
    for _ in range(3000):
        lines.append(";".join(field() for _ in range(chance.choice([1, 2, 3, 3, 3, 3, 4, 5]))))
    path = dump(*lines)
    want = pd.read_csv(
        path,
        sep=";",
        header=None,
        names=list(ABC),
        dtype=str,
        encoding="latin1",
        on_bad_lines="skip",
    )
    want = sorted(repr(tuple(None if v != v else v for v in r)) for r in want.itertuples(index=False))
    got = sorted(repr(tuple(r)) for r in read_dump(spark, path, ABC).collect())
    assert len(got) > 1500
    assert got == want


def test_failed_files(spark, dump, tmp_path, rows):
    dump('"1";"x";"y"', name="good.csv")
    whole = gzip.compress(b'"2";"x";"y"\n' * 50_000)
    (tmp_path / "cut.csv.gz").write_bytes(whole[:40])
    (tmp_path / "none.csv.gz").write_bytes(b"no gzip at all")
    df = read_dump(spark, str(tmp_path), ABC, skip_failed_files=True)
    assert ("1", "x", "y") in rows(df.distinct())
    with pytest.raises(Exception):
        read_dump(spark, str(tmp_path), ABC).collect()


def test_rows_per_file(spark, dump, tmp_path):
    dump("1;2;3", "4;5;6", name="one.csv")
    dump("7;8;9", name="two.csv")
    counted = rows_per_file(spark.read.schema("a string").csv(str(tmp_path)))
    found = {r.file and r.file.rsplit("/", 1)[-1]: r.n_rows for r in counted.collect()}
    assert found == {"one.csv": 2, "two.csv": 1, None: 3}


def _zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zipped:
        for name, text in members.items():
            zipped.writestr(name, text.encode("latin-1"))


def test_unpack_zips(spark, tmp_path, rows):
    source, out = tmp_path / "zips", tmp_path / "out"
    source.mkdir()
    _zip(
        source / "Empresas0.zip",
        {"K1.D1.EMPRECSV": '"1";"São";"c"\n', "k2.emprecsv": '"2";"b";"c"\n', "notes.txt": "x"},
    )
    _zip(source / "Empresas1.zip", {"K1.D1.EMPRECSV": '"3";"b";"c"\n', "S.SOCIOCSV": "9;9;9\n"})
    (source / "Empresas2.zip").write_bytes(b"damaged")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as zipped:
        zipped.writestr("K9.EMPRECSV", "4;4;4\n" * 100)
    spoiled = bytearray(buffer.getvalue())
    spoiled[60] ^= 0xFF
    (source / "Empresas3.zip").write_bytes(spoiled)

    def unpack():
        report = unpack_zips(spark, str(source / "*.zip"), COMPANY_MEMBER, str(out)).collect()
        good = [r for r in report if r.error is None]
        return len(good), len(report) - len(good)

    assert unpack() == (3, 2)
    first = sorted(p.name for p in out.iterdir())
    assert unpack() == (3, 2)  # again: the same files, no more
    assert sorted(p.name for p in out.iterdir()) == first
    assert not [n for n in first if n.endswith(".part")]
    assert rows(read_dump(spark, str(out), ABC)) == [
        ("1", "São", "c"),
        ("2", "b", "c"),
        ("3", "b", "c"),
    ]
    assert sorted(p.name for p in source.iterdir())[0] == "Empresas0.zip"


def test_inferred_types_keep_codes(spark, dump):
    path = dump("code;n;when", "0001;12;2024-01-05", "0002;7;2024-02-06")
    df = read_inferred_csv(spark, path, keep_text=["code"])
    assert [t for _, t in df.dtypes] == ["string", "int", "date"]
    assert df.first().code == "0001"


def test_header_tables(spark, dump, rows):
    path = dump("a;b;c", "1;NA;x", "2;y;z")
    assert rows(read_table_csv(spark, path, ABC, encoding="ISO-8859-1")) == [
        ("1", None, "x"),
        ("2", "y", "z"),
    ]
    path = dump("a;b;c", "1;NA;x", "2", "3;4;5;6", name="uneven.csv")
    assert rows(read_lenient_csv(spark, path, ABC)) == [("1", "NA", "x"), ("2", None, None)]


def test_lookups(spark, dump, rows):
    path = dump("id;nome", '"01";"Mãe"', name="lookup.csv")
    named = read_lookup(spark, path, "id", "nome", header=True, encoding="ISO-8859-1")
    assert rows(named) == [("01", "Mãe")]
    path = dump('"00";"x"', '"07";"y; z"', name="bare.csv")
    assert rows(read_lookup(spark, path)) == [("00", "x"), ("07", "y; z")]
    for own, size in ((size_lookup, 4), (reason_lookup, 63), (qualification_lookup, 68)):
        lookup = own(spark)
        assert lookup.count() == lookup.select("codigo").distinct().count() == size
    odd = [("'", "it's \\ \"quoted\""), ("\\'", "%s")]
    assert rows(inline_lookup(spark, odd)) == sorted(odd, key=repr)


@pytest.mark.parametrize(
    "as_of, month",
    [
        (date(2024, 5, 31), "2024-03"),
        (date(2024, 2, 1), "2023-06"),
        (date(2024, 4, 30), "2024-03"),
        (date(2025, 1, 1), "2024-03"),
        (date(2025, 2, 1), None),
    ],
)
def test_latest_snapshot(spark, tmp_path, as_of, month):
    table = spark.createDataFrame(
        [(1, "2023-06"), (2, "2024-03"), (3, "2024-03"), (4, "2026-01")], "id int, mes string"
    )
    path = str(tmp_path / "t")
    table.write.partitionBy("mes").parquet(path)
    got = latest_snapshot(spark.read.schema("id int, mes string").parquet(path), "mes", as_of)
    assert {r.mes for r in got.collect()} == ({month} if month else set())


def test_latest_snapshot_reads_one_month(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(120).selectExpr("id", "concat('2024-', lpad(id % 12 + 1, 2, '0')) as mes").write.partitionBy(
        "mes"
    ).parquet(path)
    got = latest_snapshot(spark.read.schema("id long, mes string").parquet(path), "mes", date(2024, 12, 9))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "id#" in line)
    assert "PartitionFilters" in scan and "Subquery" in scan
