import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from firmbook.functions.values import (
    amount_or_zero,
    clip_text,
    compact_date,
    decimal_comma,
    establishment_key,
    round_places,
)
from firmbook.layout import COMPANIES, COMPANY_TABLE, ESTABLISHMENT_TABLE, ESTABLISHMENTS, PARTNERS
from firmbook.operators.sinks import (
    column_types,
    publish_staged,
    save_table,
    write_csv,
    write_jdbc,
    write_parquet,
)
from firmbook.operators.storage import compression_ratio, dataset_bytes
from firmbook.plans import flows, quality
from firmbook.sources.databases import read_jdbc
from firmbook.sources.snapshots import latest_snapshot
from firmbook.sources.tables import read_lenient_csv, read_table_csv
from firmbook.streaming.ingest import incremental_ingest
from harness.landing import land_dump


def table(spark, columns, *rows):
    return spark.createDataFrame(
        [tuple(row.get(c) for c in columns) for row in rows], ", ".join(f"{c} string" for c in columns)
    )


@pytest.mark.parametrize(
    "text, value, amount",
    [("1234,50", 1234.5, 1234.5), ("0", 0.0, 0.0), ("", None, 0.0), (None, None, 0.0),
     ("x", None, 0.0), ("1.234,5", None, 0.0), ("-3,1", -3.1, -3.1)],
)
def test_decimal_comma(spark, text, value, amount):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(decimal_comma("t"), amount_or_zero("t")).first()) == (value, amount)


@pytest.mark.parametrize(
    "value, want", [(8201.925, 8201.92), (2.675, 2.68), (0.125, 0.13), (-0.125, -0.13), (None, None)]
)
def test_round_places(spark, value, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round_places("x")).first()[0] == want


@pytest.mark.parametrize(
    "text, want",
    [("20240229", datetime.date(2024, 2, 29)), ("20230229", None), ("0", None), ("", None), (None, None)],
)
def test_compact_date(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(compact_date("t")).first()[0] == want


def test_texts_and_keys(spark):
    df = spark.createDataFrame([("12345678", "0001", "95"), ("1", None, "2")], "a string, b string, c string")
    got = df.select(establishment_key("a", "b", "c"), clip_text("a", 3), clip_text("b", 2)).collect()
    assert [tuple(r) for r in got] == [("12345678000195", "123", "00"), (None, "1", "")]


def test_load_companies(spark):
    companies = table(
        spark,
        COMPANIES,
        {"cnpj_basico": "1" * 20, "razao_social": "é" * 300, "capital_social": "1,005", "porte_empresa": "p" * 60},
        {"cnpj_basico": None, "capital_social": None},
        {"cnpj_basico": "3", "capital_social": "9" * 16},
    )
    loaded = flows.load_companies(companies)
    declared = {f.name: f.dataType.simpleString() for f in COMPANY_TABLE}
    assert loaded.columns == [c for c in declared if c != "id"]
    first, second, third = loaded.collect()
    assert first.cnpj_basico == "1" * 15 and first.razao_social == "é" * 200
    assert first.porte_empresa == "p" * 50
    assert first.data_criacao is not None
    assert second.cnpj_basico == "" and second.razao_social == ""
    assert second.capital_social == Decimal("0.00")
    assert third.capital_social is None  # does not fit


def test_load_establishments(spark):
    made = {"cnpj_basico": "12345678", "cnpj_ordem": "0001", "cnpj_dv": "95", "uf": "SPX",
            "data_situacao_cadastral": "20240131", "numero": "12345678901", "email": "a@b"}
    loaded = flows.load_establishments(table(spark, ESTABLISHMENTS, made))
    row = loaded.first()
    assert row.cnpj_completo == "12345678000195" and row.uf == "SP" and row.numero == "1234567890"
    assert row.data_situacao_cadastral == datetime.date(2024, 1, 31)
    assert loaded.columns == [f.name for f in ESTABLISHMENT_TABLE if f.name != "id"]


def test_save_table(spark, tmp_path, plan):
    companies = table(spark, COMPANIES, *({"cnpj_basico": f"{i:08d}"} for i in range(200)))
    for name in ("left_t", "right_t"):
        for _ in range(2):  # created once, appended to twice
            save_table(flows.load_companies(companies), name, COMPANY_TABLE, str(tmp_path / name),
                       bucket_by="cnpj_basico", buckets=4)
    left, right = spark.table("left_t"), spark.table("right_t")
    assert left.count() == 400
    assert dict(left.dtypes)["capital_social"] == "decimal(15,2)"
    widths = {r.col_name: r.data_type for r in spark.sql("describe left_t").collect()}
    assert widths["razao_social"] == "varchar(200)"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left.join(right, "cnpj_basico").select("cnpj_basico")
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("files", [1, 2])
def test_bucketed_files(spark, tmp_path, files):
    df = spark.range(0, 20_000, 1, 13).selectExpr("cast(id as string) as cnpj_basico", "uuid() as razao_social")
    place = tmp_path / f"b{files}"
    save_table(df, f"bucketed_{files}", COMPANY_TABLE, str(place), "cnpj_basico", 8, files)
    assert 8 <= len(list(place.glob("*.parquet"))) <= 8 * files


def test_csv_round_trip(spark, tmp_path, rows):
    df = table(
        spark,
        PARTNERS,
        {"cnpj_basico": "00000001", "nome_socio": 'São "José"; & Cia', "pais": ""},
        {"cnpj_basico": "2", "nome_socio": "back\\slash \\"},
        {"cnpj_basico": " 3 ", "nome_socio": "  blanks\nand a line break "},
    )
    path = str(tmp_path / "csv")
    write_csv(df, path)
    write_csv(df, path)
    want = df.withColumn("pais", F.nullif("pais", F.lit("")))
    assert rows(read_table_csv(spark, path, PARTNERS, multi_line=True)) == rows(want)
    assert rows(read_lenient_csv(spark, path, multi_line=True)) == rows(want)


def test_write_parquet_splits_a_hot_partition(spark, tmp_path):
    df = spark.range(200_000).selectExpr(
        "id", "case when id % 2 = 0 then 'SP' else concat('U', id % 9) end as uf", "uuid() as t"
    )
    path = tmp_path / "p"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_parquet(df, str(path), partition_by=["uf"], max_records=60_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((path / "uf=SP").glob("*.parquet"))) > 1
    back = spark.read.parquet(str(path))
    assert back.count() == 200_000
    assert back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 60_000


def test_csv_to_parquet(spark, tmp_path, rows):
    root = tmp_path / "csv"
    companies = table(spark, COMPANIES, *({"cnpj_basico": f"{i:08d}", "razao_social": "x" * 40} for i in range(3000)))
    write_csv(companies, f"{root}/empresas")
    header = ";".join(COMPANIES)
    (root / "empresas" / "more.csv").write_text(f"{header}\n9;long;1;2;3;4;5;6;7;8\n8;short\n")
    saved = flows.csv_to_parquet(spark, str(root), str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet/empresas")).count() == 3001
    by_name = {r.dataset: r for r in saved.collect()}
    assert set(by_name) == {"empresas", None}
    assert by_name["empresas"].saved_percent > 69.3
    assert by_name[None].bytes_before == by_name["empresas"].bytes_before


def test_csv_to_parquet_keeps_all_columns(spark, tmp_path, rows):
    root = tmp_path / "csv"
    wide = table(spark, COMPANIES, *({"cnpj_basico": f"{i:08d}", "razao_social": f" n{i}\nx "} for i in range(50)))
    wide = wide.withColumn("porte_empresa_descricao", F.lit("MICRO EMPRESA"))
    write_csv(wide, f"{root}/empresas")
    flows.csv_to_parquet(spark, str(root), str(tmp_path / "parquet"), multi_line=True)
    assert rows(spark.read.parquet(str(tmp_path / "parquet/empresas"))) == rows(wide)
    (root / "empresas" / "other.csv").write_text("a;b\n1;2\n")
    with pytest.raises(Exception, match="header"):
        flows.csv_to_parquet(spark, str(root), str(tmp_path / "again"))


def test_columns_by_header_name(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text("b;a\n1;2\n")
    for read in (read_table_csv, read_lenient_csv):
        assert rows(read(spark, str(tmp_path / "t.csv"), ("a", "b"))) == [("2", "1")]
        with pytest.raises(ValueError, match="no c"):
            read(spark, str(tmp_path / "t.csv"), ("a", "c"))


def test_empty_datasets(spark, tmp_path):
    root = tmp_path / "root"
    root.mkdir()
    (root / "empresas_final.csv").write_text("")
    spark.range(0).write.parquet(str(root / "none"))
    found = {r.dataset: r.n_bytes for r in dataset_bytes(spark, str(root)).collect()}
    assert found["empresas_final.csv"] == 0 and found["none"] > 0
    assert quality.dataset_inventory(spark, str(root), ["empresas_final.csv"]).first()[1:] == (True, 0.0)
    sizing = quality.partition_sizing(spark, str(root), "none").first()
    assert sizing.n_rows == 0 and sizing.mb_per_row is None and sizing.rows_per_target is None
    empty = dataset_bytes(spark, str(root)).where("n_bytes = 0")
    assert {r.saved_percent for r in compression_ratio(empty, empty).collect()} == {None}


def test_sample_check_reads_the_pages(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(0, 5000, 1, 1).selectExpr("id", "uuid() as t").write.parquet(str(path))
    (file,) = path.glob("*.parquet")
    data = bytearray(file.read_bytes())
    data[200:2000] = bytes(1800)
    file.write_bytes(data)
    for crc in path.glob(".*.crc"):
        crc.unlink()
    good = spark.range(10)
    report = quality.sample_check({"bad": spark.read.parquet(str(path)), "good": good}).collect()
    assert report[0].n_rows is None and report[0].error and report[1][1:] == (10, None)
    assert quality.first_rows(good, 3).count() == 3


def test_storage_reports(spark, tmp_path):
    for name, size in (("a", 10), ("b", 1000)):
        spark.range(size).write.parquet(str(tmp_path / "root" / name))
    root = str(tmp_path / "root")
    sizes = {r.dataset: r.n_bytes for r in dataset_bytes(spark, root).collect()}
    on_disk = {n: sum(f.stat().st_size for f in (tmp_path / "root" / n).glob("*.parquet")) for n in "ab"}
    assert sizes == on_disk
    found = quality.dataset_inventory(spark, root, ["a", "missing"]).collect()
    assert {(r.dataset, r.present) for r in found} == {("a", True), ("missing", False)}
    sizing = quality.partition_sizing(spark, root, "b").first()
    assert sizing.n_rows == 1000
    assert sizing.rows_per_target == int(100 / (on_disk["b"] / 1024 / 1024 / 1000))
    ratio = compression_ratio(dataset_bytes(spark, root), dataset_bytes(spark, root))
    assert {r.saved_percent for r in ratio.collect()} == {0.0}
    counted = {name: spark.read.parquet(f"{root}/{name}") for name in "ab"}
    assert {tuple(r) for r in quality.row_counts(counted).collect()} == {("a", 10), ("b", 1000)}
    assert {tuple(r) for r in quality.sample_check(counted, 50).collect()} == {("a", 10, None), ("b", 50, None)}


def test_incremental_ingest(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    batch = table(spark, PARTNERS, *({"cnpj_basico": str(i), "pais": "NA"} for i in range(10)))

    def run():
        incremental_ingest(spark, landing, PARTNERS, target, checkpoint, max_files_per_batch=1)
        return spark.read.parquet(target).count()

    land_dump(batch, landing)
    (tmp_path / "in" / "uneven.csv").write_text("1;2;3\n" + ";".join("123456789abcd") + "\n")
    assert run() == 11
    assert run() == 11
    land_dump(batch.limit(4), landing, mode="append")
    assert run() == 15
    assert spark.read.parquet(target).where("pais is not null").count() == 0


def test_monthly_ingest(spark, tmp_path):
    target = str(tmp_path / "table")

    def land(month, size):
        rows = table(spark, COMPANIES, *({"cnpj_basico": f"{i:08d}"} for i in range(size)))
        path = land_dump(rows, str(tmp_path / f"dump-{month}-{size}"))
        return flows.ingest_companies(spark, path, target, month=month)

    land("2024-02", 3)
    land("2024-03", 5)
    stored = land("2024-02", 4)  # again: replaces that month only
    assert dict(stored.dtypes)["mes"] == "string"
    assert {r.mes: r["count"] for r in stored.groupBy("mes").count().collect()} == {
        "2024-02": 4,
        "2024-03": 5,
    }
    assert latest_snapshot(stored, "mes", datetime.date(2024, 2, 28)).count() == 4
    assert latest_snapshot(stored, "mes", datetime.date(2024, 9, 1)).count() == 5


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **more):
        self.told |= more
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = True


def test_jdbc_options(spark):
    class Holder:
        read = write = None

    reader, session = Recorder(), Holder()
    session.read = reader
    told = read_jdbc(session, "jdbc:x:y", "select 1", {"user": "u"})
    assert told == {"format": "jdbc", "url": "jdbc:x:y", "user": "u", "query": "select 1"}
    session.read = Recorder()
    told = read_jdbc(session, "jdbc:x:y", "select id from t", None, "id", 1, 100, 4)
    assert "query" not in told and told["dbtable"].startswith("(select id from t)")
    assert (told["lowerBound"], told["upperBound"], told["numPartitions"]) == ("1", "100", "4")

    frame = Holder()
    frame.write, frame.columns = Recorder(), ["cnpj_basico", "capital_social"]
    write_jdbc(frame, "jdbc:x:y", "t", {"user": "u"}, declared=COMPANY_TABLE)
    assert frame.write.told["batchsize"] == 50_000 and frame.write.told["saved"]
    assert frame.write.told["createTableColumnTypes"] == "cnpj_basico VARCHAR(15), capital_social DECIMAL(15,2)"
    assert "data_criacao TIMESTAMP" in column_types(flows.load_companies(table(spark, COMPANIES, {})), COMPANY_TABLE)


class Connection:
    def __init__(self, count, fails=False):
        self.count, self.fails, self.log = count, fails, []

    def cursor(self):
        return self

    def execute(self, sql):
        self.log.append(sql)
        if self.fails and sql.startswith("INSERT"):
            raise RuntimeError("refused")

    def fetchone(self):
        return (self.count,)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_publish_staged():
    good = Connection(5)
    publish_staged(good, "s", "t", ["a", "b"], 5)
    assert good.log[1:] == ["INSERT INTO t (a, b) SELECT a, b FROM s", "commit", "close"]
    for bad, error in ((Connection(6), ValueError), (Connection(5, fails=True), RuntimeError)):
        with pytest.raises(error):
            publish_staged(bad, "s", "t", ["a", "b"], 5)
        assert "commit" not in bad.log and bad.log[-2:] == ["rollback", "close"]
