import zlib

import pytest
from pyspark.sql import functions as F

from firmbook.llm import sharding
from firmbook.llm.queries import QUERIES


def test_query_obeys_its_law(spark, given):
    rows = QUERIES["op6_sharding"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: (r.text or "").encode() for r in given("documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        assert row.law == "key" and 0 <= row.shard < 16
        assert row["size"] == len(texts[row.doc_id]) + 1 and row.text_crc32 == zlib.crc32(texts[row.doc_id])
        assert row.grown_shard in (row.shard, 16)
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_depend_on_the_id_alone(spark, given):
    docs = given("documents")
    first = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.place_rows(docs).collect()}
    other = docs.where("doc_id % 3 = 0").withColumn("text", F.lit("changed")).repartition(3)
    part = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.place_rows(other).collect()}
    assert part and all(first[i] == place for i, place in part.items())
    grown = {r.doc_id: r.shard for r in sharding.place_rows(docs, shards=17).collect()}
    assert all(grown[i] == more for i, (_, more) in first.items())


@pytest.mark.parametrize("bucket_rows", [3, 1000])
def test_buckets_are_bounded_and_shuffled(spark, bucket_rows):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sharding.place_rows(docs, shards=4, bucket_rows=bucket_rows).orderBy("shard", "slot").collect()
    assert len(rows) == 2000
    order = [r.doc_id for r in rows if r.shard == 0]
    assert order != sorted(order) and order != sorted(order, reverse=True)
    assert [r.slot for r in rows if r.shard == 0] == list(range(len(order)))


def test_copies_of_one_row_spread(spark):
    docs = spark.range(0, 4000, 1, 8).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    placed = sharding.scatter(docs.withColumn("size", F.lit(5)), "size", 2, 7, 1 << 30, 200)
    assert placed.select("shard").distinct().count() == 1
    assert placed.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 300


@pytest.mark.parametrize("partitions", [1, 7])
def test_no_bucket_is_much_larger_than_its_bound(spark, partitions):
    """Copies of one row, in one input partition too, null ids, and a single long text among short ones."""
    copies = spark.range(0, 20_000, 1, partitions).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    for docs in (copies, copies.withColumn("doc_id", F.lit(None).cast("long"))):
        placed = sharding.scatter(docs.withColumn("size", F.lit(5)), "size", 16, 7, 1 << 30, 200)
        assert placed.groupBy("shard", "bucket").count().agg(F.max("count")).first()[0] <= 400
    first = sorted(map(tuple, sharding.place_rows(copies, bucket_rows=200).select("shard", "slot").collect()))
    assert [slot for _, slot in first] == list(range(20_000))


def test_written_shards_hold_whole_rows(spark, tmp_path, odd_docs, no_docs):
    path = str(tmp_path / "shards")
    sharding.write_shards(odd_docs, path, shards=3, bucket_rows=2)
    back = spark.read.parquet(path)
    key = lambda r: tuple(map(str, r))
    assert sorted((key(r.doc) for r in back.collect())) == sorted(key(r) for r in odd_docs.collect())
    for shard, slots in back.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(len(slots)))
    assert sharding.place_rows(odd_docs).count() == 10 and sharding.place_rows(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of("doc_id", 0, 1)


def test_native(odd_docs):
    plan = sharding.place_rows(odd_docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_query_reads_back_the_whole_rows_it_wrote(spark, odd_docs):
    placed = sharding.place_rows(odd_docs, shards=3, bucket_rows=2)
    files = placed.inputFiles()
    assert files and all("/shards/shard=" in f for f in files)
    back = spark.read.parquet(files[0].split("/shard=")[0])
    key = lambda r: tuple(map(str, r))
    assert sorted(key(r.doc) for r in back.collect()) == sorted(key(r) for r in odd_docs.collect())
    got = sorted(map(tuple, placed.select("shard", "slot", "doc_id").collect()), key=str)
    assert got == sorted(map(tuple, back.select("shard", "slot", "doc.doc_id").collect()), key=str)
