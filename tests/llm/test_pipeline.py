import importlib.util

import corpus_pipeline
from firmbook.llm import jaccard, packing, quality
from test_jaccard import brute as of_jaccard
from test_substrings import brute as of_substrings


def test_stages_equal_brute_force(spark, given, tmp_path):
    """Each stage against a plain computation on what its predecessor kept."""
    folder = "/root/testdata/sf0.001"
    docs = given("documents")
    held = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        held.append({r.doc_id: r for r in docs.collect()} if number < 4 else docs.collect())
        if number < 4:
            assert docs.columns == given("documents").columns and docs.count() == len(held[-1])
    first = {r.doc_id: r for r in given("documents").collect()}
    keep = {r.doc_id for r in quality.score(given("documents"), given("labels")).where("keep").collect()}
    good, single, fresh, unseen, packed = held
    assert set(good) == keep and all(good[i] == first[i] for i in good)
    texts = [(i, r.text) for i, r in good.items()]
    assert set(single) == {c for _, _, c in of_jaccard(texts)}
    removed = {i: n for i, _, n, _ in of_substrings([(i, r.text) for i, r in single.items()])}
    assert set(fresh) == set(single) and any(removed.values())
    for i, row in fresh.items():
        assert len(row.text.split()) == len(single[i].text.split()) - removed[i]
        assert row.n_chars == (len(row.text) if removed[i] else single[i].n_chars)
    assert set(unseen) < set(fresh)
    words = {i: len(r.text.split()) for i, r in unseen.items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_words
        assert r.capacity in packing.LENGTHS
    assert got == {i: n for i, n in words.items() if n}
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, again.collect())) == sorted(map(str, packed))


def test_registered(spark):
    import __spark_entry__ as entry

    assert importlib.util.find_spec("corpus_pipeline") and "pipeline" in entry.queries()
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert jaccard.SHINGLE == 5 and [n for n, _ in corpus_pipeline.STAGES][1] == "n-gram Jaccard join"


def test_empty_tables(spark, no_docs, given):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, "/root/testdata/sf0.001").count() == 0, name
