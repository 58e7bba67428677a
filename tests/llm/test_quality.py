import numpy as np

from firmbook.llm import quality
from firmbook.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_labels(spark, given):
    """Learned without a fifth of the labels, and scored on that fifth."""
    docs, labels = given("documents", FOLDER), given("labels", FOLDER)
    found = {r.doc_id: r for r in quality.score(docs, labels.where("doc_id % 5 <> 0")).collect()}
    held = [(r.quality, found[r.doc_id].keep) for r in labels.where("doc_id % 5 = 0").collect()]
    assert np.mean([bool(q) == keep for q, keep in held]) > 0.95
    assert np.mean([keep for q, keep in held if q]) > 0.98


def test_query_covers_all_rows(spark, given):
    rows = QUERIES["op4_quality_classifier"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in given("documents", FOLDER).select("doc_id").collect())
    assert all(0 <= s <= 1 for r in rows for s in (r.text_score, r.meta_score, r.score)) and all(r.keep == (r.score >= 0.5) for r in rows)


def test_views_teach_each_other():
    """The text view sees too few labels of a kind that the metadata tells apart."""
    rng = np.random.default_rng(1)

    def rows(n, shown):
        good = rng.random(n) < 0.5
        noise = rng.normal(size=(n, 4))
        text = np.column_stack([np.ones(n), np.where(good, 1, -1)[:, None] * rng.random((n, 12)) * 2 * (rng.random((n, 12)) < 0.3), noise])
        meta = np.column_stack([np.ones(n), np.where(good, 4, -4) * (1 if shown else 1) + rng.normal(size=n)])
        return text, meta, good.astype(float)

    labelled, pool, test = rows(25, True), rows(3000, True), rows(3000, True)
    accuracy = {}
    for rounds in (0, 3):
        model = quality.co_train(labelled, pool[:2], rounds)
        accuracy[rounds] = ((test[0] @ model.text > 0) == (test[2] > 0)).mean()
    assert accuracy[3] > accuracy[0]


def test_odd_rows(spark, odd_docs, no_docs, given):
    labels = given("labels", FOLDER)
    assert quality.score(odd_docs, labels).count() == 10 and quality.score(no_docs, labels).count() == 0
    unlabelled = quality.score(odd_docs, labels.where("false")).collect()
    assert {r.score for r in unlabelled} == {0.5} and all(r.keep for r in unlabelled)
    one_kind = spark.createDataFrame([(4, 1), (8, 1), (None, 0), (5, None)], "doc_id long, quality int")
    kept = quality.good_only(odd_docs, one_kind)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd_docs.collect()))
    bare = quality.score(odd_docs.select("doc_id", "text"), labels)
    assert bare.count() == 10
