"""The class prior of the toxicity model comes from the documents, not from the choice of labels."""

import numpy as np
import pytest

import corpus_pipeline
from idloom.llm import toxicity


def documents(spark):
    return spark.createDataFrame(
        [(i, f"clean text {i}", 1.0) for i in range(200)] + [(1000 + i, f"you idiot {i}", 1.0) for i in range(60)]
        + [(None, None, None), (5, "", 1.0), (5, "", 1.0), (7, "idiot " * 50000, 1.0)], "doc_id long, text string, score double")


@pytest.mark.parametrize("negatives", [60, 30, 10])
def test_rich_labels_do_not_lift_clean_and_empty_texts(spark, negatives):
    docs = documents(spark)
    labels = spark.createDataFrame([(1000 + i, 1) for i in range(30)] + [(i, 0) for i in range(negatives)] + [(None, 1), (3, None), (1000, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels, "toxic")
    out = {r.doc_id: r.predicted for r in toxicity.predict(docs, model, keep=["doc_id", "score"]).collect()}
    assert out[1050] == 1 and out[7] == 1 and out[150] == 0 and out[None] == 0 and out[5] == 0
    assert toxicity.clean(docs, model).count() == 203


@pytest.mark.parametrize("negatives", [0, 20, 300])
def test_class_prior_is_the_share_among_unlabelled_rows(negatives):
    rng = np.random.default_rng(4)

    def rows(n, toxic):
        return [np.unique(np.r_[rng.choice([7, 8] if toxic else [9, 10]), rng.integers(100, 140, 3)]) for _ in range(n)]

    unlabelled = rows(150, True) + rows(850, False)
    order = rng.permutation(len(unlabelled))
    assert abs(toxicity.class_prior(rows(200, True), rows(negatives, False), [unlabelled[i] for i in order]) - 0.15) < 0.04


def test_pipeline_keeps_documents_labelled_clean(spark, tmp_path):
    """Stage ``toxicity`` with labels of which two in five are toxic, over documents of which one in nine is."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    labels.filter("toxic = 1 OR doc_id % 5 = 0").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.toxic(spark, docs, str(tmp_path)).select("doc_id").collect()}
    of = {y: [r.doc_id in kept for r in labels.filter(f"toxic = {y}").collect()] for y in (0, 1)}
    assert np.mean(of[0]) >= 0.95 and np.mean(of[1]) <= 0.15
