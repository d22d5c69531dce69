import zlib

import numpy as np
import pytest

from tessera.llm import quality as Q

from awkward_tables import awkward, no_documents, no_labels  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    rows = Q.quality_query(spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return rows, labels


def test_held_out_rows_are_told_apart(scored):
    rows, labels = scored
    test = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in test if y], [s for s, y in test if not y]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.95 and np.mean([(s >= 0.3) == y for s, y in test]) > 0.93


def test_folds_and_predictions(scored):
    for r in scored[0]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_labels_of_the_held_out_fold_do_not_matter(spark, scored):
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(Q.train_rows(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = Q.fit(docs, labels), Q.fit(docs, flipped)
    assert all(np.array_equal(x, y) for x, y in zip(a.net, b.net, strict=True)) and a.calibration == b.calibration


def test_class_prior_of_a_known_mixture():
    rng = np.random.default_rng(2)
    pos, unl = rng.normal(2, 1, 8000), np.concatenate([rng.normal(2, 1, 4800), rng.normal(-2, 1, 3200)])
    assert abs(Q.estimate_prior(pos, unl) - 0.6) < 0.06


def test_non_negative_risk_learns_from_positives_and_unlabelled_only():
    rng = np.random.default_rng(3)
    d = Q.N_FEATURES
    pos = rng.normal(0.5, 1, (3000, d))
    unl = rng.permutation(np.concatenate([rng.normal(0.5, 1, (2100, d)), rng.normal(-0.5, 1, (900, d))]))
    model = Q.train(pos, unl, np.zeros((0, d)), np.zeros(0))
    good, bad = model.score(rng.normal(0.5, 1, (500, d))), model.score(rng.normal(-0.5, 1, (500, d)))
    assert (good > 0.5).mean() > 0.9 and (bad < 0.5).mean() > 0.9


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"", b"one", b"A LINE!! WITH BANGS!!\nA LINE!! WITH BANGS!!", "é ü | x | y".encode(), b" \n "]
    together = Q.features(texts)
    assert np.isfinite(together).all()
    for i, t in enumerate(texts):
        assert np.allclose(Q.features([t])[0], together[i])


def test_awkward_rows(spark, awkward, no_documents, no_labels):
    model = Q.fit(awkward, no_labels)
    assert model.constant == 0.5
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    Q.fit(awkward, labels)
    assert Q.fit(no_documents, no_labels).constant == 0.5
    assert Q.feature_rows(Q.keyed_texts(awkward)).count() == awkward.count()
