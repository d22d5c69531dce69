import tracemalloc
import zlib

import numpy as np
import pytest

from tessera.llm import toxicity as X

from awkward_tables import awkward, no_documents, no_labels  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = X.Net.fresh(rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(size=(9, 2 * X.DIM))
    idx = rng.integers(0, 9, (5, X.WINDOW))
    y, w = np.array([0, 1, 1, 0, 1.0]), np.array([1, 2, 1, 1, 0.5])

    def loss():
        f = net.forward(x, idx).astype(np.float64)
        return float((w * (np.logaddexp(0, f) - y * f)).mean())

    g, dx = net.gradients(x.copy(), idx, y, w)
    for name, p in list(net.p.items()) + [("x", x)]:
        grad = dx if name == "x" else g[name]
        flat = p.reshape(-1)
        for k in rng.choice(len(flat), min(4, len(flat)), replace=False):
            keep = flat[k]
            flat[k] = keep + 1e-3
            up = loss()
            flat[k] = keep - 1e-3
            down = loss()
            flat[k] = keep
            assert abs((up - down) / 2e-3 - grad.reshape(-1)[k]) < 2e-3, name


def test_windows_overlap_and_hold_every_word():
    first = np.array([0, 0, 1, 17, 117])
    step, text, before = X.windows(first)
    assert before.tolist()[:3] == [0, 1, 2] and (step[0] == -1).all()
    for t in range(4):
        held = step[text == t]
        assert set(held[held >= 0].tolist()) == set(range(first[t], first[t + 1]))
    long = step[text == 3]
    assert len(long) > 2 and all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(long, long[1:], strict=False))


def test_score_does_not_depend_on_the_piece():
    rows = [(k % 2, (b"calm words only " * 9) + (b"foulword " if k % 2 else b"") + b"the end %d" % k) for k in range(80)]
    net = X.train(rows)
    texts = [r[1] for r in rows[:20]] + [b"", b"   "]
    together = X.score_texts(net, texts)
    assert np.allclose(together, [X.score_texts(net, [t])[0] for t in texts], atol=1e-5)
    assert together[1:20:2].min() > together[0:20:2].max()


def test_training_holds_no_texts_and_few_bytes_for_one_of_text():
    words = [b"%s%d" % (w, k) for k in range(1500) for w in (b"harmless", b"meadow", b"gardener")]
    rng = np.random.default_rng(3)
    n, size = 700, 0

    def rows():
        nonlocal size
        for k in range(n):
            text = b" ".join(words[i] for i in rng.integers(0, len(words), 800))
            size += len(text)
            yield k % 2, text

    tracemalloc.start()
    try:
        net = X.train(rows(), rounds=0)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert net.constant is None and peak < 12 * size     # 13.5 when all temporary arrays lived on


@pytest.fixture(scope="module")
def scored(spark):
    rows = X.toxicity_query(spark, SF).collect()
    return rows, {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_held_out_rows_are_told_apart(scored):
    rows, labels = scored
    test = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad, good = [s for s, y in test if y], [s for s, y in test if not y]
    assert np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad]) > 0.7
    assert np.mean([(s >= 0.3) == y for s, y in test]) > 0.85


def test_folds_and_predictions(scored):
    for r in scored[0]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_awkward_rows(spark, awkward, no_documents, no_labels):
    net = X.fit(spark, awkward, no_labels, X.train_rows)
    assert net.constant == 0.0
    kept = awkward.where(X.scorer(spark, net)(X.F.coalesce(X.F.col("text"), X.F.lit(""))) < X.THRESHOLD)
    assert kept.count() == awkward.count() and kept.columns == awkward.columns
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (7, 0, 1), (None, 0, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    some = X.fit(spark, awkward, labels, X.train_rows)
    scores = awkward.select("doc_id", X.scorer(spark, some)(X.F.coalesce(X.F.col("text"), X.F.lit(""))).alias("s")).collect()
    assert len(scores) == awkward.count() and all(0 <= r["s"] <= 1 for r in scores)
    assert X.fit(spark, no_documents, no_labels, X.train_rows).constant == 0.0
