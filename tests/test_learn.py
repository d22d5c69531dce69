"""Row positions, shards and data-parallel training against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import learn as L
from tessera.plans import learn_queries as LQ
from tessera.sources import fixtures as FX

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def samples(spark):
    """137 rows (unequal shards) of 6 features in 8 input splits, keys out of order."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(137, 6))
    y = (x[:, 0] + 0.3 * x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    rows = [(int(k), [float(v) for v in x[k]], int(y[k])) for k in rng.permutation(137)]
    return x, y, spark.createDataFrame(rows, "vec_id long, features array<double>, label int").repartition(8)


def numpy_training(x, y, batch, epochs, rate, classes=3):
    w, b = L.first_weights(x.shape[1], classes)
    for _ in range(epochs):
        for s in range(0, len(x), batch):
            gw, gb = L.softmax_gradient(w, b, x[s:s + batch], y[s:s + batch])
            n = len(x[s:s + batch])
            w, b = w - rate * gw / n, b - rate * gb / n
    return w, b


def test_positions_of_a_million_rows_in_eight_splits(spark):
    df = spark.range(0, 1_000_000, 1, 8).select((F.col("id") * 7919 % 1_000_003).alias("k"))
    pos = L.with_row_position(df, "k", "pos")
    back = pos.join(pos.select(F.col("pos").alias("p2"), F.col("k").alias("k2")), F.col("pos") + 1 == F.col("p2"))
    n, distinct, low, high = pos.agg(F.count("pos"), F.countDistinct("pos"), F.min("pos"), F.max("pos")).first()
    assert (n, distinct, low, high) == (1_000_000, 1_000_000, 0, 999_999)
    assert back.where(F.col("k") >= F.col("k2")).count() == 0


@pytest.mark.parametrize("workers", range(1, 9))
def test_every_rank_has_a_task_of_its_own(spark, samples, workers):
    shards = L.make_shards(samples[2], "features", "label", workers, "vec_id")
    seen = (L.ranged_by_rank(shards.rows, workers).withColumn("task", F.spark_partition_id())
            .groupBy("task").agg(F.collect_set("__rank").alias("ranks"), F.count(F.lit(1)).alias("n")).collect())
    assert sorted((r["task"], r["ranks"]) for r in seen) == [(k, [k]) for k in range(workers)]
    assert sum(r["n"] for r in seen) == 137 and max(r["n"] for r in seen) == shards.largest


def test_one_worker_equals_two_workers_equals_numpy(spark, samples):
    x, y, df = samples
    expected = numpy_training(x, y, 32, 2, 0.1)
    one = L.train_softmax_data_parallel(df, "features", "label", 3, 1, epochs=2, batch_size=32, scale_lr=False)
    two = L.train_softmax_data_parallel(df, "features", "label", 3, 2, epochs=2, batch_size=16, scale_lr=False)
    for got in (one, two):
        assert np.allclose(got[0], expected[0], atol=1e-9) and np.allclose(got[1], expected[1], atol=1e-9)


def test_no_row_is_left_out_of_unequal_shards(spark, samples):
    """With one batch per shard a step sees all rows: three shards of 46, 46 and 45 rows."""
    x, y, df = samples
    got = L.train_softmax_data_parallel(df, "features", "label", 3, 3, epochs=1, batch_size=64, scale_lr=False)
    expected = numpy_training(x, y, 137, 1, 0.1)
    assert np.allclose(got[0], expected[0], atol=1e-9)


def test_training_lowers_the_loss_and_checkpoints_reload(spark, samples):
    x, y, df = samples
    path, losses = L.new_checkpoint_dir(spark), []

    def after(epoch, w, b):
        L.save_epoch(path, epoch, L.SoftmaxModel(w, b))
        pred = df.withColumn("p", L.predict_proba("features", w, b))
        losses.append(L.eval_loss_accuracy(pred, "p", "label").first()["loss"])

    w, b = L.train_softmax_data_parallel(df, "features", "label", 3, 2, epochs=3, batch_size=16, after_epoch=after)
    assert losses[0] > losses[1] > losses[2]
    epoch, model = L.load_latest_epoch(spark, path)
    assert epoch == 3 and np.array_equal(w, model.weights) and np.array_equal(b, model.bias)


def test_shards_partition_the_rows(spark, samples):
    df = samples[2]
    parts = [sorted(r["vec_id"] for r in L.rank_shard(df, "vec_id", k, 3).collect()) for k in range(3)]
    assert parts == [list(range(k, 137, 3)) for k in range(3)]


def test_row_position_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7 + 3).alias("k"))
    pos = L.with_row_position(df, "k", "pos", partitions=5)
    rows = sorted((r.k, r.pos) for r in pos.collect())
    assert [p for _, p in rows] == list(range(1000))


def test_rank_shard_partitions_rows(spark):
    s = FX.samples_fx(spark, SF_SMALL)
    parts = [L.rank_shard(s, "vec_id", r, 3).select("vec_id") for r in range(3)]
    total = parts[0].union(parts[1]).union(parts[2])
    assert total.distinct().count() == s.count() == total.count()


def test_rint_half_even(spark):
    df = spark.createDataFrame([([0.5, 1.5, 2.5, 0.49],)], "a array<double>")
    assert df.select(L.rint_array("a").alias("r")).first().r == [0.0, 2.0, 2.0, 0.0]


def test_barrier_training_learns_and_is_deterministic(spark):
    train, test = LQ._train_test(spark, SF_SMALL)
    w1, b1 = L.train_softmax_data_parallel(train, "features", "label", 10, 2, epochs=3, learning_rate=0.5)
    w2, b2 = L.train_softmax_data_parallel(train, "features", "label", 10, 2, epochs=3, learning_rate=0.5)
    assert (w1 == w2).all() and (b1 == b2).all()
    seen = L.eval_loss_accuracy(train.withColumn("p", L.predict_proba("features", w1, b1)), "p", "label").first()
    assert seen.loss < 2.295         # the labels are drawn at random: only the training rows can be learnt (ln 10 = 2.303)


def full_batch(x, y, classes, epochs, lr):
    w, b = L.first_weights(x.shape[1], classes)
    for _ in range(epochs):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        w, b = w - lr * x.T @ p / len(y), b - lr * p.mean(axis=0)
    return w, b


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_gradient_sums_equal_numpy_at_any_number_of_partitions(spark, samples, parts):
    x, y, df = samples
    w, b = L.train_softmax(df.repartition(parts), "features", "label", 3, epochs=4, learning_rate=0.5)
    want = full_batch(x, y, 3, 4, 0.5)
    assert np.abs(w - want[0]).max() < 1e-9 and np.abs(b - want[1]).max() < 1e-9


def test_rows_that_cannot_train_are_left_out(spark):
    rows = [([1.0, 2.0], 0), ([0.5, -1.0], 1), (None, 1), ([3.0, 3.0], None), ([3.0, 3.0], 9), ([3.0, 3.0], -1)]
    df = spark.createDataFrame(rows, "features array<double>, label int")
    w, _ = L.train_softmax(df, "features", "label", 2, epochs=2)
    assert np.allclose(w, full_batch(np.array([[1.0, 2.0], [0.5, -1.0]]), np.array([0, 1]), 2, 2, 0.1)[0], atol=1e-12)
    w, b = L.train_softmax(df.limit(0), "features", "label", 2)
    assert w.shape == (0, 2) and b.shape == (2,)


def test_saved_model_predicts_the_same_in_a_new_session(spark, samples, tmp_path):
    x, y, df = samples
    model = L.SoftmaxModel(*full_batch(x, y, 3, 5, 0.5), probability="p", prediction="best")
    model.save(str(tmp_path / "m"))
    before = {r["vec_id"]: (r["p"], r["best"]) for r in model.transform(df).collect()}
    other = spark.newSession()
    loaded = L.SoftmaxModel.read().session(other).load(str(tmp_path / "m"))
    assert loaded.uid == model.uid and loaded.getOrDefault("probabilityCol") == "p"
    assert {r["vec_id"]: (r["p"], r["best"]) for r in loaded.transform(df).collect()} == before


def test_a_half_written_epoch_is_ignored(spark, tmp_path):
    path = str(tmp_path / "model")
    for epoch in (1, 2, 10):
        L.save_epoch(path, epoch, L.SoftmaxModel(np.full((2, 2), float(epoch)), np.zeros(2)))
    (tmp_path / "model" / "epoch=11" / "weights").mkdir(parents=True)       # stopped before its end
    (tmp_path / "model" / "epoch=10" / "metadata" / "_SUCCESS").unlink()
    epoch, model = L.load_latest_epoch(spark, path)
    assert epoch == 2 and model.weights[0, 0] == 2.0
