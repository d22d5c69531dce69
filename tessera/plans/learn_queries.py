"""Registered queries of the training notebook re-aimed at the embeddings table:
shards, reshaping, scaling, one-hot, fixed-prediction evaluation, training by
gradient sums, saved models and batch scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import learn as L
from tessera.plans import oracle_parts as O
from tessera.plans.registry import register
from tessera.sources import fixtures as FX

# ---- fixed values: training parameters of the reference --------------------------
EPOCHS = 2
LEARNING_RATE = 0.1
WORKERS = 2
SCALE_DIVISOR = 255.0
HEAD_ROWS = 9               # x_test[0:9]
SHARD_RANK, SHARD_SIZE = 1, 3
# the fixed "model" used to check evaluation: softmax of 10 x the first 10 features
FIXED_LOGIT_SCALE = 10.0
# ------------------------------------------------------------------------------------

NC = FX.NUM_CLASSES


def _fixed_proba():
    z = F.transform(F.slice("embedding", 1, NC), lambda x: x.cast("double") * F.lit(FIXED_LOGIT_SCALE))
    return L.softmax(z)


@register("scan_labelled_arrays", oracle="S")
def q_scan_labelled_arrays(spark, sf):
    s = FX.samples_fx(spark, sf)
    return s.select("vec_id", "label", "part", F.size("embedding").alias("dim"))


@register("rank_shard", oracle="S")
def q_rank_shard(spark, sf):
    s = FX.samples_fx(spark, sf)
    return L.rank_shard(s, "vec_id", SHARD_RANK, SHARD_SIZE).select("vec_id", "label")


@register("array_scale", oracle="S")
def q_array_scale(spark, sf):
    s = FX.samples_fx(spark, sf).withColumn("x", L.array_scale("embedding", SCALE_DIVISOR))
    return s.select("vec_id", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double")), 6)
                    .alias("sum_x"), F.round(F.col("x")[0].cast("double"), 9).alias("x0"))


@register("array_reshape", oracle="S")
def q_array_reshape(spark, sf):
    s = FX.samples_fx(spark, sf).withColumn("x", L.array_reshape("embedding", FX.SAMPLE_ROWS, FX.SAMPLE_COLS))
    return s.select("vec_id", F.size("x").alias("d0"), F.size(F.col("x")[0]).alias("d1"),
                    F.size(F.col("x")[0][0]).alias("d2"),
                    F.round(F.col("x")[3][5][0].cast("double"), 9).alias("x_3_5"))


@register("one_hot", oracle="S")
def q_one_hot(spark, sf):
    s = FX.samples_fx(spark, sf).withColumn("y", L.one_hot("label", NC))
    return s.select("vec_id", "label", L.argmax("y").alias("hot"),
                    F.aggregate("y", F.lit(0.0), lambda a, v: a + v.cast("double")).alias("total"))


@register("prepare_dataset", oracle="S")
def q_prepare_dataset(spark, sf):
    """get_dataset(num_classes, rank=0, size=2) on the training part."""
    s = FX.samples_fx(spark, sf).where(F.col("part") == "train")
    d = L.prepare_dataset(s, NC, rank=0, size=2, rows=FX.SAMPLE_ROWS, cols=FX.SAMPLE_COLS,
                          divisor=SCALE_DIVISOR)
    flat = F.flatten(F.flatten("x"))
    return d.select("vec_id", "label", F.size(flat).alias("n"),
                    F.round(F.aggregate(flat, F.lit(0.0), lambda a, v: a + v.cast("double")), 6).alias("sum_x"),
                    L.argmax("y").alias("hot"))


@register("rint_predictions", oracle="S")
def q_rint_predictions(spark, sf):
    s = FX.samples_fx(spark, sf).withColumn("p", L.rint_array(_fixed_proba()))
    return s.select("vec_id", F.aggregate("p", F.lit(0.0), lambda a, v: a + v).alias("ones"))


@register("eval_loss_accuracy", oracle="S")
def q_eval_loss_accuracy(spark, sf):
    s = FX.samples_fx(spark, sf).where(F.col("part") == "test").withColumn("p", _fixed_proba())
    r = L.eval_loss_accuracy(s, "p", "label")
    return r.select(F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@register("head_slice", oracle="S")
def q_head_slice(spark, sf):
    s = FX.samples_fx(spark, sf).where(F.col("part") == "test")
    return s.orderBy("vec_id").limit(HEAD_ROWS).select("vec_id", "label")


def _train_test(spark, sf):
    s = FX.samples_fx(spark, sf).withColumn("features", F.transform("embedding", lambda x: x.cast("double")))
    return s.where(F.col("part") == "train"), s.where(F.col("part") == "test")


def _evaluated(test, w, b):
    pred = test.withColumn("p", L.predict_proba("features", w, b))
    return L.eval_loss_accuracy(pred, "p", "label")


def _train(spark, sf, workers, after_epoch=None):
    """Gradient sums over all partitions; the learning rate grows with the stated workers."""
    train, _ = _train_test(spark, sf)
    return L.train_softmax(train, "features", "label", NC, epochs=EPOCHS, learning_rate=LEARNING_RATE * workers, after_epoch=after_epoch)


def _rounded(df, *more):
    return df.select(F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"), *more)


@register("train_classifier", oracle="S")
def q_train_classifier(spark, sf):
    """One worker's learning rate; loss and accuracy on the test part after every epoch."""
    _, test = _train_test(spark, sf)
    seen = []
    _train(spark, sf, 1, lambda epoch, w, b: seen.append(_evaluated(test, w, b).withColumn("epoch", F.lit(epoch))))
    out = seen[0]
    for df in seen[1:]:
        out = out.unionByName(df)
    return _rounded(out, "epoch")


@register("train_data_parallel", oracle="S")
def q_train_data_parallel(spark, sf):
    """Two workers' learning rate, evaluated on the test part."""
    _, test = _train_test(spark, sf)
    return _rounded(_evaluated(test, *_train(spark, sf, WORKERS)))


@register("checkpoint_latest", oracle="S")
def q_checkpoint_latest(spark, sf):
    """One saved model per epoch; the latest complete one is loaded and evaluated."""
    path = L.new_checkpoint_dir(spark)
    _train(spark, sf, WORKERS, lambda epoch, w, b: L.save_epoch(path, epoch, L.SoftmaxModel(w, b)))
    epoch, model = L.load_latest_epoch(spark, path)
    _, test = _train_test(spark, sf)
    return _rounded(L.eval_loss_accuracy(model.transform(test), "probability", "label").withColumn("epoch", F.lit(epoch)), "epoch")


def fixed_weights(dim: int = FX.SAMPLE_ROWS * FX.SAMPLE_COLS):
    """A fixed model whose predictions SQL can follow."""
    i, j = np.arange(dim)[:, None], np.arange(NC)[None, :]
    return ((i * 7 + j * 3) % 11 - 5) / 2.0, np.arange(NC) / 10.0


@register("batch_predict", oracle="S")
def q_batch_predict(spark, sf):
    """A saved model (fixed weights) loaded and applied to new rows, then rint of the probabilities."""
    _, test = _train_test(spark, sf)
    path = f"{L.new_checkpoint_dir(spark)}/fixed"
    L.SoftmaxModel(*fixed_weights(), probability="p", prediction="predicted").save(path)
    pred = L.SoftmaxModel.load(path).transform(test)
    return pred.select("vec_id", "predicted", F.round(F.array_max("p"), 6).alias("best"),
                       F.aggregate(L.rint_array("p"), F.lit(0.0), lambda a, v: a + v).alias("ones"))


# ---- oracle SQL ----------------------------------------------------------------------

def training_ctes(learning_rate: float) -> str:
    """The gradient steps in SQL: w0 ... w{EPOCHS}(i, j, v) and b0 ... (j, v), and the test part's
    probabilities t0 ... (vec_id, label, j, p) under them."""
    dim = FX.SAMPLE_ROWS * FX.SAMPLE_COLS
    w, b = L.first_weights(dim, NC)
    cells = ", ".join(f"({i + 1}, {j}, {O.d(float(w[i, j]))})" for i in range(dim) for j in range(NC))
    out = [f"xs AS MATERIALIZED (SELECT vec_id, part, label, i, CAST(embedding[i] AS DOUBLE) AS x FROM s, (SELECT unnest(range(1, {dim + 1})) AS i))",
           f"w0 AS MATERIALIZED (SELECT * FROM (VALUES {cells}) AS t(i, j, v))",
           "b0 AS MATERIALIZED (SELECT * FROM (VALUES " + ", ".join(f"({j}, {O.d(float(b[j]))})" for j in range(NC)) + ") AS t(j, v))"]
    for e in range(EPOCHS + 1):
        out.append(f"""z{e} AS (SELECT vec_id, part, label, w.j, sum(x * w.v) + any_value(b.v) AS z
  FROM xs JOIN w{e} w USING (i) JOIN b{e} b ON b.j = w.j GROUP BY vec_id, part, label, w.j),
e{e} AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z{e}),
p{e} AS MATERIALIZED (SELECT vec_id, part, label, j, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM e{e}),
t{e} AS (SELECT vec_id, label, j, p FROM p{e} WHERE part = 'test')""")
        if e < EPOCHS:
            out.append(f"""d{e} AS MATERIALIZED (SELECT vec_id, j, p - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS d FROM p{e} WHERE part = 'train'),
n{e} AS (SELECT CAST(count(DISTINCT vec_id) AS DOUBLE) AS n FROM d{e}),
w{e + 1} AS MATERIALIZED (SELECT w.i, w.j, w.v - {O.d(learning_rate)} * g.g / n.n AS v FROM w{e} w
  JOIN (SELECT i, j, sum(x * d) AS g FROM xs JOIN d{e} USING (vec_id) GROUP BY i, j) g ON g.i = w.i AND g.j = w.j CROSS JOIN n{e} n),
b{e + 1} AS MATERIALIZED (SELECT b.j, b.v - {O.d(learning_rate)} * g.g / n.n AS v FROM b{e} b
  JOIN (SELECT j, sum(d) AS g FROM d{e} GROUP BY j) g ON g.j = b.j CROSS JOIN n{e} n)""")
    return ",\n".join(out)


def _evaluated_sql(epoch: int, extra: str = "") -> str:
    return f"""SELECT round(avg(-ln(py)), 6) AS loss, round(avg(CASE WHEN top = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy{extra}
FROM (SELECT vec_id, label, max(p) FILTER (j = label) AS py, arg_max(j, p) AS top FROM t{epoch} GROUP BY vec_id, label) u"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    s = f"""s AS (
  SELECT vec_id, embedding, label, CASE WHEN vec_id % {FX.TEST_MODULUS} = 0 THEN 'test' ELSE 'train' END AS part
  FROM embeddings
)"""
    div = O.d(SCALE_DIVISOR)
    q["scan_labelled_arrays"] = f"WITH {s}\nSELECT vec_id, label, part, CAST(len(embedding) AS INTEGER) AS dim FROM s"
    q["rank_shard"] = f"""WITH {s},
p AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM s)
SELECT vec_id, label FROM p WHERE pos % {SHARD_SIZE} = {SHARD_RANK}"""
    scaled = f"list_transform(embedding, lambda x: CAST(CAST(x AS FLOAT) / {div} AS FLOAT))"
    q["array_scale"] = f"""WITH {s}
SELECT vec_id, round(list_sum(list_transform({scaled}, lambda v: CAST(v AS DOUBLE))), 6) AS sum_x,
       round(CAST({scaled}[1] AS DOUBLE), 9) AS x0 FROM s"""
    q["array_reshape"] = f"""WITH {s}
SELECT vec_id, {FX.SAMPLE_ROWS} AS d0, {FX.SAMPLE_COLS} AS d1, 1 AS d2,
       round(CAST(embedding[{3 * FX.SAMPLE_COLS + 5 + 1}] AS DOUBLE), 9) AS x_3_5 FROM s"""
    q["one_hot"] = f"WITH {s}\nSELECT vec_id, label, label AS hot, {O.d(1.0)} AS total FROM s"
    q["prepare_dataset"] = f"""WITH {s},
p AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM s WHERE part = 'train')
SELECT vec_id, label, 64 AS n,
       round(list_sum(list_transform({scaled}, lambda v: CAST(v AS DOUBLE))), 6) AS sum_x, label AS hot
FROM p WHERE pos % 2 = 0"""
    logits = (f"list_transform(list_slice(embedding, 1, {NC}), lambda x: CAST(x AS DOUBLE) * {O.d(FIXED_LOGIT_SCALE)})")
    proba = f"""pr AS (
  SELECT vec_id, label, part, list_transform(z, lambda v: exp(v - list_max(z))) AS e
  FROM (SELECT vec_id, label, part, {logits} AS z FROM s) t
),
pp AS (SELECT vec_id, label, part, list_transform(e, lambda v: v / list_sum(e)) AS p FROM pr)"""
    q["rint_predictions"] = f"""WITH {s},
{proba}
SELECT vec_id, CAST(list_sum(list_transform(p, lambda v: CASE WHEN v - floor(v) = 0.5 AND CAST(floor(v) AS BIGINT) % 2 = 0
                                                      THEN floor(v) ELSE round(v) END)) AS DOUBLE) AS ones
FROM pp"""
    q["eval_loss_accuracy"] = f"""WITH {s},
{proba}
SELECT round(avg(-ln(p[label + 1])), 6) AS loss,
       round(avg(CASE WHEN list_position(p, list_max(p)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM pp WHERE part = 'test'"""
    dim = FX.SAMPLE_ROWS * FX.SAMPLE_COLS
    q["batch_predict"] = f"""WITH {s},
z AS (SELECT vec_id, list_transform(range({NC}), lambda j: list_sum(list_transform(range({dim}),
        lambda i: CAST(embedding[i + 1] AS DOUBLE) * (CAST((i * 7 + j * 3) % 11 - 5 AS DOUBLE) / 2.0))) + CAST(j AS DOUBLE) / 10.0) AS z
      FROM s WHERE part = 'test'),
e AS (SELECT vec_id, list_transform(z, lambda v: exp(v - list_max(z))) AS e FROM z),
p AS (SELECT vec_id, list_transform(e, lambda v: v / list_sum(e)) AS p FROM e)
SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS predicted, round(list_max(p), 6) AS best,
       CAST(list_sum(list_transform(p, lambda v: CASE WHEN v > 0.5 THEN 1.0 ELSE 0.0 END)) AS DOUBLE) AS ones FROM p"""
    epochs = [_evaluated_sql(e, f", {e} AS epoch") for e in range(1, EPOCHS + 1)]
    q["train_classifier"] = f"WITH {s},\n{training_ctes(LEARNING_RATE)}\n" + "\nUNION ALL\n".join(epochs)
    several = f"WITH {s},\n{training_ctes(LEARNING_RATE * WORKERS)}\n"
    q["train_data_parallel"] = several + _evaluated_sql(EPOCHS)
    q["checkpoint_latest"] = several + epochs[-1]
    q["head_slice"] = f"WITH {s}\nSELECT vec_id, label FROM s WHERE part = 'test' ORDER BY vec_id LIMIT {HEAD_ROWS}"
    return q
