"""Feature preparation, sharding, training and scoring for labelled array data.

* array maths (scale, reshape, one-hot, rint) are higher-order column functions;
* ``with_row_position`` gives a global 0-based row number by an order column
  without a single-partition window: the range-partitioned, sorted rows are written
  once with their partition and index inside it; the counts of these files give the
  offset of each partition;
* ``train_softmax`` is data-parallel training by gradient sums: every partition adds up its
  rows, Spark adds the partitions, and the driver holds the weights only;
* ``train_epoch`` is minibatch training in barrier mode: one task per shard, rows
  streamed in batches, gradients summed with ``BarrierTaskContext.allGather`` every
  step, as many steps as the largest shard needs on every task;
* scoring applies the (small) weight matrix as literal columns, so prediction
  runs as JVM expressions on the executors; ``SoftmaxModel`` is the stage that is saved and loaded.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.sizing import materialise
from tessera.session import scratch_dir, ship_package


# ---- array columns -----------------------------------------------------------

def array_scale(a, divisor: float = 255.0) -> Column:
    """float32 cast then divide every element (``x.astype('float32'); x /= 255``)."""
    a = a if isinstance(a, Column) else F.col(a)
    return F.transform(a, lambda x: (x.cast("float") / F.lit(divisor)).cast("float"))


def array_reshape(a, rows: int, cols: int, channels: int = 1) -> Column:
    """Flat row-major array -> rows x cols x channels nested arrays."""
    a = a if isinstance(a, Column) else F.col(a)
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(cols - 1)),
        lambda j: F.slice(a, (i * cols + j) * channels + 1, channels)))


def one_hot(label, num_classes: int) -> Column:
    """``to_categorical(y, n)``: float array with 1.0 at the label."""
    y = label if isinstance(label, Column) else F.col(label)
    return F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                       lambda i: F.when(i == y, F.lit(1.0)).otherwise(F.lit(0.0)).cast("float"))


def rint_array(a) -> Column:
    """Round half to even per element (``np.rint``)."""
    a = a if isinstance(a, Column) else F.col(a)
    return F.transform(a, lambda x: F.rint(x))


def softmax(logits) -> Column:
    z = logits if isinstance(logits, Column) else F.col(logits)
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(a) -> Column:
    a = a if isinstance(a, Column) else F.col(a)
    return F.array_position(a, F.array_max(a)).cast("int") - 1


# ---- row positions and shards --------------------------------------------------

def with_row_position(df: DataFrame, order_col: str, out_col: str = "pos",
                      partitions: int | None = None) -> DataFrame:
    """0-based global position by ``order_col`` (unique), computed distributively.

    Range bounds are sampled anew in every run, so partitions and counts must come from
    one run: the partitioned rows are written with their partition and their index
    in it, counts are taken from those files, and the offsets (one row per
    partition) are joined back.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    placed = materialise(ranged, "positions", measure=False).df
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("__pid").count()
               .select("__pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")))
    return (placed.join(F.broadcast(offsets), "__pid")          # one row per partition
            .withColumn(out_col, F.col("__offset") + F.col("__local")).drop("__pid", "__local", "__offset"))


def rank_shard(df: DataFrame, order_col: str, rank: int, size: int) -> DataFrame:
    """``x[rank::size]``: every size-th row starting at ``rank`` in ``order_col`` order."""
    pos = with_row_position(df, order_col, "__pos")
    return pos.where(F.pmod(F.col("__pos"), F.lit(size)) == rank).drop("__pos")


def prepare_dataset(df: DataFrame, num_classes: int, rank: int = 0, size: int = 1,
                    rows: int = 8, cols: int = 8, divisor: float = 255.0,
                    order_col: str = "vec_id") -> DataFrame:
    """``get_dataset``: shard, reshape to rows x cols x 1, scale, one-hot."""
    shard = rank_shard(df, order_col, rank, size) if size > 1 else df
    return shard.select(order_col, "label",
                        array_reshape(array_scale("embedding", divisor), rows, cols).alias("x"),
                        one_hot("label", num_classes).alias("y"))


# ---- scoring -------------------------------------------------------------------

def logits_column(features, weights: np.ndarray, bias: np.ndarray) -> Column:
    """x @ W + b as an array column, W (d x k) and b (k) given as literals."""
    x = features if isinstance(features, Column) else F.col(features)
    d, k = weights.shape
    outs = []
    for j in range(k):
        wj = F.expr("array(" + ", ".join(f"{float(w)!r}D" for w in weights[:, j]) + ")")
        dot = F.aggregate(F.zip_with(x, wj, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        outs.append(dot + F.lit(float(bias[j])))
    return F.array(*outs)


def predict_proba(features, weights: np.ndarray, bias: np.ndarray) -> Column:
    return softmax(logits_column(features, weights, bias))


def eval_loss_accuracy(df: DataFrame, proba_col: str, label_col: str) -> DataFrame:
    """Mean categorical cross-entropy and accuracy (``model.evaluate``)."""
    p = F.col(proba_col)
    y = F.col(label_col)
    return df.agg(F.avg(-F.log(F.element_at(p, y + 1))).alias("loss"),
                  F.avg((argmax(p) == y).cast("double")).alias("accuracy"))


# ---- data-parallel training in barrier mode ------------------------------------------

@dataclass
class Shards:
    """Labelled rows with their rank and position, written once for all epochs."""

    rows: DataFrame                # x array<double>, y int, __pos long, __rank int
    workers: int
    dim: int
    largest: int                   # rows of the largest shard


def make_shards(df: DataFrame, features: str, label: str, workers: int, order_col: str) -> Shards:
    """``x[rank::workers]`` for every rank."""
    pos = with_row_position(df.select(F.col(order_col).alias("__key"), F.col(features).cast("array<double>").alias("x"),
                                      F.col(label).cast("int").alias("y")), "__key", "__pos").drop("__key")
    ranked = pos.withColumn("__rank", F.pmod(F.col("__pos"), F.lit(workers)).cast("int"))
    rows = materialise(ranged_by_rank(ranked, workers), "shards", measure=False).df
    total, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    return Shards(rows, workers, int(dim or 0), -(-int(total) // workers))


def ranged_by_rank(rows: DataFrame, workers: int) -> DataFrame:
    """Partition r holds exactly the rows of rank r, in order of position."""
    return rows.repartitionById(workers, F.col("__rank")).sortWithinPartitions("__pos")


def first_weights(dim: int, num_classes: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    return np.random.default_rng(seed).normal(0.0, 0.01, size=(dim, num_classes)), np.zeros(num_classes)


def softmax_gradient(w: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed gradients of the cross-entropy over the rows."""
    z = x @ w + b
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1.0
    return x.T @ p, p.sum(axis=0)


def _batches(frames, size: int, dim: int):
    """(x, y) of ``size`` rows each, re-cut from the frames of an iterator."""
    x, y = np.zeros((0, dim)), np.zeros(0, dtype=np.int64)
    for f in frames:
        if len(f):
            x = np.concatenate([x, np.stack(f["x"].to_numpy()).astype(np.float64)])
            y = np.concatenate([y, f["y"].to_numpy().astype(np.int64)])
        while len(x) >= size:
            yield x[:size], y[:size]
            x, y = x[size:], y[size:]
    if len(x):
        yield x, y


def train_epoch(shards: Shards, w: np.ndarray, b: np.ndarray, batch_size: int = 128,
                learning_rate: float = 0.1, scale_lr: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One pass over all rows by one barrier task per shard; returns the new weights.

    A step takes the next ``batch_size`` rows of every shard; the gradients are summed over
    the tasks, so the weights equal those of one process whose batches are the unions.  No
    row is left out: all tasks run the steps of the largest shard, and a task whose shard has
    ended sends zero gradients.  A task holds one batch at a time.  The learning rate
    grows with the number of workers, as in the reference (``scale_lr``).
    """
    steps = -(-shards.largest // batch_size)
    lr = learning_rate * shards.workers if scale_lr else learning_rate
    dim, classes = w.shape

    def train(frames):
        import pandas as pd
        from pyspark import BarrierTaskContext
        ctx = BarrierTaskContext.get()
        mine = _batches(frames, batch_size, dim)
        cur_w, cur_b = w.copy(), b.copy()
        for _ in range(steps):
            x, y = next(mine, (np.zeros((0, dim)), np.zeros(0, dtype=np.int64)))
            gw, gb = softmax_gradient(cur_w, cur_b, x, y) if len(y) else (np.zeros_like(cur_w), np.zeros_like(cur_b))
            sent = base64.b64encode(np.concatenate([gw.ravel(), gb, [float(len(y))]]).tobytes()).decode()
            total = sum(np.frombuffer(base64.b64decode(m), dtype=np.float64) for m in ctx.allGather(sent))
            if total[-1]:
                cur_w -= lr * total[:dim * classes].reshape(dim, classes) / total[-1]
                cur_b -= lr * total[dim * classes:-1] / total[-1]
        if ctx.partitionId() == 0:
            yield pd.DataFrame({"w": [cur_w.tobytes()], "b": [cur_b.tobytes()]})

    out = ranged_by_rank(shards.rows, shards.workers).mapInPandas(train, "w binary, b binary", barrier=True).collect()
    return (np.frombuffer(bytes(out[0]["w"]), dtype=np.float64).reshape(dim, classes).copy(),
            np.frombuffer(bytes(out[0]["b"]), dtype=np.float64).copy())


def train_softmax_data_parallel(df: DataFrame, features: str, label: str, num_classes: int,
                                workers: int, epochs: int = 2, batch_size: int = 128,
                                learning_rate: float = 0.1, seed: int = 0,
                                order_col: str = "vec_id", scale_lr: bool = True,
                                after_epoch=None) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression trained on ``x[rank::workers]``; ``after_epoch(epoch, w, b)`` is called
    after every epoch (checkpoints, validation)."""
    shards = make_shards(df, features, label, workers, order_col)
    w, b = first_weights(shards.dim, num_classes, seed)
    for epoch in range(1, epochs + 1):
        w, b = train_epoch(shards, w, b, batch_size, learning_rate, scale_lr)
        if after_epoch:
            after_epoch(epoch, w, b)
    return w, b


# ---- data-parallel training by gradient sums ---------------------------------------

def gradient_sums(rows: DataFrame, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Summed gradients of all rows (x array<double>, y int) and their number.

    Every task adds up its partition batch by batch and returns one row; Spark adds those
    entry by entry, so only one number for each weight comes to the driver, whatever the input."""
    dim, classes = w.shape
    ship_package(rows.sparkSession)

    def run(batches):
        gw, gb, n = np.zeros_like(w), np.zeros_like(b), 0
        for t in batches:
            if t.num_rows:
                x = t.column("x").flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)
                more = softmax_gradient(w, b, x, t.column("y").to_numpy())
                gw, gb, n = gw + more[0], gb + more[1], n + t.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([gw.ravel(), gb, [float(n)]])], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("x", "y").mapInArrow(run, "sums array<double>")
    total = np.zeros(dim * classes + classes + 1)
    for r in parts.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
        total[r["at"]] = r["v"]
    return total[:dim * classes].reshape(dim, classes), total[dim * classes:-1], int(total[-1])


def train_softmax(df: DataFrame, features: str, label: str, num_classes: int, epochs: int = 2, learning_rate: float = 0.1,
                  seed: int = 0, after_epoch=None) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by full-batch gradient steps, one for each epoch, over any number of
    partitions: the weights do not depend on how the rows are spread, but for rounding.  Rows without
    features or with a label outside 0 ... num_classes - 1 are left out; without rows the first weights stay."""
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y")) \
        .where(F.col("x").isNotNull() & F.col("y").between(0, num_classes - 1))
    rows = materialise(rows, "training-rows", measure=False).df          # read once for each epoch
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    w, b = first_weights(dim, num_classes, seed)
    for epoch in range(1, epochs + 1):
        gw, gb, n = gradient_sums(rows, w, b)
        if n:
            w, b = w - learning_rate * gw / n, b - learning_rate * gb / n
        if after_epoch:
            after_epoch(epoch, w, b)
    return w, b


# ---- model artefact ---------------------------------------------------------------

class SoftmaxModel(Model, MLWritable, MLReadable):
    """Scores rows with fixed weights; saved and loaded as a ``pyspark.ml`` stage."""

    featuresCol = Param(Params._dummy(), "featuresCol", "array<double> column that is scored", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "array<double> of class probabilities", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "most likely class", TypeConverters.toString)

    def __init__(self, weights: np.ndarray | None = None, bias: np.ndarray | None = None, features: str = "features",
                 probability: str = "probability", prediction: str = "prediction"):
        super().__init__()
        self.weights, self.bias = weights, bias
        self._set(featuresCol=features, probabilityCol=probability, predictionCol=prediction)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = predict_proba(self.getOrDefault("featuresCol"), self.weights, self.bias)
        name = self.getOrDefault("probabilityCol")
        return dataset.withColumn(name, p).withColumn(self.getOrDefault("predictionCol"), argmax(name))

    def write(self) -> MLWriter:
        return _SoftmaxWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SoftmaxReader()


class _SoftmaxWriter(MLWriter):
    """Weights as a Parquet table (a row for each class), the metadata after them: a model whose
    metadata is complete is complete."""

    def __init__(self, model: SoftmaxModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, m = self.sparkSession, self.model
        rows = [(j, [float(v) for v in m.weights[:, j]], float(m.bias[j])) for j in range(m.weights.shape[1])]
        spark.createDataFrame(rows, "class int, weights array<double>, bias double").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
        DefaultParamsWriter.saveMetadata(m, path, spark)


class _SoftmaxReader(MLReader):
    def load(self, path: str) -> SoftmaxModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/weights").orderBy("class").collect()
        model = SoftmaxModel(np.array([r["weights"] for r in rows]).T, np.array([r["bias"] for r in rows]))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def save_epoch(path: str, epoch: int, model: SoftmaxModel) -> None:
    model.write().overwrite().save(f"{path}/epoch={epoch}")


def load_latest_epoch(spark, path: str) -> tuple[int, SoftmaxModel]:
    """Epoch and model of the highest epoch under ``path`` that was written to its end."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = []
    for entry in fs.listStatus(where):
        name = entry.getPath().getName()
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "metadata/_SUCCESS")
        if name.startswith("epoch=") and name[6:].isdigit() and fs.exists(marker):
            done.append(int(name[6:]))
    if not done:
        raise FileNotFoundError(f"no complete epoch under {path}")
    return max(done), SoftmaxModel.load(f"{path}/epoch={max(done)}")


def new_checkpoint_dir(spark) -> str:
    return scratch_dir(spark, "model")
