"""Hard-negative mining by Kronecker-packed integer products.

Components are integers, floor(scale * x).  Scores are inner products of an anchor with every
row, computed exactly and several candidates at a time (``packed_products``): the components of
``k`` candidates are biased to be non-negative and put into separate fields of one 64-bit
integer, each anchor component is multiplied once with that integer, and the sums hold one
score a field.  The width of a field follows from the lengths of the vectors of the block
(|score| <= |anchor| |row|), so vectors of length 1 at scale 256 are multiplied three at a time.

1. Anchors are cut into blocks of about ``ANCHORS``, all rows into blocks of about ``ROWS``; a
   task holds one block of anchors and streams one block of rows past it, keeping the best of
   every anchor.  First the best rows of the anchor's label: its positives.
2. With the scores of the positives known, the blocks meet again: for each positive the best
   rows of other labels whose score lies in its window.

The lists of the tasks are merged by rank.  What a task holds is bounded by the block sizes,
no key gathers a label, and no pair of rows is written but the best of a task.

Defined results: rows without vec_id or label, without vector or with a null or non-finite
component take no part, nor do rows whose squared length reaches 2**61 (their scores would
not fit a long).  Vectors of different lengths are not compared; an empty vector scores 0 with
the other empty ones.  A repeated row is a row of its own: it is another row to its copy, and as an
anchor it has its own lines.  Equal scores are ordered by vec_id.  Very long vectors are
multiplied in slices of rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.operators.sizing import materialise
from tessera.session import ship_package

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative scores between so many hundredths of the positive's score and the score itself.
LOW_PERCENT = 80
#: Anchors and rows of a block; anchors and rows multiplied at once.
ANCHORS, ROWS = 8192, 1 << 16
ANCHOR_STEP, ROW_STEP = 128, 3072
#: Squared lengths from here on leave the range of long scores.
TOO_LONG = float(1 << 61)
NONE = np.iinfo(np.int64).min + 1


# ---------------------------------------------------------------- integer products

def field_width(anchor_norms: np.ndarray, row_norms: np.ndarray) -> int:
    """Bits of a field that holds any score of these squared lengths, and its sign."""
    bound = math.isqrt(int(anchor_norms.max()) * int(row_norms.max())) + 1
    return bound.bit_length() + 1


def pack(rows: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """(components x words, bias): 64 // width rows in the fields of each word."""
    fields = 64 // width
    bias = max(0, -int(rows.min(initial=0)))
    x = (rows + bias).astype(np.uint64)
    short = -len(x) % fields
    if short:
        x = np.concatenate([x, np.zeros((short, x.shape[1]), np.uint64)])
    words = np.zeros((len(x) // fields, x.shape[1]), np.uint64)
    for f in range(fields):
        words += x[f::fields] << np.uint64(f * width)
    return np.ascontiguousarray(words.T), bias


def unpack(words: np.ndarray, width: int, n: int) -> np.ndarray:
    """(anchors, n) signed scores of fields that hold score + 2**(width - 1)."""
    fields = 64 // width
    half = 1 << (width - 1)
    mask = np.uint64((1 << width) - 1)
    out = np.empty((len(words), words.shape[1] * fields), np.int64)
    for f in range(fields):
        out[:, f::fields] = ((words >> np.uint64(f * width)) & mask).astype(np.int64)
    return out[:, :n] - half


def packed_products(anchors: np.ndarray, rows: np.ndarray, anchor_norms: np.ndarray, row_norms: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors with all rows.  Sums are taken modulo 2**64; the
    bias and half a field are settled per anchor, so that every field ends within its bits."""
    width = field_width(anchor_norms, row_norms)
    words, bias = pack(rows, width)
    ones = np.uint64(sum(1 << (f * width) for f in range(64 // width)))
    a = anchors.astype(np.uint64)
    settle = np.uint64(1 << (width - 1)) - a.sum(axis=1, dtype=np.uint64) * np.uint64(bias)
    sums = np.einsum("ad,dw->aw", a, words) if a.shape[1] else np.zeros((len(a), words.shape[1]), np.uint64)
    return unpack(sums + (settle * ones)[:, None], width, len(rows))


# ---------------------------------------------------------------- best lists of a task

class Best:
    """The k best (score, id) of each of n lists, by falling score, then rising id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), NONE)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer to ``lists`` the columns of ``scores`` (overwritten), whose ids rise from left to
        right; NONE is no offer."""
        k = self.score.shape[1]
        live = np.arange(len(lists))
        new_s, new_i = np.full((len(lists), k), NONE), np.full((len(lists), k), np.iinfo(np.int64).max)
        for step in range(min(k, scores.shape[1])):
            at = (scores if len(live) == len(scores) else scores[live]).argmax(axis=1)   # the first of equal ones
            s, i = scores[live, at], ids[at]
            last_s, last_i = self.score[lists[live], -1], self.id[lists[live], -1]
            on = (s > last_s) | ((s == last_s) & (s > NONE) & (i < last_i))
            live, at = live[on], at[on]
            if not len(live):
                break
            new_s[live, step], new_i[live, step] = s[on], i[on]
            scores[live, at] = NONE
        some = np.flatnonzero(new_s[:, 0] > NONE)
        if len(some):
            s = np.concatenate([self.score[lists[some]], new_s[some]], axis=1)
            i = np.concatenate([self.id[lists[some]], new_i[some]], axis=1)
            order = np.lexsort((i, -s), axis=1)[:, :k]
            self.score[lists[some]] = np.take_along_axis(s, order, axis=1)
            self.id[lists[some]] = np.take_along_axis(i, order, axis=1)


def integers(vecs: list[bytes], dim: int) -> np.ndarray:
    """Vectors held as integers of 2, 4 or 8 bytes -> (n, dim) long."""
    out = np.empty((len(vecs), dim), np.int64)
    width = np.fromiter(map(len, vecs), np.int64, len(vecs)) // max(dim, 1)
    for w in (2, 4, 8):
        at = np.flatnonzero(width == w)
        if len(at) and dim:
            out[at] = np.frombuffer(b"".join(vecs[i] for i in at), f"<i{w}").reshape(len(at), dim)
    return out


class Meeting:
    """One block of anchors and the rows that stream past it."""

    def __init__(self, t: pa.Table, dim: int, k: int, windows: bool):
        self.row = t.column("row").to_numpy()
        self.label = t.column("label").to_numpy()
        self.norm = t.column("norm").to_numpy()
        self.x = integers(t.column("vec").to_pylist(), dim)
        if windows:     # scores of the positives; a missing one opens no window
            w = t.column("goal").to_pylist()
            self.slots = max(map(len, w), default=0)
            self.goal = np.full((len(w), self.slots), NONE)
            for r, g in enumerate(w):
                self.goal[r, :len(g)] = g
        else:
            self.slots, self.goal = 1, None
        self.best = Best(len(self.row) * self.slots, k)

    def pass_rows(self, t: pa.Table, dim: int, low_percent: int) -> None:
        t = t.take(pa.array(np.argsort(t.column("vec_id").to_numpy(), kind="stable")))
        ids, label, norm = (t.column(c).to_numpy() for c in ("vec_id", "label", "norm"))
        x = integers(t.column("vec").to_pylist(), dim)
        if self.goal is None:
            for one in np.intersect1d(label, self.label):
                self._same_label(np.flatnonzero(self.label == one), np.flatnonzero(label == one), ids, norm, x)
            return
        for a in range(0, len(self.row), ANCHOR_STEP):
            on = np.arange(a, min(a + ANCHOR_STEP, len(self.row)))
            score = packed_products(self.x[on], x, self.norm[on], norm)
            score[self.label[on][:, None] == label[None, :]] = NONE
            for slot in range(self.slots):
                top = self.goal[on, slot]
                low = top - (top // 100) * (100 - low_percent) - ((top % 100) * (100 - low_percent)) // 100
                inside = (score <= top[:, None]) & (score >= np.where(top > NONE, low, 1)[:, None])
                lists = np.flatnonzero(inside.any(axis=1))
                if len(lists):
                    self.best.offer(on[lists] * self.slots + slot, np.where(inside[lists], score[lists], NONE), ids)

    def _same_label(self, anchors, rows, ids, norm, x) -> None:
        for a in range(0, len(anchors), ANCHOR_STEP):
            on = anchors[a:a + ANCHOR_STEP]
            self.best.offer(on, packed_products(self.x[on], x[rows], self.norm[on], norm[rows]), ids[rows])

    def result(self) -> pa.RecordBatch:
        n, k = np.nonzero(self.best.score > NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.row[n // max(self.slots, 1)]), pa.array((n % max(self.slots, 1)).astype(np.int32)),
             pa.array(self.best.score[n, k]), pa.array(self.best.id[n, k])], names=["row", "slot", "score", "id"])


def meet(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, row_blocks: int, k: int, low_percent: int | None) -> DataFrame:
    """(row, slot, score, id): the k best of every list in each pair of blocks.  ``anchors`` may
    carry ``goal``, the scores that open a window each."""
    goal = F.col("goal") if low_percent is not None else F.lit(None).cast("array<long>")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    cols = ["row", "vec_id", "label", "norm", "vec"]
    asked = anchors.select("dim", block(anchor_blocks).alias("i"), every(row_blocks).alias("j"), F.lit(0).alias("held"), *cols, goal.alias("goal"))
    held = rows.select("dim", every(anchor_blocks).alias("i"), block(row_blocks).alias("j"), F.lit(1).alias("held"), *cols,
                       F.lit(None).cast("array<long>").alias("goal"))
    keys = ["dim", "i", "j"]
    tasks = asked.unionByName(held).repartition(anchor_blocks * row_blocks, *keys).sortWithinPartitions(*keys, "held")

    def run(batches):
        at, meeting, waiting = None, None, []
        for b in batches:
            t = pa.Table.from_batches([b])
            key = np.stack([t.column(c).to_numpy() for c in [*keys, "held"]], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), t.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                *group, is_row = key[s].tolist()
                if group != at:             # the anchors of a group come first
                    if meeting is not None:
                        yield meeting.result()
                    at, meeting, waiting = group, None, []
                if not is_row:
                    waiting.append(t.slice(s, e - s))
                    continue
                if waiting:
                    meeting, waiting = Meeting(pa.concat_tables(waiting), group[0], k, low_percent is not None), []
                if meeting is not None:
                    for r in range(s, e, ROW_STEP):
                        meeting.pass_rows(t.slice(r, min(ROW_STEP, e - r)), group[0], low_percent)
        if meeting is not None:
            yield meeting.result()

    return tasks.mapInArrow(run, "row long, slot int, score long, id long")


# ---------------------------------------------------------------- the operator

def quantised(vectors: DataFrame, anchor: Column, key: str, vec: str, label: str, scale: int) -> DataFrame:
    """row, vec_id, label, is_anchor, dim, norm, vec (bytes) of the rows that take part."""
    v = F.col(vec).cast("array<double>")
    ok = F.col(key).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    length = F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x)
    rows = (vectors.where(F.coalesce(ok, F.lit(False)))
            .select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                    F.coalesce(anchor, F.lit(False)).alias("is_anchor"), scaled.alias("v"), length.alias("len"))
            .where(F.col("len") < TOO_LONG))

    def run(batches):
        for b in batches:
            vec, norm, dims = [], [], []
            for one in b.column("v"):
                q = one.values.to_numpy(zero_copy_only=False).astype(np.int64)
                w = np.abs(q).max(initial=0)
                vec.append(q.astype("<i2" if w < 1 << 15 else "<i4" if w < 1 << 31 else "<i8").tobytes())
                norm.append(int(q @ q))
                dims.append(len(q))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("is_anchor"), pa.array(dims, pa.int32()), pa.array(norm, pa.int64()),
                 pa.array(vec, pa.binary())], names=["vec_id", "label", "is_anchor", "dim", "norm", "vec"])

    return (rows.mapInArrow(run, "vec_id long, label long, is_anchor boolean, dim int, norm long, vec binary")
            .select(F.monotonically_increasing_id().alias("row"), "*"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each list of all tasks, with their rank."""
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, scale: int = SCALE, key: str = "vec_id", vec: str = "embedding",
                   label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that
    ``anchor`` selects."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialise(quantised(vectors, anchor, key, vec, label, scale), "packed-vectors", measure=False).df
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    anchor_blocks = max(1, -(-asked // ANCHORS))
    spread = min(2 * spark.sparkContext.defaultParallelism, -(-n // 1024))      # small tables use all tasks too
    row_blocks = max(1, -(-n // ROWS), spread)
    anchors = rows.where("is_anchor")

    # one more than asked for, as the anchor itself may be among its best
    best = ranked(meet(anchors, rows, anchor_blocks, row_blocks, positives + 1, None), positives + 1)
    best = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("id"), F.col("score").alias("score")))).alias("best"))
    own = lambda x: (x["id"] == F.col("vec_id")) & (x["score"] == F.col("norm"))
    me = F.coalesce(F.get(F.filter("best", own), F.lit(0))["rank"], F.lit(positives + 1))
    chosen = (anchors.join(best, "row")
              .withColumn("best", F.slice(F.filter("best", lambda x: x["rank"] != me), 1, positives)).where(F.size("best") > 0))
    chosen = materialise(chosen.withColumn("goal", F.transform("best", lambda x: x["score"])), "positives", measure=False).df

    found = ranked(meet(chosen, rows, anchor_blocks, row_blocks, negatives, low_percent), negatives)
    pairs = chosen.select("row", F.col("vec_id").alias("anchor_id"), F.posexplode("best").alias("slot", "p"))
    return (pairs.join(found, ["row", "slot"])
            .select("anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                    F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")))


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 100th vector against all; the labels of every 7th moved on by one."""
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # the columns read, under names of their own
    own = vectors.select(F.col("vec_id"), F.col("embedding"), moved.alias("label"))
    return hard_negatives(own, F.col("vec_id") % 100 == 0)
