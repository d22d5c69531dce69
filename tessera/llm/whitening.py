"""Embedding whitening from bit-sliced scatter matrices.

Entries are integers, x = floor(64 c) + 1,000,000.  The scatter matrix is counted, not multiplied:

1. one aggregation takes the smallest and largest entry of each dimension; entries are shifted to
   y = x - smallest, so that a dimension needs as many bit planes as its spread has bits;
2. every task packs plane p of dimension j over its rows into 64-bit words.  Then
   sum y_j y_k = sum over p, q of 2**(p + q) * popcount(plane_jp AND plane_kq), and
   sum y_j = sum over p of 2**p * popcount(plane_jp), both exact.  A task returns one row for each
   dimension, whatever it has read, and Spark adds them;
3. n * sum y_j y_k - sum y_j * sum y_k is the centred scatter times n, still in integers (the
   shift cancels); one division gives the covariance, ``eigh`` its components;
4. rows are projected: (n x - S) is formed in integers, then divided and projected in double
   precision.  The covariance of what was written is summed in a second pass and its largest
   difference from the identity reported with every row.

Tasks hold one block of rows and one matrix of the number of dimensions squared; the driver gets
one row for each dimension and, for the check, one small matrix of each task's sums, added by Spark.

Defined results: vectors that are null or hold null or non-finite entries are left out; so are
entries beyond 2**40 (their squares would leave the exact range) and, since one fit needs one
length, vectors of another length than the most frequent one (the longer of equally frequent
ones).  Components whose variance is not above rounding (1e-12 of the trace) cannot be scaled to 1 and have
no rows, so constant or too few vectors give fewer components or none.  Repeated rows count and are
returned as often as they occur, null vec_ids too; tables without rows give an empty result; other
columns are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.operators.sizing import materialise
from tessera.session import ship_package

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Rows whose bit planes a task holds (a multiple of 64).
BLOCK = 1 << 16
LARGEST = float(1 << 40)
#: Share of the trace from which a variance counts.
ROUNDING = 1e-12


def whole_numbers(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """vec_id, x (array of long) of the vectors that can be used."""
    v = F.col(vec).cast("array<double>")
    scaled = F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))))
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LARGEST))
    return (vectors.where(F.coalesce(v.isNotNull() & fits, F.lit(False)))
            .select(F.col(key).cast("long").alias("vec_id"), F.transform(scaled, lambda q: q.cast("long") + OFFSET).alias("x")))


# ---------------------------------------------------------------- bit planes

def planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(planes, words): plane p of dimension j over all rows, dimension by dimension.  Rows that fill
    the last word are zero."""
    n = -(-len(y) // 64) * 64
    out = np.empty((int(bits.sum()), n // 64), np.uint64)
    row = np.zeros(n, np.uint8)
    at = 0
    for j, b in enumerate(bits):
        col = np.ascontiguousarray(y[:, j])
        for p in range(b):
            row[:len(col)] = (col >> p) & 1
            out[at] = np.packbits(row).view(np.uint64)
            at += 1
    return out


def weighted_counts(plane: np.ndarray, bits: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums of every dimension and of all products of two, from popcounts."""
    first = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(bits)), bits)
    weight = np.concatenate([np.arange(b) for b in bits]) if len(owner) else np.empty(0, np.int64)
    ones = np.bitwise_count(plane).sum(axis=1, dtype=np.int64)
    sums = [0] * len(bits)
    for o, w, c in zip(owner.tolist(), weight.tolist(), ones.tolist(), strict=True):
        sums[o] += c << w
    # products of a word of counts stay in long if 2**(p + q) times the rows does
    short = 2 * int(bits.max(initial=0)) + (plane.shape[1] * 64).bit_length() + 2 < 63
    products = [[0] * len(bits) for _ in bits]
    for j in range(len(bits)):
        total = np.zeros(len(owner), np.int64 if short else object)
        for p in range(bits[j]):
            k = first[j]        # only dimensions from j on; the matrix is symmetric
            both = np.bitwise_count(plane[k:] & plane[first[j] + p]).sum(axis=1, dtype=np.int64)
            total[k:] += (both if short else both.astype(object)) << p
        for k in range(j, len(bits)):
            products[j][k] = sum(int(c) << q for q, c in enumerate(total[first[k]:first[k + 1]]))
    return sums, products


def matrix(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def scatter(rows: DataFrame, low: list[int], bits: list[int]) -> DataFrame:
    """dim, total, products: exact sums of y and of y_dim * y_k (decimals) over all rows."""
    d, low, bits = len(low), np.array(low, np.int64), np.array(bits, np.int64)

    def run(batches):
        total, products, held, n = [0] * d, [[0] * d for _ in range(d)], [], 0

        def add(blocks):
            s, c = weighted_counts(planes(np.concatenate(blocks) - low, bits), bits)
            for j in range(d):
                total[j] += s[j]
                products[j] = [a + b for a, b in zip(products[j], c[j], strict=True)]

        for b in batches:
            held.append(matrix(b.column("x"), d))
            n += len(held[-1])
            if n >= BLOCK:
                add(held)
                held, n = [], 0
        if n:
            add(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array([str(t) for t in total]), pa.array([[str(c) for c in p] for p in products], pa.list_(pa.string()))],
            names=["dim", "total", "products"])

    found = rows.select("x").mapInArrow(run, "dim int, total string, products array<string>")
    exact = found.select("dim", F.col("total").cast("decimal(38,0)").alias("total"), F.posexplode("products").alias("other", "product"))
    return (exact.groupBy("dim", "other").agg(F.sum("total").alias("total"), F.sum(F.col("product").cast("decimal(38,0)")).alias("product"))
            .where(F.col("other") >= F.col("dim")))


# ---------------------------------------------------------------- fit and projection

class Fit:
    """Components of the covariance of the fit list."""

    def __init__(self, n: int, low: list[int], sums: list[int], products: dict[tuple[int, int], int], components: int):
        d = len(low)
        self.n, self.low = n, low
        self.sums = [s + n * a for s, a in zip(sums, low, strict=True)]     # of x
        self.covariance = np.empty((d, d))
        for (j, k), p in products.items():
            # the shift cancels, so y serves for x; one rounding to double
            self.covariance[j, k] = self.covariance[k, j] = float(Fraction(n * p - sums[j] * sums[k], n * n))
        e, v = np.linalg.eigh(self.covariance)
        order = np.argsort(-e, kind="stable")[:components]
        self.trace = float(np.trace(self.covariance))
        order = [o for o in order if self.trace > 0 and e[o] > ROUNDING * self.trace]
        self.eigenvalues, self.components = e[order], v[:, order]
        # of the two signs the one whose largest entry is positive
        if len(order):
            lead = np.abs(self.components).argmax(axis=0)
            self.components = self.components * np.sign(self.components[lead, np.arange(len(order))])

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(whitened, deviation) of rows of x."""
        sums = np.array(self.sums, dtype=object)
        reach = max((abs(self.n * int(v) - s) for v_s in (x.min(axis=0), x.max(axis=0)) for v, s in zip(v_s.tolist(), self.sums, strict=True)),
                    default=0)
        centred = x * self.n - sums.astype(np.int64) if self._short(x) else x.astype(object) * self.n - sums
        if reach and 2 * reach.bit_length() + len(self.sums).bit_length() < 63:
            deviation = np.einsum("ij,ij->i", centred, centred).tolist()
        else:
            deviation = (centred.astype(object) ** 2).sum(axis=1).tolist()
        return (centred.astype(np.float64) / self.n) @ (self.components / np.sqrt(self.eigenvalues)), deviation

    def _short(self, x: np.ndarray) -> bool:
        return self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) < 1 << 62


def fit(rows: DataFrame, components: int) -> Fit | None:
    """The fit over (vec_id, x) rows of one length; None without rows."""
    ends = (rows.select(F.posexplode("x").alias("dim", "x")).groupBy("dim")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("dim").collect())
    if not ends:
        return None
    low, bits = [r["low"] for r in ends], [(r["high"] - r["low"]).bit_length() for r in ends]
    sums, products = [0] * len(low), {}
    for r in scatter(rows, low, bits).collect():        # dimensions squared / 2 rows
        sums[r["dim"]] = int(r["total"])
        products[r["dim"], r["other"]] = int(r["product"])
    return Fit(ends[0]["n"], low, sums, products, components)


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest difference of the covariance of ``white`` (arrays of k doubles) from the identity."""

    def run_sums(batches):
        total = np.zeros(k)
        for b in batches:
            total += matrix(b.column("white"), k).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], names=["i", "s"])

    mean = np.zeros(k)
    for r in white.select("white").mapInArrow(run_sums, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        mean[r["i"]] = r["s"] / n

    def run_products(batches):
        total = np.zeros((k, k))
        for b in batches:
            w = matrix(b.column("white"), k) - mean
            total += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = white.select("white").mapInArrow(run_products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    far = F.abs(F.col("s") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return float(sums.agg(F.max(far)).first()[0])


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialise(whole_numbers(vectors, key, vec), "whole-vectors", measure=False).df
    length = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).where(F.col("d") > 0)
              .orderBy(F.desc("n"), F.desc("d")).first())
    if length is None:
        return spark.createDataFrame([], SCHEMA)
    rows = rows.where(F.size("x") == length["d"])
    model = fit(rows, components)
    k, d = len(model.eigenvalues), length["d"]
    if not k:
        return spark.createDataFrame([], SCHEMA)

    def project(batches):
        for b in batches:
            if b.num_rows:
                w, deviation = model.project(matrix(b.column("x"), d))
                # a deviation beyond a long is null
                deviation = [v if v < 1 << 63 else None for v in deviation]
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), pa.array(deviation, pa.int64()),
                     pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "white"])

    white = materialise(rows.mapInArrow(project, "vec_id long, deviation long, white array<double>"), "whitened", measure=False).df
    error = identity_error(white, model.n, k)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    return (white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
