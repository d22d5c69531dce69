import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>"


def integers(rows):
    return [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows]


def covariance(xs):
    """Exact products of centred integers, one rounding at the end."""
    n, d = len(xs), len(xs[0])
    s = [sum(x[j] for x in xs) for j in range(d)]
    c = [[n * x[j] - s[j] for j in range(d)] for x in xs]
    v = np.array([[float(Fraction(sum(r[j] * r[k] for r in c), n ** 3)) for k in range(d)] for j in range(d)])
    return v, c, [sum(a * a for a in r) for r in c]


def check(rows, used, df, components=32):
    xs = integers(used)
    v, centred, deviation = covariance([x for _, x in xs])
    deviation = [a if a < 1 << 63 else None for a in deviation]     # beyond a long
    n, e = len(xs), np.sort(np.linalg.eigvalsh(v))[::-1]
    k = min(components, int((e > W.ROUNDING * e.sum()).sum()))
    seen, rows_of = Counter(), []
    for r in W.whitened(df, components).collect():
        name = (r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"] or 0)
        seen[name, r["component"]] += 1         # repeated rows stay apart
        rows_of.append((name, seen[name, r["component"]], r["component"], r))
    got = [r[-1] for r in sorted(rows_of, key=lambda r: r[:3])]
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    order = sorted(range(n), key=lambda r: (xs[r][0] is not None, xs[r][0] or 0, deviation[r] or 0))
    white = np.array([r["whitened"] for r in got]).reshape(n, k)
    assert [r["vec_id"] for r in got[::k]] == [xs[o][0] for o in order]
    assert [r["deviation"] for r in got[::k]] == [deviation[o] for o in order]
    assert [r["component"] for r in got[:k]] == list(range(1, k + 1))
    assert np.allclose([r["explained"] for r in got[:k]], e[:k] / e.sum(), rtol=1e-9)
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9 and max(r["identity_error"] for r in got) < 1e-9
    # the projections: distances in the whole space of the components are those of the inverse covariance
    c = np.array([centred[o] for o in order], dtype=float) / n
    vals, vecs = np.linalg.eigh(v)
    keep = np.argsort(-vals)[:k]
    for a in range(k):
        u = vecs[:, keep[a]]
        if min([abs(vals[keep[a]] - vals[b]) for b in range(len(vals)) if b != keep[a]], default=1) > 1e-6 * vals.max():
            want = c @ u / math.sqrt(vals[keep[a]])
            assert min(np.abs(want - white[:, a]).max(), np.abs(want + white[:, a]).max()) < 1e-6


@pytest.mark.parametrize("dims,n,scale", [(5, 40, 1.0), (40, 300, 0.3), (3, 130, 5000.0), (1, 9, 1.0), (4, 64, 1e7)])
def test_equals_exact_sums(spark, dims, n, scale):
    rng = np.random.default_rng(dims)
    basis = rng.normal(size=(dims, dims)) * (1 + np.arange(dims))
    rows = [(i, [float(c) for c in rng.normal(size=dims) @ basis * scale]) for i in range(n)]
    check(rows, rows, spark.createDataFrame(rows, SCHEMA).repartition(4))


def test_blocks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 64)
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(500)]
    check(rows, rows, spark.createDataFrame(rows, SCHEMA).coalesce(1), components=3)


def test_popcounts_equal_products():
    rng = np.random.default_rng(3)
    y = rng.integers(0, [1, 2, 200, 1 << 41, 7], (1000, 5))
    bits = np.array([int(c).bit_length() for c in y.max(axis=0)])
    sums, products = W.weighted_counts(W.planes(y, bits), bits)
    z = y.astype(object)
    assert sums == z.sum(axis=0).tolist()
    assert all(products[j][k] == (z[:, j] * z[:, k]).sum() for j in range(5) for k in range(j, 5))


def test_awkward_rows(spark):
    good = [(1, [0.5, 1.0, -2.0]), (2, [1.5, 0.0, 1.0]), (3, [0.1, 0.7, 9.0]), (3, [0.1, 0.7, 9.0]), (None, [4.0, 4.0, 4.5]), (5, [0.0, 1.0, 0.0])]
    bad = [(6, None), (7, [1.0, None, 1.0]), (8, [float("nan"), 1.0, 1.0]), (9, [1.0, float("inf"), 1.0]), (10, [1e300, 0.0, 0.0]),
           (11, []), (12, [1.0, 2.0]), (13, [1.0] * 4)]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({c: F.lit("own") for c in ("x", "n", "component", "white", "deviation", "dim")})
    check(good + bad, good, df)
    assert W.whitened(df.limit(0)).count() == 0 and W.whitened(df.where(F.col("embedding").isNull())).count() == 0


def test_constant_and_dependent_dimensions(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)
    assert W.whitened(same).count() == 0
    line = [(i, [float(i), float(2 * i), 3.0]) for i in range(20)]
    got = W.whitened(spark.createDataFrame(line, SCHEMA)).collect()
    assert len(got) == 20 and {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)


def test_query_whitens_the_whole_table(spark):
    rows = W.whitening_query(spark, "/root/testdata/sf0.01")
    n = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").count()
    r = rows.agg(F.count(F.lit(1)), F.max("identity_error"), F.countDistinct("vec_id"), F.max("component")).first()
    assert r[0] == 32 * n and r[1] < 1e-9 and (r[2], r[3]) == (n, 32)
