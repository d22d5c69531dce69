import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import nn_descent as N


def brute(rows, threshold=0.98):
    """vec_id -> (links, component) over (vec_id, vector, label) rows."""
    ok = {}
    for i, v, label in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, dtype=np.float64)
        if x is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()                  # no square overflows
            ok[i] = (x / np.sqrt(x @ x), label)
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(root, 0)
    ids = sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i in root}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.fixture(scope="module")
def clusters(spark):
    """Clusters of close vectors, some larger than the lists, copies, and scattered vectors."""
    rng = np.random.default_rng(8)
    rows = []
    for c, size in enumerate([2, 2, 3, 5, 12, 40, 90]):
        centre = rng.normal(size=24)
        for _ in range(size):
            rows.append((centre + rng.normal(scale=0.08, size=24) * rng.random(), c % 2))
    rows += [(rng.normal(size=24), int(rng.integers(2))) for _ in range(500)]
    rows += [rows[k] for k in (0, 0, 50, 200)]
    order = rng.permutation(len(rows))
    return [(int(i), [float(v) for v in rows[k][0]], rows[k][1]) for i, k in enumerate(order)]


def test_clusters_equal_brute_force(spark, clusters):
    df = spark.createDataFrame(clusters, "vec_id long, embedding array<double>, label int").repartition(5)
    assert result(N.near_duplicates(df)) == brute(clusters)


def test_blocks_and_growing_lists(spark, clusters, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    calls = []
    audit = N.audit
    monkeypatch.setattr(N, "audit", lambda *a: calls.append(audit(*a)) or (0.0 if len(calls) == 1 else calls[-1]))
    df = spark.createDataFrame(clusters, "vec_id long, embedding array<double>, label int").repartition(5)
    assert result(N.near_duplicates(df)) == brute(clusters)
    assert len(calls) == 2 and calls[-1] == 1.0


def test_awkward_vectors(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1e200, 1e190], 0), (11, [1.0, 0.0, 0.0], 0),
            (12, [1e-300, 0.0], 0), (13, [-1.0, 0.0], 0), (14, [1.0, 0.0], 1)]
    schema = "vec_id long, embedding array<double>, label int"
    df = spark.createDataFrame(rows, schema).withColumn("n_links", F.lit("own")).withColumn("id", F.lit("own")).withColumn("vec", F.lit(1))
    assert result(N.near_duplicates(df)) == brute(rows)
    assert N.near_duplicates(df.limit(0)).count() == 0
    repeated = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)], schema)
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in N.near_duplicates(repeated).collect())
    assert got == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def planted(n, pairs, d=32, seed=3):
    """``n`` scattered vectors of one label, of which ``pairs`` isolated ones have a partner at a
    cosine just above the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(pairs, d))
    away -= np.einsum("ij,ij->i", away, x[:pairs])[:, None] * x[:pairs]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cos = rng.uniform(0.9801, 0.985, size=(pairs, 1))
    x[n - pairs:] = cos * x[:pairs] + np.sqrt(1 - cos * cos) * away
    return x


def frame(spark, x):
    rows = {"vec_id": np.arange(len(x)), "embedding": list(x), "label": np.zeros(len(x), dtype=np.int32)}
    return spark.createDataFrame(pa.table(rows)).repartition(8)


def found(got, n, pairs):
    return sum(got[i][0] == 1 and got[n - pairs + i][1] == i for i in range(pairs))


def test_isolated_pairs_of_a_large_label(spark, monkeypatch):
    """The forest alone meets them: the rounds cannot, as such pairs have no common neighbours."""
    monkeypatch.setattr(N, "descend", lambda lists, classes, k: lists)
    n, pairs = 100_000, 1000
    got = result(N.near_duplicates(frame(spark, planted(n, pairs))))
    assert len(got) == n and found(got, n, pairs) >= 0.995 * pairs, found(got, n, pairs)


def test_isolated_pairs_of_a_middling_label(spark):
    n, pairs = 5000, 500
    got = result(N.near_duplicates(frame(spark, planted(n, pairs))))
    assert len(got) == n and found(got, n, pairs) >= 0.995 * pairs


def test_forest_with_large_leaves_equals_brute_force(spark, clusters, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    df = spark.createDataFrame(clusters, "vec_id long, embedding array<double>, label int").repartition(5)
    assert result(N.near_duplicates(df)) == brute(clusters)


def test_forest_and_rounds_run_for_every_label(spark, clusters, monkeypatch):
    ran = []
    for name in ("forest", "descend", "audit"):
        monkeypatch.setattr(N, name, lambda *a, f=getattr(N, name), name=name, **k: ran.append(name) or f(*a, **k))
    N.near_duplicates(spark.createDataFrame(clusters, "vec_id long, embedding array<double>, label int")).count()
    assert ran[:3] == ["forest", "descend", "audit"]


def test_one_vec_id_with_several_vectors(spark):
    rows = [(5, [0.0, 1.0], 0), (5, [1.0, 0.0], 0), (6, [1.0, 0.0], 0), (7, [1.0, 0.0], 0), (9, [0.0, 1.0], 1)]
    got = N.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(tuple(r) for r in got) == [(5, 0, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False), (9, 0, 9, True)]


def test_audit_counts_each_linked_class_alike(spark):
    rng = np.random.default_rng(4)
    x = planted(200, 100)
    group = rng.normal(size=32) + rng.normal(scale=0.001, size=(200, 32))
    rows = [("0", 32, v.tobytes(), i, 1) for i, v in enumerate(np.concatenate([x, group]))]
    classes = spark.createDataFrame(rows, "label string, dim int, vec binary, id long, copies long")
    only_group = spark.createDataFrame([(i, 199) for i in range(200, 400)], "id long, links long")
    assert N.audit(classes, only_group, 0.98) == pytest.approx(0.5)


def test_failing_audits_add_trees(spark, clusters, monkeypatch):
    """The first forests find nothing; later ones make up for it, and a warning tells when they do not."""
    seeds = []
    leaves, forest = N.forest_leaves, N.forest
    monkeypatch.setattr(N, "forest_leaves", lambda classes, threshold, seed: seeds.append(seed) or leaves(classes, threshold, seed=seed))
    monkeypatch.setattr(N, "forest", lambda classes, k, at: forest(classes, k, at) if len(seeds) > 2 else classes.select(
        F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("sim")).limit(0))
    df = spark.createDataFrame(clusters, "vec_id long, embedding array<double>, label int").repartition(5)
    assert result(N.near_duplicates(df)) == brute(clusters)
    assert seeds == [5, 6, 7]
    monkeypatch.setattr(N, "RETRIES", 0)
    seeds.clear()
    with pytest.warns(UserWarning, match="recall 0.0000"):
        N.near_duplicates(df)
