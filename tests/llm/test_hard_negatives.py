import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as H
from tessera.llm.oracles import hard_negatives_sql

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100):
    """The contract, row by row, over (vec_id, vector, label)."""
    ok = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows
          if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for k, (anchor, q, label) in enumerate(ok):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, w, strict=True)), i, other) for n, (i, w, other) in enumerate(ok) if n != k and len(w) == len(q)]
        for p, i, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fit = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(anchor, i, r, j, -p, -s) for r, (s, j, _) in enumerate(fit, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 70), st.one_of(st.integers(1, 2 ** 31), st.integers(1, 300)), st.integers(1, 9), st.integers(1, 20), st.integers(0, 2 ** 32))
def test_packed_products_are_exact(dim, most, n, m, seed):
    rng = np.random.default_rng(seed)
    most = min(most, int(math.sqrt((2 ** 61 - 1) / max(dim, 1))))
    a, r = (rng.integers(-most, most + 1, (k, dim)) for k in (n, m))
    got = H.packed_products(a, r, (a * a).sum(axis=1), (r * r).sum(axis=1))
    assert (got == a @ r.T).all()


def test_unit_vectors_share_a_word():
    assert 64 // H.field_width(np.array([256 ** 2]), np.array([256 ** 2])) == 3
    words, bias = H.pack(np.array([[-256, 256]] * 7), 18)
    assert words.shape == (2, 3) and bias == 256


@pytest.fixture(scope="module")
def table():
    """Clusters over labels, ties, copies, and rows that take no part."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(700):
        v = centres[i % 6] + rng.normal(scale=0.4, size=12)
        rows.append((i, [float(c) for c in v / np.linalg.norm(v)], int(rng.integers(3))))
    rows += [(1000 + i, rows[100][1], i % 3) for i in range(40)]                    # one vector many times
    rows += [rows[200], rows[200], (300, rows[5][1], 1)]                            # repeated rows, an id with two vectors
    return rows + [(None, rows[0][1], 0), (900, rows[0][1], None), (901, None, 0), (1100, [], 0), (1101, [], 1), (1102, [], 0),
                   (902, [float("nan")] * 12, 0), (903, [None] + rows[0][1][1:], 0), (904, [float("-inf")] * 12, 1),
                   (1200, [0.5], 0), (1201, [0.4], 1), (1202, [0.5], 0), (1300, [3e5, -1e4], 2), (1301, [2.9e5, -1e4], 1), (1302, [3e5, 0.0], 2)]


def test_equals_brute_force(spark, table):
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    df = df.withColumns({c: F.lit("own") for c in ("row", "vec", "norm", "is_anchor", "rank", "score", "id", "slot")})
    got = result(H.hard_negatives(df, F.col("vec_id") % 100 == 0))
    assert got == brute(table) and len(got) > 50


def test_blocks_do_not_matter(spark, table, monkeypatch):
    monkeypatch.setattr(H, "ANCHORS", 3)
    monkeypatch.setattr(H, "ROWS", 90)
    monkeypatch.setattr(H, "ANCHOR_STEP", 2)
    monkeypatch.setattr(H, "ROW_STEP", 17)
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    assert result(H.hard_negatives(df, F.col("vec_id") % 100 == 0)) == brute(table)


def test_equal_rows_and_scores(spark):
    rows = [(i, [1.0, 0.0], i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = result(H.hard_negatives(df, F.col("vec_id") % 100 == 0))
    assert got == brute(rows)
    assert [r[3] for r in got if r[0] == 100 and r[1] == 0] == [1, 3, 5, 7, 9]


def test_too_long_and_empty(spark):
    rows = [(0, [1e12], 0), (1, [1e300], 0), (100, [1.0], 0), (2, [1.0], 0), (3, [0.9], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(H.hard_negatives(df, F.col("vec_id") % 100 == 0)) == [(100, 2, 1, 3, 65536, 256 * 230)]
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute("SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (" + hard_negatives_sql() + ")").fetchall())
    assert result(H.hard_negatives_query(spark, sf)) == want and want
