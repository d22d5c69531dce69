import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as G

SQUARE_HOLE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2))"
MULTI = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))"


def _one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("v")).first()["v"]


def test_wkt_variants(spark):
    df = spark.createDataFrame([(SQUARE_HOLE,), (MULTI,), ("polygon ((0 0, 1e1 0, 1E1 1.0e+1, 0 0))",),
                                ("POLYGON EMPTY",), ("POLYGON ((0 0, 1",), ("LINESTRING (0 0, 1 1)",),
                                (None,), ("POINT (3 4)",)], "t string")
    g = df.select(G.st_geom_from_wkt("t").alias("g"))
    out = g.select(G.st_geometry_type("g").alias("t"), G.st_num_geometries("g").alias("n"),
                   G.st_num_points("g").alias("p")).collect()
    assert (out[0].t, out[0].n, out[0].p) == ("POLYGON", 1, 10)
    assert (out[1].t, out[1].n, out[1].p) == ("MULTIPOLYGON", 2, 10)
    assert (out[2].t, out[2].p) == ("POLYGON", 4)
    assert (out[3].t, out[3].n) == ("POLYGON", 0)
    assert out[4].t is None and out[5].t is None and out[6].t is None
    assert (out[7].t, out[7].p) == ("POINT", 1)


def test_wkt_round_trip(spark):
    df = spark.createDataFrame([(SQUARE_HOLE,), (MULTI,)], "t string")
    g = df.select(G.st_geom_from_wkt("t").alias("g"))
    back = g.select(G.st_geom_from_wkt(G.st_as_text("g")).alias("h"), "g")
    assert back.where(F.col("g") != F.col("h")).count() == 0
    gj = g.select(G.st_geom_from_geojson(G.st_as_geojson("g")).alias("h"), "g")
    assert gj.where(F.col("g.polys") != F.col("h.polys")).count() == 0


@pytest.mark.parametrize("x,y,inclusive,interior", [
    (5.0, 5.0, True, True),      # inside
    (10.0, 5.0, True, False),    # on an edge
    (10.0, 10.0, True, False),   # on a vertex
    (3.0, 3.0, False, False),    # in the hole
    (2.0, 3.0, True, False),     # on the hole's edge
    (11.0, 5.0, False, False),   # outside
])
def test_point_in_polygon_boundaries(spark, x, y, inclusive, interior):
    df = spark.createDataFrame([(SQUARE_HOLE, x, y)], "t string, x double, y double") \
        .withColumn("g", G.st_geom_from_wkt("t"))
    r = df.select(G.st_intersects_point("g", F.col("x"), F.col("y")).alias("i"),
                  G.st_contains_point("g", F.col("x"), F.col("y")).alias("c")).first()
    assert (r.i, r.c) == (inclusive, interior)


def test_second_part_and_nulls(spark):
    df = spark.createDataFrame([(MULTI, 5.5, 5.5), (MULTI, 3.0, 3.0), (None, 1.0, 1.0)],
                               "t string, x double, y double").withColumn("g", G.st_geom_from_wkt("t"))
    out = [r.i for r in df.select(G.st_intersects_point("g", F.col("x"), F.col("y")).alias("i")).collect()]
    assert out == [True, False, None]


def test_centroid_and_area(spark):
    df = spark.createDataFrame([(SQUARE_HOLE,)], "t string").withColumn("g", G.st_geom_from_wkt("t"))
    r = df.select(G.st_area("g").alias("a"), G.st_centroid("g").alias("c")).first()
    assert abs(r.a - 96.0) < 1e-12
    cx = (100 * 5 - 4 * 3) / 96.0
    assert abs(r.c.polys[0][0][0][0] - cx) < 1e-12 and abs(r.c.polys[0][0][0][1] - cx) < 1e-12


def _utm_forward(lon, lat, zone):
    """Independent forward transverse Mercator (Krueger series) for the test."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    big_a = a / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    alpha = [n / 2 - 2 * n * n / 3 + 5 * n ** 3 / 16, 13 * n * n / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240]
    phi, lam = math.radians(lat), math.radians(lon - (zone * 6 - 183))
    c = 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(phi)) - c * math.atanh(c * math.sin(phi)))
    xi, eta = math.atan(t / math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    e = eta + sum(al * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, al in enumerate(alpha, 1))
    nn = xi + sum(al * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, al in enumerate(alpha, 1))
    return 500000 + k0 * big_a * e, k0 * big_a * nn


def test_reproject_known_points(spark):
    e, n = _utm_forward(-74.0, 40.7, 18)
    df = spark.createDataFrame([(e, n, "EPSG:32618"), (0.0, 0.0, "EPSG:3857"),
                                (-74.0, 40.7, "EPSG:4326"), (1.0, 1.0, "EPSG:9999")],
                               "x double, y double, crs string")
    out = df.select(G.st_reproject_xy(F.col("x"), F.col("y"), F.col("crs")).alias("p")).collect()
    assert abs(out[0].p.x - (-74.0)) < 1e-7 and abs(out[0].p.y - 40.7) < 1e-7
    assert out[1].p.x == 0.0 and out[1].p.y == 0.0
    assert (out[2].p.x, out[2].p.y) == (-74.0, 40.7)
    assert out[3].p is None


def test_make_point_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "x double, y double")
    out = df.select(G.st_make_point("x", "y").alias("p")).collect()
    assert out[0].p is None and out[1].p.gtype == "POINT"
