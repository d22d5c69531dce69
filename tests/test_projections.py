import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions import projections as PJ

# published worked examples: code, easting, northing, lon, lat
PUBLISHED = [(3032, 7255380.79, 7053389.56, 120.0, -75.0), (5041, 3320416.75, 632668.43, 44.0, 73.0),
             (3174, 1466493.492, 702903.006, -78.75, 42.75), (2154, 700000.0, 6600000.0, 3.0, 46.5)]


def test_published_points(spark):
    df = spark.createDataFrame([(f"EPSG:{c}", x, y, lon, lat) for c, x, y, lon, lat in PUBLISHED],
                               "crs string, x double, y double, lon double, lat double")
    for r in df.select("*", G.st_reproject_xy("x", "y", F.col("crs")).alias("p")).collect():
        # a published centimetre is 1e-7 degrees of latitude, more of longitude near a pole
        assert abs(r.p.y - r.lat) < 1e-7 and abs(r.p.x - r.lon) * math.cos(math.radians(r.lat)) < 1e-7, r


CLARKE_1866 = (6378206.4, 294.978698214)


def test_published_points_on_another_ellipsoid(spark):
    """Conformal cone in feet, and an equal-area cone."""
    texas = PJ.constants("conformal", CLARKE_1866, (28 + 23 / 60, 30 + 17 / 60), (27 + 50 / 60, -99.0),
                         (2000000 * PJ.US_FOOT, 0.0), PJ.US_FOOT)
    conus = PJ.constants("equal-area", CLARKE_1866, (29.5, 45.5), (23.0, -96.0), (0.0, 0.0), 1.0)
    for numbers, x, y, lon, lat, near in ((texas, 2963503.91, 254759.80, -96.0, 28.5, 1e-7), (conus, 1885472.7, 1535925.0, -75.0, 35.0, 1e-6)):
        r = spark.range(1).select(PJ.inverse(F.lit(x), F.lit(y), PJ._named(numbers)).alias("at")).first().at
        assert abs(r.lon - lon) < near and abs(r.lat - lat) < near


def test_forward_and_back_for_every_code(spark):
    rng = random.Random(3)
    rows = []
    for code, c in PJ.TABLE.items():
        for _ in range(40):
            lat = rng.uniform(-89, -50) if c["n"] == -1 else rng.uniform(50, 89) if c["n"] == 1 else rng.uniform(10, 70) * math.copysign(1, c["n"])
            rows.append((code, c["lon0"] + rng.uniform(-40, 40), lat))
    df = spark.createDataFrame(rows, "code int, lon double, lat double")
    there = df.withColumn("xy", PJ.conic_xy(F.col("lon"), F.col("lat"), F.col("code")))
    back = there.withColumn("p", G.st_reproject_xy(F.col("xy.x"), F.col("xy.y"), F.concat(F.lit("epsg:"), F.col("code"))))
    off = F.abs(F.pmod(F.col("p.x") - F.col("lon") + 180, F.lit(360.0)) - 180)
    worst = back.agg(F.max(off), F.max(F.abs(F.col("p.y") - F.col("lat"))), F.count("p")).first()
    assert worst[0] < 1e-8 and worst[1] < 5e-8 and worst[2] == len(rows), worst


def test_poles_and_unknown_codes(spark):
    df = spark.createDataFrame([("EPSG:3031", 0.0, 0.0), ("EPSG:3413", 0.0, 0.0), ("EPSG:9999", 1.0, 1.0), (None, 1.0, 1.0),
                                ("EPSG:2154", None, 1.0), ("EPSG:5070", 1e9, 1e9)], "crs string, x double, y double")
    out = df.select(G.st_reproject_xy("x", "y", F.col("crs")).alias("p"), G.crs_supported("crs").alias("known")).collect()
    assert abs(out[0].p.y + 90) < 1e-9 and abs(out[1].p.y - 90) < 1e-9
    assert [r.p for r in out[2:]] == [None] * 4
    assert [r.known for r in out] == [True, True, False, None, True, True]
