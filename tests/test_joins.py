import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import cells as C
from tessera.functions import geometry as G
from tessera.operators import polyfill as P
from tessera.operators import spatial_join as J
from tessera.operators.sizing import materialise
from tessera.plans import geo_queries as Q
from tessera.sources import fixtures as FX

from conftest import SF_SMALL


def test_fixture_counts_match_design(spark):
    """Numbers recorded in FIXTURES.md for the grid and the fixture."""
    z = Q.zones_geom(spark, SF_SMALL)
    cnt = {r.location_id: r["count"] for r in
           P.polyfill(z, "geom", 9, "location_id").groupBy("location_id").count().collect()}
    assert (cnt[6], cnt[18], sum(cnt.values())) == (753, 746, 19228)
    two = Q.airports_cells(spark, SF_SMALL).where(F.col("locationid").isin(6, 18))
    r = Q.between_airports(spark, SF_SMALL, two).first()
    assert (r.num_trips, r.num_passengers) == (120, 376) and r.earnings == "$2488.5"
    r = Q.q_airport_trips(spark, SF_SMALL).first()          # with the two parts of zone 8
    assert (r.num_trips, r.num_passengers) == (123, 386)


def test_pip_join_equals_brute_force(spark):
    """Cell-cover join == exact test of every (trip, zone) pair (small fixture)."""
    t = FX.trips_fx(spark, SF_SMALL).select("trip_id", "pickup_longitude", "pickup_latitude")
    z = Q.zones_geom(spark, SF_SMALL)
    fast = J.pip_join(t, "pickup_longitude", "pickup_latitude", z, "geom", "location_id", 9) \
        .select("trip_id", "location_id")
    brute = t.crossJoin(z.select("location_id", "geom")) \
        .where(G.st_intersects_point("geom", F.col("pickup_longitude"), F.col("pickup_latitude"))) \
        .select("trip_id", "location_id")
    assert fast.exceptAll(brute).count() == 0 and brute.exceptAll(fast).count() == 0
    assert fast.count() == 1211


def test_cover_contains_every_inside_point(spark):
    t = FX.trips_fx(spark, SF_SMALL)
    z = Q.zones_geom(spark, SF_SMALL)
    for res in (7, 9, 12):
        cover = P.polycover(z, "geom", res, "location_id")
        inside = t.crossJoin(z.select("location_id", "geom")).where(
            G.st_intersects_point("geom", F.col("pickup_longitude"), F.col("pickup_latitude"))) \
            .select("location_id", C.cell_from_lonlat("pickup_longitude", "pickup_latitude", res).alias("cell"))
        assert inside.join(cover, ["location_id", "cell"], "left_anti").count() == 0, res
        # core cells never contain outside points
        outside = t.crossJoin(z.select("location_id", "geom")).where(
            ~G.st_intersects_point("geom", F.col("pickup_longitude"), F.col("pickup_latitude"))) \
            .select("location_id", C.cell_from_lonlat("pickup_longitude", "pickup_latitude", res).alias("cell"))
        assert outside.join(cover.where("core"), ["location_id", "cell"]).count() == 0, res


def test_first_match_skips_null_value(spark):
    zones = spark.createDataFrame([
        (1, 0, None, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"),
        (2, 1, "B", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"),
        (3, 2, "C", "POLYGON ((0 0, 20 0, 20 20, 0 20, 0 0))")],
        "zid int, ord int, borough string, wkt string").withColumn("geom", G.st_geom_from_wkt("wkt"))
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 15.0), (3, 50.0, 50.0), (4, 10.0, 5.0)],
                                "id long, x double, y double")
    out = {r.id: r.b for r in J.pip_first_match(pts, "id", "x", "y", zones, "geom", "zid", "ord",
                                                "borough", "b", res=3).collect()}
    assert out == {1: "B", 2: "C", 3: None, 4: "B"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_plans_have_no_nested_loops_or_python(spark):
    for name in ("airport_trips", "join_cell_zone", "pip_join", "pip_first_match"):
        from tessera.plans.registry import load_all
        df = load_all()[name](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = _plan(df)
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_lookup_join_matches_brute_force_on_star_polygons(spark):
    """Non-convex stars with holes, many vertices, and probe points placed exactly
    on vertices and edges: the cell lookup equals the exact test everywhere."""
    import math
    zones, pts = [], []
    for z in range(3):
        cx, cy = -73.95 + 0.05 * z, 40.70
        ring = []
        for i in range(41):
            ang = 2 * math.pi * (i % 40) / 40
            r = 0.02 if i % 2 == 0 else 0.008
            ring.append((round(cx + r * math.cos(ang), 6), round(cy + r * math.sin(ang), 6)))
        hole = [(cx - 0.002, cy - 0.002), (cx + 0.002, cy - 0.002), (cx + 0.002, cy + 0.002),
                (cx - 0.002, cy + 0.002), (cx - 0.002, cy - 0.002)]
        wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "), (" + \
              ", ".join(f"{x!r} {y!r}" for x, y in hole) + "))"
        zones.append((z, z, f"Z{z}", wkt))
        pts += [(x, y) for x, y in ring[:-1]]                                  # on vertices (exact)
        # edge midpoints rounded to doubles are only within an ulp of the edge, where
        # any two correct formulations may round differently; probe just off them
        pts += [((ring[i][0] + ring[i + 1][0]) / 2 + 1e-7, (ring[i][1] + ring[i + 1][1]) / 2) for i in range(40)]
        pts += [(cx + 0.001, cy), (cx + 0.002, cy + 0.001)]                    # in hole, on hole edge
    for i in range(60):
        for j in range(30):
            pts.append((-73.98 + i * 0.0025, 40.675 + j * 0.0017))
    zdf = spark.createDataFrame(zones, "zid int, ord int, name string, wkt string") \
        .withColumn("geom", G.st_geom_from_wkt("wkt"))
    pdf = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(pts)], "pid long, x double, y double")
    brute = pdf.crossJoin(zdf.select("zid", "geom")) \
        .where(G.st_intersects_point("geom", F.col("x"), F.col("y"))).select("pid", "zid")
    for res in (7, 9, 11):
        fast = J.pip_join(pdf, "x", "y", zdf, "geom", "zid", res).select("pid", "zid")
        assert fast.exceptAll(brute).count() == 0 and brute.exceptAll(fast).count() == 0, res
    assert brute.count() > 100


def test_shuffle_join_path_when_over_broadcast_limit(spark):
    """With the size check failing, joins fall back to shuffle joins on the cell
    and give the same results."""
    from tessera.plans.registry import load_all
    qs = load_all()
    names = ["airport_trips", "join_cell_zone", "pip_join", "pip_first_match"]
    expected = {n: sorted(map(tuple, qs[n](spark, SF_SMALL).collect())) for n in names}
    spark.conf.set("tessera.broadcast.maxBytes", "0")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in names:
            df = qs[n](spark, SF_SMALL)
            got = sorted(map(tuple, df.collect()))
            assert got == expected[n], n
            assert not re.search(r"BroadcastHashJoin[^\n]*cell", _plan(df)), n
    finally:
        spark.conf.unset("tessera.broadcast.maxBytes")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


UNCLOSED = "POLYGON ((0 0, 0.4 0, 0.4 0.4, 0 0.4))"
OVERLAP = ("MULTIPOLYGON (((0 0, 0.4 0, 0.4 0.4, 0 0.4, 0 0)), ((0.2 0.2, 0.6 0.2, 0.6 0.6, 0.2 0.6, 0.2 0.2)))")


def _cells(spark, wkt, res=7):
    df = spark.createDataFrame([(1, wkt)], "k int, wkt string")
    return [r.cell for r in P.polyfill_wkt(df, "wkt", res, "k").collect()]


def test_an_open_ring_is_closed(spark):
    closed = UNCLOSED.replace("))", ", 0 0))")
    assert sorted(_cells(spark, UNCLOSED)) == sorted(_cells(spark, closed)) != []


def test_overlapping_parts_are_united(spark):
    a, b = ("POLYGON ((0 0, 0.4 0, 0.4 0.4, 0 0.4, 0 0))", "POLYGON ((0.2 0.2, 0.6 0.2, 0.6 0.6, 0.2 0.6, 0.2 0.2))")
    both = _cells(spark, OVERLAP)
    assert len(both) == len(set(both)) and set(both) == set(_cells(spark, a)) | set(_cells(spark, b))


@pytest.mark.parametrize("res", [5, 7, 9])
def test_points_in_an_overlap_are_inside_once(spark, res):
    pts = [(0, 0.3, 0.3), (1, 0.1, 0.1), (2, 0.5, 0.5), (3, 0.5, 0.1), (4, 0.2, 0.3), (5, 0.7, 0.7)]
    p = spark.createDataFrame(pts, "pid int, x double, y double")
    z = spark.createDataFrame([(7, OVERLAP)], "zid int, wkt string").withColumn("geom", G.st_geom_from_wkt("wkt"))
    direct = sorted(r.pid for r in p.crossJoin(z).where(G.st_intersects_point("geom", F.col("x"), F.col("y"))).collect())
    joined = sorted(r.pid for r in J.pip_join(p, "x", "y", z, "geom", "zid", res).collect())
    assert direct == joined == [0, 1, 2, 4]


def test_refined_cell_join_is_exact_at_every_resolution(spark):
    t = FX.trips_fx(spark, SF_SMALL).select("trip_id", "pickup_longitude", "pickup_latitude")
    z = Q.zones_geom(spark, SF_SMALL)
    exact = sorted(map(tuple, Q.q_pip_join(spark, SF_SMALL).collect()))
    for res in (6, 8):
        got = J.refined_cell_join(t, "pickup_longitude", "pickup_latitude", z, "geom", "location_id", res)
        assert sorted(map(tuple, got.select("trip_id", "location_id").collect())) == exact, res


def test_measured_bytes_of_a_zone_with_many_vertices(spark):
    """The lookup of one 20,000-vertex zone: the measure counts the edges inside its candidates, and no
    cell holds the whole edge list."""
    import math
    n = 20_000
    ring = [(0.5 * math.cos(2 * math.pi * i / n), 0.5 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    wkt = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    z = spark.createDataFrame([(1, 0, wkt)], "zid int, ord int, wkt string").withColumn("geom", G.st_geom_from_wkt("wkt"))
    lookup = J.zone_lookup(z, "geom", "zid", 7, [], "ord")
    edges = F.aggregate("cands", F.lit(0), lambda a, c: a + F.size(c["edges"]))
    total, most, rows = lookup.df.agg(F.sum(edges), F.max(edges), F.count(F.lit(1))).first()
    real = total * 4 * 8                    # four doubles an edge, the least any form needs
    assert total >= n and most < n / 10
    assert real <= lookup.bytes() <= 2 * (total * (4 * 8 + 24) + rows * 200)


def test_uncompact_refuses_cells_finer_than_its_target(spark):
    df = spark.createDataFrame([(1, 0.1, 0.1)], "k int, x double, y double").select(
        "k", C.cell_from_lonlat("x", "y", 9).alias("cell"))
    with pytest.raises(Exception, match="finer than 7"):
        P.uncompact(df, 7, "k").collect()


def test_points_meet_compacted_cells_as_the_whole_fill(spark, tmp_path):
    whole = Q.airports_cells(spark, SF_SMALL)
    pts = Q.trips_cells(spark, SF_SMALL, 12).select("pickup_cell").where("pickup_cell is not null")
    want = sorted((r["pickup_cell"], r["locationid"]) for r in pts.join(whole, F.col("pickup_cell") == F.col("cell")).collect())
    df = Q.q_join_compacted_cells(spark, SF_SMALL)
    assert sorted((r["pickup_cell"], r["locationid"]) for r in df.collect()) == want and want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # two scans: the trips and the compacted cells; nothing expands these
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Generate") == 1


def test_ancestor_join_without_cells_or_with_finer_ones(spark):
    pts = spark.createDataFrame([(1, None), (2, 5 << 58)], "id int, c long")
    none = spark.createDataFrame([], "cell long, zone string")
    out = J.ancestor_join(pts, "c", 5, none)
    assert out.columns == ["id", "c", "cell", "zone"] and out.count() == 0
    finer = spark.createDataFrame([(9 << 58, "a")], "cell long, zone string")
    assert J.ancestor_join(pts, "c", 5, finer).count() == 0
    own = C.cell_from_lonlat(F.lit(1.0), F.lit(2.0), 5)
    pts = spark.range(1).select(own.alias("c")).unionByName(spark.createDataFrame([(None,)], "c long"))
    zones = spark.range(1).select(C.cell_from_lonlat(F.lit(1.0), F.lit(2.0), 5).alias("cell")).unionByName(
        pts.where("c is not null").select(C.cell_parent("c", 5, 2).alias("cell")))
    assert J.ancestor_join(pts, "c", 5, zones).count() == 2
