"""Registered queries of the geometry functions: WKT / GeoJSON parsing and
printing, accessors, point construction and containment, centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.plans import oracle_parts as O
from tessera.plans.registry import register
from tessera.session import scratch_dir
from tessera.sources import fixtures as FX
from tessera.sources import geojson as GJ
from tessera.sources import readers as RD


def _zones(spark, sf):
    return FX.zones_fx(spark, sf).withColumn("geom", G.st_geom_from_wkt("the_geom"))


def _vertex_stats(geom):
    pts = G.st_coordinates(geom)
    return [G.st_num_points(geom).alias("num_points"),
            F.round(F.aggregate(pts, F.lit(0.0), lambda a, p: a + p[0]), 6).alias("sum_x"),
            F.round(F.aggregate(pts, F.lit(0.0), lambda a, p: a + p[1]), 6).alias("sum_y")]


@register("st_geom_from_wkt", oracle="S")
def q_st_geom_from_wkt(spark, sf):
    z = _zones(spark, sf)
    return z.select("location_id", G.st_geometry_type("geom").alias("gtype"),
                    G.st_num_geometries("geom").alias("num_parts"), *_vertex_stats(F.col("geom")))


@register("st_as_text", oracle="S")
def q_st_as_text(spark, sf):
    """WKT round trip: print, parse again, compare text and vertices."""
    z = _zones(spark, sf).withColumn("wkt", G.st_as_text("geom"))
    back = G.st_geom_from_wkt(F.col("wkt"))
    return z.select("location_id", (F.col("wkt") == F.col("the_geom")).alias("same_text"),
                    *_vertex_stats(back))


@register("st_geom_from_geojson", oracle="S")
def q_st_geom_from_geojson(spark, sf):
    z = _zones(spark, sf)
    g = G.st_geom_from_geojson(G.st_as_geojson("geom"))
    return z.select("location_id", G.st_geometry_type(g).alias("gtype"), *_vertex_stats(g))


def _geojson_dir(spark, sf) -> str:
    path = scratch_dir(spark, "zones_geojson")
    RD.write_geojson(_zones(spark, sf), path, "geom", ["location_id", "borough", "zone"], per_document=10)
    return path


@register("scan_geojson_split", oracle="S")
def q_scan_geojson_split(spark, sf):
    """All zones in one FeatureCollection file, read by byte ranges."""
    path = scratch_dir(spark, "zones_geojson")
    RD.write_geojson(_zones(spark, sf).coalesce(1), path, "geom", ["location_id", "borough", "zone"])
    return _feature_stats(GJ.read_geojson_features(spark, path))


@register("geojson_features", oracle="S")
def q_geojson_features(spark, sf):
    """FeatureCollection files -> one row per feature with properties and WKT."""
    return _feature_stats(RD.geojson_features(RD.read_geojson(spark, _geojson_dir(spark, sf))))


def _feature_stats(feats):
    g = G.st_geom_from_wkt(F.col("geometry"))
    return feats.select(F.col("properties.location_id").try_cast("int").alias("locationid"),
                        F.col("properties.borough").alias("borough"),
                        F.col("properties.zone").alias("zone"),
                        *_vertex_stats(g),
                        F.round(G.st_area(g) * F.lit(1e4), 6).alias("area_e4"))


@register("struct_project", oracle="S")
def q_struct_project(spark, sf):
    """Nested field access: feature.properties.borough, cast(location_id as int)."""
    coll = RD.read_geojson(spark, _geojson_dir(spark, sf))
    f = coll.select(F.explode("features").alias("feature"))
    return f.select(F.col("feature.properties.location_id").try_cast("int").alias("locationid"),
                    F.col("feature.properties.borough").alias("borough"),
                    F.col("feature.properties.zone").alias("zone"))


@register("geometry_to_json", oracle="S")
def q_geometry_to_json(spark, sf):
    """Geometries printed as JSON text, compared through the fields of that text."""
    coll = RD.read_geojson(spark, _geojson_dir(spark, sf))
    f = coll.select(F.explode("features").alias("feature"))
    js = f.select(F.col("feature.properties.location_id").cast("int").alias("location_id"),
                  F.to_json(F.col("feature.geometry")).alias("js"))
    return js.select("location_id", F.get_json_object("js", "$.type").alias("gtype"),
                     F.regexp_count(F.get_json_object("js", "$.coordinates"), F.lit("\\[-?[0-9]")).cast("long").alias("num_points"))


@register("scan_geojson", oracle="S")
def q_scan_geojson(spark, sf):
    """FeatureCollection files of at most ten features, as read: one row per feature."""
    coll = RD.read_geojson(spark, _geojson_dir(spark, sf))
    f = coll.select("type", F.explode("features").alias("f"))
    return f.select("type", F.col("f.type").alias("feature_type"), F.col("f.properties.location_id").alias("location_id"),
                    F.col("f.properties.borough").alias("borough"), F.col("f.properties.zone").alias("zone"),
                    F.col("f.geometry.type").alias("gtype"))


@register("explode_array", oracle="S")
def q_explode_array(spark, sf):
    """explode over part arrays: empty arrays drop the row."""
    z = _zones(spark, sf)
    parts = F.when(F.col("location_id") % 5 == 0, F.array().cast(G.POLYS_TYPE)).otherwise(F.col("geom.polys"))
    e = z.select("location_id", F.posexplode(parts).alias("part_no", "part"))
    return e.select("location_id", "part_no", F.size("part").alias("num_rings"))


@register("st_geometry_type", oracle="S")
def q_st_geometry_type(spark, sf):
    return _zones(spark, sf).select("location_id", G.st_geometry_type("geom").alias("gtype"))


@register("st_num_geometries", oracle="S")
def q_st_num_geometries(spark, sf):
    return _zones(spark, sf).select("location_id", G.st_num_geometries("geom").alias("num_geometries"))


@register("st_geometry_n", oracle="S")
def q_st_geometry_n(spark, sf):
    """Second part (index 1) of each zone; null when the zone has one part."""
    z = _zones(spark, sf)
    g = G.st_geometry_n("geom", 1)
    return z.select("location_id", G.st_num_points(g).alias("num_points"),
                    G.st_geometry_type(g).alias("gtype"))


@register("st_coordinates", oracle="S")
def q_st_coordinates(spark, sf):
    """All vertices with the axis swap to (lat, lon)."""
    z = _zones(spark, sf)
    return z.select("location_id", F.posexplode(G.st_coordinates("geom", lat_first=True)).alias("i", "p")) \
        .select("location_id", "i", F.col("p")[0].alias("lat"), F.col("p")[1].alias("lon"))


@register("st_make_point", oracle="S")
def q_st_make_point(spark, sf):
    t = FX.trips_fx(spark, sf)
    lon = F.when(F.col("trip_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("pickup_longitude"))
    p = G.st_make_point(lon, F.col("pickup_latitude"))
    return t.select("trip_id", G.st_x(p).alias("x"), G.st_y(p).alias("y"), p.isNull().alias("is_null"))


@register("st_point_in_polygon", oracle="S")
def q_st_point_in_polygon(spark, sf):
    """Each trip's pickup against zone (trip_id % 25): exact, boundary inclusive."""
    t = FX.trips_fx(spark, sf).withColumn("location_id", (F.col("trip_id") % 25).cast("int"))
    z = _zones(spark, sf).select("location_id", "geom")
    j = t.join(z, "location_id")
    return j.select("trip_id", "location_id",
                    G.st_intersects_point("geom", F.col("pickup_longitude"), F.col("pickup_latitude"))
                    .alias("inside"))


@register("st_centroid", oracle="S")
def q_st_centroid(spark, sf):
    z = _zones(spark, sf)
    c = G.st_centroid("geom")
    return z.select("location_id", F.round(G.st_x(c), 6).alias("cx"), F.round(G.st_y(c), 6).alias("cy"),
                    F.round(G.st_area("geom") * F.lit(1e4), 6).alias("area_e4"))


@register("sql_functions", oracle="S")
def q_sql_functions(spark, sf):
    """The SQL names (st_*, cell_from_lonlat, ...) used from a SQL statement."""
    from tessera.functions.sqlfuncs import register_sql_functions
    import uuid
    register_sql_functions(spark)
    tv, zv = f"trips_{uuid.uuid4().hex[:8]}", f"zones_{uuid.uuid4().hex[:8]}"
    FX.trips_fx(spark, sf).createOrReplaceTempView(tv)
    FX.zones_fx(spark, sf).createOrReplaceTempView(zv)
    return spark.sql(f"""
        SELECT t.trip_id,
               cell_from_lonlat(t.pickup_longitude, t.pickup_latitude, 12) AS pickup_cell,
               geo_to_cell(t.pickup_latitude, t.pickup_longitude, 7) AS pickup_r7,
               cell_resolution(cell_from_lonlat(t.pickup_longitude, t.pickup_latitude, 9)) AS res,
               cell_parent(cell_from_lonlat(t.pickup_longitude, t.pickup_latitude, 12)) AS parent_r11,
               st_intersects_point(z.g, t.pickup_longitude, t.pickup_latitude) AS inside,
               z.gtype, z.npoints, z.area_e4
        FROM {tv} t
        JOIN (SELECT location_id, g, st_geometrytype(g) AS gtype,
                     st_npoints(st_geomfromwkt(st_astext(g))) AS npoints,
                     round(st_area(g) * 1e4D, 6) AS area_e4
              FROM (SELECT location_id, st_geomfromwkt(the_geom) AS g FROM {zv})) z
          ON z.location_id = t.trip_id % 25""")


# ---- oracle SQL -----------------------------------------------------------------

def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    zc = O.zones_cte()
    vstats = """vstats AS (
  SELECT location_id, count(*) AS num_points, round(sum(x), 6) AS sum_x, round(sum(y), 6) AS sum_y
  FROM zone_vtx GROUP BY location_id
)"""
    gtype = "CASE WHEN location_id % 4 = 0 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END"
    q["st_geom_from_wkt"] = f"""WITH {zc},
{vstats}
SELECT location_id, {gtype} AS gtype, CASE WHEN location_id % 4 = 0 THEN 2 ELSE 1 END AS num_parts,
       num_points, sum_x, sum_y FROM vstats"""
    q["st_as_text"] = f"WITH {zc},\n{vstats}\nSELECT location_id, true AS same_text, num_points, sum_x, sum_y FROM vstats"
    q["st_geom_from_geojson"] = f"WITH {zc},\n{vstats}\nSELECT location_id, {gtype} AS gtype, num_points, sum_x, sum_y FROM vstats"
    area = """areas AS (
  SELECT location_id,
         sum(CASE WHEN kind = 1 THEN -1 ELSE 1 END * abs(a2)) / 2 AS area
  FROM (SELECT location_id, kind, sum(x1 * y2 - x2 * y1) AS a2 FROM zone_edges GROUP BY location_id, kind) r
  GROUP BY location_id
)"""
    jtype = "CASE WHEN location_id % 4 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END"
    q["geometry_to_json"] = f"WITH {zc},\n{vstats}\nSELECT location_id, {jtype} AS gtype, num_points FROM vstats"
    q["scan_geojson"] = (f"WITH {zc}\nSELECT 'FeatureCollection' AS type, 'Feature' AS feature_type, CAST(location_id AS VARCHAR) AS location_id, "
                         f"borough, zone, {jtype} AS gtype FROM zones")
    q["geojson_features"] = f"""WITH {zc},
{vstats},
{area}
SELECT z.location_id AS locationid, z.borough, z.zone, v.num_points, v.sum_x, v.sum_y,
       round(a.area * {O.d(1e4)}, 6) AS area_e4
FROM zones z JOIN vstats v USING (location_id) JOIN areas a USING (location_id)"""
    q["scan_geojson_split"] = q["geojson_features"]
    q["struct_project"] = f"WITH {zc}\nSELECT location_id AS locationid, borough, zone FROM zones"
    q["explode_array"] = f"""WITH {zc}
SELECT location_id, 0 AS part_no, CASE WHEN location_id % 3 = 0 THEN 2 ELSE 1 END AS num_rings
FROM zones WHERE location_id % 5 <> 0
UNION ALL
SELECT location_id, 1 AS part_no, 1 AS num_rings FROM zones WHERE location_id % 5 <> 0 AND location_id % 4 = 0"""
    q["st_geometry_type"] = f"WITH {zc}\nSELECT location_id, {gtype} AS gtype FROM zones"
    q["st_num_geometries"] = (f"WITH {zc}\nSELECT location_id, CASE WHEN location_id % 4 = 0 THEN 2 ELSE 1 END "
                              f"AS num_geometries FROM zones")
    q["st_geometry_n"] = f"""WITH {zc}
SELECT location_id, CASE WHEN location_id % 4 = 0 THEN 5 END AS num_points,
       CASE WHEN location_id % 4 = 0 THEN 'POLYGON' END AS gtype FROM zones"""
    q["st_coordinates"] = f"""WITH {zc}
SELECT location_id, CAST(row_number() OVER (PARTITION BY location_id ORDER BY kind, seq) - 1 AS INTEGER) AS i,
       y AS lat, x AS lon FROM zone_vtx"""
    q["st_make_point"] = f"""WITH {O.trips_cte()}
SELECT trip_id, CASE WHEN trip_id % 11 = 0 THEN NULL ELSE pickup_longitude END AS x,
       CASE WHEN trip_id % 11 = 0 THEN NULL ELSE pickup_latitude END AS y,
       (trip_id % 11 = 0) AS is_null FROM trips"""
    q["st_point_in_polygon"] = f"""WITH {O.trips_cte()},
{zc}
SELECT t.trip_id, CAST(t.trip_id % 25 AS INTEGER) AS location_id,
       {O.pip_inclusive('t.pickup_longitude', 't.pickup_latitude')} AS inside
FROM trips t JOIN zone_edges e ON e.location_id = t.trip_id % 25
GROUP BY t.trip_id, t.pickup_longitude, t.pickup_latitude"""
    q["st_centroid"] = f"""WITH {zc},
rings AS (
  SELECT location_id, kind, sum(x1 * y2 - x2 * y1) AS a2,
         sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS cx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS cy
  FROM zone_edges GROUP BY location_id, kind
),
tot AS (
  SELECT location_id,
         sum(sign(a2) * CASE WHEN kind = 1 THEN -1 ELSE 1 END * a2) AS a2,
         sum(sign(a2) * CASE WHEN kind = 1 THEN -1 ELSE 1 END * cx) AS cx,
         sum(sign(a2) * CASE WHEN kind = 1 THEN -1 ELSE 1 END * cy) AS cy
  FROM rings GROUP BY location_id
)
SELECT location_id, round(cx / (a2 * 3), 6) AS cx, round(cy / (a2 * 3), 6) AS cy,
       round(a2 / 2 * {O.d(1e4)}, 6) AS area_e4 FROM tot"""
    q["sql_functions"] = f"""WITH {O.trips_cte()},
{zc},
npts AS (SELECT location_id, count(*) AS npoints FROM zone_vtx GROUP BY location_id),
areas AS (
  SELECT location_id, sum(CASE WHEN kind = 1 THEN -1 ELSE 1 END * abs(a2)) / 2 AS area
  FROM (SELECT location_id, kind, sum(x1 * y2 - x2 * y1) AS a2 FROM zone_edges GROUP BY location_id, kind) r
  GROUP BY location_id
),
pip AS (
  SELECT t.trip_id, {O.pip_inclusive('t.pickup_longitude', 't.pickup_latitude')} AS inside
  FROM trips t JOIN zone_edges e ON e.location_id = t.trip_id % 25
  GROUP BY t.trip_id, t.pickup_longitude, t.pickup_latitude
)
SELECT t.trip_id, {O.cell('t.pickup_longitude', 't.pickup_latitude', 12)} AS pickup_cell,
       {O.cell('t.pickup_longitude', 't.pickup_latitude', 7)} AS pickup_r7, 9 AS res,
       {O.encode(11, *O.parent_ab(O.cell_a(O.cell('t.pickup_longitude', 't.pickup_latitude', 12)), O.cell_b(O.cell('t.pickup_longitude', 't.pickup_latitude', 12)), 12))} AS parent_r11, p.inside,
       {gtype.replace('location_id', 'n.location_id')} AS gtype, n.npoints, round(a.area * {O.d(1e4)}, 6) AS area_e4
FROM trips t JOIN pip p USING (trip_id) JOIN npts n ON n.location_id = t.trip_id % 25
JOIN areas a ON a.location_id = n.location_id"""
    return q
