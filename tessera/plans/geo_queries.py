"""Registered queries of the cell / zone pipelines (trip cells, zone fills,
compaction, cell joins, point-in-polygon)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import cells as C
from tessera.functions import geometry as G
from tessera.functions.sqlfuncs import register_sql_functions
from tessera.operators import bucketed as BK
from tessera.operators import polyfill as P
from tessera.operators import tables as TB
from tessera.operators import spatial_join as J
from tessera.operators.sizing import materialise
from tessera.plans.registry import register
from tessera.sources import fixtures as FX

# ---- fixed values: resolutions used by the reference pipelines ------------
RES_TRIPS = 12          # trip and airport cells
RES_TRIPS_FINE = 15     # second trip cell table
RES_ZONE_JOIN = 7       # point-to-zone cell join and density bins
RES_ZONES = 9           # all-zone fill and the exact point-in-polygon cover
# -------------------------------------------------------------------------

TS_FMT = "yyyy-MM-dd HH:mm:ss"


_LOOKUPS: dict[tuple[str, str], object] = {}


def zones_lookup(spark: SparkSession, sf: str):
    """The zone lookup at RES_ZONES, built once per session and input and shared by the
    point-in-polygon queries."""
    name = (spark.sparkContext.applicationId, sf)
    if name not in _LOOKUPS:
        _LOOKUPS[name] = J.zone_lookup(zones_geom(spark, sf), "geom", "location_id", RES_ZONES,
                                       ["borough"], "zone_order")
    return _LOOKUPS[name]


def zones_geom(spark: SparkSession, sf: str) -> DataFrame:
    return FX.zones_fx(spark, sf).withColumn("geom", G.st_geom_from_wkt("the_geom"))


def trips_cells(spark: SparkSession, sf: str, res: int) -> DataFrame:
    """trips_h3 / trips_h3_15: pickup and dropoff cells plus the two measures."""
    t = FX.trips_fx(spark, sf)
    return t.select(
        C.cell_from_lonlat(F.col("pickup_longitude"), F.col("pickup_latitude"), res).alias("pickup_cell"),
        C.cell_from_lonlat(F.col("dropoff_longitude"), F.col("dropoff_latitude"), res).alias("dropoff_cell"),
        "passenger_count", "fare_amount")


def airports_cells(spark: SparkSession, sf: str, res: int = RES_TRIPS) -> DataFrame:
    """airports_h3: (locationid, cell) of the airport polygons' centre fill."""
    a = FX.airports_fx(spark, sf).withColumnRenamed("LocationID", "locationid")
    return P.polyfill_wkt(a, "the_geom", res, "locationid")


@register("trips_cells_r12", oracle="S")
def q_trips_cells_r12(spark, sf):
    return trips_cells(spark, sf, RES_TRIPS)


@register("trips_cells_r15", oracle="S")
def q_trips_cells_r15(spark, sf):
    return trips_cells(spark, sf, RES_TRIPS_FINE)


@register("cell_from_lonlat", oracle="S")
def q_cell_from_lonlat(spark, sf):
    """geoToH3(lat, lng, 7) call shape: the (lat, lon) caller swaps into (lon, lat)."""
    t = FX.trips_fx(spark, sf)
    lat, lon = F.col("pickup_latitude"), F.col("pickup_longitude")
    return t.select("trip_id", C.cell_from_lonlat(lon, lat, RES_ZONE_JOIN).alias("h3index"),
                    C.cell_from_lonlat(lon, lat, 0).alias("cell_r0"))


@register("airport_trips", oracle="S", flagship=True)
def q_airport_trips(spark, sf):
    """Trips between two different airports: count, passengers and fare text (cell joins)."""
    return between_airports(spark, sf, airports_cells(spark, sf))


def between_airports(spark: SparkSession, sf: str, airports: DataFrame) -> DataFrame:
    t = trips_cells(spark, sf, RES_TRIPS)
    # one size-checked dimension joined twice under two aliases: the planner
    # reuses a single broadcast for both sides
    ap = materialise(airports, "airports_h3").for_join()
    src, trg = ap.alias("src"), ap.alias("trg")
    j = (t.join(src, C.cell_key(t.pickup_cell) == F.col("src.cell"))
         .join(trg, C.cell_key(t.dropoff_cell) == F.col("trg.cell"))
         .where(F.col("src.locationid") != F.col("trg.locationid")))
    return j.agg(F.count(F.lit(1)).alias("num_trips"),
                 F.sum("passenger_count").cast("long").alias("num_passengers"),
                 F.concat(F.lit("$"), F.sum("fare_amount").cast("string")).alias("earnings"))


@register("trip_totals", oracle="S")
def q_trip_totals(spark, sf):
    t = trips_cells(spark, sf, RES_TRIPS)
    return t.agg(F.count(F.lit(1)).alias("num_trips"),
                 F.sum("passenger_count").cast("long").alias("num_passengers"),
                 F.sum("fare_amount").alias("fare_total"))


@register("fmt_count", oracle="S")
def q_fmt_count(spark, sf):
    t = trips_cells(spark, sf, RES_TRIPS)
    return t.agg(F.format_number(F.count(F.lit(1)), 0).alias("count"))


@register("money_text", oracle="S")
def q_money_text(spark, sf):
    t = FX.trips_fx(spark, sf)
    return t.groupBy("vendor_id").agg(
        F.concat(F.lit("$"), F.sum("fare_amount").cast("string")).alias("earnings"))


@register("cells_per_zone", oracle="S")
def q_cells_per_zone(spark, sf):
    return airports_cells(spark, sf).groupBy("locationid").agg(
        F.count(F.lit(1)).alias("num_cells")).orderBy("locationid")


@register("cell_compact", oracle="S")
def q_cell_compact(spark, sf):
    return P.compact(airports_cells(spark, sf), RES_TRIPS, "locationid")


@register("cells_per_zone_compacted", oracle="S")
def q_cells_per_zone_compacted(spark, sf):
    c = P.compact(airports_cells(spark, sf), RES_TRIPS, "locationid")
    return c.groupBy("locationid").agg(F.count(F.lit(1)).alias("num_cells")).orderBy("locationid")


def compacted_airports(spark: SparkSession, sf: str):
    """airports_h3_c: the airports' fill as cells of mixed resolutions, written and measured."""
    return materialise(P.compact(airports_cells(spark, sf), RES_TRIPS, "locationid"), "airports_h3_c")


@register("join_compacted_cells", oracle="S")
def q_join_compacted_cells(spark, sf):
    """Pickups joined to the compacted airport cells: the rows of the join to the whole fill."""
    t = FX.trips_fx(spark, sf)
    pts = t.select("trip_id", C.cell_from_lonlat(F.col("pickup_longitude"), F.col("pickup_latitude"), RES_TRIPS).alias("pickup_cell"))
    j = J.ancestor_join(pts, "pickup_cell", RES_TRIPS, compacted_airports(spark, sf))
    return j.select("trip_id", "pickup_cell", "locationid")


@register("airport_trips_compacted", oracle="S")
def q_airport_trips_compacted(spark, sf):
    """airport_trips over the compacted cells: ancestors of both trip ends, nothing expanded."""
    ap = compacted_airports(spark, sf)
    t = trips_cells(spark, sf, RES_TRIPS)
    src = J.ancestor_join(t, "pickup_cell", RES_TRIPS, ap).withColumnRenamed("locationid", "src_location").drop("cell")
    j = J.ancestor_join(src, "dropoff_cell", RES_TRIPS, ap).where(F.col("src_location") != F.col("locationid"))
    return j.agg(F.count(F.lit(1)).alias("num_trips"), F.sum("passenger_count").cast("long").alias("num_passengers"),
                 F.concat(F.lit("$"), F.sum("fare_amount").cast("string")).alias("earnings"))


@register("cell_uncompact", oracle="S")
def q_cell_uncompact(spark, sf):
    """uncompact(compact(fill)) must give the fill back."""
    m = materialise(P.compact(airports_cells(spark, sf), RES_TRIPS, "locationid"), "airports_h3_c", measure=False)
    return P.uncompact(m.df, RES_TRIPS, "locationid")


def _sql_cells(spark: SparkSession, source: DataFrame, select: str) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS ... AS ``select`` over the view {src}, with the SQL table functions."""
    register_sql_functions(spark)
    view, table = (f"{kind}_{uuid.uuid4().hex[:10]}" for kind in ("src", "cells_h3"))
    source.createOrReplaceTempView(view)
    out = TB.ctas_if_absent(spark, table, select.format(src=view))
    back = materialise(out, "sql_cells", measure=False).df
    TB.drop_if_exists(spark, table)
    spark.catalog.dropTempView(view)
    return back


def _spread_airports(spark: SparkSession, sf: str) -> DataFrame:
    """One airport's arrays are built by one task: keep the airports apart."""
    return FX.airports_fx(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "LocationID")


@register("sql_zones_cells", oracle="S")
def q_sql_zones_cells(spark, sf):
    """taxi_zone_explode_h3 as one SQL statement: fills in pieces, nothing shuffled."""
    return _sql_cells(spark, FX.zones_fx(spark, sf), f"""
        SELECT location_id AS locationid, borough, zone, c.cell
        FROM {{src}}, LATERAL cell_polyfill_spans(the_geom, {RES_ZONES}) s, LATERAL cell_range(s.b, s.a0, s.a1, {RES_ZONES}) c""")


@register("sql_airports_cells", oracle="S")
def q_sql_airports_cells(spark, sf):
    """airports_h3 as one SQL statement."""
    return _sql_cells(spark, _spread_airports(spark, sf), f"""
        SELECT LocationID AS locationid, c.cell FROM {{src}}, LATERAL cell_polyfill(the_geom, {RES_TRIPS}) c""")


@register("sql_airports_cells_compacted", oracle="S")
def q_sql_airports_cells_compacted(spark, sf):
    """airports_h3_c as one SQL statement: the compacted array of the filled array."""
    return _sql_cells(spark, _spread_airports(spark, sf), f"""
        SELECT a.locationid, c.cell
        FROM (SELECT LocationID AS locationid, cell_polyfill_array(the_geom, {RES_TRIPS}) AS cells FROM {{src}}) a,
             LATERAL cell_compact(a.cells) c""")


@register("cell_parent", oracle="S")
def q_cell_parent(spark, sf):
    t = trips_cells(spark, sf, RES_TRIPS)
    c = F.col("pickup_cell")
    return t.select(c.alias("cell"), C.cell_parent(c, RES_TRIPS, RES_ZONES).alias("parent_r9"),
                    C.cell_parent(c, RES_TRIPS, RES_ZONE_JOIN).alias("parent_r7")).distinct()


@register("zones_cells", oracle="S")
def q_zones_cells(spark, sf):
    """taxi_zone_explode_h3: every zone's attributes with its centre-fill cells."""
    z = zones_geom(spark, sf)
    cells = P.polyfill(z, "geom", RES_ZONES, "location_id")
    attrs = z.select(F.col("location_id"), "borough", "zone")
    return cells.join(attrs, "location_id").select(
        F.col("location_id").alias("locationid"), "borough", "zone", "cell")


@register("polyfill_polygon", oracle="S")
def q_polyfill_polygon(spark, sf):
    """Polygon-only fill: MultiPolygon rows give no cells (type guard)."""
    z = zones_geom(spark, sf).where(G.st_geometry_type("geom") == "POLYGON")
    return P.polyfill(z, "geom", RES_ZONE_JOIN, "location_id")


@register("polyfill_multipolygon", oracle="S")
def q_polyfill_multipolygon(spark, sf):
    """MultiPolygon-only fill of all parts."""
    z = zones_geom(spark, sf).where(G.st_geometry_type("geom") == "MULTIPOLYGON")
    return P.polyfill(z, "geom", RES_ZONE_JOIN, "location_id")


@register("polyfill_first_part", oracle="S")
def q_polyfill_first_part(spark, sf):
    """MultiPolygon-only fill of the first part (the part handling of the reference's first
    notebook)."""
    z = zones_geom(spark, sf).where(G.st_geometry_type("geom") == "MULTIPOLYGON")
    return P.polyfill(z, "geom", RES_ZONE_JOIN, "location_id", first_part_only=True)


@register("zones_cells_r12", oracle="S")
def q_zones_cells_r12(spark, sf):
    """The fill of every zone at the trip resolution: count and checksum of the cells."""
    cells = P.polyfill(zones_geom(spark, sf), "geom", RES_TRIPS, "location_id")
    return cells.groupBy(F.col("location_id").alias("locationid")).agg(
        F.count(F.lit(1)).alias("num_cells"), F.min("cell").alias("first_cell"), F.max("cell").alias("last_cell"),
        F.sum(F.col("cell") % 1000003).alias("checksum"))


@register("refined_cell_join", oracle="S")
def q_refined_cell_join(spark, sf):
    """The resolution-7 cell join with refinement: exact, as pip_join."""
    t = FX.trips_fx(spark, sf).select("trip_id", "pickup_longitude", "pickup_latitude")
    return J.refined_cell_join(t, "pickup_longitude", "pickup_latitude", zones_geom(spark, sf), "geom", "location_id",
                               RES_ZONE_JOIN).select("trip_id", "location_id")


@register("join_cell_zone", oracle="S")
def q_join_cell_zone(spark, sf):
    """Pickups joined to zones through resolution-7 cells (approximate join)."""
    t = FX.trips_fx(spark, sf)
    pts = t.select("trip_id", "pickup_longitude", "pickup_latitude",
                   F.col("pickup_datetime").cast("string").alias("pickup_datetime"),
                   C.cell_key(C.cell_from_lonlat(F.col("pickup_longitude"), F.col("pickup_latitude"),
                                                 RES_ZONE_JOIN)).alias("h3index"))
    z = zones_geom(spark, sf)
    zc = P.polyfill(z, "geom", RES_ZONE_JOIN, "location_id", cell_col="h3index") \
        .join(z.select("location_id", "zone", "borough"), "location_id")
    j = J.cell_join(pts, "h3index", zc, "h3index")
    return j.select("zone", "borough", "trip_id", "pickup_longitude", "pickup_latitude",
                    "pickup_datetime", "h3index")


@register("join_bucketed_cells", oracle="S")
def q_join_bucketed_cells(spark, sf):
    """join_cell_zone over stored buckets of the cell: no exchange in the join."""
    pts = FX.trips_fx(spark, sf).select(
        "trip_id", "pickup_longitude", "pickup_latitude", F.col("pickup_datetime").cast("string").alias("pickup_datetime"),
        C.cell_from_lonlat(F.col("pickup_longitude"), F.col("pickup_latitude"), RES_ZONE_JOIN).alias("h3index"))
    z = zones_geom(spark, sf)
    cells = P.polyfill(z, "geom", RES_ZONE_JOIN, "location_id").join(z.select("location_id", "zone", "borough"), "location_id")
    trips, zones = (f"{kind}_{uuid.uuid4().hex[:10]}" for kind in ("trips_b", "zones_b"))
    BK.save_points(pts, "h3index", trips, int(spark.conf.get("spark.sql.shuffle.partitions")))
    BK.save_cells(cells, "cell", zones, trips)
    out = materialise(BK.bucketed_cell_join(spark, trips, zones), "bucket_join", measure=False).df
    BK.drop_points(spark, trips)
    TB.drop_if_exists(spark, zones)
    return out.select("zone", "borough", "trip_id", "pickup_longitude", "pickup_latitude", "pickup_datetime",
                      F.col("cell").alias("h3index"))


@register("cell_density", oracle="S")
def q_cell_density(spark, sf):
    t = FX.trips_fx(spark, sf)
    c = C.cell_from_lonlat(F.col("dropoff_longitude"), F.col("dropoff_latitude"), RES_ZONE_JOIN)
    return t.groupBy(c.alias("cell")).agg(F.count(F.lit(1)).alias("num_dropoffs"))


@register("pip_join", oracle="S")
def q_pip_join(spark, sf):
    t = FX.trips_fx(spark, sf).select("trip_id", "pickup_longitude", "pickup_latitude")
    z = zones_geom(spark, sf)
    out = J.pip_join(t, "pickup_longitude", "pickup_latitude", z, "geom", "location_id", RES_ZONES,
                     lookup=zones_lookup(spark, sf))
    return out.select("trip_id", "location_id")


@register("pip_first_match", oracle="S")
def q_pip_first_match(spark, sf):
    """find_borough(lat, lng) over every trip: first zone by order, null if none."""
    t = FX.trips_fx(spark, sf).select(
        "trip_id", F.col("pickup_datetime").cast("string").alias("pickup_datetime"),
        "pickup_latitude", "pickup_longitude")
    z = zones_geom(spark, sf)
    return J.pip_first_match(t, "trip_id", "pickup_longitude", "pickup_latitude", z, "geom",
                             "location_id", "zone_order", "borough", "pickup_borough", RES_ZONES,
                             lookup=zones_lookup(spark, sf))
