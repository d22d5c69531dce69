"""Registered queries of the raster notebook: pixels -> tiles, band alignment,
NDVI, tile sums and filter, footprints, CRS and reprojected centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions import projections as PJ
from tessera.operators import raster as RS
from tessera.plans import oracle_parts as O
from tessera.plans.registry import register
from tessera.session import scratch_dir
from tessera.sources import fixtures as FX

# ---- fixed values: the tile-sum threshold for the 8x8 fixture tiles ----------
NDVI_SUM_THRESHOLD = 12.0
# -------------------------------------------------------------------------------

N = FX.TILE_COLS * FX.TILE_ROWS


def _band_tiles(spark, sf, band: str, out: str):
    return RS.tiles_from_pixels(FX.pixels_fx(spark, sf), band, out, FX.TILE_COLS, FX.TILE_ROWS)


def _scene(spark, sf):
    """spark.read.raster(...) shape: red and NIR tiles with extent and CRS.  Both
    bands of the fixture come from the same pixel rows, so they are tiled in one
    aggregation (band_align_join shows the join of separately read bands)."""
    return RS.tiles_from_band_pixels(FX.pixels_fx(spark, sf), {"red": "red", "NIR": "nir"},
                                     FX.TILE_COLS, FX.TILE_ROWS)


def _weighted(col: str):
    """Order-sensitive checksum of a tile: sum(pos * value) over non-null cells."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(N - 1)), F.lit(0.0),
                       lambda acc, i: acc + F.coalesce(F.col(col)[i], F.lit(0.0)) * i.cast("double"))


@register("tiles_from_pixels", oracle="S")
def q_tiles_from_pixels(spark, sf):
    t = _band_tiles(spark, sf, "red", "red")
    return t.select(*RS.TILE_KEY, RS.tile_count("red").alias("num_cells"),
                    F.round(RS.tile_sum("red"), 6).alias("red_sum"),
                    F.round(_weighted("red"), 6).alias("red_wsum"))


@register("band_align_join", oracle="S")
def q_band_align_join(spark, sf):
    """Bands tiled separately, then aligned tile by tile with an equi-join."""
    s = RS.align_bands(_band_tiles(spark, sf, "red", "red"), _band_tiles(spark, sf, "nir", "NIR"))
    return s.select(*RS.TILE_KEY, F.round(RS.tile_sum("red"), 6).alias("red_sum"),
                    F.round(RS.tile_sum("NIR"), 6).alias("nir_sum"),
                    RS.tile_count("NIR").alias("nir_cells"))


@register("ndvi", oracle="S")
def q_ndvi(spark, sf):
    s = _scene(spark, sf).withColumn("NDVI", RS.normalized_difference("NIR", "red"))
    return s.select(*RS.TILE_KEY, RS.tile_count("NDVI").alias("ndvi_cells"),
                    F.round(_weighted("NDVI"), 6).alias("ndvi_wsum"))


@register("tile_sum", oracle="S")
def q_tile_sum(spark, sf):
    s = _scene(spark, sf).withColumn("NDVI", RS.normalized_difference("NIR", "red"))
    return s.select(*RS.TILE_KEY, F.round(RS.tile_sum("NDVI"), 6).alias("ndvi_sum"))


@register("filter_tile_sum", oracle="S")
def q_filter_tile_sum(spark, sf):
    s = _scene(spark, sf).withColumn("NDVI", RS.normalized_difference("NIR", "red"))
    return s.where(RS.tile_sum("NDVI") > NDVI_SUM_THRESHOLD).select(*RS.TILE_KEY)


@register("rf_geometry", oracle="S")
def q_rf_geometry(spark, sf):
    s = _scene(spark, sf).withColumn("footprint", RS.tile_geometry())
    bb = G.st_bbox("footprint")
    return s.select(*RS.TILE_KEY, bb["xmin"].alias("xmin"), bb["ymin"].alias("ymin"),
                    bb["xmax"].alias("xmax"), bb["ymax"].alias("ymax"),
                    F.round(G.st_area("footprint"), 3).alias("area"))


@register("rf_crs", oracle="S")
def q_rf_crs(spark, sf):
    return _scene(spark, sf).select(*RS.TILE_KEY, RS.tile_crs().alias("crs"))


@register("rf_tile", oracle="S")
def q_rf_tile(spark, sf):
    s = _scene(spark, sf)
    return s.select(*RS.TILE_KEY, F.size("red").alias("cells"),
                    F.size(F.filter("NIR", lambda v: v.isNull())).alias("nir_nodata"))


@register("st_reproject", oracle="S")
def q_st_reproject(spark, sf):
    """Tile centroids from UTM zone 18N to lon/lat."""
    s = _scene(spark, sf)
    ll = RS.tile_centre_lonlat()
    return s.select(*RS.TILE_KEY, F.round(ll["x"], 7).alias("lon"), F.round(ll["y"], 7).alias("lat"))


# ---- fixed values: projected systems that hold the trips, by trip id -----------
TRIP_CRS = (2263, 32118, 3347, 3174, 5070, 3413)
# ---------------------------------------------------------------------------------


@register("st_reproject_conic", oracle="S")
def q_st_reproject_conic(spark, sf):
    """Pickups kept in conic and polar systems, several in one column, back to lon/lat."""
    t = FX.trips_fx(spark, sf)
    code = F.get(F.array(*map(F.lit, TRIP_CRS)), (F.col("trip_id") % len(TRIP_CRS)).cast("int"))
    kept = t.select("trip_id", code.alias("code"), PJ.conic_xy(F.col("pickup_longitude"), F.col("pickup_latitude"), code).alias("at"))
    back = G.st_reproject_xy(F.col("at.x"), F.col("at.y"), F.concat(F.lit("EPSG:"), F.col("code").cast("string")))
    return kept.withColumn("p", back).select("trip_id", "code", F.round("p.x", 6).alias("lon"), F.round("p.y", 6).alias("lat"))


@register("vegetated_tiles", oracle="S", flagship=False)
def q_vegetated_tiles(spark, sf):
    """Read bands, rename, centroid lon/lat, NDVI, filter on the tile sum, project."""
    s = (_scene(spark, sf)
         .withColumn("longitude_latitude", RS.tile_centre_lonlat())
         .withColumn("NDVI", RS.normalized_difference("NIR", "red"))
         .where(RS.tile_sum("NDVI") > NDVI_SUM_THRESHOLD))
    return s.select(*RS.TILE_KEY,
                    F.round(F.col("longitude_latitude.x"), 7).alias("lon"),
                    F.round(F.col("longitude_latitude.y"), 7).alias("lat"),
                    F.round(RS.tile_sum("red"), 6).alias("red_sum"),
                    F.round(RS.tile_sum("NIR"), 6).alias("nir_sum"),
                    F.round(RS.tile_sum("NDVI"), 6).alias("ndvi_sum"))


@register("scan_raster_catalog", oracle="S")
def q_scan_raster_catalog(spark, sf):
    """Band catalog CSV (header scene,B4,B5; a row of pixel-table paths for each of two
    scenes: even and odd tile rows) -> tiles under the scene names of the catalog."""
    px = FX.pixels_fx(spark, sf)
    rows = []
    for scene, parity in (("even", 0), ("odd", 1)):
        row = [scene]
        for band, col in (("B4", "red"), ("B5", "nir")):
            p = scratch_dir(spark, f"band_{band}")
            (px.where(F.col("tile_row") % 2 == parity).select(*RS.TILE_KEY, "pos", *RS.EXTENT, F.col(col).alias("value"))
             .write.parquet(p))
            row.append(p)
        rows.append(tuple(row))
    cat = scratch_dir(spark, "catalog")
    spark.createDataFrame(rows, "scene string, B4 string, B5 string").write.option("header", "true").csv(cat)
    rf = RS.read_raster_catalog(spark, cat, ["B4", "B5"], FX.TILE_COLS, FX.TILE_ROWS) \
        .withColumnRenamed("B4", "red").withColumnRenamed("B5", "NIR")
    return rf.select(*RS.TILE_KEY, F.round(RS.tile_sum("red"), 6).alias("red_sum"),
                     F.round(RS.tile_sum("NIR"), 6).alias("nir_sum"),
                     RS.tile_count("NIR").alias("nir_cells"))


# ---- oracle SQL -----------------------------------------------------------------

def _pixels_cte() -> str:
    return f"""px AS (
  SELECT o_orderkey // {N} AS tile, CAST(o_orderkey % {N} AS INTEGER) AS pos, o_orderkey AS k,
         CASE WHEN o_orderkey % {FX.DARK_MODULUS} = 0 THEN 0.0::DOUBLE
              ELSE CAST({FX.RED[0]} + o_orderkey * {FX.RED[1]} % {FX.RED[2]} AS DOUBLE) END AS red
  FROM orders
),
pn AS (
  SELECT *, CASE WHEN k % {FX.NODATA_MODULUS} = 0 THEN NULL WHEN k % {FX.DARK_MODULUS} = 0 THEN 0.0::DOUBLE
                 ELSE red + CAST(tile * {FX.NIR[0]} % {FX.NIR[1]} + ({FX.NIR[2]}) AS DOUBLE) END AS nir FROM px
),
pix AS (
  SELECT '{FX.SCENE}' AS scene, CAST(tile % {FX.TILE_GRID_COLS} AS INTEGER) AS tile_col,
         CAST(tile // {FX.TILE_GRID_COLS} AS INTEGER) AS tile_row, pos, red, nir,
         CASE WHEN nir + red = 0 THEN NULL ELSE (nir - red) / (nir + red) END AS ndvi
  FROM pn
),
tiles AS (
  SELECT scene, tile_col, tile_row,
         count(red) AS red_cells, sum(red) AS red_sum, sum(red * pos) AS red_wsum,
         count(nir) AS nir_cells, coalesce(sum(nir), 0) AS nir_sum,
         count(ndvi) AS ndvi_cells, coalesce(sum(ndvi), 0) AS ndvi_sum, coalesce(sum(ndvi * pos), 0) AS ndvi_wsum,
         count(*) AS n
  FROM pix GROUP BY scene, tile_col, tile_row
)"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    w = f"WITH {_pixels_cte()}\n"
    key = "scene, tile_col, tile_row"
    q["tiles_from_pixels"] = w + f"SELECT {key}, CAST(red_cells AS INTEGER) AS num_cells, round(red_sum, 6) AS red_sum, round(red_wsum, 6) AS red_wsum FROM tiles"
    q["band_align_join"] = w + f"SELECT {key}, round(red_sum, 6) AS red_sum, round(nir_sum, 6) AS nir_sum, CAST(nir_cells AS INTEGER) AS nir_cells FROM tiles"
    q["scan_raster_catalog"] = w + ("SELECT CASE WHEN tile_row % 2 = 0 THEN 'even' ELSE 'odd' END AS scene, tile_col, tile_row, "
                                    "round(red_sum, 6) AS red_sum, round(nir_sum, 6) AS nir_sum, CAST(nir_cells AS INTEGER) AS nir_cells FROM tiles")
    q["ndvi"] = w + f"SELECT {key}, CAST(ndvi_cells AS INTEGER) AS ndvi_cells, round(ndvi_wsum, 6) AS ndvi_wsum FROM tiles"
    q["tile_sum"] = w + f"SELECT {key}, round(ndvi_sum, 6) AS ndvi_sum FROM tiles"
    q["filter_tile_sum"] = w + f"SELECT {key} FROM tiles WHERE ndvi_sum > {O.d(NDVI_SUM_THRESHOLD)}"
    ext = f"""ext AS (
  SELECT {key}, {O.d(FX.TILE_X0)} + CAST(tile_col AS DOUBLE) * {O.d(FX.TILE_SIZE_M)} AS xmin,
         {O.d(FX.TILE_Y0)} + CAST(tile_row AS DOUBLE) * {O.d(FX.TILE_SIZE_M)} AS ymin
  FROM tiles
)"""
    q["rf_geometry"] = w + f""", {ext}
SELECT {key}, xmin, ymin, xmin + {O.d(FX.TILE_SIZE_M)} AS xmax, ymin + {O.d(FX.TILE_SIZE_M)} AS ymax,
       round({O.d(FX.TILE_SIZE_M)} * {O.d(FX.TILE_SIZE_M)}, 3) AS area FROM ext"""
    q["rf_crs"] = w + f"SELECT {key}, '{FX.TILE_CRS}' AS crs FROM tiles"
    q["rf_tile"] = w + f"SELECT {key}, {N} AS cells, CAST({N} - nir_cells AS INTEGER) AS nir_nodata FROM tiles"
    zone = int(FX.TILE_CRS.split(":")[1]) - 32600
    cx = f"(xmin + {O.d(FX.TILE_SIZE_M / 2)})"
    cy = f"(ymin + {O.d(FX.TILE_SIZE_M / 2)})"
    lon, lat = O.utm_inverse(cx, cy, zone)
    q["st_reproject"] = w + f""", {ext}
SELECT {key}, round({lon}, 7) AS lon, round({lat}, 7) AS lat FROM ext"""
    codes = f"[{', '.join(map(str, TRIP_CRS))}]"
    q["st_reproject_conic"] = f"""WITH {O.trips_cte()}
SELECT trip_id, {codes}[CAST(trip_id % {len(TRIP_CRS)} AS INT) + 1] AS code, round(pickup_longitude, 6) AS lon,
       round(pickup_latitude, 6) AS lat FROM trips"""
    q["vegetated_tiles"] = w + f""", {ext}
SELECT e.scene, e.tile_col, e.tile_row, round({lon}, 7) AS lon, round({lat}, 7) AS lat,
       round(t.red_sum, 6) AS red_sum, round(t.nir_sum, 6) AS nir_sum, round(t.ndvi_sum, 6) AS ndvi_sum
FROM ext e JOIN tiles t USING ({key}) WHERE t.ndvi_sum > {O.d(NDVI_SUM_THRESHOLD)}"""
    return q
