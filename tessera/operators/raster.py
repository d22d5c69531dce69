"""Raster tiles as rows: one row per (scene, tile) with one array column per band.

Pixels -> tiles is a group-by on the tile key (groups bounded by the tile size);
bands of one scene are aligned with an equi-join on (scene, tile_col, tile_row);
per-cell maths (NDVI) are ``zip_with`` over the band arrays and per-tile
aggregates are ``aggregate``, so everything stays in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry as G

TILE_KEY = ["scene", "tile_col", "tile_row"]
EXTENT = ["xmin", "ymin", "xmax", "ymax", "crs", "cols", "rows"]


def tiles_from_pixels(pixels: DataFrame, value_col: str, out_col: str, cols: int, rows: int) -> DataFrame:
    """Pixels (scene, tile_col, tile_row, pos, value, extent...) -> one row per tile
    with a row-major ``array<double>`` of ``cols*rows`` cells (missing -> null)."""
    g = pixels.groupBy(*TILE_KEY, *EXTENT).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("pos"), F.col(value_col).cast("double"))))
        .alias("__m"))
    cells = F.transform(F.sequence(F.lit(0), F.lit(cols * rows - 1)), lambda i: F.col("__m")[i])
    return g.select(*TILE_KEY, *EXTENT, cells.alias(out_col))


def tiles_from_band_pixels(pixels: DataFrame, bands: dict[str, str], cols: int, rows: int) -> DataFrame:
    """Like ``tiles_from_pixels`` for several value columns of the same pixels
    (``{output tile column: pixel value column}``): one aggregation, no band join."""
    vals = F.struct(*[F.col(v).cast("double").alias(out) for out, v in bands.items()])
    g = pixels.groupBy(*TILE_KEY, *EXTENT).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("pos"), vals))).alias("__m"))
    seq = F.sequence(F.lit(0), F.lit(cols * rows - 1))

    def band(out):
        return F.transform(seq, lambda i: F.col("__m")[i][out]).alias(out)

    return g.select(*TILE_KEY, *EXTENT, *[band(out) for out in bands])


def align_bands(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tile-by-tile join of two bands of the same scenes."""
    r = right.drop(*EXTENT)
    return left.join(r, TILE_KEY)


def normalized_difference(a, b) -> Column:
    """(a - b) / (a + b) per cell in double; 0/0 and nulls give null (NoData)."""
    a = a if isinstance(a, Column) else F.col(a)
    b = b if isinstance(b, Column) else F.col(b)
    return F.zip_with(a, b, lambda x, y: F.try_divide(x - y, x + y))


def tile_sum(tile) -> Column:
    """Sum of the non-NoData cells of a tile."""
    t = tile if isinstance(tile, Column) else F.col(tile)
    return F.aggregate(F.filter(t, lambda v: v.isNotNull()), F.lit(0.0), lambda acc, v: acc + v)


def tile_count(tile) -> Column:
    t = tile if isinstance(tile, Column) else F.col(tile)
    return F.size(F.filter(t, lambda v: v.isNotNull()))


def tile_geometry() -> Column:
    """Footprint polygon of a tile from its extent columns (rf_geometry)."""
    x0, y0, x1, y1 = F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    return G.geometry(F.lit(G.WKT_POLYGON), F.array(F.array(ring)))


def tile_crs() -> Column:
    return F.col("crs")


def tile_centre_lonlat() -> Column:
    """Centroid of the (rectangular) footprint reprojected to EPSG:4326 (x=lon, y=lat).

    The centroid of an axis-aligned extent is its midpoint; computing it that way
    avoids the cancellation of the shoelace formula on large projected numbers."""
    cx = (F.col("xmin") + F.col("xmax")) / 2.0
    cy = (F.col("ymin") + F.col("ymax")) / 2.0
    return G.st_reproject_xy(cx, cy, F.col("crs"))


def unknown_crs(tiles: DataFrame) -> DataFrame:
    """crs, num_tiles of the tiles that cannot be reprojected (their centres are null)."""
    return (tiles.where(~G.crs_supported("crs")).groupBy("crs").agg(F.count(F.lit(1)).alias("num_tiles")))


def read_raster_catalog(spark: SparkSession, catalog: str | DataFrame, bands: list[str],
                        cols: int, rows: int) -> DataFrame:
    """Catalog (CSV path or DataFrame: one column of pixel-table folders per band, one row per
    scene) -> one row per tile with one array column per band.

    The scene of a tile is its catalog row: the row's ``scene`` if the catalog has such a
    column, else the folder of its first band.  The catalog is metadata - the folders it
    lists are the arguments of one read per band - so it is read on the driver; the pixel
    tables are read and tiled by executors.
    """
    if isinstance(catalog, str):
        catalog = spark.read.option("header", "true").csv(catalog)
    named = F.col("scene") if "scene" in catalog.columns else F.col(bands[0])
    cat = catalog.select(named.cast("string").alias("scene"), *bands).collect()
    folder = F.regexp_replace(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1), "^[a-z0-9]+:/+", "/")
    out = None
    for band in bands:
        where = spark.createDataFrame([(re.sub("^[a-z0-9]+:/+", "/", r[band]).rstrip("/"), r["scene"]) for r in cat],
                                      "__folder string, scene string")
        pix = (spark.read.parquet(*[r[band] for r in cat]).drop("scene").withColumn("__folder", folder)
               .join(F.broadcast(where), "__folder").drop("__folder"))     # one row per catalog row
        t = tiles_from_pixels(pix, "value", band, cols, rows)
        out = t if out is None else align_bands(out, t)
    return out
