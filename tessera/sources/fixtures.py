"""Trip, zone, building, tile and sample tables derived from the driver's tables.

Every table is computed by Spark from the parquet inputs (``orders``, ``nation``,
``region``, ``part``, ``lineitem``, ``embeddings``), so its size follows the
scale factor of the input.  Formulas are those of FIXTURES.md; the DuckDB
oracle in ``tessera.plans.oracle`` derives the same rows independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table_path

# ---- fixed values: fixture geometry (integer units of 1e-5 degree) -------
ZONE_X0 = -7425005          # X = ZONE_X0 + ZONE_DX * (z % 5)
ZONE_Y0 = 4050005           # Y = ZONE_Y0 + ZONE_DY * floor(z / 5)
ZONE_DX = 10000
ZONE_DY = 8000
ZONE_OUTER = [(0, 0), (10000, 0), (10000, 4000), (6000, 4000), (6000, 8000), (0, 8000), (0, 0)]
ZONE_HOLE = [(1000, 1000), (2000, 1000), (2000, 2000), (1000, 2000), (1000, 1000)]   # z % 3 == 0
ZONE_PART2 = [(7000, 5000), (9000, 5000), (9000, 7000), (7000, 7000), (7000, 5000)]  # z % 4 == 0
AIRPORT_ZONES = (6, 18, 8)          # zone 8 has two parts
# trip coordinates: base + ((k * mult) % modulus) / 10000
PICKUP_LON = (-74.25, 7919, 4999)
PICKUP_LAT = (40.5, 104729, 3989)
DROPOFF_LON = (-74.25, 15485863, 4999)
DROPOFF_LAT = (40.5, 32452843, 3989)
AIRPORT_A = ((-74.15, 31, 997), (40.58, 37, 797))
AIRPORT_B = ((-73.95, 41, 997), (40.74, 43, 797))
# -------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _coord(k: Column, spec) -> Column:
    base, mult, mod = spec
    return F.lit(base) + (k * mult % mod).cast("double") / F.lit(10000.0)


def trips_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trip table (one row per order)."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    to_b = (k % 8 == 0) & (k % 16 != 0)   # B -> A
    to_a = (k % 16 == 0)                  # A -> B
    a_lon, a_lat = _coord(k, AIRPORT_A[0]), _coord(k, AIRPORT_A[1])
    b_lon, b_lat = _coord(k, AIRPORT_B[0]), _coord(k, AIRPORT_B[1])
    # o_orderdate is a wall-clock timestamp (TIMESTAMP_NTZ): keep it so, so the
    # trip times do not depend on the session time zone
    pickup = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (k * 37 % 1440).cast("int"))
    return o.select(
        k.alias("trip_id"),
        (F.lit(1) + k % 2).cast("string").alias("vendor_id"),
        pickup.alias("pickup_datetime"),
        (pickup + F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(1) + k * 13 % 60).cast("int")))
        .alias("dropoff_datetime"),
        F.when(to_a, a_lon).when(to_b, b_lon).otherwise(_coord(k, PICKUP_LON)).alias("pickup_longitude"),
        F.when(to_a, a_lat).when(to_b, b_lat).otherwise(_coord(k, PICKUP_LAT)).alias("pickup_latitude"),
        F.when(to_a, b_lon).when(to_b, a_lon).otherwise(_coord(k, DROPOFF_LON)).alias("dropoff_longitude"),
        F.when(to_a, b_lat).when(to_b, a_lat).otherwise(_coord(k, DROPOFF_LAT)).alias("dropoff_latitude"),
        (F.lit(1) + k % 6).cast("int").alias("passenger_count"),
        (F.lit(2.5) + (k % 160).cast("double") * F.lit(0.25)).alias("fare_amount"),
    )


def _ring_wkt(z: Column, ring) -> Column:
    x0 = F.lit(ZONE_X0) + F.lit(ZONE_DX) * (z % 5)
    y0 = F.lit(ZONE_Y0) + F.lit(ZONE_DY) * F.floor(z / 5)
    pts = [F.concat(((x0 + dx) / F.lit(1e5)).cast("string"), F.lit(" "),
                    ((y0 + dy) / F.lit(1e5)).cast("string")) for dx, dy in ring]
    return F.concat(F.lit("("), F.concat_ws(", ", *pts), F.lit(")"))


def zone_wkt(z: Column) -> Column:
    """WKT of fixture zone z: an L-shape, a hole when z%3=0, a second part when z%4=0."""
    outer = _ring_wkt(z, ZONE_OUTER)
    hole = _ring_wkt(z, ZONE_HOLE)
    part1 = F.when(z % 3 == 0, F.concat(F.lit("("), outer, F.lit(", "), hole, F.lit(")"))) \
        .otherwise(F.concat(F.lit("("), outer, F.lit(")")))
    part2 = F.concat(F.lit("("), _ring_wkt(z, ZONE_PART2), F.lit(")"))
    return F.when(z % 4 == 0, F.concat(F.lit("MULTIPOLYGON ("), part1, F.lit(", "), part2, F.lit(")"))) \
        .otherwise(F.concat(F.lit("POLYGON "), part1))


def zones_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone table with WKT text: location_id, zone, borough, zone_order, the_geom."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    z = F.col("n_nationkey")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(z.cast("int").alias("location_id"), F.col("n_name").alias("zone"),
                    F.col("r_name").alias("borough"), z.cast("int").alias("zone_order"),
                    zone_wkt(z).alias("the_geom")))


def airports_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport zones as in the reference: OBJECTID, the_geom, zone, LocationID, borough."""
    zs = zones_fx(spark, sf_dir).where(F.col("location_id").isin(*AIRPORT_ZONES))
    return zs.select(F.col("location_id").alias("OBJECTID"), "the_geom", "zone",
                     F.col("location_id").alias("LocationID"), "borough")


# ---- raw CSV-shaped trips (all strings, reference headers) ---------------

# ---- fixed values: raw header names of the two cab files ------------------
GREEN_RAW_HEADER = [
    "VendorID", "lpep_pickup_datetime", "Lpep_dropoff_datetime", "Store_and_fwd_flag",
    "RateCodeID", "Pickup_longitude", "Pickup_latitude", "Dropoff_longitude",
    "Dropoff_latitude", "Passenger_count", "Trip_distance", "Fare_amount", "Extra",
    "MTA_tax", "Tip_amount", "Tolls_amount", "Ehail_fee", "Total_amount", "Payment_type",
    "Trip_type ",
]
YELLOW_RAW_HEADER = [
    "vendor_name", "Trip_Pickup_DateTime", "Trip_Dropoff_DateTime", "Passenger_Count",
    "Trip_Distance", "Start_Lon", "Start_Lat", "Rate_Code", "store_and_forward", "End_Lon",
    "End_Lat", "Payment_Type", "Fare_Amt", "surcharge", "mta_tax", "Tip_Amt", "Tolls_Amt",
    "Total_Amt",
]
YELLOW_2015_RAW_HEADER = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_longitude", "pickup_latitude", "RateCodeID", "store_and_fwd_flag", "dropoff_longitude",
    "dropoff_latitude", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount",
]
# -------------------------------------------------------------------------


def _raw_values(t: DataFrame) -> DataFrame:
    """Shared text columns of the raw files, with the fixture's bad values."""
    k = F.col("trip_id")
    pax = (F.when(k % 97 == 0, F.lit("x")).when(k % 101 == 0, F.lit(""))
           .otherwise(F.col("passenger_count").cast("string")))
    pick = F.when(k % 103 == 0, F.lit("bad")).otherwise(F.col("pickup_datetime").cast("string"))
    fare = F.col("fare_amount")
    return t.select(
        k, F.col("vendor_id").alias("v_vendor"), pick.alias("v_pick"),
        F.col("dropoff_datetime").cast("string").alias("v_drop"),
        F.when(k % 5 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("v_flag"),
        (F.lit(1) + k % 3).cast("string").alias("v_rate"),
        F.col("pickup_longitude").cast("string").alias("v_plon"),
        F.col("pickup_latitude").cast("string").alias("v_plat"),
        F.col("dropoff_longitude").cast("string").alias("v_dlon"),
        F.col("dropoff_latitude").cast("string").alias("v_dlat"),
        pax.alias("v_pax"),
        ((k % 50).cast("double") / F.lit(4.0)).cast("string").alias("v_dist"),
        fare.cast("string").alias("v_fare"),
        ((k % 3).cast("double") * F.lit(0.5)).cast("string").alias("v_extra"),
        F.lit("0.5").alias("v_mta"),
        ((k % 7).cast("double") * F.lit(0.25)).cast("string").alias("v_tip"),
        F.lit("0.0").alias("v_tolls"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("1.25")).alias("v_ehail"),
        (fare + F.lit(1.0)).cast("string").alias("v_total"),
        (F.lit(1) + k % 4).cast("string").alias("v_pay"),
        (F.lit(1) + k % 2).cast("string").alias("v_ttype"),
    )


def trips_raw_green_fx(spark: SparkSession, sf_dir: str, keep: str | None = None) -> DataFrame:
    v = _raw_values(trips_fx(spark, sf_dir))
    cols = ["v_vendor", "v_pick", "v_drop", "v_flag", "v_rate", "v_plon", "v_plat", "v_dlon",
            "v_dlat", "v_pax", "v_dist", "v_fare", "v_extra", "v_mta", "v_tip", "v_tolls",
            "v_ehail", "v_total", "v_pay", "v_ttype"]
    return v.select(*[F.col(c).alias(h) for c, h in zip(cols, GREEN_RAW_HEADER)], *([keep] if keep else []))


# ---- fixed values: malformed lines of the file of bad rows (first that applies) ----
SHORT_MODULUS, LONG_MODULUS, QUOTE_MODULUS = 89, 83, 79
# -----------------------------------------------------------------------------------


def write_bad_green_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The raw green files as lines, some with a field less, a field more or an open quote."""
    k = "trip_id"
    v = trips_raw_green_fx(spark, sf_dir, keep=k)
    cols = [F.col(f"`{c}`") for c in GREEN_RAW_HEADER]
    short, whole = F.concat_ws(",", *cols[:-1]), F.concat_ws(",", *cols)
    opened = F.concat_ws(",", *cols[:3], F.concat(F.lit('"'), cols[3]), *cols[4:])
    line = (F.when(F.col(k) % SHORT_MODULUS == 0, short).when(F.col(k) % LONG_MODULUS == 0, F.concat(whole, F.lit(",?")))
            .when(F.col(k) % QUOTE_MODULUS == 0, opened).otherwise(whole))
    # one column without delimiters or quotes of its own: its name is the header line
    (v.select(line.alias(",".join(GREEN_RAW_HEADER))).write.option("header", "true").option("sep", "\u0001")
     .option("quote", "\u0000").option("ignoreTrailingWhiteSpace", "false").csv(path))


def trips_raw_yellow_fx(spark: SparkSession, sf_dir: str, parity: int | None = None) -> DataFrame:
    v = _raw_values(_half(trips_fx(spark, sf_dir), parity))
    cols = ["v_vendor", "v_pick", "v_drop", "v_pax", "v_dist", "v_plon", "v_plat", "v_rate",
            "v_flag", "v_dlon", "v_dlat", "v_pay", "v_fare", "v_extra", "v_mta", "v_tip",
            "v_tolls", "v_total"]
    return v.select(*[F.col(c).alias(h) for c, h in zip(cols, YELLOW_RAW_HEADER)])


def _half(trips: DataFrame, parity: int | None) -> DataFrame:
    """Trips with even or odd ids (file sets of two header vintages)."""
    return trips if parity is None else trips.where(F.col("trip_id") % 2 == parity)


def trips_raw_yellow_2015_fx(spark: SparkSession, sf_dir: str, parity: int | None = None) -> DataFrame:
    v = _raw_values(_half(trips_fx(spark, sf_dir), parity)).withColumn("v_improvement", F.lit("0.3"))
    cols = ["v_vendor", "v_pick", "v_drop", "v_pax", "v_dist", "v_plon", "v_plat", "v_rate",
            "v_flag", "v_dlon", "v_dlat", "v_pay", "v_fare", "v_extra", "v_mta", "v_tip",
            "v_tolls", "v_improvement", "v_total"]
    return v.select(*[F.col(c).alias(h) for c, h in zip(cols, YELLOW_2015_RAW_HEADER)])


# ---- buildings (shapefile-shaped attribute table) ------------------------

def buildings_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, num_floors (text), geometry (WKT square), building_id from ``part``."""
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 4 == 0, F.lit("")) \
        .otherwise(F.col("p_name"))
    floors = F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    x0 = F.lit(-74.05) + (k % 100).cast("double") / F.lit(1000.0)
    y0 = F.lit(40.6) + F.floor(k / 100).cast("double") / F.lit(1000.0)
    d = F.lit(0.0005)
    ring = [(x0, y0), (x0 + d, y0), (x0 + d, y0 + d), (x0, y0 + d), (x0, y0)]
    wkt = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[
        F.concat(x.cast("string"), F.lit(" "), y.cast("string")) for x, y in ring]), F.lit("))"))
    return p.select(k.alias("building_id"), name.alias("name"), floors.alias("num_floors"),
                    wkt.alias("geometry"))


# ---- raster pixels (tiles of 8 x 8 cells) ------------------------------------

# ---- fixed values: tile layout of the pixel fixture ---------------------------
TILE_COLS = 8
TILE_ROWS = 8
TILE_SIZE_M = 240.0         # 8 cells of 30 m
TILE_X0 = 580000.0
TILE_Y0 = 4500000.0
TILE_GRID_COLS = 16         # tile_col = tile % 16, tile_row = tile div 16
TILE_CRS = "EPSG:32618"
SCENE = "fx"
RED = (20, 37, 101)         # red = 20 + order * 37 % 101
NIR = (29, 61, -20)         # near infrared = red + tile * 29 % 61 - 20
NODATA_MODULUS = 53         # the near-infrared cell of every 53rd order is NoData
DARK_MODULUS = 97           # both bands of every 97th order are 0 (NDVI is NoData)
# -------------------------------------------------------------------------------


def pixels_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per pixel: scene, tile key, pos (row-major), extent, red, nir.

    Every order is a pixel: tile = order key div 64, position = order key mod 64, so the
    tiles grow with the table, the last one is short, and nothing is sorted or cut.
    """
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    size = TILE_COLS * TILE_ROWS
    tile = F.expr(f"o_orderkey div {size}")
    dark = k % DARK_MODULUS == 0
    red = F.when(dark, F.lit(0.0)).otherwise((F.lit(RED[0]) + k * RED[1] % RED[2]).cast("double"))
    nir = (F.when(k % NODATA_MODULUS == 0, F.lit(None).cast("double")).when(dark, F.lit(0.0))
           .otherwise(red + (tile * NIR[0] % NIR[1] + NIR[2]).cast("double")))
    tcol = (tile % TILE_GRID_COLS).cast("int")
    trow = F.expr(f"o_orderkey div {size * TILE_GRID_COLS}").cast("int")
    xmin = F.lit(TILE_X0) + tcol.cast("double") * F.lit(TILE_SIZE_M)
    ymin = F.lit(TILE_Y0) + trow.cast("double") * F.lit(TILE_SIZE_M)
    return o.select(
        F.lit(SCENE).alias("scene"), tcol.alias("tile_col"), trow.alias("tile_row"), (k % size).cast("int").alias("pos"),
        xmin.alias("xmin"), ymin.alias("ymin"),
        (xmin + F.lit(TILE_SIZE_M)).alias("xmax"), (ymin + F.lit(TILE_SIZE_M)).alias("ymax"),
        F.lit(TILE_CRS).alias("crs"), F.lit(TILE_COLS).alias("cols"), F.lit(TILE_ROWS).alias("rows"),
        red.alias("red"), nir.alias("nir"))


# ---- labelled arrays (the image data set, re-aimed at the embeddings table) ----

# ---- fixed values: sample layout ------------------------------------------------
SAMPLE_ROWS = 8
SAMPLE_COLS = 8
NUM_CLASSES = 10
TEST_MODULUS = 5            # test part: vec_id % 5 == 0
# ---------------------------------------------------------------------------------


def samples_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, embedding (64 floats = 8 x 8 x 1), label, part ('train' / 'test')."""
    e = read(spark, sf_dir, "embeddings")
    part = F.when(F.col("vec_id") % TEST_MODULUS == 0, F.lit("test")).otherwise(F.lit("train"))
    return e.select("vec_id", "embedding", "label", part.alias("part"))
