"""Registered queries of the trip-preparation and table notebooks: raw CSV
vintages, cleaning, unions, sinks and catalog, building top-k."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.operators import quarantine as QR
from tessera.operators import tables as TB
from tessera.operators import trips as TR
from tessera.operators.versioned import VersionedTable
from tessera.operators.sizing import materialise
from tessera.plans import oracle_parts as O
from tessera.plans.registry import register
from tessera.session import scratch_dir
from tessera.sources import fixtures as FX
from tessera.sources import readers as RD

TS_FMT = "yyyy-MM-dd HH:mm:ss"
DUCK_TS = "'%Y-%m-%d %H:%M:%S'"


def _write_raw(spark: SparkSession, sf: str, kind: str) -> str:
    """Write the raw cab fixture as headered CSV files; return the folder."""
    df = FX.trips_raw_green_fx(spark, sf) if kind == "green" else FX.trips_raw_yellow_fx(spark, sf)
    path = scratch_dir(spark, f"{kind}_csv")
    df.write.option("header", "true").csv(path)
    return path


def kept(df: DataFrame, clean_up) -> DataFrame:
    """The rows of a table that is dropped at once: written to the shared folder, then cleaned up."""
    out = materialise(df, "kept", measure=False).df
    clean_up()
    return out


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("scan_csv_raw", oracle="S")
def q_scan_csv_raw(spark, sf):
    """Every column as text, as written (an empty field is null; the writer trims headers)."""
    raw = RD.read_csv_raw(spark, _write_raw(spark, sf, "green"))
    return raw.select("VendorID", "lpep_pickup_datetime", "Passenger_count", "Ehail_fee", F.col("Trip_type").alias("trip_type"),
                      F.lit(",".join(dict(raw.dtypes).values())).alias("types"))


@register("quarantine_csv", oracle="S")
def q_quarantine_csv(spark, sf):
    """Records in, clean, quarantined by reason, and values lost by column, of files with malformed lines."""
    path = scratch_dir(spark, "bad_green_csv")
    FX.write_bad_green_lines(spark, sf, path)
    good, bad = QR.split_records(spark, path)
    clean, _ = QR.clean_with_quarantine(spark, [path], "green")
    one = F.count(F.lit(1)).alias("num_rows")
    lost = QR.lost_values(good, "green")
    lost = lost.select(F.inline(F.array(*[F.struct(F.lit(section).alias("section"), F.col("column").alias("name"), F.col(c).alias("num_rows"))
                                          for section, c in (("became null", "became_null"), ("empty", "empty"))])))
    return (clean.agg(one).select(F.lit("records").alias("section"), F.lit("clean").alias("name"), "num_rows")
            .unionByName(bad.groupBy(F.col("reason").alias("name")).agg(one).withColumn("section", F.lit("quarantine")))
            .unionByName(lost).where(F.col("num_rows") > 0))


@register("case_header_map", oracle="S")
def q_case_header_map(spark, sf):
    """Trimmed, lower-cased headers; pass-through copies of payment and trip type."""
    raw = TR.normalise_headers(RD.read_csv_raw(spark, _write_raw(spark, sf, "green")))
    return raw.select(F.col("payment_type"), F.col("trip_type"),
                      TR.cast_numeric(F.col("dropoff_latitude"), "double").alias("dropoff_latitude"))


@register("rename_columns", oracle="S")
def q_rename_columns(spark, sf):
    raw = RD.read_csv_raw(spark, _write_raw(spark, sf, "yellow"))
    df = TR.rename_columns(TR.normalise_headers(raw), TR.YELLOW_ALIASES)
    return df.select("vendor_id", "rate_code_id", "store_and_forward", "payment_type")


@register("cast_numeric", oracle="S")
def q_cast_numeric(spark, sf):
    raw = TR.normalise_headers(RD.read_csv_raw(spark, _write_raw(spark, sf, "green")))
    return raw.select(TR.cast_numeric(F.col("passenger_count"), "int").alias("passenger_count"),
                      TR.cast_numeric(F.col("fare_amount"), "double").alias("fare_amount"),
                      TR.cast_numeric(F.col("ehail_fee"), "double").alias("ehail_fee"))


@register("normalise_datetime", oracle="S")
def q_normalise_datetime(spark, sf):
    raw = TR.normalise_headers(RD.read_csv_raw(spark, _write_raw(spark, sf, "green")))
    return raw.select(TR.normalise_datetime(F.col("lpep_pickup_datetime"), as_string=True)
                      .alias("pickup_datetime"),
                      TR.normalise_datetime(F.col("lpep_dropoff_datetime"), as_string=True)
                      .alias("dropoff_datetime"))


@register("clean_trips_green", oracle="S")
def q_clean_trips_green(spark, sf):
    raw = RD.read_csv_raw(spark, _write_raw(spark, sf, "green"))
    return TR.clean_trips_green(raw, as_string=True)


@register("clean_trips_yellow", oracle="S")
def q_clean_trips_yellow(spark, sf):
    raw = RD.read_csv_raw(spark, _write_raw(spark, sf, "yellow"))
    return TR.clean_trips_yellow(raw, as_string=True)


@register("union_trips", oracle="S")
def q_union_trips(spark, sf):
    g = TR.clean_trips_green(RD.read_csv_raw(spark, _write_raw(spark, sf, "green")), as_string=True)
    y = TR.clean_trips_yellow(RD.read_csv_raw(spark, _write_raw(spark, sf, "yellow")), as_string=True)
    return TR.union_trips(g, y)


@register("union_all", oracle="S")
def q_union_all(spark, sf):
    """ewr.unionAll(lga): two one-row tables, duplicates kept, renamed positionally."""
    a = FX.airports_fx(spark, sf)
    ewr = a.where(F.col("LocationID") == FX.AIRPORT_ZONES[0])
    lga = a.where(F.col("LocationID") == FX.AIRPORT_ZONES[1])
    u = ewr.unionByName(lga).toDF("OBJECTID", "the_geom", "zone", "LocationID", "borough")
    return u.select("OBJECTID", "zone", "LocationID", "borough",
                    G.st_num_points(G.st_geom_from_wkt("the_geom")).alias("num_points"))


@register("inline_rows", oracle="S")
def q_inline_rows(spark, sf):
    """Literal rows (VALUES) joined with the zone table."""
    codes = spark.sql("SELECT * FROM VALUES (6, 'EWR'), (18, 'LGA') AS t(location_id, code)")
    z = FX.zones_fx(spark, sf).select("location_id", "zone", "borough")
    return codes.join(z, "location_id").select("location_id", "code", "zone", "borough")


@register("scan_table_path", oracle="S")
def q_scan_table_path(spark, sf):
    path = scratch_dir(spark, "trips_path")
    FX.trips_fx(spark, sf).write.parquet(path)
    return RD.sql_on_path(spark, "parquet", path,
                          "count(*) AS num_rows, sum(passenger_count) AS num_passengers")


@register("sink_overwrite", oracle="S")
def q_sink_overwrite(spark, sf):
    """Overwrite twice with different schemas; the second schema wins."""
    path = scratch_dir(spark, "overwrite")
    t = FX.trips_fx(spark, sf)
    TB.write_overwrite(t.select("trip_id", "fare_amount"), path)
    back = TB.write_overwrite(t.select("trip_id", "vendor_id", "passenger_count"), path)
    return back


@register("sink_save_table", oracle="S")
def q_sink_save_table(spark, sf):
    name = _unique("airports")
    back = TB.save_table(FX.airports_fx(spark, sf).where(F.col("LocationID").isin(*FX.AIRPORT_ZONES[:2])), name)
    out = back.select("OBJECTID", "zone", "LocationID", "borough",
                      G.st_num_points(G.st_geom_from_wkt("the_geom")).alias("num_points"))
    return kept(out, lambda: TB.drop_if_exists(spark, name))


@register("ctas_if_absent", oracle="S")
def q_ctas_if_absent(spark, sf):
    """CTAS twice: the second statement is a no-op and the table keeps its rows."""
    from tessera.plans.geo_queries import RES_TRIPS, trips_cells
    view = _unique("trips_v")
    trips_cells(spark, sf, RES_TRIPS).createOrReplaceTempView(view)
    name = _unique("trips_h3")
    TB.ctas_if_absent(spark, name, f"SELECT * FROM {view}")
    out = TB.ctas_if_absent(spark, name, f"SELECT * FROM {view} WHERE passenger_count > 3")
    return kept(out, lambda: (TB.drop_if_exists(spark, name), spark.catalog.dropTempView(view)))


@register("drop_if_exists", oracle="S")
def q_drop_if_exists(spark, sf):
    """Rows of a table before the drop, and whether it is listed before and after dropping it
    twice."""
    name = _unique("zones_tmp")
    rows = TB.save_table(FX.zones_fx(spark, sf).select("location_id", "zone"), name).count()
    listed = [int(spark.catalog.tableExists(name))]
    TB.drop_if_exists(spark, name)
    TB.drop_if_exists(spark, name)
    listed.append(int(spark.catalog.tableExists(name)))
    return spark.createDataFrame([(rows, *listed)], "num_rows long, before_drop int, after_drop int")


@register("database_scope", oracle="S")
def q_database_scope(spark, sf):
    """A table made under USE lies in that database: its name and its rows.  The database is
    dropped and the former one is current again, also when a step fails."""
    db = _unique("tessera_db")
    with TB.database(spark, db):
        TB.save_table(FX.zones_fx(spark, sf).select("location_id", "zone"), "zones")
        shown = [r["tableName"] for r in spark.sql("SHOW TABLES").where(F.col("namespace") == db).collect()]
        rows = spark.table(f"{db}.zones").count()
    return spark.createDataFrame([(t, rows) for t in shown], "table_name string, num_rows long")


@register("temp_view", oracle="S")
def q_temp_view(spark, sf):
    view = _unique("trips")
    FX.trips_fx(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT vendor_id, count(*) AS num_trips, sum(passenger_count) AS num_passengers "
                     f"FROM {view} GROUP BY vendor_id")


@register("compact_table", oracle="S")
def q_compact_table(spark, sf):
    """Many small files -> few files range-partitioned on trip_id; same content."""
    src = scratch_dir(spark, "small_files")
    FX.trips_fx(spark, sf).select("trip_id", "vendor_id", "fare_amount").repartition(16).write.parquet(src)
    return TB.compact_files(spark, src, scratch_dir(spark, "compacted"), order_by="trip_id")


@register("compact_table_versions", oracle="S")
def q_compact_table_versions(spark, sf):
    """Many small files rewritten along the Hilbert curve of the pickups as the table's next version."""
    table = VersionedTable(spark, scratch_dir(spark, "versions"))
    table.write(FX.trips_fx(spark, sf).select("trip_id", "pickup_longitude", "pickup_latitude", "fare_amount").repartition(16))
    table.compact("pickup_longitude", "pickup_latitude")
    return table.read()


@register("table_columns", oracle="S")
def q_table_columns(spark, sf):
    """``df.columns`` of the cleaned green table, as (position, name, non-null values) rows."""
    df = TR.clean_trips_green(FX.trips_raw_green_fx(spark, sf), as_string=True)
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(c).alias("num_values"))
                     for i, c in enumerate(df.columns)])
    return counts.select(F.inline(rows))


@register("clean_trips_vintages", oracle="S")
def q_clean_trips_vintages(spark, sf):
    """Two yellow file sets with different headers, each read on its own."""
    even, odd = scratch_dir(spark, "yellow_2009"), scratch_dir(spark, "yellow_2015")
    FX.trips_raw_yellow_fx(spark, sf, parity=0).write.option("header", "true").csv(even)
    FX.trips_raw_yellow_2015_fx(spark, sf, parity=1).write.option("header", "true").csv(odd)
    return TR.read_vintages(spark, [even, odd], "yellow", as_string=True)


@register("peek_text", oracle="S")
def q_peek_text(spark, sf):
    """The first line of every file is its header; the head of a text file is asked for."""
    return RD.peek_text(spark, _write_raw(spark, sf, "green"), 1)


@register("list_files", oracle="S")
def q_list_files(spark, sf):
    """Files of a table written one per vendor: their number, and that none is empty."""
    path = scratch_dir(spark, "vendors")
    t = FX.trips_fx(spark, sf).select("trip_id", "vendor_id")
    t.repartition("vendor_id").write.partitionBy("vendor_id").parquet(path)
    found = RD.list_files(spark, path).where(F.col("path").endswith(".parquet"))
    return found.select(F.regexp_extract("path", "vendor_id=([^/]+)/", 1).alias("vendor_id"),
                        (F.col("length") > 0).alias("has_bytes")).groupBy("vendor_id", "has_bytes").agg(
        F.count(F.lit(1)).alias("num_files"))


@register("scan_csv_infer", oracle="S")
def q_scan_csv_infer(spark, sf):
    """Zone CSV read with schema inference: integer ids come back as int, the
    geometry as text (compared through its parsed vertex count)."""
    path = scratch_dir(spark, "zones_csv")
    FX.zones_fx(spark, sf).write.option("header", "true").csv(path)
    z = RD.read_csv_infer(spark, path)
    return z.select("location_id", "zone", "borough", "zone_order",
                    F.lit(dict(z.dtypes)["location_id"]).alias("location_id_type"),
                    G.st_num_points(G.st_geom_from_wkt("the_geom")).alias("num_points"))


# ---- building table (shapefile-shaped attributes) ----------------------------

@register("filter_non_empty", oracle="S")
def q_filter_non_empty(spark, sf):
    b = FX.buildings_fx(spark, sf)
    return b.where(F.col("name") != "").select("building_id", "name")


@register("topk_tallest", oracle="S")
def q_topk_tallest(spark, sf):
    """Five tallest named buildings; the rounded number sorts (alias wins), nulls
    last, ties broken by id."""
    b = FX.buildings_fx(spark, sf)
    floors = F.round(F.col("num_floors").try_cast("double"), 0)
    return (b.where(F.col("name") != "")
            .select("building_id", "name", floors.alias("num_floors"))
            .orderBy(F.col("num_floors").desc_nulls_last(), F.col("building_id"))
            .limit(5))


@register("select_star_derived", oracle="S")
def q_select_star_derived(spark, sf):
    """SELECT *, ST_GeomFromWKT(geometry) AS geometry: the parsed column replaces the text."""
    b = FX.buildings_fx(spark, sf).withColumn("geometry", G.st_geom_from_wkt("geometry"))
    return b.select("building_id", "name", "num_floors",
                    G.st_geometry_type("geometry").alias("gtype"),
                    G.st_num_points("geometry").alias("num_points"),
                    F.round(G.st_area("geometry") * F.lit(1e8), 3).alias("area_e8"))


@register("scan_shapefile", oracle="S")
def q_scan_shapefile(spark, sf):
    """Buildings written as shapefiles (one triple per partition), read back by
    record ranges: WKT geometry + text attributes."""
    from tessera.sources import shapefile as SH
    b = FX.buildings_fx(spark, sf).withColumn("g", G.st_geom_from_wkt("geometry"))
    rings = F.transform(F.col("g.polys")[0], lambda r: F.reverse(r))   # outer ring clockwise
    path = scratch_dir(spark, "buildings_shp")
    SH.write_shapefiles(b.select(rings.alias("rings"), F.col("building_id").cast("string").alias("bid"),
                                 "name", "num_floors").repartition(4),
                        path, "rings", ["bid", "name", "num_floors"],
                        {"bid": 12, "name": 64, "num_floors": 8})
    SH.register(spark)
    shp = spark.read.format("shapefile").option("recordsPerPartition", "300").load(path)
    g = G.st_geom_from_wkt("geometry")
    return shp.select(F.col("bid").cast("long").alias("building_id"), "name", "num_floors",
                      G.st_num_points(g).alias("num_points"),
                      F.round(G.st_area(g) * F.lit(1e8), 3).alias("area_e8"))


@register("count_rows", oracle="S")
def q_count_rows(spark, sf):
    return FX.trips_fx(spark, sf).agg(F.count(F.lit(1)).alias("count"))


@register("sample_fraction", oracle="S")
def q_sample_fraction(spark, sf):
    """1% sample of the trips (the sample is the feature), by a hash of the key: the same rows in
    every run, whatever the partitions."""
    return TB.sample_by_hash(FX.trips_fx(spark, sf), "trip_id", 0.01).select("trip_id", "vendor_id", "fare_amount")


# ---- oracle SQL -----------------------------------------------------------------

def _raw_expect_cte() -> str:
    """Expected clean values of the raw cab fixture (bad text -> null)."""
    return f"""{O.trips_cte()},
clean AS (
  SELECT trip_id AS k,
         vendor_id,
         CASE WHEN trip_id % 103 = 0 THEN NULL ELSE strftime(pickup_datetime, {DUCK_TS}) END AS pickup_datetime,
         strftime(dropoff_datetime, {DUCK_TS}) AS dropoff_datetime,
         CASE WHEN trip_id % 5 = 0 THEN 'Y' ELSE 'N' END AS store_and_forward,
         CAST(1 + trip_id % 3 AS VARCHAR) AS rate_code_id,
         pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
         CASE WHEN trip_id % 97 = 0 OR trip_id % 101 = 0 THEN NULL ELSE passenger_count END AS passenger_count,
         CAST(trip_id % 50 AS DOUBLE) / {O.d(4.0)} AS trip_distance,
         fare_amount,
         CAST(trip_id % 3 AS DOUBLE) * {O.d(0.5)} AS extra,
         {O.d(0.5)} AS mta_tax,
         CAST(trip_id % 7 AS DOUBLE) * {O.d(0.25)} AS tip_amount,
         {O.d(0.0)} AS tolls_amount,
         CASE WHEN trip_id % 2 = 0 THEN NULL ELSE {O.d(1.25)} END AS ehail_fee,
         fare_amount + {O.d(1.0)} AS total_amount,
         CAST(1 + trip_id % 4 AS VARCHAR) AS payment_type,
         CAST(1 + trip_id % 2 AS VARCHAR) AS trip_type
  FROM trips
)"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    raw = _raw_expect_cte()
    green = ", ".join(TR.GREEN_COLUMNS)
    yellow = ", ".join(TR.YELLOW_COLUMNS)
    q["case_header_map"] = f"WITH {raw}\nSELECT payment_type, trip_type, dropoff_latitude FROM clean"
    q["rename_columns"] = f"WITH {raw}\nSELECT vendor_id, rate_code_id, store_and_forward, payment_type FROM clean"
    q["cast_numeric"] = f"WITH {raw}\nSELECT passenger_count, fare_amount, ehail_fee FROM clean"
    q["normalise_datetime"] = f"WITH {raw}\nSELECT pickup_datetime, dropoff_datetime FROM clean"
    q["clean_trips_green"] = f"WITH {raw}\nSELECT {green} FROM clean"
    q["clean_trips_yellow"] = f"WITH {raw}\nSELECT {yellow} FROM clean"
    yellow_as_green = ", ".join(c if c in TR.YELLOW_COLUMNS else f"CAST(NULL AS {'DOUBLE' if c == 'ehail_fee' else 'VARCHAR'}) AS {c}"
                                for c in TR.GREEN_COLUMNS)
    q["union_trips"] = (f"WITH {raw}\nSELECT {green}, 'green' AS cab_type FROM clean\nUNION ALL\n"
                        f"SELECT {yellow_as_green}, 'yellow' AS cab_type FROM clean")
    ids = FX.AIRPORT_ZONES
    q["union_all"] = f"""WITH {O.zones_cte()},
npts AS (SELECT location_id, count(*) AS num_points FROM zone_vtx GROUP BY location_id)
SELECT z.location_id AS OBJECTID, z.zone, z.location_id AS LocationID, z.borough, n.num_points
FROM zones z JOIN npts n USING (location_id) WHERE z.location_id IN ({ids[0]}, {ids[1]})"""
    q["sink_save_table"] = q["union_all"]
    q["inline_rows"] = f"""WITH {O.zones_cte()},
codes(location_id, code) AS (VALUES (6, 'EWR'), (18, 'LGA'))
SELECT c.location_id, c.code, z.zone, z.borough FROM codes c JOIN zones z USING (location_id)"""
    q["scan_table_path"] = (f"WITH {O.trips_cte()}\nSELECT count(*) AS num_rows, "
                            f"CAST(sum(passenger_count) AS BIGINT) AS num_passengers FROM trips")
    q["sink_overwrite"] = f"WITH {O.trips_cte()}\nSELECT trip_id, vendor_id, passenger_count FROM trips"
    from tessera.plans.geo_oracle import _trips_cells_cte
    from tessera.plans.geo_queries import RES_TRIPS
    q["ctas_if_absent"] = f"WITH {O.trips_cte()},\n{_trips_cells_cte(RES_TRIPS)}\nSELECT * FROM t"
    q["quarantine_csv"] = f"""WITH {O.trips_cte()},
told AS (SELECT trip_id AS k, CASE WHEN trip_id % {FX.SHORT_MODULUS} = 0 THEN 'too few fields' WHEN trip_id % {FX.LONG_MODULUS} = 0
         THEN 'too many fields' WHEN trip_id % {FX.QUOTE_MODULUS} = 0 THEN 'broken quote' END AS reason FROM trips),
good AS (SELECT k FROM told WHERE reason IS NULL),
counts AS (
  SELECT 'records' AS section, 'clean' AS name, count(*) AS num_rows FROM good
  UNION ALL SELECT 'quarantine', reason, count(*) FROM told WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT 'became null', 'passenger_count', count(*) FROM good WHERE k % 97 = 0
  UNION ALL SELECT 'became null', 'pickup_datetime', count(*) FROM good WHERE k % 103 = 0
  UNION ALL SELECT 'empty', 'passenger_count', count(*) FROM good WHERE k % 101 = 0 AND k % 97 <> 0
  UNION ALL SELECT 'empty', 'ehail_fee', count(*) FROM good WHERE k % 2 = 0)
SELECT * FROM counts WHERE num_rows > 0"""
    q["temp_view"] = (f"WITH {O.trips_cte()}\nSELECT vendor_id, count(*) AS num_trips, "
                      f"CAST(sum(passenger_count) AS BIGINT) AS num_passengers FROM trips GROUP BY vendor_id")
    q["compact_table_versions"] = f"WITH {O.trips_cte()}\nSELECT trip_id, pickup_longitude, pickup_latitude, fare_amount FROM trips"
    q["compact_table"] = f"WITH {O.trips_cte()}\nSELECT trip_id, vendor_id, fare_amount FROM trips"
    bld = f"""buildings AS (
  SELECT p_partkey AS building_id,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS name,
         CASE WHEN p_partkey % 11 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS num_floors
  FROM part
)"""
    q["filter_non_empty"] = f"WITH {bld}\nSELECT building_id, name FROM buildings WHERE name <> ''"
    q["topk_tallest"] = f"""WITH {bld}
SELECT building_id, name, round(TRY_CAST(num_floors AS DOUBLE), 0) AS num_floors
FROM buildings WHERE name <> ''
ORDER BY num_floors DESC NULLS LAST, building_id LIMIT 5"""
    q["select_star_derived"] = f"""WITH {bld}
SELECT building_id, name, num_floors, 'POLYGON' AS gtype, 5 AS num_points,
       round({O.d(0.0005)} * {O.d(0.0005)} * {O.d(1e8)}, 3) AS area_e8
FROM buildings"""
    q["scan_shapefile"] = f"""WITH {bld}
SELECT building_id, nullif(name, '') AS name, num_floors, 5 AS num_points,
       round({O.d(0.0005)} * {O.d(0.0005)} * {O.d(1e8)}, 3) AS area_e8 FROM buildings"""
    names = ("vendor_id pickup_datetime dropoff_datetime store_and_forward rate_code_id pickup_longitude pickup_latitude "
             "dropoff_longitude dropoff_latitude passenger_count trip_distance fare_amount extra mta_tax tip_amount "
             "tolls_amount ehail_fee total_amount payment_type trip_type").split()
    q["table_columns"] = f"WITH {raw}\n" + "\nUNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS name, count({c}) AS num_values FROM clean" for i, c in enumerate(names))
    q["clean_trips_vintages"] = q["clean_trips_yellow"]
    q["scan_csv_raw"] = f"""WITH {O.trips_cte()}
SELECT vendor_id AS VendorID,
       CASE WHEN trip_id % 103 = 0 THEN 'bad' ELSE strftime(pickup_datetime, {DUCK_TS}) END AS lpep_pickup_datetime,
       CASE WHEN trip_id % 97 = 0 THEN 'x' WHEN trip_id % 101 = 0 THEN NULL ELSE CAST(passenger_count AS VARCHAR) END AS Passenger_count,
       CASE WHEN trip_id % 2 = 0 THEN NULL ELSE '1.25' END AS Ehail_fee, CAST(1 + trip_id % 2 AS VARCHAR) AS trip_type,
       '{",".join(["string"] * 20)}' AS types FROM trips"""
    q["peek_text"] = "SELECT '" + ",".join(h.strip() for h in FX.GREEN_RAW_HEADER) + "' AS value"
    q["list_files"] = f"WITH {O.trips_cte()}\nSELECT vendor_id, true AS has_bytes, CAST(1 AS BIGINT) AS num_files FROM trips GROUP BY vendor_id"
    q["drop_if_exists"] = f"WITH {O.zones_cte()}\nSELECT count(*) AS num_rows, CAST(1 AS INTEGER) AS before_drop, CAST(0 AS INTEGER) AS after_drop FROM zones"
    q["database_scope"] = f"WITH {O.zones_cte()}\nSELECT 'zones' AS table_name, count(*) AS num_rows FROM zones"
    q["sample_fraction"] = f"""WITH {O.trips_cte()}
SELECT trip_id, vendor_id, fare_amount FROM trips
WHERE CAST(('0x' || substr(md5('42|' || CAST(trip_id AS VARCHAR)), 1, 8)) AS BIGINT) < CAST(0.01 * 4294967296 AS BIGINT)"""
    q["scan_csv_infer"] = f"""WITH {O.zones_cte()},
npts AS (SELECT location_id, count(*) AS num_points FROM zone_vtx GROUP BY location_id)
SELECT z.location_id, z.zone, z.borough, z.zone_order, 'int' AS location_id_type, n.num_points
FROM zones z JOIN npts n USING (location_id)"""
    q["count_rows"] = f"WITH {O.trips_cte()}\nSELECT count(*) AS count FROM trips"
    return q
