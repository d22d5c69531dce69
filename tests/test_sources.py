"""Readers, sinks and the catalog: values, and errors where a read would be silently empty."""

import os

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import raster as RS
from tessera.operators import tables as TB
from tessera.operators import trips as TR
from tessera.plans import raster_queries as RQ
from tessera.plans import table_queries as TQ
from tessera.session import scratch_dir
from tessera.sources import fixtures as FX
from tessera.sources import readers as RD
from tessera.sources import shapefile as SH

from conftest import SF_SMALL


def test_unknown_header_is_an_error_that_names_the_headers(spark):
    df = spark.createDataFrame([("1", "2")], ["VendorID", "pickup_time"])
    with pytest.raises(ValueError, match="pickup_time"):
        TR.clean_trips_yellow(df)
    with pytest.raises(ValueError, match="no header for"):
        TR.clean_trips(df, TR.GREEN_ALIASES, TR.GREEN_COLUMNS)


@pytest.mark.parametrize("name", [*TR.GREEN_VINTAGES, *TR.YELLOW_VINTAGES])
def test_every_vintage_is_told_by_its_header(spark, name):
    vintages = TR.GREEN_VINTAGES if name.startswith("green") else TR.YELLOW_VINTAGES
    headers = [h.upper() + " " for h in vintages[name][0]]
    assert TR.vintage_of(headers, vintages) == name
    df = spark.createDataFrame([tuple("1" for _ in headers)], headers)
    out = TR.clean_vintage(df, name.split()[0])
    columns = TR.GREEN_COLUMNS if name.startswith("green") else TR.YELLOW_COLUMNS
    assert out.columns == columns and out.first()["passenger_count"] == 1


def test_shapefile_errors(spark, tmp_path):
    SH.register(spark)
    with pytest.raises(Exception, match="no shapefile"):
        spark.read.format("shapefile").load(str(tmp_path)).count()
    with pytest.raises(Exception, match="not from s3a"):
        spark.read.format("shapefile").load("s3a://bucket/folder").count()
    ring = [[[0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [0.0, 0.0]]]
    df = spark.createDataFrame([(ring, "a long name", None)], "rings array<array<array<double>>>, name string, other string")
    with pytest.raises(Exception, match="longer than its column"):
        SH.write_shapefiles(df, str(tmp_path / "cut"), "rings", ["name"], {"name": 4})
    with pytest.raises(ValueError, match="longer than 10 bytes"):
        SH.write_shapefiles(df.withColumnRenamed("name", "a_name_too_long"), str(tmp_path / "x"), "rings", ["a_name_too_long"],
                            {"a_name_too_long": 20})
    SH.write_shapefiles(df, "file://" + str(tmp_path / "ok"), "rings", ["name", "other"], {"name": 20, "other": 4})
    row = spark.read.format("shapefile").load(str(tmp_path / "ok")).first()
    assert (row["name"], row["other"]) == ("a long name", None) and row["geometry"].startswith("POLYGON")


def test_unsupported_shape_is_an_error_and_deleted_records_are_left_out(spark, tmp_path):
    SH.register(spark)
    ring = [[[0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [0.0, 0.0]]]
    df = spark.createDataFrame([(ring, str(i)) for i in range(3)], "rings array<array<array<double>>>, name string").coalesce(1)
    SH.write_shapefiles(df, str(tmp_path), "rings", ["name"], {"name": 4})
    base = next(str(tmp_path / f) for f in os.listdir(tmp_path) if f.endswith(".dbf"))[:-4]
    data = bytearray(open(base + ".dbf", "rb").read())
    start = int.from_bytes(data[8:10], "little")
    data[start + 5] = ord("*")                         # the second record
    open(base + ".dbf", "wb").write(bytes(data))
    got = sorted(r["name"] for r in spark.read.format("shapefile").load(str(tmp_path)).collect())
    assert got == ["0", "2"]
    shp = bytearray(open(base + ".shp", "rb").read())
    shp[108:112] = (3).to_bytes(4, "little")           # a polyline
    open(base + ".shp", "wb").write(bytes(shp))
    with pytest.raises(Exception, match="shape type 3"):
        spark.read.format("shapefile").load(str(tmp_path)).collect()


def test_geojson_documents_are_bounded(spark):
    path = scratch_dir(spark, "gj")
    z = FX.zones_fx(spark, SF_SMALL).withColumn("geom", RD.G.st_geom_from_wkt("the_geom"))
    RD.write_geojson(z, path, "geom", ["location_id", "borough", "zone"], per_document=4)
    sizes = [r[0] for r in RD.read_geojson(spark, path).select(F.size("features")).collect()]
    assert sum(sizes) == 25 and max(sizes) <= 4


def test_tiles_grow_with_the_table_and_the_last_is_short(spark):
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    tiles = RQ.q_tiles_from_pixels(spark, SF_SMALL).collect()
    assert len(tiles) == -(-n // 64)
    assert sorted(t["num_cells"] for t in tiles)[0] == n % 64 or n % 64 == 0
    kept = RQ.q_filter_tile_sum(spark, SF_SMALL).count()
    assert 0 < kept < len(tiles)
    assert RQ.q_rf_tile(spark, SF_SMALL).where("nir_nodata > 0").count() > 0


def test_catalog_given_as_a_dataframe_names_the_scenes(spark):
    px = FX.pixels_fx(spark, SF_SMALL)
    path = scratch_dir(spark, "band")
    px.select(*RS.TILE_KEY, "pos", *RS.EXTENT, F.col("red").alias("value")).write.parquet(path)
    cat = spark.createDataFrame([(path, "first")], "B4 string, scene string")
    tiles = RS.read_raster_catalog(spark, cat, ["B4"], FX.TILE_COLS, FX.TILE_ROWS)
    assert {r["scene"] for r in tiles.select("scene").distinct().collect()} == {"first"}


def test_database_is_restored_and_dropped_when_a_step_fails(spark):
    before = spark.catalog.currentDatabase()
    with pytest.raises(RuntimeError):
        with TB.database(spark, "tessera_test_db"):
            assert spark.catalog.currentDatabase() == "tessera_test_db"
            raise RuntimeError("a step fails")
    assert spark.catalog.currentDatabase() == before and not spark.catalog.databaseExists("tessera_test_db")


def test_compaction_of_files_lowers_their_number(spark):
    src, dst = scratch_dir(spark, "small"), scratch_dir(spark, "large")
    FX.trips_fx(spark, SF_SMALL).select("trip_id", "fare_amount").repartition(16).write.parquet(src)
    out = TB.compact_files(spark, src, dst, order_by="trip_id")
    count = lambda p: RD.list_files(spark, p).where(F.col("path").endswith(".parquet")).count()
    assert count(src) == 16 and count(dst) == 1
    assert out.count() == spark.read.parquet(src).count()


def test_compaction_splits_what_one_task_sorts(spark):
    """300 MB of rows of one key, stored in a few kB: not all of them in one task."""
    src = scratch_dir(spark, "wide")
    rows = spark.range(0, 3000, 1, 4).select("id", F.lit(1).alias("k"), F.repeat(F.lit("x"), F.lit(100_000)).alias("t"))
    rows.write.parquet(src)
    out = TB.compact_files(spark, src, scratch_dir(spark, "split"), order_by="k")
    sizes = [r["n"] for r in out.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 2 and sum(sizes) == 3000 and max(sizes) < 2000
    assert out.agg(F.count_distinct("id"), F.sum(F.length("t"))).first() == (3000, 300_000_000)


def test_peeked_lines_are_the_head_of_the_first_files(spark, tmp_path):
    """Files in the order of their paths, whatever their sizes and however they are split."""
    (tmp_path / "a.txt").write_text("")
    (tmp_path / "b.txt").write_text("b0\n\nb2\n")
    (tmp_path / "c.txt").write_text("".join(f"c{i}\n" for i in range(5000)))
    (tmp_path / "d.txt").write_text("".join(f"d{i}\n" for i in range(9000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        for n, want in ((1, ["b0"]), (5, ["b0", "", "b2", "c0", "c1"]), (900, ["b0", "", "b2", *(f"c{i}" for i in range(897))])):
            got = RD.peek_text(spark, str(tmp_path), n)
            assert got.columns == ["value"] and [r[0] for r in got.collect()] == want
        assert [r[0] for r in RD.peek_text(spark, str(tmp_path / "d.txt"), 2).collect()] == ["d0", "d1"]
        assert RD.peek_text(spark, str(tmp_path / "a.txt")).collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_peeked_files_are_written_by_as_many_tasks_as_read_the_trips(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    before, conf = set(session._MADE), "spark.sql.files.openCostInBytes"
    cost = spark.conf.get(conf)
    spark.conf.set(conf, str(1 << 30))                                      # a task for each file
    try:
        head = TQ.q_peek_text(spark, str(tmp_path))
        assert [r[0] for r in head.collect()] == [",".join(h.strip() for h in FX.GREEN_RAW_HEADER)]
    finally:
        spark.conf.set(conf, cost)
    (path,) = session._MADE - before
    assert RD.list_files(spark, path).count() == 3


def test_sample_by_hash_is_the_same_under_any_partitioning(spark):
    t = FX.trips_fx(spark, SF_SMALL).select("trip_id")
    a = sorted(r[0] for r in TB.sample_by_hash(t.repartition(7), "trip_id", 0.1).collect())
    b = sorted(r[0] for r in TB.sample_by_hash(t.coalesce(1), "trip_id", 0.1).collect())
    assert a == b and 0.05 < len(a) / t.count() < 0.15


def test_tiles_of_an_unknown_crs_are_counted(spark):
    px = FX.pixels_fx(spark, SF_SMALL).withColumn("crs", F.when(F.col("tile_col") == 3, F.lit("EPSG:9999"))
                                                  .when(F.col("tile_col") == 4, F.lit("no crs")).otherwise(F.col("crs")))
    tiles = RS.tiles_from_pixels(px, "red", "red", FX.TILE_COLS, FX.TILE_ROWS)
    null = tiles.where(RS.tile_centre_lonlat().isNull()).count()
    counted = {r["crs"]: r["num_tiles"] for r in RS.unknown_crs(tiles).collect()}
    assert set(counted) == {"EPSG:9999", "no crs"} and sum(counted.values()) == null > 0


def test_scratch_folders_are_removed_and_others_left_alone(spark, tmp_path):
    from tessera.operators.sizing import materialise
    from tessera.session import remove_scratch
    made = materialise(spark.range(5), "gone", measure=False)
    assert os.path.isdir(made.path)
    made.delete()
    assert not os.path.exists(made.path)
    remove_scratch(spark, str(tmp_path))
    assert tmp_path.exists()


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session())


def _awkward_collections(tmp_path):
    """Two files: braces, brackets, escaped quotes and backslashes in strings, nested members, members
    before and after the features, and line breaks."""
    import json
    import random
    rng = random.Random(1)
    texts = ['a}b', '{"type":"Feature"}', 'q\\"uo\\te', '],[{', '\\\\', 'end\\', '"}', '', 'é日本"}{', '"features":[', 'x' * 300]
    want = []
    for name, indent in (("a.json", None), ("b.json", 2)):
        feats = []
        for i in range(150):
            x = rng.randint(0, 50)
            props = {"location_id": str(i), "borough": rng.choice(texts), "zone": rng.choice(texts)}
            extra = {"nested": {"deep": [{"a": rng.choice(texts)}, {"b": {}}]}, "list": [[1, {"c": "}"}]]}
            geom = {"type": "Polygon", "coordinates": [[[x, 0], [x + 1, 0], [x + 1, 1], [x, 0]]]}
            feats.append({"type": "Feature", "properties": {**props, **extra} if i % 3 else props, "geometry": geom})
            want.append((name, props["location_id"], props["borough"], props["zone"], x))
        doc = {"type": "FeatureCollection", "crs": {"properties": {"name": "}{["}}, "bbox": [0, 1], "features": feats, "meta": {"x": [{"y": 1}]}}
        (tmp_path / name).write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(indent)), encoding="utf-8")
    return want


@pytest.mark.parametrize("size", [700, 5000, 1 << 27])
def test_geojson_split_into_ranges_reads_the_same_features(spark, tmp_path, size):
    from tessera.sources import geojson as GJ
    want = _awkward_collections(tmp_path)
    former = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        pieces = GJ._pieces(spark, str(tmp_path))
        assert size > 5000 or pieces.select("file", "block").distinct().count() > 10        # one file, many tasks
        rows = GJ.read_geojson_features(spark, str(tmp_path)).orderBy("file", "at").collect()
    finally:
        for k, v in former.items():
            spark.conf.set(k, v)
    got = [(r["file"].rsplit("/", 1)[1], r["properties"]["location_id"], r["properties"]["borough"], r["properties"]["zone"],
            int(float(r["geometry"].split("((")[1].split()[0]))) for r in rows]
    assert got == want and {r["type"] for r in rows} == {"Feature"}


def test_geojson_without_features_or_cut_off(spark, tmp_path):
    from tessera.sources import geojson as GJ
    (tmp_path / "empty.json").write_text('{"type":"FeatureCollection","features":[]}\n')
    (tmp_path / "cut.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"zone":"z"},"geometry":null},'
                                       '{"type":"Feature","properties":{"zone":"lost"')
    rows = GJ.read_geojson_features(spark, str(tmp_path)).collect()
    assert [r["properties"]["zone"] for r in rows] == ["z"] and rows[0]["geometry"] is None
