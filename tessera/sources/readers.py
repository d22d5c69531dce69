"""File sources: headered CSV, GeoJSON feature collections, directory listings,
text heads, SQL-on-path.  All are Spark readers; schemas are explicit where the
reference relied on inference, except in ``read_csv_infer`` which reproduces
inference on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry as G

GEOJSON_PROPERTIES = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("borough", T.StringType()),
    T.StructField("zone", T.StringType()),
])


def geojson_schema(properties: T.StructType = GEOJSON_PROPERTIES) -> T.StructType:
    """FeatureCollection schema; geometry coordinates are kept as raw JSON text so
    Polygon and MultiPolygon features share one column."""
    geometry = T.StructType([T.StructField("type", T.StringType()),
                             T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("type", T.StringType()),
                            T.StructField("properties", properties),
                            T.StructField("geometry", geometry)])
    return T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("features", T.ArrayType(feature))])


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV files, every column as text (the reference's raw read)."""
    return spark.read.option("header", "true").csv(path)


def read_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with type inference (one extra pass over the data)."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def read_geojson(spark: SparkSession, path: str,
                 properties: T.StructType = GEOJSON_PROPERTIES) -> DataFrame:
    """Multi-line GeoJSON FeatureCollection files -> one row per file."""
    return spark.read.schema(geojson_schema(properties)).option("multiLine", "true").json(path)


def geojson_features(collections: DataFrame) -> DataFrame:
    """FeatureCollections -> one row per feature: type, properties, WKT geometry."""
    f = collections.select("type", F.explode("features").alias("feature"))
    geom = G.st_geom_from_geojson(F.to_json(F.col("feature.geometry")))
    return f.select("type", F.col("feature.properties").alias("properties"),
                    G.st_as_text(geom).alias("geometry"))


def write_geojson(df: DataFrame, path: str, geom_col: str, prop_cols: list[str],
                  per_document: int = 10_000) -> None:
    """Write a geometry column as FeatureCollection documents of at most ``per_document``
    features, one document per file (a multi-line JSON file is read by one task)."""
    feat = F.concat(F.lit('{"type":"Feature","properties":'),
                    F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in prop_cols])),
                    F.lit(',"geometry":'), G.st_as_geojson(F.col(geom_col)), F.lit("}"))
    at = F.monotonically_increasing_id()
    feats = df.select(feat.alias("f"), F.floor(at / per_document).alias("__doc"))
    docs = feats.groupBy("__doc").agg(F.collect_list("f").alias("fs"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['),
                    F.concat_ws(",", "fs"), F.lit("]}"))
    # one document per file: multi-line JSON readers parse one document per file
    docs.select(text.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``ls``: path, length, modificationTime (file content is never read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime"))


def peek_text(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First ``n`` lines of a text file (``head``); the limit is the feature.

    Of a folder, the files are taken in the order of their paths.  Each file that is not empty has a line, so only
    the first ``n`` of them are read, and lines go by their place, as a later part of a split file may come first.
    """
    heads = [r["path"] for r in list_files(spark, path).where(F.col("length") > 0).orderBy("path").limit(n).collect()]
    lines = spark.read.text(heads or path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
             F.monotonically_increasing_id().alias("at")]
    return lines.select("value", *place).orderBy("file", "start", "at").limit(n).select("value")


def sql_on_path(spark: SparkSession, fmt: str, path: str, select: str = "*") -> DataFrame:
    """``SELECT ... FROM parquet.`path``` (open a table by its location)."""
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}`")
