"""Features of GeoJSON FeatureCollections of any size, read by byte ranges.

A multi-line JSON file is read by one task.  Here the file is cut at every closing brace by the text
reader, which splits files into byte ranges, and the pieces are put together to features again:

1. whether a piece starts inside a string depends on how many quotation marks come before it, its depth
   in braces and brackets on those outside strings.  Each byte range adds up both for the two
   states it may start in (outside or inside a string): a row of five numbers;
2. running sums over these rows (one for each range, in file order) give the state in
   which each range really starts;
3. a brace that leads from depth 2 to depth 1, inside one bracket, ends a feature.  A range
   that ends none hands its last end on to the next in the same way;
4. the pieces between two ends are one feature: they meet in one group, no larger than the
   feature, and are parsed.

Features keep their order by (file, at).  Members of the collection beside ``features`` may come
before or after; a feature cut off by the end of the file is left out; a piece that is not valid JSON
gives a row of nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry as G
from tessera.operators.sizing import materialise
from tessera.sources.readers import GEOJSON_PROPERTIES, geojson_schema


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.translate(text, sign, ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block (start of the byte range), seq, value, and the running sums inside the range: quotes
    before the piece, and after it the depths for either start state."""
    raw = (spark.read.option("lineSep", "}").text(path)
           .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("seq")))
    bare = raw.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", "")).withColumn("quotes", _count(F.col("bare"), '"'))
    up_to = Window.partitionBy("file", "block").orderBy("seq")      # no more than a byte range
    out = bare.withColumn("sum_quotes", F.sum("quotes").over(up_to))
    for state in (0, 1):
        inside = (F.col("sum_quotes") - F.col("quotes") + state) % 2 == 1
        text = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), "bare")).otherwise(F.col("bare")), r'(?s)"[^"]*("|$)', "")
        ends_outside = ((F.col("sum_quotes") + state) % 2 == 0).cast("int")
        out = out.withColumn(f"brace{state}", _count(text, "{") - ends_outside).withColumn(f"bracket{state}", _count(text, "[") - _count(text, "]"))
    sums = {f"{kind}{state}": F.sum(f"{kind}{state}").over(up_to) for kind in ("brace", "bracket") for state in (0, 1)}
    return out.withColumns(sums).drop("bare", "quotes")


def _range_states(pieces: DataFrame) -> DataFrame:
    """file, block, start (1: inside a string), braces and brackets open where the range starts."""
    last = pieces.groupBy("file", "block").agg(F.max_by(F.struct("sum_quotes", "brace0", "bracket0", "brace1", "bracket1"), "seq").alias("t"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = last.withColumn("start", F.coalesce(F.sum("t.sum_quotes").over(before), F.lit(0)) % 2)
    for kind in ("brace", "bracket"):
        start = start.withColumn(kind, F.when(F.col("start") == 1, F.col(f"t.{kind}1")).otherwise(F.col(f"t.{kind}0")))
    return start.select("file", "block", "start", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_before") for k in ("brace", "bracket")])


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """file, at (place of the feature's end), text of every feature of the collections under ``path``."""
    pieces = materialise(_pieces(spark, path), "geojson-pieces", measure=False).df
    states = F.broadcast(_range_states(pieces))                    # a row for each byte range
    known = pieces.join(states, ["file", "block"])
    depth = {k: F.col(f"{k}_before") + F.when(F.col("start") == 1, F.col(f"{k}1")).otherwise(F.col(f"{k}0")) for k in ("brace", "bracket")}
    ends = (depth["brace"] == 1) & (depth["bracket"] == 1) & ((F.col("start") + F.col("sum_quotes")) % 2 == 0)
    known = known.select("file", "block", "seq", "value", ends.alias("ends"))
    place = F.struct("block", "seq")
    marks = known.groupBy("file", "block").agg(F.max(F.when(F.col("ends"), place)).alias("mark"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("file", "block", F.last("mark", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # the last end before a piece names its feature
    named = (known.join(F.broadcast(carried), ["file", "block"])
             .withColumn("after", F.coalesce(F.last(F.when(F.col("ends"), place), ignorenulls=True).over(inside), F.col("carried"))))
    found = (named.groupBy("file", "after").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"),
                                                F.max(F.when(F.col("ends"), place)).alias("at"))
             .where(F.col("at").isNotNull()))
    text = F.concat(F.concat_ws("}", F.transform("parts", lambda p: p["value"])), F.lit("}"))
    # before the first feature of a file stands the head of the collection
    head = F.when(F.col("after").isNull(), F.regexp_replace(text, r'(?s)^.*?"features"\s*:\s*\[\s*', "")).otherwise(F.regexp_replace(text, r"^[\s,]+", ""))
    return found.select("file", "at", head.alias("text"))


def read_geojson_features(spark: SparkSession, path: str, properties: T.StructType = GEOJSON_PROPERTIES) -> DataFrame:
    """file, at, type, properties, geometry (WKT) of every feature."""
    one = geojson_schema(properties)["features"].dataType.elementType
    f = feature_texts(spark, path).select("file", "at", F.from_json("text", one).alias("feature"))
    geom = G.st_geom_from_geojson(F.to_json(F.col("feature.geometry")))
    return f.select("file", "at", F.col("feature.type").alias("type"), F.col("feature.properties").alias("properties"),
                    G.st_as_text(geom).alias("geometry"))
