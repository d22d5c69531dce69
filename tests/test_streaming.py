from pyspark.sql import functions as F

from tessera.operators import polyfill as P
from tessera.plans import geo_queries as Q
from tessera.session import scratch_dir
from tessera.sources import fixtures as FX
from tessera.streaming.zone_stream import start_zone_tagging, tag_trips

from conftest import SF_SMALL


def test_stream_equals_batch(spark):
    trips = FX.trips_fx(spark, SF_SMALL).select("trip_id", "pickup_longitude", "pickup_latitude")
    src = scratch_dir(spark, "trip_files")
    trips.repartition(4).write.parquet(src)
    zc = P.polyfill(Q.zones_geom(spark, SF_SMALL), "geom", 7, "location_id")
    sink, checkpoint = scratch_dir(spark, "tagged"), scratch_dir(spark, "tagged_ckpt")
    start_zone_tagging(spark, src, trips.schema, zc, 7, sink, checkpoint).awaitTermination(120)
    # a restart with the same folders finds nothing new
    start_zone_tagging(spark, src, trips.schema, zc, 7, sink, checkpoint).awaitTermination(120)
    streamed = spark.read.parquet(sink).select("trip_id", "location_id")
    batch = tag_trips(trips, zc, 7).select("trip_id", "location_id")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert streamed.where(F.col("location_id").isNotNull()).count() == 1195
