"""The stateless cell and zone functions applied to a stream of trip files.

The reference has no streaming code; every function of the cell pipeline is a
stateless column expression, so the same plan runs on a ``readStream`` source
with a static (broadcast, size-checked) zone-cell table.  No state store, no
watermark: each micro-batch is tagged independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions import cells as C
from tessera.operators.sizing import materialise


def tag_trips(trips: DataFrame, zone_cells: DataFrame, res: int) -> DataFrame:
    """Pickup cell + zone of every trip (batch or streaming input).

    ``zone_cells`` is (location_id, cell) at ``res``; trips whose cell is in no
    zone keep a null location (left join).  The zone side is a static table;
    pass ``materialise(...).for_join()`` to broadcast it behind a measured size
    check, or a plain DataFrame to let the planner choose.
    """
    t = trips.withColumn("pickup_cell", C.cell_key(
        C.cell_from_lonlat(F.col("pickup_longitude"), F.col("pickup_latitude"), res)))
    z = zone_cells.withColumnRenamed("cell", "pickup_cell")
    return t.join(z, "pickup_cell", "left")


def start_zone_tagging(spark: SparkSession, source_dir: str, schema, zone_cells: DataFrame,
                       res: int, sink_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Tag trip files arriving in ``source_dir`` and append them as parquet.

    Runs with ``availableNow`` (process what is there, then stop); the
    sink and the checkpoint are named by the caller, in a shared folder: a restarted
    driver that names the same ones goes on where the last one stopped.
    """
    stream = spark.readStream.schema(schema).parquet(source_dir)
    zc = materialise(zone_cells, "stream_zone_cells").for_join()
    q = (tag_trips(stream, zc, res).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start())
    return q
