"""Points and zone cells stored in buckets of the cell, joined without a shuffle.

For zone sides above the broadcast limit that are joined again and again: both tables are written
once in the same number of buckets, and every later join reads bucket against bucket.  A join of
bucketed tables has one task a bucket and cannot be split at run time, so hot cells are split
when the points are written: a cell with more than ``1 / (2 * buckets)`` of all points gets several slices
(at most ``2 * buckets`` cells can be that hot, so their list is small at any size), its points are dealt over
them, and the zone side repeats its row for each slice.  The list is kept as ``<points table>_hot``.

Points without a cell are kept in the table and meet nothing; repeated rows stay; zone cells of any
number of zones may repeat.  Pick ``buckets`` so that one holds 128 to 256 MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = "cell_slice"


def save_points(points: DataFrame, cell_col: str, table: str, buckets: int) -> DataFrame:
    """Write points (cell column renamed to ``cell``) in buckets; returns the table."""
    spark = points.sparkSession
    own = points.withColumnRenamed(cell_col, "cell")
    counts = own.where(F.col("cell").isNotNull()).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("total", F.lit(own.count()).cast("long"))
    hot = counts.where(F.col("n") * (2 * buckets) > F.col("total")).select(
        "cell", F.ceil(F.col("n") * (2 * buckets) / F.col("total")).cast("int").alias("slices"))
    hot.coalesce(1).write.mode("overwrite").saveAsTable(f"{table}_hot")
    # by the hash of its place a row is dealt apart from its equals
    dealt = (own.withColumn("__at", F.monotonically_increasing_id())
             .join(F.broadcast(spark.table(f"{table}_hot")), "cell", "left")
             .withColumn(SLICE, F.coalesce(F.pmod(F.xxhash64("__at"), F.col("slices")).cast("int"), F.lit(0))).drop("__at", "slices"))
    _save(dealt, table, buckets)
    return spark.table(table)


def save_cells(cells: DataFrame, cell_col: str, table: str, points_table: str) -> DataFrame:
    """Write zone cells in the buckets and slices of ``points_table``; returns the table."""
    spark = cells.sparkSession
    hot = F.broadcast(spark.table(f"{points_table}_hot"))
    spread = cells.withColumnRenamed(cell_col, "cell").join(hot, "cell", "left").withColumn(
        SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1))).drop("slices")
    _save(spread, table, bucket_number(spark, points_table))
    return spark.table(table)


def _save(df: DataFrame, table: str, buckets: int) -> None:
    # one file a bucket: the exchange hashes as the buckets do
    (df.repartition(buckets, "cell", SLICE).write.mode("overwrite")
     .bucketBy(buckets, "cell", SLICE).sortBy("cell", SLICE).saveAsTable(table))


def bucket_number(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == "Num Buckets").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed")
    return int(rows[0]["data_type"])


def bucketed_cell_join(spark: SparkSession, points_table: str, cells_table: str) -> DataFrame:
    """The rows of ``spatial_join.cell_join`` over two stored tables; tables in other buckets are an error."""
    if bucket_number(spark, points_table) != bucket_number(spark, cells_table):
        raise ValueError(f"{points_table} and {cells_table} have other numbers of buckets")
    # a sort-merge join keeps the buckets also where the estimate would broadcast a side
    return spark.table(points_table).join(spark.table(cells_table).hint("merge"), ["cell", SLICE]).drop(SLICE)


def drop_points(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}_hot")
