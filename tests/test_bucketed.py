import pytest
from pyspark.sql import functions as F

from tessera.operators import bucketed as BK


@pytest.fixture
def tables(spark):
    # one cell holds half of all points, among them equal rows; some points have no cell
    pts = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 300)
                                   .cast("long").alias("c"), (F.col("id") % 40).alias("v"))
    cells = spark.range(0, 200).select(F.col("id").alias("cell"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("zone"))
    BK.save_points(pts, "c", "t_points", 8)
    BK.save_cells(cells, "cell", "t_cells", "t_points")
    yield pts, cells
    BK.drop_points(spark, "t_points")
    spark.sql("DROP TABLE t_cells")


def test_join_without_exchange_equals_the_plain_join(spark, tables):
    pts, cells = tables
    got = BK.bucketed_cell_join(spark, "t_points", "t_cells")
    want = pts.withColumnRenamed("c", "cell").join(cells, "cell")
    assert sorted(map(tuple, got.select("cell", "v", "zone").collect())) == sorted(map(tuple, want.select("cell", "v", "zone").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert spark.table("t_points").count() == 4000


def test_a_hot_cell_is_dealt_over_its_slices(spark, tables):
    by = spark.table("t_points").groupBy("cell", BK.SLICE).count()
    hot = [r["count"] for r in by.where("cell = 7").collect()]
    assert len(hot) >= 8 and sum(hot) >= 2000 and max(hot) <= 2 * 4000 / 16
    assert by.where("cell <> 7").where(F.col(BK.SLICE) > 0).count() == 0


def test_other_buckets_are_refused(spark, tables):
    spark.range(3).write.saveAsTable("t_plain")
    try:
        with pytest.raises(ValueError, match="not bucketed"):
            BK.bucketed_cell_join(spark, "t_points", "t_plain")
    finally:
        spark.sql("DROP TABLE t_plain")


def test_empty_tables(spark):
    BK.save_points(spark.createDataFrame([], "c long, v int"), "c", "t_none", 4)
    BK.save_cells(spark.createDataFrame([], "cell long, zone string"), "cell", "t_none_cells", "t_none")
    assert BK.bucketed_cell_join(spark, "t_none", "t_none_cells").count() == 0
    BK.drop_points(spark, "t_none")
    spark.sql("DROP TABLE t_none_cells")
