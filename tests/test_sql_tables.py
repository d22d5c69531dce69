import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import cells as C
from tessera.functions.sqlfuncs import register_sql_functions
from tessera.operators import polyfill as P

L_SHAPE = "POLYGON ((-74 40, -73.5 40, -73.5 40.2, -73.8 40.2, -73.8 40.4, -74 40.4, -74 40), (-73.95 40.05, -73.9 40.05, -73.9 40.1, -73.95 40.1, -73.95 40.05))"
OVERLAP = "MULTIPOLYGON (((0 0, 0.4 0, 0.4 0.4, 0 0.4, 0 0)), ((0.2 0.2, 0.6 0.2, 0.6 0.6, 0.2 0.6, 0.2 0.2)), ((1 1, 1.1 1, 1.1 1.1, 1 1.1)))"


@pytest.fixture(scope="module")
def zones(spark):
    register_sql_functions(spark)
    rows = [(1, L_SHAPE), (2, OVERLAP), (3, None), (4, "POLYGON EMPTY"), (5, "LINESTRING (0 0, 1 1)"), (6, "POINT (1 2)"), (2, OVERLAP)]
    spark.createDataFrame(rows, "k int, wkt string").createOrReplaceTempView("sql_zones")
    return spark.table("sql_zones")


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("res", [0, 5, 8, 9])
def test_fills_equal_the_operator(spark, zones, res):
    want = _rows(P.polyfill_wkt(zones.distinct(), "wkt", res, "k"))
    whole = spark.sql(f"SELECT k, c.cell FROM sql_zones, LATERAL cell_polyfill(wkt, {res}) c")
    parts = spark.sql(f"SELECT k, c.cell FROM sql_zones, LATERAL cell_polyfill_spans(wkt, {res}) s, "
                      f"LATERAL cell_range(s.b, s.a0, s.a1, {res}) c")
    assert _rows(whole.distinct()) == _rows(parts.distinct()) == want
    # a repeated row is filled for itself
    twice = whole.where("k = 2").groupBy("cell").count()
    assert twice.where("count <> 2").count() == 0


def test_a_lateral_call_is_a_generator(spark, zones):
    plan = spark.sql("SELECT k, c.cell FROM sql_zones, LATERAL cell_polyfill_spans(wkt, 8) s, "
                     "LATERAL cell_range(s.b, s.a0, s.a1, 8) c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 2 and "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("res", [7, 8])
def test_compaction_and_expansion(spark, zones, res):
    fill = P.polyfill_wkt(zones.distinct(), "wkt", res, "k")
    fill.groupBy("k").agg(F.collect_list("cell").alias("cells")).createOrReplaceTempView("sql_fills")
    got = spark.sql("SELECT k, c.cell FROM sql_fills, LATERAL cell_compact(cells) c")
    assert _rows(got) == _rows(P.compact(fill, res, "k"))
    got.createOrReplaceTempView("sql_compacted")
    back = spark.sql(f"SELECT k, u.descendant FROM sql_compacted, LATERAL cell_uncompact(cell, {res}) u")
    assert _rows(back) == _rows(fill)


@pytest.mark.parametrize("res", [0, 1, 2, 9, 12, 15])
def test_children_of_any_cell_give_it_back(spark, zones, res):
    rng = random.Random(res)
    pts = [(rng.uniform(-180, 180), rng.uniform(-70, 70)) for _ in range(50)]
    own = spark.createDataFrame(pts, "x double, y double").select(C.cell_from_lonlat("x", "y", res).alias("cell")).distinct()
    own.createOrReplaceTempView("sql_cells")
    below = min(res + 2, C.MAX_RES)
    down = spark.sql(f"SELECT cell, u.descendant FROM sql_cells, LATERAL cell_uncompact(cell, {below}) u")
    assert down.where(C.cell_res("descendant") != below).count() == 0
    assert _rows(down) == _rows(P.uncompact(own.select("cell", F.col("cell").alias("d")), below, "cell", "d"))
    down.groupBy("cell").agg(F.collect_list("descendant").alias("cells")).createOrReplaceTempView("sql_down")
    back = spark.sql("SELECT d.cell AS was, c.cell FROM sql_down d, LATERAL cell_compact(cells) c")
    if below > res:
        assert _rows(back) == sorted((r.cell, r.cell) for r in own.collect())


def test_awkward_arrays(spark, zones):
    one = spark.sql("SELECT cell_compact_array(array()) AS a, cell_compact_array(null) AS b, cell_polyfill_array(null, 5) AS c, "
                    "cell_compact_array(array(null, cell_from_lonlat(1D, 2D, 5), cell_from_lonlat(1D, 2D, 5))) AS d, "
                    "cell_from_lonlat(1D, 2D, 5) AS cell").first()
    assert (one.a, one.b, one.c, one.d) == (None, None, None, [one.cell])
    with pytest.raises(Exception, match="several resolutions"):
        spark.sql("SELECT cell_compact_array(array(cell_from_lonlat(1D, 2D, 5), cell_from_lonlat(1D, 2D, 6)))").collect()
    with pytest.raises(Exception, match="finer than 3"):
        spark.sql("SELECT u.* FROM (SELECT cell_from_lonlat(1D, 2D, 5) AS c), LATERAL cell_uncompact(c, 3) u").collect()


def test_an_array_over_the_bound_is_an_error(spark, zones):
    with pytest.raises(Exception, match="cell_polyfill_spans"):
        spark.sql("SELECT size(cell_polyfill_array('POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))', 12))").collect()
    n = spark.sql("SELECT sum(s.a1 - s.a0 + 1) FROM LATERAL cell_polyfill_spans('POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))', 12) s").first()[0]
    assert n > 1 << 22
