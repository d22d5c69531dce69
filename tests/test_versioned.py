import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators.versioned import VersionedTable, hilbert_number, with_hilbert


def test_hilbert_numbers_are_a_walk_over_all_cells(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    rows = sorted((r["d"], r["x"], r["y"]) for r in df.select("x", "y", hilbert_number("x", "y", 4).alias("d")).collect())
    assert [r[0] for r in rows] == list(range(256))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_places_of_nulls_and_of_a_single_point(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (None, 2.0), (1.0, None)], "x double, y double")
    assert [r["h"] for r in with_hilbert(df, "x", "y", "h").collect()] == [0, 0, None, None]
    assert with_hilbert(df.limit(0), "x", "y", "h").count() == 0


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "points"))
    df = spark.range(40_000).select("id", (F.rand(1) * 0.5 - 74.25).alias("lon"), (F.rand(2) * 0.4 + 40.5).alias("lat"))
    t.write(df.repartition(8), {"parquet.block.size": "65536"})
    return t


def groups_met(path, box):
    """Row groups whose statistics overlap a box, and all."""
    met = n = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            cols = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(3)}
            n += 1
            met += all(cols[k].min <= hi and cols[k].max >= lo for k, (lo, hi) in box.items())
    return met, n


def test_compaction_keeps_the_rows_and_reads_fewer_row_groups(spark, table):
    before, first = table.read(), table.current()
    want = sorted(tuple(r) for r in before.collect())
    box = {"lon": (-74.0, -73.95), "lat": (40.6, 40.64)}
    table.compact("lon", "lat", target_bytes=400_000, options={"parquet.block.size": "65536"})
    assert table.current() != first and sorted(tuple(r) for r in table.read().collect()) == want
    old, new = (groups_met(f"{table.path}/{v}", box) for v in (first, table.current()))
    assert old[0] == old[1] and new[1] > 4 and new[0] <= new[1] / 2
    # readers of the old version go on, until it is dropped
    assert before.count() == 40_000
    assert table.drop_old(keep=1) == [] and table.drop_old(keep=0) == [first]
    assert table.read().count() == 40_000


def test_a_compaction_splits_what_one_task_sorts(spark, tmp_path):
    """300 MB of rows at one place, stored in a few kB: not all of them in one task."""
    t = VersionedTable(spark, str(tmp_path / "wide"))
    rows = spark.range(0, 3000, 1, 4).select("id", F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"), F.repeat(F.lit("x"), F.lit(100_000)).alias("t"))
    t.write(rows)
    t.compact("lon", "lat")
    sizes = [r["n"] for r in t.read().groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 2 and sum(sizes) == 3000 and max(sizes) < 2000
    assert t.read().agg(F.count_distinct("id"), F.sum(F.length("t"))).first() == (3000, 300_000_000)


def test_a_failed_rewrite_leaves_the_current_version(spark, table):
    first = table.current()
    bad = table.read().withColumn("id", F.when(F.col("id") == 39_999, F.raise_error(F.lit("stopped")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stopped"):
        table.write(bad)
    assert table.current() == first and table.read().count() == 40_000
    assert len(table.versions()) <= 2
    table.write(table.read().limit(10))
    assert table.read().count() == 10


def test_a_table_without_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "none"))
    assert t.current() is None and t.versions() == []
    with pytest.raises(FileNotFoundError):
        t.read()
