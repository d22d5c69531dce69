from pyspark.sql import functions as F

from tessera.operators import trips as TR
from tessera.sources import fixtures as FX

from conftest import SF_SMALL


def test_bad_values_become_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", "True")
    raw = FX.trips_raw_green_fx(spark, SF_SMALL)
    clean = TR.clean_trips_green(raw)
    assert clean.columns == TR.GREEN_COLUMNS
    out = raw.select(TR.cast_numeric(F.col("Passenger_count"), "int").alias("p"),
                     F.col("Passenger_count").alias("t")).where(F.col("t").isin("x", ""))
    assert out.count() > 0 and out.where(F.col("p").isNotNull()).count() == 0


def test_header_trailing_space_and_case(spark):
    df = spark.createDataFrame([("1", "2")], ["Trip_type ", "VendorID"])
    n = TR.normalise_headers(df)
    assert n.columns == ["trip_type", "vendorid"]
    others = tuple(c for c in TR.GREEN_COLUMNS if c not in ("trip_type", "vendor_id"))
    clean = TR.clean_trips(df, TR.GREEN_ALIASES, TR.GREEN_COLUMNS, optional=others)
    r = clean.first()
    assert r.trip_type == "1" and r.vendor_id == "2"


def test_datetime_text_form_and_bad(spark):
    df = spark.createDataFrame([("2019-01-02 03:04:05",), ("bad",), (None,)], "t string")
    out = [r.d for r in df.select(TR.normalise_datetime(F.col("t"), as_string=True).alias("d")).collect()]
    assert out == ["2019-01-02 03:04:05", None, None]


def test_union_fills_missing_columns(spark):
    g = TR.clean_trips_green(FX.trips_raw_green_fx(spark, SF_SMALL))
    y = TR.clean_trips_yellow(FX.trips_raw_yellow_fx(spark, SF_SMALL))
    u = TR.union_trips(g, y)
    assert u.where((F.col("cab_type") == "yellow") & F.col("ehail_fee").isNotNull()).count() == 0
    assert u.count() == g.count() + y.count()
