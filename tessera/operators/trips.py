"""Raw trip files (all-text columns, several header vintages) -> typed trip tables.

One ``select`` per vintage: headers are trimmed and lower-cased, mapped to the
clean names through an alias list, cast with ``try_cast`` / guarded ``to_timestamp_ntz``
(bad values become null under ANSI mode instead of failing the job), and put
in the reference's column order.  File sets are read one by one, since each has its
own header; the vintage is told by the header, and an unknown header is an error.
Cab types are combined with ``unionByName(allowMissingColumns=True)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.readers import read_csv_raw

# ---- fixed values: clean schemas and the header aliases of each vintage ----
GREEN_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "store_and_forward", "rate_code_id",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "total_amount", "payment_type", "trip_type",
]
YELLOW_COLUMNS = [c for c in GREEN_COLUMNS if c not in ("ehail_fee", "trip_type")]
GREEN_ALIASES = {
    "vendorid": "vendor_id", "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime", "store_and_fwd_flag": "store_and_forward",
    "ratecodeid": "rate_code_id", "pickup_longitude": "pickup_longitude",
    "pickup_latitude": "pickup_latitude", "dropoff_longitude": "dropoff_longitude",
    "dropoff_latitude": "dropoff_latitude", "passenger_count": "passenger_count",
    "trip_distance": "trip_distance", "fare_amount": "fare_amount", "extra": "extra",
    "mta_tax": "mta_tax", "tip_amount": "tip_amount", "tolls_amount": "tolls_amount",
    "ehail_fee": "ehail_fee", "total_amount": "total_amount", "payment_type": "payment_type",
    "trip_type": "trip_type",
}
YELLOW_ALIASES = {
    "vendor_name": "vendor_id", "trip_pickup_datetime": "pickup_datetime",
    "trip_dropoff_datetime": "dropoff_datetime", "passenger_count": "passenger_count",
    "trip_distance": "trip_distance", "start_lon": "pickup_longitude",
    "start_lat": "pickup_latitude", "rate_code": "rate_code_id",
    "store_and_forward": "store_and_forward", "end_lon": "dropoff_longitude",
    "end_lat": "dropoff_latitude", "payment_type": "payment_type", "fare_amt": "fare_amount",
    "surcharge": "extra", "mta_tax": "mta_tax", "tip_amt": "tip_amount",
    "tolls_amt": "tolls_amount", "total_amt": "total_amount",
}
# later header vintages of the same files
GREEN_2015_ALIASES = {**GREEN_ALIASES, "improvement_surcharge": None}
YELLOW_2010_ALIASES = {
    "vendor_id": "vendor_id", "pickup_datetime": "pickup_datetime", "dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count", "trip_distance": "trip_distance",
    "pickup_longitude": "pickup_longitude", "pickup_latitude": "pickup_latitude", "rate_code": "rate_code_id",
    "store_and_fwd_flag": "store_and_forward", "dropoff_longitude": "dropoff_longitude",
    "dropoff_latitude": "dropoff_latitude", "payment_type": "payment_type", "fare_amount": "fare_amount",
    "surcharge": "extra", "mta_tax": "mta_tax", "tip_amount": "tip_amount", "tolls_amount": "tolls_amount",
    "total_amount": "total_amount",
}
YELLOW_2015_ALIASES = {
    "vendorid": "vendor_id", "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count", "trip_distance": "trip_distance",
    "pickup_longitude": "pickup_longitude", "pickup_latitude": "pickup_latitude", "ratecodeid": "rate_code_id",
    "store_and_fwd_flag": "store_and_forward", "dropoff_longitude": "dropoff_longitude",
    "dropoff_latitude": "dropoff_latitude", "payment_type": "payment_type", "fare_amount": "fare_amount",
    "extra": "extra", "mta_tax": "mta_tax", "tip_amount": "tip_amount", "tolls_amount": "tolls_amount",
    "improvement_surcharge": None, "total_amount": "total_amount",
}
# from the second half of 2016 the files name zones in place of coordinates
ZONE_ALIASES = {"pulocationid": None, "dolocationid": None}
COORDINATES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
GREEN_2016_ALIASES = {k: v for k, v in GREEN_2015_ALIASES.items() if v not in COORDINATES} | ZONE_ALIASES
YELLOW_2016_ALIASES = {k: v for k, v in YELLOW_2015_ALIASES.items() if v not in COORDINATES} | ZONE_ALIASES
COLUMN_TYPES = {
    "vendor_id": "string", "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz",
    "store_and_forward": "string", "rate_code_id": "string", "pickup_longitude": "double",
    "pickup_latitude": "double", "dropoff_longitude": "double", "dropoff_latitude": "double",
    "passenger_count": "int", "trip_distance": "double", "fare_amount": "double",
    "extra": "double", "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double",
    "ehail_fee": "double", "total_amount": "double", "payment_type": "string",
    "trip_type": "string",
}
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# vintage -> (aliases, clean columns that its files do not have)
GREEN_VINTAGES = {
    "green 2013": (GREEN_ALIASES, ()), "green 2015": (GREEN_2015_ALIASES, ()), "green 2016": (GREEN_2016_ALIASES, COORDINATES),
}
YELLOW_VINTAGES = {
    "yellow 2009": (YELLOW_ALIASES, ()), "yellow 2010": (YELLOW_2010_ALIASES, ()),
    "yellow 2015": (YELLOW_2015_ALIASES, ()), "yellow 2016": (YELLOW_2016_ALIASES, COORDINATES),
}
# ----------------------------------------------------------------------------


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim and lower-case every header (``'Trip_type '`` -> ``'trip_type'``)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def rename_columns(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    present = {k: v for k, v in aliases.items() if v and k in df.columns and k != v}
    return df.withColumnsRenamed(present)


def cast_numeric(c: Column, to: str) -> Column:
    """String -> number; empty or malformed text gives null (ANSI-safe)."""
    return F.trim(c).try_cast(to)


def normalise_datetime(c: Column, as_string: bool = False, fmt: str = DATETIME_FORMAT) -> Column:
    """Parse text wall-clock times to TIMESTAMP_NTZ; bad text gives null.

    Trip times carry no zone, so they stay wall-clock values and never pass
    through the session time zone (no shift inside daylight-saving gaps).
    ``as_string`` keeps the reference's text form."""
    ts = F.try_to_timestamp(F.concat(F.trim(c), F.lit(" +0000")), F.lit(f"{fmt} Z"))
    # the instant in UTC, read back as a wall clock: one parse, no session zone
    wall = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=(F.unix_micros(ts) / 1000000).cast("decimal(18,6)"))
    return wall.cast("string") if as_string else wall


def clean_trips(raw: DataFrame, aliases: dict[str, str | None], columns: list[str],
                as_string: bool = False, optional: tuple[str, ...] = ()) -> DataFrame:
    """One select: headers normalised, renamed, typed and ordered.

    A column without a matching header is null if ``optional`` names it, else an error that
    names the headers found."""
    df = rename_columns(normalise_headers(raw), aliases)
    missing = [c for c in columns if c not in df.columns and c not in optional]
    if missing:
        raise ValueError(f"no header for {missing}; headers found: {raw.columns}")
    out = []
    for name in columns:
        if name not in df.columns:
            out.append(F.lit(None).cast(COLUMN_TYPES[name]).alias(name))
            continue
        typ = COLUMN_TYPES[name]
        c = F.col(name)
        if typ == "timestamp_ntz":
            out.append(normalise_datetime(c, as_string).alias(name))
        elif typ == "string":
            out.append(c.alias(name))
        else:
            out.append(cast_numeric(c, typ).alias(name))
    return df.select(*out)


def vintage_of(headers: list[str], vintages: dict) -> str:
    """The vintage whose aliases are exactly the headers; an error names them otherwise."""
    found = {h.strip().lower() for h in headers}
    for name, (aliases, _) in vintages.items():
        if found == set(aliases):
            return name
    raise ValueError(f"headers of no known vintage ({', '.join(vintages)}): {headers}")


def clean_vintage(raw: DataFrame, cab: str, as_string: bool = False) -> DataFrame:
    """Clean one file set of a cab type (green or yellow), by the vintage that its header tells."""
    vintages, columns = (GREEN_VINTAGES, GREEN_COLUMNS) if cab == "green" else (YELLOW_VINTAGES, YELLOW_COLUMNS)
    aliases, optional = vintages[vintage_of(raw.columns, vintages)]
    return clean_trips(raw, aliases, columns, as_string, optional)


def clean_trips_green(raw: DataFrame, as_string: bool = False) -> DataFrame:
    return clean_vintage(raw, "green", as_string)


def clean_trips_yellow(raw: DataFrame, as_string: bool = False) -> DataFrame:
    return clean_vintage(raw, "yellow", as_string)


def read_vintages(spark: SparkSession, paths: list[str], cab: str, as_string: bool = False) -> DataFrame:
    """Raw file sets of one cab type, each read on its own under its own header, as one
    clean table."""
    out = None
    for path in paths:
        own = clean_vintage(read_csv_raw(spark, path), cab, as_string)
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("no paths")
    return out


def union_trips(green: DataFrame, yellow: DataFrame, cab_col: str | None = "cab_type") -> DataFrame:
    """One trip table from both cab types; columns missing in one are null."""
    if cab_col:
        green = green.withColumn(cab_col, F.lit("green"))
        yellow = yellow.withColumn(cab_col, F.lit("yellow"))
    return green.unionByName(yellow, allowMissingColumns=True)
