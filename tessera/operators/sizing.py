"""Materialise dimension tables and broadcast them only behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import remove_scratch, scratch_dir

# default ceiling for a broadcast side; overridable per session with
# spark.conf.set("tessera.broadcast.maxBytes", ...)
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def value_bytes(c: Column, t: T.DataType) -> Column:
    """Bytes of a value in Spark's row format: 8 for each fixed value, strings and binaries
    by their real length, structs and arrays by their real contents at any depth."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        n = F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
    elif isinstance(t, T.StructType):
        n = F.lit(24)
        for f in t.fields:
            n = n + value_bytes(c[f.name], f.dataType)
    elif isinstance(t, T.ArrayType):
        if _fixed(t.elementType):
            n = F.lit(24) + F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0)) * _fixed(t.elementType)
        else:
            n = F.lit(24) + F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda acc, x:
                                                   acc + value_bytes(x, t.elementType).cast("long")), F.lit(0))
    elif isinstance(t, T.MapType):
        n = F.lit(48) + value_bytes(F.map_keys(c), T.ArrayType(t.keyType)) + value_bytes(F.map_values(c), T.ArrayType(t.valueType))
    else:
        n = F.lit(16 if isinstance(t, T.DecimalType) else 8)
    return n


def _fixed(t: T.DataType) -> int | None:
    """Bytes of an array element if all values of the type have the same, else None."""
    if isinstance(t, T.StructType):
        own = [_fixed(f.dataType) for f in t.fields]
        return None if None in own else 24 + sum(max(8, n) for n in own)
    return None if isinstance(t, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 8


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("tessera.broadcast.maxBytes", str(DEFAULT_BROADCAST_MAX_BYTES)))


class Materialised:
    """A DataFrame written to the shared scratch folder, with measured size."""

    def __init__(self, df: DataFrame, rows: int, nbytes: int, path: str):
        self.df = df
        self.rows = rows
        self.nbytes = nbytes
        self.path = path

    def bytes(self) -> int:
        return self.nbytes

    def delete(self) -> None:
        """Remove the files; nothing may read the table any more."""
        remove_scratch(self.df.sparkSession, self.path)

    def for_join(self) -> DataFrame:
        """Broadcast-hinted when the measured size fits, plain otherwise (then the
        planner uses a shuffle join and AQE splits skewed keys)."""
        spark = self.df.sparkSession
        if 0 <= self.bytes() <= broadcast_limit(spark):
            return F.broadcast(self.df)
        return self.df


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) in one aggregation over the real contents."""
    row = F.lit(16)
    for f in df.schema.fields:
        row = row + value_bytes(F.col(f.name), f.dataType)
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes")).first()
    return int(r["rows"]), int(r["bytes"])


def materialise(df: DataFrame, name: str, partition_hint: int | None = None,
                measure: bool = True) -> Materialised:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage (survives executor loss) and measures rows and bytes with one
    aggregation over the written files; the broadcast decision uses that.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    out = df if partition_hint is None else df.repartition(partition_hint)
    out.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    if not measure:               # intermediate that is never broadcast
        return Materialised(back, -1, -1, path)
    rows, nbytes = rows_and_bytes(back)
    return Materialised(back, rows, nbytes, path)
