"""Sinks and catalog operations: overwrite, managed tables, CTAS-if-absent,
drop, database scope, temp views and small-file compaction."""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sizing import rows_and_bytes
from tessera.sources.readers import list_files

DEFAULT_TARGET_FILE_BYTES = 128 * 1024 * 1024
# bytes of rows that one task of a compaction sorts
DEFAULT_SORT_BYTES = 256 * 1024 * 1024


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Overwrite a path table (schema may change) and return it read back."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Managed-table overwrite (``saveAsTable``)."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def ctas_if_absent(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS name USING parquet AS (select)``: a rerun keeps
    the old contents."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet AS ({select_sql})")
    return spark.table(name)


def drop_if_exists(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def use_database(spark: SparkSession, db: str) -> DataFrame:
    """``CREATE DATABASE IF NOT EXISTS db; USE db`` and return ``SHOW TABLES``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql(f"USE {db}")
    return spark.sql("SHOW TABLES")


@contextmanager
def database(spark: SparkSession, db: str):
    """Work in a database of its own; afterwards it is dropped and the former one is current."""
    former = spark.catalog.currentDatabase()
    try:
        use_database(spark, db)
        yield
    finally:
        spark.sql(f"USE {former}")
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def sample_by_hash(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Rows whose hashed key falls into the fraction: the same rows in every run and under any
    partitioning (``DataFrame.sample`` depends on both)."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.where(h < int(fraction * (1 << 32)))


def file_bytes(spark: SparkSession, path: str) -> int:
    """Summed file sizes of a table (a metadata listing, no data read)."""
    return list_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def split_by_range(df: DataFrame, key: str, nbytes: int, target_bytes: int, sort_bytes: int) -> DataFrame:
    """``df`` range-partitioned on ``key`` and sorted, for files of about ``target_bytes`` (``nbytes`` are those of the
    table's files).

    A task sorts about ``sort_bytes`` of rows and no more, so rows that are stored in much fewer bytes than they
    take in memory come in more and smaller files.  Rows of one key may be dealt to several tasks.
    """
    n = max(1, math.ceil(nbytes / target_bytes), math.ceil(rows_and_bytes(df)[1] / sort_bytes))
    dealt = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, key, "__tie").drop("__tie")
    return dealt.sortWithinPartitions(key)


def compact_files(spark: SparkSession, src: str, dst: str, order_by: str | None = None,
                  target_bytes: int = DEFAULT_TARGET_FILE_BYTES, sort_bytes: int = DEFAULT_SORT_BYTES) -> DataFrame:
    """Rewrite a parquet table with few large files (the content is unchanged).

    The file count comes from the summed file sizes; ``order_by`` range-partitions the
    rewrite so parquet min/max statistics let later filters skip row groups, and then
    the bytes of the rows count too (see ``split_by_range``).
    """
    total = file_bytes(spark, src)
    df = spark.read.parquet(src)
    out = split_by_range(df, order_by, total, target_bytes, sort_bytes) if order_by else df.repartition(max(1, math.ceil(total / target_bytes)))
    out.write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)
