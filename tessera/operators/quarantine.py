"""Malformed records of headered CSV files go to a side table; values lost to casts are counted.

``split_records`` reads the lines of one file set once and tells for each record whether it fits the header:
too few fields, too many fields, or a quoted field that is not closed before its delimiter.  Records
that fit are parsed; every other line is kept whole with its file and reason, so records in = parsed +
quarantined.  Blank lines and repeats of the header line are no records.  Quoted fields may hold
delimiters and quotes, but no line breaks.  In a line with ``\\"`` the backslash escapes quotes, as in the raw
reader; in any other a doubled quote is one quote (the raw reader keeps both and ends the field at the
next delimiter).

``lost_values`` counts, per clean column, the values that were text and became null in the cast, and the
empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import trips as TR

# a quoted field from its delimiter to the next one
QUOTED = r'(?<![^,])"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"(?=,|$)'


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, each computed once for a row however often later steps use it (a generator keeps the
    optimiser from putting a column's expression into each of its uses)."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def split_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records as text columns, quarantine: file, reason, fields, line) of one file set."""
    header = spark.read.option("header", "true").csv(path).columns
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    schema = ", ".join([f"c{i} STRING" for i in range(len(header))] + ["misfit STRING"])
    names = F.when(F.contains("value", F.lit('\\"')), F.from_csv("value", schema, {"columnNameOfCorruptRecord": "misfit"})) \
        .otherwise(F.from_csv("value", schema, {"columnNameOfCorruptRecord": "misfit", "escape": '"'}))
    own = F.array(*map(F.lit, header))
    values = F.array(*[F.col(f"r.c{i}") for i in range(len(header))])
    bare = F.when(F.contains("value", F.lit('"')), F.regexp_replace("value", QUOTED, "")).otherwise(F.col("value"))
    fields = F.length("bare") - F.length(F.replace(F.col("bare"), F.lit(","))) + 1
    n = len(header)
    reason = (F.when(F.col("bare").rlike('(?<![^,])"'), "broken quote").when(F.col("fields") < n, "too few fields")
              .when(F.col("fields") > n, "too many fields"))
    counted = once(once(lines.where(F.trim("value") != ""), bare=bare), fields=fields)
    told = (once(once(counted, reason=reason), r=F.when(F.col("reason").isNull(), names))
            .withColumn("reason", F.when(F.col("r.misfit").isNotNull(), "broken quote").otherwise(F.col("reason")))
            .where(F.col("r").isNull() | ~values.eqNullSafe(own)))
    good = told.where(F.col("reason").isNull()).select(*[F.col(f"r.c{i}").alias(h) for i, h in enumerate(header)])
    bad = told.where(F.col("reason").isNotNull()).select("file", "reason", "fields", F.col("value").alias("line"))
    return good, bad


def clean_with_quarantine(spark: SparkSession, paths: list[str], cab: str, as_string: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean trips, quarantine) of several file sets of one cab type, each under its own header."""
    clean = bad = None
    for path in paths:
        good, rest = split_records(spark, path)
        own = TR.clean_vintage(good, cab, as_string)
        clean = own if clean is None else clean.unionByName(own)
        bad = rest if bad is None else bad.unionByName(rest)
    if clean is None:
        raise ValueError("no paths")
    return clean, bad


def lost_values(raw: DataFrame, cab: str) -> DataFrame:
    """column, became_null, empty: one row for each clean column that the files have (one pass)."""
    vintages, columns = (TR.GREEN_VINTAGES, TR.GREEN_COLUMNS) if cab == "green" else (TR.YELLOW_VINTAGES, TR.YELLOW_COLUMNS)
    aliases, _ = vintages[TR.vintage_of(raw.columns, vintages)]
    named = TR.rename_columns(TR.normalise_headers(raw), aliases)
    counts = []
    for name in [c for c in columns if c in named.columns]:
        c, typ = F.col(name), TR.COLUMN_TYPES[name]
        empty = c.isNull() | (F.trim(c) == "")
        value = c if typ == "string" else TR.normalise_datetime(c) if typ == "timestamp_ntz" else TR.cast_numeric(c, typ)
        counts.append(F.struct(F.lit(name).alias("column"), F.count_if(~empty & value.isNull()).alias("became_null"),
                               F.count_if(empty).alias("empty")))
    return named.agg(F.array(*counts).alias("c")).select(F.inline("c"))
