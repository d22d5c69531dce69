"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Each source gets a target number of words; every document of the source then has the
same expected number of copies, target / source size.  The documents of a source are put
in a fixed order, the expected copies are prefix-summed, one random offset per source is
added, and a document is emitted once for every integer boundary its interval crosses.

The order runs by size, so the taken words follow the target closely: neighbours in the
order have nearly the same size, and a skipped document is made up by the next one.  Of
``DRAWS`` random offsets a source uses the one whose taken words come nearest its target.

Positions are worked out on narrow rows (keys and sizes); the texts are counted once and
shuffled once, to meet the copies of their rows.

No source is ever sorted in one task.  Its documents fall into size bins, a bin of c
documents into ceil(sqrt(c)) hash buckets, and positions are the sum of three small
prefix counts: bins within the source, buckets within the bin, rows within the bucket.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; a source without words has target 0 and none of its documents is taken; rows
repeated under one doc_id are separate documents; an empty table gives an empty table.
Extra columns are carried along untouched; those of the operator's own output names
(``size``, ``source_size``, ``target``, ``copies``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.sizing import materialise

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: A source's target is at most so many times its size.
MAX_REPEAT = 3
#: Expected copies are held in units of 2**-FRACTION_BITS, so prefix sums are exact.
FRACTION_BITS = 24
#: Random offsets drawn for each source.
DRAWS = 16
OUT = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def size_bin(size: Column) -> Column:
    """Sizes below 16 each have a bin; above, eight bins for every doubling."""
    octave = F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")))
    step = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * 8)
    return F.when(size < 16, size).otherwise(octave * 8 + step).cast("long")


def unit_hash(*cols: Column) -> Column:
    """32 bits of an MD5, as a long (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> + weight, target double.

    Shares the total by weight; no target exceeds ``max_repeat`` sizes.  The level w * L that
    the uncapped sources share is found at once: with sources sorted by the level at which
    they reach their cap, L is the first (total - caps before) / (weights from here on) that
    the source here does not reach.  One row per source is all that is gathered."""
    name_order = [F.col("source").isNull().cast("int"), F.col("source")]
    ranked = sizes.withColumn("__r", F.row_number().over(Window.orderBy(*name_order)) - 1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("__r") % len(weights) + 1).cast("int"))
    ranked = (ranked.withColumn("weight", w.cast("long"))
              .withColumn("__cap", F.col("source_size") * max_repeat))
    by_level = Window.orderBy((F.col("__cap") / F.col("weight")).asc(), F.col("__r"))
    everything = Window.partitionBy()
    caps_before = F.coalesce(F.sum("__cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights_from = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    level = (total - caps_before).cast("double") / weights_from.cast("double")
    lifted = ranked.withColumn("__l", level)
    fits = F.when(F.col("__l") * F.col("weight") <= F.col("__cap"), F.col("__l"))
    lifted = lifted.withColumn("__level", F.max(fits).over(everything))
    share = F.col("__level") * F.col("weight")
    return (lifted.withColumn("target", F.when(share.isNull() | (share >= F.col("__cap")), F.col("__cap").cast("double"))
                              .otherwise(share))
            .select("source", "source_size", "weight", "target"))


def mix(docs: DataFrame, seed: int = 17, weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix emits the row).

    Rows meet their copies by key, source and a hash of the text; rows that agree in all of them
    are told apart by a number."""
    row = F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.xxhash64(text).cast("string"),
                      F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("null")))
    base = docs.drop(*[c for c in OUT if c in docs.columns]).withColumn("__rowkey", row)
    narrow = base.select("__rowkey", F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    copies = (systematic_copies(narrow, seed, weights, max_repeat).groupBy("__rowkey")
              .agg(F.sort_array(F.collect_list(F.struct("copies", *OUT[:3]))).alias("__mixed")))
    number = F.row_number().over(Window.partitionBy("__rowkey").orderBy("__rowkey"))
    met = base.join(copies, "__rowkey").withColumn("__mixed", F.col("__mixed")[number - 1])
    return met.select(*[c for c in docs.columns if c not in OUT], *[F.col("__mixed")[c].alias(c) for c in OUT])


def systematic_copies(docs: DataFrame, seed: int = 17, weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
                      key: str = "doc_id", source: str = "source") -> DataFrame:
    """Rows with a ``size`` (and any other columns, which are carried along) with source_size,
    target and copies.  They pass several shuffles: leave texts out, or use mix()."""
    base = docs.drop(*[c for c in OUT[1:] if c in docs.columns])
    base = materialise(base, "mix-sizes", measure=False).df        # the texts are counted once
    carried = [c for c in base.columns if c != "size"]
    base = (base.withColumn("__source", F.col(source).cast("string"))
            .withColumn("__bin", size_bin(F.col("size")))
            .withColumn("__h", unit_hash(F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")))))
    bins = base.groupBy("__source", "__bin").agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__words"))
    targets = source_targets(bins.groupBy(F.col("__source").alias("source"))
                             .agg(F.sum("__words").alias("source_size")), weights, max_repeat)
    in_source = Window.partitionBy("__source").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    plan = (bins.withColumn("__before_bin", F.coalesce(F.sum("__n").over(in_source), F.lit(0)))
            .withColumn("__buckets", F.ceil(F.sqrt(F.col("__n").cast("double"))))
            .join(targets, F.col("__source").eqNullSafe(F.col("source")))
            .select(F.col("__source").alias("__s"), F.col("__bin").alias("__b"), "__before_bin", "__buckets",
                    F.col("source_size").alias("__size_of"), F.col("target").alias("__target")))
    placed = (base.join(plan, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__bin") == F.col("__b")))
              .withColumn("__bucket", F.col("__h") % F.col("__buckets")))
    counts = placed.groupBy("__s", "__b", "__bucket").agg(F.count(F.lit(1)).alias("__c"))
    in_bin = Window.partitionBy("__s", "__b").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (counts.withColumn("__before_bucket", F.coalesce(F.sum("__c").over(in_bin), F.lit(0)))
              .select(F.col("__s").alias("__s2"), F.col("__b").alias("__b2"), F.col("__bucket").alias("__k2"),
                      "__before_bucket"))
    in_bucket = Window.partitionBy("__s", "__b", "__bucket").orderBy("size", F.col(key).cast("string"))
    ordered = (placed.withColumn("__row", F.row_number().over(in_bucket))
               .join(before, F.col("__s").eqNullSafe(F.col("__s2")) & (F.col("__b") == F.col("__b2"))
                     & (F.col("__bucket") == F.col("__k2"))))
    one = 1 << FRACTION_BITS
    rate = F.when(F.col("__size_of") > 0, F.floor(F.col("__target") / F.col("__size_of") * one)).otherwise(F.lit(0)).cast("long")
    last = F.col("__before_bin") + F.col("__before_bucket") + F.col("__row")
    ordered = ordered.withColumn("__rate", rate).withColumn("__last", last)

    def crossed(offset: Column) -> Column:
        return (F.shiftright(offset + F.col("__rate") * F.col("__last"), FRACTION_BITS)
                - F.shiftright(offset + F.col("__rate") * (F.col("__last") - 1), FRACTION_BITS))

    def offset(k: int) -> Column:
        return unit_hash(F.lit(str(seed)), F.lit(f"offset {k}"),
                         F.coalesce(F.concat(F.lit("s"), F.col("__s")), F.lit("n"))) % one

    taken = ordered.groupBy("__s").agg(F.first("__target").alias("__t"), *[
        F.sum(F.col("size") * crossed(offset(k))).alias(f"__w{k}") for k in range(DRAWS)])
    drawn = F.array_min(F.array(*[F.struct(F.abs(F.col(f"__w{k}") - F.col("__t")).alias("miss"), F.lit(k).alias("k"),
                                           offset(k).alias("offset")) for k in range(DRAWS)]))
    best = taken.select(F.col("__s").alias("__s3"), drawn["offset"].alias("__offset"))
    ordered = ordered.join(best, F.col("__s").eqNullSafe(F.col("__s3")))
    return ordered.select(*carried, "size", F.col("__size_of").alias("source_size"),
                          F.col("__target").alias("target"), crossed(F.col("__offset")).cast("long").alias("copies"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """One row per copy, numbered from 0 in ``copy`` (an own column of that name is replaced)."""
    return (mixed.where(F.col("copies") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")))))


def mix_query(docs: DataFrame, seed: int = 17) -> DataFrame:
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return systematic_copies(sized, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_sql(seed: int = 17) -> str:
    one = 1 << FRACTION_BITS
    h = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT)"
    doc_hash = h.format(f"'{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')")
    off = h.format(f"'{seed}|offset ' || k || '|' || coalesce('s' || source, 'n')")
    return f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
b AS (SELECT *, {doc_hash} AS h,
      CASE WHEN size < 16 THEN size ELSE CAST(floor(log2(CAST(size AS DOUBLE))) * 8
           + floor((size / pow(2.0, floor(log2(CAST(size AS DOUBLE)))) - 1) * 8) AS BIGINT) END AS bin FROM d),
bins AS (SELECT source, bin, count(*) AS n, sum(size) AS words FROM b GROUP BY ALL),
src AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size FROM bins GROUP BY source),
rk AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r FROM src),
wt AS (SELECT *, r % {len(WEIGHTS)} + 1 AS weight, source_size * {MAX_REPEAT} AS cap FROM rk),
lv AS (SELECT *, CAST((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS l FROM wt),
lf AS (SELECT *, max(CASE WHEN l * weight <= cap THEN l END) OVER () AS lev FROM lv),
tg AS (SELECT source, source_size, CASE WHEN lev IS NULL OR lev * weight >= cap THEN CAST(cap AS DOUBLE) ELSE lev * weight END AS target FROM lf),
pl AS (SELECT bins.source, bin, coalesce(sum(n) OVER (PARTITION BY bins.source ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_bin,
      CAST(ceil(sqrt(CAST(n AS DOUBLE))) AS BIGINT) AS buckets, source_size, target
      FROM bins JOIN tg ON bins.source IS NOT DISTINCT FROM tg.source),
p AS (SELECT doc_id, b.source, size, b.bin, h % buckets AS bucket, before_bin, source_size, target
      FROM b JOIN pl ON b.source IS NOT DISTINCT FROM pl.source AND b.bin = pl.bin),
o AS (SELECT *, before_bin + row_number() OVER (PARTITION BY source, bin ORDER BY bucket, size, CAST(doc_id AS VARCHAR)) AS pos FROM p),
x AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * {one}) AS BIGINT) ELSE 0 END AS rate FROM o),
draws AS (SELECT source, k, {off} % {one} AS off FROM src, range({DRAWS}) AS r(k)),
miss AS (SELECT x.source, k, off, abs(sum(size * (((off + rate * pos) // {one}) - ((off + rate * (pos - 1)) // {one}))) - first(target)) AS miss
      FROM x JOIN draws ON x.source IS NOT DISTINCT FROM draws.source GROUP BY x.source, k, off),
best AS (SELECT * FROM miss QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, k) = 1)
SELECT doc_id, size, source_size, target,
       CAST(size * (((off + rate * pos) // {one}) - ((off + rate * (pos - 1)) // {one})) AS BIGINT) AS taken
FROM x JOIN best ON x.source IS NOT DISTINCT FROM best.source"""
