"""Shared helpers of the training-data operators.

``text_map`` streams (key, text) rows through a numpy/Arrow function in bounded
pieces; the byte helpers below hash words and byte ranges of a whole piece at once;
``connected_components`` labels a graph held in DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.sizing import materialise
from tessera.session import ship_package, table_path

#: Texts are handed to numpy in pieces of about so many bytes (one longer text is a
#: piece of its own).
PIECE_BYTES = 1 << 19

_M64 = (1 << 64) - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id long, text string): the two columns the operators read; a null text is
    empty, every other column (whatever its name) is left out."""
    return docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def spread(df: DataFrame) -> DataFrame:
    """Spread few wide rows over all tasks (round robin, no key)."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1))


def text_map(docs: DataFrame, fn: Callable[[list, list[bytes]], pa.RecordBatch | dict],
             schema: T.StructType | str) -> DataFrame:
    """Apply ``fn(ids, utf8_texts) -> {column: values}`` to (doc_id, text) rows, piece by
    piece, in one narrow pass (no shuffle)."""
    spark = docs.sparkSession
    ship_package(spark)
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in pieces(batches):
            out = fn(ids, texts)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], (pa.Array, pa.ChunkedArray))
                     else pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, st)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Cut Arrow batches of (doc_id, text) into pieces of about PIECE_BYTES."""
    for b in batches:
        ids = b.column(0).to_pylist()
        col = b.column(1)
        lo, size = 0, 0
        lens = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        for i, n in enumerate(lens):
            if i > lo and size + n > PIECE_BYTES:
                yield ids[lo:i], utf8(col.slice(lo, i - lo))
                lo, size = i, 0
            size += n
        if lo < len(ids):
            yield ids[lo:], utf8(col.slice(lo))


def utf8(col: pa.Array) -> list[bytes]:
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def groups_of(batches, keys: list[str]):
    """Successive groups of rows, equal in ``keys``, of sorted Arrow batches."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        change = np.zeros(t.num_rows, dtype=bool)
        for k in keys:
            codes = t.column(k).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        cut = [0, *np.flatnonzero(change).tolist()]
        for s, e in zip(cut, cut[1:], strict=False):
            yield t.slice(s, e - s)
        rest = t.slice(cut[-1])
    if rest is not None and rest.num_rows:
        yield rest


# ---------------------------------------------------------------- numpy byte hashing

#: Fixed odd multipliers of the polynomial hashes (any odd 64-bit numbers do).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(n, 1 << 12).bit_length()
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, b, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = _POWERS[base] = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def range_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of every byte range buf[start:end], equal for equal bytes."""
    p, inv = _powers(base, len(buf) + 1)
    acc = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[:len(buf)], out=acc[1:])
    return mix((acc[ends] - acc[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of the contracts: anything but space and the control characters 9 to 13.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Words without punctuation: ASCII letters and digits, and every non-ASCII byte.
WORDLIKE = np.zeros(256, dtype=bool)
WORDLIKE[48:58] = WORDLIKE[65:91] = WORDLIKE[97:123] = True
WORDLIKE[128:] = True


def flatten(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a line feed after each; offsets has n + 1 entries."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lens + 1, out=offsets[1:])
    return buf, offsets


def word_ranges(buf: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes marked in ``table``."""
    on = np.zeros(len(buf) + 2, dtype=np.int8)
    on[1:-1] = table[buf]
    d = np.diff(on)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def words_of(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, word hashes, first word of each text)
    of a piece; the last array has n + 1 entries."""
    raw, offsets = flatten(texts)
    buf = LOWER[raw]
    s, e = word_ranges(buf, table)
    return buf, s, e, range_hashes(buf, s, e), np.searchsorted(s, offsets)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def sampled(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, keep, limit: int,
            max_chars: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``limit`` labelled rows of each class, as (y, text) in one partition, and how
    many rows each class has: the rows of smallest hash among those that ``keep`` allows and
    whose text has at most ``max_chars`` characters.  The bound limit * 2 * max_chars fits a task."""
    from pyspark.sql import Window
    d = keyed_texts(docs)
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
           .where(keep(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y")))
    order = F.xxhash64(F.col("doc_id"), F.lit("train"))
    few = [lab.where(F.col("y") == y).orderBy(order, "doc_id").limit(2 * limit) for y in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))       # at most 4 * limit rows of two numbers
    w = Window.partitionBy("y").orderBy("__o", "doc_id")
    rows = (d.where(F.length("text") <= max_chars).join(chosen, "doc_id")
            .withColumn("__o", F.xxhash64(F.col("doc_id"), F.lit("train")))
            .withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= limit)
            .select("doc_id", "y", "text").coalesce(1).sortWithinPartitions("doc_id").select("y", "text"))
    totals = {int(r[0]): int(r[1]) for r in lab.groupBy("y").count().collect()}
    return rows, totals


# ---------------------------------------------------------------- graph

def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component): smallest node reachable, for every node of an edge.

    ``edges`` has two long columns.  Alternates the large-star and small-star steps; each
    round is a group minimum and an equi-join, written to the shared folder, until the
    edges no longer change.  Nothing is gathered in one task or on the driver."""
    a, b = edges.columns[:2]
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    table = materialise(e, f"{name}-edges", measure=False)
    seen = None
    while True:
        e = table.df
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        up = big.join(low, "a")
        e = (up.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
             .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        last, table = table, materialise(e, f"{name}-round", measure=False)
        last.delete()
        e = table.df
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
