"""Parquet tables with versions: a rewrite is prepared beside the table and taken over by one swap.

A table is a folder with one folder for each version and a small file, ``CURRENT``, that names the one
readers take.  A writer finishes its version first and swaps the pointer last, so a failed write
changes nothing, a reader sees one version whole, and readers of an older version go on until
``drop_old`` removes it.  Everything goes through the file system of the path.

``compact`` rewrites the current version with few large files in the order of a Hilbert curve over two
coordinates.  Rows near each other on the map come to lie in the same row groups, whose statistics
let a box filter skip the rest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.tables import DEFAULT_SORT_BYTES, DEFAULT_TARGET_FILE_BYTES, file_bytes, split_by_range

HILBERT_BITS = 16


def hilbert_number(x: str, y: str, bits: int = HILBERT_BITS) -> Column:
    """Place of the cell (x, y), whole numbers from 0 to 2**bits - 1 (SQL text), on the Hilbert curve.

    From the coarsest bit on a quarter is numbered along the curve, and the lower bits are turned into the
    quarter's own direction."""
    step = ("named_struct('x', IF(ry = 1, acc.x, IF(rx = 1, s - 1 - (acc.y & (s - 1)), acc.y & (s - 1))), "
            "'y', IF(ry = 1, acc.y, IF(rx = 1, s - 1 - (acc.x & (s - 1)), acc.x & (s - 1))), 'd', acc.d * 4 + ((3 * rx) ^ ry))")
    step = step.replace("rx", "IF((acc.x & s) = 0, 0L, 1L)").replace("ry", "IF((acc.y & s) = 0, 0L, 1L)")
    sizes = ", ".join(f"{1 << b}L" for b in reversed(range(bits)))
    return F.expr(f"aggregate(array({sizes}), named_struct('x', cast({x} as bigint), 'y', cast({y} as bigint), 'd', 0L), "
                  f"(acc, s) -> {step}, acc -> acc.d)")


def with_hilbert(df: DataFrame, x: str, y: str, out: str, bits: int = HILBERT_BITS) -> DataFrame:
    """``out``: place of (x, y) on the curve over the box that the rows span; rows without a place come first."""
    lo_x, hi_x, lo_y, hi_y = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()

    def cell(c: str, lo, hi) -> str:
        if lo is None or hi <= lo:
            return "0"
        return f"least({(1 << bits) - 1}, floor(({c} - {float(lo)!r}D) / {float(hi - lo)!r}D * {1 << bits}))"

    place = hilbert_number(cell(f"`{x}`", lo_x, hi_x), cell(f"`{y}`", lo_y, hi_y), bits)
    return df.withColumn(out, F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), place))


class VersionedTable:
    """A Parquet table whose contents are swapped whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        where = self._at(self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def current(self) -> str | None:
        """Name of the version that readers take."""
        pointer = f"{self.path}/CURRENT"
        if not self._fs().exists(self._at(pointer)):
            return None
        return self.spark.read.text(pointer).first()[0].strip()

    def versions(self) -> list[str]:
        if not self._fs().exists(self._at(self.path)):
            return []
        return sorted(s.getPath().getName() for s in self._fs().listStatus(self._at(self.path)) if s.getPath().getName().startswith("v"))

    def read(self) -> DataFrame:
        name = self.current()
        if name is None:
            raise FileNotFoundError(f"{self.path} has no current version")
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, df: DataFrame, options: dict[str, str] | None = None) -> str:
        """Write ``df`` as the next version and make it current."""
        number = max((int(v[1:].split("-")[0]) for v in self.versions()), default=0) + 1
        name = f"v{number:08d}-{uuid.uuid4().hex[:8]}"          # writers at the same time do not meet
        df.write.options(**(options or {})).parquet(f"{self.path}/{name}")
        self._swap(name)
        return name

    def _swap(self, name: str) -> None:
        """Replace the pointer by a finished file: one rename."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fresh = self._at(f"{self.path}/next-{name}")
        out = self._fs().create(fresh, True)
        out.write(bytearray(name.encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), conf)
        kinds = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(fresh, self._at(f"{self.path}/CURRENT"), kinds)

    def compact(self, x: str, y: str, target_bytes: int = DEFAULT_TARGET_FILE_BYTES, options: dict[str, str] | None = None,
                sort_bytes: int = DEFAULT_SORT_BYTES) -> str:
        """Rewrite the current version in the order of the curve, in files of about ``target_bytes`` (``split_by_range``)."""
        total = file_bytes(self.spark, f"{self.path}/{self.current()}")
        rows = split_by_range(with_hilbert(self.read(), x, y, "__h"), "__h", total, target_bytes, sort_bytes).drop("__h")
        return self.write(rows, options)

    def drop_old(self, keep: int = 1) -> list[str]:
        """Remove all but the current version and the ``keep`` newest others, and what failed writes left."""
        now = self.current()
        others = [v for v in self.versions() if v != now]
        gone = others[:max(0, len(others) - keep)]
        for v in gone:
            self._fs().delete(self._at(f"{self.path}/{v}"), True)
        return gone
