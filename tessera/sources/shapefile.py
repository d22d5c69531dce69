"""ESRI shapefile source (``spark.read.format("shapefile").load(dir)``).

Files are opened with local file APIs, so on a cluster the folder must be a
shared mount visible to every executor; other URIs are refused.

A Python data source: the driver only lists ``*.shp`` files and reads each
index (``.shx``) to cut the records into ranges of at most ``recordsPerPartition``;
executors decode their own record range from ``.shp`` (polygons / points) and
``.dbf`` (attribute text) and emit ``geometry`` as WKT plus one string column per
attribute, like the reference's shapefile adapter.  No record passes through the
driver.  Deleted records are left out; a blank attribute is null (the format knows no
empty text); a null shape has a null geometry; other shape types, a folder without
shapefiles, and text or names too long for the format are errors.

``write_shapefiles`` is the matching writer used to produce fixtures: one
``.shp/.shx/.dbf`` triple per partition, written by the executors.
"""

from __future__ import annotations

import glob
import os
import re
import struct
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

# ---- fixed values of the shapefile / dBase formats ------------------------------
SHP_FILE_CODE = 9994
SHP_VERSION = 1000
SHAPE_NULL, SHAPE_POINT, SHAPE_POLYGON = 0, 1, 5
HEADER_BYTES = 100
DBF_VERSION = 0x03
DBF_HEADER_END = 0x0D
DBF_EOF = 0x1A
DBF_DELETED = b"*"
DBF_NAME_BYTES = 10
# ----------------------------------------------------------------------------------


BATCH_ROWS = 10_000


def local_folder(path: str) -> str:
    """The path in the file system; URIs of other schemes are refused."""
    m = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]*):/*", path)
    if m and m[1] != "file":
        raise ValueError(f"shapefiles are read through a shared mount, not from {m[1]}: {path}")
    return "/" + path[m.end():] if m else path


def shapefiles(path: str) -> list[str]:
    found = sorted(glob.glob(os.path.join(path, "*.shp")))
    if not found:
        raise FileNotFoundError(f"no shapefile in {path}")
    return found


def _dbf_fields(path: str) -> tuple[list[tuple[str, int]], int, int, int]:
    """[(name, width)], record count, header length, record length."""
    with open(path, "rb") as f:
        head = f.read(32)
        n, hlen, rlen = struct.unpack("<IHH", head[4:12])
        fields = []
        while True:
            d = f.read(32)
            if not d or d[0] == DBF_HEADER_END:
                break
            name = d[:11].split(b"\x00")[0].decode("ascii")
            fields.append((name, d[16]))
    return fields, n, hlen, rlen


def _signed_area(ring) -> float:
    return sum(ring[i][0] * ring[i + 1][1] - ring[i + 1][0] * ring[i][1] for i in range(len(ring) - 1)) / 2


def _fmt(v: float) -> str:
    return repr(float(v))


def _polygon_wkt(rings) -> str:
    """Clockwise rings start polygons, counter-clockwise rings are holes of the last one."""
    polys = []
    for r in rings:
        if _signed_area(r) <= 0 or not polys:
            polys.append([r])
        else:
            polys[-1].append(r)

    def ring_txt(r):
        return "(" + ", ".join(f"{_fmt(x)} {_fmt(y)}" for x, y in r) + ")"

    def poly_txt(p):
        return "(" + ", ".join(ring_txt(r) for r in p) + ")"

    if len(polys) == 1:
        return "POLYGON " + poly_txt(polys[0])
    return "MULTIPOLYGON (" + ", ".join(poly_txt(p) for p in polys) + ")"


class ShapefilePartition(InputPartition):
    def __init__(self, shp: str, first: int, count: int):
        super().__init__((shp, first, count))
        self.shp, self.first, self.count = shp, first, count


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, per_partition: int, schema: StructType):
        self.path = path
        self.per_partition = per_partition
        self.schema = schema

    def partitions(self):
        parts = []
        for shp in shapefiles(self.path):
            n = (os.path.getsize(shp[:-4] + ".shx") - HEADER_BYTES) // 8
            for first in range(0, n, self.per_partition):
                parts.append(ShapefilePartition(shp, first, min(self.per_partition, n - first)))
        return parts or [ShapefilePartition("", 0, 0)]     # files without records

    def read(self, partition: ShapefilePartition):
        import pyarrow as pa
        schema = pa.schema([(f.name, pa.string()) for f in self.schema.fields])
        rows = self._records(partition)
        while batch := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*batch, strict=True)], schema=schema)

    def _records(self, partition: ShapefilePartition):
        if not partition.count:
            return
        base = partition.shp[:-4]
        with open(base + ".shx", "rb") as f:
            f.seek(HEADER_BYTES + 8 * partition.first)
            index = [struct.unpack(">ii", f.read(8)) for _ in range(partition.count)]
        fields, _, hlen, rlen = _dbf_fields(base + ".dbf")
        names = [f.name for f in self.schema.fields]
        with open(partition.shp, "rb") as shp, open(base + ".dbf", "rb") as dbf:
            dbf.seek(hlen + rlen * partition.first)
            for off, _length in index:
                shp.seek(off * 2 + 8)
                stype = struct.unpack("<i", shp.read(4))[0]
                if stype == SHAPE_POLYGON:
                    shp.read(32)
                    nparts, npoints = struct.unpack("<ii", shp.read(8))
                    starts = list(struct.unpack(f"<{nparts}i", shp.read(4 * nparts))) + [npoints]
                    pts = struct.unpack(f"<{2 * npoints}d", shp.read(16 * npoints))
                    xy = [(pts[2 * i], pts[2 * i + 1]) for i in range(npoints)]
                    wkt = _polygon_wkt([xy[starts[k]:starts[k + 1]] for k in range(nparts)])
                elif stype == SHAPE_POINT:
                    x, y = struct.unpack("<dd", shp.read(16))
                    wkt = f"POINT ({_fmt(x)} {_fmt(y)})"
                elif stype == SHAPE_NULL:
                    wkt = None
                else:
                    raise ValueError(f"shape type {stype} in {partition.shp} is not supported")
                rec = dbf.read(rlen)
                if rec[:1] == DBF_DELETED:
                    continue
                values, pos = {}, 1
                for name, width in fields:
                    values[name] = rec[pos:pos + width].decode("utf-8", "replace").strip() or None
                    pos += width
                values["geometry"] = wkt
                yield tuple(values.get(n) for n in names)


class ShapefileDataSource(DataSource):
    """Options: ``path`` (folder of .shp/.shx/.dbf), ``recordsPerPartition``."""

    @classmethod
    def name(cls):
        return "shapefile"

    def schema(self):
        first = shapefiles(local_folder(self.options.get("path")))[0][:-4] + ".dbf"
        return StructType([StructField("geometry", StringType()),
                           *[StructField(n, StringType()) for n, _ in _dbf_fields(first)[0]]])

    def reader(self, schema: StructType):
        per = int(self.options.get("recordsPerPartition", "100000"))
        return ShapefileReader(local_folder(self.options.get("path")), per, schema)


def register(spark) -> None:
    from tessera.session import ship_package
    ship_package(spark)
    spark.dataSource.register(ShapefileDataSource)


# ---- writer (fixtures) ---------------------------------------------------------------

def _encode_polygon(rings) -> bytes:
    pts = [p for r in rings for p in r]
    xs, ys = [p[0] for p in pts], [p[1] for p in pts]
    starts, acc = [], 0
    for r in rings:
        starts.append(acc)
        acc += len(r)
    body = struct.pack("<i4d", SHAPE_POLYGON, min(xs), min(ys), max(xs), max(ys))
    body += struct.pack("<ii", len(rings), len(pts)) + struct.pack(f"<{len(rings)}i", *starts)
    body += b"".join(struct.pack("<dd", x, y) for x, y in pts)
    return body


def _header(length_words: int, bbox) -> bytes:
    return (struct.pack(">7i", SHP_FILE_CODE, 0, 0, 0, 0, 0, length_words)
            + struct.pack("<2i", SHP_VERSION, SHAPE_POLYGON) + struct.pack("<8d", *bbox, 0, 0, 0, 0))


def write_shapefiles(df: DataFrame, path: str, rings_col: str, attr_cols: list[str],
                     widths: dict[str, int]) -> None:
    """Write one shapefile triple per Arrow batch; ``rings_col`` holds
    array<array<array<double>>> (rings of one polygon, outer ring clockwise)."""
    from tessera.session import ship_package
    ship_package(df.sparkSession)
    path = local_folder(path)
    for c in attr_cols:
        if len(c.encode()) > DBF_NAME_BYTES:
            raise ValueError(f"attribute name {c!r} is longer than {DBF_NAME_BYTES} bytes")
    os.makedirs(path, exist_ok=True)

    def encoded(value, width):
        text = b"" if value is None else str(value).encode("utf-8")
        if len(text) > width:
            raise ValueError(f"{value!r} is longer than its column ({width} bytes)")
        return text.ljust(width, b" ")

    def write_part(batches):
        for rows in batches:
            if len(rows):
                yield write_triple(rows)

    def write_triple(rows):
        import uuid
        import pandas as pd
        base = os.path.join(path, f"part-{uuid.uuid4().hex[:12]}")
        recs = [_encode_polygon([[tuple(p) for p in r] for r in rings]) for rings in rows[rings_col]]
        allpts = [p for rings in rows[rings_col] for r in rings for p in r]
        bbox = (min(p[0] for p in allpts), min(p[1] for p in allpts),
                max(p[0] for p in allpts), max(p[1] for p in allpts))
        shp_len = HEADER_BYTES + sum(8 + len(r) for r in recs)
        with open(base + ".shp", "wb") as shp, open(base + ".shx", "wb") as shx:
            shp.write(_header(shp_len // 2, bbox))
            shx.write(_header((HEADER_BYTES + 8 * len(recs)) // 2, bbox))
            off = HEADER_BYTES
            for i, r in enumerate(recs, start=1):
                shx.write(struct.pack(">ii", off // 2, len(r) // 2))
                shp.write(struct.pack(">ii", i, len(r) // 2) + r)
                off += 8 + len(r)
        rlen = 1 + sum(widths[c] for c in attr_cols)
        with open(base + ".dbf", "wb") as dbf:
            dbf.write(struct.pack("<B3BIHH20x", DBF_VERSION, 124, 1, 1, len(rows),
                                  32 + 32 * len(attr_cols) + 1, rlen))
            for c in attr_cols:
                dbf.write(struct.pack("<11sc4xBB14x", c.encode(), b"C", widths[c], 0))
            dbf.write(bytes([DBF_HEADER_END]))
            for values in zip(*[rows[c] for c in attr_cols], strict=True):
                dbf.write(b" " + b"".join(encoded(v, widths[c]) for v, c in zip(values, attr_cols, strict=True)))
            dbf.write(bytes([DBF_EOF]))
        return pd.DataFrame({"file": [base]})

    df.select(rings_col, *attr_cols).mapInPandas(write_part, "file string").collect()
