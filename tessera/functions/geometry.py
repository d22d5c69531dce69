"""Vector geometry as plain Spark columns.

A geometry value is ``struct<gtype: string, polys: array<array<array<array<double>>>>>``
(part -> ring -> vertex -> [x, y]); a Polygon is a one-part value, a Point a
one-part, one-ring, one-vertex value.  Parsing, printing and predicates are
built from ``regexp_replace``/``from_json``/``transform``/``aggregate``, so they
run inside the JVM with no Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import projections as PJ

POLYS_TYPE = "array<array<array<array<double>>>>"
GEOM_TYPE = T.StructType([
    T.StructField("gtype", T.StringType()),
    T.StructField("polys", T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))),
])
EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double,part:int>>"

# ---- fixed values: geometry type names as written in WKT / GeoJSON ------
WKT_POINT = "POINT"
WKT_POLYGON = "POLYGON"
WKT_MULTIPOLYGON = "MULTIPOLYGON"
GEOJSON_NAMES = {"POINT": "Point", "POLYGON": "Polygon", "MULTIPOLYGON": "MultiPolygon"}
# -------------------------------------------------------------------------

_NUM = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def geometry(gtype: Column, polys: Column) -> Column:
    return F.struct(gtype.alias("gtype"), polys.cast(POLYS_TYPE).alias("polys"))


# ---- constructors --------------------------------------------------------

def st_make_point(x, y) -> Column:
    """Point(x, y) = Point(lon, lat); null if either coordinate is null."""
    x, y = _c(x).cast("double"), _c(y).cast("double")
    pt = geometry(F.lit(WKT_POINT), F.array(F.array(F.array(F.array(x, y)))))
    return F.when(x.isNotNull() & y.isNotNull(), pt)


def st_geom_from_wkt(text) -> Column:
    """Parse POINT / POLYGON / MULTIPOLYGON WKT (any case, EMPTY allowed).

    Numbers may carry signs and exponents.  Text that does not parse gives null.
    """
    t = F.upper(F.trim(_c(text)))
    gtype = F.regexp_extract(t, r"^([A-Z]+)", 1)
    body = F.trim(F.regexp_replace(t, r"^[A-Z]+", ""))
    # "x y" -> [x,y]; parentheses -> brackets; the result is JSON
    js = F.translate(
        F.regexp_replace(body, rf"({_NUM})\s+({_NUM})", "[$1,$2]"), "()", "[]")
    empty = body == F.lit("EMPTY")
    poly = F.from_json(js, "array<array<array<double>>>")
    multi = F.from_json(js, POLYS_TYPE)
    pt = F.from_json(js, "array<array<double>>")
    polys = (F.when(empty, F.array().cast(POLYS_TYPE))
             .when(gtype == WKT_MULTIPOLYGON, multi)
             .when(gtype == WKT_POLYGON, F.when(poly.isNotNull(), F.array(poly)))
             .when(gtype == WKT_POINT, F.when(pt.isNotNull(), F.array(F.array(pt)))))
    ok = polys.isNotNull() & gtype.isin(WKT_POINT, WKT_POLYGON, WKT_MULTIPOLYGON)
    return F.when(ok, geometry(gtype, polys))


def st_geom_from_geojson(js) -> Column:
    """Parse a GeoJSON geometry object (Point / Polygon / MultiPolygon)."""
    raw = F.from_json(_c(js), "struct<type:string, coordinates:string>")
    typ = F.upper(raw["type"])
    coords = raw["coordinates"]
    polys = (F.when(typ == WKT_MULTIPOLYGON, F.from_json(coords, POLYS_TYPE))
             .when(typ == WKT_POLYGON,
                   F.array(F.from_json(coords, "array<array<array<double>>>")))
             .when(typ == WKT_POINT,
                   F.array(F.array(F.array(F.from_json(coords, "array<double>"))))))
    return F.when(polys.isNotNull(), geometry(typ, polys))


# ---- printers ------------------------------------------------------------

def _num_text(v: Column) -> Column:
    return v.cast("string")


def _ring_text(r: Column) -> Column:
    return F.concat(F.lit("("), F.concat_ws(", ", F.transform(
        r, lambda p: F.concat(_num_text(p[0]), F.lit(" "), _num_text(p[1])))), F.lit(")"))


def _poly_text(p: Column) -> Column:
    return F.concat(F.lit("("), F.concat_ws(", ", F.transform(p, _ring_text)), F.lit(")"))


def st_as_text(geom) -> Column:
    """WKT text of a geometry struct."""
    g = _c(geom)
    polys = g["polys"]
    body = (F.when(F.size(polys) == 0, F.lit(" EMPTY"))
            .when(g["gtype"] == WKT_MULTIPOLYGON, F.concat(F.lit(" ("), F.concat_ws(
                ", ", F.transform(polys, _poly_text)), F.lit(")")))
            .when(g["gtype"] == WKT_POLYGON, F.concat(F.lit(" "), _poly_text(polys[0])))
            .otherwise(F.concat(F.lit(" ("), _num_text(polys[0][0][0][0]), F.lit(" "),
                                _num_text(polys[0][0][0][1]), F.lit(")"))))
    return F.when(g.isNotNull(), F.concat(g["gtype"], body))


def st_as_geojson(geom) -> Column:
    g = _c(geom)
    name = (F.when(g["gtype"] == WKT_MULTIPOLYGON, F.lit(GEOJSON_NAMES[WKT_MULTIPOLYGON]))
            .when(g["gtype"] == WKT_POLYGON, F.lit(GEOJSON_NAMES[WKT_POLYGON]))
            .otherwise(F.lit(GEOJSON_NAMES[WKT_POINT])))
    coords = (F.when(g["gtype"] == WKT_MULTIPOLYGON, F.to_json(g["polys"]))
              .when(g["gtype"] == WKT_POLYGON, F.to_json(g["polys"][0]))
              .otherwise(F.to_json(g["polys"][0][0][0])))
    return F.when(g.isNotNull(), F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'),
                                          coords, F.lit("}")))


# ---- accessors -----------------------------------------------------------

def st_geometry_type(geom) -> Column:
    return _c(geom)["gtype"]


def st_num_geometries(geom) -> Column:
    return F.size(_c(geom)["polys"])


def st_geometry_n(geom, n: int) -> Column:
    """Part n (0-based) as a Polygon, null when out of range."""
    g = _c(geom)
    part = F.get(g["polys"], F.lit(n))
    return F.when(part.isNotNull(), geometry(F.lit(WKT_POLYGON), F.array(part)))


def st_coordinates(geom, lat_first: bool = False) -> Column:
    """All vertices (parts, rings in order) as array<array<double>>."""
    pts = F.flatten(F.flatten(_c(geom)["polys"]))
    if lat_first:
        pts = F.transform(pts, lambda p: F.array(p[1], p[0]))
    return pts


def st_num_points(geom) -> Column:
    return F.size(st_coordinates(geom))


def st_x(geom) -> Column:
    return _c(geom)["polys"][0][0][0][0]


def st_y(geom) -> Column:
    return _c(geom)["polys"][0][0][0][1]


def st_bbox(geom) -> Column:
    """struct<xmin, ymin, xmax, ymax>."""
    pts = st_coordinates(geom)
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def st_parts(geom) -> Column:
    """Each part as a geometry of its own: array<geometry>."""
    g = _c(geom)
    return F.transform(g["polys"], lambda p: geometry(F.lit(WKT_POLYGON), F.array(p)))


def closed_ring(r) -> Column:
    """The ring with its first point repeated at the end, if it is not there already."""
    return F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1)))


def st_edges(geom) -> Column:
    """All ring edges, part by part: array<struct<x1,y1,x2,y2,part>>.  Open rings are closed."""
    def ring_edges(ring, part):
        r = closed_ring(ring)
        return F.transform(F.sequence(F.lit(0), F.size(r) - 2),
                           lambda i: F.struct(r[i][0].alias("x1"), r[i][1].alias("y1"),
                                              r[i + 1][0].alias("x2"), r[i + 1][1].alias("y2"),
                                              part.cast("int").alias("part")))

    return F.flatten(F.transform(_c(geom)["polys"], lambda rings, k: F.flatten(F.transform(
        F.filter(rings, lambda r: F.size(r) >= 2), lambda r: ring_edges(r, k)))))


def st_area(geom) -> Column:
    """Planar area in squared coordinate units: outer ring minus holes, per part."""
    def ring_area(r):
        return F.abs(F.aggregate(
            F.sequence(F.lit(0), F.size(r) - 2), F.lit(0.0),
            lambda acc, i: acc + (r[i][0] * r[i + 1][1] - r[i + 1][0] * r[i][1]))) / 2.0

    def part_area(p):
        holes = F.aggregate(F.transform(F.slice(p, 2, 1 << 30), ring_area), F.lit(0.0),
                            lambda acc, a: acc + a)
        return ring_area(p[0]) - holes

    return F.aggregate(F.transform(_c(geom)["polys"], part_area), F.lit(0.0),
                       lambda acc, a: acc + a)


def st_centroid(geom) -> Column:
    """Centroid of a polygonal geometry (area weighted, holes subtract); Point for a point."""
    g = _c(geom)

    def ring_terms(r):
        # (2*signed area, sum cx, sum cy) of one ring by the shoelace formula
        return F.aggregate(
            F.sequence(F.lit(0), F.size(r) - 2),
            F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy")),
            lambda acc, i: F.struct(
                (acc["a"] + (r[i][0] * r[i + 1][1] - r[i + 1][0] * r[i][1])).alias("a"),
                (acc["cx"] + (r[i][0] + r[i + 1][0]) * (r[i][0] * r[i + 1][1] - r[i + 1][0] * r[i][1])).alias("cx"),
                (acc["cy"] + (r[i][1] + r[i + 1][1]) * (r[i][0] * r[i + 1][1] - r[i + 1][0] * r[i][1])).alias("cy")))

    def oriented(r, sign):
        t = ring_terms(r)
        s = F.when(t["a"] >= 0, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.lit(sign)
        return F.struct((t["a"] * s).alias("a"), (t["cx"] * s).alias("cx"), (t["cy"] * s).alias("cy"))

    terms = F.flatten(F.transform(g["polys"], lambda p: F.transform(
        F.sequence(F.lit(0), F.size(p) - 1),
        lambda k: F.when(k == 0, oriented(p[k], 1.0)).otherwise(oriented(p[k], -1.0)))))
    tot = F.aggregate(terms, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy")),
                      lambda acc, t: F.struct((acc["a"] + t["a"]).alias("a"),
                                              (acc["cx"] + t["cx"]).alias("cx"),
                                              (acc["cy"] + t["cy"]).alias("cy")))
    cx = tot["cx"] / (tot["a"] * 3.0)
    cy = tot["cy"] / (tot["a"] * 3.0)
    return (F.when(g["gtype"] == WKT_POINT, g)
            .when(tot["a"] != 0, st_make_point(cx, cy)))


# ---- predicates ----------------------------------------------------------

def point_in_edges(px, py, edges, inclusive: bool = True) -> Column:
    """Point-in-polygon over an edge array: even-odd within a part, any part will do.

    The edges of a part follow one another, as st_edges gives them.  ``inclusive`` counts
    points on an edge or vertex as inside (intersects semantics); otherwise they are
    outside (interior semantics).
    """
    px, py = _c(px), _c(py)

    def step(acc, e):
        x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
        crosses = ((y1 > py) != (y2 > py)) & (px < x1 + (py - y1) * (x2 - x1) / (y2 - y1))
        on_edge = (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) == 0) & \
            (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2)) & \
            (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2))
        same = acc["part"] == e["part"]
        return F.struct((acc["done"] | (~same & acc["inside"])).alias("done"),
                        ((same & acc["inside"]) != crosses).alias("inside"),
                        (acc["edge"] | on_edge).alias("edge"), e["part"].alias("part"))

    start = F.struct(F.lit(False).alias("done"), F.lit(False).alias("inside"), F.lit(False).alias("edge"),
                     F.lit(-1).alias("part"))
    res = F.aggregate(_c(edges), start, step)
    inside = res["done"] | res["inside"]
    if inclusive:
        return res["edge"] | inside
    return ~res["edge"] & inside


def _orient(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def on_any_edge(px, py, edges) -> Column:
    """True when (px, py) lies on one of the edges."""
    px, py = _c(px), _c(py)
    return F.exists(_c(edges), lambda e: (_orient(e["x1"], e["y1"], e["x2"], e["y2"], px, py) == 0)
                    & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
                    & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))


def segment_crossing_parity(px, py, rx, ry, edges) -> Column:
    """Parity of the edges crossed by the segment p -> r.

    Vertices exactly on the line p-r count as lying on its positive side (a
    consistent perturbation), so an edge chain passing through a vertex on the
    segment is counted once.  Valid when neither p nor r lies on an edge.
    """
    px, py, rx, ry = _c(px), _c(py), _c(rx), _c(ry)

    def cross(e):
        sa = _orient(px, py, rx, ry, e["x1"], e["y1"]) >= 0
        sb = _orient(px, py, rx, ry, e["x2"], e["y2"]) >= 0
        tp = _orient(e["x1"], e["y1"], e["x2"], e["y2"], px, py)
        tr = _orient(e["x1"], e["y1"], e["x2"], e["y2"], rx, ry)
        return (sa != sb) & (((tp > 0) & (tr < 0)) | ((tp < 0) & (tr > 0)))

    return F.aggregate(_c(edges), F.lit(False), lambda acc, e: acc != cross(e))


def st_intersects_point(geom, px, py) -> Column:
    """True when point (px, py) lies in the polygonal geometry or on its boundary."""
    g = _c(geom)
    bb = st_bbox(g)
    px, py = _c(px), _c(py)
    in_box = (px >= bb["xmin"]) & (px <= bb["xmax"]) & (py >= bb["ymin"]) & (py <= bb["ymax"])
    return F.when(g.isNotNull() & px.isNotNull() & py.isNotNull(),
                  in_box & point_in_edges(px, py, st_edges(g), inclusive=True))


def st_contains_point(geom, px, py) -> Column:
    """Interior test (boundary excluded)."""
    g = _c(geom)
    return F.when(g.isNotNull() & _c(px).isNotNull() & _c(py).isNotNull(),
                  point_in_edges(px, py, st_edges(g), inclusive=False))


# ---- reprojection --------------------------------------------------------

# ---- fixed values: WGS84 ellipsoid and UTM / web-mercator constants ------
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
# -------------------------------------------------------------------------


def _utm_inverse(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Inverse transverse Mercator (Krueger series, 3 terms) to lon/lat degrees."""
    f = WGS84_F
    n = f / (2 - f)
    a_hat = WGS84_A / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    beta = [n / 2 - 2 * n * n / 3 + 37 * n ** 3 / 96,
            n * n / 48 + n ** 3 / 15,
            17 * n ** 3 / 480]
    delta = [2 * n - 2 * n * n / 3 - 2 * n ** 3,
             7 * n * n / 3 - 8 * n ** 3 / 5,
             56 * n ** 3 / 15]
    xi = (y - F.when(south, F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))) / (UTM_K0 * a_hat)
    eta = (x - F.lit(UTM_FALSE_EASTING)) / (UTM_K0 * a_hat)
    xi_p = xi
    eta_p = eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
        eta_p = eta_p - F.lit(b) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + F.lit(d) * F.sin(chi * (2 * j))
    lon0 = (zone.cast("double") * 6.0 - 183.0)
    lon = lon0 + F.degrees(F.atan2(F.sinh(eta_p), F.cos(xi_p)))
    return lon, F.degrees(lat)


def crs_supported(crs) -> Column:
    """Whether st_reproject knows the CRS (null for a null one): count the rows of which it is
    false beside a reprojection, since those get null coordinates."""
    code = F.regexp_extract(F.upper(F.trim(_c(crs))), r"^EPSG:(\d+)$", 1)
    num = F.when(code != "", code.try_cast("int"))
    known = num.isin(4326, 3857) | PJ.is_conic(num) | num.between(32601, 32660) | num.between(32701, 32760)
    return F.when(_c(crs).isNotNull(), F.coalesce(known, F.lit(False)))


def st_reproject_xy(x, y, src_crs, dst_crs: str = "EPSG:4326") -> Column:
    """Reproject a coordinate pair to lon/lat (EPSG:4326).

    Supported sources: EPSG:4326 (identity), EPSG:3857 (spherical web mercator),
    EPSG:326zz / 327zz (UTM north / south) and the conic and polar codes of
    ``projections``.  Other CRS give null.
    """
    if dst_crs.upper() != "EPSG:4326":
        raise ValueError("only EPSG:4326 is supported as target")
    x, y = _c(x).cast("double"), _c(y).cast("double")
    crs = F.upper(F.trim(_c(src_crs) if isinstance(src_crs, Column) else F.lit(src_crs)))
    code = F.regexp_extract(crs, r"^EPSG:(\d+)$", 1)
    num = F.when(code != "", code.cast("int"))
    is_utm_n = (num >= 32601) & (num <= 32660)
    is_utm_s = (num >= 32701) & (num <= 32760)
    zone = F.when(is_utm_n, num - 32600).when(is_utm_s, num - 32700)
    ulon, ulat = _utm_inverse(x, y, zone, is_utm_s)
    mlon = F.degrees(x / F.lit(WGS84_A))
    mlat = F.degrees(F.atan(F.sinh(y / F.lit(WGS84_A))))
    lon = (F.when(num == 4326, x).when(num == 3857, mlon).when(is_utm_n | is_utm_s, ulon))
    lat = (F.when(num == 4326, y).when(num == 3857, mlat).when(is_utm_n | is_utm_s, ulat))
    conic = PJ.conic_lonlat(x, y, num)
    plain = F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("x"), lat.alias("y")))
    return F.when(PJ.is_conic(num), F.when(conic.isNotNull(), F.struct(conic["lon"].alias("x"), conic["lat"].alias("y")))).otherwise(plain)


def st_reproject(geom, src_crs, dst_crs: str = "EPSG:4326") -> Column:
    """Reproject every vertex of a geometry struct."""
    g = _c(geom)
    crs = _c(src_crs) if isinstance(src_crs, Column) else F.lit(src_crs)

    def vtx(p):
        r = st_reproject_xy(p[0], p[1], crs, dst_crs)
        return F.array(r["x"], r["y"])

    polys = F.transform(g["polys"], lambda part: F.transform(
        part, lambda ring: F.transform(ring, vtx)))
    return F.when(g.isNotNull(), geometry(g["gtype"], polys))
