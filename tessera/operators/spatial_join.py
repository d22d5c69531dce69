"""Spatial joins expressed as equi-joins on cell ids.

* ``cell_join``: points with a cell column joined to a zone-cell table (the
  approximate centre-fill join of the reference).
* ``pip_join``: exact point-in-polygon join.  Points are matched to a *cover*
  of each polygon by cells; points in core cells match without a test, points
  in boundary cells get the exact even-odd test against the polygon's edges.
  Never a nested-loop or cartesian join.
* ``pip_first_match``: per point, the value of the first polygon (by an order
  column) that contains it and has a non-null value; null when none.

Dimension sides are materialised to the shared scratch folder and broadcast
only when their measured size fits ``tessera.broadcast.maxBytes``; otherwise
the planner shuffles both sides on the cell and AQE splits hot cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import cells as C
from tessera.functions import geometry as G
from tessera.operators import polyfill as P
from tessera.operators.sizing import Materialised, materialise


def cell_join(points: DataFrame, point_cell: str, zone_cells: DataFrame, zone_cell: str = "cell",
              how: str = "inner") -> DataFrame:
    """Equi-join on cell id; the zone side is size-checked before broadcasting.

    The join is as exact as the cells: a point of a boundary cell matches when the cell's centre
    is inside.  ``refined_cell_join`` tests such points."""
    m = materialise(zone_cells, "zone_cells")
    z = m.for_join()
    if point_cell == zone_cell:
        return points.join(z, point_cell, how)
    return points.join(z, points[point_cell] == z[zone_cell], how)


def ancestor_join(points: DataFrame, point_cell: str, point_res: int, cells: DataFrame, cell_col: str = "cell") -> DataFrame:
    """Points of one resolution joined to cells of mixed resolutions (a compacted fill): a point meets
    the cells that hold its own cell, itself included.

    ``cells`` may be a DataFrame or what ``materialise`` returned for it.  A point gets the ids of its ancestors
    at the levels that occur in ``cells`` (at most 16) as one array, and the exploded ids meet
    the cells in one equi-join, so a compacted fill is never expanded.  Cells finer than the points
    meet none; points without a cell meet none."""
    m = cells if isinstance(cells, Materialised) else materialise(cells, "mixed_cells")
    found = m.df.select(C.cell_res(F.col(cell_col)).alias("r")).distinct().where(F.col("r") <= point_res)
    levels = sorted(r["r"] for r in found.collect())
    own = [F.col(f"`{c}`") for c in points.columns]
    if not levels:
        return points.where(F.lit(False)).join(m.for_join(), F.lit(True))
    # the array is never empty; of a plain explode the optimizer infers a filter on it, pushes that
    # below the projections of the levels and writes each level into the next
    keyed = C.with_ancestors(points, point_cell, point_res, levels, "__up").select(*own, F.explode_outer("__up").alias("__key"))
    z = m.for_join()
    return keyed.withColumn("__key", C.cell_key("__key")).join(z, F.col("__key") == z[cell_col]).drop("__key")


def refined_cell_join(points: DataFrame, lon: str, lat: str, zones: DataFrame, geom_col: str, key: str, res: int,
                      zone_cols: list[str] | None = None, lookup=None) -> DataFrame:
    """Cell join with refinement: points in core cells match at once, those in boundary cells are
    tested against the edges near the cell.  The result is exact at every resolution."""
    return pip_join(points, lon, lat, zones, geom_col, key, res, zone_cols, lookup)


def zone_cover(zones: DataFrame, geom_col: str, key: str, res: int):
    """Materialised cover (key, cell, core) and edge table (key, edges) of the zones."""
    cover = materialise(P.polycover(zones, geom_col, res, key), "zone_cover")
    edges = materialise(zones.select(key, G.st_edges(F.col(geom_col)).alias("edges"))
                        .where(F.col("edges").isNotNull()), "zone_edges")
    return cover, edges


# sliver margin (plane km) added to the bound on how far a lon/lat-straight edge
# bends away from the plane-straight edge the centre fill used
SLIVER_MARGIN_KM = 1e-6


def _sliver_ambiguous(cx: Column, cy: Column, edges: Column) -> Column:
    """True when the centre lies so close to an edge that the centre fill's
    inside/outside status (plane-straight edges) may differ from the exact
    lon/lat status: distance <= KY * max|sin(lat)| * dlat^2 / 8 + margin."""
    X, Y = C.plane_xy(cx, cy)

    def near(e):
        x1, y1 = C.plane_xy(e["x1"], e["y1"])
        x2, y2 = C.plane_xy(e["x2"], e["y2"])
        dx, dy = x2 - x1, y2 - y1
        l2 = dx * dx + dy * dy
        t = F.when(l2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((X - x1) * dx + (Y - y1) * dy) / l2))) \
            .otherwise(F.lit(0.0))
        qx, qy = x1 + t * dx, y1 + t * dy
        dist = F.sqrt((X - qx) * (X - qx) + (Y - qy) * (Y - qy))
        dphi = (e["y2"] - e["y1"]) * F.lit(C.D2R)
        bend = F.lit(C.KY) * F.greatest(F.abs(F.sin(e["y1"] * F.lit(C.D2R))), F.abs(F.sin(e["y2"] * F.lit(C.D2R)))) \
            * dphi * dphi / 8.0
        return dist <= bend + F.lit(SLIVER_MARGIN_KM)

    return F.exists(edges, near)


#: Size of a cell of resolution 0 in degrees, roughly; reference points are moved by small parts of it.
CELL_DEGREES = 10.0
REFERENCE_SHIFT = (0.0137, 0.0071)


def _exact_references(bnd: DataFrame, parts: DataFrame, keys: list[str], res: int) -> DataFrame:
    """Boundary cells whose centre is too close to an edge: a reference point a little off the
    centre, with its status tested against all edges of the part.  The (rare) reference points
    meet the edges in an equi-join on the part and only crossings are counted, so no edge
    list is copied to a cell."""
    size = CELL_DEGREES * 7.0 ** (-res / 2)
    moved = bnd.withColumn("cx", F.col("cx") + size * REFERENCE_SHIFT[0]).withColumn("cy", F.col("cy") + size * REFERENCE_SHIFT[1])
    edges = parts.select(*keys, F.explode(G.st_edges(F.col("__pgeom"))).alias("e")).select(*keys, "e.x1", "e.y1", "e.x2", "e.y2")
    crosses = ((F.col("y1") > F.col("cy")) != (F.col("y2") > F.col("cy"))) & \
        (F.col("cx") < F.col("x1") + (F.col("cy") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    status = (moved.select(*keys, "cell", "cx", "cy").join(edges, keys).groupBy(*keys, "cell")
              .agg((F.sum(crosses.cast("int")) % 2 == 1).alias("centre_in")))
    return moved.drop("centre_in").join(status, [*keys, "cell"])


def zone_lookup(zones: DataFrame, geom_col: str, key: str, res: int, attr_cols: list[str],
                order_col: str):
    """Per cell, the zone parts that may contain a point of the cell, sorted by ``order_col``:
    ``cell -> cands array<struct<order, key, attrs..., core, centre_in, cx, cy, edges>>``.

    A core cell lies inside the part and needs no test.  Otherwise ``edges`` holds the edges of
    the part near the cell, and a point's status is that of the reference point (the centre,
    or a point next to it when the centre lies in the bending sliver of an edge) flipped
    by the parity of the edges crossed on the way there.

    Built once per zone table - pass the result to the joins - with joins and aggregations
    whose groups are bounded by the complexity of the boundary near a cell; materialised
    and measured.
    """
    parts = zones.select(key, F.posexplode(G.st_parts(F.col(geom_col))).alias("__part", "__pgeom"))
    keys = [key, "__part"]
    # written once: both the core and the boundary entries derive from it
    cover = materialise(P.polycover(parts, "__pgeom", res, keys, with_centre=True), "zone_cover",
                        measure=False).df
    near = P.edges_near_cells(parts, "__pgeom", res, keys)
    bnd = (cover.where(~F.col("core")).select(*keys, "cell", "centre_in")
           .join(near, [*keys, "cell"])
           .groupBy(*keys, "cell", "centre_in")
           .agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")))
    ctr = C.cell_centre(F.col("cell"))
    cols = [*keys, "cell", "centre_in", "cx", "cy", "edges"]
    bnd = materialise(bnd.select(*keys, "cell", "centre_in", ctr["lon"].alias("cx"), ctr["lat"].alias("cy"),
                                 "edges"), "zone_boundary", measure=False).df
    close = _sliver_ambiguous(F.col("cx"), F.col("cy"), F.col("edges"))
    local = bnd.where(~close).select(*cols).unionByName(
        _exact_references(bnd.where(close), parts, keys, res).select(*cols)).withColumn("core", F.lit(False))
    core = cover.where(F.col("core")).select(
        *keys, "cell", F.lit(True).alias("centre_in"), F.lit(None).cast("double").alias("cx"),
        F.lit(None).cast("double").alias("cy"), F.array().cast(LOCAL_EDGES).alias("edges"), F.lit(True).alias("core"))
    attrs = zones.select(key, F.col(order_col).alias("__order"), *[F.col(c).alias(f"__a_{c}") for c in attr_cols])
    entries = core.unionByName(local).join(attrs, key)
    cand = F.struct(F.col("__order").alias("order"), F.col(key).alias("key"), *[F.col(f"__a_{c}").alias(c) for c in attr_cols],
                    "core", "centre_in", "cx", "cy", "edges")
    table = entries.groupBy("cell").agg(F.array_sort(F.collect_list(cand)).alias("cands"))
    return materialise(table, "zone_lookup")


LOCAL_EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _hit(c: Column, px: Column, py: Column) -> Column:
    return c["core"] | G.on_any_edge(px, py, c["edges"]) | (
        c["centre_in"] != G.segment_crossing_parity(px, py, c["cx"], c["cy"], c["edges"]))


def _lookup_join(points: DataFrame, lon: str, lat: str, lookup, res: int) -> DataFrame:
    pts = points.withColumn("__cell", C.cell_key(C.cell_from_lonlat(F.col(lon), F.col(lat), res)))
    tab = lookup.for_join().withColumnRenamed("cell", "__cell")
    return pts.join(tab, "__cell", "left")


def pip_join(points: DataFrame, lon: str, lat: str, zones: DataFrame, geom_col: str, key: str,
             res: int = 9, zone_cols: list[str] | None = None, lookup=None) -> DataFrame:
    """All (point, zone) pairs where the zone polygon intersects the point
    (boundary inclusive).  One lookup per point, no shuffle of points while the lookup
    fits the broadcast limit: output = point columns + key + zone_cols.

    ``lookup`` is a zone_lookup of the same zones and resolution with these columns; it is
    built here when none is given."""
    zone_cols = zone_cols or []
    lookup = lookup or zone_lookup(zones, geom_col, key, res, zone_cols, key)
    j = _lookup_join(points, lon, lat, lookup, res)
    px, py = F.col(lon), F.col(lat)
    # a zone is met once however many of its parts hold the point
    hits = F.array_distinct(F.transform(F.filter("cands", lambda c: _hit(c, px, py)),
                                        lambda c: F.struct(c["key"].alias("key"), *[c[z].alias(z) for z in zone_cols])))
    out = j.select(*points.columns, F.explode(hits).alias("__z"))
    return out.select(*points.columns, F.col("__z.key").alias(key), *[F.col(f"__z.{c}").alias(c) for c in zone_cols])


def pip_first_match(points: DataFrame, id_col: str, lon: str, lat: str, zones: DataFrame,
                    geom_col: str, key: str, order_col: str, value_col: str, out_col: str,
                    res: int = 9, lookup=None) -> DataFrame:
    """Points with ``out_col`` = value of the first zone by ``order_col`` that
    contains the point and has a non-null value; null when none.

    Candidates of a cell are pre-sorted by the order, so the answer is the first
    candidate passing its test: a per-row expression after one lookup -- no
    aggregation.  ``lookup`` as for pip_join, ordered by ``order_col``, with ``value_col``."""
    lookup = lookup or zone_lookup(zones, geom_col, key, res, [value_col], order_col)
    j = _lookup_join(points, lon, lat, lookup, res)
    px, py = F.col(lon), F.col(lat)
    first = F.get(F.filter("cands", lambda c: c[value_col].isNotNull() & _hit(c, px, py)), 0)
    return j.select(*points.columns, first[value_col].alias(out_col))
