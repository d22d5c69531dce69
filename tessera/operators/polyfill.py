"""Polygon -> cell sets: centre polyfill, boundary cover, compaction, uncompaction.

Polyfill is a distributed scanline fill in the lattice frame of the target
resolution.  Lattice rows are the lines ``v = b * sqrt(3)/2``; every polygon
edge is exploded into the rows it crosses (half-open rule), crossings are
grouped per (polygon, row), sorted, and paired into intervals; the centres
``u = a + b/2`` inside each interval are exploded into cells.  Work is
proportional to crossings + output cells, never to polygons x candidate
cells, and the only shuffle is the (polygon, row) grouping, which spreads one
huge polygon over many tasks.

A cell is in the fill iff its centre is inside some part (even-odd over the rings of the
part, so each part has its own holes); overlapping parts are united row by row.  Open
rings are closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import cells as C
from tessera.functions import geometry as G
from tessera.operators.sizing import materialise

H = C.HALF_SQRT3
CHUNK = 4096            # most cell centres exploded from one row span by one task


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def geometry_edges(df: DataFrame, geom_col: str, keys, first_part_only: bool = False) -> DataFrame:
    """One row per ring edge: keys..., x1, y1, x2, y2 (lon/lat), part."""
    g = F.col(geom_col)
    if first_part_only:
        g = F.when(g.isNotNull(), G.geometry(g["gtype"], F.slice(g["polys"], 1, 1)))
    k = _keys(keys)
    return (df.select(*k, F.explode(G.st_edges(g)).alias("e"))
            .select(*k, "e.x1", "e.y1", "e.x2", "e.y2", "e.part"))


def row_crossings(edges: DataFrame, res: int, keys) -> DataFrame:
    """keys..., b, part, uc: every crossing of a lattice row with an edge."""
    k = _keys(keys)
    u1, v1 = C.lattice_uv(F.col("x1"), F.col("y1"), res)
    u2, v2 = C.lattice_uv(F.col("x2"), F.col("y2"), res)
    e = edges.select(*k, "part", u1.alias("u1"), v1.alias("v1"), u2.alias("u2"), v2.alias("v2")) \
        .where(F.col("v1") != F.col("v2"))
    b_lo = F.floor(F.least("v1", "v2") / F.lit(H))
    b_hi = F.ceil(F.greatest("v1", "v2") / F.lit(H))
    rows = e.select("*", F.explode(F.sequence(b_lo, b_hi)).alias("b"))
    vb = F.col("b").cast("double") * F.lit(H)
    crossing = (F.col("v1") > vb) != (F.col("v2") > vb)
    uc = F.col("u1") + (vb - F.col("v1")) * (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))
    return rows.where(crossing).select(*k, "b", "part", uc.alias("uc"))


def _intervals(cs: Column) -> Column:
    """Sorted (part, uc) crossings of a row -> its inside intervals, those of several parts
    united.  A closed ring crosses a row an even number of times, so pairs stay in a part."""
    pairs = F.when(F.size(cs) >= 2, F.transform(
        F.sequence(F.lit(0), F.floor(F.size(cs) / 2).cast("int") - 1),
        lambda i: F.struct(cs[i * 2]["uc"].alias("c0"), cs[i * 2 + 1]["uc"].alias("c1"))))

    def unite(acc, s):
        last = F.element_at(acc, -1)
        head = F.slice(acc, 1, F.size(acc) - 1)
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["c1"] >= s["c0"]),
                      F.concat(head, F.array(F.struct(last["c0"].alias("c0"), F.greatest(last["c1"], s["c1"]).alias("c1"))))) \
            .otherwise(F.concat(acc, F.array(s)))

    several = F.element_at(cs, 1)["part"] != F.element_at(cs, -1)["part"]
    return F.when(several, F.aggregate(F.array_sort(pairs), F.array().cast("array<struct<c0:double,c1:double>>"), unite)) \
        .otherwise(pairs)


def polyfill(df: DataFrame, geom_col: str, res: int, keys, first_part_only: bool = False,
             cell_col: str = "cell") -> DataFrame:
    """keys..., cell for every cell of resolution ``res`` whose centre is inside.

    Non-polygonal or null geometries yield no rows (as an exploded empty list).
    """
    k = _keys(keys)
    edges = geometry_edges(df, geom_col, k, first_part_only)
    xs = row_crossings(edges, res, k)
    rows = xs.groupBy(*k, "b").agg(F.array_sort(F.collect_list(F.struct("part", "uc"))).alias("cs"))
    half = F.col("b").cast("double") * F.lit(0.5)
    spans = rows.select(*k, "b", F.explode(_intervals(F.col("cs"))).alias("s"))
    a_lo = F.floor(F.col("s.c0") - half)
    a_hi = F.ceil(F.col("s.c1") - half)
    # split long spans into chunks of at most CHUNK centres and spread them
    # round-robin, so one huge polygon's cells are exploded by many tasks
    chunks = spans.select(*k, "b", "s.c0", "s.c1", a_lo.alias("a_lo"), a_hi.alias("a_hi")) \
        .select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("a_hi") - F.col("a_lo")) / CHUNK)))
                .alias("ch"))
    start = F.col("a_lo") + F.col("ch") * CHUNK
    stop = F.least(F.col("a_hi"), start + (CHUNK - 1))
    chunks = chunks.select(*k, "b", "c0", "c1", start.alias("a0"), stop.alias("a1")) \
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cand = chunks.select(*k, "b", "c0", "c1", F.explode(F.sequence("a0", "a1")).alias("a"))
    uc = F.col("a").cast("double") + half
    inside = (F.col("c0") <= uc) & (uc < F.col("c1"))
    return cand.where(inside).select(*k, C.cell_from_ab(res, F.col("a"), F.col("b")).alias(cell_col))


def polyfill_wkt(df: DataFrame, wkt_col: str, res: int, keys, first_part_only: bool = False,
                 cell_col: str = "cell") -> DataFrame:
    """Polyfill straight from WKT text."""
    g = df.select(*_keys(keys), G.st_geom_from_wkt(F.col(wkt_col)).alias("__g"))
    return polyfill(g, "__g", res, keys, first_part_only, cell_col)


def _edge_samples(df: DataFrame, geom_col: str, res: int, keys) -> DataFrame:
    """keys..., eid, x1, y1, x2, y2, c0: cells of points sampled along every edge
    with a step of at most 1/4 of the centre spacing (in the plane)."""
    k = _keys(keys)
    g = F.col(geom_col)
    e = (df.select(*k, F.posexplode(G.st_edges(g)).alias("eid", "e"))
         .select(*k, "eid", "e.x1", "e.y1", "e.x2", "e.y2"))
    u1, v1 = C.lattice_uv(F.col("x1"), F.col("y1"), res)
    u2, v2 = C.lattice_uv(F.col("x2"), F.col("y2"), res)
    n = (F.ceil(F.sqrt((u2 - u1) * (u2 - u1) + (v2 - v1) * (v2 - v1)) / F.lit(0.25)) + 1).cast("int")
    pts = e.select(*k, "eid", "x1", "y1", "x2", "y2",
                   F.explode(F.sequence(F.lit(0), n)).alias("i"), n.alias("n"))
    t = F.col("i").cast("double") / F.col("n").cast("double")
    px = F.col("x1") + (F.col("x2") - F.col("x1")) * t
    py = F.col("y1") + (F.col("y2") - F.col("y1")) * t
    return pts.select(*k, "eid", "x1", "y1", "x2", "y2", C.cell_from_lonlat(px, py, res).alias("c0")).distinct()


def boundary_cells(df: DataFrame, geom_col: str, res: int, keys, cell_col: str = "cell") -> DataFrame:
    """Cells that may meet the boundary: cells of points sampled along every edge
    (step <= 1/4 centre spacing in the plane) plus their ring-1 neighbours.

    Every point of the boundary lies in one of these cells, so together with the
    centre fill they cover the polygon.
    """
    k = _keys(keys)
    sample = _edge_samples(df, geom_col, res, k).select(*k, "c0").distinct()
    return sample.select(*k, F.explode(C.cell_neighbours(F.col("c0"), res)).alias(cell_col)).distinct()


def edges_near_cells(df: DataFrame, geom_col: str, res: int, keys, ring: int = 2,
                     cell_col: str = "cell") -> DataFrame:
    """keys..., cell, eid, x1, y1, x2, y2: every edge assigned to the cells within
    ``ring`` steps of its sample cells -- a superset of the edges that pass
    through (or within a cell of) each cell.  Work is proportional to the
    boundary length, never to cells x edges."""
    k = _keys(keys)
    s = _edge_samples(df, geom_col, res, k)
    return (s.select(*k, "eid", "x1", "y1", "x2", "y2",
                     F.explode(C.cell_disk(F.col("c0"), res, ring)).alias(cell_col))
            .distinct())


def polycover(df: DataFrame, geom_col: str, res: int, keys, cell_col: str = "cell",
              with_centre: bool = False) -> DataFrame:
    """keys..., cell, core: a cover of each polygon by cells of resolution ``res``.

    ``core`` cells lie wholly inside (no boundary point in them), so a point in a
    core cell is inside without an exact test; other cells need the exact test.
    ``with_centre`` adds ``centre_in`` (the cell centre is inside, lattice frame).
    """
    k = _keys(keys)
    fill = polyfill(df, geom_col, res, k, cell_col=cell_col).withColumn("__in", F.lit(True))
    edge = boundary_cells(df, geom_col, res, k, cell_col).withColumn("__edge", F.lit(True))
    both = fill.join(edge, k + [cell_col], "full_outer")
    inside = F.coalesce(F.col("__in"), F.lit(False))
    cols = [*k, cell_col, (inside & F.col("__edge").isNull()).alias("core")]
    if with_centre:
        cols.append(inside.alias("centre_in"))
    return both.select(*cols)


# ---- compaction ------------------------------------------------------------

#: Levels that one step of the compaction looks at: first over all cells (groups of at most
#: 7**4 cells, which spread well), then over the complete ancestors, 2401 times fewer at most.
FIRST_LEVELS, NEXT_LEVELS = 4, 8


def _aligned_blocks(lo: str, hi: str, levels: int) -> Column:
    """The run of numbers [lo, hi) as the fewest blocks of 7**k aligned numbers, k <= levels:
    array<struct<up, at>>, ``at`` numbered in blocks of 7**up."""
    first = [f"(({lo} + {7 ** k - 1}) div {7 ** k})" for k in range(levels + 1)]
    last = [f"({hi} div {7 ** k})" for k in range(levels + 1)]

    def named(k: int, start: str, stop: str) -> str:
        return (f"transform(IF({start} < {stop}, sequence({start}, {stop} - 1), cast(array() as array<bigint>)), "
                f"x -> named_struct('up', {k}, 'at', x))")

    out = [named(levels, first[levels], last[levels])]
    for k in range(levels):
        above = f"{first[k + 1]} < {last[k + 1]}"          # some block of the next level covers the middle
        out.append(named(k, first[k], f"IF({above}, {first[k + 1]} * 7, {last[k]})"))
        out.append(named(k, f"IF({above}, {last[k + 1]} * 7, {last[k]})", last[k]))
    return F.expr(f"concat({', '.join(out)})")


def compact(df: DataFrame, res: int, keys, cell_col: str = "cell") -> DataFrame:
    """Replace every complete set of 7 siblings by their parent, repeatedly.

    Input: cells of one resolution ``res`` per key; repeated ones count once.  Cells are numbered
    along the hierarchy (``with_path``), so that the descendants of a cell are consecutive.
    The cells under one ancestor ``FIRST_LEVELS`` up meet in one shuffle and are sorted; their runs of
    consecutive numbers are cut into aligned blocks of 7**k numbers, which are the compacted
    cells.  Only ancestors that are complete go on to the next step, at most one row for 2401
    cells; everything else is final and not shuffled again.
    """
    k = _keys(keys)
    opened = C.with_path(df.select(*k, F.col(cell_col).alias("__c")), "__c", res, "u").drop("__c")
    final, lvl, levels = [], res, FIRST_LEVELS
    while True:
        up = min(levels, lvl)
        placed = opened.select(*k, "u", F.expr(f"u div {7 ** up}").alias("g"))
        # consecutive numbers keep their distance from their rank
        rank = F.dense_rank().over(Window.partitionBy(*k, "g").orderBy("u"))
        runs = (placed.withColumn("r", F.col("u") - rank).groupBy(*k, "g", "r")
                .agg(F.min("u").alias("lo"), (F.max("u") + 1).alias("hi")))
        blocks = runs.select(*k, F.explode(_aligned_blocks("lo", "hi", up)).alias("b")).select(*k, "b.up", "b.at")
        if lvl - up == 0:
            final.append((blocks, lvl))
            break
        done = materialise(blocks, "compaction", measure=False).df
        final.append((done.where(F.col("up") < up), lvl))
        opened = done.where(F.col("up") == up).select(*k, F.col("at").alias("u"))
        if opened.isEmpty():
            break
        lvl, levels = lvl - up, NEXT_LEVELS
    out = None
    for blocks, lvl in final:
        part = blocks.select(*k, C.cell_from_path("at", f"{lvl} - up").alias(cell_col))
        out = part if out is None else out.unionByName(part)
    return out


def uncompact(df: DataFrame, res: int, keys, cell_col: str = "cell") -> DataFrame:
    """Expand mixed-resolution cells to all their descendants at ``res`` (no shuffle); a cell
    finer than ``res`` is an error."""
    k = _keys(keys)
    cur = df.select(*k, F.col(cell_col).alias(cell_col))
    for lvl in range(0, res):
        c = F.col(cell_col)
        cur = cur.select(*k, F.explode(F.when(C.cell_res(c) == lvl, C.cell_children(c, lvl))
                                       .otherwise(F.array(c))).alias(cell_col))
    level = C.cell_res(F.col(cell_col))
    ok = F.when(level == res, F.col(cell_col)).otherwise(F.raise_error(F.concat(
        F.lit("uncompact: a cell of resolution "), level.cast("string"), F.lit(f" is finer than {res}"))).cast("long"))
    return cur.select(*k, ok.alias(cell_col))
