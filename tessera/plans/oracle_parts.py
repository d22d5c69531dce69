"""SQL text building blocks for the DuckDB oracle.

The oracle re-derives every fixture from the driver's tables with plain SQL and
computes cells, fills and point-in-polygon with independent formulations
(ray casting per candidate instead of the Spark scanline fill).  Constants are
written as ``CAST('<repr>' AS DOUBLE)`` so both engines see identical doubles.
"""

from __future__ import annotations

from tessera.functions import cells as C
from tessera.sources import fixtures as FX


def d(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


H = d(C.HALF_SQRT3)


# ---- cells -----------------------------------------------------------------

def _round(aq: str, bq: str) -> tuple[str, str]:
    sq = f"((-({aq})) - ({bq}))"
    ra, rb, rs = f"floor(({aq}) + {d(0.5)})", f"floor(({bq}) + {d(0.5)})", f"floor({sq} + {d(0.5)})"
    da, db, ds = f"abs({ra} - ({aq}))", f"abs({rb} - ({bq}))", f"abs({rs} - {sq})"
    fix_a = f"(({da}) > ({db}) AND ({da}) > ({ds}))"
    fix_b = f"(NOT {fix_a} AND ({db}) > ({ds}))"
    a = f"CAST(CASE WHEN {fix_a} THEN -{rb} - {rs} ELSE {ra} END AS BIGINT)"
    b = f"CAST(CASE WHEN {fix_b} THEN -{ra} - {rs} ELSE {rb} END AS BIGINT)"
    return a, b


def uv(lon: str, lat: str, res: int) -> tuple[str, str]:
    m = C.inv_scale(res)
    x = f"(({lon}) * {d(C.KX)})"
    y = f"(sin(({lat}) * {d(C.D2R)}) * {d(C.KY)})"
    u = f"(({x} * {d(m.real)}) - ({y} * {d(m.imag)}))"
    v = f"(({x} * {d(m.imag)}) + ({y} * {d(m.real)}))"
    return u, v


def encode(res: int, a: str, b: str) -> str:
    return (f"(CAST({res} AS BIGINT) * {C.SHIFT_RES} + (({a}) + {C.OFFSET}) * {C.SHIFT_A}"
            f" + (({b}) + {C.OFFSET}))")


def cell(lon: str, lat: str, res: int) -> str:
    u, v = uv(lon, lat, res)
    bq = f"({v} * {d(C.TWO_OVER_SQRT3)})"
    aq = f"({u} - ({v} * {d(C.INV_SQRT3)}))"
    a, b = _round(aq, bq)
    return f"(CASE WHEN ({lon}) IS NULL OR ({lat}) IS NULL THEN NULL ELSE {encode(res, a, b)} END)"


def cell_a(c: str) -> str:
    return f"(((({c}) // {C.SHIFT_A}) % {C.SHIFT_A}) - {C.OFFSET})"


def cell_b(c: str) -> str:
    return f"((({c}) % {C.SHIFT_A}) - {C.OFFSET})"


def parent_ab(a: str, b: str, child_res: int) -> tuple[str, str]:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    if child_res % 2 == 1:
        aq, bq = f"(({a} * {d(3.0)} + {b}) / {d(7.0)})", f"(({b} * {d(2.0)} - {a}) / {d(7.0)})"
    else:
        aq, bq = f"(({a} * {d(2.0)} - {b}) / {d(7.0)})", f"(({a} + {b} * {d(3.0)}) / {d(7.0)})"
    return _round(aq, bq)


# ---- fixtures ----------------------------------------------------------------

def _coord(spec) -> str:
    base, mult, mod = spec
    return f"({d(base)} + CAST((k * {mult}) % {mod} AS DOUBLE) / {d(10000.0)})"


def trips_cte() -> str:
    """trips(trip_id, vendor_id, pickup_datetime, dropoff_datetime, lon/lat x4, passenger_count, fare_amount)."""
    to_a = "(k % 16 = 0)"
    to_b = "(k % 8 = 0 AND k % 16 <> 0)"
    a_lon, a_lat = _coord(FX.AIRPORT_A[0]), _coord(FX.AIRPORT_A[1])
    b_lon, b_lat = _coord(FX.AIRPORT_B[0]), _coord(FX.AIRPORT_B[1])
    return f"""trips AS (
  SELECT k AS trip_id,
         CAST(1 + k % 2 AS VARCHAR) AS vendor_id,
         CAST(o_orderdate AS TIMESTAMP) + to_minutes(CAST((k * 37) % 1440 AS BIGINT)) AS pickup_datetime,
         CAST(o_orderdate AS TIMESTAMP) + to_minutes(CAST((k * 37) % 1440 AS BIGINT))
             + to_minutes(CAST(1 + (k * 13) % 60 AS BIGINT)) AS dropoff_datetime,
         CASE WHEN {to_a} THEN {a_lon} WHEN {to_b} THEN {b_lon} ELSE {_coord(FX.PICKUP_LON)} END AS pickup_longitude,
         CASE WHEN {to_a} THEN {a_lat} WHEN {to_b} THEN {b_lat} ELSE {_coord(FX.PICKUP_LAT)} END AS pickup_latitude,
         CASE WHEN {to_a} THEN {b_lon} WHEN {to_b} THEN {a_lon} ELSE {_coord(FX.DROPOFF_LON)} END AS dropoff_longitude,
         CASE WHEN {to_a} THEN {b_lat} WHEN {to_b} THEN {a_lat} ELSE {_coord(FX.DROPOFF_LAT)} END AS dropoff_latitude,
         CAST(1 + k % 6 AS INTEGER) AS passenger_count,
         {d(2.5)} + CAST(k % 160 AS DOUBLE) * {d(0.25)} AS fare_amount
  FROM (SELECT o_orderkey AS k, o_orderdate FROM orders) o
)"""


def _ring_values() -> str:
    rows = []
    for kind, ring in ((0, FX.ZONE_OUTER), (1, FX.ZONE_HOLE), (2, FX.ZONE_PART2)):
        for i, (dx, dy) in enumerate(ring):
            rows.append(f"({kind}, {i}, {dx}, {dy})")
    return ", ".join(rows)


def zones_cte() -> str:
    """zones(location_id, zone, borough, zone_order) and zone_edges(location_id, x1, y1, x2, y2)."""
    return f"""zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, n_name AS zone, r_name AS borough,
         CAST(n_nationkey AS INTEGER) AS zone_order
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
ring_tpl(kind, seq, dx, dy) AS (VALUES {_ring_values()}),
zone_vtx AS (
  SELECT z.location_id, t.kind, t.seq,
         CAST({FX.ZONE_X0} + {FX.ZONE_DX} * (z.location_id % 5) + t.dx AS DOUBLE) / {d(1e5)} AS x,
         CAST({FX.ZONE_Y0} + {FX.ZONE_DY} * (z.location_id // 5) + t.dy AS DOUBLE) / {d(1e5)} AS y
  FROM zones z JOIN ring_tpl t
    ON t.kind = 0 OR (t.kind = 1 AND z.location_id % 3 = 0) OR (t.kind = 2 AND z.location_id % 4 = 0)
),
zone_edges AS (
  SELECT p.location_id, p.kind, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2
  FROM zone_vtx p JOIN zone_vtx q
    ON p.location_id = q.location_id AND p.kind = q.kind AND q.seq = p.seq + 1
)"""


def fill_ctes(name: str, edges: str, res: int, key: str = "location_id") -> str:
    """{name}(key, cell): centre fill by ray casting every bbox candidate."""
    u1, v1 = uv("x1", "y1", res)
    u2, v2 = uv("x2", "y2", res)
    half = d(0.5)
    return f"""{name}_uv AS (
  SELECT {key}, {u1} AS u1, {v1} AS v1, {u2} AS u2, {v2} AS v2 FROM {edges}
),
{name}_box AS (
  SELECT {key}, min(least(u1, u2)) AS umin, max(greatest(u1, u2)) AS umax,
         min(least(v1, v2)) AS vmin, max(greatest(v1, v2)) AS vmax
  FROM {name}_uv GROUP BY {key}
),
{name}_rows AS (
  SELECT {key}, umin, umax,
         unnest(generate_series(CAST(floor(vmin / {H}) AS BIGINT), CAST(ceil(vmax / {H}) AS BIGINT))) AS b
  FROM {name}_box
),
{name}_cand AS (
  SELECT {key}, b, unnest(generate_series(CAST(floor(umin - CAST(b AS DOUBLE) * {half}) AS BIGINT) - 1,
                                          CAST(ceil(umax - CAST(b AS DOUBLE) * {half}) AS BIGINT) + 1)) AS a
  FROM {name}_rows
),
{name} AS (
  SELECT c.{key}, {encode(res, 'c.a', 'c.b')} AS cell
  FROM {name}_cand c JOIN {name}_uv e
    ON c.{key} = e.{key}
   AND ((e.v1 > CAST(c.b AS DOUBLE) * {H}) <> (e.v2 > CAST(c.b AS DOUBLE) * {H}))
  WHERE e.u1 + (CAST(c.b AS DOUBLE) * {H} - e.v1) * (e.u2 - e.u1) / (e.v2 - e.v1)
        > CAST(c.a AS DOUBLE) + CAST(c.b AS DOUBLE) * {half}
  GROUP BY c.{key}, c.a, c.b
  HAVING count(*) % 2 = 1
)"""


def pip_inclusive(px: str, py: str) -> str:
    """Aggregate body: true when the point is inside (odd crossings) or on an edge.

    Use inside ``GROUP BY`` over rows joined with the polygon's edges (x1, y1, x2, y2).
    """
    cross = (f"((y1 > {py}) <> (y2 > {py}) AND {px} < x1 + ({py} - y1) * (x2 - x1) / (y2 - y1))")
    on_edge = (f"((x2 - x1) * ({py} - y1) - (y2 - y1) * ({px} - x1) = 0 AND {px} BETWEEN least(x1, x2) AND greatest(x1, x2)"
               f" AND {py} BETWEEN least(y1, y2) AND greatest(y1, y2))")
    return f"(sum(CASE WHEN {cross} THEN 1 ELSE 0 END) % 2 = 1 OR bool_or({on_edge}))"


def utm_inverse(x: str, y: str, zone: int, south: bool = False) -> tuple[str, str]:
    """SQL (lon, lat) of UTM coordinates: inverse transverse Mercator, Krueger series."""
    from tessera.functions import geometry as G
    f = G.WGS84_F
    n = f / (2 - f)
    a_hat = G.WGS84_A / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    beta = [n / 2 - 2 * n * n / 3 + 37 * n ** 3 / 96, n * n / 48 + n ** 3 / 15, 17 * n ** 3 / 480]
    delta = [2 * n - 2 * n * n / 3 - 2 * n ** 3, 7 * n * n / 3 - 8 * n ** 3 / 5, 56 * n ** 3 / 15]
    fn = G.UTM_FALSE_NORTHING_SOUTH if south else 0.0
    xi = f"(({y}) - {d(fn)}) / {d(G.UTM_K0 * a_hat)}"
    eta = f"(({x}) - {d(G.UTM_FALSE_EASTING)}) / {d(G.UTM_K0 * a_hat)}"
    xi_p, eta_p = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_p = f"({xi_p} - {d(b)} * sin({xi} * {2 * j}) * cosh({eta} * {2 * j}))"
        eta_p = f"({eta_p} - {d(b)} * cos({xi} * {2 * j}) * sinh({eta} * {2 * j}))"
    chi = f"asin(sin({xi_p}) / cosh({eta_p}))"
    lat = chi
    for j, dl in enumerate(delta, start=1):
        lat = f"({lat} + {d(dl)} * sin({chi} * {2 * j}))"
    lon = f"({d(zone * 6.0 - 183.0)} + degrees(atan2(sinh({eta_p}), cos({xi_p}))))"
    return lon, f"degrees({lat})"
