"""SQL names for the column functions (``register_sql_functions(spark)``).

Registered as Spark SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN expr``):
their bodies are built-in expressions, so a call inlines into the caller's plan,
constant-folds, and runs in whole-stage codegen like the DataFrame API.
Fills and compaction are table functions (``sqltables``); joins stay DataFrame operators.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions import cells as C
from tessera.functions import geometry as G
from tessera.functions.sqltables import table_functions

GEOM_SQL_TYPE = "STRUCT<gtype: STRING, polys: ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>>"


def _d(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _arr(values) -> str:
    return "array(" + ", ".join(_d(v) for v in values) + ")"


def _sql_str(s: str) -> str:
    """A SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _round(aq: str, bq: str) -> tuple[str, str]:
    sq = f"((-({aq})) - ({bq}))"
    ra, rb, rs = f"floor(({aq}) + 0.5D)", f"floor(({bq}) + 0.5D)", f"floor({sq} + 0.5D)"
    da, db, ds = f"abs({ra} - ({aq}))", f"abs({rb} - ({bq}))", f"abs({rs} - {sq})"
    fix_a = f"(({da}) > ({db}) AND ({da}) > ({ds}))"
    fix_b = f"(NOT {fix_a} AND ({db}) > ({ds}))"
    return (f"(CASE WHEN {fix_a} THEN -{rb} - {rs} ELSE {ra} END)",
            f"(CASE WHEN {fix_b} THEN -{ra} - {rs} ELSE {rb} END)")


def cell_sql(lon: str, lat: str, res: str) -> str:
    """Generic-resolution cell id; per-level constants are indexed literal arrays."""
    mr = f"element_at({_arr([C.inv_scale(r).real for r in range(C.MAX_RES + 1)])}, {res} + 1)"
    mi = f"element_at({_arr([C.inv_scale(r).imag for r in range(C.MAX_RES + 1)])}, {res} + 1)"
    x = f"(({lon}) * {_d(C.KX)})"
    y = f"(sin(({lat}) * {_d(C.D2R)}) * {_d(C.KY)})"
    u = f"(({x} * {mr}) - ({y} * {mi}))"
    v = f"(({x} * {mi}) + ({y} * {mr}))"
    return f"tessera_lattice_cell({u}, {v}, {res})"


def _lattice_cell_body() -> str:
    """Body of tessera_lattice_cell(u, v, res): round lattice-frame (u, v) to the
    nearest centre and pack the id.  A separate SQL function so that (u, v) are
    bound once as parameters instead of being repeated inside the rounding."""
    return f"tessera_pack_cell(u - v * {_d(C.INV_SQRT3)}, v * {_d(C.TWO_OVER_SQRT3)}, res)"


def _pack_cell_body() -> str:
    a, b = _round("aq", "bq")
    return (f"CAST(res AS BIGINT) * {C.SHIFT_RES}L + (CAST({a} AS BIGINT) + {C.OFFSET}L) * {C.SHIFT_A}L"
            f" + (CAST({b} AS BIGINT) + {C.OFFSET}L)")


def _wkt_sql(text: str) -> str:
    num = G._NUM
    t = f"upper(trim({text}))"
    gtype = f"regexp_extract({t}, {_sql_str('^([A-Z]+)')}, 1)"
    body = f"trim(regexp_replace({t}, {_sql_str('^[A-Z]+')}, ''))"
    js = (f"translate(regexp_replace({body}, {_sql_str(f'({num})' + chr(92) + f's+({num})')}, "
          f"{_sql_str('[$1,$2]')}), '()', '[]')")
    polys = (f"CASE WHEN {body} = 'EMPTY' THEN CAST(array() AS ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>) "
             f"WHEN {gtype} = 'MULTIPOLYGON' THEN from_json({js}, 'array<array<array<array<double>>>>') "
             f"WHEN {gtype} = 'POLYGON' THEN array(from_json({js}, 'array<array<array<double>>>')) "
             f"WHEN {gtype} = 'POINT' THEN array(array(from_json({js}, 'array<array<double>>'))) END")
    ok = (f"({gtype} IN ('POINT', 'POLYGON', 'MULTIPOLYGON') AND ({polys}) IS NOT NULL "
          f"AND NOT array_contains(transform({polys}, p -> p IS NULL), true))")
    return f"CASE WHEN {ok} THEN named_struct('gtype', {gtype}, 'polys', {polys}) END"


def _edges_sql(g: str) -> str:
    """Edges part by part; open rings are closed."""
    closed = "CASE WHEN o[0] = element_at(o, -1) THEN o ELSE concat(o, slice(o, 1, 1)) END"
    return (f"flatten(transform({g}.polys, (p, k) -> flatten(transform(transform(filter(p, o -> size(o) >= 2), o -> {closed}), "
            f"r -> transform(sequence(0, size(r) - 2), i -> named_struct("
            f"'x1', r[i][0], 'y1', r[i][1], 'x2', r[i + 1][0], 'y2', r[i + 1][1], 'part', k))))))")


def _pip_sql(g: str, px: str, py: str, inclusive: bool) -> str:
    step = (f"(acc, e) -> named_struct('done', acc.done OR (acc.part <> e.part AND acc.inside), "
            f"'inside', (acc.part = e.part AND acc.inside) <> ((e.y1 > {py}) <> (e.y2 > {py}) AND "
            f"{px} < e.x1 + ({py} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)), "
            f"'edge', acc.edge OR ((e.x2 - e.x1) * ({py} - e.y1) - (e.y2 - e.y1) * ({px} - e.x1) = 0 "
            f"AND {px} >= least(e.x1, e.x2) AND {px} <= greatest(e.x1, e.x2) "
            f"AND {py} >= least(e.y1, e.y2) AND {py} <= greatest(e.y1, e.y2)), 'part', e.part)")
    last = "acc -> acc.edge OR acc.done OR acc.inside" if inclusive else "acc -> NOT acc.edge AND (acc.done OR acc.inside)"
    test = (f"aggregate({_edges_sql(g)}, named_struct('done', false, 'inside', false, 'edge', false, 'part', -1), "
            f"{step}, {last})")
    return f"CASE WHEN {g} IS NOT NULL AND {px} IS NOT NULL AND {py} IS NOT NULL THEN {test} END"


def _ring_area_sql(r: str) -> str:
    return (f"abs(aggregate(sequence(0, size({r}) - 2), 0D, "
            f"(acc, i) -> acc + ({r}[i][0] * {r}[i + 1][1] - {r}[i + 1][0] * {r}[i][1]))) / 2")


def _area_sql(g: str) -> str:
    part = (f"p -> {_ring_area_sql('p[0]')} - aggregate(transform(slice(p, 2, 1073741824), "
            f"h -> {_ring_area_sql('h')}), 0D, (a, v) -> a + v)")
    return f"aggregate(transform({g}.polys, {part}), 0D, (a, v) -> a + v)"


def _parent_sql(cell: str) -> str:
    """The cell one level up; the level is read from the id (null at level 0)."""
    res = f"CAST(shiftright({cell}, 58) AS INT)"
    a = f"CAST((shiftright({cell}, 29) & {C.SHIFT_A - 1}L) - {C.OFFSET}L AS DOUBLE)"
    b = f"CAST(({cell} & {C.SHIFT_A - 1}L) - {C.OFFSET}L AS DOUBLE)"
    odd = f"tessera_pack_cell(({a} * 3D + {b}) / 7D, ({b} * 2D - {a}) / 7D, {res} - 1)"
    even = f"tessera_pack_cell(({a} * 2D - {b}) / 7D, ({a} + {b} * 3D) / 7D, {res} - 1)"
    return f"CASE WHEN {res} > 0 AND {res} % 2 = 1 THEN {odd} WHEN {res} > 0 THEN {even} END"


def _geojson_sql(text: str) -> str:
    raw = f"from_json({text}, 'type STRING, coordinates STRING')"
    kind, xy = f"upper({raw}.type)", f"{raw}.coordinates"
    polys = (f"CASE WHEN {kind} = 'MULTIPOLYGON' THEN from_json({xy}, 'array<array<array<array<double>>>>') "
             f"WHEN {kind} = 'POLYGON' THEN array(from_json({xy}, 'array<array<array<double>>>')) "
             f"WHEN {kind} = 'POINT' THEN array(array(array(from_json({xy}, 'array<double>')))) END")
    return f"CASE WHEN {polys} IS NOT NULL THEN named_struct('gtype', {kind}, 'polys', {polys}) END"


def _centroid_sql(g: str) -> str:
    """Area-weighted centroid, holes subtract; a point is its own."""
    zero = "named_struct('a', 0D, 'x', 0D, 'y', 0D)"
    cross = "(r[i][0] * r[i + 1][1] - r[i + 1][0] * r[i][1])"
    ring = (f"aggregate(sequence(0, size(r) - 2), {zero}, (s, i) -> named_struct('a', s.a + {cross}, "
            f"'x', s.x + (r[i][0] + r[i + 1][0]) * {cross}, 'y', s.y + (r[i][1] + r[i + 1][1]) * {cross}))")
    signed = (f"transform(transform(p, r -> {ring}), (t, k) -> named_struct('f', CASE WHEN (t.a >= 0) = (k = 0) THEN 1D ELSE -1D END, 't', t))")
    total = (f"aggregate(flatten(transform({g}.polys, p -> {signed})), {zero}, (s, q) -> named_struct('a', s.a + q.f * q.t.a, "
             f"'x', s.x + q.f * q.t.x, 'y', s.y + q.f * q.t.y), s -> CASE WHEN s.a <> 0 THEN named_struct('gtype', 'POINT', 'polys', "
             f"array(array(array(array(s.x / (s.a * 3D), s.y / (s.a * 3D)))))) END)")
    return f"CASE WHEN {g}.gtype = 'POINT' THEN {g} ELSE {total} END"


def _num(v: str) -> str:
    return f"CAST({v} AS STRING)"


def _astext_sql(g: str) -> str:
    ring = f"r -> concat('(', concat_ws(', ', transform(r, q -> concat({_num('q[0]')}, ' ', {_num('q[1]')}))), ')')"
    poly = f"p -> concat('(', concat_ws(', ', transform(p, {ring})), ')')"
    body = (f"CASE WHEN size({g}.polys) = 0 THEN ' EMPTY' "
            f"WHEN {g}.gtype = 'MULTIPOLYGON' THEN concat(' (', concat_ws(', ', transform({g}.polys, {poly})), ')') "
            f"WHEN {g}.gtype = 'POLYGON' THEN concat(' ', element_at(transform({g}.polys, {poly}), 1)) "
            f"ELSE concat(' (', {_num(f'{g}.polys[0][0][0][0]')}, ' ', {_num(f'{g}.polys[0][0][0][1]')}, ')') END")
    return f"CASE WHEN {g} IS NOT NULL THEN concat({g}.gtype, {body}) END"


def sql_functions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameter list, return type, body)."""
    g = "g"
    point = (f"CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN named_struct('gtype', 'POINT', "
             f"'polys', array(array(array(array(CAST(x AS DOUBLE), CAST(y AS DOUBLE)))))) END")
    return {
        "tessera_pack_cell": ("aq DOUBLE, bq DOUBLE, res INT", "BIGINT", _pack_cell_body()),
        "tessera_lattice_cell": ("u DOUBLE, v DOUBLE, res INT", "BIGINT", _lattice_cell_body()),
        "cell_from_lonlat": ("lon DOUBLE, lat DOUBLE, res INT", "BIGINT", cell_sql("lon", "lat", "res")),
        "geo_to_cell": ("lat DOUBLE, lon DOUBLE, res INT", "BIGINT", cell_sql("lon", "lat", "res")),
        "cell_resolution": ("cell BIGINT", "INT", "CAST(shiftright(cell, 58) AS INT)"),
        "st_geomfromwkt": ("t STRING", GEOM_SQL_TYPE, _wkt_sql("t")),
        "st_astext": (f"{g} {GEOM_SQL_TYPE}", "STRING", _astext_sql(g)),
        "st_makepoint": ("x DOUBLE, y DOUBLE", GEOM_SQL_TYPE, point),
        "cell_parent": ("cell BIGINT", "BIGINT", _parent_sql("cell")),
        "st_geomfromgeojson": ("t STRING", GEOM_SQL_TYPE, _geojson_sql("t")),
        "st_geometryn": (f"{g} {GEOM_SQL_TYPE}, n INT", GEOM_SQL_TYPE,
                         f"CASE WHEN get({g}.polys, n) IS NOT NULL THEN named_struct('gtype', 'POLYGON', 'polys', array(get({g}.polys, n))) END"),
        "st_centroid": (f"{g} {GEOM_SQL_TYPE}", GEOM_SQL_TYPE, _centroid_sql(g)),
        "rf_geometry": ("xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE", GEOM_SQL_TYPE,
                        "named_struct('gtype', 'POLYGON', 'polys', array(array(array(array(xmin, ymin), array(xmax, ymin), "
                        "array(xmax, ymax), array(xmin, ymax), array(xmin, ymin)))))"),
        "rf_crs": ("crs STRING", "STRING", "crs"),
        "st_geometrytype": (f"{g} {GEOM_SQL_TYPE}", "STRING", f"{g}.gtype"),
        "st_numgeometries": (f"{g} {GEOM_SQL_TYPE}", "INT", f"size({g}.polys)"),
        "st_npoints": (f"{g} {GEOM_SQL_TYPE}", "INT", f"size(flatten(flatten({g}.polys)))"),
        "st_x": (f"{g} {GEOM_SQL_TYPE}", "DOUBLE", f"{g}.polys[0][0][0][0]"),
        "st_y": (f"{g} {GEOM_SQL_TYPE}", "DOUBLE", f"{g}.polys[0][0][0][1]"),
        "st_area": (f"{g} {GEOM_SQL_TYPE}", "DOUBLE", _area_sql(g)),
        "st_intersects_point": (f"{g} {GEOM_SQL_TYPE}, px DOUBLE, py DOUBLE", "BOOLEAN",
                                _pip_sql(g, "px", "py", True)),
        "st_contains_point": (f"{g} {GEOM_SQL_TYPE}, px DOUBLE, py DOUBLE", "BOOLEAN",
                              _pip_sql(g, "px", "py", False)),
        "rf_normalized_difference": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "ARRAY<DOUBLE>",
                                     "zip_with(a, b, (x, y) -> try_divide(x - y, x + y))"),
        "rf_tile_sum": ("t ARRAY<DOUBLE>", "DOUBLE",
                        "aggregate(filter(t, v -> v IS NOT NULL), 0D, (acc, v) -> acc + v)"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) every SQL function for this session; returns the names."""
    names = []
    for name, (params, rtype, body) in (sql_functions() | table_functions(_wkt_sql, _edges_sql)).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {rtype} RETURN {body}")
        names.append(name)
    return names
