"""SQL table functions of the cell grid: fills, compaction and expansion called from SQL text.

Each is a ``RETURNS TABLE`` function whose body is one generator over built-in expressions, so a
lateral call is one ``Generate`` in the caller's plan: rows stream through, nothing is shuffled and
no subquery is joined back.  (A body with two generators or with a call of another SQL function
is planned as a join with the distinct arguments; hence the functions for spans and ranges
are called one after the other.)

* ``cell_polyfill(wkt, res)``: the cells whose centre is inside, as ``operators.polyfill``.
* ``cell_polyfill_spans(wkt, res)``, then ``cell_range(b, a0, a1, res)``: the same fill in pieces of at
  most ``CHUNK`` cells.
* ``cell_compact(cells)``: cells of one resolution -> complete sets of 7 siblings replaced by their parent.
* ``cell_uncompact(cell, res)``: the descendants at ``res``.

``cell_polyfill_array`` and ``cell_compact_array`` give arrays.  Text that is no polygon, null, and
empty or null arrays give no rows.  What one row may hold is bounded: an array of more than
``MAX_CELLS`` cells is an error that names the way without arrays (spans and ranges, or the operators).
"""

from __future__ import annotations

from collections.abc import Callable

from tessera.functions import cells as C

#: Most cells of one array (32 MB), and most cells of one range.
MAX_CELLS = 1 << 22
CHUNK = 4096
SPAN = "STRUCT<b: BIGINT, c0: DOUBLE, c1: DOUBLE>"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _const(values) -> str:
    return "array(" + ", ".join(f"{v!r}D" if isinstance(v, float) else f"{v}L" for v in values) + ")"


def _uv(lon: str, lat: str) -> tuple[str, str]:
    x, y = f"({lon} * {C.KX!r}D)", f"(sin({lat} * {C.D2R!r}D) * {C.KY!r}D)"
    return f"{x} * k.re - {y} * k.im", f"{x} * k.im + {y} * k.re"


def _spans(g: str, edges: str, res: str) -> str:
    """Rows of the lattice inside a geometry: array<struct<b, c0, c1>>, those of several parts united."""
    levels = range(C.MAX_RES + 1)
    scale = (f"named_struct('re', element_at({_const(C.inv_scale(r).real for r in levels)}, {res} + 1), "
             f"'im', element_at({_const(C.inv_scale(r).imag for r in levels)}, {res} + 1))")
    (u1, v1), (u2, v2) = _uv("e.x1", "e.y1"), _uv("e.x2", "e.y2")
    uv = let(scale, "k", f"transform({edges}, e -> named_struct('u1', {u1}, 'v1', {v1}, 'u2', {u2}, 'v2', {v2}, 'part', e.part))")
    h = f"{C.HALF_SQRT3!r}D"
    row = f"(CAST(b AS DOUBLE) * {h})"
    crossings = (f"flatten(transform(filter({uv}, e -> e.v1 <> e.v2), e -> transform("
                 f"filter(sequence(floor(least(e.v1, e.v2) / {h}), ceil(greatest(e.v1, e.v2) / {h})), b -> (e.v1 > {row}) <> (e.v2 > {row})), "
                 f"b -> named_struct('b', b, 'part', e.part, 'uc', e.u1 + ({row} - e.v1) * (e.u2 - e.u1) / (e.v2 - e.v1)))))")
    # closed rings: the crossings of a row and part come in pairs
    none = f"CAST(array() AS ARRAY<{SPAN}>)"
    pairs = let(f"array_sort({crossings})", "cs",
                f"CASE WHEN size(cs) < 2 THEN {none} ELSE transform(sequence(0, size(cs) div 2 - 1), "
                f"i -> named_struct('b', cs[cast(i * 2 AS INT)].b, 'c0', cs[cast(i * 2 AS INT)].uc, 'c1', cs[cast(i * 2 + 1 AS INT)].uc)) END")
    last = "try_element_at(acc, -1)"
    unite = (f"aggregate(array_sort(ps), {none}, (acc, s) -> CASE WHEN size(acc) > 0 AND {last}.b = s.b AND {last}.c1 >= s.c0 "
             f"THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('b', s.b, 'c0', {last}.c0, 'c1', greatest({last}.c1, s.c1)))) "
             f"ELSE concat(acc, array(s)) END)")
    return let(pairs, "ps", f"CASE WHEN size({g}.polys) > 1 THEN {unite} ELSE ps END")


def _ranges(spans: str) -> str:
    """array<struct<b, a0, a1>>: the centres inside each span, as inclusive ranges."""
    half = "CAST(s.b AS DOUBLE) * 0.5D"
    lo, hi = f"floor(s.c0 - {half})", f"ceil(s.c1 - {half})"
    a0 = f"array_min(filter(array({lo}, {lo} + 1), a -> s.c0 <= a + {half}))"
    a1 = f"array_max(filter(array({hi} - 2, {hi} - 1, {hi}), a -> a + {half} < s.c1))"
    return f"filter(transform({spans}, s -> named_struct('b', s.b, 'a0', {a0}, 'a1', {a1})), r -> r.a0 <= r.a1)"


def _too_many(n: str, way: str) -> str:
    return f"raise_error(concat('an array of ', CAST({n} AS STRING), ' cells is over {MAX_CELLS}: use {way}'))"


def _fill_array(wkt: str, res: str, wkt_sql: Callable[[str], str], edges_sql: Callable[[str], str]) -> str:
    cells = f"flatten(transform(rs, r -> transform(sequence(r.a0, r.a1), a -> {C._sql_encode(res, 'a', 'r.b')})))"
    n = "aggregate(rs, 0L, (n, r) -> n + r.a1 - r.a0 + 1)"
    return let(_fill_ranges(wkt, res, wkt_sql, edges_sql), "rs",
               f"CASE WHEN {n} > {MAX_CELLS} THEN {_too_many(n, 'cell_polyfill_spans and cell_range')} ELSE {cells} END")


def _fill_ranges(wkt: str, res: str, wkt_sql, edges_sql) -> str:
    ranges = _ranges(_spans("g", edges_sql("g"), res))
    return let(let(wkt, "txt", wkt_sql("txt")), "g", f"CASE WHEN g IS NOT NULL THEN {ranges} END")


def _chunked(ranges: str) -> str:
    return (f"flatten(transform({ranges}, r -> transform(sequence(0L, (r.a1 - r.a0) div {CHUNK}), "
            f"i -> named_struct('b', r.b, 'a0', r.a0 + i * {CHUNK}, 'a1', least(r.a1, r.a0 + i * {CHUNK} + {CHUNK - 1})))))")


def _path(cell: str) -> str:
    """Path number of a cell (``cells.with_path``): two levels a step, from an odd level one first."""
    unit = [0] * 7                              # odd level: the remainder of 3a + b tells the unit
    for d, (du, dv) in enumerate(zip(C.DIGIT_DU, C.DIGIT_DV)):
        unit[(3 * du + dv) % 7] = d
    a, b = C._sql_a(cell), C._sql_b(cell)
    x, y = f"(q.a - get({_const(C.DIGIT_DU)}, q.d))", f"(q.b - get({_const(C.DIGIT_DV)}, q.d))"
    odd = let(f"named_struct('a', {a}, 'b', {b}, 'd', CAST(get({_const(unit)}, CAST(pmod(3 * {a} + {b}, 7) AS INT)) AS INT))", "q",
              f"named_struct('a', (3 * {x} + {y}) div 7, 'b', (2 * {y} - {x}) div 7, 'p', CAST(q.d AS BIGINT), 'm', 7L)")
    start = f"IF(shiftright({cell}, 58) % 2 = 1, {odd}, named_struct('a', {a}, 'b', {b}, 'p', 0L, 'm', 1L))"
    table = C._two_levels()
    dx, dy, digits = (f"get({_const(table[i, j][part] for i in range(7) for j in range(7))}, n)" for part in range(3))
    up = let("CAST(pmod(z.a, 7) * 7 + pmod(z.b, 7) AS INT)", "n",
             f"named_struct('a', (z.a - {dx}) div 7, 'b', (z.b - {dy}) div 7, 'p', z.p + {digits} * z.m, 'm', z.m * 49)")
    half = C.PATH_ROOTS // 2
    return (f"aggregate(sequence({C.MAX_RES - 1}, 2, -2), {start}, (z, lvl) -> IF(lvl > shiftright({cell}, 58), z, {up}), "
            f"z -> ((z.a + {half}) * {C.PATH_ROOTS}L + z.b + {half}) * z.m + z.p)")


def _path_cell(path: str, res: str) -> str:
    """Cell id of a path number (the inverse of ``_path``)."""
    steps = sorted((digits, dx, dy) for dx, dy, digits in C._two_levels().values())
    dx, dy = (f"get({_const(t[part] for t in steps)}, n)" for part in (1, 2))
    half = C.PATH_ROOTS // 2
    powers = _const(7 ** k for k in range(C.MAX_RES + 1))

    def above(lvl: str) -> str:
        return f"{path} div element_at({powers}, CAST({res} - {lvl} AS INT) + 1)"

    start = let(above("0"), "root", f"named_struct('a', shiftright(root, 10) - {half}L, 'b', root % {C.PATH_ROOTS} - {half}L)")
    down = let(f"CAST({above('lvl')} % 49 AS INT)", "n", f"named_struct('a', z.a * 7 + {dx}, 'b', z.b * 7 + {dy})")
    du, dv = (f"get({_const(t)}, CAST({path} % 7 AS INT))" for t in (C.DIGIT_DU, C.DIGIT_DV))
    odd = C._sql_encode(res, f"(z.a * 2 - z.b + {du})", f"(z.a + z.b * 3 + {dv})")
    return (f"aggregate(sequence(2, {C.MAX_RES - 1}, 2), {start}, (z, lvl) -> IF(lvl > {res}, z, {down}), "
            f"z -> IF({res} % 2 = 1, {odd}, {C._sql_encode(res, 'z.a', 'z.b')}))")


def _compact_array(cells: str) -> str:
    """Runs of consecutive path numbers, cut into aligned blocks of 7**k numbers."""
    powers = _const(7 ** k for k in range(C.MAX_RES + 2))

    def block(edge: str, k: str, up: bool) -> str:
        p = f"element_at({powers}, CAST({k} AS INT) + 1)"
        return f"(({edge} + {p} - 1) div {p})" if up else f"({edge} div {p})"

    first, last = block("r.lo", "k", True), block("r.hi", "k", False)
    above0, above1 = block("r.lo", "(k + 1)", True), block("r.hi", "(k + 1)", False)

    def span(start: str, stop: str) -> str:
        return (f"IF({start} < {stop}, transform(sequence({start}, {stop} - 1), x -> {_path_cell('x', '(own - k)')}), "
                f"CAST(array() AS ARRAY<BIGINT>))")

    covered = f"(k < own AND {above0} < {above1})"       # the middle of the run is taken by the next level
    blocks = (f"flatten(transform(runs, r -> flatten(transform(sequence(0L, own), k -> IF({covered}, "
              f"concat({span(first, f'({above0} * 7)')}, {span(f'({above1} * 7)', last)}), {span(first, last)})))))")
    runs = let("filter(sequence(0, size(us) - 1), i -> i = 0 OR us[i] <> get(us, i - 1) + 1)", "st",
               "transform(st, (i, j) -> named_struct('lo', us[i], 'hi', us[IF(j + 1 < size(st), get(st, j + 1), size(us)) - 1] + 1))")
    own = "shiftright(cs[0], 58)"
    whole = let(own, "own", let(f"array_sort(array_distinct(transform(cs, c -> {_path('c')})))", "us", let(runs, "runs", blocks)))
    mixed = f"exists(cs, c -> shiftright(c, 58) <> {own})"
    body = (f"CASE WHEN size(cs) > {MAX_CELLS} THEN {_too_many('size(cs)', 'operators.polyfill.compact')} "
            f"WHEN {mixed} THEN raise_error('cell_compact: cells of several resolutions') "
            f"WHEN size(cs) > 0 THEN {whole} END")
    return let(f"filter({cells}, c -> c IS NOT NULL)", "cs", body)


def _uncompact_array(cell: str, res: str) -> str:
    powers = _const(7 ** k for k in range(C.MAX_RES + 1))
    n = f"element_at({powers}, CAST({res} - own AS INT) + 1)"
    cells = let(_path(cell), "p", f"transform(sequence(p * {n}, (p + 1) * {n} - 1), x -> {_path_cell('x', res)})")
    return let(f"shiftright({cell}, 58)", "own",
               f"CASE WHEN own > {res} THEN raise_error(concat('cell_uncompact: a cell of resolution ', CAST(own AS STRING), "
               f"' is finer than ', CAST({res} AS STRING))) WHEN {n} > {MAX_CELLS} THEN {_too_many(n, 'operators.polyfill.uncompact')} "
               f"WHEN {cell} IS NOT NULL THEN {cells} END")


def table_functions(wkt_sql: Callable[[str], str], edges_sql: Callable[[str], str]) -> dict[str, tuple[str, str, str]]:
    """name -> (parameter list, return type, body), as ``sqlfuncs.sql_functions``."""
    fill = _fill_array("wkt", "res", wkt_sql, edges_sql)
    compacted = _compact_array("cells")
    pieces = _chunked(_fill_ranges("wkt", "res", wkt_sql, edges_sql))
    one = f"transform(sequence(a0, a1), a -> {C._sql_encode('res', 'a', 'b')})"
    cell = "TABLE (cell BIGINT)"
    return {
        "cell_polyfill_array": ("wkt STRING, res INT", "ARRAY<BIGINT>", fill),
        "cell_compact_array": ("cells ARRAY<BIGINT>", "ARRAY<BIGINT>", compacted),
        "cell_polyfill": ("wkt STRING, res INT", cell, f"SELECT explode({fill})"),
        "cell_polyfill_spans": ("wkt STRING, res INT", "TABLE (b BIGINT, a0 BIGINT, a1 BIGINT)", f"SELECT inline({pieces})"),
        "cell_range": ("b BIGINT, a0 BIGINT, a1 BIGINT, res INT", cell, f"SELECT explode({one})"),
        "cell_compact": ("cells ARRAY<BIGINT>", cell, f"SELECT explode({compacted})"),
        "cell_uncompact": ("cell BIGINT, res INT", "TABLE (descendant BIGINT)", f"SELECT explode({_uncompact_array('cell', 'res')})"),
    }
