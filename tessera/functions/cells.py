"""Hierarchical hexagonal cell grid as Spark column expressions.


* the globe is projected with a cylindrical equal-area projection (radius
  6371.007 km, standard parallel 40 degrees), so every cell of one resolution
  has the same area;
* cells of resolution r are the Voronoi hexagons of the Eisenstein lattice
  ``s_r * (a + b*w)``, ``w = exp(i*pi/3)``; aperture 7 between levels, odd levels
  are turned by ``arg(2 + w)``;
* an id packs ``res << 58 | (a + 2**28) << 29 | (b + 2**28)`` into a positive
  bigint.

Limits of the projection: longitudes do not wrap at +-180 degrees, and near the
poles a coarse cell may extend beyond the projected strip, so its centre and
corners are clamped to the pole (a point's cell id is always defined).

Everything is plain arithmetic on doubles and longs, so it compiles into
whole-stage codegen; no Python runs per row.  Resolution arguments are Python
ints so the per-level constants fold into literals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values of the grid -------------------------------------------
R_KM = 6371.007                      # sphere radius of the projection, km
PHI0_DEG = 40.0                      # standard parallel, degrees
EDGE_KM_RES7 = 1.22                  # hexagon edge length at resolution 7, km
MAX_RES = 15
OFFSET = 1 << 28                     # bias of the packed a / b lattice coordinates
# -------------------------------------------------------------------------

D2R = math.pi / 180.0
R2D = 180.0 / math.pi
SQRT3 = math.sqrt(3.0)
HALF_SQRT3 = SQRT3 / 2.0
INV_SQRT3 = 1.0 / SQRT3
TWO_OVER_SQRT3 = 2.0 / SQRT3
KX = R_KM * math.cos(PHI0_DEG * D2R) * D2R   # plane km per degree of longitude
KY = R_KM / math.cos(PHI0_DEG * D2R)         # plane km per unit of sin(latitude)
S0 = EDGE_KM_RES7 * SQRT3 * 7 ** 3.5         # centre spacing at resolution 0, km
THETA = complex(2.5, HALF_SQRT3)             # 2 + w, norm 7
SHIFT_RES = 1 << 58
SHIFT_A = 1 << 29


def scale(res: int) -> complex:
    """Complex lattice scale s_r: centre = s_r * (a + b*w) in plane km."""
    if res % 2 == 0:
        return complex(S0 / 7 ** (res // 2), 0.0)
    return S0 / (7 ** ((res - 1) // 2) * THETA)


def inv_scale(res: int) -> complex:
    return 1.0 / scale(res)


def spacing_km(res: int) -> float:
    return abs(scale(res))


def edge_km(res: int) -> float:
    return spacing_km(res) / SQRT3


def _check_res(res: int) -> int:
    if not isinstance(res, int) or not 0 <= res <= MAX_RES:
        raise ValueError(f"resolution must be an int in 0..{MAX_RES}, got {res!r}")
    return res


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# ---- projection ----------------------------------------------------------

def plane_xy(lon, lat) -> tuple[Column, Column]:
    """Equal-area plane coordinates (km) of lon/lat degrees."""
    return _c(lon) * F.lit(KX), F.sin(_c(lat) * F.lit(D2R)) * F.lit(KY)


def lattice_uv(lon, lat, res: int) -> tuple[Column, Column]:
    """Lattice-frame coordinates (u, v): centres sit at (a + b/2, b*sqrt(3)/2)."""
    m = inv_scale(_check_res(res))
    x, y = plane_xy(lon, lat)
    u = x * F.lit(m.real) - y * F.lit(m.imag)
    v = x * F.lit(m.imag) + y * F.lit(m.real)
    return u, v


def hex_round(aq: Column, bq: Column) -> tuple[Column, Column]:
    """Nearest Eisenstein integer (a, b) to the real lattice coordinates (aq, bq)."""
    sq = -aq - bq
    ra, rb, rs = F.floor(aq + 0.5), F.floor(bq + 0.5), F.floor(sq + 0.5)
    da, db, ds = F.abs(ra - aq), F.abs(rb - bq), F.abs(rs - sq)
    fix_a = (da > db) & (da > ds)
    fix_b = ~fix_a & (db > ds)
    a = F.when(fix_a, -rb - rs).otherwise(ra)
    b = F.when(fix_b, -ra - rs).otherwise(rb)
    return a, b


def encode(res, a: Column, b: Column) -> Column:
    r = F.lit(res).cast("long") if isinstance(res, int) else _c(res).cast("long")
    return (r * F.lit(SHIFT_RES) + (a.cast("long") + F.lit(OFFSET)) * F.lit(SHIFT_A)
            + (b.cast("long") + F.lit(OFFSET)))


def cell_res(cell) -> Column:
    return F.shiftright(_c(cell), 58).cast("int")


def cell_a(cell) -> Column:
    return F.shiftright(_c(cell), 29).bitwiseAND(F.lit(SHIFT_A - 1)) - F.lit(OFFSET)


def cell_b(cell) -> Column:
    return _c(cell).bitwiseAND(F.lit(SHIFT_A - 1)) - F.lit(OFFSET)


# ---- point -> cell -------------------------------------------------------

def cell_from_lonlat(lon, lat, res: int) -> Column:
    """Cell id of a lon/lat point at resolution ``res`` (null if either is null).

    Axis order is always (lon, lat); the (lat, lon) call sites of the reference
    are served by swapping the arguments.
    """
    u, v = lattice_uv(lon, lat, res)
    bq = v * F.lit(TWO_OVER_SQRT3)
    aq = u - v * F.lit(INV_SQRT3)
    a, b = hex_round(aq, bq)
    return encode(res, a, b)


def cell_key(cell) -> Column:
    """Non-nullable join key of a cell column (null -> -1, which no cell equals).

    Joining on a nullable computed key makes the optimizer infer an
    ``isnotnull(<cell expression>)`` filter below the projection, which evaluates
    the whole grid arithmetic twice per row; a non-nullable key avoids that.
    """
    return F.coalesce(_c(cell), F.lit(-1).cast("long"))


def cell_from_ab(res: int, a: Column, b: Column) -> Column:
    return encode(res, a, b)


# ---- cell -> geometry ----------------------------------------------------

def _per_res(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def cell_centre(cell) -> Column:
    """struct<lon, lat> of the centre of any cell (resolution read from the id)."""
    cell = _c(cell)
    idx = cell_res(cell) + 1
    sr = F.element_at(_per_res([scale(r).real for r in range(MAX_RES + 1)]), idx)
    si = F.element_at(_per_res([scale(r).imag for r in range(MAX_RES + 1)]), idx)
    a, b = cell_a(cell).cast("double"), cell_b(cell).cast("double")
    u = a + b * F.lit(0.5)
    v = b * F.lit(HALF_SQRT3)
    x = u * sr - v * si
    y = u * si + v * sr
    # near the poles a coarse cell's lattice centre can lie beyond the projected
    # strip (|sin(lat)| > 1): such centres are clamped to the pole
    s = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y / F.lit(KY)))
    return F.struct((x / F.lit(KX)).alias("lon"), (F.asin(s) * F.lit(R2D)).alias("lat"))


def cell_boundary(cell) -> Column:
    """Closed ring (array of [lon, lat]) of the hexagon of ``cell``."""
    cell = _c(cell)
    idx = cell_res(cell) + 1
    sr = F.element_at(_per_res([scale(r).real for r in range(MAX_RES + 1)]), idx)
    si = F.element_at(_per_res([scale(r).imag for r in range(MAX_RES + 1)]), idx)
    a, b = cell_a(cell).cast("double"), cell_b(cell).cast("double")
    u0 = a + b * F.lit(0.5)
    v0 = b * F.lit(HALF_SQRT3)
    # hexagon corners sit at distance 1/sqrt(3) from the centre, at 30 + 60k degrees
    corners = []
    for k in list(range(6)) + [0]:
        ang = math.radians(30 + 60 * k)
        du, dv = INV_SQRT3 * math.cos(ang), INV_SQRT3 * math.sin(ang)
        u = u0 + F.lit(du)
        v = v0 + F.lit(dv)
        x = u * sr - v * si
        y = u * si + v * sr
        s = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y / F.lit(KY)))
        corners.append(F.array(x / F.lit(KX), F.asin(s) * F.lit(R2D)))
    return F.array(*corners)


# ---- hierarchy -----------------------------------------------------------

def _parent_ab(a: Column, b: Column, child_res: int) -> tuple[Column, Column]:
    """(a, b) of the parent at child_res - 1."""
    a = a.cast("double")
    b = b.cast("double")
    if child_res % 2 == 1:       # odd child level: parent ~ z * conj(theta) / 7
        aq, bq = (a * 3.0 + b) / 7.0, (b * 2.0 - a) / 7.0
    else:                        # even child level: parent ~ z * theta / 7
        aq, bq = (a * 2.0 - b) / 7.0, (a + b * 3.0) / 7.0
    return hex_round(aq, bq)


def cell_parent(cell, child_res: int, parent_res: int) -> Column:
    """Ancestor of a cell of known resolution ``child_res`` at ``parent_res``."""
    _check_res(child_res)
    _check_res(parent_res)
    if parent_res > child_res:
        raise ValueError("parent resolution must not exceed the child's")
    if parent_res == child_res:
        return _c(cell)
    a, b = cell_a(cell), cell_b(cell)
    if child_res - parent_res == 1:
        return encode(parent_res, *_parent_ab(a, b, child_res))
    # several levels: fold over the levels so the expression stays linear in size
    # (inlining the rounding of each level into the next would grow exponentially)

    def step(acc, r):
        pa_odd = _parent_ab(acc["a"], acc["b"], 1)
        pa_even = _parent_ab(acc["a"], acc["b"], 2)
        odd = (r % 2) == 1
        return F.struct(F.when(odd, pa_odd[0]).otherwise(pa_even[0]).cast("long").alias("a"),
                        F.when(odd, pa_odd[1]).otherwise(pa_even[1]).cast("long").alias("b"))

    init = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    ab = F.aggregate(F.sequence(F.lit(child_res), F.lit(parent_res + 1), F.lit(-1)), init, step)
    return encode(parent_res, ab["a"], ab["b"])


# ---- hierarchical order --------------------------------------------------
# A cell's path number has one base-7 digit per level below its ancestor of resolution 0, so the
# descendants of a cell are consecutive numbers.  The digit of a child is 3 * du + dv + 3 for
# its lattice step (du, dv) from the centre child.
PATH_ROOTS = 1 << 10                          # resolution-0 coordinates are below half of this
DIGIT_DU = (-1, -1, 0, 0, 0, 1, 1)
DIGIT_DV = (0, 1, -1, 0, 1, -1, 0)


def _two_levels() -> dict[tuple[int, int], tuple[int, int, int]]:
    """Two levels from even to even are a factor of 7: 49 steps (dx, dy) from 7 times the
    ancestor's coordinates, told apart by their remainders.  (dx % 7, dy % 7) -> (dx, dy, both digits)."""
    out = {}
    for d1 in range(7):
        for d2 in range(7):
            u, v = DIGIT_DU[d1], DIGIT_DV[d1]           # the odd level, then times conj(theta) = 3 - w
            dx, dy = u * 3 + v + DIGIT_DU[d2], v * 2 - u + DIGIT_DV[d2]
            out[dx % 7, dy % 7] = (dx, dy, 7 * d1 + d2)
    return out


# These expressions are long; as SQL text each is one call to the planner.

def _sql_a(cell: str) -> str:
    return f"((shiftright({cell}, 29) & {SHIFT_A - 1}) - {OFFSET})"


def _sql_b(cell: str) -> str:
    return f"(({cell} & {SHIFT_A - 1}) - {OFFSET})"


def _sql_encode(res, a: str, b: str) -> str:
    return f"(cast({res} as bigint) * {SHIFT_RES} + ({a} + {OFFSET}) * {SHIFT_A} + ({b} + {OFFSET}))"


def _sql_step(cell: str, part: int) -> str:
    """dx, dy or digits (part 0, 1, 2) of a cell of an even level below its ancestor two levels up."""
    table = _two_levels()
    values = ", ".join(f"{table[i, j][part]}L" for i in range(7) for j in range(7))
    return f"get(array({values}), cast(pmod({_sql_a(cell)}, 7) * 7 + pmod({_sql_b(cell)}, 7) as int))"


def with_even_ancestors(df: DataFrame, cell: str, res: int, down_to: int) -> DataFrame:
    """``__c{l}``: the ancestors' ids at the even levels l from ``res`` to ``down_to``.

    One column and one projection for two levels; each uses the column before, so the projections
    stay apart in the plan and run in one generated stage.  Keep filters off the results: a filter
    pushed below the projections writes each level into the next."""
    _check_res(res)
    top = res - res % 2
    out = df.withColumn(f"__c{top}", cell_parent(cell, res, top))
    for lvl in range(top, down_to + 1, -2):
        c = f"__c{lvl}"
        up = [f"(({x} - {_sql_step(c, part)}) div 7)" for part, x in enumerate((_sql_a(c), _sql_b(c)))]
        out = out.withColumn(f"__c{lvl - 2}", F.expr(_sql_encode(lvl - 2, *up)))
    return out


def with_ancestors(df: DataFrame, cell: str, res: int, levels: list[int], out: str) -> DataFrame:
    """``out``: array of the ancestors' ids at ``levels`` (each at most ``res``; ``res`` is the cell)."""
    own = [F.col(f"`{c}`") for c in df.columns]
    wide = with_even_ancestors(df, cell, res, min(levels))

    def at(lvl: int) -> Column:
        if lvl == res:
            return F.col(cell)
        return F.col(f"__c{lvl}") if lvl % 2 == 0 else cell_parent(cell if lvl + 1 == res else f"__c{lvl + 1}", lvl + 1, lvl)

    return wide.select(*own, F.array(*map(at, levels)).alias(out))


def with_path(df: DataFrame, cell: str, res: int, out: str) -> DataFrame:
    """``out``: path number of a cell of resolution ``res``; ``out div 7**k`` is that of its ancestor
    k levels up."""
    own = [F.col(f"`{c}`") for c in df.columns]
    wide = with_even_ancestors(df, cell, res, 0)
    path = f"({_sql_a('__c0')} + {PATH_ROOTS // 2}) * {PATH_ROOTS}L + {_sql_b('__c0')} + {PATH_ROOTS // 2}"
    for lvl in range(2, res + 1, 2):
        path = f"({path}) * 49 + {_sql_step(f'__c{lvl}', 2)}"
    if res % 2:
        up = F.col(f"__c{res - 1}")
        ca, cb = child_ab(cell_a(up), cell_b(up), res - 1, 0)
        return wide.select(*own, (F.expr(path) * 7 + (cell_a(cell) - ca) * 3 + (cell_b(cell) - cb) + 3).alias(out))
    return wide.select(*own, F.expr(path).alias(out))


def cell_from_path(path: str, res: str) -> Column:
    """Cell id of the path number ``path`` of resolution ``res`` (SQL text of columns)."""
    du, dv = (f"array({', '.join(map(str, d))})" for d in (DIGIT_DU, DIGIT_DV))
    # digits from the coarsest level on; then down from the ancestor of resolution 0
    split = (f"aggregate(sequence(1, {MAX_RES}), named_struct('rest', {path}, 'digits', cast(array() as array<bigint>)), (acc, lvl) -> "
             f"CASE WHEN lvl <= {res} THEN named_struct('rest', acc.rest div 7, 'digits', concat(array(acc.rest % 7), acc.digits)) ELSE acc END)")
    down = (f"aggregate(s.digits, named_struct('a', shiftright(s.rest, 10) - {PATH_ROOTS // 2}L, 'b', s.rest % {PATH_ROOTS} - {PATH_ROOTS // 2}L, 'lvl', 0), "
            f"(acc, d) -> named_struct('a', IF(acc.lvl % 2 = 0, acc.a * 2 - acc.b, acc.a * 3 + acc.b) + get({du}, cast(d as int)), "
            f"'b', IF(acc.lvl % 2 = 0, acc.a + acc.b * 3, acc.b * 2 - acc.a) + get({dv}, cast(d as int)), 'lvl', acc.lvl + 1))")
    return F.expr(f"transform(transform(array({split}), s -> {down}), z -> {_sql_encode(f'({res})', 'z.a', 'z.b')})[0]")


# the seven residues mod theta: centre plus the six units of the lattice
UNITS = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1), (-1, 1), (1, -1)]


def child_ab(a: Column, b: Column, parent_res: int, k: int) -> tuple[Column, Column]:
    """(a, b) of child k (0 = centre child) at parent_res + 1."""
    du, dv = UNITS[k]
    if parent_res % 2 == 0:      # even -> odd: z * theta + u, theta = 2 + w
        ca, cb = a * 2 - b, a + b * 3
    else:                        # odd -> even: z * conj(theta) + u, conj = 3 - w
        ca, cb = a * 3 + b, b * 2 - a
    return ca + F.lit(du), cb + F.lit(dv)


def cell_children(cell, parent_res: int) -> Column:
    """array<bigint> of the 7 children of a cell of resolution ``parent_res``."""
    _check_res(parent_res)
    if parent_res == MAX_RES:
        raise ValueError("resolution 15 has no children")
    a, b = cell_a(cell), cell_b(cell)
    return F.array(*[encode(parent_res + 1, *child_ab(a, b, parent_res, k)) for k in range(7)])


def disk_offsets(k: int) -> list[tuple[int, int]]:
    """Lattice offsets (da, db) within hex distance k (1, 7, 19, ... cells)."""
    return [(da, db) for da in range(-k, k + 1) for db in range(-k, k + 1)
            if max(abs(da), abs(db), abs(da + db)) <= k]


def cell_disk(cell, res: int, k: int) -> Column:
    """array<bigint> of every cell within k steps of a cell of resolution ``res``."""
    a, b = cell_a(cell), cell_b(cell)
    return F.array(*[encode(res, a + F.lit(da), b + F.lit(db)) for da, db in disk_offsets(k)])


def cell_neighbours(cell, res: int, include_self: bool = True) -> Column:
    """array<bigint> of the ring-1 neighbourhood of a cell of resolution ``res``."""
    a, b = cell_a(cell), cell_b(cell)
    ks = UNITS if include_self else UNITS[1:]
    return F.array(*[encode(res, a + F.lit(du), b + F.lit(dv)) for du, dv in ks])
