"""Conic and polar projections as column maths: Lambert conformal conic, Albers equal-area, polar stereographic.

A code of ``CONICS`` gives the constants of its projection, worked out on the driver; rows of several codes
look theirs up, so one expression serves them all.  Polar stereographic is the conformal cone with
n = 1 (north) or -1 (south).  Coordinates stay on the datum of the code, which is WGS84 or one that agrees with
it within a metre or two; codes on other datums are left out.  Latitudes from series, within 5e-8 degrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: ellipsoids (a, 1/f) and projections by EPSG code ---------
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)
US_FOOT = 12 / 39.37
# kind, ellipsoid, standard parallels, origin (lat, lon), false easting and northing (m), unit (m)
CONICS = {
    2154: ("conformal", GRS80, (49.0, 44.0), (46.5, 3.0), (700000.0, 6600000.0), 1.0),
    2263: ("conformal", GRS80, (41 + 2 / 60, 40 + 40 / 60), (40 + 10 / 60, -74.0), (300000.0, 0.0), US_FOOT),
    3034: ("conformal", GRS80, (35.0, 65.0), (52.0, 10.0), (4000000.0, 2800000.0), 1.0),
    3347: ("conformal", GRS80, (49.0, 77.0), (63.390675, -91.86666666666666), (6200000.0, 3000000.0), 1.0),
    32118: ("conformal", GRS80, (41 + 2 / 60, 40 + 40 / 60), (40 + 10 / 60, -74.0), (300000.0, 0.0), 1.0),
    3005: ("equal-area", GRS80, (50.0, 58.5), (45.0, -126.0), (1000000.0, 0.0), 1.0),
    3174: ("equal-area", GRS80, (42.122774, 49.01518), (45.568977, -84.455955), (1000000.0, 1000000.0), 1.0),
    3338: ("equal-area", GRS80, (55.0, 65.0), (50.0, -154.0), (0.0, 0.0), 1.0),
    3577: ("equal-area", GRS80, (-18.0, -36.0), (0.0, 132.0), (0.0, 0.0), 1.0),
    5070: ("equal-area", GRS80, (29.5, 45.5), (23.0, -96.0), (0.0, 0.0), 1.0),
    3031: ("polar", WGS84, (-71.0,), (-90.0, 0.0), (0.0, 0.0), 1.0),
    3032: ("polar", WGS84, (-71.0,), (-90.0, 70.0), (6000000.0, 6000000.0), 1.0),
    3413: ("polar", WGS84, (70.0,), (90.0, -45.0), (0.0, 0.0), 1.0),
    3995: ("polar", WGS84, (71.0,), (90.0, 0.0), (0.0, 0.0), 1.0),
}
# universal polar stereographic: scale 0.994 at the pole in place of a standard parallel
UPS = {32661: 90.0, 32761: -90.0, 5041: 90.0, 5042: -90.0}
UPS_SCALE, UPS_FALSE = 0.994, 2000000.0
# -------------------------------------------------------------------------------


def _m(e: float, lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)


def _t(e: float, lat: float) -> float:
    s = e * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) * ((1 + s) / (1 - s)) ** (e / 2)


def _q(e: float, lat: float) -> float:
    s = e * math.sin(lat)
    return (1 - e * e) * (math.sin(lat) / (1 - s * s) + math.atanh(s) / e)


def constants(kind: str, ellipsoid: tuple[float, float], parallels: tuple[float, ...], origin: tuple[float, float],
              false: tuple[float, float], unit: float, scale: float = 1.0) -> dict[str, float]:
    """The numbers that a projection and its inverse need."""
    a, f = ellipsoid[0], 1 / ellipsoid[1]
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    p1, p2 = (math.radians(p) for p in (parallels[0], parallels[-1]))
    lat0 = math.radians(origin[0])
    area = kind == "equal-area"
    conformal = [e2 / 2 + 5 * e2 ** 2 / 24 + e2 ** 3 / 12 + 13 * e2 ** 4 / 360, 7 * e2 ** 2 / 48 + 29 * e2 ** 3 / 240 + 811 * e2 ** 4 / 11520,
                 7 * e2 ** 3 / 120 + 81 * e2 ** 4 / 1120, 4279 * e2 ** 4 / 161280]
    authalic = [e2 / 3 + 31 * e2 ** 2 / 180 + 517 * e2 ** 3 / 5040, 23 * e2 ** 2 / 360 + 251 * e2 ** 3 / 3780, 761 * e2 ** 3 / 45360, 0.0]
    if area:
        n = math.sin(p1) if p1 == p2 else (_m(e, p1) ** 2 - _m(e, p2) ** 2) / (_q(e, p2) - _q(e, p1))
        k = _m(e, p1) ** 2 + n * _q(e, p1)
        rho0 = a * math.sqrt(k - n * _q(e, lat0)) / n
    elif kind == "polar":
        n, rho0 = math.copysign(1.0, lat0), 0.0
        flat = abs(p1)
        if math.isclose(flat, math.pi / 2):           # scale at the pole
            k = 2 * a * scale / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
        else:
            k = a * _m(e, flat) / _t(e, flat)
    else:
        n = math.sin(p1) if p1 == p2 else math.log(_m(e, p1) / _m(e, p2)) / math.log(_t(e, p1) / _t(e, p2))
        k = abs(scale * a * _m(e, p1) / (n * _t(e, p1) ** n))
        rho0 = math.copysign(k, n) * _t(e, lat0) ** n
    series = authalic if area else conformal
    return {"area": float(area), "a": a, "e": e, "n": n, "k": k, "rho0": rho0, "lon0": origin[1], "fe": false[0], "fn": false[1],
            "unit": unit, "qp": _q(e, math.pi / 2)} | {f"s{i + 1}": v for i, v in enumerate(series)}


def table() -> dict[int, dict[str, float]]:
    out = {code: constants(*spec) for code, spec in CONICS.items()}
    for code, pole in UPS.items():
        out[code] = constants("polar", WGS84, (pole,), (pole, 0.0), (UPS_FALSE, UPS_FALSE), 1.0, UPS_SCALE)
    return out


TABLE = table()


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once: written out, the formulas outgrow generated code."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _named(numbers: dict[str, float]) -> Column:
    return F.struct(*[F.lit(float(v)).alias(k) for k, v in numbers.items()])


def _lookup(code: Column) -> Column:
    """The constants of a code as a struct, null for codes not in the table."""
    at = F.array_position(F.array(*map(F.lit, TABLE)), code).cast("int") - 1
    return F.get(F.array(*map(_named, TABLE.values())), at)


def is_conic(code: Column) -> Column:
    return code.isin(*TABLE)


def inverse(x: Column, y: Column, constants_: Column) -> Column:
    """struct<lon, lat> (degrees) of projected coordinates; null off the projection and for null constants."""

    def polar(v: Column) -> Column:
        p, sign = v["p"], F.signum(v["p"]["n"])
        east = sign * (v["x"] * p["unit"] - p["fe"])
        south = sign * (p["rho0"] - (v["y"] * p["unit"] - p["fn"]))
        return F.struct(p.alias("p"), F.sqrt(east * east + south * south).alias("rho"),
                        (p["lon0"] + F.degrees(F.atan2(east, south) / p["n"])).alias("lon"))

    def base(v: Column) -> Column:
        p, rho = v["p"], v["rho"]
        sine = (p["k"] - rho * rho * p["n"] * p["n"] / (p["a"] * p["a"])) / p["n"] / p["qp"]
        onto = F.when(F.abs(sine) <= 1 + 1e-12, F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine))))
        chi = F.when(p["area"] == 1, onto).otherwise(
            F.lit(math.pi / 2) - F.lit(2.0) * F.atan(F.pow(rho / p["k"], F.lit(1.0) / p["n"])))
        return F.struct(p.alias("p"), _round_the_globe(v["lon"]).alias("lon"), chi.alias("chi"))

    def degrees(v: Column) -> Column:
        lat = v["chi"]
        for i in range(1, 5):
            lat = lat + v["p"][f"s{i}"] * F.sin(v["chi"] * (2 * i))
        return F.when(lat.isNotNull() & v["lon"].isNotNull(), F.struct(v["lon"].alias("lon"), F.degrees(lat).alias("lat")))

    start = F.struct(x.alias("x"), y.alias("y"), constants_.alias("p"))
    return _let(_let(_let(start, polar), base), degrees)


def forward(lon: Column, lat: Column, constants_: Column) -> Column:
    """struct<x, y> of longitude and latitude (degrees); null for null constants."""

    def cone(v: Column) -> Column:
        p, sine = v["p"], F.sin(v["phi"])
        s = p["e"] * sine
        t = F.tan(F.lit(math.pi / 4) - v["phi"] / 2) * F.pow((F.lit(1.0) + s) / (F.lit(1.0) - s), p["e"] / 2)
        q = (F.lit(1.0) - p["e"] * p["e"]) * (sine / (F.lit(1.0) - s * s) + F.log((F.lit(1.0) + s) / (F.lit(1.0) - s)) / (p["e"] * 2))
        rho = F.when(p["area"] == 1, p["a"] * F.sqrt(p["k"] - p["n"] * q) / F.abs(p["n"])).otherwise(p["k"] * F.pow(t, p["n"]))
        theta = F.radians(_round_the_globe(v["turn"])) * p["n"]
        return F.struct(p.alias("p"), (F.signum(p["n"]) * rho).alias("rho"), theta.alias("theta"))

    def plane(v: Column) -> Column:
        p = v["p"]
        x = (p["fe"] + v["rho"] * F.sin(v["theta"])) / p["unit"]
        y = (p["fn"] + p["rho0"] - v["rho"] * F.cos(v["theta"])) / p["unit"]
        return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))

    start = F.struct(F.radians(lat).alias("phi"), (lon - constants_["lon0"]).alias("turn"), constants_.alias("p"))
    return _let(_let(start, cone), plane)


def _round_the_globe(lon: Column) -> Column:
    return F.when(lon > 180, lon - 360).when(lon < -180, lon + 360).otherwise(lon)


def conic_lonlat(x: Column, y: Column, code: Column) -> Column:
    """``inverse`` by EPSG code; null for codes not in the table."""
    return inverse(x, y, _lookup(code))


def conic_xy(lon: Column, lat: Column, code: Column) -> Column:
    """``forward`` by EPSG code; null for codes not in the table."""
    return forward(lon, lat, _lookup(code))
