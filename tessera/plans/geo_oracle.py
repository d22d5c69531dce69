"""DuckDB oracle SQL for the cell / zone pipeline queries."""

from __future__ import annotations

from tessera.plans import oracle_parts as O
from tessera.plans.geo_queries import RES_TRIPS, RES_TRIPS_FINE, RES_ZONE_JOIN, RES_ZONES
from tessera.sources import fixtures as FX

TS = "'%Y-%m-%d %H:%M:%S'"


def _trips_cells_cte(res: int, name: str = "t") -> str:
    return f"""{name} AS (
  SELECT {O.cell('pickup_longitude', 'pickup_latitude', res)} AS pickup_cell,
         {O.cell('dropoff_longitude', 'dropoff_latitude', res)} AS dropoff_cell,
         passenger_count, fare_amount
  FROM trips
)"""


def _airport_edges() -> str:
    ids = ", ".join(str(z) for z in FX.AIRPORT_ZONES)
    return f"""airport_edges AS (
  SELECT location_id AS locationid, x1, y1, x2, y2 FROM zone_edges WHERE location_id IN ({ids})
)"""


def _airports_fill(res: int = RES_TRIPS) -> str:
    return f"{O.zones_cte()},\n{_airport_edges()},\n{O.fill_ctes('ap', 'airport_edges', res, 'locationid')}"


def _compact_ctes(src: str, res: int, key: str = "locationid") -> str:
    """{src}(key, cell) at one resolution -> cmp(key, cell): coarsest complete ancestors."""
    parts = [f"""anc{res} AS (
  SELECT DISTINCT {key}, cell AS c{res}, {O.cell_a('cell')} AS a{res}, {O.cell_b('cell')} AS b{res} FROM {src}
)"""]
    for lvl in range(res - 1, -1, -1):
        a, b = O.parent_ab(f"a{lvl + 1}", f"b{lvl + 1}", lvl + 1)
        parts.append(f"""anc{lvl}_ab AS (SELECT *, {a} AS a{lvl}, {b} AS b{lvl} FROM anc{lvl + 1}),
anc{lvl} AS (SELECT *, {O.encode(lvl, f'a{lvl}', f'b{lvl}')} AS c{lvl} FROM anc{lvl}_ab)""")
    levels = []
    for lvl in range(res, -1, -1):
        par = f"c{lvl - 1}" if lvl > 0 else "CAST(NULL AS BIGINT)"
        levels.append(f"SELECT {key}, {lvl} AS lvl, c{lvl} AS anc, {par} AS par, "
                      f"CAST({7 ** (res - lvl)} AS BIGINT) AS need FROM anc0")
    parts.append("lv AS (\n  " + "\n  UNION ALL ".join(levels) + "\n)")
    parts.append(f"""full_sets AS (
  SELECT {key}, lvl, anc, par FROM lv GROUP BY {key}, lvl, anc, par, need HAVING count(*) = need
),
cmp AS (
  SELECT f.{key}, f.anc AS cell FROM full_sets f
  WHERE NOT EXISTS (SELECT 1 FROM full_sets g
                    WHERE g.{key} = f.{key} AND g.lvl = f.lvl - 1 AND g.anc = f.par)
)""")
    return ",\n".join(parts)


def _pip_pairs() -> str:
    """pairs(trip_id, location_id): exact, boundary-inclusive point-in-polygon."""
    return f"""pairs AS (
  SELECT t.trip_id, e.location_id
  FROM trips t JOIN zone_edges e ON TRUE
  GROUP BY t.trip_id, e.location_id, t.pickup_longitude, t.pickup_latitude
  HAVING {O.pip_inclusive('t.pickup_longitude', 't.pickup_latitude')}
)"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    trips = O.trips_cte()
    q["trips_cells_r12"] = f"WITH {trips},\n{_trips_cells_cte(RES_TRIPS)}\nSELECT * FROM t"
    q["trips_cells_r15"] = f"WITH {trips},\n{_trips_cells_cte(RES_TRIPS_FINE)}\nSELECT * FROM t"
    q["cell_from_lonlat"] = (
        f"WITH {trips}\nSELECT trip_id, {O.cell('pickup_longitude', 'pickup_latitude', RES_ZONE_JOIN)} AS h3index, "
        f"{O.cell('pickup_longitude', 'pickup_latitude', 0)} AS cell_r0 FROM trips")
    q["airport_trips"] = f"""WITH {trips},
{_trips_cells_cte(RES_TRIPS)},
{_airports_fill()},
ap_m AS MATERIALIZED (SELECT locationid, cell FROM ap),
picked AS MATERIALIZED (
  SELECT t.dropoff_cell, t.passenger_count, t.fare_amount, src.locationid AS src_loc
  FROM t JOIN ap_m src ON t.pickup_cell = src.cell
)
SELECT count(*) AS num_trips,
       CAST(sum(passenger_count) AS BIGINT) AS num_passengers,
       ('$' || CAST(sum(fare_amount) AS VARCHAR)) AS earnings
FROM picked p JOIN ap_m trg ON p.dropoff_cell = trg.cell
WHERE p.src_loc <> trg.locationid"""
    q["airport_trips_compacted"] = q["airport_trips"]
    q["join_compacted_cells"] = f"""WITH {trips},
pts AS (SELECT trip_id, {O.cell('pickup_longitude', 'pickup_latitude', RES_TRIPS)} AS pickup_cell FROM trips),
{_airports_fill()}
SELECT trip_id, pickup_cell, locationid FROM pts JOIN ap ON pts.pickup_cell = ap.cell"""
    q["trip_totals"] = f"""WITH {trips},
{_trips_cells_cte(RES_TRIPS)}
SELECT count(*) AS num_trips, CAST(sum(passenger_count) AS BIGINT) AS num_passengers,
       sum(fare_amount) AS fare_total FROM t"""
    q["fmt_count"] = f"WITH {trips},\n{_trips_cells_cte(RES_TRIPS)}\nSELECT format('{{:,}}', count(*)) AS count FROM t"
    q["money_text"] = (f"WITH {trips}\nSELECT vendor_id, ('$' || CAST(sum(fare_amount) AS VARCHAR)) AS earnings "
                       f"FROM trips GROUP BY vendor_id")
    q["cells_per_zone"] = f"""WITH {_airports_fill()}
SELECT locationid, count(*) AS num_cells FROM ap GROUP BY locationid ORDER BY locationid"""
    q["cell_compact"] = f"WITH {_airports_fill()},\n{_compact_ctes('ap', RES_TRIPS)}\nSELECT locationid, cell FROM cmp"
    q["cells_per_zone_compacted"] = f"""WITH {_airports_fill()},
{_compact_ctes('ap', RES_TRIPS)}
SELECT locationid, count(*) AS num_cells FROM cmp GROUP BY locationid ORDER BY locationid"""
    q["cell_uncompact"] = f"WITH {_airports_fill()}\nSELECT locationid, cell FROM ap"
    pa9 = O.parent_ab(O.cell_a("pickup_cell"), O.cell_b("pickup_cell"), RES_TRIPS)
    q["cell_parent"] = f"""WITH {trips},
{_trips_cells_cte(RES_TRIPS)},
p11 AS (SELECT pickup_cell, {pa9[0]} AS a11, {pa9[1]} AS b11 FROM t),
p10 AS (SELECT *, {O.parent_ab('a11', 'b11', 11)[0]} AS a10, {O.parent_ab('a11', 'b11', 11)[1]} AS b10 FROM p11),
p9 AS (SELECT *, {O.parent_ab('a10', 'b10', 10)[0]} AS a9, {O.parent_ab('a10', 'b10', 10)[1]} AS b9 FROM p10),
p8 AS (SELECT *, {O.parent_ab('a9', 'b9', 9)[0]} AS a8, {O.parent_ab('a9', 'b9', 9)[1]} AS b8 FROM p9),
p7 AS (SELECT *, {O.parent_ab('a8', 'b8', 8)[0]} AS a7, {O.parent_ab('a8', 'b8', 8)[1]} AS b7 FROM p8)
SELECT DISTINCT pickup_cell AS cell, {O.encode(9, 'a9', 'b9')} AS parent_r9, {O.encode(7, 'a7', 'b7')} AS parent_r7 FROM p7"""
    q["zones_cells"] = f"""WITH {O.zones_cte()},
{O.fill_ctes('zc', 'zone_edges', RES_ZONES)}
SELECT z.location_id AS locationid, z.borough, z.zone, zc.cell FROM zc JOIN zones z USING (location_id)"""
    q["polyfill_polygon"] = f"""WITH {O.zones_cte()},
poly_edges AS (SELECT * FROM zone_edges WHERE location_id % 4 <> 0),
{O.fill_ctes('pf', 'poly_edges', RES_ZONE_JOIN)}
SELECT location_id, cell FROM pf"""
    q["polyfill_multipolygon"] = f"""WITH {O.zones_cte()},
multi_edges AS (SELECT * FROM zone_edges WHERE location_id % 4 = 0),
{O.fill_ctes('pf', 'multi_edges', RES_ZONE_JOIN)}
SELECT location_id, cell FROM pf"""
    q["polyfill_first_part"] = f"""WITH {O.zones_cte()},
multi_edges AS (SELECT * FROM zone_edges WHERE location_id % 4 = 0 AND kind IN (0, 1)),
{O.fill_ctes('pf', 'multi_edges', RES_ZONE_JOIN)}
SELECT location_id, cell FROM pf"""
    q["zones_cells_r12"] = f"""WITH {O.zones_cte()},
{O.fill_ctes('zc', 'zone_edges', RES_TRIPS)}
SELECT location_id AS locationid, count(*) AS num_cells, min(cell) AS first_cell, max(cell) AS last_cell,
       CAST(sum(cell % 1000003) AS BIGINT) AS checksum FROM zc GROUP BY location_id"""
    q["join_cell_zone"] = f"""WITH {trips},
{O.zones_cte()},
{O.fill_ctes('zc', 'zone_edges', RES_ZONE_JOIN)},
pts AS (SELECT trip_id, pickup_longitude, pickup_latitude, strftime(pickup_datetime, {TS}) AS pickup_datetime,
               {O.cell('pickup_longitude', 'pickup_latitude', RES_ZONE_JOIN)} AS h3index FROM trips)
SELECT z.zone, z.borough, p.trip_id, p.pickup_longitude, p.pickup_latitude, p.pickup_datetime, p.h3index
FROM pts p JOIN zc ON p.h3index = zc.cell JOIN zones z ON z.location_id = zc.location_id"""
    q["cell_density"] = f"""WITH {trips}
SELECT {O.cell('dropoff_longitude', 'dropoff_latitude', RES_ZONE_JOIN)} AS cell, count(*) AS num_dropoffs
FROM trips GROUP BY 1"""
    q["pip_join"] = f"""WITH {trips},
{O.zones_cte()},
{_pip_pairs()}
SELECT trip_id, location_id FROM pairs"""
    q["refined_cell_join"] = q["pip_join"]
    q["pip_first_match"] = f"""WITH {trips},
{O.zones_cte()},
{_pip_pairs()},
firsts AS (
  SELECT p.trip_id, min_by(z.borough, z.zone_order) AS pickup_borough
  FROM pairs p JOIN zones z ON z.location_id = p.location_id
  WHERE z.borough IS NOT NULL GROUP BY p.trip_id
)
SELECT t.trip_id, strftime(t.pickup_datetime, {TS}) AS pickup_datetime, t.pickup_latitude, t.pickup_longitude,
       f.pickup_borough
FROM trips t LEFT JOIN firsts f ON f.trip_id = t.trip_id"""
    q["join_bucketed_cells"] = q["join_cell_zone"]
    q["sql_zones_cells"] = q["zones_cells"]
    q["sql_airports_cells"] = q["cell_uncompact"]
    q["sql_airports_cells_compacted"] = q["cell_compact"]
    return q
