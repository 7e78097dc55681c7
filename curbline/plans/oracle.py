"""The same results in plain SQL over the event table, for DuckDB.

Every statement is written from the definition of its operator, with whole-vehicle windows
and unindexed joins. It shares the region list, the constants of the projections and, where an
approximation is part of the definition, its polynomials.
"""

from __future__ import annotations

from math import radians, sqrt

from curbline.functions.geo import (BESSEL_AXIS_M, BESSEL_E2, ORIGIN_LON, SHIFT_M, SWISS_LAT, SWISS_LON,
                                    WGS84_AXIS_M, WGS84_E2, grid_constants)
from curbline.regions import REGIONS

JANUARY = ("2024-01-01", "2024-02-01")
FIRST_PART = ("2024-01-01", "2024-01-16")
MID_JANUARY = ("2024-01-16", "2024-02-01")
EARLY = ("2024-01-01", "2024-01-20")
LATE = ("2024-01-10", "2024-02-01")


def _lv03(lon: str, lat: str) -> tuple[str, str]:
    p, q = f"(({lat} * 3600e0 - 169028.66e0) / 10000e0)", f"(({lon} * 3600e0 - 26782.5e0) / 10000e0)"
    return (f"(600072.37e0 + 211455.93e0*{q} - 10938.51e0*{q}*{p} - 0.36e0*{q}*{p}*{p} - 44.54e0*{q}*{q}*{q})",
            f"(200147.07e0 + 308807.95e0*{p} + 3745.25e0*{q}*{q} + 76.63e0*{p}*{p}"
            f" - 194.56e0*{q}*{q}*{p} + 119.79e0*{p}*{p}*{p})")


def _wgs84(x: str, y: str) -> tuple[str, str]:
    a, b = f"(({x} - 600000e0) / 1000000e0)", f"(({y} - 200000e0) / 1000000e0)"
    return (f"((2.6779094e0 + 4.728982e0*{a} + 0.791484e0*{a}*{b} + 0.1306e0*{a}*{b}*{b}"
            f" - 0.0436e0*{a}*{a}*{a}) * 100e0 / 36e0)",
            f"((16.9023892e0 + 3.238272e0*{b} - 0.270978e0*{a}*{a} - 0.002528e0*{b}*{b}"
            f" - 0.0447e0*{a}*{a}*{b} - 0.0140e0*{b}*{b}*{b}) * 100e0 / 36e0)")


def _mercator(lon: str, lat: str) -> tuple[str, str]:
    return (f"(6378137e0 * radians({lon}))", f"(6378137e0 * ln(tan(pi() / 4 + radians({lat}) / 2)))")


def _planar(a: tuple[str, str], b: tuple[str, str]) -> str:
    return f"sqrt(pow({a[0]} - {b[0]}, 2) + pow({a[1]} - {b[1]}, 2))"


def _sphere(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (f"(2 * 6371009e0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
            f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


_ROWS = ", ".join(f"({i}, {r.city_bfs_id}, {r.south}e0, {r.north}e0, {r.west}e0, {r.east}e0)"
                  for i, r in enumerate(REGIONS))

OBS = f"""
cities AS (SELECT * FROM (VALUES {_ROWS}) AS t(ord, city_bfs_id, south, north, west, east)),
placed AS (
  SELECT user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    (user_id * 7919 + CAST(floor(epoch(ts) / 43200) AS BIGINT) * 104729) % 400 AS cell FROM events),
obs AS (
  SELECT 'v' || user_id AS id, 'u' || user_id AS vehicle, 'prov_' || (user_id % 3) AS provider, 'p' || (user_id % 3) AS pid,
    ts AS runtime, ts - to_seconds(k) AS time,
    coalesce(c.west + (c.east - c.west) * (0.05e0 + 0.9e0 * (cell % 20) / 19e0) + 0.0009e0 * (k % 3) / 3e0, 0e0) AS lon,
    coalesce(c.south + (c.north - c.south) * (0.05e0 + 0.9e0 * floor(cell / 20e0) / 19e0) + 0.00005e0 * (k % 5) / 5e0, 0e0) AS lat,
    CASE WHEN event_type = 'error' THEN true WHEN event_type <> 'signup' THEN false END AS disabled,
    event_type = 'purchase' AS reserved
  FROM placed LEFT JOIN cities c ON placed.user_id % 11 = c.ord)"""

_INSIDE = "o.lat > c.south AND o.lat < c.north AND o.lon > c.west AND o.lon < c.east"


def _tagged(interval: tuple[str, str], name: str = "pts") -> str:
    return f""",
{name} AS (SELECT o.*, c.city_bfs_id FROM obs o JOIN cities c ON {_INSIDE}
  WHERE o.runtime > TIMESTAMP '{interval[0]}' AND o.runtime < TIMESTAMP '{interval[1]}')"""


def _points(interval: tuple[str, str] = JANUARY) -> str:
    return OBS + _tagged(interval)


def _steps(source: str = "pts", order: str = "runtime, lon, lat, provider", p: str = "") -> str:
    x, y = _lv03("lon", "lat")
    return f""",
{p}one AS (SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY city_bfs_id, id, time ORDER BY {order}) AS nth FROM {source}) WHERE nth = 1),
{p}flat AS (SELECT *, {x} AS x, {y} AS y FROM {p}one),
{p}prev AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM {p}flat
  WINDOW w AS (PARTITION BY city_bfs_id, id ORDER BY time)),
{p}step AS (SELECT *, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS step FROM {p}prev)"""


def _segments(source: str = "pts", order: str = "runtime, lon, lat, provider", p: str = "") -> str:
    lon, lat = _wgs84("x", "y")
    return _steps(source, order, p) + f""",
{p}num AS (SELECT *, coalesce(step > 50, false) AS moved, sum(CASE WHEN step > 50 THEN 1 ELSE 0 END) OVER (
  PARTITION BY city_bfs_id, id ORDER BY time ROWS UNBOUNDED PRECEDING) AS stay FROM {p}step),
{p}span AS (SELECT city_bfs_id, id, stay, min(time) AS time_from, max(time) AS time_to FROM {p}num GROUP BY ALL),
{p}mid AS (SELECT city_bfs_id, id, stay, avg(x) AS x, avg(y) AS y FROM (
  SELECT DISTINCT city_bfs_id, id, stay, x, y FROM {p}num) GROUP BY ALL),
{p}stays AS (
  SELECT s.city_bfs_id, s.id, s.stay, n.provider, s.time_from, s.time_to, coalesce(n.step, 0e0) AS distance_m,
    (s.time_from = s.time_to AND n.moved) AS moving, m.x, m.y, {lon.replace("(x ", "(m.x ").replace("(y ", "(m.y ")} AS lon,
    {lat.replace("(x ", "(m.x ").replace("(y ", "(m.y ")} AS lat
  FROM {p}span s JOIN {p}num n ON n.city_bfs_id = s.city_bfs_id AND n.id = s.id AND n.time = s.time_from
  JOIN {p}mid m ON m.city_bfs_id = s.city_bfs_id AND m.id = s.id AND m.stay = s.stay)"""


def _stays(interval: tuple[str, str] = JANUARY) -> str:
    return _points(interval) + _segments()


def _path(interval: tuple[str, str] = JANUARY) -> str:
    a, b, c = _lv03("plon", "plat"), _lv03("plon", "lat"), _lv03("lon", "lat")
    return _stays(interval) + f""",
hops AS (SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM stays
  WINDOW w AS (PARTITION BY city_bfs_id, id ORDER BY time_from)),
path AS (SELECT *, {_planar(a, b)} + {_planar(b, c)} AS distance_m_walk,
  ({_planar(a, b)} + {_planar(b, c)}) * 1.1e0 AS distance_m_bike FROM hops WHERE plon IS NOT NULL),
vertices AS (
  SELECT city_bfs_id, id, provider, time_from, time_to, 1 AS path_idx, plon AS lon, plat AS lat FROM path UNION ALL
  SELECT city_bfs_id, id, provider, time_from, time_to, 2, plon, lat FROM path UNION ALL
  SELECT city_bfs_id, id, provider, time_from, time_to, 3, lon, lat FROM path)"""


_STAY_COLUMNS = """city_bfs_id, id, provider, time_from, time_to, round(distance_m, 3) AS distance_m, moving,
  round(x, 3) AS x, round(y, 3) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat"""

STREETS = f""",
nodes AS (
  SELECT c.city_bfs_id, c.ord * 1000 + cell AS node_id, cell,
    c.west + (c.east - c.west) * (0.05e0 + 0.9e0 * ((cell % 20) + 0.1e0 * ((cell * 37) % 7) / 7e0) / 19e0) AS lon,
    c.south + (c.north - c.south) * (0.05e0 + 0.9e0 * (floor(cell / 20e0) + 0.1e0 * ((cell * 53) % 11) / 11e0) / 19e0) AS lat
  FROM cities c CROSS JOIN range(400) r(cell)),
forward AS (
  SELECT a.city_bfs_id, a.node_id AS u, b.node_id AS v, a.cell AS cu, {_sphere("a.lon", "a.lat", "b.lon", "b.lat")} AS length_m,
    {_planar(_lv03("a.lon", "a.lat"), _lv03("b.lon", "b.lat"))} AS line_m
  FROM nodes a JOIN nodes b ON a.city_bfs_id = b.city_bfs_id
    AND ((b.cell = a.cell + 1 AND a.cell % 20 < 19) OR b.cell = a.cell + 20)),
ways AS (
  SELECT city_bfs_id, 'walk' AS mode, u, v, length_m, line_m FROM forward UNION ALL
  SELECT city_bfs_id, 'walk', v, u, length_m, line_m FROM forward UNION ALL
  SELECT city_bfs_id, 'bike', u, v, length_m, line_m FROM forward UNION ALL
  SELECT city_bfs_id, 'bike', v, u, length_m, line_m FROM forward WHERE cu % 7 <> 0),
ranked AS (
  SELECT s.city_bfs_id, s.id, s.stay, s.time_from, n.node_id, {_sphere("s.lon", "s.lat", "n.lon", "n.lat")} AS node_m,
    row_number() OVER (PARTITION BY s.city_bfs_id, s.id, s.stay ORDER BY {_sphere("s.lon", "s.lat", "n.lon", "n.lat")}, n.node_id) AS nth
  FROM stays s JOIN nodes n ON n.city_bfs_id = s.city_bfs_id),
near AS (SELECT * EXCLUDE (nth) FROM ranked WHERE nth = 1),
legs AS (
  SELECT city_bfs_id, id, stay, coalesce(lag(node_id) OVER (PARTITION BY city_bfs_id, id ORDER BY stay), node_id) AS origin,
    node_id AS destination FROM near),
asked AS (SELECT DISTINCT city_bfs_id, mode, origin, destination FROM legs CROSS JOIN (VALUES ('walk'), ('bike')) AS t(mode)),
lab(city_bfs_id, mode, origin, node, dist, line_m, hops) USING KEY (city_bfs_id, mode, origin, node) AS (
  SELECT DISTINCT city_bfs_id, mode, origin, origin, 0e0, 0e0, 1 FROM asked
  UNION
  SELECT c.city_bfs_id, c.mode, c.origin, c.node, c.dist, c.line_m, c.hops FROM (
    SELECT l.city_bfs_id, l.mode, l.origin, w.v AS node, min(l.dist + w.length_m) AS dist,
      arg_min(l.line_m + w.line_m, l.dist + w.length_m) AS line_m, arg_min(l.hops + 1, l.dist + w.length_m) AS hops
    FROM lab l JOIN ways w ON w.city_bfs_id = l.city_bfs_id AND w.mode = l.mode AND w.u = l.node GROUP BY ALL) c
  LEFT JOIN recurring.lab r ON r.city_bfs_id = c.city_bfs_id AND r.mode = c.mode AND r.origin = c.origin AND r.node = c.node
  WHERE r.dist IS NULL OR c.dist < r.dist),
routes AS (
  SELECT a.*, l.dist AS length_m, l.line_m, l.hops FROM asked a JOIN lab l ON l.city_bfs_id = a.city_bfs_id AND l.mode = a.mode
    AND l.origin = a.origin AND l.node = a.destination)"""

_REGISTRY = "vehicle AS id, provider, city_bfs_id, min(time) AS first_seen, max(time) AS last_seen, count(DISTINCT time) AS datapoints"


def _with(ctes: str, query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes.lstrip()}\n{query}"


def _history(start: str) -> str:
    return f"""
recent AS (SELECT id, provider, time_from AS time, lon, lat,
    row_number() OVER (PARTITION BY id ORDER BY time_to DESC, time_from DESC) AS r
  FROM path WHERE time_to BETWEEN TIMESTAMP '{start}' - INTERVAL 30 DAY AND TIMESTAMP '{start}')"""


_FEED = """feed AS (SELECT 'p' || (user_id % 3) AS provider_id, max(CAST(floor(epoch(ts)) AS BIGINT)) AS last_updated,
  bool_and(user_id % 3 <> 1) AS offers FROM events GROUP BY user_id % 3)"""

_EXPLORED = ",\nseen AS (SELECT o.*, c.city_bfs_id FROM obs o JOIN cities c ON " + _INSIDE + ")"

# No region: the polynomials where they are valid, elsewhere the closed formulas of the Swiss
# oblique projection, step by step.
_X, _Y = _lv03("lon", "lat")
_VALID = f"lon BETWEEN {SWISS_LON[0]}e0 AND {SWISS_LON[1]}e0 AND lat BETWEEN {SWISS_LAT[0]}e0 AND {SWISS_LAT[1]}e0"
_A, _SIN0, _COS0, _K, _R = grid_constants()
_E = sqrt(BESSEL_E2)
_SHORT = BESSEL_AXIS_M * sqrt(1 - BESSEL_E2)
_ANYWHERE = f""",
p1 AS (SELECT *, radians(lat) AS phi0, radians(lon) AS lam0,
  {WGS84_AXIS_M!r} / sqrt(1 - {WGS84_E2!r}::DOUBLE * sin(radians(lat)) * sin(radians(lat))) AS nn FROM obs),
p2 AS (SELECT *, nn * cos(phi0) * cos(lam0) - {SHIFT_M[0]}::DOUBLE AS gx, nn * cos(phi0) * sin(lam0) - {SHIFT_M[1]}::DOUBLE AS gy,
  nn * (1 - {WGS84_E2!r}::DOUBLE) * sin(phi0) - {SHIFT_M[2]}::DOUBLE AS gz FROM p1),
p3 AS (SELECT *, sqrt(gx * gx + gy * gy) AS gp, atan2(gz * {BESSEL_AXIS_M!r}::DOUBLE, sqrt(gx * gx + gy * gy) * {_SHORT!r}::DOUBLE) AS gt FROM p2),
p4 AS (SELECT *, atan2(gz + {BESSEL_E2 / (1 - BESSEL_E2) * _SHORT!r}::DOUBLE * pow(sin(gt), 3),
  gp - {BESSEL_E2 * BESSEL_AXIS_M!r}::DOUBLE * pow(cos(gt), 3)) AS bphi,
  {_A!r}::DOUBLE * (atan2(gy, gx) - {radians(ORIGIN_LON)!r}::DOUBLE) AS bl FROM p3),
p5 AS (SELECT *, 2 * (atan(exp({_A!r}::DOUBLE * ln(tan(pi() / 4 + bphi / 2))
  - {_A * _E / 2!r}::DOUBLE * ln((1 + {_E!r}::DOUBLE * sin(bphi)) / (1 - {_E!r}::DOUBLE * sin(bphi))) + {_K!r}::DOUBLE)) - pi() / 4) AS bb FROM p4),
closed AS (SELECT *, 600000 + {_R!r}::DOUBLE * atan2(sin(bl), {_SIN0!r}::DOUBLE * tan(bb) + {_COS0!r}::DOUBLE * cos(bl)) AS x,
  200000 + {_R!r}::DOUBLE / 2 * ln((1 + {_COS0!r}::DOUBLE * sin(bb) - {_SIN0!r}::DOUBLE * cos(bb) * cos(bl))
    / (1 - {_COS0!r}::DOUBLE * sin(bb) + {_SIN0!r}::DOUBLE * cos(bb) * cos(bl))) AS y FROM p5),
flat AS (SELECT * REPLACE (CASE WHEN {_VALID} THEN {_X} ELSE x END AS x, CASE WHEN {_VALID} THEN {_Y} ELSE y END AS y) FROM closed)"""
_WALKED = OBS + _ANYWHERE + """,
prev AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, row_number() OVER w AS nth FROM flat
  WINDOW w AS (PARTITION BY id ORDER BY runtime, time, lon, lat)),
walked AS (SELECT *, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS distance_m FROM prev)"""


def _bins() -> str:
    return """SELECT time_bucket(INTERVAL 2 MINUTE, runtime) AS time, provider, city_bfs_id, count(*) AS count_datapoints,
  count(DISTINCT vehicle) AS count_distinct_ids, round(avg(epoch_us(runtime) - epoch_us(time)) / 1000000e0, 6) AS avg_delta_updated,
  count(*) AS count_available, CAST(sum(coalesce(CAST(disabled AS INT), 0)) AS BIGINT) AS count_disabled,
  CAST(sum(coalesce(CAST(reserved AS INT), 0)) AS BIGINT) AS count_reserved
FROM pts GROUP BY 1, 2, 3"""


def _registry_rows(interval: tuple[str, str], name: str) -> str:
    return _tagged(interval, f"pts_{name}") + f""",
reg_{name} AS (SELECT {_REGISTRY} FROM pts_{name} GROUP BY vehicle, provider, city_bfs_id)"""


def oracles() -> dict[str, str]:
    mx, my = _mercator("lon", "lat")
    blon, blat = _wgs84(_X, _Y)
    q: dict[str, str] = {}
    q["provider_stats"] = _with(_points(), _bins())
    q["vehicle_registry"] = _with(_points(), f"SELECT {_REGISTRY} FROM pts GROUP BY vehicle, provider, city_bfs_id")
    q["vehicle_list"] = _with(OBS, "SELECT id, first(pid ORDER BY runtime, pid) AS provider FROM obs GROUP BY id")
    q["observation_scan"] = _with(_points(), """SELECT city_bfs_id, id, provider, time, runtime,
  round(lon, 6) AS lon, round(lat, 6) AS lat FROM pts""")
    q["region_counts"] = _with(OBS + _EXPLORED, """SELECT city_bfs_id, count(*) AS datapoints,
  count(DISTINCT id) AS vehicles FROM seen GROUP BY 1""")
    q["observation_dedup"] = _with(_points() + """,
twice AS (SELECT * FROM pts UNION ALL
  SELECT * REPLACE (runtime + INTERVAL 2 MINUTE AS runtime, lon + 0.001e0 AS lon) FROM pts)""" + _steps("twice"),
                                   """SELECT city_bfs_id, id, provider, time,
  round(lon, 6) AS lon, round(lat, 6) AS lat FROM one""")
    q["reproject_lv03"] = _with(_points(), f"""SELECT city_bfs_id, id, time, round({_X}, 3) AS x, round({_Y}, 3) AS y,
  round({blon}, 6) AS lon_back, round({blat}, 6) AS lat_back FROM pts""")
    q["reproject_mercator"] = _with(_points(), f"""SELECT city_bfs_id, id, time, round({mx}, 3) AS mx,
  round({my}, 3) AS my FROM pts""")
    q["step_distance"] = _with(_points() + _steps(), """SELECT city_bfs_id, id, time,
  round(step, 3) AS distance_m FROM step""")
    q["stay_segments"] = _with(_stays(), f"SELECT {_STAY_COLUMNS} FROM stays")
    q["history_top2"] = _with(_path() + "," + _history("2024-01-16"), """SELECT id, provider, time, r,
  round(lon, 6) AS lon, round(lat, 6) AS lat FROM recent WHERE r <= 2""")
    q["stays_incremental"] = _with(
        _path(FIRST_PART) + "," + _history("2024-01-16") + _tagged(MID_JANUARY, "fresh") + """,
awake AS (SELECT DISTINCT city_bfs_id, id FROM fresh WHERE time > TIMESTAMP '2024-01-16'),
joined AS (
  SELECT city_bfs_id, id, provider, time, lon, lat, runtime, 1 AS rank FROM fresh SEMI JOIN awake USING (city_bfs_id, id) UNION ALL
  SELECT a.city_bfs_id, r.id, r.provider, r.time, r.lon, r.lat, NULL, 0 FROM recent r JOIN awake a USING (id) WHERE r.r <= 2)"""
        + _segments("joined", "rank, runtime, lon, lat, provider", "j"),
        f"SELECT {_STAY_COLUMNS} FROM jstays WHERE time_to >= TIMESTAMP '2024-01-16'")
    q["street_clip"] = _with(_stays() + STREETS + """,
all_nodes AS (SELECT city_bfs_id, node_id, lon, lat FROM nodes UNION ALL SELECT city_bfs_id, node_id + 500000, lon - 20, lat FROM nodes),
all_ways AS (SELECT city_bfs_id, mode, u, v, length_m FROM ways UNION ALL SELECT city_bfs_id, mode, u, v, length_m * 1.5e0 FROM ways
  UNION ALL SELECT city_bfs_id, mode, u, u, 1e0 FROM ways UNION ALL SELECT city_bfs_id, mode, u, u + 500000, 5e0 FROM ways),
boxed AS (SELECT o.city_bfs_id, o.node_id FROM all_nodes o JOIN cities c ON c.city_bfs_id = o.city_bfs_id AND """ + _INSIDE + """),
clipped AS (SELECT city_bfs_id, mode, u, v, min(length_m) AS length_m FROM all_ways w
  WHERE u <> v AND EXISTS (SELECT 1 FROM boxed b WHERE b.city_bfs_id = w.city_bfs_id AND b.node_id = w.u)
    AND EXISTS (SELECT 1 FROM boxed b WHERE b.city_bfs_id = w.city_bfs_id AND b.node_id = w.v) GROUP BY ALL)""",
                            """SELECT w.city_bfs_id, w.mode, w.u, w.v, round(w.length_m, 3) AS length_m,
  coalesce(n.stays, 0) AS stays FROM clipped w
  LEFT JOIN (SELECT city_bfs_id, node_id, count(*) AS stays FROM near GROUP BY ALL) n
    ON n.city_bfs_id = w.city_bfs_id AND n.node_id = w.u""", True)
    q["nearest_node"] = _with(_stays() + STREETS, """SELECT city_bfs_id, id, time_from, node_id AS node_walk,
  node_id AS node_bike, round(node_m, 3) AS node_walk_m, round(node_m, 3) AS node_bike_m FROM near""", True)
    q["shortest_path"] = _with(_stays() + STREETS, """SELECT city_bfs_id, mode, origin, destination,
  round(length_m, 3) AS length_m FROM routes""", True)
    q["path_table"] = _with(_stays() + STREETS, """SELECT s.id, s.provider, s.city_bfs_id, round(s.lon, 6) AS lon,
  round(s.lat, 6) AS lat, s.time_from, s.time_to, round(s.distance_m, 3) AS distance_m, s.moving,
  round(w.line_m, 3) AS distance_m_walk, round(b.line_m, 3) AS distance_m_bike,
  CAST(w.hops AS BIGINT) AS walk_vertices, CAST(b.hops AS BIGINT) AS bike_vertices
FROM stays s JOIN legs l USING (city_bfs_id, id, stay)
JOIN routes w ON w.city_bfs_id = l.city_bfs_id AND w.mode = 'walk' AND w.origin = l.origin AND w.destination = l.destination
JOIN routes b ON b.city_bfs_id = l.city_bfs_id AND b.mode = 'bike' AND b.origin = l.origin AND b.destination = l.destination
WHERE l.origin <> l.destination AND s.time_to >= TIMESTAMP '2024-01-01'
  AND EXISTS (SELECT 1 FROM pts p WHERE p.city_bfs_id = s.city_bfs_id AND p.id = s.id AND p.time > TIMESTAMP '2024-01-01')""", True)
    q["path_vertices"] = _with(_path(), """SELECT id, time_from, CAST(path_idx AS BIGINT) AS path_idx,
  round(lon, 6) AS lon, round(lat, 6) AS lat FROM vertices""")
    q["path_length"] = _with(_path(), """SELECT id, time_from, time_to, round(distance_m_walk, 3) AS distance_m_walk,
  round(distance_m_walk, 3) AS line_m FROM path""")
    here, before = _mercator("lon", "lat"), _mercator("lon_before", "lat_before")
    q["mart_edges"] = _with(_path() + """,
linked AS (SELECT *, lag(lon) OVER w AS lon_before, lag(lat) OVER w AS lat_before FROM vertices
  WHERE time_from BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
  WINDOW w AS (PARTITION BY city_bfs_id, id ORDER BY time_to, path_idx, time_from))""",
                            f"""SELECT id, provider, city_bfs_id, time_from, time_to, CAST(path_idx AS BIGINT) AS path_idx,
  round(lon, 6) AS lon, round(lat, 6) AS lat, round(lon_before, 6) AS lon_before, round(lat_before, 6) AS lat_before,
  round({_planar(here, before)}, 3) AS distance_m FROM linked""")
    q["mart_distinct_ids"] = _with(_path(), """SELECT provider, city_bfs_id, date_trunc('day', time_from)::TIMESTAMP AS time,
  count(DISTINCT id) AS distinct_ids FROM path GROUP BY 1, 2, 3""")
    q["mart_distinct_ids_day"] = _with(_path(), """SELECT provider, city_bfs_id, TIMESTAMP '2024-01-16' AS time,
  count(DISTINCT id) AS distinct_ids FROM path WHERE time_from::DATE = DATE '2024-01-16' GROUP BY 1, 2""")
    q["mart_vehicle_age"] = _with(_path() + """,
lives AS (SELECT id, provider, city_bfs_id, min(time_from) AS born, max(time_to) AS died FROM path GROUP BY 1, 2, 3),
marks AS (SELECT provider, city_bfs_id, born, died,
  date_trunc('hour', unnest(generate_series(born + INTERVAL 1 HOUR, died, INTERVAL 1 HOUR))) AS time FROM lives)""",
                                  """SELECT time, city_bfs_id, provider,
  round(avg((epoch_us(time) - epoch_us(born)) / 1000000e0 / 86400e0), 6) AS avg_age_days_scooter
FROM marks WHERE time BETWEEN born AND died AND time BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
GROUP BY 1, 2, 3""")
    trips = _path() + """,
numbered AS (SELECT *, CAST(sum(CASE WHEN moving THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY time_from) AS BIGINT) AS trip_id
  FROM path),
late AS (SELECT * FROM numbered WHERE time_from BETWEEN TIMESTAMP '2024-01-16' AND TIMESTAMP '2024-02-01')"""
    q["trip_numbers"] = _with(trips, "SELECT id, time_from, moving, trip_id FROM late")
    q["mart_trip_distance"] = _with(trips, """SELECT id, provider, city_bfs_id, CAST(trip_id AS VARCHAR) AS trip_id,
  min(time_from) AS trip_start, max(time_from) AS trip_end, round(sum(distance_m_walk), 3) AS trip_walk_distance_m,
  round(sum(distance_m_bike), 3) AS trip_bike_distance_m FROM late GROUP BY id, provider, city_bfs_id, trip_id""")
    q["upsert_replace"] = _with(
        OBS + _tagged(EARLY, "early") + _tagged(LATE, "late") + _segments("early", p="e") + _segments("late", p="l"),
        """SELECT id, provider, city_bfs_id, time_from, time_to, round(distance_m, 3) AS distance_m FROM lstays
UNION ALL SELECT id, provider, city_bfs_id, time_from, time_to, round(distance_m, 3) FROM estays
WHERE NOT EXISTS (SELECT 1 FROM lstays l WHERE l.id = estays.id AND l.time_from = estays.time_from)""")
    q["upsert_accumulate"] = _with(
        OBS + _registry_rows(EARLY, "a") + _registry_rows(LATE, "b"),
        """SELECT coalesce(a.id, b.id) AS id, coalesce(b.provider, a.provider) AS provider,
  coalesce(a.city_bfs_id, b.city_bfs_id) AS city_bfs_id, least(a.first_seen, b.first_seen) AS first_seen,
  greatest(a.last_seen, b.last_seen) AS last_seen, coalesce(a.datapoints, 0) + coalesce(b.datapoints, 0) AS datapoints
FROM reg_a a FULL OUTER JOIN reg_b b ON a.id = b.id AND a.city_bfs_id = b.city_bfs_id""")
    q["retention_keep"] = _with(_path(), """SELECT id, city_bfs_id, time_from, time_to FROM path
WHERE NOT (time_from::DATE < DATE '2024-01-15' AND city_bfs_id = 230)""")
    q["rows_in_interval"] = _with(_path(), """SELECT city_bfs_id, count(*) AS path_rows FROM path
WHERE time_to BETWEEN TIMESTAMP '2024-01-16' AND TIMESTAMP '2024-02-01' GROUP BY 1""")
    checked = {"id": "id", "provider": "pid", "time_provider": "time", "lon": "lon",
               "is_disabled": "disabled", "is_reserved": "reserved"}
    q["not_null_report"] = _with(OBS, " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows, count(*) AS total_rows FROM obs"
        for name, c in checked.items()))
    q["collect_enrich"] = _with(OBS + ",\n" + _FEED, """SELECT id, vehicle, pid AS provider,
  '{"id":"' || pid || '","name":"' || provider || '"}' AS provider_document, round(lon, 6) AS lon, round(lat, 6) AS lat,
  TIMESTAMP '2024-02-01 02:05:00' AS runtime, make_timestamp(last_updated * 1000000) AS refreshed
FROM obs JOIN feed ON provider_id = pid WHERE offers""")
    q["offering_providers"] = _with(_FEED, "SELECT provider_id, last_updated FROM feed WHERE offers")
    q["stream_provider_stats"] = _with(OBS + ",\npts AS (SELECT o.*, c.city_bfs_id FROM obs o JOIN cities c ON " + _INSIDE + ")",
                                       _bins())
    q["stream_registry"] = _with(
        OBS + ",\npts AS (SELECT o.*, c.city_bfs_id FROM obs o JOIN cities c ON " + _INSIDE + ")",
        """SELECT vehicle AS id, last(provider ORDER BY time, provider) AS provider, city_bfs_id, min(time) AS first_seen,
  max(time) AS last_seen, count(DISTINCT (provider, time)) AS datapoints FROM pts GROUP BY vehicle, city_bfs_id""")
    q["stream_settled_counts"] = _with(
        OBS + ",\npts AS (SELECT o.*, c.city_bfs_id FROM obs o JOIN cities c ON " + _INSIDE + ")",
        """SELECT time_bucket(INTERVAL 2 MINUTE, runtime) AS time, provider, city_bfs_id,
  count(DISTINCT (id, runtime)) AS count_datapoints FROM pts GROUP BY 1, 2, 3
HAVING max(time_bucket(INTERVAL 2 MINUTE, runtime)) + INTERVAL 12 MINUTE <= (SELECT max(runtime) FROM pts)""")
    q["registry_rerun"] = q["upsert_accumulate"]
    q["pages_scan"] = _with(OBS, """SELECT id, vehicle, pid AS provider, round(lon, 6) AS lon, round(lat, 6) AS lat,
  CASE WHEN CAST(floor(epoch(runtime)) AS BIGINT) % 7 <> 0 THEN true END AS available FROM obs""")
    q["explore_scan"] = _with(OBS, """SELECT time AS time_provider, runtime AS time_airflow, id, round(lon, 6) AS lon,
  round(lat, 6) AS lat, pid AS provider, true AS is_available, disabled AS is_disabled, reserved AS is_reserved
FROM obs WHERE lat > 46 AND lat < 47.5e0 AND lon > 7 AND lon < 8.75e0
  AND time > TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-25'""")
    q["distance_from_last_row"] = _with(_WALKED, """SELECT id, runtime AS time_airflow,
  round(distance_m, 3) AS distance_m FROM walked""")
    q["moved_datapoints"] = _with(_WALKED + """,
counted AS (SELECT *, sum(CASE WHEN distance_m >= 20 THEN distance_m ELSE 0 END) OVER (
  PARTITION BY id ORDER BY runtime, time, lon, lat ROWS UNBOUNDED PRECEDING) AS total FROM walked),
placed_in AS (SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY round(total, 6)) AS spot FROM counted),
spans AS (SELECT *, first_value(time) OVER w AS time_from, last_value(time) OVER w AS time_to FROM placed_in
  WINDOW w AS (PARTITION BY id, spot ORDER BY runtime, time, lon, lat ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""",
                                  """SELECT id, runtime AS time_airflow, time AS time_provider, round(distance_m, 3) AS distance_m,
  time_from, time_to, round((epoch_us(time_to) - epoch_us(time_from)) / 1000000e0, 3) AS stay_in_pos_sec
FROM spans WHERE distance_m >= 20 OR nth = 1""")
    q["distance_from_point"] = _with(OBS + _ANYWHERE, f"""SELECT id, runtime AS time_airflow,
  round({_planar(("x", "y"), ("695538e0", "260803e0"))}, 3) AS distance_m FROM flat""")
    # Winter time holds for the whole event table.
    q["tz_convert"] = _with(OBS, """SELECT id, time + INTERVAL 1 HOUR AS time_provider, runtime + INTERVAL 1 HOUR AS time_airflow,
  date_trunc('hour', runtime + INTERVAL 1 HOUR)::TIMESTAMP AS hour FROM obs""")
    return q | _stored_oracles(q)


def _later_wins(early: str, late: str, key: tuple[str, ...], columns: str = "*") -> str:
    """Rows of two statements; one of the first goes where the second has its key."""
    same = " AND ".join(f"l.{k} IS NOT DISTINCT FROM early.{k}" for k in key)
    return _with(f"early AS ({early}), late AS ({late})", f"""SELECT {columns} FROM late
UNION ALL SELECT {columns} FROM early WHERE NOT EXISTS (SELECT 1 FROM late l WHERE {same})""")


def _edges_of(interval: tuple[str, str]) -> str:
    here, before = _mercator("lon", "lat"), _mercator("lon_before", "lat_before")
    return _with(_path() + f""",
linked AS (SELECT *, lag(lon) OVER w AS lon_before, lag(lat) OVER w AS lat_before FROM vertices
  WHERE time_from BETWEEN TIMESTAMP '{interval[0]}' AND TIMESTAMP '{interval[1]}'
  WINDOW w AS (PARTITION BY city_bfs_id, id ORDER BY time_to, path_idx, time_from))""",
                 f"""SELECT id, provider, city_bfs_id, time_from, time_to, CAST(path_idx AS BIGINT) AS path_idx,
  round(lon, 6) AS lon, round(lat, 6) AS lat, round(lon_before, 6) AS lon_before, round(lat_before, 6) AS lat_before,
  round({_planar(here, before)}, 3) AS distance_m FROM linked""")


def _ages_of(interval: tuple[str, str]) -> str:
    return _with(_path() + f""",
lives AS (SELECT id, provider, city_bfs_id, min(time_from) AS born, max(time_to) AS died FROM path
  WHERE time_from::DATE <= DATE '{interval[1]}' GROUP BY 1, 2, 3),
marks AS (SELECT provider, city_bfs_id, born, died,
  date_trunc('hour', unnest(generate_series(born + INTERVAL 1 HOUR, died, INTERVAL 1 HOUR))) AS time FROM lives)""",
                 f"""SELECT time, city_bfs_id, provider,
  round(avg((epoch_us(time) - epoch_us(born)) / 1000000e0 / 86400e0), 6) AS avg_age_days_scooter
FROM marks WHERE time BETWEEN born AND died AND time BETWEEN TIMESTAMP '{interval[0]}' AND TIMESTAMP '{interval[1]}'
GROUP BY 1, 2, 3""")


def _trips_of(interval: tuple[str, str]) -> str:
    return _with(_path() + """,
numbered AS (SELECT *, CAST(sum(CASE WHEN moving THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY time_from) AS BIGINT) AS trip_no
  FROM path)""", f"""SELECT id, provider, city_bfs_id, CAST(trip_no AS VARCHAR) AS trip_id, min(time_from) AS trip_start,
  max(time_from) AS trip_end, round(sum(distance_m_walk), 3) AS trip_walk_distance_m, round(sum(distance_m_bike), 3) AS trip_bike_distance_m
FROM numbered WHERE time_from BETWEEN TIMESTAMP '{interval[0]}' AND TIMESTAMP '{interval[1]}' GROUP BY id, provider, city_bfs_id, trip_no""")


def _stored_oracles(q: dict[str, str]) -> dict[str, str]:
    def path_of(interval: tuple[str, str]) -> str:
        return _with(_path(interval), """SELECT id, provider, city_bfs_id, round(lon, 6) AS lon, round(lat, 6) AS lat, time_from, time_to,
  round(distance_m, 3) AS distance_m, moving, round(distance_m_walk, 3) AS distance_m_walk, round(distance_m_bike, 3) AS distance_m_bike,
  CAST(3 AS BIGINT) AS walk_vertices, CAST(3 AS BIGINT) AS bike_vertices FROM path""")
    found = {
        "table_path": _later_wins(path_of(EARLY), path_of(LATE), ("id", "time_from")),
        "table_provider_stats": _later_wins(_with(_points(EARLY), _bins()), _with(_points(LATE), _bins()),
                                            ("time", "provider", "city_bfs_id")),
        "table_edges": _later_wins(_edges_of(EARLY), _edges_of(LATE), ("id", "time_from")),
        "table_distinct_ids": q["mart_distinct_ids"],
        "table_vehicle_age": _later_wins(_ages_of(EARLY), _ages_of(LATE), ("time", "city_bfs_id", "provider")),
        "table_trip_distance": _later_wins(_trips_of(FIRST_PART), _trips_of(MID_JANUARY), ("id", "trip_id")),
        "table_retention": q["retention_keep"],
        "landed_scan": q["observation_scan"],
        "landed_feed": q["offering_providers"],
        "landed_documents": _with(OBS + _EXPLORED, """SELECT city_bfs_id, id, provider, date_trunc('second', time)::TIMESTAMP AS time,
  date_trunc('second', runtime)::TIMESTAMP AS runtime, round(lon, 6) AS lon, round(lat, 6) AS lat FROM seen"""),
        "explore_ids": _with(OBS, """SELECT time AS time_provider, runtime AS time_airflow, id, round(lon, 6) AS lon,
  round(lat, 6) AS lat, pid AS provider, true AS is_available, disabled AS is_disabled, reserved AS is_reserved
FROM obs WHERE id IN (SELECT id FROM obs WHERE lon > -1 AND lon < 1)"""),
    }
    return found
