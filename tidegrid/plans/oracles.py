"""The registered queries again, as plain SQL for DuckDB over the supplied tables.

Written independently of the library: brute force over all pairs, no grid, no index.
"""

from __future__ import annotations

import math

from tidegrid.plans.derived import REFERENCE_AREAS
from tidegrid.sources.sample import RISK_BASES, RISK_SIGMA, SAFE_BASES, SAFE_SIGMA

# --- tables ------------------------------------------------------------------

CTES: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    CTES[name], NEEDS[name] = sql, list(needs)


def sql(select: str, *needs: str) -> str:
    """``select`` with the common tables it needs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS[name]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    return f"WITH {', '.join(f'{n} AS ({CTES[n]})' for n in order)} {select}" if order else select


def _ring(vertices: list[tuple[str, str]]) -> str:
    return "[" + ", ".join(f"{{'x': {x}, 'y': {y}}}" for x, y in vertices) + "]"


def _at(dx: object, dy: object) -> tuple[str, str]:
    return f"CAST(x + {dx} AS DOUBLE) / 1e3", f"CAST(y + {dy} AS DOUBLE) / 1e3"


_cte("people", """
    SELECT c_custkey AS citizen_id, c_name AS name,
      'Rua ' || CAST(c_custkey % 997 AS VARCHAR) || ', Porto Alegre' AS address,
      CASE WHEN c_custkey % 11 <> 0 THEN '51 99999-' || printf('%04d', c_custkey) END AS phone,
      DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS registration_date,
      CAST(-51350 + (c_custkey * 7919) % 251 AS DOUBLE) / 1e3 AS lon,
      CAST(-30080 + (c_custkey * c_custkey * 31 + c_custkey * 17) % 233 AS DOUBLE) / 1e3 AS lat
    FROM customer""")

_rows = []
for _i, _name, _date, _severity, _n, (_x0, _y0, _x1, _y1) in REFERENCE_AREAS:
    _box = _ring([(f"{x}e0", f"{y}e0") for x, y in [(_x0, _y0), (_x1, _y0), (_x1, _y1), (_x0, _y1), (_x0, _y0)]])
    _rows.append(
        f"SELECT CAST({_i} AS BIGINT) AS area_id, '{_name}' AS area_name, '{_date}' AS flood_date, "
        f"'{_severity}' AS severity, CAST({_n} AS BIGINT) AS affected_population, {_box} AS ring"
    )
_cte("ref_areas", " UNION ALL ".join(_rows))

_cte("placed", """
    SELECT s_suppkey AS k, -51360 + (s_suppkey * 7919) % 240 AS x,
      -30090 + (s_suppkey * s_suppkey * 13 + s_suppkey * 29) % 220 AS y,
      8 + s_suppkey % 20 AS w, 8 + (s_suppkey * 7) % 20 AS h FROM supplier""")

_BASIN = f"""CASE k % 4
    WHEN 0 THEN {_ring([_at(0, 0), _at('w', 0), _at('w', 'h'), _at(0, 'h'), _at(0, 0)])}
    WHEN 1 THEN {_ring([_at(0, 0), _at('w', 0), _at(3, 'h'), _at(0, 0)])}
    WHEN 2 THEN {_ring([_at(0, 0), _at('w', 0), _at('w', 3), _at(3, 3), _at(3, 'h'), _at(0, 'h'), _at(0, 0)])}
    ELSE {_ring([_at(0, 0), _at('w', 2), _at('2 * w', 0), _at('w', 'h'), _at(0, 0)])} END"""

_cte("basins", f"""
    SELECT k + 1000 AS area_id, 'Basin ' || CAST(k % 40 AS VARCHAR) AS area_name,
      strftime(DATE '2024-05-01' + CAST(k % 60 AS INTEGER), '%Y-%m-%d') AS flood_date,
      CASE k % 3 WHEN 0 THEN 'medium' WHEN 1 THEN 'high' ELSE 'very_high' END AS severity,
      100 + k * 37 % 5000 AS affected_population, {_BASIN} AS ring FROM placed""", "placed")
_cte("areas", "SELECT * FROM ref_areas UNION ALL SELECT * FROM basins", "ref_areas", "basins")

_cte("raw_areas", f"""
    SELECT k + 1000 AS area_id, 'Basin ' || CAST(k % 40 AS VARCHAR) || note AS area_name,
      strftime(DATE '2024-05-01' + CAST(k % 60 AS INTEGER), '%Y-%m-%d') AS flood_date,
      CASE WHEN k % 5 <> 0 THEN 'high' END AS severity,
      CASE WHEN k % 7 <> 0 THEN 100 + k * 37 % 5000 END AS affected_population,
      k + late AS arrival,
      CASE k % 11
        WHEN 1 THEN {_ring([_at(0, 0), _at(9, 0), _at(9, 9), _at(0, 9)])}
        WHEN 2 THEN {_ring([_at(0, 0), _at(9, 0), _at(0, 0)])}
        WHEN 3 THEN {_ring([_at(0, 0), _at(9, 0), _at(4, 0), _at(0, 0)])}
        WHEN 4 THEN {_ring([_at(0, 0), _at(9, 9), _at(9, 0), _at(0, 12), _at(0, 0)])}
        WHEN 5 THEN {_ring([_at(0, 0), _at(8, 0), _at(8, 8), _at(4, 0), _at(0, 8), _at(0, 0)])}
        WHEN 6 THEN NULL
        WHEN 7 THEN {_ring([_at(0, 0), _at(9, 0), _at(9, 0), _at(9, 9), _at(0, 0)])}
        WHEN 8 THEN {_ring([_at(0, 0), _at(9, 0), _at(9, 9), _at(9, 14), _at(9, 9), _at(0, 9), _at(0, 0)])}
        ELSE {_BASIN} END AS ring
    FROM placed, (SELECT 0 AS late, '' AS note UNION ALL SELECT 1000000000, ' again') AS twice
    WHERE late = 0 OR k % 6 = 0""", "placed")

_cte("raw_people", """
    SELECT CAST(who AS VARCHAR) AS citizen_id, '  Citizen_' || printf('%03d', who) || ' ' AS name,
      ' Rua ' || CAST(o_orderkey % 997 AS VARCHAR) || '  ' AS address,
      CASE WHEN o_orderkey % 7 <> 0 THEN '51 99999-' || printf('%04d', o_orderkey % 10000) END AS phone,
      strftime(o_orderdate, '%Y-%m-%d') AS registration_date,
      CASE WHEN o_orderkey % 20 = 3 THEN NULL WHEN o_orderkey % 20 = 5 THEN 999e0
        ELSE CAST(-51350 + (o_orderkey * 7919) % 251 AS DOUBLE) / 1e3 END AS lon,
      CAST(-30080 + (o_orderkey * o_orderkey * 31 + o_orderkey * 17) % 233 AS DOUBLE) / 1e3 AS lat,
      o_orderkey AS arrival
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS who FROM orders) AS o""")

# --- geometry ----------------------------------------------------------------


def _edges(source: str, key: str) -> str:
    return f"""SELECT {key}, i, n, ring[i].x AS x1, ring[i].y AS y1, ring[i + 1].x AS x2, ring[i + 1].y AS y2
        FROM (SELECT {key}, ring, len(ring) - 1 AS n, unnest(range(1, len(ring))) AS i FROM {source}) AS r"""


def _inside(x: str, y: str) -> str:
    """HAVING text over the edges e of one area: strictly inside, even-odd, edges excluded."""
    side = f"((x2 - x1) * ({y} - y1) - ({x} - x1) * (y2 - y1))"
    return f"""sum(CASE WHEN (y1 > {y}) <> (y2 > {y}) AND (y2 > y1) = ({side} > 0) THEN 1 ELSE 0 END) % 2 = 1
        AND NOT bool_or({side} = 0 AND {x} BETWEEN least(x1, x2) AND greatest(x1, x2)
            AND {y} BETWEEN least(y1, y2) AND greatest(y1, y2))"""


_A, _E2 = 6378137.0, 0.00669437999014


def _kx(lat: str) -> str:
    return f"({math.pi / 180 * _A!r}e0 * cos(radians({lat})) / sqrt(1e0 - {_E2}e0 * sin(radians({lat})) * sin(radians({lat}))))"


def _ky(lat: str) -> str:
    return f"({math.pi / 180 * _A * (1 - _E2)!r}e0 / pow(1e0 - {_E2}e0 * sin(radians({lat})) * sin(radians({lat})), 1.5e0))"


def _edge_distances(points: str, edges: str, key: str) -> str:
    """Every (point, edge) with its distance in metres."""
    return f"""SELECT {key}, area_id, x1, y1, x2, y2, lon, lat,
          sqrt(pow(dx * {_kx('lat + dy / 2e0')}, 2) + pow(dy * {_ky('lat + dy / 2e0')}, 2)) AS metres
        FROM (SELECT *, (t * ex - px) / ratio AS dx, t * ey - py AS dy
          FROM (SELECT *, least(greatest((px * ex + py * ey) / (ex * ex + ey * ey), 0e0), 1e0) AS t
            FROM (SELECT *, (x2 - x1) * ratio AS ex, y2 - y1 AS ey, (lon - x1) * ratio AS px, lat - y1 AS py
              FROM (SELECT p.*, e.*, greatest({_kx('lat')} / {_ky('lat')}, 1e-9) AS ratio
                FROM {points} AS p, {edges} AS e) AS a) AS b) AS c) AS d"""


_cte("ref_edges", _edges("ref_areas", "area_id"), "ref_areas")
_cte("basin_edges", _edges("basins", "area_id"), "basins")
_cte("edges", _edges("areas", "area_id"), "areas")
_cte("ref_hits", f"SELECT citizen_id, area_id FROM people, ref_edges GROUP BY citizen_id, area_id, lon, lat HAVING {_inside('lon', 'lat')}",
     "people", "ref_edges")
_cte("hits", f"SELECT citizen_id, area_id FROM people, edges GROUP BY citizen_id, area_id, lon, lat HAVING {_inside('lon', 'lat')}",
     "people", "edges")
for _name, _edge_table in (("ref_distances", "ref_edges"), ("distances", "edges"), ("basin_distances", "basin_edges")):
    _cte(_name, f"""SELECT citizen_id, area_id, CASE WHEN {_inside('lon', 'lat')} THEN 0e0 ELSE min(metres) END AS metres
        FROM ({_edge_distances('people', _edge_table, 'citizen_id')}) AS m GROUP BY citizen_id, area_id, lon, lat""",
        "people", _edge_table)
_cte("table_now", """SELECT people.*, citizen_id IN (SELECT citizen_id FROM ref_hits) AS affected_by_flooding
    FROM people""", "people", "ref_hits")
_cte("table_later", """SELECT people.*, citizen_id IN (SELECT citizen_id FROM hits) AS affected_by_flooding
    FROM people""", "people", "hits")


def _num(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def _point_wkt(x: str, y: str) -> str:
    return f"'POINT(' || {_num(x)} || ' ' || {_num(y)} || ')'"


_RING_WKT = (
    "'POLYGON((' || array_to_string(list_transform(ring, lambda v: "
    f"{_num('v.x')} || ' ' || {_num('v.y')}), ',') || '))'"
)
_POINT_JSON = """'{"type":"Point","coordinates":[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']}'"""
_RING_JSON = (
    """'{"type":"Polygon","coordinates":[[' || array_to_string(list_transform(ring, lambda v: """
    """'[' || CAST(v.x AS VARCHAR) || ',' || CAST(v.y AS VARCHAR) || ']'), ',') || ']]}'"""
)


def _json_text(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


_CITIZEN_FEATURE = (
    "'{\"type\":\"Feature\",\"properties\":{\"id\":' || CAST(citizen_id AS VARCHAR) || ',\"name\":' || "
    f"{_json_text('name')} || ',\"address\":' || {_json_text('address')} || ',\"phone\":' || {_json_text('phone')} || "
    "',\"affected\":' || CAST(affected_by_flooding AS VARCHAR) || ',\"type\":\"citizen\"},\"geometry\":' || "
    f"{_POINT_JSON} || '}}'"
)
_AREA_FEATURE = (
    "'{\"type\":\"Feature\",\"properties\":{\"id\":' || CAST(area_id AS VARCHAR) || ',\"name\":' || "
    f"{_json_text('area_name')} || ',\"date\":' || {_json_text('flood_date')} || ',\"severity\":' || "
    f"{_json_text('severity')} || ',\"type\":\"flood_area\"}},\"geometry\":' || {_RING_JSON} || '}}'"
)

_BAD_POINT = "CASE WHEN lon IS NULL OR lat IS NULL THEN 'missing' WHEN abs(lon) > 180 OR abs(lat) > 90 THEN 'out_of_range' END"

# rings: edges without directly repeated vertices, all pairs of edges of a ring compared
_cte("raw_steps", """SELECT arrival, i, ring[i].x AS vx, ring[i].y AS vy FROM
    (SELECT arrival, ring, unnest(range(1, len(ring) + 1)) AS i FROM raw_areas) AS r
    WHERE i = 1 OR ring[i].x <> ring[i - 1].x OR ring[i].y <> ring[i - 1].y""", "raw_areas")
_cte("raw_edges", """SELECT * FROM (SELECT arrival, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY arrival) - 1 AS n,
      vx AS x1, vy AS y1, lead(vx) OVER w AS x2, lead(vy) OVER w AS y2
    FROM raw_steps WINDOW w AS (PARTITION BY arrival ORDER BY i)) AS s WHERE x2 IS NOT NULL""", "raw_steps")


def _turn(a: str, b: str, p: str) -> str:
    """Sign of the turn a → b → p; each given as 'table.end', e.g. ``e.1``."""
    (ta, ia), (tb, ib), (tp, ip) = (v.split(".") for v in (a, b, p))
    return (
        f"sign(({tb}.x{ib} - {ta}.x{ia}) * ({tp}.y{ip} - {ta}.y{ia}) "
        f"- ({tp}.x{ip} - {ta}.x{ia}) * ({tb}.y{ib} - {ta}.y{ia}))"
    )


_TOUCH = f"""greatest(least(e.x1, e.x2), least(f.x1, f.x2)) <= least(greatest(e.x1, e.x2), greatest(f.x1, f.x2))
    AND greatest(least(e.y1, e.y2), least(f.y1, f.y2)) <= least(greatest(e.y1, e.y2), greatest(f.y1, f.y2))
    AND {_turn('e.1', 'e.2', 'f.1')} * {_turn('e.1', 'e.2', 'f.2')} <= 0
    AND {_turn('f.1', 'f.2', 'e.1')} * {_turn('f.1', 'f.2', 'e.2')} <= 0"""

_cte("crossed", f"""SELECT DISTINCT e.arrival FROM raw_edges AS e JOIN raw_edges AS f ON e.arrival = f.arrival AND e.i <> f.i
    WHERE CASE WHEN f.i = (e.i + 1) % e.n THEN {_turn('e.1', 'e.2', 'f.2')} = 0
        AND (e.x2 - e.x1) * (f.x2 - f.x1) + (e.y2 - e.y1) * (f.y2 - f.y1) < 0
      WHEN e.i = (f.i + 1) % e.n THEN false ELSE {_TOUCH} END""", "raw_edges")
_cte("ring_sizes", """SELECT arrival, sum((x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy)) AS a2
    FROM (SELECT e.*, first_value(x1) OVER w AS ox, first_value(y1) OVER w AS oy
      FROM raw_edges AS e WINDOW w AS (PARTITION BY arrival ORDER BY i)) AS o GROUP BY arrival""", "raw_edges")
_cte("checked_areas", """SELECT *, invalid_reason IS NULL AS geometry_valid FROM (SELECT raw_areas.*,
      CASE WHEN ring IS NULL THEN 'missing' WHEN len(ring) < 4 THEN 'too_few_vertices'
        WHEN ring[1].x <> ring[len(ring)].x OR ring[1].y <> ring[len(ring)].y THEN 'not_closed'
        WHEN coalesce(a2, 0) = 0 THEN 'zero_area'
        WHEN raw_areas.arrival IN (SELECT arrival FROM crossed) THEN 'self_intersection' END AS invalid_reason
    FROM raw_areas LEFT JOIN ring_sizes ON raw_areas.arrival = ring_sizes.arrival) AS c""",
     "raw_areas", "ring_sizes", "crossed")
_cte("checked_people", f"""SELECT *, invalid_reason IS NULL AS geometry_valid
    FROM (SELECT *, {_BAD_POINT} AS invalid_reason FROM raw_people) AS c""", "raw_people")
_cte("silver_people", """SELECT CAST(citizen_id AS BIGINT) AS citizen_id, trim(name) AS name, trim(address) AS address,
      coalesce(phone, 'N/A') AS phone, registration_date, lon, lat, arrival
    FROM (SELECT *, row_number() OVER (PARTITION BY citizen_id ORDER BY arrival) AS rn FROM checked_people WHERE geometry_valid) AS r
    WHERE rn = 1""", "checked_people")
_cte("silver_areas", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY arrival) AS rn
    FROM checked_areas WHERE geometry_valid) AS r WHERE rn = 1""", "checked_areas")
_cte("silver_edges", _edges("silver_areas", "area_id"), "silver_areas")
_cte("silver_hits", f"""SELECT citizen_id, area_id FROM silver_people, silver_edges
    GROUP BY citizen_id, area_id, lon, lat HAVING {_inside('lon', 'lat')}""", "silver_people", "silver_edges")
_cte("silver_pairs", """SELECT p.*, h.area_id AS affected_area_id, h.area_id IS NOT NULL AS affected_by_flooding
    FROM silver_people AS p LEFT JOIN silver_hits AS h ON p.citizen_id = h.citizen_id""", "silver_people", "silver_hits")

_FLAG_OLD = "CASE citizen_id % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END"
_cte("table_before", f"""SELECT citizen_id, name, {_FLAG_OLD} AS affected_by_flooding FROM (
    SELECT citizen_id, 'Old ' || name AS name FROM people
    UNION ALL SELECT citizen_id + 10000000, 'Gone ' || name FROM people) AS b""", "people")


def _hash(key: str, stream: str) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '/{stream}'), 1, 8) AS BIGINT) AS DOUBLE)"


def _normal(key: str, stream: str, mean: str, sigma: float) -> str:
    u1 = f"({_hash(key, stream + '/u1')} + 1e0) / 4294967297e0"
    u2 = f"{_hash(key, stream + '/u2')} / 4294967296e0"
    return f"({mean} + {sigma}e0 * sqrt(-2e0 * ln({u1})) * cos(6.283185307179586e0 * {u2}))"


def _sample_axis(key: str, name: str, i: int) -> str:
    def base(stream: str, bases: list) -> str:
        values = ", ".join(f"{b[i]}e0" for b in bases)
        return f"[{values}][1 + CAST({_hash(key, stream)} AS BIGINT) % {len(bases)}]"

    risk = _normal(key, f"risk/{name}", base("risk/base", RISK_BASES), RISK_SIGMA)
    safe = _normal(key, f"safe/{name}", base("safe/base", SAFE_BASES), SAFE_SIGMA)
    return f"round(CASE WHEN {key} % 100 < 60 THEN {risk} ELSE {safe} END, 6) AS {name}"


def _sample(table: str, key: str) -> str:
    return f"""SELECT {key} AS citizen_id, 'Citizen_' || printf('%03d', {key}) AS name,
        'Rua ' || CAST({key} AS VARCHAR) || ', nº ' || CAST(1 + CAST({_hash(key, 'house')} AS BIGINT) % 999 AS VARCHAR)
          || ', Porto Alegre' AS address, '51 99999-' || printf('%04d', {key}) AS phone,
        strftime(DATE '2024-01-01' + CAST({key} % 36500 AS INTEGER), '%Y-%m-%d') AS registration_date,
        {_sample_axis(key, 'lon', 0)}, {_sample_axis(key, 'lat', 1)} FROM {table}"""


_cte("sample", _sample("customer", "c_custkey"))
_cte("more_sample", _sample("supplier", "s_suppkey"))

_cte("drops", """SELECT citizen_id, name || ' v1' AS name, lon, lat, 1 AS drop_no FROM people WHERE citizen_id % 7 <> 0
    UNION ALL SELECT citizen_id, name || ' v2', lon, lat, 2 FROM people WHERE phone IS NULL
    UNION ALL SELECT citizen_id, name || ' v3', lon, lat, 3 FROM people WHERE lat > -29.95e0""", "people")

_COUNTS = """count(*) AS total_citizens, count(CASE WHEN affected_by_flooding THEN 1 END) AS affected,
    count(CASE WHEN NOT affected_by_flooding THEN 1 END) AS unaffected"""
_SHARE = _COUNTS + """, round(100e0 * count(CASE WHEN affected_by_flooding THEN 1 END) / nullif(count(*), 0), 2) AS affected_pct"""
# a category wants rows of one flag, or all
_SUMMARY = """SELECT category, CAST(coalesce(sum(n) FILTER (WHERE wanted IS NULL OR flag = wanted), 0) AS BIGINT) AS count,
    CASE WHEN wanted IS NULL THEN 0e0 ELSE round(100e0 * coalesce(sum(n) FILTER (WHERE flag = wanted), 0) / nullif(sum(n), 0), 2) END AS percentage
    FROM (VALUES ('total', NULL), ('affected', true), ('unaffected', false)) AS c(category, wanted),
      (SELECT affected_by_flooding AS flag, count(*) AS n FROM table_now GROUP BY affected_by_flooding) AS t
    GROUP BY category, wanted"""
_INGESTED = """SELECT 'citizens_data.csv' AS source, 'csv' AS source_type, 'success' AS status,
      CAST((SELECT count(*) FROM people) AS BIGINT) AS records
    UNION ALL SELECT 'citizens_data.geojson', 'geojson', 'success', (SELECT count(*) FROM areas)
    UNION ALL SELECT 'no_coordinates.csv', 'csv', 'error', NULL"""
_cte("ingested", _INGESTED, "people", "areas")

_DATE_TEXTS = """(SELECT o_orderkey, o_orderdate, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS lenient FROM orders) AS d"""

_cte("touching", f"""SELECT DISTINCT e.area_id, f.area_id AS other_id FROM edges AS e JOIN edges AS f ON
    greatest(least(e.x1, e.x2), least(f.x1, f.x2)) <= least(greatest(e.x1, e.x2), greatest(f.x1, f.x2)) AND {_TOUCH}""", "edges")
_cte("starts", "SELECT area_id AS start_id, ring[1].x AS lon, ring[1].y AS lat FROM areas", "areas")
_cte("holding", f"""SELECT area_id, start_id FROM starts, edges GROUP BY area_id, start_id, lon, lat
    HAVING {_inside('lon', 'lat')}""", "starts", "edges")

_cte("centre_distances", f"""SELECT area_id, round(CASE WHEN {_inside('lon', 'lat')} THEN 0e0 ELSE min(metres) END, 2) AS distance_m
        FROM ({_edge_distances('(SELECT 0 AS one, -51.2093e0 AS lon, -30.0326e0 AS lat)', 'edges', 'one')}) AS m
        GROUP BY area_id, lon, lat""", "edges")
_cte("centroids", """SELECT area_id, round(ox + sum((x1 + x2 - 2 * ox) * w) / (3 * sum(w)), 9) AS lon,
        round(oy + sum((y1 + y2 - 2 * oy) * w) / (3 * sum(w)), 9) AS lat
        FROM (SELECT e.*, ring[1].x AS ox, ring[1].y AS oy,
          (x1 - ring[1].x) * (y2 - ring[1].y) - (x2 - ring[1].x) * (y1 - ring[1].y) AS w
          FROM edges AS e JOIN areas ON e.area_id = areas.area_id) AS m GROUP BY area_id, ox, oy""", "edges", "areas")

# areas with holes and parts: their boxes in order, b the box in thousandths of a degree from the corner
_cte("lake_boxes", """
    SELECT area_id, no, part, shell, CAST(x + b[1] AS DOUBLE) / 1e3 AS x0, CAST(y + b[2] AS DOUBLE) / 1e3 AS y0,
      CAST(x + b[3] AS DOUBLE) / 1e3 AS x1, CAST(y + b[4] AS DOUBLE) / 1e3 AS y1, b
    FROM (SELECT k + 1000 AS area_id, x, y, 0 AS no, 0 AS part, true AS shell, [0, 0, w + 12, h + 12] AS b FROM placed
      UNION ALL SELECT k + 1000, x, y, 1, 0, false, [3, 3, 9, 9] FROM placed
      UNION ALL SELECT k + 1000, x, y, 2, 0, false, [11, 11, 15, 15] FROM placed WHERE k % 3 = 0
      UNION ALL SELECT k + 1000, x, y, 3, 1, true, [w + 20, 0, w + 30, 6] FROM placed WHERE k % 2 = 0
      UNION ALL SELECT k + 1000, x, y, 4, 2, true, [5, 5, 7, 7] FROM placed WHERE k % 4 = 0) AS u""", "placed")
# inside an odd number of the boxes of an area that have nothing but boxes inside one another
_cte("lake_hits", """SELECT citizen_id, area_id FROM people, lake_boxes WHERE lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1
    GROUP BY citizen_id, area_id HAVING count(*) % 2 = 1 AND bool_and(lon > x0 AND lon < x1 AND lat > y0 AND lat < y1)""", "people", "lake_boxes")
_cte("lake_edges", """SELECT area_id, no, unnest([x0, x1, x1, x0]) AS x1, unnest([y0, y0, y1, y1]) AS y1,
    unnest([x1, x1, x0, x0]) AS x2, unnest([y0, y1, y1, y0]) AS y2 FROM lake_boxes""", "lake_boxes")
_cte("lake_distances", f"""SELECT citizen_id, area_id, CASE WHEN {_inside('lon', 'lat')} THEN 0e0 ELSE min(metres) END AS metres
    FROM ({_edge_distances('people', 'lake_edges', 'citizen_id')}) AS m GROUP BY citizen_id, area_id, lon, lat""", "people", "lake_edges")
_cte("lake_text", f"""SELECT area_id, max(part) > 0 AS several, string_agg(CASE WHEN no = 0 THEN '' WHEN shell THEN ')),((' ELSE '),(' END || array_to_string(
    [a || ' ' || b, c || ' ' || b, c || ' ' || d, a || ' ' || d, a || ' ' || b], ','), '' ORDER BY no) AS body
    FROM (SELECT *, CAST(x0 AS VARCHAR) AS a, CAST(y0 AS VARCHAR) AS b, CAST(x1 AS VARCHAR) AS c, CAST(y1 AS VARCHAR) AS d FROM (SELECT * EXCLUDE (b) FROM lake_boxes)) AS t
    GROUP BY area_id""", "lake_boxes")
_LAKE_WKT = """replace(CASE WHEN several THEN 'MULTIPOLYGON(((' || body || ')))' ELSE 'POLYGON((' || body || '))' END, '.0 ', ' ')"""

# --- the queries -------------------------------------------------------------

ORACLES: dict[str, str] = {
    "flagship_affected_share": sql(f"""SELECT {_SHARE} FROM (SELECT h.area_id IS NOT NULL AS affected_by_flooding
        FROM people AS p LEFT JOIN ref_hits AS h ON p.citizen_id = h.citizen_id) AS c""", "people", "ref_hits"),
    "s1_csv_points": sql("SELECT citizen_id, name, address, phone, lon, lat FROM people", "people"),
    "s1_damaged_records": sql("""SELECT citizen_id, CASE WHEN citizen_id % 7 <> 0 THEN lon END AS lon, lat,
        citizen_id % 7 = 0 OR citizen_id % 11 = 0 AS damaged,
        CASE WHEN citizen_id % 7 = 0 THEN citizen_id || ',' || lat
            WHEN citizen_id % 11 = 0 THEN citizen_id || ',' || lat || ',' || lon || ',more' END AS record FROM people""", "people"),
    "s3_box_scan": sql("""SELECT citizen_id, lon, lat FROM people
        WHERE lon BETWEEN -51.25e0 AND -51.18e0 AND lat BETWEEN -30.06e0 AND -30e0""", "people"),
    "s3_box_areas": sql("""SELECT a.area_id, a.area_name FROM areas AS a JOIN (SELECT area_id, min(least(x1, x2)) AS x0, max(greatest(x1, x2)) AS x1,
          min(least(y1, y2)) AS y0, max(greatest(y1, y2)) AS y1 FROM edges GROUP BY area_id) AS b ON a.area_id = b.area_id
        WHERE b.x0 <= -51.18e0 AND b.x1 >= -51.25e0 AND b.y0 <= -30e0 AND b.y1 >= -30.06e0""", "areas", "edges"),
    "s2_geojson_points": sql("SELECT citizen_id, name, phone, 'Point' AS geometry_type, lon, lat FROM people", "people"),
    "s2_geojson_areas": sql(f"SELECT area_id, area_name, 'Polygon' AS geometry_type, {_RING_WKT} AS wkt FROM areas", "areas"),
    "s3_layer_scan": sql("SELECT citizen_id, lon, lat FROM people WHERE lat > -29.95e0", "people"),
    "s3_wkb_scan": sql(f"SELECT area_id, {_RING_WKT} AS wkt FROM areas", "areas"),
    "s4_layer_overwrite": sql("SELECT area_id, area_name, severity FROM basins", "basins"),
    "s5_csv_export": sql("""SELECT citizen_id, name, CAST(lon AS VARCHAR) AS longitude, CAST(lat AS VARCHAR) AS latitude
        FROM people""", "people"),
    "s6_geojson_export": sql(f"""SELECT '{{"type":"Feature","properties":{{"citizen_id":' || CAST(citizen_id AS VARCHAR)
        || ',"name":"' || name || '","phone":' || {_json_text('phone')} || '}},"geometry":' || {_POINT_JSON} || '}}' AS feature
        FROM people""", "people"),
    "s2_mixed_folder": sql("""SELECT 'Point' AS geometry_type, false AS malformed, count(*) AS features, CAST(NULL AS BIGINT) AS vertices
        FROM people UNION ALL SELECT 'Polygon', false, count(*), CAST(sum(len(ring)) AS BIGINT) FROM areas""", "people", "areas"),
    "s2_any_layout": sql("""SELECT layout, false AS malformed, count(*) AS features, count(DISTINCT area_id) AS areas,
        CAST(sum(len(ring)) AS BIGINT) AS vertices FROM areas, (SELECT unnest(['one_line', 'beside_the_frame', 'frame_over_lines',
        'feature_over_lines', 'no_collection']) AS layout) AS l GROUP BY layout""", "areas"),
    "s2_lakes": sql(f"""SELECT area_id, CASE WHEN several THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
        {_LAKE_WKT} AS wkt, true AS same FROM lake_text""", "lake_text"),
    "s3_wkb_lakes": sql(f"SELECT area_id, {_LAKE_WKT} AS wkt FROM lake_text", "lake_text"),
    "s3_wkb_points": sql("SELECT citizen_id, lon, lat FROM people", "people"),
    "p3_lake_validity": sql("""SELECT *, invalid_reason IS NULL AS geometry_valid FROM (SELECT k + 1000 AS area_id, CASE WHEN k % 9 = 1 OR k % 9 = 4 AND k % 2 = 1
        THEN 'hole_outside' WHEN k % 9 = 2 THEN 'parts_overlap' WHEN k % 9 = 3 THEN 'self_intersection' WHEN k % 9 = 5 THEN 'too_few_vertices' END AS invalid_reason
        FROM placed) AS p""", "placed"),
    "j1_within_lakes": sql("SELECT citizen_id, area_id FROM lake_hits", "lake_hits"),
    "j6_distance_to_lakes": sql("SELECT citizen_id, round(min(metres), 2) AS min_distance_m FROM lake_distances GROUP BY citizen_id", "lake_distances"),
    "j10_basins_meet_lakes": sql(f"""SELECT DISTINCT e.area_id AS basin_id, f.area_id FROM basin_edges AS e JOIN lake_edges AS f ON
          greatest(least(e.x1, e.x2), least(f.x1, f.x2)) <= least(greatest(e.x1, e.x2), greatest(f.x1, f.x2)) AND {_TOUCH}
        UNION SELECT basin_id, area_id FROM (SELECT area_id AS basin_id, ring[1].x AS px, ring[1].y AS py FROM basins) AS b, lake_boxes
          WHERE px > x0 AND px < x1 AND py > y0 AND py < y1 GROUP BY basin_id, area_id HAVING count(*) % 2 = 1
        UNION SELECT basin_id, area_id FROM (SELECT e.area_id AS basin_id, c.area_id, c.no FROM basin_edges AS e, (SELECT area_id, no, x0 AS lon, y0 AS lat FROM lake_boxes) AS c
          GROUP BY e.area_id, c.area_id, c.no, c.lon, c.lat HAVING {_inside('c.lon', 'c.lat')}) AS i""", "basin_edges", "lake_edges", "basins", "lake_boxes"),
    "f5_lake_measures": sql("""SELECT area_id, min(x0) AS xmin, min(y0) AS ymin, max(x1) AS xmax, max(y1) AS ymax,
        round(sum(s * a * (x0 + x1) / 2e0) / sum(s * a), 9) AS lon, round(sum(s * a * (y0 + y1) / 2e0) / sum(s * a), 9) AS lat,
        round(CAST(sum(s * a) AS DOUBLE), 6) AS area
        FROM (SELECT *, CASE WHEN shell THEN 1 ELSE -1 END AS s, (b[3] - b[1]) * (b[4] - b[2]) AS a FROM lake_boxes) AS m GROUP BY area_id""", "lake_boxes"),
    "s7_ingest_sources": sql("SELECT * FROM ingested", "ingested"),
    "s8_source_report": sql("""SELECT count(*) AS total_files, count(*) FILTER (WHERE status = 'success') AS successful,
        count(*) FILTER (WHERE status = 'error') AS failed, CAST(sum(records) AS BIGINT) AS total_records FROM ingested""", "ingested"),
    "s9_store_copy": sql("SELECT citizen_id, name, lon, lat FROM people", "people"),
    "s10_table_load": sql("""SELECT area_id, area_name, flood_date, coalesce(severity, 'unknown') AS severity,
        coalesce(affected_population, 0) AS affected_population FROM silver_areas""", "silver_areas"),
    "s11_refresh_citizens": sql("""SELECT citizen_id, name, affected_by_flooding FROM table_now UNION ALL
        SELECT * FROM table_before WHERE affected_by_flooding IS NULL AND citizen_id NOT IN (SELECT citizen_id FROM table_now)""",
        "table_now", "table_before"),
    "s11_upsert_citizens": sql("""SELECT citizen_id, name, affected_by_flooding FROM table_now UNION ALL
        SELECT * FROM table_before WHERE citizen_id NOT IN (SELECT citizen_id FROM table_now)""", "table_now", "table_before"),
    "s11_upsert_flag_only": sql("""SELECT b.citizen_id, b.name,
        CASE WHEN n.citizen_id IS NULL THEN b.affected_by_flooding ELSE n.affected_by_flooding END AS affected_by_flooding
        FROM table_before AS b LEFT JOIN table_now AS n ON b.citizen_id = n.citizen_id""", "table_now", "table_before"),
    "s12_run_log": sql("""SELECT '2024-07-01T02:00:00' AS run_date, count(*) AS total_citizens,
        count(*) FILTER (WHERE affected_by_flooding) AS affected_citizens,
        count(*) FILTER (WHERE NOT affected_by_flooding) AS unaffected_citizens, 'success' AS status, 'first' AS run_id,
        15e-1 AS processing_time_seconds FROM table_now
        UNION ALL SELECT '2024-07-02T02:00:00', count(*), count(*) FILTER (WHERE affected_by_flooding),
        count(*) FILTER (WHERE NOT affected_by_flooding), 'success', 'second', 2e0 FROM table_later""", "table_now", "table_later"),
    "s13_sample_citizens": sql("SELECT * FROM sample", "sample"),
    "s14_delete_rows": sql("SELECT citizen_id, name FROM table_now WHERE NOT affected_by_flooding", "table_now"),
    "s15_medallion": sql(f"SELECT {_SHARE} FROM silver_pairs", "silver_pairs"),
    "p1_affected": sql("SELECT citizen_id, name FROM table_now WHERE affected_by_flooding", "table_now"),
    "p1_unaffected": sql("SELECT citizen_id, name FROM table_now WHERE NOT affected_by_flooding", "table_now"),
    "p2_tolerant_projection": sql("SELECT name, citizen_id, phone FROM people", "people"),
    "p3_point_validity": sql("SELECT arrival, invalid_reason, geometry_valid FROM checked_people", "checked_people"),
    "p3_ring_validity": sql("SELECT arrival, area_id, invalid_reason, geometry_valid FROM checked_areas", "checked_areas"),
    "p4_quarantine": sql("""SELECT 'citizens' AS source, invalid_reason, count(*) AS records FROM checked_people
        WHERE NOT geometry_valid GROUP BY invalid_reason UNION ALL
        SELECT 'areas', invalid_reason, count(*) FROM checked_areas WHERE NOT geometry_valid GROUP BY invalid_reason""",
        "checked_people", "checked_areas"),
    "p5_standard_types": sql("""SELECT arrival, CAST(citizen_id AS BIGINT) AS citizen_id, 'timestamp' AS date_type,
        registration_date || 'T00:00:00' AS registration_date FROM raw_people""", "raw_people"),
    "p6_phone_fill": sql("SELECT arrival, coalesce(phone, 'N/A') AS phone FROM raw_people", "raw_people"),
    "p7_trim": sql("SELECT arrival, trim(name) AS name, trim(address) AS address FROM raw_people", "raw_people"),
    "p8_control_columns": sql("""SELECT citizen_id, '2024-07-01T02:00:00' AS normalized_date, 1e0 AS data_quality_score
        FROM people""", "people"),
    "p9_source_columns": sql("""SELECT citizen_id, '2024-07-01T02:00:00' AS _processed_date, 'csv' AS _source_type,
        'validated' AS _data_quality FROM people""", "people"),
    "p10_auto_dates": sql("""SELECT arrival, registration_date,
        CASE WHEN arrival % 9 <> 0 THEN registration_date END AS seen, CASE WHEN arrival % 9 = 0 THEN 'unknown' END AS seen_text,
        lower(phone) AS phone FROM raw_people""", "raw_people"),
    "p11_auto_lowercase": """SELECT doc_id,
        CASE WHEN (SELECT max(length(text)) FROM documents) < 100 THEN lower(text) ELSE text END AS text,
        lower(lang) AS lang, lower(source) AS source FROM documents""",
    "p12_classified": sql("""SELECT p.citizen_id, h.area_id IS NOT NULL AS affected_by_flooding, h.area_id AS affected_area_id
        FROM people AS p LEFT JOIN ref_hits AS h ON p.citizen_id = h.citizen_id""", "people", "ref_hits"),
    "p12_published_affected": sql("""SELECT p.citizen_id, p.name, p.phone, p.affected_area_id, a.area_name, a.severity,
        1e0 AS data_quality_score, '2024-07-01T02:00:00' AS processing_date
        FROM silver_pairs AS p JOIN silver_areas AS a ON p.affected_area_id = a.area_id""", "silver_pairs", "silver_areas"),
    "p12_published_unaffected": sql("""SELECT citizen_id, name, affected_by_flooding FROM silver_pairs
        WHERE NOT affected_by_flooding""", "silver_pairs"),
    "p12_published_all": sql("SELECT citizen_id, affected_by_flooding, affected_area_id FROM silver_pairs", "silver_pairs"),
    "p13_defaults": sql("""SELECT arrival, area_name, coalesce(severity, 'unknown') AS severity,
        coalesce(affected_population, 0) AS affected_population, 'new' AS status FROM raw_areas""", "raw_areas"),
    "p14_export_guard": sql("""SELECT arrival AS id, 'citizen' AS type FROM raw_people
        WHERE lon IS NOT NULL AND lat IS NOT NULL""", "raw_people"),
    "p15_markers": sql("""SELECT citizen_id, CASE WHEN affected_by_flooding THEN 'red' ELSE 'blue' END AS marker_colour,
        CASE WHEN affected_by_flooding THEN 'exclamation-triangle' ELSE 'info-sign' END AS marker_icon,
        CASE WHEN affected_by_flooding THEN 'AFETADO' ELSE 'SEGURO' END AS marker_label FROM table_now""", "table_now"),
    "p16_contract_violations": sql("""SELECT 'bad_geometry' AS violation, count(*) AS rows FROM checked_people WHERE NOT geometry_valid
        UNION ALL SELECT 'duplicate_key', count(*) FROM raw_people WHERE citizen_id IN
        (SELECT citizen_id FROM raw_people GROUP BY citizen_id HAVING count(*) > 1)""", "raw_people", "checked_people"),
    "j1_left_within": sql("""SELECT p.citizen_id, p.name, a.area_id, a.area_name, a.flood_date, a.severity, a.affected_population
        FROM people AS p LEFT JOIN ref_hits AS h ON p.citizen_id = h.citizen_id
        LEFT JOIN ref_areas AS a ON h.area_id = a.area_id""", "people", "ref_hits", "ref_areas"),
    "j1_left_within_basins": sql("""SELECT p.citizen_id, a.area_id, a.severity FROM people AS p
        LEFT JOIN hits AS h ON p.citizen_id = h.citizen_id LEFT JOIN areas AS a ON h.area_id = a.area_id""", "people", "hits", "areas"),
    "j1_left_within_shuffled": sql("""SELECT p.citizen_id, a.area_id, a.severity FROM people AS p
        LEFT JOIN hits AS h ON p.citizen_id = h.citizen_id LEFT JOIN areas AS a ON h.area_id = a.area_id""", "people", "hits", "areas"),
    "j2_inner_within": sql("SELECT citizen_id, area_id FROM hits", "hits"),
    "j3_contains_first_rows": sql(f"""SELECT p.citizen_id, p.name, a.area_name, {_point_wkt('lon', 'lat')} AS geometry
        FROM people AS p LEFT JOIN ref_hits AS h ON p.citizen_id = h.citizen_id LEFT JOIN ref_areas AS a ON h.area_id = a.area_id
        ORDER BY p.citizen_id, a.area_name NULLS FIRST LIMIT 10""", "people", "ref_hits", "ref_areas"),
    "j3_contains_left": sql("""SELECT a.area_id, a.area_name, h.citizen_id FROM areas AS a
        LEFT JOIN hits AS h ON a.area_id = h.area_id""", "areas", "hits"),
    "j4_affected_per_area": sql("""SELECT a.area_name, count(t.citizen_id) AS affected_count FROM areas AS a
        LEFT JOIN hits AS h ON a.area_id = h.area_id LEFT JOIN table_now AS t ON h.citizen_id = t.citizen_id
        WHERE t.affected_by_flooding GROUP BY a.area_name""", "areas", "hits", "table_now"),
    "j5_citizens_per_area": sql("""SELECT a.area_id, a.area_name, count(h.citizen_id) AS citizen_count FROM areas AS a
        LEFT JOIN hits AS h ON a.area_id = h.area_id GROUP BY a.area_id, a.area_name""", "areas", "hits"),
    "j6_min_distance": sql("""SELECT p.citizen_id, p.name, round(min(metres), 2) AS min_distance_meters
        FROM people AS p JOIN ref_distances AS d ON p.citizen_id = d.citizen_id GROUP BY p.citizen_id, p.name""", "people", "ref_distances"),
    "j7_anti": sql("SELECT citizen_id, name FROM people WHERE citizen_id NOT IN (SELECT citizen_id FROM hits)", "people", "hits"),
    "j8_semi": sql("SELECT citizen_id, name FROM people WHERE citizen_id IN (SELECT citizen_id FROM hits)", "people", "hits"),
    "j9_within_distance": sql("""SELECT citizen_id, area_id, round(metres, 2) AS distance_m FROM distances
        WHERE metres <= 500e0""", "distances"),
    "j10_areas_intersect": sql("""SELECT area_id, other_id FROM touching UNION SELECT area_id, start_id FROM holding
        UNION SELECT start_id, area_id FROM holding""", "touching", "holding"),
    "a1_counts": sql("""SELECT count(*) AS total_citizens, count(*) FILTER (WHERE affected_by_flooding) AS affected_citizens
        FROM table_now""", "table_now"),
    "a2_conditional_counts": sql(f"SELECT {_COUNTS} FROM table_now", "table_now"),
    "a3_filtered_counts": sql("""SELECT count(*) AS total_citizens, count(*) FILTER (WHERE affected_by_flooding) AS affected_citizens,
        count(*) FILTER (WHERE NOT affected_by_flooding) AS unaffected_citizens, 'success' AS status FROM table_now""", "table_now"),
    "a4_share": sql(f"SELECT {_SHARE} FROM table_now", "table_now"),
    "a5_count_per_area": sql("""SELECT a.severity, a.area_name, count(*) AS citizens FROM hits AS h
        JOIN areas AS a ON h.area_id = a.area_id GROUP BY a.severity, a.area_name""", "hits", "areas"),
    "a6_min_distance_basins": sql("""SELECT citizen_id, round(min(metres), 2) AS min_distance_meters FROM basin_distances
        GROUP BY citizen_id""", "basin_distances"),
    "a7_extent": sql(f"""SELECT *, 'POLYGON((' || {_num('xmin')} || ' ' || {_num('ymin')} || ',' || {_num('xmin')} || ' ' || {_num('ymax')}
        || ',' || {_num('xmax')} || ' ' || {_num('ymax')} || ',' || {_num('xmax')} || ' ' || {_num('ymin')} || ','
        || {_num('xmin')} || ' ' || {_num('ymin')} || '))' AS bbox
        FROM (SELECT min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax FROM people) AS b""", "people"),
    "a7_extent_areas": sql(f"""SELECT *, 'POLYGON((' || {_num('xmin')} || ' ' || {_num('ymin')} || ',' || {_num('xmin')} || ' ' || {_num('ymax')}
        || ',' || {_num('xmax')} || ' ' || {_num('ymax')} || ',' || {_num('xmax')} || ' ' || {_num('ymin')} || ','
        || {_num('xmin')} || ' ' || {_num('ymin')} || '))' AS bbox
        FROM (SELECT (SELECT count(*) FROM areas) AS total_features, min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax
          FROM edges) AS b""", "areas", "edges"),
    "a8_scalar_subquery_share": sql("""SELECT area_id, count(*) AS citizens,
        round(count(*) * 100e0 / (SELECT count(*) FROM people), 2) AS percentage FROM hits GROUP BY area_id""", "hits", "people"),
    "a9_gold_summary": sql("""SELECT count(*) AS evaluated, count(h.area_id) AS affected, count(*) - count(h.area_id) AS unaffected
        FROM people AS p LEFT JOIN hits AS h ON p.citizen_id = h.citizen_id""", "people", "hits"),
    "a10_quality_profile": sql("""SELECT count(*) AS records, count(*) FILTER (WHERE geometry_valid) AS valid_geometries,
        bool_and(geometry_valid) AS all_valid, count(*) FILTER (WHERE phone IS NULL) AS null_phone,
        count(*) FILTER (WHERE lon IS NULL) AS null_lon, count(*) FILTER (WHERE name IS NULL) AS null_name,
        avg(1e0) AS mean_quality FROM checked_people""", "checked_people"),
    "a11_source_records": sql("SELECT CAST(sum(records) AS BIGINT) AS total_records FROM ingested", "ingested"),
    "a12_geometry_kinds": sql("""SELECT 'Point' AS geometry_type, count(*) AS features, true AS all_valid FROM people
        UNION ALL SELECT 'Polygon', count(*), true FROM areas""", "people", "areas"),
    "a13_layer_inventory": sql("""SELECT 'bronze' AS layer, CAST(4 AS BIGINT) AS files, count(*) AS rows FROM raw_people
        UNION ALL SELECT 'silver', 3, count(*) FROM silver_people UNION ALL SELECT 'gold', 2, count(*) FROM people""",
        "raw_people", "silver_people", "people"),
    "w1_keep_first": sql("""SELECT citizen_id, arrival, address, lon, lat FROM (SELECT *, row_number() OVER
        (PARTITION BY citizen_id ORDER BY arrival) AS rn FROM checked_people WHERE geometry_valid) AS r WHERE rn = 1""", "checked_people"),
    "w1_keep_first_areas": sql("SELECT area_id, arrival, area_name FROM silver_areas", "silver_areas"),
    "w2_order_by_id": sql("SELECT citizen_id, name, phone FROM table_now ORDER BY citizen_id", "table_now"),
    "w3_latest_first": """SELECT o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS run_date FROM orders
        ORDER BY run_date DESC, run_id""",
    "w4_top_nearest": sql("""SELECT p.citizen_id, p.name, round(min(metres), 2) AS min_distance_meters
        FROM people AS p JOIN ref_distances AS d ON p.citizen_id = d.citizen_id
        GROUP BY p.citizen_id, p.name ORDER BY min_distance_meters, p.citizen_id LIMIT 10""", "people", "ref_distances"),
    "w5_first_affected": sql(f"""SELECT citizen_id, name, address, {_point_wkt('lon', 'lat')} AS location, affected_by_flooding
        FROM table_now WHERE affected_by_flooding ORDER BY citizen_id LIMIT 10""", "table_now"),
    "w5_geometry_listing": sql(f"""SELECT area_id AS id, {_RING_JSON} AS geometry, '{{"area_name":"' || area_name || '","severity":"'
        || severity || '","affected_population":' || CAST(affected_population AS VARCHAR) || '}}' AS properties
        FROM areas ORDER BY area_id LIMIT 100""", "areas"),
    "w6_nearest_area": sql("""SELECT citizen_id, area_id, round(metres, 2) AS min_distance_meters FROM (SELECT *, row_number() OVER
        (PARTITION BY citizen_id ORDER BY metres, area_id) AS rn FROM ref_distances) AS r WHERE rn = 1""", "ref_distances"),
    "u1_summary": sql(_SUMMARY, "table_now"),
    "u1_summary_sql": sql(_SUMMARY, "table_now"),
    "u2_feature_union": sql(f"""SELECT citizen_id AS id, 'citizen' AS type, {_CITIZEN_FEATURE} AS feature FROM table_now
        UNION ALL SELECT area_id, 'flood_area', {_AREA_FEATURE} FROM areas""", "table_now", "areas"),
    "u3_id_difference": sql("SELECT citizen_id FROM people EXCEPT SELECT citizen_id FROM hits", "people", "hits"),
    "u4_point_union": sql("""SELECT citizen_id, name, lon, lat FROM sample
        UNION ALL SELECT citizen_id, name, lon, lat FROM more_sample""", "sample", "more_sample"),
    "u5_view": sql(f"SELECT * FROM ({_SUMMARY}) AS v WHERE count > 0", "table_now"),
    "u6_list_tables": sql("""SELECT 'tidegrid_areas' AS table_name, count(*) AS rows FROM areas
        UNION ALL SELECT 'tidegrid_citizens', count(*) FROM people UNION ALL SELECT 'tidegrid_raw_citizens', count(*) FROM raw_people""",
        "areas", "people", "raw_people"),
    "f1_points_from_xy": sql("SELECT citizen_id, lon AS x, lat AS y FROM people", "people"),
    "f2_x_and_y": sql("SELECT citizen_id, lon AS st_x, lat AS st_y FROM people", "people"),
    "f3_contains": sql(f"""SELECT area_id, {_inside('mx', 'my')} AS holds_middle FROM (SELECT e.*,
        (min(x1) OVER (PARTITION BY area_id) + max(x1) OVER (PARTITION BY area_id)) / 2e0 AS mx,
        (min(y1) OVER (PARTITION BY area_id) + max(y1) OVER (PARTITION BY area_id)) / 2e0 AS my FROM edges AS e) AS m
        GROUP BY area_id""", "edges"),
    "f4_distance": sql("SELECT area_id, distance_m FROM centre_distances", "centre_distances"),
    "f5_centroid": sql("SELECT area_id, lon, lat FROM centroids", "centroids"),
    "f6_wkt": sql(f"""SELECT citizen_id AS id, {_point_wkt('lon', 'lat')} AS wkt FROM people
        UNION ALL SELECT -area_id, {_RING_WKT} FROM areas""", "people", "areas"),
    "f6_sql_functions": sql(f"""SELECT c.area_id, {_RING_WKT} AS wkt, lon, lat, {_RING_JSON} AS geojson, distance_m,
        CAST(len(ring) AS INTEGER) AS vertices FROM centroids AS c JOIN areas ON c.area_id = areas.area_id
        JOIN centre_distances AS d ON c.area_id = d.area_id""", "centroids", "areas", "centre_distances"),
    "f7_geojson": sql(f"""SELECT citizen_id AS id, {_POINT_JSON} AS geojson FROM people
        UNION ALL SELECT -area_id, {_RING_JSON} FROM areas""", "people", "areas"),
    "f8_from_wkt": sql("""SELECT area_id, CAST(len(ring) AS INTEGER) AS vertices, ring[1].x AS first_x, ring[1].y AS first_y,
        list_max(list_transform(ring, lambda v: v.x)) AS xmax FROM areas""", "areas"),
    "f9_is_valid": sql("SELECT arrival, geometry_valid FROM checked_areas", "checked_areas"),
    "f10_bounds": sql("""SELECT area_id, min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax
        FROM edges GROUP BY area_id""", "edges"),
    "f11_date_parse": f"SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS strict, lenient FROM {_DATE_TEXTS}",
    "f12_iso_date": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS second FROM events",
    "f13_round": "SELECT c_custkey, round(c_custkey * 100e0 / 7e0, 2) AS share FROM customer",
    "f14_nullif_case": """SELECT c_custkey, nullif(c_custkey % 5, 0) AS part,
        CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'low' ELSE 'none' END AS level,
        round(100e0 / nullif(c_custkey % 5, 0), 2) AS guarded FROM customer""",
    "f15_text": """SELECT doc_id, lower(text) AS lowered, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS tidied,
        CAST(length(text) AS INTEGER) AS n FROM documents""",
    "f16_zero_pad": """SELECT c_custkey, 'Citizen_' || printf('%03d', c_custkey) AS name,
        '51 99999-' || printf('%04d', c_custkey) AS phone FROM customer""",
    "f17_daily_dates": """SELECT c_custkey, strftime(DATE '2024-01-01' + CAST(c_custkey % 3650 AS INTEGER), '%Y-%m-%d') AS day
        FROM customer""",
    "f18_feature_text": sql(f"SELECT citizen_id AS id, {_CITIZEN_FEATURE} AS feature FROM table_now", "table_now"),
    "f18_feature_collection": sql("""SELECT 'FeatureCollection' AS type, p.n + a.n AS features, a.n AS areas, p.n + a.n - 1 AS continued, first_name
        FROM (SELECT count(*) AS n, min_by(name, citizen_id) AS first_name FROM people) AS p, (SELECT count(*) AS n FROM areas) AS a""",
        "people", "areas"),
    "f19_json_geometry": sql("""SELECT area_id, 'Polygon' AS type, CAST(len(ring) AS INTEGER) AS vertices, ring[2].x AS second_x
        FROM areas""", "areas"),
    "f20_properties": "SELECT event_id, CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS BIGINT) AS k FROM events",
    "f21_normal_draw": f"SELECT c_custkey, round({_normal('c_custkey', 'risk/lon', '-51.24e0', 0.03)}, 6) AS draw FROM customer",
    "t1_new_files": sql("SELECT citizen_id, name, drop_no FROM drops", "drops"),
    "t2_classified_drops": sql("""SELECT d.citizen_id, d.drop_no, h.area_id IS NOT NULL AS affected_by_flooding,
        h.area_id AS affected_area_id FROM drops AS d LEFT JOIN ref_hits AS h ON d.citizen_id = h.citizen_id""", "drops", "ref_hits"),
    "t2_classified_batches": sql("""SELECT d.citizen_id, d.drop_no, h.area_id AS affected_area_id
        FROM drops AS d LEFT JOIN hits AS h ON d.citizen_id = h.citizen_id""", "drops", "hits"),
    "t3_merged_drops": sql("""SELECT citizen_id, name, drop_no FROM (SELECT *, row_number() OVER
        (PARTITION BY citizen_id ORDER BY drop_no DESC) AS rn FROM drops) AS r WHERE rn = 1""", "drops"),
    "t4_first_seen": sql("""SELECT citizen_id, name, drop_no FROM (SELECT *, row_number() OVER
        (PARTITION BY citizen_id ORDER BY drop_no) AS rn FROM drops) AS r WHERE rn = 1""", "drops"),
    "t4_first_settled": sql("""SELECT citizen_id, name || ' 1' AS name, drop_no, 1 AS seq FROM (SELECT *, row_number() OVER
        (PARTITION BY citizen_id ORDER BY drop_no) AS rn FROM drops) AS r WHERE rn = 1""", "drops"),
}
