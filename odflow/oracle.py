"""DuckDB SQL oracles for ``odflow.queries``.

Each query key maps to SQL over the driver's tables (pre-registered
views).  The fixture mapping is written once here as CTEs, in the same
terms as ``odflow.sources.fixtures``; question SQL is written directly
against those CTEs, so the oracle shares no code with the Spark side.
Spatial predicates are plain arithmetic on the fixture's rectangles and a
brute-force ray cast for the concave polygon (no spatial extension).
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format

CTE: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTE[name] = (sql, deps or [])


def _code(k: str) -> str:
    return f"lpad(CAST({k} AS VARCHAR), 5, '0')"


def _zone(ln: str) -> str:
    return f"CASE {ln} % 3 WHEN 0 THEN 'municipios' WHEN 1 THEN 'distritos' ELSE 'gaus' END"


cte("trip_rows", """
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, c.c_nationkey, s.s_nationkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey""")

cte("typed_trips", f"""
  SELECT CAST(DATE '2023-01-01' + CAST(l_partkey % 14 AS INTEGER) AS DATE) AS fecha,
         CAST(l_orderkey % 24 AS INTEGER) AS periodo,
         {_zone('l_linenumber')} AS tipo_zona,
         CAST(s_nationkey AS INTEGER) AS id_origen,
         CAST(c_nationkey AS INTEGER) AS id_destino,
         CAST(l_quantity AS DOUBLE) AS viajes,
         CAST(round(l_extendedprice) AS DOUBLE) AS viajes_metros
  FROM trip_rows""", ["trip_rows"])

cte("bronze_trips", f"""
  SELECT {_zone('l_linenumber')} AS tipo_zona,
         strftime(CAST(DATE '2023-01-01' + CAST(l_partkey % 14 AS INTEGER) AS DATE), '%Y-%m-%d') AS fecha,
         lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') AS periodo,
         'Z' || {_code('s_nationkey')} AS origen,
         'Z' || {_code('c_nationkey')} AS destino,
         CAST(CAST(l_quantity + CASE WHEN l_linenumber = 1 THEN 0.5 ELSE 0.0 END AS DECIMAL(12,1)) AS VARCHAR) AS viajes,
         CAST(CAST(floor(l_extendedprice) + 0.25 AS DECIMAL(14,2)) AS VARCHAR) AS viajes_km
  FROM trip_rows""", ["trip_rows"])

_REL_ROW = (
    "'Z' || {c} AS municipio_mitma, {i} AS municipio_ine, 'Z' || {c} AS distrito_mitma, "
    "{i} AS distrito_ine, 'Z' || {c} AS gau_mitma"
)
cte("relaciones", f"""
  SELECT {_REL_ROW.format(c=_code('n_nationkey'), i="CASE WHEN n_nationkey % 12 = 11 THEN 'NA' ELSE " + _code('n_nationkey') + " END")}
  FROM nation
  UNION ALL SELECT {_REL_ROW.format(c=_code('n_nationkey'), i="'90003'")} FROM nation WHERE n_nationkey = 3
  UNION ALL SELECT {_REL_ROW.format(c=_code('n_nationkey'), i="'90003'")} FROM nation WHERE n_nationkey = 3""")

cte("rel_pairs", "SELECT DISTINCT municipio_mitma AS m, municipio_ine AS i FROM relaciones", ["relaciones"])

# every trip row once per official id of its two codes; 'NA' has none
cte("official", """
  SELECT m AS code, TRY_CAST(i AS INTEGER) AS id FROM rel_pairs WHERE TRY_CAST(i AS INTEGER) IS NOT NULL""", ["rel_pairs"])
cte("viajes", """
  SELECT strptime(t.fecha, '%Y-%m-%d')::DATE AS fecha, t.periodo::INTEGER AS periodo, t.tipo_zona, a.id AS id_origen, b.id AS id_destino,
         round_even(t.viajes::DOUBLE, 0) AS viajes, t.viajes_km::DOUBLE * 1000 AS viajes_metros
  FROM bronze_trips t, official a, official b WHERE a.code = t.origen AND b.code = t.destino""", ["bronze_trips", "official"])

cte("bronze_poblacion", f"""
  SELECT {_code('n.n_nationkey')} || ' ' || n.n_name AS column0, format('{{:,}}', c.n * 1000) AS "Total"
  FROM nation n JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) c
    ON n.n_nationkey = c.c_nationkey
  UNION ALL SELECT ' 2023 ', '1,000' FROM region WHERE r_regionkey = 0
  UNION ALL SELECT {_code('n_nationkey')} || ' ' || n_name, ' . ' FROM nation WHERE n_nationkey % 7 = 6
  UNION ALL SELECT NULL, '5' FROM region WHERE r_regionkey = 1""")

cte("bronze_renta", f"""
  SELECT {_code('n.n_nationkey')} || ' ' || n.n_name AS column0,
         format('{{:,}}', CAST(floor(CAST(s.cents AS DOUBLE) / 100.0) AS BIGINT)) AS "Renta neta media por persona"
  FROM nation n JOIN (SELECT c_nationkey, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS cents
                      FROM customer GROUP BY c_nationkey) s ON n.n_nationkey = s.c_nationkey
  UNION ALL SELECT '2023', '7' FROM region WHERE r_regionkey = 0""")


def _clean_stat(src: str, value_col: str, out: str) -> str:
    """Rows whose label begins with a code and whose value is a number once its separators are gone."""
    return f"""
  SELECT id, v AS {out} FROM (
    SELECT TRY_CAST(left(trim(column0), 5) AS INTEGER) AS id, TRY_CAST(translate("{value_col}", ', ', '') AS INTEGER) AS v,
           trim(column0) = '2023' AS year_row
    FROM {src}) WHERE id IS NOT NULL AND v IS NOT NULL AND NOT year_row"""


cte("poblacion", _clean_stat("bronze_poblacion", "Total", "poblacion"), ["bronze_poblacion"])
cte("renta", _clean_stat("bronze_renta", "Renta neta media por persona", "renta"), ["bronze_renta"])

cte("bronze_calendario", """
  SELECT strftime(fecha, '%Y-%m-%d') AS "Dia", ' ' || upper(dayname(fecha)) || ' ' AS "Dia_semana",
         CASE WHEN dayofweek(fecha) IN (0, 6) THEN 'false' ELSE 'true' END AS laborable
  FROM (SELECT DISTINCT fecha FROM viajes) d""", ["viajes"])

cte("calendario", """
  SELECT CAST("Dia" AS DATE) AS fecha, lower(trim("Dia_semana")) AS dia_semana, CAST(laborable AS BOOLEAN) AS tipo_dia
  FROM bronze_calendario WHERE "Dia" IS NOT NULL AND "Dia_semana" IS NOT NULL AND laborable IS NOT NULL""",
    ["bronze_calendario"])

cte("provincias", f"""
  SELECT CAST(r_regionkey AS INTEGER) AS cod_provincia, r_name AS nombre_provincia, lower(r_name) AS nombre_alternativo,
         CAST(r_regionkey % 2 + 1 AS INTEGER) AS cod_ccaa, 'CCAA ' || CAST(r_regionkey % 2 + 1 AS VARCHAR) AS nombre_ccaa,
         {D('r_regionkey')} - 0.5 AS xmin, {D('-0.5')} AS ymin, {D('r_regionkey')} + 0.5 AS xmax, {D('4.5')} AS ymax
  FROM region WHERE r_regionkey < 4""")

cte("nat", f"""
  SELECT n_nationkey AS k, n_name, {D('n_nationkey % 5')} AS cx, {D('n_nationkey // 5')} AS cy,
         'Z' || {_code('n_nationkey')} AS mitma
  FROM nation""")

cte("geo_all", f"""
  SELECT 'municipio' AS tipo_zona, mitma, n_name || ' ' AS name, {D('0.4')} AS h, cx, cy FROM nat
  UNION ALL SELECT 'distrito', mitma, n_name || '-D ', {D('0.3')}, cx, cy FROM nat WHERE k % 2 = 0
  UNION ALL SELECT 'gau', mitma, n_name || '-G ', {D('0.2')}, cx, cy FROM nat WHERE k % 3 = 0""", ["nat"])

cte("lugares_union", """
  SELECT DISTINCT TRY_CAST(r.i AS INTEGER) AS id, g.mitma AS id_mitma, trim(g.name) AS nombre, g.tipo_zona,
         g.cx - g.h AS xmin, g.cy - g.h AS ymin, g.cx + g.h AS xmax, g.cy + g.h AS ymax, g.cx, g.cy
  FROM geo_all g JOIN rel_pairs r ON g.mitma = r.m""", ["geo_all", "rel_pairs"])

cte("lugares", """
  SELECT u.id, u.id_mitma, u.nombre, u.tipo_zona, u.xmin, u.ymin, u.xmax, u.ymax,
         u.cx AS longitude, u.cy AS latitude, p.cod_provincia
  FROM lugares_union u LEFT JOIN provincias p
    ON u.cx > p.xmin AND u.cx < p.xmax AND u.cy > p.ymin AND u.cy < p.ymax
  WHERE u.id IS NOT NULL AND u.nombre IS NOT NULL""", ["lugares_union", "provincias"])

# the rectangle [-0.5, 2.5]^2 used as the question polygon
cte("inpoly", f"""
  SELECT * FROM lugares WHERE xmin >= {D('-0.5')} AND ymin >= {D('-0.5')} AND xmax <= {D('2.5')} AND ymax <= {D('2.5')}""",
    ["lugares"])

for _lv in ("municipios", "distritos", "gaus"):
    cte(f"gold_{_lv}", f"""
  SELECT id_origen, id_destino, fecha, CAST(periodo AS VARCHAR) AS periodo,
         sum(viajes) AS total_viajes, avg(viajes_metros) AS avg_viajes_metros
  FROM viajes WHERE tipo_zona = '{_lv}' GROUP BY id_origen, id_destino, fecha, periodo""", ["viajes"])

cte("pts", """
  SELECT c_custkey AS point_id, CAST(c_custkey % 45 AS DOUBLE) * 0.1 - 0.43 AS x,
         CAST(c_custkey % 53 AS DOUBLE) * 0.1 - 0.41 AS y
  FROM customer""")

cte("squares", """
  SELECT point_id, CAST(printf('%.2f', x - 0.1) AS DOUBLE) AS x0, CAST(printf('%.2f', y - 0.1) AS DOUBLE) AS y0,
         CAST(printf('%.2f', x + 0.1) AS DOUBLE) AS x1, CAST(printf('%.2f', y + 0.1) AS DOUBLE) AS y1
  FROM pts""", ["pts"])

PERIOD_SQL = "DATE '2023-01-01' AND DATE '2023-01-14'"


def _bq3(gold: str, places: str, where: str = "", name: str = "") -> None:
    """Ranking of the places of a polygon: one row per place and day with the
    day's type, means by FILTER, rank by counting the smaller ratios."""
    name = name or gold
    cte(f"place_days_{name}", f"""
  SELECT z.nombre, k.fecha, k.tipo_dia AS working, sum(g.total_viajes) AS trips
  FROM calendario k JOIN {gold} g USING (fecha) JOIN (SELECT id, nombre FROM {places} {where}) z ON z.id = g.id_destino
  WHERE k.fecha >= '2023-01-01' AND k.fecha < '2023-01-15' GROUP BY ALL""", [gold, places, "calendario"])
    cte(f"place_means_{name}", f"""
  SELECT nombre, avg(trips) FILTER (working) AS workday_v, avg(trips) FILTER (NOT working) AS weekend_v,
         CASE WHEN weekend_v <> 0 THEN workday_v / weekend_v END AS ratio
  FROM place_days_{name} GROUP BY nombre""", [f"place_days_{name}"])
    cte(f"ranking_{name}", f"""
  SELECT c.*, coalesce(n_below / nullif(n_all - 1, 0), 0)::DOUBLE AS percentile
  FROM (SELECT x.*, count(*) OVER () AS n_all,
               (SELECT count(*) FROM place_means_{name} o WHERE o.workday_v > 50 AND o.weekend_v IS NOT NULL
                  AND (o.ratio < x.ratio OR (x.ratio IS NULL AND o.ratio IS NOT NULL))) AS n_below
        FROM place_means_{name} x WHERE x.workday_v > 50 AND x.weekend_v IS NOT NULL) c
  WHERE coalesce(n_below / nullif(n_all - 1, 0), 0) >= 0.95""", [f"place_means_{name}"])


_bq3("gold_municipios", "inpoly")
_bq3("gold_distritos", "inpoly", "WHERE tipo_zona = 'distrito'")
_bq3("gold_municipios", "lugares", name="wide")
cte("ranked_places", "SELECT l.* FROM lugares l SEMI JOIN ranking_gold_municipios USING (nombre)", ["lugares", "ranking_gold_municipios"])

# the two ends of a BQ2 pair, each with all it needs
cte("od_origins", "SELECT id, nombre, latitude, longitude, poblacion FROM inpoly JOIN poblacion USING (id)", ["inpoly", "poblacion"])
cte("od_targets", "SELECT id, nombre, latitude, longitude, poblacion, renta FROM renta JOIN poblacion USING (id) JOIN lugares USING (id)",
    ["renta", "poblacion", "lugares"])
cte("od_rows", f"""
  SELECT a.nombre AS origen, b.nombre AS destino, a.latitude AS o_lat, a.longitude AS o_lon, b.latitude AS d_lat, b.longitude AS d_lon,
         g.total_viajes AS n, g.total_viajes * g.avg_viajes_metros AS metres, a.poblacion AS pa, b.poblacion AS pb, b.renta AS rb
  FROM od_targets b JOIN gold_municipios g ON g.id_destino = b.id JOIN od_origins a ON a.id = g.id_origen
  WHERE g.fecha BETWEEN {PERIOD_SQL}""", ["od_origins", "od_targets", "gold_municipios"])
cte("od_pairs", """
  SELECT origen, destino, o_lat, o_lon, d_lat, d_lon, sum(n) AS viajes_reales, CASE WHEN sum(n) <> 0 THEN sum(metres) / sum(n) END AS dist_media,
         max(pa)::DOUBLE AS pop_origen, max(pb)::DOUBLE AS pop_destino, max(rb)::DOUBLE AS renta_destino,
         CASE WHEN dist_media <> 0 THEN pop_origen * renta_destino / (dist_media * dist_media) END AS potencial
  FROM od_rows GROUP BY ALL""", ["od_rows"])
cte("od_scored", """
  SELECT *, CASE WHEN potencial * k <> 0 THEN viajes_reales / (potencial * k) END AS mismatch, sqrt(pop_origen * pop_destino) AS pop_weight,
         mismatch * pop_weight AS weighted_mismatch
  FROM (SELECT *, sum(viajes_reales) OVER () / nullif(sum(potencial) OVER (), 0) AS k FROM od_pairs)""", ["od_pairs"])

cte("hourly", f"""
  SELECT g.fecha, CAST(g.periodo AS INTEGER) AS periodo, sum(g.total_viajes) AS total_viajes
  FROM gold_municipios g JOIN inpoly l ON g.id_origen = l.id
  WHERE g.fecha BETWEEN {PERIOD_SQL} GROUP BY g.fecha, CAST(g.periodo AS INTEGER)""", ["gold_municipios", "inpoly"])

_H = [f"{h:02d}" for h in range(24)]
cte("day_vectors", f"""
  SELECT w.fecha,
         {', '.join(f'CAST(CASE WHEN p.p{h} = 1 THEN w.r{h} ELSE 0 END AS DOUBLE) AS h{h}' for h in _H)}
  FROM (SELECT fecha, {', '.join(f'sum(total_viajes) FILTER (WHERE periodo = {int(h)}) AS r{h}' for h in _H)}
        FROM hourly GROUP BY fecha) w,
       (SELECT {', '.join(f'max(CASE WHEN periodo = {int(h)} THEN 1 ELSE 0 END) AS p{h}' for h in _H)} FROM hourly) p""",
    ["hourly"])

_TOTAL = " + ".join(f"coalesce(h{h}, 0)" for h in _H)
cte("shares", f"""
  SELECT *, {', '.join(f'coalesce(h{h} / NULLIF({_TOTAL}, 0), 0) AS s{h}' for h in _H)} FROM day_vectors""",
    ["day_vectors"])


_DIST = " + ".join(f"(s.s{h} - c.s{h}) * (s.s{h} - c.s{h})" for h in _H)
cte("centres", "SELECT row_number() OVER (ORDER BY fecha) AS k, * FROM shares ORDER BY fecha LIMIT 3", ["shares"])
cte("assigned", f"""
  SELECT s.*, CAST(a.k AS INTEGER) AS cluster
  FROM shares s JOIN (
    SELECT fecha, k FROM (
      SELECT s.fecha, c.k, row_number() OVER (PARTITION BY s.fecha ORDER BY {_DIST}, c.k) AS rn
      FROM shares s, centres c) t
    WHERE rn = 1) a ON s.fecha = a.fecha""", ["shares", "centres"])

# the best of all partitions of the days into three: inertia of a set is the sum of its squared distances over its size
cte("day_numbers", "SELECT *, row_number() OVER (ORDER BY fecha) - 1 AS i FROM shares", ["shares"])
cte("day_pairs", f"SELECT s.i AS i, c.i AS j, {_DIST} AS d FROM day_numbers s JOIN day_numbers c ON s.i < c.i", ["day_numbers"])
cte("day_sets", """
  SELECT m, coalesce(sum(d) FILTER ((m >> i) & 1 = 1 AND (m >> j) & 1 = 1), 0) / bit_count(m) AS spread
  FROM (SELECT unnest(range(1, (1 << (SELECT count(*) FROM day_numbers)::INT))) AS m), day_pairs GROUP BY m""", ["day_numbers", "day_pairs"])
cte("best_thirds", """
  SELECT a.m AS a, b.m AS b, a.spread + b.spread + c.spread AS inertia
  FROM (SELECT max(m) AS m FROM day_sets) w, day_sets a, day_sets b, day_sets c
  WHERE a.m & 1 = 1 AND b.m & 1 = 0 AND a.m & b.m = 0 AND c.m = w.m - a.m - b.m
    AND b.m & (w.m - a.m) & -(w.m - a.m) <> 0 ORDER BY inertia LIMIT 1""", ["day_sets"])

CONCAVE_EDGES = "(-0.5, -0.5, 2.5, -0.5), (2.5, -0.5, 2.5, 2.5), (2.5, 2.5, 1.0, 1.0), (1.0, 1.0, -0.5, 2.5), (-0.5, 2.5, -0.5, -0.5)"

VIAJES_COLS = "fecha, periodo, tipo_zona, id_origen, id_destino, viajes, viajes_metros"
GOLD_COLS = "id_origen, id_destino, fecha, periodo, total_viajes, avg_viajes_metros"
R6 = "round({0}, 6) AS {0}".format


def _r6(*cols: str) -> str:
    return ", ".join(R6(c) for c in cols)


SQL: dict[str, tuple[str, list[str]]] = {
    # ---- sources
    "empty_from_schema": ("SELECT fecha, periodo, origen, destino, viajes, viajes_km FROM bronze_trips LIMIT 0", ["bronze_trips"]),
    "csv_scan_trips": ("SELECT fecha, periodo, origen, destino, viajes, viajes_km FROM bronze_trips", ["bronze_trips"]),
    "csv_daily_files": ("SELECT fecha, periodo, origen, destino, viajes, viajes_km FROM bronze_trips "
                        "WHERE tipo_zona = 'municipios' AND fecha BETWEEN '2023-01-02' AND '2023-01-05'", ["bronze_trips"]),
    "csv_all_varchar": ("SELECT * FROM relaciones", ["relaciones"]),
    "geojson_scan": ("SELECT tipo_zona, mitma AS id, name, 'Polygon' AS kind, 4 AS n_edges, "
                     "cx - h AS xmin, cy - h AS ymin, cx + h AS xmax, cy + h AS ymax FROM geo_all", ["geo_all"]),
    "geojson_collection_scan": ("SELECT CAST(point_id AS VARCHAR) AS point_id, 'Polygon' AS kind, 4 AS n_edges, round(x0, 6) AS xmin, "
                                "round(y0, 6) AS ymin, round(x1, 6) AS xmax, round(y1, 6) AS ymax FROM squares", ["squares"]),
    "csv_scan_stats": ("""
      SELECT 'poblacion' AS source, column0, "Total" AS value FROM bronze_poblacion
      UNION ALL SELECT 'renta', column0, "Renta neta media por persona" FROM bronze_renta""", ["bronze_poblacion", "bronze_renta"]),
    "csv_detect_dialects": ("""
      SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, c_name || ', Güeña; ' || c_mktsegment AS label,
        format('{:,}', CAST(floor(c_acctbal) * 1000 AS BIGINT)) AS value FROM customer""", []),
    "schema_from_sample": ("SELECT DISTINCT fecha, 'residencia|destino|viajes_km|fecha|origen|viajes|periodo' AS columns FROM bronze_trips",
                           ["bronze_trips"]),
    "day_spine": ("""
      SELECT strftime(s.d, '%Y-%m-%d') AS day, count(v.fecha) AS n_trips
      FROM (SELECT CAST(unnest(generate_series(CAST(min(fecha) AS TIMESTAMP), CAST(max(fecha) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
            FROM viajes) s
      LEFT JOIN viajes v ON v.fecha = s.d GROUP BY s.d""", ["viajes"]),
    # ---- sinks
    "ctas_roundtrip": ("SELECT id, renta FROM renta", ["renta"]),
    "not_null_contract": (f"SELECT {VIAJES_COLS} FROM typed_trips", ["typed_trips"]),
    "contract_report": ("""
      SELECT u.column, u.n_rows::BIGINT AS n_rows, u.rows_read FROM (
        SELECT unnest([{'column': 'id_origen', 'n_rows': count(*) FILTER (c_custkey % 7 = 0), 'rows_read': count(*)},
                       {'column': 'id_destino', 'n_rows': count(*) FILTER (c_custkey % 5 = 0), 'rows_read': count(*)},
                       {'column': 'avg_viajes_metros', 'n_rows': count(*) FILTER (c_acctbal < 0), 'rows_read': count(*)}]) AS u
        FROM customer) WHERE u.n_rows > 0""", []),
    "append_union": (f"SELECT {VIAJES_COLS} FROM viajes", ["viajes"]),
    "replace_partition_zone": (f"SELECT {VIAJES_COLS} FROM viajes WHERE NOT (tipo_zona = 'gaus' AND fecha > DATE '2023-01-07')",
                               ["viajes"]),
    "replace_partition_day": (f"SELECT {GOLD_COLS} FROM gold_municipios WHERE fecha <> DATE '2023-01-03'", ["gold_municipios"]),
    "report_lines_bq2": ("""
      SELECT origen || ' -> ' || destino || ' | Weighted mismatch: ' || printf('%.4f', weighted_mismatch) AS line
      FROM (SELECT * FROM od_scored ORDER BY weighted_mismatch DESC NULLS LAST, origen, destino LIMIT 15) t""", ["od_scored"]),
    "report_lines_bq3": ("SELECT '- ' || nombre || ': Ratio ' || printf('%.2f', ratio) AS line FROM ranking_gold_municipios",
                         ["ranking_gold_municipios"]),
    # ---- cleaning
    "clean_provinces": ("SELECT cod_provincia, nombre_provincia, nombre_alternativo, cod_ccaa, nombre_ccaa, xmin, ymin, xmax, ymax "
                        "FROM provincias", ["provincias"]),
    "clean_population": ("SELECT id, poblacion FROM poblacion", ["poblacion"]),
    "clean_income": ("SELECT id, renta FROM renta", ["renta"]),
    "clean_calendar": ("SELECT fecha, dia_semana, tipo_dia FROM calendario", ["calendario"]),
    # ---- filters / projections
    "filter_not_null": ("SELECT id, id_mitma, nombre, tipo_zona FROM lugares_union WHERE id IS NOT NULL AND nombre IS NOT NULL",
                        ["lugares_union"]),
    "filter_neq_trim": ("SELECT column0, \"Total\" FROM bronze_poblacion WHERE trim(column0) <> '2023'", ["bronze_poblacion"]),
    "filter_eq": (f"SELECT {VIAJES_COLS} FROM viajes WHERE fecha = DATE '2023-01-03' AND tipo_zona = 'gaus'", ["viajes"]),
    "filter_between_dates": (f"SELECT {GOLD_COLS} FROM gold_municipios WHERE fecha BETWEEN DATE '2023-01-02' AND DATE '2023-01-05'",
                             ["gold_municipios"]),
    "filter_parses_int": ("SELECT column0, \"Total\" FROM bronze_poblacion "
                          "WHERE TRY_CAST(substr(trim(column0), 1, 5) AS INTEGER) IS NOT NULL", ["bronze_poblacion"]),
    "filter_regex_digit": ("SELECT column0, \"Total\" FROM bronze_poblacion WHERE regexp_matches(trim(\"Total\"), '[0-9]')",
                           ["bronze_poblacion"]),
    "filter_in_polygon": ("SELECT id, nombre, tipo_zona FROM inpoly", ["inpoly"]),
    "metres_from_km": ("SELECT tipo_zona, origen, destino, round(sum(TRY_CAST(trim(viajes_km) AS DOUBLE) * 1000), 2) AS viajes_metros "
                       "FROM bronze_trips GROUP BY tipo_zona, origen, destino", ["bronze_trips"]),
    # ---- joins
    "lugares_union": ("SELECT id, id_mitma, nombre, tipo_zona, xmin, ymin, xmax, ymax FROM lugares_union", ["lugares_union"]),
    "join_resolve_codes": ("SELECT tipo_zona, id_origen, id_destino, count(*) AS n_trips, sum(viajes) AS viajes FROM viajes GROUP BY 1, 2, 3",
                           ["viajes"]),
    "silver_trips": (f"SELECT {VIAJES_COLS} FROM viajes", ["viajes"]),
    "join_star_5way": ("SELECT origen, destino, count(*) AS n_rows, sum(n) AS total_viajes FROM od_rows GROUP BY ALL", ["od_rows"]),
    "spatial_left_join": ("""
      SELECT p.point_id, round(p.x, 6) AS x, round(p.y, 6) AS y, v.cod_provincia
      FROM pts p LEFT JOIN provincias v ON p.x > v.xmin AND p.x < v.xmax AND p.y > v.ymin AND p.y < v.ymax""",
                          ["pts", "provincias"]),
    "point_in_polygon": (f"""
      SELECT p.point_id FROM pts p,
        (SELECT CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
         FROM (VALUES {CONCAVE_EDGES}) t(x1, y1, x2, y2)) e
      GROUP BY p.point_id
      HAVING sum(CASE WHEN (e.y1 > p.y) <> (e.y2 > p.y)
                       AND p.x < e.x1 + (e.x2 - e.x1) * (p.y - e.y1) / NULLIF(e.y2 - e.y1, 0) THEN 1 ELSE 0 END) % 2 = 1""",
                         ["pts"]),
    "mark_join_group": ("""
      SELECT id, nombre, tipo_zona, CASE WHEN nombre IN (FROM ranking_gold_municipios SELECT nombre) THEN 'ranked' ELSE 'other' END AS grupo
      FROM lugares""", ["lugares", "ranking_gold_municipios"]),
    "join_calendar": ("""
      SELECT d.fecha, c.tipo_dia, d.total_viajes
      FROM (SELECT fecha, sum(total_viajes) AS total_viajes FROM gold_municipios GROUP BY fecha) d
      JOIN calendario c ON d.fecha = c.fecha""", ["gold_municipios", "calendario"]),
    "semi_join_names": (f"""
      SELECT {GOLD_COLS} FROM gold_municipios
      WHERE id_destino IN (SELECT id FROM ranked_places)""", ["gold_municipios", "ranked_places"]),
    # ---- aggregates
    "agg_sum": ("SELECT tipo_zona, fecha, sum(viajes) AS total_viajes FROM viajes GROUP BY 1, 2", ["viajes"]),
    "agg_avg": ("SELECT tipo_zona, periodo, avg(viajes_metros) AS avg_viajes_metros FROM viajes GROUP BY 1, 2", ["viajes"]),
    "agg_max_pick": ("""
      SELECT g.id_destino, CAST(max(p.poblacion) AS DOUBLE) AS pop_destino, sum(g.total_viajes) AS total_viajes
      FROM gold_municipios g JOIN poblacion p ON g.id_destino = p.id GROUP BY g.id_destino""",
                     ["gold_municipios", "poblacion"]),
    "agg_two_level": ("SELECT nombre, working AS tipo_dia, round(avg(trips), 6) AS avg_daily_vol FROM place_days_gold_municipios GROUP BY 1, 2",
                      ["place_days_gold_municipios"]),
    "agg_conditional": (f"SELECT nombre, {_r6('workday_v', 'weekend_v')} FROM place_means_gold_municipios", ["place_means_gold_municipios"]),
    "agg_weighted_mean": ("""
      SELECT id_origen, id_destino, round(sum(total_viajes * avg_viajes_metros) / NULLIF(sum(total_viajes), 0), 6) AS dist_media
      FROM gold_municipios GROUP BY 1, 2""", ["gold_municipios"]),
    "distinct_rows": ("SELECT tipo_zona, id_origen, id_destino, fecha FROM viajes GROUP BY ALL", ["viajes"]),
    # ---- windows / ranking
    "percent_rank": ("""
      SELECT x.nombre, round(x.ratio, 6) AS ratio,
             round((SELECT count(*) FROM place_means_gold_municipios o
                    WHERE o.weekend_v IS NOT NULL AND (o.ratio < x.ratio OR (x.ratio IS NULL AND o.ratio IS NOT NULL)))
                   / greatest(count(*) OVER () - 1, 1), 6) AS percentile
      FROM place_means_gold_municipios x WHERE x.weekend_v IS NOT NULL""", ["place_means_gold_municipios"]),
    "bq3_ranking": (f"SELECT nombre, {_r6('workday_v', 'weekend_v', 'ratio', 'percentile')} FROM ranking_gold_municipios",
                    ["ranking_gold_municipios"]),
    "bq3_ranking_wide": (f"SELECT nombre, {_r6('workday_v', 'weekend_v', 'ratio', 'percentile')} FROM ranking_wide", ["ranking_wide"]),
    "top_percentile": (f"SELECT nombre, {_r6('workday_v', 'weekend_v', 'ratio', 'percentile')} FROM ranking_gold_distritos",
                       ["ranking_gold_distritos"]),
    "bq3_hourly": (f"""
      SELECT g.periodo::INTEGER AS periodo, k.tipo_dia, sum(g.total_viajes * w.n) AS total_viajes
      FROM (SELECT id, count(*) AS n FROM ranked_places GROUP BY id) w JOIN gold_municipios g ON g.id_destino = w.id
      JOIN calendario k USING (fecha) WHERE k.fecha BETWEEN {PERIOD_SQL} GROUP BY 1, 2""", ["gold_municipios", "calendario", "ranked_places"]),
    "bq3_flows": (f"""
      SELECT o.nombre AS origen, d.nombre AS destino, round(sum(o.latitude) / count(*), 6) AS o_lat, round(sum(o.longitude) / count(*), 6) AS o_lon,
             round(sum(d.latitude) / count(*), 6) AS d_lat, round(sum(d.longitude) / count(*), 6) AS d_lon, sum(g.total_viajes) AS viajeros
      FROM ranked_places d JOIN gold_municipios g ON g.id_destino = d.id JOIN lugares o ON o.id = g.id_origen
      WHERE g.fecha BETWEEN {PERIOD_SQL} GROUP BY o.nombre, d.nombre""", ["gold_municipios", "lugares", "ranked_places"]),
    # ---- BQ2
    "bq2_od_base": (f"SELECT origen, destino, viajes_reales, pop_origen, pop_destino, renta_destino, "
                    f"{_r6('o_lat', 'o_lon', 'd_lat', 'd_lon', 'dist_media', 'potencial')} FROM od_pairs", ["od_pairs"]),
    "gravity_potential": ("SELECT origen, destino, round(potencial, 6) AS potencial FROM od_pairs", ["od_pairs"]),
    "gravity_mismatch": (f"SELECT origen, destino, viajes_reales, {_r6('potencial', 'mismatch', 'pop_weight', 'weighted_mismatch')} "
                         f"FROM od_scored", ["od_scored"]),
    "bq2_result_table": (f"SELECT origen, destino, viajes_reales, {_r6('potencial', 'mismatch', 'pop_weight', 'weighted_mismatch')} "
                         f"FROM od_scored", ["od_scored"]),
    "bq2_bottom50": (f"SELECT origen, destino, viajes_reales, {_r6('potencial', 'mismatch', 'pop_weight', 'weighted_mismatch')} "
                     f"FROM (SELECT * FROM od_scored ORDER BY weighted_mismatch ASC NULLS LAST, origen, destino LIMIT 50) t",
                     ["od_scored"]),
    "bq2_top10": (f"SELECT origen, destino, viajes_reales, {_r6('potencial', 'mismatch', 'pop_weight', 'weighted_mismatch')} "
                  f"FROM (SELECT * FROM od_scored ORDER BY weighted_mismatch DESC NULLS LAST, origen, destino LIMIT 10) t",
                  ["od_scored"]),
    "bq2_top15": (f"SELECT origen, destino, viajes_reales, {_r6('potencial', 'mismatch', 'pop_weight', 'weighted_mismatch')} "
                  f"FROM (SELECT * FROM od_scored ORDER BY weighted_mismatch DESC NULLS LAST, origen, destino LIMIT 15) t",
                  ["od_scored"]),
    # ---- BQ1
    "bq1_hourly_profile": ("SELECT fecha, periodo, total_viajes FROM hourly", ["hourly"]),
    "pivot_hours": (f"SELECT fecha, {', '.join('h' + h for h in _H)} FROM day_vectors", ["day_vectors"]),
    "row_normalise": (f"SELECT fecha, {_r6(*['s' + h for h in _H])} FROM shares", ["shares"]),
    "kmeans_assign_fixed": ("SELECT fecha, cluster FROM assigned", ["assigned"]),
    "bq1_day_clusters": ("""
      SELECT fecha, true AS nearest, 3 AS n_clusters, round(inertia, 9) AS inertia,
             CAST(CASE WHEN (a >> i) & 1 = 1 THEN 1 WHEN (b >> i) & 1 = 1 THEN 2 ELSE 3 END AS INTEGER) AS cluster
      FROM day_numbers, best_thirds""", ["day_numbers", "best_thirds"]),
    "cluster_profile": (f"""
      SELECT cluster, count(*) AS n_days,
             {', '.join(f'round(avg(h{h}), 6) AS avg_h{h}' for h in _H)},
             {', '.join(f'round(avg(s{h}), 6) AS avg_s{h}' for h in _H)}
      FROM assigned GROUP BY cluster""", ["assigned"]),
    # ---- scalar functions
    "cast_int": ("""
      SELECT column0, CAST(substr(trim(column0), 1, 5) AS INTEGER) AS id FROM bronze_poblacion
      WHERE trim(column0) <> '2023' AND TRY_CAST(substr(trim(column0), 1, 5) AS INTEGER) IS NOT NULL""", ["bronze_poblacion"]),
    "cast_int_round": ("""
      SELECT tipo_zona, fecha, CAST(sum(CAST(TRY_CAST(viajes AS DOUBLE) AS INTEGER)) AS BIGINT) AS viajes
      FROM bronze_trips GROUP BY 1, 2""", ["bronze_trips"]),
    "try_cast_na": ("SELECT DISTINCT municipio_mitma, municipio_ine, TRY_CAST(municipio_ine AS INTEGER) AS id FROM relaciones",
                    ["relaciones"]),
    "cast_date": ("SELECT DISTINCT fecha AS fecha_text, CAST(fecha AS DATE) AS fecha FROM bronze_trips", ["bronze_trips"]),
    "latin1_text": ("""
      SELECT doc_id, CAST(length(text) AS INTEGER) AS n_in,
             CAST(length(regexp_replace(text, '[^\\x{00}-\\x{FF}]', '', 'g')) AS INTEGER) AS n_out
      FROM documents""", []),
    "wkt_parse": ("SELECT point_id, round((x1 - x0) * (y1 - y0), 6) AS area, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax "
                  "FROM squares", ["squares"]),
    # closed square inside the closed concave ring: inside its box and, over the square's x range, below
    # both notch edges (y <= 2 - x or y <= x); the lowest notch height is 1 at x = 1
    "polygon_in_polygon": ("""
      SELECT point_id FROM squares
      WHERE x0 >= -0.5 AND y0 >= -0.5 AND x1 <= 2.5 AND y1 <= 2.5
        AND y1 <= CASE WHEN x0 <= 1 AND x1 >= 1 THEN 1.0
                       ELSE least(greatest(2 - x0, x0), greatest(2 - x1, x1)) END""", ["squares"]),
    # small squares against HOLE_SHAPES of the fixtures: inside a box, and not over the hole
    "polygon_with_holes": ("""
      SELECT t.shape, q.c_custkey AS point_id, CASE t.shape
        WHEN 'hole' THEN x + w <= 10 AND y + w <= 10 AND NOT (x < 6 AND x + w > 4 AND y < 6 AND y + w > 4)
        WHEN 'touching' THEN (x + w <= 4 AND y + w <= 4) OR (x >= 4 AND y >= 4 AND x + w <= 8 AND y + w <= 8)
        ELSE x + w <= 5 AND y + w <= 5 END AS inside
      FROM (SELECT c_custkey, c_custkey % 9 AS x, c_custkey // 9 % 9 AS y, 1 + c_custkey // 81 % 3 AS w FROM customer) q,
           (VALUES ('hole'), ('touching'), ('heights')) t(shape)""", []),
    "filter_in_z_polygon": ("SELECT id, nombre, tipo_zona FROM inpoly", ["inpoly"]),
    "centroid_xy": ("SELECT point_id, round((x0 + x1) / 2, 6) AS x, round((y0 + y1) / 2, 6) AS y FROM squares", ["squares"]),
    "stream_ingest_trips": (f"SELECT {VIAJES_COLS} FROM viajes", ["viajes"]),
    # ---- composites
    "silver_places": ("SELECT id, id_mitma, nombre, tipo_zona, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, "
                      "cod_provincia FROM lugares", ["lugares"]),
    "gold_rollup_municipios": (f"SELECT {GOLD_COLS} FROM gold_municipios", ["gold_municipios"]),
    "gold_rollup_distritos": (f"SELECT {GOLD_COLS} FROM gold_distritos", ["gold_distritos"]),
    "gold_rollup_gaus": (f"SELECT {GOLD_COLS} FROM gold_gaus", ["gold_gaus"]),
    "bq3_points": ("""
      SELECT l.nombre, round(l.latitude, 6) AS latitude, round(l.longitude, 6) AS longitude,
             CASE WHEN l.nombre IN (SELECT nombre FROM ranking_gold_municipios) THEN 'Top 5%' ELSE 'Resto' END AS grupo
      FROM inpoly l WHERE (SELECT count(*) FROM ranking_gold_municipios) > 0""", ["inpoly", "ranking_gold_municipios"]),
    "uc1_top_income": ("SELECT l.nombre, r.renta FROM renta r JOIN lugares l ON r.id = l.id ORDER BY r.renta DESC, l.nombre LIMIT 10",
                       ["renta", "lugares"]),
    "uc2_nonworking_days": ("""
      SELECT CAST(month(fecha) AS INTEGER) AS month_num, strftime(fecha, '%m - %B') AS month_name, count(*) AS non_working_days
      FROM calendario WHERE NOT tipo_dia GROUP BY 1, 2""", ["calendario"]),
    "uc2_all_months": ("""
      SELECT CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%m - %B') AS month_name, count(*) AS non_working_days
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE dayofweek(d) IN (0, 6) GROUP BY 1, 2""", []),
    "uc3_top_population": ("""
      SELECT l.nombre, p.poblacion FROM lugares l JOIN poblacion p ON l.id = p.id
      WHERE l.tipo_zona = 'municipio' ORDER BY p.poblacion DESC, l.nombre LIMIT 10""", ["lugares", "poblacion"]),
    "uc4_places_in_polygon": ("SELECT id, nombre, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM inpoly",
                              ["inpoly"]),
    "uc4_map_centre": ("SELECT round(avg(latitude), 6) AS centro_lat, round(avg(longitude), 6) AS centro_lon FROM inpoly", ["inpoly"]),
    "uc5_province_geojson": ("""
      SELECT nombre_provincia,
             '{"type":"Polygon","coordinates":[[[' || CAST(xmin AS VARCHAR) || ',' || CAST(ymin AS VARCHAR) || '],['
             || CAST(xmax AS VARCHAR) || ',' || CAST(ymin AS VARCHAR) || '],['
             || CAST(xmax AS VARCHAR) || ',' || CAST(ymax AS VARCHAR) || '],['
             || CAST(xmin AS VARCHAR) || ',' || CAST(ymax AS VARCHAR) || '],['
             || CAST(xmin AS VARCHAR) || ',' || CAST(ymin AS VARCHAR) || ']]]}' AS geom_json
      FROM provincias""", ["provincias"]),
    "uc6_trips_from_place": ("""
      SELECT DISTINCT lo.nombre AS origen, ld.nombre AS destino, v.fecha, v.viajes, v.periodo
      FROM viajes v JOIN lugares lo ON v.id_origen = lo.id JOIN lugares ld ON v.id_destino = ld.id
      WHERE v.fecha = DATE '2023-01-03' AND lo.nombre = 'NATION_5'
      ORDER BY destino, periodo, viajes LIMIT 10""", ["viajes", "lugares"]),
}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTE[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def build(key: str) -> str:
    body, deps = SQL[key]
    names = _order(deps)
    if not names:
        return body.strip()
    withs = ",\n".join(f"{n} AS ({CTE[n][0]}\n)" for n in names)
    return f"WITH {withs}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    return {k: build(k) for k in SQL}
