"""One SQL text per query key. Shared frames are CTEs, pulled in by name where a text uses them."""

from __future__ import annotations

import re

CTE: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def even(x: str, digits: int) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def raw(x: str, digits: int) -> str:
    return (f"CASE WHEN abs({x}) < 1e30 THEN CAST(round_even(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE) "
            f"ELSE {x} END")


def up(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def clip(x: str, low: float | None, high: float | None) -> str:
    inner = x
    if low is not None:
        inner = f"greatest({inner}, {low}::DOUBLE)"
    if high is not None:
        inner = f"least({inner}, {high}::DOUBLE)"
    return f"CASE WHEN {x} IS NOT NULL THEN {inner} END"


def percent(rate: str) -> str:
    return f"CAST(CAST(round_even(CAST(({rate}) * 100 AS DECIMAL(18,8)), 1) AS DECIMAL(18,1)) AS VARCHAR) || '%'"


def texts(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def with_ctes(body: str) -> str:
    """Prefix the CTEs a text names, dependencies first."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in CTE:
            if re.search(rf"\b{name}\b", sql) and name not in order:
                need(CTE[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in order) + "\n" + body.strip()


BODY: dict[str, str] = {}


def add(key: str, body: str) -> None:
    BODY[key] = body
    ORACLE[key] = with_ctes(body)


# --- fixed values ----------------------------------------------------------------------
COUNTRIES = ("TN", "DZ", "MA", "LY", "EG", "LB", "GR", "TR", "IT", "FR", "ES", "CL", "GB", "NL")
LATS = (36.82, 36.74, 33.57, 32.90, 30.06, 33.89, 37.98, 41.01, 41.90, 43.30, 40.42, -33.45, 51.51, 52.37)
LONS = (10.17, 3.06, -7.59, 13.18, 31.24, 35.50, 23.73, 28.95, 12.50, 5.37, -3.70, -70.67, -0.13, 4.90)
SOURCES = ("openmeteo", "openaq", "waqi")
POLLUTANTS = ("pm2_5", "pm10", "nitrogen_dioxide", "ozone")
FEATURES = ("pm2_5", "ozone", "nitrogen_dioxide")
FLAGS = {"who_pm25_exceed": ("pm2_5", 15), "who_pm10_exceed": ("pm10", 45),
         "who_no2_exceed": ("nitrogen_dioxide", 25), "who_o3_exceed": ("ozone", 100)}
MAXIMA = {"pm2_5": 1000, "pm10": 2000, "nitrogen_dioxide": 500, "ozone": 500}
BOUNDS = {"temp_max_c": (-60, 60), "temp_min_c": (-60, 60), "temp_mean_c": (-60, 60),
          "apparent_temp_max_c": (-80, 80), "precipitation_mm": (0, 1000),
          "wind_speed_max_kmh": (0, 400), "wind_gust_max_kmh": (0, 500), "humidity_pct": (0, 100),
          "dust": (0, 10000)}
AQI = ("good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy", "hazardous", "unknown")
CONDITIONS = ("unknown", "clear", "cloudy", "fog", "drizzle", "rain", "snow", "thunderstorm")
WINDS = ("unknown", "calm", "breezy", "windy", "gale", "storm")
DUSTS = ("unknown", "none", "moderate", "high", "severe")
ANCHORS = (("LB", 33.89, 35.50), ("MA", 33.57, -7.59), ("MA", 34.02, -6.84), ("MA", 31.63, -8.01),
           ("TN", 36.82, 10.17), ("DZ", 36.74, 3.06), ("EG", 30.06, 31.24), ("EG", 31.20, 29.92),
           ("TR", 41.01, 28.95), ("TR", 39.93, 32.86), ("GR", 37.98, 23.73), ("ES", 40.42, -3.70),
           ("ES", 41.39, 2.17), ("IT", 41.90, 12.50), ("IT", 45.46, 9.19))
RUN_TS = "2024-01-31T06:00:00+00:00"


def pick(values, key: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" for v in values)
    return f"[{items}][CAST({key} % {len(values)} AS INT) + 1]"


def lat_of(user: str, nation: str) -> str:
    return f"({pick(LATS, nation)} + ({user} * 7 % 200) / 100e0 - 1e0)"


def lon_of(user: str, nation: str) -> str:
    return f"({pick(LONS, nation)} + ({user} * 13 % 300) / 100e0 - 1.5e0)"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6371e0 * asin(sqrt(least(1e0, pow(sin(radians({lat2} - {lat1}) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


# --- landings ----------------------------------------------------------------------------
CTE["stations"] = f"""
SELECT c_custkey AS user_id, 'st' || c_custkey || '_' || lower({pick(COUNTRIES, 'c_nationkey')}) AS station_id,
  c_name AS station_name,
  CASE WHEN c_custkey % 3 <> 0 THEN CASE WHEN c_custkey % 4 = 0 THEN ''
       WHEN c_custkey % 4 <> 1 THEN 'City ' || c_nationkey END END AS city,
  CASE WHEN c_custkey % 11 <> 0 THEN {pick(COUNTRIES, 'c_nationkey')} END AS country_code,
  {lat_of('c_custkey', 'c_nationkey')} AS latitude, {lon_of('c_custkey', 'c_nationkey')} AS longitude,
  {pick(SOURCES, 'c_custkey')} AS source
FROM customer"""

CTE["readings"] = """
SELECT event_id, user_id, ts,
  CAST(CASE WHEN user_id % 13 = 5 THEN DATE '2024-01-05'
       WHEN CAST(ts AS DATE) IN (DATE '2024-01-12', DATE '2024-01-20') AND user_id % 5 <> 0
       THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS VARCHAR) AS date,
  CASE event_type WHEN 'view' THEN 'pm2_5' WHEN 'click' THEN 'pm10' WHEN 'purchase' THEN 'nitrogen_dioxide'
       WHEN 'signup' THEN 'ozone' WHEN 'error' THEN 'dust' END AS parameter,
  CASE WHEN event_type = 'purchase' THEN value / 2 ELSE value END AS value, value AS raw_value,
  TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS code
FROM events"""

_MEANS = ", ".join(
    f"{even(f'''avg(CASE WHEN parameter = '{p}' THEN value END)''', 4)} AS {p}" for p in POLLUTANTS)
CTE["bronze_air"] = f"""
SELECT station_id, station_name, city, country_code,
  CASE WHEN user_id % 29 = 11 THEN 999e0 ELSE latitude END AS latitude, longitude,
  CASE WHEN user_id % 23 = 7 THEN pm2_5 * 20 ELSE pm2_5 END AS pm2_5,
  CASE WHEN user_id % 31 = 5 THEN -pm10 ELSE pm10 END AS pm10,
  nitrogen_dioxide, ozone, date, date AS partition_date, source
FROM (SELECT user_id, date, {_MEANS} FROM readings GROUP BY user_id, date) JOIN stations USING (user_id)"""

CTE["model_grid"] = f"""
SELECT CAST(round_even(latitude * 10000, 0) AS BIGINT) AS la, CAST(round_even(longitude * 10000, 0) AS BIGINT) AS lo,
  date, max(model) AS model
FROM (SELECT user_id, date, {even("avg(CASE WHEN parameter = 'dust' THEN value END) / 2", 4)} AS model
      FROM readings GROUP BY user_id, date) JOIN stations USING (user_id)
WHERE model IS NOT NULL GROUP BY 1, 2, 3"""

CTE["bronze_weather"] = f"""
SELECT station_id, station_name, country_code, latitude, longitude, w.date, w.* EXCLUDE (user_id, date),
  w.date AS partition_date
FROM (SELECT user_id, date, max(raw_value) / 5 + 10 AS temp_max_c, min(raw_value) / 5 - 5 AS temp_min_c,
    {even('avg(raw_value) / 10 + 10', 4)} AS temp_mean_c, max(raw_value) / 5 + 12 AS apparent_temp_max_c,
    max(raw_value) FILTER (parameter = 'nitrogen_dioxide') / 10 AS precipitation_mm,
    max(raw_value) FILTER (parameter = 'pm10') / 2 AS wind_speed_max_kmh,
    max(raw_value) FILTER (parameter = 'pm10') AS wind_gust_max_kmh,
    {even("avg(raw_value) FILTER (parameter = 'ozone')", 4)} AS humidity_pct,
    max(code) AS weather_code, {even("avg(raw_value) FILTER (parameter = 'dust')", 2)} AS dust
  FROM readings GROUP BY user_id, date) w JOIN stations USING (user_id)"""

CTE["weather_history"] = """
SELECT 'sup' || l_suppkey AS station_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS partition_date,
  max(l_extendedprice) / 2500 + 5 AS temp_max_c, min(l_extendedprice) / 2500 - 5 AS temp_min_c
FROM lineitem GROUP BY 1, 2"""

# --- Silver ------------------------------------------------------------------------------
_CLIPPED = ", ".join(f"{clip(p, 0, MAXIMA[p])} AS {p}" for p in POLLUTANTS)
CTE["cleaned"] = f"""
SELECT * REPLACE ({_CLIPPED}) FROM bronze_air
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""

CTE["patched"] = """
SELECT c.* REPLACE (CASE WHEN source = 'openmeteo' THEN pm2_5 ELSE coalesce(pm2_5, model) END AS pm2_5),
  CASE WHEN source = 'openmeteo' AND pm2_5 IS NOT NULL THEN 'model_grid'
       WHEN pm2_5 IS NOT NULL THEN 'ground_sensor'
       WHEN source <> 'openmeteo' AND model IS NOT NULL THEN 'model_estimated' END AS pm2_5_source
FROM cleaned c LEFT JOIN model_grid g
  ON g.la = CAST(round_even(c.latitude * 10000, 0) AS BIGINT)
 AND g.lo = CAST(round_even(c.longitude * 10000, 0) AS BIGINT) AND g.date = c.date"""


def enriched(source: str) -> str:
    present = " + ".join(f"({p} IS NOT NULL)::INT" for p in POLLUTANTS)
    flags = ", ".join(f"CAST(coalesce({c}, 0) > {t} AS BIGINT) AS {f}" for f, (c, t) in FLAGS.items())
    return f"""
SELECT *, ({present}) / 4e0 AS data_completeness,
  CASE WHEN pm2_5 IS NULL THEN 'unknown' WHEN pm2_5 <= 12.0 THEN 'good' WHEN pm2_5 <= 35.4 THEN 'moderate'
       WHEN pm2_5 <= 55.4 THEN 'unhealthy_sensitive' WHEN pm2_5 <= 150.4 THEN 'unhealthy'
       WHEN pm2_5 <= 250.4 THEN 'very_unhealthy' ELSE 'hazardous' END AS aqi_category, {flags}
FROM {source} WHERE ({present}) / 4e0 >= 0.2"""


_SILVER_COLUMNS = f"""station_id, station_name, city, country_code, latitude, longitude, date,
  {', '.join(POLLUTANTS)}, pm2_5_source, aqi_category, {', '.join(FLAGS)}, data_completeness, source,
  '{RUN_TS}' AS silver_ts, partition_date"""
CTE["air"] = f"SELECT {_SILVER_COLUMNS} FROM ({enriched('patched')})"

_WX_CLIPPED = ", ".join(f"{clip(c, lo, hi)} AS {c}" for c, (lo, hi) in BOUNDS.items())
CTE["weather_cleaned"] = f"""
SELECT * REPLACE ({_WX_CLIPPED}, CAST(weather_code AS DOUBLE) AS weather_code), 'openmeteo_weather' AS source
FROM bronze_weather WHERE temp_max_c IS NOT NULL"""

CTE["weather"] = f"""
SELECT station_id, station_name, country_code, latitude, longitude, date, {', '.join(list(BOUNDS)[:8])},
  coalesce(CAST(weather_code AS BIGINT), -1) AS weather_code, dust,
  CASE WHEN weather_code = 0 THEN 'clear' WHEN weather_code IN (1, 2, 3) THEN 'cloudy'
       WHEN weather_code IN (45, 48) THEN 'fog' WHEN weather_code IN (51, 53, 55, 56, 57) THEN 'drizzle'
       WHEN weather_code IN (61, 63, 65, 66, 67, 80, 81, 82) THEN 'rain'
       WHEN weather_code IN (71, 73, 75, 77, 85, 86) THEN 'snow'
       WHEN weather_code IN (95, 96, 99) THEN 'thunderstorm' ELSE 'unknown' END AS condition,
  CASE WHEN wind_gust_max_kmh IS NULL THEN 'unknown' WHEN wind_gust_max_kmh < 20 THEN 'calm'
       WHEN wind_gust_max_kmh < 39 THEN 'breezy' WHEN wind_gust_max_kmh < 62 THEN 'windy'
       WHEN wind_gust_max_kmh < 89 THEN 'gale' ELSE 'storm' END AS wind_level,
  CASE WHEN dust IS NULL THEN 'unknown' WHEN dust < 20 THEN 'none' WHEN dust < 50 THEN 'moderate'
       WHEN dust < 200 THEN 'high' ELSE 'severe' END AS dust_level,
  source, '{RUN_TS}' AS silver_ts, partition_date
FROM weather_cleaned"""

# --- Gold --------------------------------------------------------------------------------
_PCTS = ", ".join(f"{even(f'avg({f}) * 100', 1)} AS {f}_pct" for f in FLAGS)
CTE["summary"] = f"""
SELECT partition_date, coalesce(country_code, upper(string_split(station_id, '_')[-1])) AS country_code, source,
  {even('avg(pm2_5)', 2)} AS mean_pm2_5, {even('avg(pm10)', 2)} AS mean_pm10,
  {even('avg(nitrogen_dioxide)', 2)} AS mean_no2, {even('avg(ozone)', 2)} AS mean_o3,
  {even('max(pm2_5)', 2)} AS max_pm2_5, count(DISTINCT station_id) AS station_count, {_PCTS}
FROM air GROUP BY 1, 2, 3"""

_O3 = "least(greatest(coalesce(ozone, 0) / 180e0, 0e0), 1e0)"
_PM = "least(greatest(coalesce(pm2_5, 0) / 150e0, 0e0), 1e0)"
CTE["risk"] = f"""
SELECT *, CASE WHEN risk_index <= 25 THEN 'low' WHEN risk_index <= 50 THEN 'moderate'
  WHEN risk_index <= 75 THEN 'high' ELSE 'extreme' END AS risk_level
FROM (SELECT partition_date, source, station_id, station_name, country_code, latitude, longitude, pm2_5, ozone,
  {even(f'({_O3} * 0.6e0 + {_PM} * 0.4e0) * 100', 1)} AS risk_index FROM air)"""


def heat(source: str) -> str:
    """Baselines, then streaks as islands between cool (or mild) rows."""
    return f"""
SELECT *, CASE WHEN is_hot_day THEN row_number() OVER (PARTITION BY station_id, hot_island, is_hot_day
              ORDER BY partition_date) ELSE 0 END AS heat_streak_days,
  CASE WHEN is_cold_day THEN row_number() OVER (PARTITION BY station_id, cold_island, is_cold_day
              ORDER BY partition_date) ELSE 0 END AS cold_streak_days
FROM (SELECT *, count(*) FILTER (NOT is_hot_day) OVER r AS hot_island,
             count(*) FILTER (NOT is_cold_day) OVER r AS cold_island
  FROM (SELECT *,
      coalesce(heat_baseline_c IS NOT NULL AND temp_max_c > greatest(heat_baseline_c, 30e0), false) AS is_hot_day,
      coalesce(cold_baseline_c IS NOT NULL AND temp_min_c < least(cold_baseline_c, 5e0), false) AS is_cold_day
    FROM (SELECT *,
        CASE WHEN count(temp_max_c) OVER p >= 10 THEN quantile_cont(temp_max_c, 0.9) OVER p END AS heat_baseline_c,
        CASE WHEN count(temp_min_c) OVER p >= 10 THEN quantile_cont(temp_min_c, 0.1) OVER p END AS cold_baseline_c
      FROM {source}
      WINDOW p AS (PARTITION BY station_id ORDER BY partition_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)))
  WINDOW r AS (PARTITION BY station_id ORDER BY partition_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


CTE["heat_days"] = heat("weather")
CTE["heat_history"] = heat("weather_history")


def worst(column: str, order) -> str:
    ranks = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(order))
    names = ", ".join(f"'{v}'" for v in order)
    return f"coalesce([{names}][max(CASE {column} {ranks} END) + 1], 'unknown')"


_WX = {"temp_max_c": "max", "temp_mean_c": "avg", "temp_min_c": "min", "apparent_temp_max_c": "max",
       "precipitation_mm": "max", "wind_gust_max_kmh": "max", "humidity_pct": "avg", "dust": "max"}
CTE["country_weather"] = f"""
SELECT partition_date, country_code, stations, {', '.join(f"{even(f'x_{c}', 1)} AS {c}" for c in _WX)},
  heat_streak_days, cold_streak_days, stations_hot, stations_cold, condition, wind_level, dust_level,
  CASE WHEN heat_streak_days >= 3 AND x_temp_max_c >= 40 THEN 'extreme_heatwave'
       WHEN heat_streak_days >= 3 THEN 'heatwave' WHEN heat_streak_days > 0 THEN 'heat_advisory'
       ELSE 'none' END AS heat_alert,
  CASE WHEN cold_streak_days >= 3 AND x_temp_min_c <= 0 THEN 'severe_cold_wave'
       WHEN cold_streak_days >= 3 THEN 'cold_wave' WHEN cold_streak_days > 0 THEN 'cold_advisory'
       ELSE 'none' END AS cold_alert
FROM (SELECT partition_date, country_code, count(DISTINCT station_id) AS stations,
    {', '.join(f'{fn}({c}) AS x_{c}' for c, fn in _WX.items())},
    CAST(max(heat_streak_days) AS BIGINT) AS heat_streak_days, CAST(max(cold_streak_days) AS BIGINT) AS cold_streak_days,
    count(*) FILTER (is_hot_day) AS stations_hot, count(*) FILTER (is_cold_day) AS stations_cold,
    {worst('condition', CONDITIONS)} AS condition, {worst('wind_level', WINDS)} AS wind_level,
    {worst('dust_level', DUSTS)} AS dust_level
  FROM heat_days GROUP BY 1, 2)"""

CTE["model_rows"] = """
SELECT * FROM air WHERE source IN ('openmeteo', 'openaq')
  AND (pm2_5 IS NOT NULL OR ozone IS NOT NULL OR nitrogen_dioxide IS NOT NULL)"""
CTE["flagged"] = f"""
SELECT station_id, station_name, country_code, source, date, partition_date, pm2_5, ozone, nitrogen_dioxide,
  latitude, longitude,
  {even('-(0.3e0 + coalesce(pm2_5, 0) / 2000 + coalesce(ozone, 0) / 2000)', 6)} AS anomaly_score,
  CAST(coalesce(pm2_5, 0) > 150 OR coalesce(ozone, 0) > 180 AS BIGINT) AS is_anomaly
FROM model_rows"""

_ANCHORS = ", ".join(f"('{c}', {la}::DOUBLE, {lo}::DOUBLE)" for c, la, lo in ANCHORS)
CTE["anchors"] = f"SELECT * FROM (VALUES {_ANCHORS}) t(cc, a_lat, a_lon)"


def near(alias: str) -> str:
    return (f"(NOT EXISTS (SELECT 1 FROM anchors WHERE cc = upper(coalesce({alias}.country_code, ''))) "
            f"OR EXISTS (SELECT 1 FROM anchors WHERE cc = upper(coalesce({alias}.country_code, '')) AND "
            f"{km(f'{alias}.latitude', f'{alias}.longitude', 'a_lat', 'a_lon')} <= 100))")


_KEEP = "coalesce(x.country_code NOT IN ('CL', 'GB', 'NL'), true)"
_NEAR = f"(x.source IS DISTINCT FROM 'waqi' OR {near('x')})"
CTE["r_summary"] = f"SELECT x.* FROM summary x WHERE {_KEEP}"
CTE["r_weather"] = f"SELECT x.* FROM country_weather x WHERE {_KEEP}"
CTE["r_risk"] = f"SELECT x.* FROM risk x WHERE {_KEEP} AND {_NEAR}"
CTE["r_anomalies"] = f"SELECT x.* FROM flagged x WHERE {_KEEP} AND {_NEAR}"

# --- landings and sources ------------------------------------------------------------------
CTE["hours"] = """
SELECT CAST(user_id AS VARCHAR) AS station_id,
  strftime(date_trunc('hour', ts) + to_hours(CAST(i AS INT)), '%Y-%m-%dT%H:%M') AS time,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN CASE i WHEN 0 THEN value WHEN 1 THEN value + 1 END END AS pm2_5,
  CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN CASE i WHEN 0 THEN value / 2 WHEN 2 THEN value END END AS pm10,
  CASE WHEN event_type IN ('purchase', 'signup', 'view') THEN value / 4 END AS nitrogen_dioxide,
  CASE WHEN i = 0 THEN value * 2 END AS ozone
FROM events, range(3) t(i) WHERE event_type <> 'error'"""
add("src_hourly_payload", "SELECT station_id, time, time[1:10] AS date, pm2_5, pm10, nitrogen_dioxide, ozone FROM hours")
_DAY = ", ".join(f"{even(f'avg({p})', 4)} AS {p}" for p in POLLUTANTS)
add("hourly_to_daily", f"SELECT station_id, time[1:10] AS date, {_DAY} FROM hours GROUP BY 1, 2")

CTE["weather_docs"] = """
SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(CAST(ts AS DATE) + CAST(i AS INT) AS VARCHAR) AS date,
  value + i AS temp_max_c, CASE WHEN i = 0 THEN value - 20 END AS temp_min_c,
  CASE i WHEN 0 THEN value - 5 ELSE value - 4 END AS temp_mean_c,
  CASE i WHEN 0 THEN value + 2 ELSE value + 3 END AS apparent_temp_max_c,
  CASE WHEN i = 0 AND event_type <> 'view' THEN value / 10 END AS precipitation_mm,
  value / 2 AS wind_speed_max_kmh, value AS wind_gust_max_kmh, value / 4 AS humidity_pct,
  CASE WHEN i = 0 THEN TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) END AS weather_code
FROM events, range(2) t(i)"""
add("src_daily_weather_payload", "SELECT * FROM weather_docs")
CTE["dust_days"] = f"""
SELECT station_id, date, {even('avg(dust)', 2)} AS dust FROM (
  SELECT CAST(user_id AS VARCHAR) AS station_id,
    CAST(CAST(date_trunc('hour', ts) + to_hours(CAST(i * 12 AS INT)) AS DATE) AS VARCHAR) AS date,
    CASE i WHEN 0 THEN value WHEN 2 THEN value * 2 END AS dust
  FROM events, range(3) t(i) WHERE event_type <> 'view') GROUP BY 1, 2"""
add("src_hourly_dust", "SELECT * FROM dust_days")
add("weather_dust_join", """
SELECT d.station_id, d.date, temp_max_c, weather_code, dust FROM weather_docs d LEFT JOIN dust_days USING (station_id, date)""")

CTE["locations"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_custkey, c_name AS station_name,
  CASE WHEN c_custkey % 4 <> 1 THEN 'City ' || c_nationkey END AS city, {pick(COUNTRIES, 'c_nationkey')} AS country_code,
  {lat_of('c_custkey', 'c_nationkey')} AS latitude, {lon_of('c_custkey', 'c_nationkey')} AS longitude
FROM customer WHERE c_custkey % 7 <> 0 OR {pick(COUNTRIES, 'c_nationkey')} = {pick(COUNTRIES, '(c_nationkey + 1)')}"""
add("src_locations", "SELECT * EXCLUDE (c_custkey) FROM locations")
add("src_sensor_params", """
SELECT station_id, c_custkey * 10 + id AS sensor_id, parameter
FROM locations, (VALUES (1, 'pm10'), (2, 'pm2_5'), (3, 'ozone'), (5, 'nitrogen_dioxide')) p(id, parameter)""")
add("src_daily_measurements", """
SELECT o_custkey AS sensor_id, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice / x AS value
FROM orders, (VALUES (1000), (2000), (4000)) d(x)""")
add("src_first_measurement", "SELECT o_custkey AS sensor_id, o_totalprice / 1000 AS value FROM orders")
add("requested_dates", "SELECT DISTINCT o_custkey % 20 AS list, strftime(o_orderdate, '%Y-%m-%d') AS partition_date FROM orders")


def _set_aside(kind: str, table: str, key: str, part: str, wanted: str, block: bool) -> str:
    """Reasons by the rule the bodies are damaged with."""
    unequal = "WHEN 5 THEN 'arrays of unequal length'" if block else ""
    # Of a block whose hours are empty nothing is lengthened, and an absent dust array has no length.
    keep = {"hourly": "event_type = 'error'", "dust": "event_type = 'view'"}.get(kind, "false")
    return f"""SELECT '{kind}' AS kind, CASE WHEN {key} % 7 = 5 AND {keep} THEN NULL ELSE CASE {key} % 7 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'empty body'
      WHEN 2 THEN 'not an object' WHEN 3 THEN 'no {part}' WHEN 4 THEN '{part} is no {wanted}' {unequal} END END AS reason,
    count(*) AS payloads FROM {table} GROUP BY 2"""


add("payload_quarantine", " UNION ALL ".join(_set_aside(*x) for x in (
    ("hourly", "events", "user_id", "hourly.time", "array", True), ("dust", "events", "user_id", "hourly.time", "array", True),
    ("daily", "events", "user_id", "daily.time", "array", True), ("locations", "customer", "c_custkey", "results", "array", False),
    ("measurements", "orders", "o_custkey", "results", "array", False), ("feed", "events", "user_id", "feed", "object", False),
    ("search", "customer", "c_custkey", "data", "array", False))))
add("src_station_feed", f"""
SELECT CAST(user_id AS VARCHAR) AS station_id, 'City ' || (user_id % 25) AS station_name, 'City ' || (user_id % 25) AS city,
  {pick(COUNTRIES, 'user_id')} AS country_code,
  CASE WHEN event_type <> 'error' THEN CAST(user_id % 10 + 30 AS DOUBLE) END AS latitude,
  CASE WHEN event_type <> 'error' THEN CAST(user_id % 20 AS DOUBLE) END AS longitude,
  CASE WHEN event_type = 'view' THEN value END AS pm2_5, CASE WHEN event_type = 'click' THEN value END AS pm10,
  CASE WHEN event_type = 'purchase' THEN value END AS nitrogen_dioxide,
  CASE WHEN event_type = 'signup' THEN value END AS ozone,
  CAST(CAST(ts AS DATE) + CAST(event_id % 5 - 2 AS INT) AS VARCHAR) AS date,
  CAST(CAST(ts AS DATE) + CAST(event_id % 5 - 2 AS INT) AS VARCHAR) AS partition_date, 'waqi' AS source
FROM events WHERE abs(event_id % 5 - 2) <= 1""")
CTE["hits"] = f"""
SELECT x.* FROM (
  SELECT CAST(c_nationkey AS INT) AS query_order, {pick(COUNTRIES, 'c_nationkey')} AS country_code,
    CAST(pos AS INT) AS position,
    CASE pos WHEN 0 THEN c_custkey WHEN 3 THEN c_custkey + 2000000 ELSE c_custkey % 500 END AS uid,
    c_name AS station_name,
    {lat_of('c_custkey', 'c_nationkey')} + CASE pos WHEN 3 THEN 5e0 ELSE 0e0 END AS latitude,
    {lon_of('c_custkey', 'c_nationkey')} AS longitude
  FROM customer, (VALUES (0), (3), (4)) p(pos)) x WHERE {near('x')}"""
add("src_station_search", "SELECT * FROM hits")
add("topk_per_key", """
SELECT uid, query_order, position, country_code FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY query_order, position, country_code) AS first
  FROM (SELECT *, row_number() OVER (PARTITION BY query_order ORDER BY position, uid) AS hit FROM hits)
  WHERE hit <= 3) WHERE first = 1""")
add("locations_per_country", """
SELECT country_code, station_id FROM (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY c_custkey) AS n
  FROM locations) WHERE n <= 50""")
add("openaq_pivot", f"""
SELECT station_id, station_name, city, country_code, latitude, longitude, date, {_MEANS}
FROM readings JOIN stations USING (user_id) WHERE value >= 0 GROUP BY ALL""")
add("ingest_completeness", """
SELECT station_id, 'missing' AS problem FROM stations WHERE station_id NOT IN (SELECT station_id FROM bronze_weather)""")

# --- scans ---------------------------------------------------------------------------------
add("scan_partition_filter", """
SELECT station_id, source, partition_date, pm2_5 FROM bronze_air
WHERE partition_date IN ('2024-01-03', '2024-01-12', '2024-01-27')""")
add("scan_silver_window", "SELECT station_id, source, partition_date, pm2_5 FROM air WHERE partition_date >= '2024-01-17'")
add("scan_recent_partitions", """
SELECT 'recent' AS read, station_id, source, partition_date, pm2_5 FROM air WHERE partition_date >= '2024-01-28'
UNION ALL SELECT 'named', station_id, source, partition_date, pm2_5 FROM air
WHERE partition_date IN ('2024-01-05', '2024-01-09')""")
add("list_partitions", "SELECT DISTINCT partition_date FROM air")
CTE["stg"] = f"""
SELECT station_id, station_name, city, country_code, CAST(date AS DATE) AS observation_date, latitude, longitude,
  {', '.join(POLLUTANTS)}, aqi_category, {', '.join(f'CAST({f} AS INT) AS {f}' for f in FLAGS)},
  data_completeness, source, partition_date, silver_ts AS _loaded_at FROM air"""
add("stg_air_quality", "SELECT * FROM stg")

# --- Silver --------------------------------------------------------------------------------
add("silver_clean", f"""
SELECT station_id, station_name, CAST(NULL AS VARCHAR) AS city, country_code, latitude, longitude, source,
  {clip('pm2_5', 0, 1000)} AS pm2_5,
  CASE WHEN pm10 > 60 THEN NULL WHEN pm10 IS NOT NULL THEN greatest(pm10, 0e0) END AS pm10,
  {clip('nitrogen_dioxide', 0, 500)} AS nitrogen_dioxide,
  CASE WHEN ozone > 120 THEN NULL ELSE {clip('ozone', 0, 500)} END AS ozone, date
FROM bronze_air WHERE latitude BETWEEN -90 AND 90 AND date NOT LIKE '%-17' AND date NOT LIKE '%-11'""")
add("silver_enrich", f"""
SELECT station_id, date, {', '.join(POLLUTANTS)}, data_completeness, aqi_category, {', '.join(FLAGS)}
FROM ({enriched('cleaned')})""")
add("silver_canonical", "SELECT * FROM air")
add("silver_union_sources", "SELECT * REPLACE (CASE WHEN source <> 'openmeteo' THEN city END AS city) FROM air")
add("pm25_patch", "SELECT station_id, source, date, latitude, longitude, pm2_5, pm2_5_source FROM patched")
add("weather_clean", "SELECT * EXCLUDE (partition_date) FROM weather_cleaned")
add("weather_enrich", "SELECT * FROM weather")
add("air_weather_join", """
SELECT a.station_id, a.date, a.source, pm2_5, ozone, temp_max_c, temp_min_c, condition, wind_level, dust_level
FROM air a JOIN weather w ON a.station_id = w.station_id AND a.date = w.date""")
add("incremental_partitions", """
SELECT DISTINCT source, partition_date FROM bronze_air
EXCEPT SELECT DISTINCT source, partition_date FROM air
WHERE partition_date <= CASE source WHEN 'openmeteo' THEN '2024-01-20' WHEN 'openaq' THEN '2024-01-25' ELSE '2024-01-02' END""")
add("changed_partitions", """
SELECT DISTINCT source, partition_date FROM bronze_air
WHERE partition_date >= '2024-01-25' OR (partition_date = '2024-01-02' AND source = 'waqi')
  OR (source = 'openaq' AND day(CAST(partition_date AS DATE)) % 3 = 0 AND ozone IS NOT NULL)""")
add("missing_dates", """
SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS partition_date
FROM range(DATE '2023-12-28', DATE '2024-02-04', INTERVAL 1 DAY) t(day)
WHERE CAST(CAST(day AS DATE) AS VARCHAR) NOT IN (SELECT partition_date FROM air
  WHERE partition_date <= '2024-01-10' OR partition_date > '2024-01-15')""")

# --- Gold ----------------------------------------------------------------------------------
add("daily_country_summary", "SELECT * FROM summary")
add("wildfire_risk_index", "SELECT * FROM risk")
add("trailing_quantile", f"""
SELECT station_id, partition_date, {even('heat_baseline_c', 6)} AS heat_baseline_c,
  {even('cold_baseline_c', 6)} AS cold_baseline_c FROM heat_days""")
_STREAKS = "is_hot_day, is_cold_day, heat_streak_days, cold_streak_days"
add("heat_streak", f"SELECT station_id, partition_date, {_STREAKS} FROM heat_history")
add("flag_heat_events", f"SELECT station_id, partition_date, temp_max_c, temp_min_c, {_STREAKS} FROM heat_days")
add("daily_country_weather", "SELECT * FROM country_weather")
add("anomaly_features", f"""
WITH settled AS (SELECT * FROM model_rows WHERE station_id IN
  (SELECT station_id FROM model_rows GROUP BY station_id HAVING count(DISTINCT date) >= 2))
SELECT station_id, source, date,
  {', '.join(even(f'coalesce({f}, (SELECT median({f}) FROM settled))', 6) + f' AS model_{f}' for f in FEATURES)}
FROM settled""".replace("WITH settled AS (", "SELECT * FROM (WITH settled AS (") + ")")


add("anomaly_audit", f"""
SELECT station_id, source, date, {', '.join(f'{f}' for f in FEATURES)}, true AS score_in_range, true AS flag_follows_scores
FROM model_rows WHERE station_id IN (SELECT station_id FROM model_rows GROUP BY station_id HAVING count(DISTINCT date) >= 2)""")
add("forest_daily_rates", """
SELECT partition_date, count(*) AS rows FROM model_rows
WHERE station_id IN (SELECT station_id FROM model_rows GROUP BY station_id HAVING count(DISTINCT date) >= 2) GROUP BY 1""")
add("scan_non_empty", "SELECT * FROM summary")
add("dates_in_paths", "SELECT DISTINCT partition_date FROM air WHERE partition_date IS NOT NULL")


def pct(flag: str) -> str:
    return f"{up(f'avg({flag}) * 100', 1)} AS {flag}_pct"


add("mart_daily_air_quality", f"""
SELECT observation_date, country_code, source, aqi_category AS dominant_aqi_tier,
  count(DISTINCT station_id) AS station_count, {up('avg(pm2_5)', 2)} AS daily_mean_pm2_5,
  {up('max(pm2_5)', 2)} AS daily_max_pm2_5, {up('avg(pm10)', 2)} AS daily_mean_pm10,
  {up('avg(nitrogen_dioxide)', 2)} AS daily_mean_nitrogen_dioxide, {up('avg(ozone)', 2)} AS daily_mean_ozone,
  {', '.join(pct(f) for f in FLAGS)}, {up('avg(data_completeness)', 4)} AS mean_data_completeness
FROM stg GROUP BY 1, 2, 3, 4""")
_WEEK = "OVER (PARTITION BY country_code, city_name, source ORDER BY observation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
add("mart_city_weekly_trend", f"""
SELECT *, {up(f'avg(daily_mean_pm2_5) {_WEEK}', 2)} AS rolling_7d_pm2_5,
  {up(f'avg(daily_mean_ozone) {_WEEK}', 2)} AS rolling_7d_ozone
FROM (SELECT observation_date, country_code, coalesce(nullif(city, ''), station_name, station_id) AS city_name, source,
    count(DISTINCT station_id) AS station_count, {up('avg(pm2_5)', 2)} AS daily_mean_pm2_5,
    {up('avg(ozone)', 2)} AS daily_mean_ozone, {up('avg(data_completeness)', 4)} AS mean_data_completeness
  FROM stg GROUP BY 1, 2, 3, 4)""")


def available(column: str, name: str) -> str:
    return f"{up(f'avg(CASE WHEN {column} IS NOT NULL THEN 1e0 ELSE 0e0 END) * 100', 1)} AS {name}_available_pct"


add("mart_source_coverage", f"""
SELECT observation_date, country_code, source, count(DISTINCT station_id) AS station_count, count(*) AS reading_count,
  {up('avg(data_completeness)', 4)} AS mean_data_completeness, {available('pm2_5', 'pm2_5')},
  {available('pm10', 'pm10')}, {available('nitrogen_dioxide', 'no2')}, {available('ozone', 'ozone')}
FROM stg GROUP BY 1, 2, 3""")
add("mart_who_exceedance_streak", f"""
SELECT * EXCLUDE (island), CAST(CASE WHEN has_who_exceedance = 1 THEN row_number() OVER
    (PARTITION BY station_id, source, island, has_who_exceedance ORDER BY observation_date) ELSE 0 END AS BIGINT)
    AS current_exceedance_streak_days
FROM (SELECT *, count(*) FILTER (has_who_exceedance = 0) OVER (PARTITION BY station_id, source
        ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM (SELECT *, CASE WHEN {' OR '.join(f'{f} = 1' for f in FLAGS)} THEN 1 ELSE 0 END AS has_who_exceedance
    FROM (SELECT observation_date, station_id, station_name, country_code, source,
        {', '.join(f'max({f}) AS {f}' for f in FLAGS)} FROM stg GROUP BY 1, 2, 3, 4, 5)))""")

# --- sinks ---------------------------------------------------------------------------------
add("sink_append_roundtrip", "SELECT * REPLACE (CASE WHEN source <> 'openmeteo' THEN city END AS city) FROM bronze_air")
add("sink_replace_range", """
SELECT station_id, partition_date, temp_min_c,
  CASE WHEN partition_date BETWEEN '2024-01-13' AND '2024-01-16' THEN temp_max_c + 1 ELSE temp_max_c END AS temp_max_c
FROM bronze_weather WHERE partition_date <> '2024-01-14'""")
add("sink_overwrite", "SELECT * FROM summary WHERE partition_date > '2024-01-02'")
_SPLICE = """
SELECT * REPLACE (CASE WHEN partition_date < '2024-01-17' THEN -1e0 ELSE mean_pm2_5 END AS mean_pm2_5)
FROM summary WHERE partition_date <> '2024-01-08'"""
add("gold_merge_refreshed", _SPLICE)
add("gold_refresh", _SPLICE)

_OLD = "SELECT * REPLACE (-1e0 AS mean_pm2_5) FROM summary WHERE partition_date NOT IN ('2024-01-08', '2024-01-28')"
_CUT = f"SELECT * FROM ({_SPLICE}) WHERE partition_date NOT IN ('2024-01-20', '2024-01-22')"
add("table_restore", _SPLICE)
add("table_as_of_version", " UNION ALL ".join(
    f"SELECT {n}::INTEGER AS version, partition_date, country_code, source, mean_pm2_5 FROM ({q})"
    for n, q in ((1, _OLD), (2, _SPLICE), (3, _CUT))))


def _days(rows: str, where: str = "true") -> str:
    return f"(SELECT count(DISTINCT partition_date)::INTEGER FROM ({rows}) WHERE {where})"


_LOST = "partition_date IN ('2024-01-20', '2024-01-22')"
add("table_history", f"""
SELECT 1::INTEGER AS version, 'overwrite' AS operation, (SELECT count(*) FROM ({_OLD})) AS rows, {_days(_OLD)} AS partitions,
  {_days(_OLD)} AS changed, 0::INTEGER AS removed
UNION ALL SELECT 2, 'refresh', (SELECT count(*) FROM summary WHERE partition_date >= '2024-01-17'), {_days(_SPLICE)},
  {_days('SELECT * FROM summary', "partition_date >= '2024-01-17'")}, 0
UNION ALL SELECT 3, 'replace range', (SELECT count(*) FROM summary WHERE partition_date = '2024-01-21'), {_days(_CUT)},
  {_days('SELECT * FROM summary', "partition_date = '2024-01-21'")}, {_days(_SPLICE, _LOST)}
UNION ALL SELECT 4, 'restore 2', 0, {_days(_SPLICE)}, {_days(_SPLICE, "partition_date BETWEEN '2024-01-20' AND '2024-01-22'")}, 0""")

# --- geography -----------------------------------------------------------------------------
add("geo_haversine", f"SELECT station_id, {even(km('latitude', 'longitude', '36.82e0', '10.17e0'), 4)} AS km FROM stations")
add("geo_near_city", f"SELECT x.station_id, {near('x')} AS near FROM stations x")
add("report_filter", f"SELECT x.station_id, x.source, x.date, x.country_code FROM air x WHERE {_KEEP} AND {_NEAR}")

_ANCHORS = "SELECT user_id AS anchor_id, upper(string_split(station_id, '_')[-1]) AS code, latitude AS alat, longitude AS alon FROM stations WHERE user_id % 5 = 0"
_KM = km("x.latitude", "x.longitude", "a.alat", "a.alon")
add("geo_near_anchors", f"""
SELECT x.station_id, x.date, x.country_code FROM air x
WHERE coalesce(upper(x.country_code), '') NOT IN (SELECT code FROM ({_ANCHORS}))
  OR EXISTS (SELECT 1 FROM ({_ANCHORS}) a WHERE a.code = upper(x.country_code) AND {_KM} <= 25)""")
add("geo_nearest_anchor", f"""
SELECT station_id, anchor_id, km FROM (
  SELECT x.station_id, a.anchor_id, {even(_KM, 4)} AS km, {_KM} AS d FROM stations x JOIN ({_ANCHORS}) a ON a.code = upper(x.country_code))
WHERE d <= 60 QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY km, anchor_id) = 1""")

# --- distinct counts -----------------------------------------------------------------------
_COUNTRY = "coalesce(country_code, upper(string_split(station_id, '_')[-1]))"
add("stations_by_week", f"""
SELECT CAST(date_trunc('week', CAST(partition_date AS DATE))::DATE AS VARCHAR) AS week, {_COUNTRY} AS country_code,
  count(DISTINCT station_id) AS stations FROM air GROUP BY 1, 2""")
_BY_MONTH = "SELECT {k}::INTEGER AS level, substr(partition_date, 1, 7) AS month, {c} AS country_code, {s} AS source, count(DISTINCT station_id) AS stations FROM air GROUP BY ALL"
add("stations_by_month", " UNION ALL ".join(_BY_MONTH.format(k=k, c=c, s=s) for k, c, s in (
    (0, _COUNTRY, "source"), (1, _COUNTRY, "NULL::VARCHAR"), (2, "NULL::VARCHAR", "NULL::VARCHAR"))))

# --- report --------------------------------------------------------------------------------
CTE["coverage"] = """
SELECT partition_date, CAST(sum(station_count) AS BIGINT) AS station_days, count(DISTINCT country_code) AS countries,
  count(DISTINCT source) AS source_count, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources
FROM r_summary GROUP BY 1"""
CTE["readiness"] = f"""
SELECT * EXCLUDE (med, seen), {even('med', 2)} AS coverage_baseline_station_days,
  {even('station_days / med', 3)} AS coverage_ratio,
  coalesce(station_days / med BETWEEN 0.45 AND 2.25, true) AS is_reporting_ready
FROM (SELECT *, CASE WHEN seen >= 3 THEN m END AS med FROM (
  SELECT *, count(*) FILTER (station_days > 0) OVER p AS seen,
    median(CASE WHEN station_days > 0 THEN station_days END) OVER p AS m
  FROM coverage WINDOW p AS (ORDER BY partition_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))) q""".replace(
    "SELECT * EXCLUDE (med, seen)", "SELECT * EXCLUDE (med, seen, m)")
CTE["ready"] = "SELECT partition_date FROM readiness WHERE is_reporting_ready"
CTE["shown"] = "SELECT partition_date FROM ready ORDER BY partition_date DESC LIMIT 45"
CTE["rates"] = f"""
SELECT partition_date, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_flags, count(is_anomaly) AS rows,
  {even('sum(is_anomaly) / count(is_anomaly) * 100', 2)} AS anomaly_rate_pct
FROM r_anomalies GROUP BY 1"""
add("coverage_by_date", "SELECT * FROM coverage")
add("coverage_readiness", "SELECT * FROM readiness")
add("reporting_dates", "SELECT * FROM ready")
add("latest_reporting_dates", "SELECT partition_date FROM ready ORDER BY partition_date DESC LIMIT 20")
add("readiness_diagnostics", """
SELECT c.*, coalesce(anomaly_flags, 0) AS anomaly_flags, coalesce(rows, 0) AS rows,
  coalesce(anomaly_rate_pct, 0) AS anomaly_rate_pct FROM readiness c LEFT JOIN rates USING (partition_date)""")
add("anomaly_daily_rates", f"""
SELECT partition_date, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_flags, count(is_anomaly) AS rows,
  {even('sum(is_anomaly) / count(is_anomaly) * 100', 2)} AS anomaly_rate_pct FROM flagged GROUP BY 1""")
add("anomaly_by_country", f"""
SELECT country_code, CAST(sum(is_anomaly) AS BIGINT) AS anomalies, count(is_anomaly) AS total,
  {even('sum(is_anomaly) / count(is_anomaly) * 100', 1)} AS rate
FROM r_anomalies WHERE country_code IS NOT NULL AND partition_date IN (SELECT partition_date FROM shown) GROUP BY 1""")
add("top_anomalies", """
SELECT partition_date, station_id, country_code, anomaly_score FROM r_anomalies
WHERE is_anomaly = 1 AND partition_date IN (SELECT partition_date FROM shown)
ORDER BY anomaly_score, partition_date, station_id LIMIT 10""")
# The summary's newest date as if barely covered: it is not ready to report then.
CTE["thin_summary"] = """
SELECT * REPLACE (CASE WHEN partition_date = (SELECT max(partition_date) FROM r_summary) THEN 1 ELSE station_count END AS station_count)
FROM r_summary"""
CTE["thin_coverage"] = CTE["coverage"].replace("r_summary", "thin_summary")
CTE["thin_readiness"] = CTE["readiness"].replace("coverage WINDOW", "thin_coverage WINDOW")
CTE["thin_shown"] = "SELECT partition_date FROM thin_readiness WHERE is_reporting_ready ORDER BY partition_date DESC LIMIT 45"
CTE["anomaly_day"] = "SELECT * FROM r_anomalies WHERE partition_date = (SELECT max(partition_date) FROM thin_shown)"
CTE["anomaly_shown"] = "SELECT * FROM r_anomalies WHERE partition_date IN (SELECT partition_date FROM thin_shown)"
CTE["brief_day"] = "SELECT * FROM r_anomalies WHERE partition_date = (SELECT max(partition_date) FROM r_summary)"
add("most_anomalous_of_day", """
SELECT partition_date, station_id, anomaly_score, is_anomaly FROM anomaly_day ORDER BY anomaly_score, station_id LIMIT 5""")


def histogram(source: str, key: str, value: str, bins: str) -> str:
    return f"""
SELECT {key}, CAST(bins AS BIGINT) AS bins, CAST(least(floor(({value} - low) / (high - low) * bins), bins - 1) AS BIGINT) AS bin,
  count(*) AS rows
FROM (SELECT {key}, {value} FROM {source} WHERE {value} IS NOT NULL) JOIN (
  SELECT {key}, {bins} AS bins, CASE WHEN a = b THEN a - 0.5 ELSE a END AS low, CASE WHEN a = b THEN b + 0.5 ELSE b END AS high
  FROM (SELECT {key}, min({value}) AS a, max({value}) AS b, count(*) AS n FROM {source} WHERE {value} IS NOT NULL GROUP BY 1))
USING ({key}) GROUP BY 1, 2, 3"""


CTE["day_values"] = " UNION ALL ".join(f"SELECT '{f}' AS pollutant, {f} AS value FROM anomaly_day" for f in FEATURES)
add("score_histogram", histogram("anomaly_shown", "is_anomaly", "anomaly_score", "CASE WHEN is_anomaly = 1 THEN 15 ELSE 30 END"))
add("day_value_histogram", histogram("day_values", "pollutant", "value", "least(greatest(n // 2, 5), 20)"))

FIELDS = ("temp_max_c", "temp_min_c", "temp_mean_c", "apparent_temp_max_c", "condition", "wind_level",
          "wind_gust_max_kmh", "precipitation_mm", "humidity_pct", "dust", "dust_level", "heat_alert",
          "heat_streak_days", "cold_alert", "cold_streak_days")
TEXT = ("condition", "wind_level", "dust_level", "heat_alert", "cold_alert")
CTE["weather_facts"] = f"""
SELECT partition_date, country_code, {', '.join(f if f in TEXT else f'{even(f, 1)} AS {f}' for f in FIELDS)} FROM r_weather"""
CTE["air_facts"] = f"""
SELECT country_code, CAST(sum(station_count) AS BIGINT) AS stations, {even('avg(mean_pm2_5)', 1)} AS mean_pm2_5,
  {even('max(max_pm2_5)', 1)} AS max_pm2_5, {even('avg(mean_pm10)', 1)} AS mean_pm10, {even('avg(mean_no2)', 1)} AS mean_no2,
  {even('avg(mean_o3)', 1)} AS mean_o3, {even('avg(who_pm25_exceed_pct)', 3)} AS who_pm25_exceed_pct
FROM r_summary WHERE country_code IS NOT NULL AND partition_date = (SELECT max(partition_date) FROM r_summary) GROUP BY 1"""
CTE["country_facts"] = f"""
SELECT a.*, {', '.join(f'w.{f}' for f in FIELDS)} FROM air_facts a LEFT JOIN weather_facts w
  ON w.country_code = a.country_code AND w.partition_date = (SELECT max(partition_date) FROM r_summary)"""
add("country_briefing_facts", "SELECT * FROM country_facts")


def json_field(name: str, alias: str, text: bool) -> str:
    value = f"""'"' || {name} || '"'""" if text else f"CAST({name} AS VARCHAR)"
    return f"""'"{alias}":' || {value}"""


_AIR_FIELDS = ("stations", "mean_pm2_5", "max_pm2_5", "mean_pm10", "mean_no2", "mean_o3", "who_pm25_exceed_pct")
_JSON = ", ".join(json_field(f, f, f in TEXT or f == "country_code") for f in ("country_code", *_AIR_FIELDS, *FIELDS))
add("brief_facts", f"SELECT country_code, '{{' || concat_ws(',', {_JSON}) || '}}' AS facts FROM country_facts")

_TOP = "(SELECT * FROM brief_day ORDER BY anomaly_score, station_id, source LIMIT 1)"
add("top_anomaly_facts", f"""
SELECT t.partition_date, station_id, station_name, t.country_code, source, anomaly_score, is_anomaly,
  {', '.join(f'{even(f"t.{f}", 1)} AS {f}' for f in FEATURES)}, {', '.join(f'w.{f}' for f in FIELDS)},
  {', '.join(even(f'(SELECT median({f}) FROM brief_day)', 1) + f' AS median_{f}' for f in FEATURES)},
  (SELECT count(DISTINCT station_id) FROM brief_day) AS stations,
  {', '.join(even(f'(SELECT avg(CAST(d.{f} < z.{f} AS INT)) FROM brief_day d, {_TOP} z) * 100', 2) + f' AS percentile_{f}' for f in FEATURES)}
FROM {_TOP} t LEFT JOIN weather_facts w ON w.country_code = t.country_code AND w.partition_date = t.partition_date""")

_SEASON = "['winter', 'spring', 'summer', 'autumn'][CAST(floor((month({d}) % 12) / 3) AS INT) + 1]"
add("coverage_pivot", """
SELECT d.partition_date, c.country_code, CAST(coalesce(sum(station_count), 0) AS BIGINT) AS station_days
FROM (SELECT DISTINCT partition_date FROM r_summary WHERE partition_date IN (SELECT partition_date FROM shown)) d
CROSS JOIN (SELECT DISTINCT country_code FROM r_summary WHERE country_code IS NOT NULL AND partition_date IN (SELECT partition_date FROM shown)) c
LEFT JOIN r_summary s ON s.partition_date = d.partition_date AND s.country_code = c.country_code GROUP BY 1, 2""")
CTE["focus_days"] = f"""
SELECT partition_date, season, CASE WHEN heat THEN 'heat' WHEN cold THEN 'cold'
  ELSE CASE season WHEN 'winter' THEN 'cold' WHEN 'spring' THEN 'dust' WHEN 'summer' THEN 'heat' ELSE 'rain' END END AS focus
FROM (SELECT partition_date, {_SEASON.format(d='CAST(partition_date AS DATE)')} AS season,
    bool_or(heat_alert IN ('heatwave', 'extreme_heatwave')) AS heat,
    bool_or(cold_alert IN ('cold_wave', 'severe_cold_wave')) AS cold FROM r_weather GROUP BY 1, 2)"""
CTE["focus_now"] = "SELECT season, focus FROM focus_days ORDER BY partition_date DESC LIMIT 1"
_FOCUS_VALUE = """CASE (SELECT focus FROM focus_now) WHEN 'heat' THEN temp_max_c WHEN 'cold' THEN temp_min_c
  WHEN 'rain' THEN precipitation_mm ELSE dust END"""
add("focus_pivot", f"""
SELECT d.partition_date, c.country_code, max({_FOCUS_VALUE}) AS value
FROM (SELECT DISTINCT partition_date FROM r_weather WHERE partition_date IN (SELECT partition_date FROM shown)) d
CROSS JOIN (SELECT DISTINCT country_code FROM r_weather WHERE country_code IS NOT NULL AND partition_date IN (SELECT partition_date FROM shown)) c
LEFT JOIN r_weather s ON s.partition_date = d.partition_date AND s.country_code = c.country_code GROUP BY 1, 2""")
add("pollutants_by_country", f"""
SELECT country_code, {', '.join(f'''{even(f"avg({c}) FILTER (source = '{s}')", 2)} AS {n}_{s}''' for n, c in (('pm2_5', 'mean_pm2_5'), ('o3', 'mean_o3')) for s in SOURCES)}
FROM r_summary WHERE country_code IS NOT NULL GROUP BY 1""")
CTE["exceed"] = f"""
SELECT country_code, {', '.join(f"{even(f'avg({f}_pct)', 1)} AS {f}_pct" for f in FLAGS)}
FROM r_summary WHERE country_code IS NOT NULL GROUP BY 1"""
add("who_exceed_by_country", "SELECT * FROM exceed")
add("top_exceedance", """
SELECT country_code, who_pm25_exceed_pct FROM exceed ORDER BY who_pm25_exceed_pct DESC NULLS LAST, country_code LIMIT 5""")
_LEVELS = ("low", "moderate", "high", "extreme")
add("risk_distribution", f"""
SELECT country_code, {', '.join(f"count(*) FILTER (risk_level = '{v}') AS {v}" for v in _LEVELS)},
  {', '.join(even(f"count(*) FILTER (risk_level = '{v}') / count(*) * 100", 4) + f' AS {v}_pct' for v in _LEVELS)}
FROM r_risk WHERE country_code IS NOT NULL GROUP BY 1""")
add("top_risk", """
SELECT partition_date, station_id, country_code, risk_index, risk_level FROM r_risk
ORDER BY risk_index DESC, partition_date, station_id LIMIT 10""")
add("source_share", f"""
SELECT country_code, {', '.join(f"CAST(coalesce(sum(station_count) FILTER (source = '{s}'), 0) AS BIGINT) AS {s}" for s in SOURCES)},
  {', '.join(even(f"coalesce(sum(station_count) FILTER (source = '{s}'), 0) / sum(station_count) * 100", 4) + f' AS {s}_pct' for s in SOURCES)}
FROM r_summary WHERE country_code IS NOT NULL AND partition_date IN (SELECT partition_date FROM ready) GROUP BY 1""")
add("latest_conditions", """
SELECT country_code, temp_max_c, temp_min_c, precipitation_mm, condition, wind_level, dust_level, heat_alert,
  heat_streak_days, cold_alert, cold_streak_days
FROM r_weather WHERE partition_date = (SELECT max(partition_date) FROM r_weather)""")


def leader(source: str, value: str, direction: str) -> str:
    return (f"(SELECT country_code FROM {source} WHERE country_code IS NOT NULL GROUP BY 1 "
            f"ORDER BY {value} {direction} NULLS LAST, country_code LIMIT 1)")


_NEWEST = "partition_date = (SELECT max(partition_date) FROM r_weather)"
add("report_kpis", f"""
SELECT (SELECT min(partition_date) FROM r_summary) AS first_date, (SELECT max(partition_date) FROM r_summary) AS last_date,
  (SELECT count(DISTINCT partition_date) FROM r_summary) AS dates,
  (SELECT count(DISTINCT country_code) FROM r_summary) AS countries,
  (SELECT string_agg(DISTINCT country_code, ', ' ORDER BY country_code) FROM r_summary) AS country_list,
  (SELECT string_agg(DISTINCT source, ', ' ORDER BY source) FROM r_summary) AS source_list,
  (SELECT count(*) FROM r_summary) AS summary_rows, (SELECT count(*) FROM r_risk) AS risk_rows,
  (SELECT count(DISTINCT station_id) FROM r_risk) AS stations, (SELECT count(*) FROM r_anomalies) AS anomaly_rows,
  (SELECT CAST(sum(is_anomaly) AS BIGINT) FROM r_anomalies) AS anomalies,
  (SELECT {even('avg(is_anomaly) * 100', 1)} FROM r_anomalies) AS anomaly_rate_pct,
  (SELECT count(*) FROM r_weather) AS weather_rows,
  (SELECT count(*) FROM r_weather WHERE heat_alert IN ('heatwave', 'extreme_heatwave')) AS heatwave_country_days,
  (SELECT count(*) FROM r_weather WHERE cold_alert IN ('cold_wave', 'severe_cold_wave')) AS cold_wave_country_days,
  (SELECT count(*) FROM r_weather WHERE heat_alert <> 'none' AND {_NEWEST}) AS under_heat_alert,
  (SELECT count(*) FROM r_weather WHERE cold_alert <> 'none' AND {_NEWEST}) AS under_cold_alert,
  {leader('r_risk', even('avg(risk_index)', 4), 'DESC')} AS highest_risk_country,
  {leader('r_weather', 'max(temp_max_c)', 'DESC')} AS hottest_country,
  {leader('r_weather', 'min(temp_min_c)', 'ASC')} AS coldest_country,
  {leader('r_summary', even('avg(who_pm25_exceed_pct)', 4), 'DESC')} AS highest_exceedance_country,
  (SELECT season FROM focus_now) AS season, (SELECT focus FROM focus_now) AS focus""")

_RECORD = ", ".join([
    json_field("partition_date", "date", True), json_field(even("temp_max_c", 1), "high_c", False),
    json_field(even("temp_min_c", 1), "low_c", False), json_field(even("precipitation_mm", 1), "rain_mm", False),
    json_field(even("dust", 1), "dust", False), json_field("heat_alert", "heat_alert", True),
    json_field("cold_alert", "cold_alert", True)])


def last(c: str) -> str:
    return f"max({c}) FILTER (recency = 1)"


_LED = {"heat": ("temp_max_c", "highest", 1, "C"), "cold": ("temp_min_c", "lowest", 1, "C"),
        "rain": ("precipitation_mm", "highest", 10, "mm"), "dust": ("dust", "highest", 1, "ug/m3")}
add("spotlight", " UNION ALL ".join(f"""
SELECT country_code, '2024-01-29' AS date, season, focus, '{c}' AS measured, '{end}' AS leader, CAST({k} AS INT) AS rank_days, '{unit}' AS unit,
  {even('v', 1)} AS value
FROM (SELECT country_code, avg({c}) AS v, max(partition_date) AS day FROM r_weather WHERE country_code IS NOT NULL AND partition_date IN (
    SELECT DISTINCT partition_date FROM r_weather WHERE partition_date <= '2024-01-29' ORDER BY partition_date DESC LIMIT {k})
  GROUP BY 1 HAVING avg({c}) IS NOT NULL ORDER BY v {'ASC' if end == 'lowest' else 'DESC'}, country_code LIMIT 1),
  (SELECT season, focus FROM focus_days WHERE partition_date = '2024-01-29') WHERE focus = '{n}'"""
    for n, (c, end, k, unit) in _LED.items()))

add("weather_profile", f"""
SELECT country_code, max(partition_date) AS date, count(*) AS days_of_history,
  {even(last('temp_max_c'), 1)} AS high_c, {even(last('temp_min_c'), 1)} AS low_c,
  {even(f"{last('temp_max_c')} - {last('temp_min_c')}", 1)} AS day_night_range_c,
  {last('heat_alert')} AS heat_alert, coalesce({last('heat_streak_days')}, 0) AS heat_streak_days,
  {last('cold_alert')} AS cold_alert, coalesce({last('cold_streak_days')}, 0) AS cold_streak_days,
  {last('condition')} AS condition,
  {even('max(temp_max_c)', 1)} AS window_highest_c, {even('min(temp_min_c)', 1)} AS window_lowest_c,
  {even('max(temp_max_c) - min(temp_max_c)', 1)} AS window_high_spread_c,
  bool_or(coalesce(heat_alert <> 'none', false)) AND bool_or(coalesce(cold_alert <> 'none', false)) AS swung_between_heat_and_cold,
  {even(last('precipitation_mm'), 1)} AS rain_today_mm, {even('coalesce(sum(precipitation_mm), 0)', 1)} AS window_rain_total_mm,
  {even('max(precipitation_mm)', 1)} AS window_wettest_day_mm, {even(last('dust'), 1)} AS dust_today,
  {even('max(dust)', 1)} AS window_dust_peak,
  {even('max(step) FILTER (sharpest = 1 AND step IS NOT NULL)', 1)} AS biggest_day_to_day_change_c,
  max(partition_date) FILTER (sharpest = 1 AND step IS NOT NULL) AS biggest_change_on,
  '[' || string_agg('{{' || concat_ws(',', {_RECORD}) || '}}', ',' ORDER BY partition_date) || ']' AS days
FROM (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY abs(step) DESC NULLS LAST, partition_date) AS sharpest
  FROM (SELECT *, temp_max_c - lag(temp_max_c) OVER (PARTITION BY country_code ORDER BY partition_date) AS step
    FROM (SELECT *, row_number() OVER (PARTITION BY country_code ORDER BY partition_date DESC) AS recency
      FROM r_weather WHERE partition_date <= '2024-01-29' AND country_code IS NOT NULL) WHERE recency <= 10))
GROUP BY country_code""")

# --- season --------------------------------------------------------------------------------
add("season_of", f"""
SELECT {_SEASON.format(d='o_orderdate')} AS season, CAST(month(o_orderdate) AS INT) AS month, count(*) AS orders
FROM orders GROUP BY 1, 2""")
add("season_focus", "SELECT * FROM focus_days")
_EVENTS = {"heat": "heat_alert IN ('heatwave', 'extreme_heatwave')", "cold": "cold_alert IN ('cold_wave', 'severe_cold_wave')",
           "rain": "precipitation_mm >= 10", "dust": "dust_level IN ('high', 'severe')"}
add("season_event_days", " UNION ALL ".join(
    f"SELECT country_code, count(*) AS event_days, '{n}' AS focus FROM r_weather WHERE {test} AND country_code IS NOT NULL GROUP BY 1"
    for n, test in _EVENTS.items()))
_RANKED = {"heat": ("temp_max_c", 1), "cold": ("temp_min_c", 1), "rain": ("precipitation_mm", 10), "dust": ("dust", 1)}
add("rank_countries", " UNION ALL ".join(f"""
SELECT '{n}' AS focus, country_code, {even(f'avg({c})', 6)} AS value FROM r_weather
WHERE country_code IS NOT NULL AND partition_date IN (SELECT DISTINCT partition_date FROM r_weather
  WHERE partition_date <= '2024-01-28' ORDER BY partition_date DESC LIMIT {k})
GROUP BY 2 HAVING avg({c}) IS NOT NULL""" for n, (c, k) in _RANKED.items()))


# --- quality -------------------------------------------------------------------------------
class Suite:
    """One SELECT per check over a one-row frame of measures."""

    def __init__(self, source: str, layer: str, table: str, where: str = "true"):
        self.source, self.layer, self.table, self.where = source, layer, table, where
        self.measures, self.rows = ["count(*) AS n"], []

    def row(self, name: str, passed: str, severity: str, detail: str) -> None:
        self.rows.append((name, passed, severity, detail))

    def measure(self, name: str, condition: str) -> str:
        self.measures.append(f"count(*) FILTER ({condition}) AS {name}")
        return name

    def row_count(self) -> None:
        self.row("row_count_non_zero", "n >= 1", "'fail'", "n || ' rows (min 1)'")

    def columns(self, names, absent=()) -> None:
        for c in names:
            there = c not in absent
            self.row(f"column_exists_{c}", str(there).lower(), "'fail'", "'present'" if there else "'MISSING'")

    def nulls(self, c: str, warn: float, fail: float, hard: bool = True) -> None:
        rate = f"({self.measure(f'null_{c}', f'{c} IS NULL')} / n)"
        policy = "" if hard else "; non-blocking optional source"
        self.row(f"null_rate_{c}", f"{rate} < {warn}",
                 f"CASE WHEN {rate} >= {fail} THEN '{'fail' if hard else 'warn'}' ELSE 'warn' END",
                 f"{percent(rate)} || CASE WHEN {rate} >= {fail} THEN ' nulls (threshold {fail:.0%}{policy})' "
                 f"WHEN {rate} >= {warn} THEN ' nulls (warn threshold {warn:.0%})' ELSE ' nulls — OK' END")

    def range(self, c: str, low, high) -> None:
        valued = self.measure(f"valued_{c}", f"{c} IS NOT NULL")
        inside = self.measure(f"inside_{c}", f"{c} >= {low}" + (f" AND {c} <= {high}" if high is not None else ""))
        share = f"({inside} / nullif({valued}, 0))"
        self.row(f"range_{c}", f"coalesce({share} >= 0.99, true)", "'warn'",
                 f"coalesce({percent(share)} || ' in [{low}, {high}] (required 99%)', 'no non-null values to check')")

    def values(self, c: str, allowed) -> None:
        bad = self.measure(f"bad_{c}", f"{c} NOT IN {texts(allowed)}")
        self.row(f"valid_values_{c}", f"{bad} = 0", "'warn'",
                 f"CASE WHEN {bad} = 0 THEN 'all valid' ELSE {bad} || ' invalid values' END")

    def floor(self) -> None:
        low = self.measure("low_completeness", "data_completeness < 0.2")
        self.row("data_completeness_floor", f"{low} = 0", "'warn'", f"{low} || ' rows below 20% completeness'")

    def sql(self, absent_severity: str = "fail", target: str = "configured lookback window") -> str:
        body = " UNION ALL ".join(
            f"SELECT '{name}' AS check_name, '{self.layer}' AS layer, '{self.table}' AS \"table\", {passed} AS passed, "
            f"{severity} AS severity, {detail} AS detail FROM m WHERE n > 0"
            for name, passed, severity, detail in self.rows)
        absent = (f"SELECT 'data_present', '{self.layer}', '{self.table}', false, '{absent_severity}', "
                  f"'no data found for {target}' FROM m WHERE n = 0")
        return (f"SELECT * FROM (WITH m AS (SELECT {', '.join(self.measures)} FROM {self.source} WHERE {self.where}) "
                f"{body} UNION ALL {absent})")


def bronze_suite(source: str, where: str = "true", target: str = "configured lookback window") -> str:
    s = Suite("bronze_air", "bronze", f"bronze/{source}/air_quality", f"source = '{source}' AND {where}")
    s.row_count()
    s.columns(("station_id", "latitude", "longitude", "date", "partition_date", "source"))
    for c in POLLUTANTS:
        s.nulls(c, 0.4, 0.8, source == "openmeteo")
        s.range(c, 0, None)
    s.values("source", SOURCES)
    return s.sql("fail" if source == "openmeteo" else "warn", target)


def silver_suite(frame: str, absent=(), where: str = "true", target: str = "configured lookback window") -> str:
    s = Suite(frame, "silver", "silver/air_quality", where)
    s.row_count()
    s.columns(("station_id", "country_code", "latitude", "longitude", "date", *POLLUTANTS, "aqi_category",
               "who_pm25_exceed", "data_completeness", "source", "silver_ts", "partition_date"), absent)
    for c in POLLUTANTS:
        s.nulls(c, 0.3, 0.7)
        s.range(c, 0, None)
    s.values("aqi_category", AQI)
    s.values("source", SOURCES)
    s.floor()
    return s.sql("fail", target)


def weather_suite(frame: str, layer: str, table: str, where: str = "true", target: str = "configured lookback window") -> str:
    s = Suite(frame, layer, table, where)
    s.row_count()
    s.columns(("station_id", "country_code", "date", "partition_date", "temp_max_c", "temp_min_c", "temp_mean_c"))
    for c in ("temp_max_c", "temp_min_c", "temp_mean_c"):
        s.nulls(c, 0.1, 0.3)
        s.range(c, -60, 60)
    for c, (low, high) in {"precipitation_mm": (0, 1000), "wind_gust_max_kmh": (0, 500), "humidity_pct": (0, 100),
                           "dust": (0, 10000)}.items():
        s.range(c, low, high)
    if layer == "silver":
        s.values("condition", CONDITIONS)
    return s.sql("fail", target)


CTE["faulty_silver"] = """
SELECT * REPLACE (CASE WHEN pm2_5 > 400 THEN 'handheld' ELSE source END AS source,
  CASE WHEN ozone > 200 THEN 'foul' ELSE aqi_category END AS aqi_category,
  CASE WHEN pm10 > 150 THEN 0.1e0 ELSE data_completeness END AS data_completeness,
  CASE WHEN pm10 > 200 THEN 2 ELSE who_no2_exceed END AS who_no2_exceed,
  CASE WHEN pm10 < 2 THEN -pm10 ELSE pm10 END AS pm10) FROM air"""
CTE["faulty_weather"] = "SELECT * REPLACE (CASE WHEN dust > 100 THEN 'sandstorm' ELSE condition END AS condition) FROM weather"
_BRONZE_WX = "bronze/openmeteo_weather/weather"
_QB = " UNION ALL ".join(bronze_suite(s) for s in SOURCES)
_QS = silver_suite("faulty_silver", absent=("silver_ts",))
_QW = weather_suite("bronze_weather", "bronze", _BRONZE_WX) + " UNION ALL " + weather_suite("faulty_weather", "silver", "silver/weather")
add("quality_bronze", _QB)
add("quality_silver", _QS)
add("quality_weather", _QW)
add("quality_summary", f"""
SELECT layer, severity, passed, count(*) AS checks FROM ({_QB} UNION ALL {_QS} UNION ALL {_QW}) GROUP BY 1, 2, 3""")
_TWO, _TARGET = "partition_date IN ('2024-01-29', '2024-01-30')", "target partition(s): 2024-01-29, 2024-01-30"
add("quality_checks", " UNION ALL ".join([
    bronze_suite("openmeteo", _TWO, _TARGET), bronze_suite("openaq", _TWO, _TARGET),
    bronze_suite("waqi", "partition_date IN ('2023-12-01')", _TARGET), silver_suite("air", where=_TWO, target=_TARGET),
    weather_suite("bronze_weather", "bronze", _BRONZE_WX, _TWO, _TARGET),
    weather_suite("weather", "silver", "silver/weather", _TWO, _TARGET)]))

# --- audits --------------------------------------------------------------------------------
CTE["faulty_stg"] = f"""
SELECT *, CAST(date AS DATE) AS observation_date, silver_ts AS _loaded_at FROM faulty_silver"""


def audits(kind: str, tests: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'stg_air_quality' AS \"table\", '{kind}' AS audit, '{c}' AS \"column\", count(*) FILTER ({t}) AS violations FROM faulty_stg"
        for c, t in tests.items())


add("audit_not_null", audits("not_null", {c: f"{c} IS NULL" for c in (
    "station_id", "country_code", "observation_date", "latitude", "longitude", "aqi_category", "data_completeness",
    "source", "partition_date", "_loaded_at")}))
add("audit_accepted_values", audits("accepted_values", {
    "aqi_category": f"aqi_category NOT IN {texts(AQI)}", **{f: f"{f} NOT IN (0, 1)" for f in FLAGS},
    "source": f"source NOT IN {texts(SOURCES)}"}))
add("audit_accepted_range", audits("accepted_range", {
    "latitude": "latitude < -90 OR latitude > 90", "longitude": "longitude < -180 OR longitude > 180",
    **{c: f"{c} < 0 OR {c} > {m}" for c, m in MAXIMA.items()},
    "data_completeness": "data_completeness < 0 OR data_completeness > 1"}))
add("audit_unique", " UNION ALL ".join(
    f"SELECT 'readings' AS \"table\", 'unique' AS audit, '{k}' AS \"column\", count(*) AS violations FROM "
    f"(SELECT {k} FROM readings GROUP BY {k} HAVING count(*) > 1)" for k in ("user_id,date,parameter", "user_id,ts")))


def mart_audit(mart: str, filled: str, ranges: dict[str, tuple], values: dict[str, str], unique: str = "") -> None:
    """Every audit of a mart over faulty staging rows; the time stamp is missing on every third day of a month."""
    rows = re.sub(r"\bstg\b", "faulty_stg", BODY[mart])
    tests = [("not_null", c, f"{c} IS NULL") for c in filled.split()]
    tests.append(("not_null", "mart_ts", "day(observation_date) % 3 = 0"))
    tests += [("accepted_values", c, f"{c} NOT IN {v}") for c, v in values.items()]
    tests += [("accepted_range", c, f"{c} < {lo}" + (f" OR {c} > {hi}" if hi is not None else "")) for c, (lo, hi) in ranges.items()]
    parts = [f"SELECT '{mart}' AS \"table\", '{k}' AS audit, '{c}' AS \"column\", count(*) FILTER ({t}) AS violations FROM mart" for k, c, t in tests]
    if unique:
        parts.append(f"SELECT '{mart}', 'unique', '{unique}', count(*) FROM (SELECT {unique} FROM mart GROUP BY {unique} HAVING count(*) > 1)")
    add(f"audit_{mart}", f"SELECT * FROM (WITH mart AS ({rows}) {' UNION ALL '.join(parts)})")


_PCT = {f"{f}_pct": (0, 100) for f in FLAGS}
_SRC = {"source": texts(SOURCES)}
mart_audit("mart_daily_air_quality", "observation_date country_code source dominant_aqi_tier station_count mean_data_completeness",
           {"station_count": (1, None), "daily_mean_pm2_5": (0, 1000), "daily_max_pm2_5": (0, 1000), "daily_mean_pm10": (0, 2000),
            "daily_mean_nitrogen_dioxide": (0, 500), "daily_mean_ozone": (0, 500), **_PCT, "mean_data_completeness": (0, 1)},
           {**_SRC, "dominant_aqi_tier": texts(AQI)}, "observation_date,country_code,source,dominant_aqi_tier")
mart_audit("mart_city_weekly_trend", "observation_date country_code city_name source station_count",
           {"station_count": (1, None), "rolling_7d_pm2_5": (0, 1000), "rolling_7d_ozone": (0, 500)}, _SRC)
mart_audit("mart_source_coverage", "observation_date country_code source station_count mean_data_completeness",
           {"station_count": (1, None), "mean_data_completeness": (0, 1), "pm2_5_available_pct": (0, 100)}, _SRC)
mart_audit("mart_who_exceedance_streak", "observation_date station_id country_code source current_exceedance_streak_days",
           {"current_exceedance_streak_days": (0, None)}, {**_SRC, "has_who_exceedance": "(0, 1)"})

# --- contracts -----------------------------------------------------------------------------
def contract(table: str, frame: str, fields, rules=()) -> str:
    """fields: (name, low, high, values, present)."""
    checks = [(f"Check that model {table} has row_count > 0", f"'Actual row_count({table}) was ' || n || ', expected > 0'", "n > 0")]
    measures = ["count(*) AS n"]

    def counted(name: str, condition: str, measure: str) -> None:
        m = f"m{len(measures)}"
        measures.append(f"count(*) FILTER ({condition}) AS {m}")
        checks.append((name, f"'Actual {measure} was ' || {m} || ', expected = 0'", f"{m} = 0"))

    for name, low, high, values, present in fields:
        missing = "''" if present else f"'Required column ''{name}'' is missing'"
        checks.append((f"Check that field ''{name}'' is present", missing, str(present).lower()))
        if not present:
            continue
        measure = f"invalid_count({name})"
        if low is not None:
            counted(f"Check that field {name} has a minimum of {low}", f"{name} < {low}", measure)
        if high is not None:
            counted(f"Check that field {name} has a maximum of {high}", f"{name} > {high}", measure)
        if values:
            listed = texts(values) if isinstance(values[0], str) else f"({', '.join(map(str, values))})"
            counted(f"Check that field {name} has invalid_count = 0", f"{name} NOT IN {listed}", measure)
    for description, condition in rules:
        counted(description, condition, f"custom_sql({table})")
    body = " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{n}' AS check_name, {r} AS reason, {p} AS passed FROM m" for n, r, p in checks)
    return f"SELECT * FROM (WITH m AS (SELECT {', '.join(measures)} FROM {frame}) {body})"


def plain(*names: str, absent=()) -> list:
    return [(n, None, None, None, n not in absent) for n in names]


CTE["faulty_summary"] = "SELECT * REPLACE (CASE WHEN country_code = 'TN' THEN -mean_pm2_5 ELSE mean_pm2_5 END AS mean_pm2_5) FROM summary"
CTE["faulty_risk"] = "SELECT * REPLACE (risk_index * 2 AS risk_index, CASE WHEN pm2_5 IS NULL THEN 'unset' ELSE risk_level END AS risk_level) FROM risk"
CTE["faulty_country_weather"] = """
SELECT * REPLACE (CASE WHEN wind_level = 'storm' THEN temp_min_c - 70 ELSE temp_max_c END AS temp_max_c,
  CASE WHEN dust > 150 THEN 'scorching' ELSE heat_alert END AS heat_alert, heat_streak_days - 1 AS heat_streak_days)
FROM country_weather"""
CTE["faulty_flagged"] = """
SELECT * REPLACE (CASE WHEN ozone > 100 THEN 'waqi' ELSE source END AS source,
  CASE WHEN pm2_5 > 300 THEN 2 ELSE is_anomaly END AS is_anomaly) FROM flagged"""
add("contract_checks", " UNION ALL ".join([
    contract("daily_country_summary", "faulty_summary", [
        *plain("partition_date", "country_code", "source"), ("mean_pm2_5", 0, None, None, True),
        *plain("max_pm2_5", "mean_pm10", "mean_no2", "mean_o3", "station_count", absent=("mean_o3",)),
        *[(f"{f}_pct", 0, 100, None, True) for f in FLAGS]]),
    contract("wildfire_risk_index", "faulty_risk", [
        *plain("partition_date", "source", "station_id"), ("risk_index", 0, 100, None, True),
        ("risk_level", None, None, _LEVELS, True)]),
    contract("daily_country_weather", "faulty_country_weather", [
        *plain("partition_date", "country_code", "stations"), ("temp_max_c", -60, 60, None, True),
        ("temp_mean_c", -60, 60, None, True), ("temp_min_c", -60, 60, None, True),
        *plain("condition", "wind_level", "dust_level"),
        ("heat_alert", None, None, ("none", "heat_advisory", "heatwave", "extreme_heatwave"), True),
        ("heat_streak_days", 0, None, None, True),
        ("cold_alert", None, None, ("none", "cold_advisory", "cold_wave", "severe_cold_wave"), True),
        ("cold_streak_days", 0, None, None, True)],
        rules=(("The low never sits above the high.", "temp_max_c < temp_min_c"),)),
    contract("anomaly_alerts", "faulty_flagged", [
        *plain("partition_date"), ("source", None, None, ("openmeteo", "openaq"), True),
        *plain("station_id", "anomaly_score"), ("is_anomaly", None, None, (0, 1), True)]),
]))
add("contract_missing_partitions", """
SELECT DISTINCT CAST(CAST(d AS DATE) AS VARCHAR) AS partition_date
FROM (SELECT ts AS d FROM events UNION ALL SELECT CAST(ts AS DATE) - 3 FROM events)
WHERE CAST(CAST(d AS DATE) AS VARCHAR) NOT IN (SELECT partition_date FROM summary)""")

# --- monitoring ----------------------------------------------------------------------------
add("run_metrics", """
SELECT 'bronze' AS stage, partition_date, count(*) AS rows FROM bronze_air GROUP BY 2
UNION ALL SELECT 'silver', partition_date, count(*) FROM air GROUP BY 2
UNION ALL SELECT 'gold', partition_date, count(*) FROM summary GROUP BY 2""")
_RUNS = f"""
SELECT stage, run_ts, rows, duration_seconds, quality_failures, last_value(rows) OVER (PARTITION BY stage ORDER BY run_ts
    RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS previous,
  row_number() OVER (PARTITION BY stage ORDER BY run_ts DESC) AS recency,
  epoch(TIMESTAMP '2024-02-01 02:00:00') - epoch(run_ts) AS age
FROM (SELECT CASE event_type WHEN 'view' THEN 'bronze_openmeteo' WHEN 'click' THEN 'bronze_openaq'
    WHEN 'purchase' THEN 'silver' WHEN 'signup' THEN 'gold' ELSE 'quality' END AS stage,
    date_trunc('second', max(ts)) AS run_ts, count(*) FILTER (value > 100) AS rows,
    {even('sum(value)', 2)} AS duration_seconds, count(*) FILTER (value < 0.5) AS quality_failures
  FROM events GROUP BY 1, CAST(ts AS DATE))"""
add("run_alerts", f"""
SELECT stage, string_split(stage, '_')[1] AS layer, alert, severity, CAST(value AS DOUBLE) AS value FROM (
  SELECT stage, 'run_stale' AS alert, 'warning' AS severity, age AS value FROM ({_RUNS}) WHERE recency = 1
    AND age > CASE stage WHEN 'bronze_openmeteo' THEN 90000 WHEN 'silver' THEN 93600 WHEN 'gold' THEN 97200 WHEN 'quality' THEN 93600 END
  UNION ALL SELECT stage, 'row_count_drop', 'warning', rows FROM ({_RUNS}) WHERE recency = 1 AND stage = 'bronze_openmeteo' AND rows < previous * 0.5
  UNION ALL SELECT stage, 'no_rows', 'warning', rows FROM ({_RUNS}) WHERE recency = 1 AND stage = 'bronze_openaq' AND rows < 1
  UNION ALL SELECT stage, 'quality_failed', 'pipeline', quality_failures FROM ({_RUNS}) WHERE recency = 1 AND quality_failures > 0
  UNION ALL SELECT stage, 'run_slow', 'warning', duration_seconds FROM ({_RUNS}) WHERE recency = 1
    AND duration_seconds > CASE WHEN stage LIKE 'bronze%' THEN 1800 WHEN stage = 'silver' THEN 3600 END)""")

_LOG = f"""
SELECT stage, epoch(run_ts)::BIGINT AS t, lead(epoch(run_ts)::BIGINT) OVER (PARTITION BY stage ORDER BY run_ts) AS u,
  rows, duration_seconds AS took, quality_failures AS failed FROM ({_RUNS})"""
_HELD = f"""
WITH log AS ({_LOG}), changes AS (
  SELECT stage, t, max(now) AS now, max(earlier) AS earlier FROM (
    SELECT stage, t, rows AS now, NULL AS earlier FROM log WHERE stage = 'bronze_openmeteo'
    UNION ALL SELECT stage, t + 86400, NULL, rows FROM log WHERE stage = 'bronze_openmeteo') GROUP BY 1, 2
), filled AS (
  SELECT stage, t, lead(t) OVER w AS u, last_value(now IGNORE NULLS) OVER w AS now, last_value(earlier IGNORE NULLS) OVER w AS earlier
  FROM changes WINDOW w AS (PARTITION BY stage ORDER BY t)
), held AS (
  SELECT 'run_stale' AS alert, 300 AS hold, stage, t + lim AS b, u FROM log JOIN (VALUES ('bronze_openmeteo', 90000), ('silver', 93600),
    ('gold', 97200), ('quality', 93600)) AS l(stage, lim) USING (stage) WHERE u IS NULL OR t + lim < u
  UNION ALL SELECT 'row_count_drop', 600, stage, t, u FROM filled WHERE now < earlier * 0.5
  UNION ALL SELECT 'no_rows', 60, stage, t, u FROM log WHERE stage = 'bronze_openaq' AND rows < 1
  UNION ALL SELECT 'quality_failed', 60, stage, t, u FROM log WHERE failed > 0
  UNION ALL SELECT 'run_slow', 300, CASE WHEN stage LIKE 'bronze%' THEN 'bronze' ELSE stage END, t, u FROM log
    WHERE (stage LIKE 'bronze%' AND took > 1800) OR (stage = 'silver' AND took > 3600)
), flagged AS (
  SELECT *, coalesce(u, 9e15::BIGINT) AS e, coalesce(b > max(coalesce(u, 9e15::BIGINT)) OVER (PARTITION BY alert, stage ORDER BY b, u NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS fresh FROM held
), islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY alert, stage ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS k FROM flagged
), whole AS (SELECT alert, hold, stage, min(b) AS b, max(e) AS e, epoch(TIMESTAMP '2024-02-01 02:00:00')::BIGINT AS n FROM islands GROUP BY alert, hold, stage, k)
"""
_SHOWN = "strftime(make_timestamp(({}) * 1000000), '%Y-%m-%d %H:%M:%S')"
add("alert_intervals", f"""SELECT * FROM ({_HELD}
SELECT alert, CASE WHEN alert = 'quality_failed' THEN 'pipeline' ELSE 'warning' END AS severity, stage, {_SHOWN.format('b')} AS begin,
  {_SHOWN.format('b + hold')} AS fired, CASE WHEN e <= n THEN {_SHOWN.format('e')} END AS resolved
FROM whole WHERE b < n AND b + hold <= least(e, n))""")

add("quality_alerts", f"""
SELECT 'quality_failed' AS alert, 'pipeline' AS severity, check_name, layer, CAST(count(*) AS DOUBLE) AS value
FROM ({' UNION ALL '.join(f'SELECT check_name, layer, passed FROM ({ORACLE[k]})' for k in ('quality_bronze', 'quality_silver', 'quality_weather'))})
WHERE NOT passed GROUP BY check_name, layer""")

# --- streaming -----------------------------------------------------------------------------
_STREAM = {"pm2_5": "view", "pm10": "click", "nitrogen_dioxide": "purchase", "ozone": "signup"}
add("stream_daily_means", f"""
SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
  {', '.join(f'''{even(f"avg(value) FILTER (event_type = '{e}')", 4)} AS {p}''' for p, e in _STREAM.items())}
FROM events GROUP BY 1, 2""")
add("stream_late_readings", ORACLE["stream_daily_means"])
add("contract_documents", BODY["contract_checks"])
add("stream_heat_events", BODY["flag_heat_events"])
add("stream_exceedance_streak", f"""
SELECT CAST(observation_date AS VARCHAR) AS observation_date, station_id, station_name, country_code, source, current_exceedance_streak_days
FROM ({BODY["mart_who_exceedance_streak"]})""")
_TWICE = """SELECT * FROM weather UNION ALL SELECT * REPLACE (temp_max_c + 1 AS temp_max_c) FROM weather WHERE substr(station_id, 3, 1) = '7'
  UNION ALL SELECT * FROM weather WHERE partition_date = '2024-01-09'"""
add("repeated_station_days", f"""
SELECT station_id, partition_date, count(*) AS rows, count(DISTINCT temp_max_c) AS distinct_rows
FROM ({_TWICE}) GROUP BY 1, 2 HAVING count(*) > 1""")
