"""DuckDB text of the fixture mappings, used by the oracle queries.

These mirror ``airshed.sources.driver_tables`` expression by expression
(same casts, same operation order) so the oracle sees identical inputs.
"""

def m1(name: str = "m1", source: str = "events") -> str:
    """FIXTURES M1 measurements over ``source`` as a CTE named ``name``."""
    return f"""
{name}_raw AS (
  SELECT event_id, user_id, event_type, value,
         CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10'
              WHEN 'purchase' THEN 'no2' WHEN 'signup' THEN 'so2' WHEN 'error' THEN 'co' END AS parameter,
         CAST(ts + to_days(CAST(30 * (event_id % 12) AS INTEGER)) AS TIMESTAMP) AS datetime_utc
  FROM {source}
),
{name} AS (
  SELECT CAST(user_id AS BIGINT) AS location_id,
         CAST(user_id * 10 AS BIGINT) AS sensor_id,
         parameter,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -value ELSE value END AS value,
         CASE WHEN parameter = 'co' THEN 'mg/m³' ELSE 'µg/m³' END AS unit,
         datetime_utc,
         datetime_utc + INTERVAL 330 MINUTE AS datetime_local,
         CASE WHEN event_id % 31 = 0 THEN NULL
              ELSE CAST(28.0 AS DOUBLE) + CAST(user_id % 64 AS DOUBLE) / CAST(64.0 AS DOUBLE) END AS latitude,
         CASE WHEN event_id % 31 = 0 THEN NULL
              ELSE CAST(77.0 AS DOUBLE) + CAST(user_id % 32 AS DOUBLE) / CAST(32.0 AS DOUBLE) END AS longitude,
         '2024-12-31T00:00:00+00:00' AS ingested_at
  FROM {name}_raw
)"""


M1 = m1()

# The fixed tables of the models, joined by key or range.
LIMITS = """
limits(parameter, top) AS (VALUES ('pm25', 999e0), ('pm10', 999e0), ('no2', 2000e0), ('so2', 2000e0), ('co', 50e0), ('o3', 600e0)),
seasons(season, months) AS (VALUES ('winter', [12, 1, 2]), ('summer', [3, 4, 5]), ('monsoon', [6, 7, 8, 9]), ('post_monsoon', [10, 11]))"""

STAGING = LIMITS + """,
stg AS (
  SELECT m.location_id, m.sensor_id, m.parameter, m.value, m.unit, m.datetime_utc, m.datetime_local, m.latitude, m.longitude, m.ingested_at,
         m.value BETWEEN 0 AND coalesce(l.top, m.value) AS is_valid, CAST(date_part('hour', m.datetime_local) AS INTEGER) AS hour_local,
         CAST(date_part('isodow', m.datetime_local) % 7 AS INTEGER) AS day_of_week, CAST(date_part('month', m.datetime_local) AS INTEGER) AS month,
         s.season
  FROM m1 m LEFT JOIN limits l USING (parameter) JOIN seasons s ON list_contains(s.months, date_part('month', m.datetime_local))
  WHERE m.value IS NOT NULL
)"""

POLLUTANTS = ["pm25", "pm10", "no2", "so2", "co", "o3"]
PIVOT = f"""
pivoted AS (
  SELECT location_id, time_bucket(INTERVAL 1 HOUR, datetime_utc) AS hour_utc, hour_local, day_of_week, month, season, latitude, longitude,
         {", ".join(f"avg(value) FILTER (parameter = '{p}') AS {p}" for p in POLLUTANTS)}, count(value) AS measurement_count
  FROM stg WHERE is_valid GROUP BY ALL
)"""

#: Sub-index segments: concentration above x0 up to x1, index a0 to a1, category.
SEGMENTS = """(VALUES (0e0, 30e0, 0e0, 50e0, 'Good'), (30e0, 60e0, 50e0, 100e0, 'Satisfactory'), (60e0, 90e0, 100e0, 200e0, 'Moderate'),
  (90e0, 120e0, 200e0, 300e0, 'Poor'), (120e0, 250e0, 300e0, 400e0, 'Very Poor')) AS seg(x0, x1, a0, a1, category)"""
#: The segment of a concentration: up to x1 and above x0; the first also holds what is below it.
_IN_SEGMENT = "{x} <= x1 AND ({x} > x0 OR x0 = 0)"
AQI_PM25 = ("CASE WHEN {x} IS NOT NULL THEN coalesce((SELECT round(a0 + ({x} - x0) / (x1 - x0) * (a1 - a0)) FROM " + SEGMENTS
            + " WHERE " + _IN_SEGMENT + "), 400e0) END")
CATEGORY_PM25 = "coalesce((SELECT category FROM " + SEGMENTS + " WHERE " + _IN_SEGMENT + "), 'Severe')"

MART = """
mart AS (
  SELECT *, """ + AQI_PM25.format(x="pm25") + """ AS aqi_pm25, """ + CATEGORY_PM25.format(x="pm25") + """ AS aqi_category
  FROM pivoted
)"""

WITH_M1 = "WITH " + M1
WITH_STG = "WITH " + ",".join([M1, STAGING])
MART_CHAIN = "WITH " + ",".join([M1, STAGING, PIVOT, MART])

# Hourly feeds (M2): every third user is series 0, the others 50 users each; a month apart.
SERIES_EVENTS = """(SELECT *, CAST(CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id // 50 + 1 END AS BIGINT) AS series_id FROM events)"""
FEED_HOUR = "CAST(date_trunc('hour', ts + to_days(CAST(30 * (series_id % 12) AS INTEGER))) AS TIMESTAMP)"

AIR = f"""
air AS (
  SELECT {FEED_HOUR} AS datetime, series_id,
         avg(CASE WHEN event_type = 'click' THEN value END) AS pm2_5,
         avg(CASE WHEN event_type = 'view' THEN value END) AS pm10,
         avg(CASE WHEN event_type = 'purchase' THEN value END) AS nitrogen_dioxide
  FROM {SERIES_EVENTS} WHERE event_type IN ('click', 'view', 'purchase')
  GROUP BY 1, 2
)"""

WEATHER = f"""
weather AS (
  SELECT {FEED_HOUR} AS datetime, series_id,
         avg(CASE WHEN event_type = 'signup' THEN value END) AS temperature_2m,
         avg(CASE WHEN event_type = 'error' THEN value END) AS wind_speed_10m,
         avg(value) AS boundary_layer_height
  FROM {SERIES_EVENTS} WHERE event_type IN ('signup', 'error')
  GROUP BY 1, 2
)"""

# ---- hourly series (M2) in DuckDB, whole-series windows -----------------------

MERGED_INNER = """
merged AS (
  SELECT a.series_id, a.datetime, a.pm2_5 AS pm2p5, a.pm10, a.nitrogen_dioxide AS no2,
         w.temperature_2m AS temp_c, w.wind_speed_10m AS vent_kmh, w.boundary_layer_height AS blh_m
  FROM air a JOIN weather w ON a.datetime = w.datetime AND a.series_id = w.series_id
)"""

MERGED_FULL = """
merged_full AS (
  SELECT coalesce(a.series_id, w.series_id) AS series_id, coalesce(a.datetime, w.datetime) AS datetime, a.pm2_5, a.pm10, a.nitrogen_dioxide AS no2,
         w.temperature_2m AS temp_c, w.wind_speed_10m AS vent_kmh, w.boundary_layer_height AS blh_m
  FROM air a FULL OUTER JOIN weather w ON a.datetime = w.datetime AND a.series_id = w.series_id
)"""

INTERP_COLS = ["pm10", "no2", "temp_c", "vent_kmh", "blh_m"]


def interp_sql(src: str, name: str, cols=None, limit: int = 3) -> str:
    """CTEs ``{name}`` = pandas-style linear interpolation (limit) by position of ``src``."""
    cols = cols or INTERP_COLS
    back = "OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    parts = []
    for c in cols:
        parts.append(f"max(CASE WHEN {c} IS NOT NULL THEN pos END) {back} AS {c}_pp, "
                     f"last_value({c} IGNORE NULLS) {back} AS {c}_pv, "
                     f"min(CASE WHEN {c} IS NOT NULL THEN pos END) {ahead} AS {c}_np, "
                     f"first_value({c} IGNORE NULLS) {ahead} AS {c}_nv")
    outs = []
    for c in cols:
        outs.append(f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pp IS NULL THEN NULL "
                    f"WHEN pos - {c}_pp > {limit} THEN NULL WHEN {c}_np IS NULL THEN {c}_pv "
                    f"ELSE ({c}_nv - {c}_pv) / CAST({c}_np - {c}_pp AS DOUBLE) * CAST(pos - {c}_pp AS DOUBLE)"
                    f" + {c}_pv END AS {c}")
    return f"""
{name}_pos AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS pos FROM {src}),
{name}_w AS (SELECT *, {", ".join(parts)} FROM {name}_pos),
{name} AS (SELECT series_id, datetime, pm2p5, {", ".join(outs)} FROM {name}_w)"""


CALENDAR = """CAST(hour(datetime) AS INTEGER) AS heure, CAST(isodow(datetime) - 1 AS INTEGER) AS jour_semaine,
         CAST(month(datetime) AS INTEGER) AS mois, CAST(isodow(datetime) >= 6 AS INTEGER) AS est_weekend"""


def lags_sql(target: str) -> str:
    return ", ".join(f"lag({target}, {k}) OVER (PARTITION BY series_id ORDER BY datetime) AS pm2p5_lag_{k}h" for k in (1, 2, 24))


def rolling_sql(target: str, digits: int | None = 9) -> str:
    out = []
    for n in (3, 24):
        f = f"OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        e = f"CASE WHEN count({target}) {f} = {n} THEN avg({target}) {f} END"
        out.append(f"{e if digits is None else f'round({e}, {digits})'} AS pm2p5_rolling_{n}h")
    return ", ".join(out)


def spark_round(x: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 17)), {digits}) AS DOUBLE)"


CLEAN = ("WITH " + ",".join([AIR, WEATHER, MERGED_INNER])
         + ",\nkept AS (SELECT * FROM merged WHERE pm2p5 IS NOT NULL)," + interp_sql("kept", "interp")
         + """,
clean AS (SELECT * FROM interp WHERE pm2p5 IS NOT NULL AND pm10 IS NOT NULL AND no2 IS NOT NULL
          AND temp_c IS NOT NULL AND vent_kmh IS NOT NULL AND blh_m IS NOT NULL)""")

def features_sql(digits: int | None = 9) -> str:
    return CLEAN + f""",
feat_all AS (SELECT *, {CALENDAR}, {lags_sql("pm2p5")}, {rolling_sql("pm2p5", digits)} FROM clean),
features AS (SELECT * FROM feat_all WHERE pm2p5_lag_24h IS NOT NULL AND pm2p5_lag_1h IS NOT NULL
             AND pm2p5_lag_2h IS NOT NULL AND pm2p5_rolling_3h IS NOT NULL AND pm2p5_rolling_24h IS NOT NULL)"""


FEATURES = features_sql(9)
FEATURES_RAW = features_sql(None)
