"""Queries exercising the scalar functions (H1-H32), the time spine (C3), the
forecast pairing (C4) and the model-free part of request scoring (H16-H19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_ml import requests
from airshed.catalog.q_series import ASOF, feeds
from airshed.functions import aqi as A
from airshed.functions import calendar as cal
from airshed.functions import misc as M
from airshed.operators import joins as J
from airshed.plans import ml as ML
from airshed.plans import nowcast as NC
from airshed.plans import quality as Q
from airshed.sources import driver_tables as D


def _case(pairs, other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"


_BAND_SQL = "CASE WHEN value IS NULL THEN NULL " + " ".join(
    f"WHEN value < {hi} THEN '{name}'" for hi, name in S.PM25_BANDS) + f" ELSE '{S.PM25_BAND_TOP}' END"
_CAT_AQI = _case([(f"{{x}} <= {hi}", f"'{name}'") for hi, name in S.AQI_CATEGORY_BOUNDS], f"'{S.SEVERE}'")

# DuckDB's ``round`` keeps the sign of a negative zero (-0.2 -> -0.0), Spark's gives 0.0;
# ``+ 0.0`` normalises it (negative readings reach the AQI formula in this query only).
_SCALAR_SQL = X.WITH_M1 + f""",
cal AS (
  SELECT *, CAST(extract(month FROM datetime_local) AS INTEGER) AS month,
         CAST(extract(hour FROM datetime_local) AS INTEGER) AS hour_local
  FROM m1
)
SELECT location_id, parameter, datetime_utc, value,
       CAST(date_trunc('hour', datetime_utc) AS TIMESTAMP) AS hour_utc,
       hour_local,
       CAST(extract(dow FROM datetime_local) AS INTEGER) AS dow_sunday0,
       CAST(isodow(datetime_local) - 1 AS INTEGER) AS dow_monday0,
       month,
       CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'summer'
            WHEN month IN (6, 7, 8, 9) THEN 'monsoon' ELSE 'post_monsoon' END AS season,
       CAST(isodow(datetime_local) >= 6 AS INTEGER) AS is_weekend,
       timezone('UTC', timezone('{S.LOCAL_ZONE}', datetime_local)) AS utc_from_local,
       timezone('{S.LOCAL_ZONE}', timezone('UTC', datetime_utc)) AS local_from_utc,
       strftime(datetime_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso_utc,
       CAST({X.AQI_PM25.format(x="value")} AS DOUBLE) + 0.0 AS aqi,
       {X.CATEGORY_PM25.format(x="value")} AS category_pm25,
       {_CAT_AQI.format(x=X.AQI_PM25.format(x="value"))} AS category_aqi,
       coalesce(value, CAST(0.0 AS DOUBLE)) AS value_or_zero,
       value > 15 AS exceeds_who,
       CASE WHEN value > 15 THEN '🔴 OMS!' ELSE '🟢 OK' END AS status,
       {_BAND_SQL} AS band,
       CASE WHEN parameter = 'co' THEN 'mg/m³' ELSE 'µg/m³' END AS unit,
       greatest(1, CAST(hour_local * 5 // 24 AS BIGINT) + 1) AS days_for_window
FROM cal"""


@register("h_scalar_functions", _SCALAR_SQL)
def h_scalar_functions(spark, sf_dir):
    """H1-H16, H18, H22-H24, H30, H32 over every measurement row (NULL and negative
    values included), the value column read as a PM2.5 concentration."""
    m = D.measurements(spark, sf_dir)
    local, v = F.col("datetime_local"), F.col("value")
    month, hour = cal.month_of(local), cal.hour_of(local)
    exceeds = A.exceeds_who(v)
    return m.select(
        "location_id", "parameter", "datetime_utc", "value",
        cal.floor_hour("datetime_utc").alias("hour_utc"),
        hour.alias("hour_local"),
        cal.dow_sunday0(local).alias("dow_sunday0"),
        cal.dow_monday0(local).alias("dow_monday0"),
        month.alias("month"),
        cal.season_of_month(month).alias("season"),
        cal.weekend_flag(cal.dow_monday0(local)).alias("is_weekend"),
        cal.local_to_utc(local).cast("timestamp_ntz").alias("utc_from_local"),
        cal.utc_to_local("datetime_utc").alias("local_from_utc"),
        cal.iso_text("datetime_utc", with_offset=True).alias("iso_utc"),
        A.aqi_from_pm25(v).alias("aqi"),
        A.category_from_pm25(v).alias("category_pm25"),
        A.category_from_aqi(A.aqi_from_pm25(v)).alias("category_aqi"),
        M.default_zero(v).alias("value_or_zero"),
        exceeds.alias("exceeds_who"),
        A.status_label(exceeds).alias("status"),
        A.pm25_band(v).alias("band"),
        A.unit_of("parameter").alias("unit"),
        cal.days_for_window(hour * 5).alias("days_for_window"),
    )


@register("c3_daily_completeness_spine", X.WITH_M1 + f""",
daily AS (
  SELECT location_id, parameter, CAST(date_trunc('day', datetime_utc) AS TIMESTAMP) AS day,
         count(*) AS n_rows, count(value) AS n_values, avg(value) AS mean
  FROM m1 GROUP BY 1, 2, 3
),
bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM daily),
spine AS (
  SELECT s.location_id, p.parameter, d.day
  FROM (SELECT DISTINCT location_id FROM m1) s,
       (SELECT unnest([{", ".join(f"'{p}'" for p in S.POLLUTANTS)}]) AS parameter) p,
       (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS day FROM bounds) d
)
SELECT spine.location_id, spine.parameter, CAST(spine.day AS TIMESTAMP) AS day,
       coalesce(n_rows, 0) AS n_rows, coalesce(n_values, 0) AS n_values, round(mean, 9) AS mean
FROM spine LEFT JOIN daily
  ON spine.location_id = daily.location_id AND spine.parameter = daily.parameter AND spine.day = daily.day""")
def c3_daily_completeness_spine(spark, sf_dir):
    """C3 + D3: readings per station, parameter and day on the full spine (zeros kept)."""
    return Q.daily_completeness(D.measurements(spark, sf_dir))


@register("c4_pair_first_forecast", "WITH " + X.AIR + f""",
last48 AS (SELECT * FROM (SELECT * FROM air WHERE datetime <= TIMESTAMP '{ASOF}')
           QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) <= 48),
ahead AS (SELECT * FROM (SELECT series_id, pm2_5, datetime FROM air WHERE datetime > TIMESTAMP '{ASOF}')
          QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime) = 1)
SELECT last48.series_id, last48.datetime, last48.pm2_5, ahead.pm2_5 AS pm25_cams
FROM last48 LEFT JOIN ahead ON ahead.series_id = last48.series_id""")
def c4_pair_first_forecast(spark, sf_dir):
    """C4: the last 48 observed hours at ``asof``, each stored beside the first forecast value
    strictly after ``asof`` (grouped ``min_by`` per series + equi join, no pair enumeration)."""
    air, _ = feeds(spark, sf_dir)
    asof = F.lit(ASOF).cast("timestamp_ntz")
    recent = NC.latest_window(air, asof, 48)
    paired = J.pair_next_after(recent.select("series_id", "datetime", "pm2_5"), air, ["series_id"], asof,
                               "datetime", "pm2_5", "pm25_cams")
    return paired.select("series_id", "datetime", "pm2_5", "pm25_cams")


@register("k7_request_features", X.MART_CHAIN + f"""
SELECT location_id, hour_utc, hour_local, latitude, longitude,
       {", ".join(f"coalesce({c}, CAST(0.0 AS DOUBLE)) AS f_{c}" for c in ["pm10", "no2", "so2", "co", "o3"])},
       coalesce(CAST(season = 'winter' AS INTEGER), 0) AS season_winter,
       coalesce(CAST(season = 'monsoon' AS INTEGER), 0) AS season_monsoon,
       coalesce(CAST(season = 'summer' AS INTEGER), 0) AS season_summer,
       CASE WHEN coalesce(pm10, 0.0) != 0 AND coalesce(no2, 0.0) != 0 THEN 'high' ELSE 'medium' END AS confidence,
       {_CAT_AQI.format(x="aqi_pm25")} AS category_from_aqi
FROM mart""")
def k7_request_features(spark, sf_dir):
    """H16-H19 + K7 without the model: request defaults, season one-hot, confidence and the
    AQI category of every mart row (the oracle-able part of batch scoring)."""
    f = ML.scoring_features(requests(spark, sf_dir))
    return f.select("location_id", "hour_utc", "hour_local", "latitude", "longitude",
                    *[f"f_{c}" for c in ["pm10", "no2", "so2", "co", "o3"]],
                    "season_winter", "season_monsoon", "season_summer",
                    A.confidence("pm10", "no2").alias("confidence"),
                    A.category_from_aqi("aqi_pm25").alias("category_from_aqi"))
