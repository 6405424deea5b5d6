"""Queries of the SQL-model layer: staging, intermediate, pivot, mart, dedup, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.operators import dedup, joins
from airshed.plans import mart
from airshed.sources import driver_tables as D

_STG_COLS = ("location_id, sensor_id, parameter, value, unit, datetime_utc, datetime_local, "
             "latitude, longitude, ingested_at, is_valid, hour_local, day_of_week, month, season")


@register("b1_staging", X.WITH_STG + f"\nSELECT {_STG_COLS} FROM stg")
def b1_staging(spark, sf_dir):
    """Staging model (validity flag, local calendar, NULLs dropped)."""
    return mart.staging(D.measurements(spark, sf_dir))


@register("b3_intermediate",
          X.WITH_STG + f"\nSELECT {_STG_COLS} FROM stg WHERE is_valid = true")
def b3_intermediate(spark, sf_dir):
    """Valid rows only (intermediate model)."""
    return mart.intermediate(mart.staging(D.measurements(spark, sf_dir)))


@register("d1_pivot_hourly", X.MART_CHAIN + "\nSELECT * EXCLUDE (aqi_pm25, aqi_category) FROM mart")
def d1_pivot_hourly(spark, sf_dir):
    """Conditional-average pollutant pivot + count over the 8 mart keys."""
    return mart.pivot_hourly(mart.intermediate(mart.staging(D.measurements(spark, sf_dir))))


@register("d2_mart_hourly", X.MART_CHAIN + "\nSELECT * FROM mart")
def d2_mart_hourly(spark, sf_dir):
    """D2 (flagship): hourly mart with AQI and category."""
    return mart.mart_hourly(D.measurements(spark, sf_dir))


@register("d19_mart_sql_ordinals", X.MART_CHAIN + """
SELECT season, aqi_category, count(*) AS n_rows, CAST(sum(measurement_count) AS BIGINT) AS n_measurements
FROM mart GROUP BY 1, 2""")
def d19_mart_sql_ordinals(spark, sf_dir):
    """Models registered as views and referenced by name from Spark SQL
    (``GROUP BY`` ordinals)."""
    mart.register_models(spark, D.measurements(spark, sf_dir), prefix="q_")
    return spark.sql("""
        SELECT season, aqi_category, count(*) AS n_rows,
               CAST(sum(measurement_count) AS BIGINT) AS n_measurements
        FROM q_mart_hourly GROUP BY 1, 2""")


_DEDUP_SQL = X.WITH_M1 + "," + X.m1("m7", "(SELECT * FROM events WHERE event_id % 7 = 0)") + """,
again AS (
  SELECT location_id, sensor_id, parameter, coalesce(value, 0.0) + 1.0 AS value, unit,
         datetime_utc, datetime_local, latitude, longitude,
         '2025-01-01T00:00:00+00:00' AS ingested_at
  FROM m7
),
allrows AS (SELECT * FROM m1 UNION ALL SELECT * FROM again),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY location_id, parameter, datetime_utc
                               ORDER BY ingested_at DESC, value DESC NULLS LAST) AS rn
  FROM allrows
)
SELECT location_id, sensor_id, parameter, value, unit, datetime_utc, datetime_local,
       latitude, longitude, ingested_at FROM ranked WHERE rn = 1"""


@register("e10_dedup_measurements", _DEDUP_SQL)
def e10_dedup_measurements(spark, sf_dir):
    """Deduplicate re-delivered measurements on the declared key, newest ingest wins."""
    return dedup.dedup_measurements(D.redelivered_measurements(spark, sf_dir))


@register("c6_station_enrichment", X.WITH_M1 + """,
st AS (
  SELECT location_id AS id, max(latitude) AS st_latitude, max(longitude) AS st_longitude,
         'station-' || CAST(location_id AS VARCHAR) AS name,
         'zone-' || CAST(location_id % 7 AS VARCHAR) AS locality
  FROM m1 GROUP BY location_id
)
SELECT m1.location_id, m1.parameter, m1.value, m1.datetime_utc, st.name, st.locality,
       coalesce(m1.latitude, st.st_latitude) AS latitude,
       coalesce(m1.longitude, st.st_longitude) AS longitude
FROM m1 LEFT JOIN st ON m1.location_id = st.id""")
def c6_station_enrichment(spark, sf_dir):
    """Measurements enriched with the station dimension (size-checked broadcast);
    missing coordinates are filled from the station."""
    m = D.measurements(spark, sf_dir)
    st = D.stations_from_measurements(m).select(
        F.col("id").alias("location_id"), "name", "locality",
        F.col("latitude").alias("st_latitude"), F.col("longitude").alias("st_longitude"))
    j = joins.join_dimension(m, st, "location_id", "left")
    return j.select("location_id", "parameter", "value", "datetime_utc", "name", "locality",
                    F.coalesce("latitude", "st_latitude").alias("latitude"),
                    F.coalesce("longitude", "st_longitude").alias("longitude"))
