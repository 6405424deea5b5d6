"""SQL-model layer: staging -> intermediate -> hourly mart.

Each model is a function returning a lazy DataFrame, so the whole chain is one
logical plan that Catalyst optimises end to end (the filter crosses the model
boundary and reaches the scan; unused columns are pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.functions import aqi as A
from airshed.functions import calendar as cal

MART_KEYS = ["location_id", "hour_utc", "hour_local", "day_of_week", "month", "season",
             "latitude", "longitude"]


def staging(measurements: DataFrame) -> DataFrame:
    """Staging model: typed timestamps, validity flag, local calendar features; NULL values dropped."""
    m = measurements.where(F.col("value").isNotNull())
    utc = F.col("datetime_utc").cast("timestamp_ntz")
    local = F.col("datetime_local").cast("timestamp_ntz")
    month = cal.month_of(local)
    return m.select(
        "location_id", "sensor_id", "parameter", "value", "unit",
        utc.alias("datetime_utc"), local.alias("datetime_local"),
        "latitude", "longitude", "ingested_at",
        A.is_valid("parameter", "value").alias("is_valid"),
        cal.hour_of(local).alias("hour_local"),
        cal.dow_sunday0(local).alias("day_of_week"),
        month.alias("month"),
        cal.season_of_month(month).alias("season"),
    )


def intermediate(stg: DataFrame) -> DataFrame:
    """Intermediate model: valid rows only.

    The redundant ``value >= 0`` is implied by ``is_valid`` and lets a Parquet scan prune
    row groups (a CASE-derived flag never reaches the scan as a pushed filter).
    """
    return stg.where(A.validity_prefilter("value") & F.col("is_valid"))


def pivot_hourly(valid: DataFrame, pollutants=None) -> DataFrame:
    """Conditional-average pivot of the pollutants plus ``count(*)`` over the 8 mart keys.

    One hash aggregation (partial on the map side, final after one shuffle); ``.pivot`` would
    plan an extra pass to find the values.
    """
    pollutants = pollutants or S.POLLUTANTS
    keyed = valid.select(
        "location_id", cal.floor_hour("datetime_utc").alias("hour_utc"), "hour_local",
        "day_of_week", "month", "season", "latitude", "longitude", "parameter", "value")
    aggs = [F.avg(F.when(F.col("parameter") == p, F.col("value"))).alias(p) for p in pollutants]
    aggs.append(F.count(F.lit(1)).alias("measurement_count"))
    return keyed.groupBy(*MART_KEYS).agg(*aggs)


def with_aqi(df: DataFrame, pm25: str = "pm25", null_category: str | None = S.SEVERE) -> DataFrame:
    """H14 + H15 appended to a pivoted frame."""
    return df.select("*", A.aqi_from_pm25(pm25).alias("aqi_pm25"),
                     A.category_from_pm25(pm25, null_category).alias("aqi_category"))


def mart_hourly(measurements: DataFrame, null_category: str | None = S.SEVERE) -> DataFrame:
    """The hourly mart (flagship query)."""
    return with_aqi(pivot_hourly(intermediate(staging(measurements))), null_category=null_category)


def register_models(spark, measurements: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Expose the models as named views (``ref`` by name in SQL)."""
    stg = staging(measurements)
    models = {"stg_measurements": stg, "int_cleaned": intermediate(stg),
              "mart_hourly": mart_hourly(measurements)}
    for name, df in models.items():
        df.createOrReplaceTempView(prefix + name)
    return models
