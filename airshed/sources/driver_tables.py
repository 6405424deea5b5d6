"""Map the driver's generic tables onto the reference's input schemas.

The driver ships TPC-H-like tables plus an ``events`` stream table.  The
reference works on station measurements and hourly air/weather feeds; these
functions derive those shapes from ``events`` with plain projections and one
aggregation, so every query's work grows with the input.

* ``measurements``: one measurement per event (FIXTURES M1), with seeded
  defects: NULL values, negative values, NULL coordinates, and a month shift
  so all four seasons occur.
* ``hourly_air`` / ``hourly_weather``: per-hour averages by event type
  (FIXTURES M2).  Hours without an event of a type give natural NULL gaps.
* ``predictions``: nowcast table derived from the hourly air feed (M3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.functions import calendar as cal
from airshed.functions.aqi import unit_of
from airshed.session import table_path

# Mapping of event types onto pollutant parameters (fixture choice, not reference data).
EVENT_PARAMETER = [("click", "pm25"), ("view", "pm10"), ("purchase", "no2"),
                   ("signup", "so2"), ("error", "co")]
INGESTED_AT = "2024-12-31T00:00:00+00:00"
REINGESTED_AT = "2025-01-01T00:00:00+00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _parameter_of(event_type: Column) -> Column:
    expr = None
    for et, p in EVENT_PARAMETER:
        expr = F.when(event_type == et, F.lit(p)) if expr is None else expr.when(event_type == et, F.lit(p))
    return expr


def measurements_from_events(ev: DataFrame) -> DataFrame:
    """FIXTURES M1: long-format measurements with seeded defects."""
    eid = F.col("event_id")
    shift = F.make_dt_interval((F.lit(30) * (eid % 12)).cast("int"))
    utc = (F.col("ts") + shift).cast("timestamp_ntz")
    value = (F.when(eid % 17 == 0, F.lit(None).cast("double"))
             .when(eid % 23 == 0, -F.col("value"))
             .otherwise(F.col("value")))
    lat = F.when(eid % 31 == 0, F.lit(None).cast("double")).otherwise(
        F.lit(28.0) + (F.col("user_id") % 64).cast("double") / F.lit(64.0))
    lon = F.when(eid % 31 == 0, F.lit(None).cast("double")).otherwise(
        F.lit(77.0) + (F.col("user_id") % 32).cast("double") / F.lit(32.0))
    parameter = _parameter_of(F.col("event_type"))
    return ev.select(
        F.col("user_id").cast("long").alias("location_id"),
        (F.col("user_id") * 10).cast("long").alias("sensor_id"),
        parameter.alias("parameter"),
        value.alias("value"),
        unit_of(parameter).alias("unit"),
        utc.alias("datetime_utc"),
        cal.add_fixed_offset(utc).alias("datetime_local"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.lit(INGESTED_AT).alias("ingested_at"),
    )


def with_station_names(df: DataFrame) -> DataFrame:
    """FIXTURES M1: the stations of the fixture are called ``station-<id>``."""
    return df.withColumn("location_name", F.concat(F.lit("station-"), F.col("location_id").cast("string")))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements_from_events(
        read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"]))


def redelivered_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements plus a later re-delivery of every seventh event with a corrected value.

    Gives the declared key ``(location_id, parameter, datetime_utc)`` real duplicates, which
    the deduplication operator (E10) must resolve in favour of the newest ``ingested_at``.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    base = measurements_from_events(ev)
    again = (measurements_from_events(ev.where(F.col("event_id") % 7 == 0))
             .withColumn("value", F.coalesce(F.col("value"), F.lit(0.0)) + F.lit(1.0))
             .withColumn("ingested_at", F.lit(REINGESTED_AT)))
    return base.unionByName(again)


def stations_from_measurements(m: DataFrame) -> DataFrame:
    """Station dimension (reference ``stations`` schema) derived from measurements."""
    agg = m.groupBy("location_id").agg(
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"),
        F.array_sort(F.collect_set("parameter")).alias("parameters"))
    return agg.select(
        F.col("location_id").alias("id"),
        F.concat(F.lit("station-"), F.col("location_id").cast("string")).alias("name"),
        F.concat(F.lit("zone-"), (F.col("location_id") % 7).cast("string")).alias("locality"),
        F.lit(S.LOCAL_ZONE).alias("timezone"),
        "latitude", "longitude",
        F.lit(True).alias("is_monitor"),
        F.lit("events").alias("provider"),
        "parameters",
        F.lit(INGESTED_AT).alias("ingested_at"),
    )


#: Users of one series of the hourly feeds (fixture choice); every third user belongs to series 0.
USERS_PER_SERIES = 50


def series_of(user: Column) -> Column:
    """FIXTURES M2: the series of an event's user.  Series 0 holds a third of all users (a hot
    series); the others hold the rest of ``USERS_PER_SERIES`` consecutive users each."""
    return F.when(user % 3 == 0, F.lit(0)).otherwise(F.floor(user / USERS_PER_SERIES) + 1).cast("long")


def feed_hour() -> Column:
    """FIXTURES M2: the hour of ``ts``, a month later for each next series, so the feeds cover a year."""
    return cal.floor_hour(F.col("ts") + F.make_dt_interval((F.lit(30) * (F.col("series_id") % 12)).cast("int")))


AIR_SOURCES = [("pm2_5", "click"), ("pm10", "view"), ("nitrogen_dioxide", "purchase")]
WEATHER_SOURCES = [("temperature_2m", "signup"), ("wind_speed_10m", "error"),
                   ("boundary_layer_height", None)]


def hourly_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both M2 feeds from ONE aggregation over ``events``: per series and hour, the six feed means and
    the number of air-type and weather-type events (``_n_air``, ``_n_weather``).

    ``split_feeds`` then projects the air and weather feeds from it, so the raw table is
    scanned once instead of twice.
    """
    ev = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"]).withColumn("series_id", series_of(F.col("user_id")))
    air_types = [et for _, et in AIR_SOURCES]
    weather_types = ["signup", "error"]
    et = F.col("event_type")
    aggs = [F.avg(F.when(et == src, F.col("value"))).alias(name) for name, src in AIR_SOURCES]
    for name, src in WEATHER_SOURCES:
        cond = et == src if src is not None else et.isin(weather_types)
        aggs.append(F.avg(F.when(cond, F.col("value"))).alias(name))
    aggs += [F.count_if(et.isin(air_types)).alias("_n_air"), F.count_if(et.isin(weather_types)).alias("_n_weather")]
    return (ev.where(et.isin(air_types + weather_types))
            .groupBy("series_id", feed_hour().alias("datetime")).agg(*aggs))


def split_feeds(hourly: DataFrame, keys=()) -> tuple[DataFrame, DataFrame]:
    """(air, weather) from ``hourly_feeds``: hours with at least one event of the feed's types;
    ``keys`` (series columns) are kept after the value columns."""
    keys = list(keys)
    air = hourly.where(F.col("_n_air") > 0).select("datetime", *[n for n, _ in AIR_SOURCES], *keys)
    weather = hourly.where(F.col("_n_weather") > 0).select("datetime", *[n for n, _ in WEATHER_SOURCES], *keys)
    return air, weather
