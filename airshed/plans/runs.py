"""Runnable jobs for the reference's three lifecycles.

* ``run_sql_models``: landed CSV tables -> typed raw tables -> dedup -> staging ->
  intermediate -> hourly mart table -> contract report table.
* ``run_feature_build``: landed hourly air/weather payloads -> rename, join, clean,
  interpolate -> calendar, lag and rolling features -> table partitioned by year/month.
* ``run_nowcast_cycle``: the same payloads -> realtime features -> newest complete row per
  series at ``asof`` -> model -> paired with the first forecast after ``asof`` -> keyed
  upsert into a new version of the predictions table.

Each job is a plain function of a session and folder paths.  Plans stay lazy until a write;
every output goes to a folder the caller names (under the shared storage on a cluster), and
a table is replaced by writing a new version, never by rewriting in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.functions import aqi as A
from airshed.functions import calendar as cal
from airshed.operators import dedup
from airshed.operators import joins as J
from airshed.plans import features as FE
from airshed.plans import mart
from airshed.plans import ml as ML
from airshed.plans import nowcast as NC
from airshed.plans import quality as Q
from airshed.session import materialize
from airshed.sources import csv_tables as C
from airshed.sources import json_feed as JF
from airshed.sources import sinks as K


def run_sql_models(spark: SparkSession, stations_csv: str, measurements_csv: str, latest_csv: str,
                   out_dir: str, asof: str, strict: bool = True) -> dict[str, str]:
    """CSV -> raw tables (replace) -> mart table -> contract report; returns the table paths.

    ``strict=True`` fails on text that does not parse (the reference aborts the load);
    ``strict=False`` turns it into NULL and lets the contract report count it.
    """
    out = out_dir.rstrip("/")
    paths = {
        "stations": K.write_replace(C.read_stations(spark, stations_csv, strict), f"{out}/raw_stations"),
        "measurements": K.write_replace(C.read_measurements(spark, measurements_csv, strict),
                                        f"{out}/raw_measurements"),
        "latest": K.write_replace(C.read_latest(spark, latest_csv, strict), f"{out}/raw_latest"),
    }
    # written once: the mart and the report both read the deduplicated rows
    clean = dedup.dedup_measurements(spark.read.parquet(paths["measurements"]))
    m = spark.read.parquet(K.write_replace(clean, f"{out}/measurements_dedup"))
    paths["mart"] = K.write_replace(mart.mart_hourly(m), f"{out}/mart_hourly")
    report = Q.contract_report(m, spark.read.parquet(paths["latest"]), spark.read.parquet(paths["mart"]), asof)
    paths["contract_report"] = K.write_replace(report, f"{out}/contract_report")
    return paths


def read_feeds(spark: SparkSession, air_path: str, weather_path: str,
               series=tuple(FE.SERIES)) -> tuple[DataFrame, DataFrame]:
    """Landed air and weather payloads as hourly rows keyed by series, checkpointed: every
    positional step reads its input twice (a small summary and the rows)."""
    air = JF.read_hourly_payloads(spark, air_path, S.AIR_FEED_COLUMNS, keys=series)
    weather = JF.read_hourly_payloads(spark, weather_path, S.WEATHER_FEED_COLUMNS, keys=series)
    return materialize(air), materialize(weather)


def run_feature_build(spark: SparkSession, air_path: str, weather_path: str, out_path: str,
                      lag_mode: str = "rows") -> str:
    """Landed payloads -> clean, merged, interpolated series -> feature table, written
    partitioned by year/month (time filters of the readers prune folders)."""
    air, weather = read_feeds(spark, air_path, weather_path)
    features = FE.batch_features(FE.clean_and_merge(air, weather), lag_mode=lag_mode)
    return K.write_partitioned(features, out_path)


def nowcast_rows(air: DataFrame, weather: DataFrame, model, asof: str,
                 features=None, window_hours: int = 48) -> tuple[DataFrame, DataFrame]:
    """One nowcast cycle for every series at ``asof`` (floored to the hour).

    Returns (prediction rows, skipped rows).  As in the reference, each feed is cut to its
    last ``window_hours`` rows at or before ``asof`` (B8 + E5) before the full outer align, so
    the positional lags see exactly that window.  The newest aligned row per series is a
    grouped ``max_by`` (no sort of the series); rows with a missing model input are skipped
    (B13); the prediction is rounded to 2 decimals, stored beside the first forecast value
    after ``asof`` (B9 + C4) and flagged against the WHO limit (H22).
    """
    features = features or S.NOWCAST_FEATURES
    at = cal.floor_hour(F.lit(asof).cast("timestamp_ntz"))
    rt = FE.realtime_features(NC.latest_window(air, at, window_hours),
                              NC.latest_window(weather, at, window_hours))
    latest = dedup.latest_per_key(rt, FE.SERIES, [FE.TIME])
    ok, skipped = ML.complete_vectors(latest, features)
    scored = model.transform(ok)
    pred = F.round("prediction", 2)
    rows = scored.select(*FE.SERIES, FE.TIME, F.round("pm2_5", 2).alias("pm25_observe"), pred.alias("pm25_xgboost"))
    rows = J.pair_next_after(rows, air, FE.SERIES, at, FE.TIME, "pm2_5", "_cams")
    rows = rows.select(*FE.SERIES, F.col(FE.TIME).alias("datetime"), "pm25_observe", "pm25_xgboost",
                       F.round("_cams", 2).alias("pm25_cams"), A.exceeds_who("pm25_xgboost").alias("depasse_oms"))
    return rows, skipped


def run_nowcast_cycle(spark: SparkSession, air_path: str, weather_path: str, model,
                      asof: str, predictions_path: str | None, new_path: str) -> str:
    """Score one cycle and upsert it on (series, datetime) into a new predictions version."""
    air, weather = read_feeds(spark, air_path, weather_path)
    rows, _ = nowcast_rows(air, weather, model, asof)
    rows = rows.withColumn("inserted_at", F.current_timestamp())
    return K.upsert_table(spark, predictions_path, rows, FE.SERIES + ["datetime"], new_path)
