"""Queries of the sources and sinks (A1-A9, A14): each writes into a fresh folder under the
shared checkpoint directory and reads the data back through the library's readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_dashboards import PRED_SQL, predictions
from airshed.catalog.q_mart import _DEDUP_SQL
from airshed.catalog.q_quality import LATEST_SQL
from airshed.catalog.q_series import ASOF, feeds
from airshed.catalog.q_stats import feature_table
from airshed.operators import dedup
from airshed.plans import features as FE
from airshed.plans import mart
from airshed.session import shared_path
from airshed.sources import csv_tables as C
from airshed.sources import driver_tables as D
from airshed.sources import json_feed as J
from airshed.sources import sinks as K


@register("a1_a3_csv_measurements", X.WITH_M1 + "\nSELECT * FROM m1")
def a1_a3_csv_measurements(spark, sf_dir):
    """A1 + A3: measurements landed as header CSV (all text), read back and typed
    (empty coordinates and values -> NULL in tolerant mode)."""
    path = C.write_csv(D.measurements(spark, sf_dir), shared_path(spark, "measurements-csv"))
    return C.read_measurements(spark, path, strict=False)


@register("a1_csv_reordered_header", X.WITH_M1 + "\nSELECT * FROM m1")
def a1_csv_reordered_header(spark, sf_dir):
    """A1 + A3: the same table landed with its columns in another order and one column more; columns
    are taken by name."""
    m = D.measurements(spark, sf_dir)
    other = m.select(F.lit("x").alias("remark"), *reversed(m.columns))
    path = C.write_csv(other, shared_path(spark, "measurements-reordered"))
    return C.read_measurements(spark, path, strict=False)


@register("a2_csv_stations", X.WITH_M1 + """
SELECT location_id AS id, 'station-' || CAST(location_id AS VARCHAR) AS name,
       'zone-' || CAST(location_id % 7 AS VARCHAR) AS locality, 'Asia/Kolkata' AS timezone,
       max(latitude) AS latitude, max(longitude) AS longitude, true AS is_monitor, 'events' AS provider,
       list_sort(list(DISTINCT parameter)) AS parameters, '2024-12-31T00:00:00+00:00' AS ingested_at
FROM m1 GROUP BY location_id""")
def a2_csv_stations(spark, sf_dir):
    """A2 + H25 + H26: station table as CSV (``True`` text, ``a|b`` lists) read back and typed."""
    st = D.stations_from_measurements(D.measurements(spark, sf_dir))
    path = C.write_csv(st, shared_path(spark, "stations-csv"))
    return C.read_stations(spark, path)


@register("a4_csv_latest", X.WITH_M1 + "," + LATEST_SQL + "\nSELECT * FROM latest")
def a4_csv_latest(spark, sf_dir):
    """A4: latest snapshot as CSV read back and typed."""
    latest = dedup.latest_snapshot(D.with_station_names(D.measurements(spark, sf_dir)))
    path = C.write_csv(latest, shared_path(spark, "latest-csv"))
    return C.read_latest(spark, path)


@register("a5_a7_parquet_replace", X.MART_CHAIN + "\nSELECT * FROM mart")
def a5_a7_parquet_replace(spark, sf_dir):
    """A5 + A7 + A12: the mart materialised as a table (replace write) and scanned back."""
    path = shared_path(spark, "mart-parquet")
    K.write_replace(mart.mart_hourly(D.measurements(spark, sf_dir)), path)
    K.write_replace(mart.mart_hourly(D.measurements(spark, sf_dir)), path)  # replace, not add
    return spark.read.parquet(path)


@register("a6_append_then_dedup", _DEDUP_SQL)
def a6_append_then_dedup(spark, sf_dir):
    """A6 + E10: two appended batches (delivery and re-delivery), deduplicated on read."""
    path = shared_path(spark, "measurements-append")
    K.write_append(D.measurements(spark, sf_dir), path)
    again = (D.redelivered_measurements(spark, sf_dir)
             .where(F.col("ingested_at") == D.REINGESTED_AT))
    K.write_append(again, path)
    return dedup.dedup_measurements(spark.read.parquet(path))


@register("a8_partitioned_features", X.FEATURES + """
SELECT *, CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month
FROM features WHERE year(datetime) = 2024 AND month(datetime) = 1""")
def a8_partitioned_features(spark, sf_dir):
    """A8 + A7: feature table written partitioned by year/month, read with partition pruning."""
    f = feature_table(spark, sf_dir)
    f = f.withColumns({c: F.round(c, 9) for c in FE.ROLLING})
    path = K.write_partitioned(f, shared_path(spark, "features-partitioned"))
    return K.read_partitioned(spark, path, 2024, 1, f.schema)


@register("a9_json_hourly_air", "WITH " + X.AIR + "\nSELECT * FROM air")
def a9_json_hourly_air(spark, sf_dir):
    """Hourly air feed landed as columnar JSON payloads (one per day), read back to rows."""
    air, _ = feeds(spark, sf_dir)
    cols = ["pm2_5", "pm10", "nitrogen_dioxide"]
    path = shared_path(spark, "air-json")
    J.to_hourly_payloads(air, cols, keys=["series_id"]).write.mode("overwrite").json(path)
    return J.read_hourly_payloads(spark, path, cols, keys=["series_id"])


@register("a9_json_mixed_payloads", "WITH " + X.AIR + """
SELECT series_id, count(DISTINCT CASE WHEN day(datetime) % 5 = 0 THEN date_trunc('day', datetime) END) AS rejected,
       count_if(day(datetime) % 5 <> 0) AS hours, round(sum(CASE WHEN day(datetime) % 5 <> 0 THEN pm10 END), 6) AS pm10
FROM air GROUP BY series_id""")
def a9_json_mixed_payloads(spark, sf_dir):
    """A9 with damaged payloads: every fifth day's document is cut short, one series is landed pretty-printed,
    one document per file.  Readable documents give their rows, the others are rejected and counted."""
    air, _ = feeds(spark, sf_dir)
    cols = ["pm2_5", "pm10", "nitrogen_dioxide"]
    docs = J.to_hourly_payloads(air, cols, keys=["series_id"])
    bad = F.substring(F.col("hourly.time")[0], 9, 2).cast("int") % 5 == 0
    text = docs.select(F.to_json(F.struct("series_id", "hourly")).alias("value"), bad.alias("bad"), "series_id")
    text = text.select("series_id", F.when(F.col("bad"), F.expr("substring(value, 1, length(value) - 9)")).otherwise(F.col("value")).alias("value"))
    path = shared_path(spark, "air-json-mixed")
    text.where("series_id <> 0").select("value").write.text(f"{path}/lines")
    pretty = F.regexp_replace("value", r'([\[{,])(["\d])', "$1\n  $2")
    text.where("series_id = 0").select(pretty.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{path}/pretty")
    rows, rejected = J.hourly_payloads(spark, f"{path}/*", cols, keys=["series_id"])
    sid = F.regexp_extract(F.col("text"), r'"series_id":\s*(\d+)', 1).cast("long")
    lost = rejected.groupBy(sid.alias("series_id")).agg(F.count(F.lit(1)).alias("rejected"))
    kept = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("hours"), F.round(F.sum("pm10"), 6).alias("pm10"))
    return kept.join(lost, "series_id", "full").select("series_id", F.coalesce("rejected", F.lit(0)).alias("rejected"),
                                                       F.coalesce("hours", F.lit(0)).alias("hours"), "pm10")


@register("a14_predictions_table", PRED_SQL + "\nSELECT *, true AS inserted_now FROM predictions")
def a14_predictions_table(spark, sf_dir):
    """Predictions conformed to the result-table schema with ``inserted_at`` = now, checked to be
    the wall clock of this run (the value itself differs from run to run)."""
    out = K.with_result_defaults(predictions(spark, sf_dir), keys=["series_id"])
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("inserted_at")
    return out.withColumn("inserted_now", age.between(-5, 3600)).drop("inserted_at")


@register("a14_predictions_table_asof", PRED_SQL + f"""
SELECT *, TIMESTAMP '{ASOF}' AS inserted_at FROM predictions""")
def a14_predictions_table_asof(spark, sf_dir):
    """A14 with the insertion time passed in (the fixture's ``asof``, UTC) instead of the wall
    clock, so the conformed table is deterministic."""
    out = K.with_result_defaults(predictions(spark, sf_dir), F.lit(ASOF).cast("timestamp"), keys=["series_id"])
    return out.withColumn("inserted_at", F.col("inserted_at").cast("timestamp_ntz"))


@register("a10_nested_locations", X.WITH_M1 + """
SELECT location_id AS id, 'station-' || CAST(location_id AS VARCHAR) AS name,
       'zone-' || CAST(location_id % 7 AS VARCHAR) AS locality, 'Asia/Kolkata' AS timezone,
       max(latitude) AS latitude, max(longitude) AS longitude, true AS is_monitor, 'events' AS provider,
       list_sort(list(DISTINCT parameter)) AS parameters, CAST(NULL AS VARCHAR) AS ingested_at
FROM m1 GROUP BY location_id""")
def a10_nested_locations(spark, sf_dir):
    """A10: nested location/sensor JSON documents flattened to station rows."""
    st = D.stations_from_measurements(D.measurements(spark, sf_dir))
    path = shared_path(spark, "locations-json")
    J.to_nested_locations(st).write.mode("overwrite").json(path)
    return J.flatten_locations(spark, path)
