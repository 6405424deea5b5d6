"""Queries of the streaming layer (I1-I5): each stream runs to completion with an
``availableNow`` trigger into shared storage and the result table is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog import ORACLE
from airshed.catalog.q_dashboards import UPSERT_NEW_FROM, UPSERT_OLD_BEFORE, predictions

_A11_SQL = ORACLE["a11_upsert_predictions"]
from airshed.catalog.q_quality import LATEST_SQL
from airshed.catalog.q_series import feeds
from airshed.session import shared_path
from airshed.sources import driver_tables as D
from airshed.streaming import jobs as ST


def event_stream(spark, sf_dir, max_files: int | None = None):
    """File stream over the ``events`` table, whether it is one file or a folder of part files
    (fixed schema, no inference)."""
    path = D.table_path(sf_dir, "events")
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # as a glob (of the name itself): a file source accepts a plain path only if it is a folder
    return r.parquet(f"{path[:-1]}[{path[-1]}]")


def measurement_stream(spark, sf_dir):
    """Streaming measurements (FIXTURES M1) with ``event_time``: the UTC instant of
    ``datetime_utc`` (watermarks need a zoned timestamp)."""
    m = D.measurements_from_events(event_stream(spark, sf_dir))
    return m.withColumn("event_time", F.col("datetime_utc").cast("timestamp"))


#: Files of one time slice of a landed folder; a micro-batch reads one slice.
FILES = 2


def land_event_folder(spark, sf_dir, files: int = 4) -> str:
    """``events`` landed as a folder of part files, one time slice after the other; returns the folder
    above it, to be read like ``sf_dir``."""
    base = shared_path(spark, "event-folder")
    ev = D.events(spark, sf_dir).withColumn("at", (F.col("ts").cast("timestamp") + F.make_dt_interval((F.lit(30) * (F.col("event_id") % 12)).cast("int"))))
    cuts = [c for c in ev.select(F.percentile_approx(F.unix_micros("at"), [i / files for i in range(1, files)], 1000).alias("q")).first()["q"]]
    at = F.unix_micros("at")
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = ev if lo is None else ev.where(at > lo)
        part = part if hi is None else part.where(at <= hi)
        part.drop("at").repartition(FILES).write.mode("append").parquet(f"{base}/events.parquet")
    return base


_I1_SQL = X.MART_CHAIN + """
SELECT * FROM mart
WHERE hour_utc + INTERVAL 1 HOUR <= (SELECT max(datetime_utc) FROM stg WHERE is_valid AND value >= 0) - INTERVAL 1 HOUR"""


@register("i1_streaming_mart_batches", _I1_SQL)
def i1_streaming_mart_batches(spark, sf_dir):
    """I1 over a folder of files, one time slice per micro-batch: windows close as the watermark moves on."""
    m = D.measurements_from_events(event_stream(spark, land_event_folder(spark, sf_dir), FILES))
    m = m.withColumn("event_time", F.col("datetime_utc").cast("timestamp"))
    return spark.read.parquet(ST.run_to_parquet(spark, ST.hourly_mart_stream(m), "i1-batches"))


@register("i1_streaming_hourly_mart", _I1_SQL)
def i1_streaming_hourly_mart(spark, sf_dir):
    """Hourly mart as 1-hour event-time windows with a 1-hour watermark (append mode):
    every window whose end the watermark has passed, exactly once."""
    out = ST.run_to_parquet(spark, ST.hourly_mart_stream(measurement_stream(spark, sf_dir)), "i1-mart")
    return spark.read.parquet(out)


@register("i2_streaming_latest", X.WITH_M1 + "," + LATEST_SQL + "\nSELECT * FROM latest")
def i2_streaming_latest(spark, sf_dir):
    """Latest reading per (station, parameter) as a stateful streaming aggregation."""
    path = shared_path(spark, "i2-latest")
    ST.run_foreach_batch(spark, ST.latest_stream(D.with_station_names(measurement_stream(spark, sf_dir))), "i2",
                         ST.overwrite_sink(path), mode="complete")
    return spark.read.parquet(path)


@register("i2_streaming_latest_batches", X.WITH_M1 + "," + LATEST_SQL + "\nSELECT * FROM latest")
def i2_streaming_latest_batches(spark, sf_dir):
    """I2 over a folder of files in several micro-batches, in update mode into the keyed sink: each batch
    adds only the keys it changed; readers take the newest version of a key."""
    m = D.measurements_from_events(event_stream(spark, land_event_folder(spark, sf_dir), FILES))
    path = shared_path(spark, "i2-batches")
    ST.run_foreach_batch(spark, ST.latest_stream(D.with_station_names(m)), "i2-batches", ST.upsert_sink(path), mode="update")
    return ST.read_upserted(spark, path, ["location_id", "parameter"])


@register("i5_streaming_dedup_batches", X.WITH_M1 + "\nSELECT * FROM m1")
def i5_streaming_dedup_batches(spark, sf_dir):
    """I5 over a folder of files, then a second folder that delivers every seventh event again with
    another value: the first delivery of each key is kept, whole rows compared."""
    base = land_event_folder(spark, sf_dir, 2)
    again = D.events(spark, sf_dir).where(F.col("event_id") % 7 == 0).withColumn("value", F.col("value") + 1000.0)
    again.repartition(FILES).write.mode("append").parquet(f"{base}/events.parquet")
    m = D.measurements_from_events(event_stream(spark, base, FILES)).withColumn("event_time", F.col("datetime_utc").cast("timestamp"))
    out = ST.run_to_parquet(spark, ST.dedup_stream(m, "400 days"), "i5-batches")
    return spark.read.parquet(out).drop("event_time")


def _land_predictions(spark, sf_dir) -> str:
    """Land the old and the corrected predictions as day-partitioned files (two deliveries).

    A delivery's rows are gathered by day first: otherwise each task leaves a file in each day it has rows of, and the
    stream's micro-batches grow with tasks times days instead of with the data."""
    p = predictions(spark, sf_dir)
    old = p.where(F.col("datetime") < F.lit(UPSERT_OLD_BEFORE).cast("timestamp_ntz")).withColumn("version", F.lit(0))
    new = (p.where(F.col("datetime") >= F.lit(UPSERT_NEW_FROM).cast("timestamp_ntz"))
           .select("series_id", "datetime", *[(F.col(c) + 1.0).alias(c) for c in ("pm25_observe", "pm25_xgboost", "pm25_cams")])
           .withColumn("depasse_oms", F.col("pm25_xgboost") > 15.0).withColumn("version", F.lit(1)))
    path = shared_path(spark, "i3-landing")
    for batch in (old, new):
        (batch.withColumn("day", F.date_format("datetime", "yyyy-MM-dd")).hint("rebalance", F.col("day"))
         .write.mode("append").partitionBy("day").parquet(path))
    return path


@register("i3_streaming_upsert_sink", _A11_SQL)
def i3_streaming_upsert_sink(spark, sf_dir):
    """I3 + A11: landed prediction files streamed a few files per micro-batch into an
    idempotent merge-on-read sink (foreachBatch); newest version per datetime wins."""
    landing = _land_predictions(spark, sf_dir)
    schema = spark.read.parquet(landing).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(landing)
    table = shared_path(spark, "i3-table")
    ST.run_foreach_batch(spark, stream.drop("day"), "i3", ST.upsert_sink(table), mode="append")
    return ST.read_upserted(spark, table, ["series_id", "datetime"], version="version").drop("version")


@register("i4_streaming_lags", "WITH " + X.AIR + """
SELECT series_id, datetime, pm2_5, lag(pm2_5, 1) OVER (PARTITION BY series_id ORDER BY datetime) AS pm2p5_lag_1h,
       lag(pm2_5, 2) OVER (PARTITION BY series_id ORDER BY datetime) AS pm2p5_lag_2h,
       lag(pm2_5, 24) OVER (PARTITION BY series_id ORDER BY datetime) AS pm2p5_lag_24h, false AS late
FROM air""")
def i4_streaming_lags(spark, sf_dir):
    """I4: lags 1/2/24 of pm2_5 from per-series streaming state (last 24 readings)."""
    air, _ = feeds(spark, sf_dir)
    landing = shared_path(spark, "i4-landing")
    air.select("series_id", "datetime", "pm2_5").write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    stream = spark.readStream.schema(schema).parquet(landing)
    out = ST.run_to_parquet(spark, ST.lag_stream(stream), "i4-lags")
    return spark.read.parquet(out)


@register("i5_streaming_dedup", X.WITH_M1 + "\nSELECT DISTINCT location_id, parameter, datetime_utc FROM m1")
def i5_streaming_dedup(spark, sf_dir):
    """Re-delivered measurements dropped within the watermark; one row per declared key."""
    m = measurement_stream(spark, sf_dir)
    ev = event_stream(spark, sf_dir)
    re = (D.measurements_from_events(ev.where(F.col("event_id") % 7 == 0))
          .withColumn("ingested_at", F.lit(D.REINGESTED_AT))
          .withColumn("event_time", F.col("datetime_utc").cast("timestamp")))
    out = ST.run_to_parquet(spark, ST.dedup_stream(m.unionByName(re)), "i5-dedup")
    return spark.read.parquet(out).select("location_id", "parameter", "datetime_utc")
