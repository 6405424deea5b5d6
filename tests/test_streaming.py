"""Streaming jobs across restarts: state must carry across micro-batches and query runs."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from airshed.streaming import jobs as ST

SCHEMA = "series_id long, datetime timestamp_ntz, pm2_5 double"


def _rows(lo, hi):
    t0 = dt.datetime(2024, 1, 1)
    return [(s, t0 + dt.timedelta(hours=i), None if i % 11 == 0 else float(i * 10 + s))
            for s in (1, 2) for i in range(lo, hi)]


def _run(spark, landing, out, ck):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    q = (ST.lag_stream(stream).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()


def test_lag_state_survives_restart_and_batches(spark, tmp_path):
    ST.configure_streaming(spark)
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    # first run: two files (two micro-batches), hours 0..39
    spark.createDataFrame(_rows(0, 20), SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame(_rows(20, 40), SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    _run(spark, landing, out, ck)
    # restart with the same checkpoint after more data landed: hours 40..69
    spark.createDataFrame(_rows(40, 70), SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    _run(spark, landing, out, ck)

    got = spark.read.parquet(out).toPandas().sort_values(["series_id", "datetime"]).reset_index(drop=True)
    exp = pd.DataFrame(_rows(0, 70), columns=["series_id", "datetime", "pm2_5"])
    exp = exp.sort_values(["series_id", "datetime"]).reset_index(drop=True)
    assert len(got) == len(exp) == 140
    for name, k in (("pm2p5_lag_1h", 1), ("pm2p5_lag_2h", 2), ("pm2p5_lag_24h", 24)):
        want = exp.groupby("series_id")["pm2_5"].shift(k).to_numpy(dtype=float)
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), want, equal_nan=True)


def _readings(spark, times):
    from airshed import schemas as S
    rows = [(1, 10, "pm25", float(10 * (i + 1)), "u", t, t + dt.timedelta(minutes=330), 28.0, 77.0, "x")
            for i, t in enumerate(times)]
    return spark.createDataFrame(rows, S.MEASUREMENTS)


def test_hourly_mart_stream_drops_late_rows_and_emits_each_window_once(spark, tmp_path):
    from pyspark.sql import functions as F
    from airshed import schemas as S
    ST.configure_streaming(spark)
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    d0 = dt.datetime(2024, 1, 5)

    def at(h, m):
        return d0 + dt.timedelta(hours=h, minutes=m)

    def run():
        src = (spark.readStream.schema(S.MEASUREMENTS).option("maxFilesPerTrigger", 1).parquet(landing)
               .withColumn("event_time", F.col("datetime_utc").cast("timestamp")))
        q = (ST.hourly_mart_stream(src).writeStream.outputMode("append").format("parquet")
             .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    _readings(spark, [at(0, 5), at(0, 20), at(1, 10), at(3, 15)]).coalesce(1).write.mode("append").parquet(landing)
    run()                                                   # watermark 02:15: hours 00 and 01 final
    first = {r["hour_utc"].hour: r["measurement_count"] for r in spark.read.parquet(out).collect()}
    assert first == {0: 2, 1: 1}
    # a late reading for hour 00 (behind the watermark) and one that moves the watermark to 04:45
    _readings(spark, [at(0, 25), at(5, 45)]).coalesce(1).write.mode("append").parquet(landing)
    run()
    got = {r["hour_utc"].hour: r["measurement_count"] for r in spark.read.parquet(out).collect()}
    assert got == {0: 2, 1: 1, 3: 1}                        # late row dropped, hour 05 still open


def test_upsert_sink_is_idempotent_on_replay(spark, tmp_path):
    path = str(tmp_path / "table")
    sink = ST.upsert_sink(path)
    t0 = dt.datetime(2024, 1, 1)
    b0 = spark.createDataFrame([(t0, 1.0, 0), (t0 + dt.timedelta(hours=1), 2.0, 0)],
                               "datetime timestamp_ntz, v double, version int")
    b1 = spark.createDataFrame([(t0 + dt.timedelta(hours=1), 5.0, 1)], "datetime timestamp_ntz, v double, version int")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)                      # the same micro-batch replayed after a failure
    assert spark.read.parquet(path).count() == 3
    got = {r["datetime"].hour: r["v"] for r in ST.read_upserted(spark, path, ["datetime"], version="version").collect()}
    assert got == {0: 1.0, 1: 5.0}


def test_landed_predictions_have_files_by_day_not_by_task(spark, tmp_path, monkeypatch):
    from airshed.catalog import q_streaming as Q
    t0 = dt.datetime(2024, 1, 10)
    rows = [(s, t0 + dt.timedelta(hours=6 * h), 10.0, float(s), 1.0, False) for s in range(40) for h in range(60)]  # 10 to 24 January
    df = spark.createDataFrame(rows, "series_id long, datetime timestamp_ntz, pm25_observe double, pm25_xgboost double, "
                                     "pm25_cams double, depasse_oms boolean").repartition(12)
    monkeypatch.setattr(Q, "predictions", lambda *_: df)
    landing = Q._land_predictions(spark, "")
    files = spark.read.parquet(landing).select(F.input_file_name().alias("f"), "version").distinct()
    assert {r["version"]: r["n"] for r in files.groupBy("version").agg(F.count("*").alias("n")).collect()} == {0: 11, 1: 10}
    got = Q.i3_streaming_upsert_sink(spark, "").collect()
    exp = {(s, t): (11.0, s > 14) if t >= dt.datetime(2024, 1, 15) else (10.0, False) for s, t, *_ in rows}
    assert len(got) == len(exp)
    assert {(r["series_id"], r["datetime"]): (r["pm25_observe"], r["depasse_oms"]) for r in got} == exp


def test_latest_stream_keeps_newest_across_batches(spark, tmp_path):
    from airshed import schemas as S
    ST.configure_streaming(spark)
    landing, table, ck = str(tmp_path / "in"), str(tmp_path / "latest"), str(tmp_path / "ck")
    t0 = dt.datetime(2024, 1, 1)

    def land(rows):
        spark.createDataFrame([(1, 10, "pm25", v, "u", t0 + dt.timedelta(hours=h),
                                t0 + dt.timedelta(hours=h, minutes=330), 28.0, 77.0, "x") for h, v in rows],
                              S.MEASUREMENTS).coalesce(1).write.mode("append").parquet(landing)

    def run():
        src = spark.readStream.schema(S.MEASUREMENTS).option("maxFilesPerTrigger", 1).parquet(landing)
        q = (ST.latest_stream(src).writeStream.outputMode("complete").foreachBatch(ST.overwrite_sink(table))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    land([(10, 1.0)])
    land([(12, 2.0)])
    run()
    land([(11, 3.0), (13, None)])        # an older reading arriving late, a newer NULL reading
    run()
    rows = spark.read.parquet(table).collect()
    assert len(rows) == 1 and rows[0]["value"] == 2.0 and rows[0]["datetime_utc"].hour == 12


def test_dedup_stream_drops_redelivery_in_a_later_batch(spark, tmp_path):
    from pyspark.sql import functions as F
    from airshed import schemas as S
    ST.configure_streaming(spark)
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    t0 = dt.datetime(2024, 1, 1, 10)

    def land(rows, ingested):
        spark.createDataFrame([(loc, 10, "pm25", v, "u", t0 + dt.timedelta(minutes=mi),
                                t0 + dt.timedelta(minutes=mi + 330), 28.0, 77.0, ingested) for loc, mi, v in rows],
                              S.MEASUREMENTS).coalesce(1).write.mode("append").parquet(landing)

    def run():
        src = (spark.readStream.schema(S.MEASUREMENTS).option("maxFilesPerTrigger", 1).parquet(landing)
               .withColumn("event_time", F.col("datetime_utc").cast("timestamp")))
        q = (ST.dedup_stream(src).writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    land([(1, 0, 1.0), (2, 5, 2.0)], "first")
    run()
    land([(1, 0, 9.0), (3, 20, 3.0)], "again")      # station 1 re-delivered within the watermark
    run()
    rows = {(r["location_id"], r["ingested_at"]) for r in spark.read.parquet(out).collect()}
    assert rows == {(1, "first"), (2, "first"), (3, "again")}


def test_late_readings_come_out_flagged_and_none_is_lost(spark, tmp_path):
    ST.configure_streaming(spark)
    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    t0 = dt.datetime(2024, 1, 1)
    for hours in ([0, 1, 2, 5], [3, 6, 5]):     # hours 3 and 5 come after hour 5 was seen
        spark.createDataFrame([(1, t0 + dt.timedelta(hours=h), float(h)) for h in hours], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    _run(spark, landing, out, ck)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 7
    assert sorted((r["datetime"].hour, r["late"]) for r in rows) == [(0, False), (1, False), (2, False), (3, True), (5, False), (5, True), (6, False)]
    assert {r["pm2p5_lag_1h"] for r in rows if r["late"]} == {None}


def test_event_stream_reads_a_folder_of_files_like_a_file(spark, tmp_path):
    from airshed.catalog import q_streaming as QS
    from conftest import SF0001
    spark.read.parquet(f"{SF0001}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for base in (SF0001, str(tmp_path)):
        path = ST.run_to_parquet(spark, QS.event_stream(spark, base, 1), "t-events")
        assert spark.read.parquet(path).count() == 1000
