"""Keyed upsert, deduplication, latest snapshot, spine generation and the forecast pairing."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from airshed.operators import dedup, joins


def test_upsert_400_old_200_new_100_overlaps(spark):
    t0 = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(t0 + dt.timedelta(hours=i), float(i)) for i in range(1, 401)],
                                "datetime timestamp_ntz, v double")
    new = spark.createDataFrame([(t0 + dt.timedelta(hours=i), float(i) + 1) for i in range(301, 501)],
                                "datetime timestamp_ntz, v double")
    out = {r["datetime"]: r["v"] for r in dedup.upsert(old, new, ["datetime"]).collect()}
    assert len(out) == 500
    updated = sum(1 for i in range(301, 501) if out[t0 + dt.timedelta(hours=i)] == i + 1)
    assert updated == 200
    assert out[t0 + dt.timedelta(hours=1)] == 1.0


def test_dedup_newest_ingest_wins_with_hot_key(spark):
    # one key holds a third of all rows: max_by reduces it on every task before the shuffle
    rows = [(1, "pm25", dt.datetime(2024, 1, 1), float(i), f"2024-12-{(i % 28) + 1:02d}") for i in range(300)]
    rows += [(k, "pm10", dt.datetime(2024, 1, 1), 1.0, "2024-12-01") for k in range(2, 602)]
    df = spark.createDataFrame(rows, "location_id long, parameter string, datetime_utc timestamp_ntz, "
                                     "value double, ingested_at string").repartition(7)
    out = dedup.dedup_measurements(df)
    assert out.count() == 601
    hot = out.where("location_id = 1").collect()[0]
    assert hot["ingested_at"] == "2024-12-28"
    assert hot["value"] == max(float(i) for i in range(300) if (i % 28) + 1 == 28)


def test_spine_product_is_full_product_without_join(spark):
    dim = spark.createDataFrame([(s, p) for s in range(5) for p in ["a", "b"]], "s long, p string")
    start, end = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-01 20:00:00").cast("timestamp_ntz")
    out = joins.spine_product(dim, start, end, "4 HOURS", out="t", partitions=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = sorted((r["s"], r["p"], r["t"].hour) for r in out.collect())
    exp = sorted(itertools.product(range(5), ["a", "b"], [0, 4, 8, 12, 16, 20]))
    assert got == exp


def test_pair_next_after_takes_first_forecast_even_if_null(spark):
    t0 = dt.datetime(2024, 1, 1)
    fc = spark.createDataFrame([(1, t0 + dt.timedelta(hours=h), v) for h, v in [(1, 5.0), (2, None), (3, 7.0)]]
                               + [(2, t0 + dt.timedelta(hours=h), v) for h, v in [(3, 9.0), (4, 8.0)]],
                               "sid long, t timestamp_ntz, v double")
    left = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0)], "sid long, obs double")
    asof = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    got = {r["sid"]: r["first_fc"] for r in joins.pair_next_after(left, fc, ["sid"], asof, "t", "v", "first_fc").collect()}
    assert got == {1: None, 2: 9.0, 3: None}


def test_empty_payload_gives_schema_bearing_empty_frame(spark, tmp_path):
    from airshed.plans import features as FE
    from airshed.sources import json_feed
    p = tmp_path / "empty.json"
    p.write_text('{"timezone": "Asia/Kolkata"}\n{"hourly": {"time": [], "pm2_5": []}}\n')
    got = json_feed.read_hourly_payloads(spark, str(p), ["pm2_5"])
    assert got.columns == ["datetime", "pm2_5"] and got.count() == 0
    empty = json_feed.empty_hourly(spark, ["pm2_5"])
    assert empty.schema == got.schema
    # downstream operators accept the empty feed
    feed = empty.withColumn("series_id", F.lit(1).cast("long"))
    assert FE.add_calendar(feed).count() == 0
