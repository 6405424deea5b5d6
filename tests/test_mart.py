"""Hourly mart semantics on hand-made frames."""

import datetime as dt

from airshed import schemas as S
from airshed.plans import mart


def _m(spark, rows):
    return spark.createDataFrame(rows, S.MEASUREMENTS)


def test_half_hour_split_gives_two_rows(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 2, 10), dt.datetime(2024, 1, 1, 2, 40)
    off = dt.timedelta(hours=5, minutes=30)
    rows = [(1, 10, "pm25", 40.0, "µg/m³", t1, t1 + off, 28.0, 77.0, "x"),
            (1, 10, "pm25", 80.0, "µg/m³", t2, t2 + off, 28.0, 77.0, "x")]
    out = mart.mart_hourly(_m(spark, rows)).orderBy("hour_local").collect()
    assert len(out) == 2  # 07:40 and 08:10 local: one UTC hour, two local hours
    assert [r["hour_local"] for r in out] == [7, 8]
    assert out[0]["aqi_pm25"] == 67.0 and out[0]["aqi_category"] == "Satisfactory"


def test_null_pm25_is_severe_and_bc_only_counts(spark):
    t = dt.datetime(2024, 7, 1, 0, 0)
    rows = [(2, 20, "bc", 5000.0, "µg/m³", t, t, None, None, "x"),
            (2, 20, "co", 60.0, "mg/m³", t, t, None, None, "x"),      # invalid: above 50
            (2, 20, "no2", None, "µg/m³", t, t, None, None, "x")]     # dropped: NULL
    out = mart.mart_hourly(_m(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["measurement_count"] == 1 and r["pm25"] is None and r["o3"] is None
    assert r["aqi_pm25"] is None and r["aqi_category"] == "Severe" and r["season"] == "monsoon"
    sane = mart.mart_hourly(_m(spark, rows), null_category=None).collect()[0]
    assert sane["aqi_category"] is None


def test_mart_plan_single_shuffle_and_pushdown(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    path = str(tmp_path / "m")
    _m(spark, [(1, 10, "pm25", 1.0, "u", t, t, 1.0, 1.0, "x")]).write.parquet(path)
    plan = mart.mart_hourly(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "GreaterThanOrEqual(value,0.0)" in plan  # redundant validity bound reaches the scan
