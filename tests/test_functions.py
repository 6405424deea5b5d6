"""Scalar functions on hand-made boundary frames (FIXTURES M4)."""

import datetime as dt

from pyspark.sql import functions as F

from airshed.functions import aqi as A
from airshed.functions import calendar as cal
from airshed.functions import misc as M


def test_validity_limits_inclusive(spark):
    rows = [("pm25", None, False), ("pm25", -0.01, False), ("pm25", 0.0, True), ("pm25", 999.0, True),
            ("pm25", 999.01, False), ("no2", 2000.0, True), ("no2", 2000.01, False), ("co", 50.0, True),
            ("co", 50.01, False), ("o3", 600.0, True), ("o3", 600.01, False), ("bc", 5000.0, True)]
    df = spark.createDataFrame(rows, "parameter string, value double, expected boolean")
    got = df.select(A.is_valid().alias("v"), "expected").collect()
    assert all(r["v"] == r["expected"] for r in got)


def test_aqi_breaks(spark):
    pm = [None, 0.0, 30.0, 30.01, 60.0, 90.0, 120.0, 250.0, 250.01]
    df = spark.createDataFrame([(x,) for x in pm], "pm25 double")
    got = df.select(A.aqi_from_pm25().alias("aqi"), A.category_from_pm25().alias("cat"),
                    A.category_from_pm25(null_category=None).alias("cat2")).collect()
    assert [r["aqi"] for r in got] == [None, 0.0, 50.0, 50.0, 100.0, 200.0, 300.0, 400.0, 400.0]
    assert [r["cat"] for r in got] == ["Severe", "Good", "Good", "Satisfactory", "Satisfactory", "Moderate",
                                       "Poor", "Very Poor", "Severe"]
    assert got[0]["cat2"] is None and got[1]["cat2"] == "Good"


def test_aqi_category_from_aqi(spark):
    df = spark.createDataFrame([(x,) for x in [50.0, 50.4, 100.0, 200.0, 300.0, 400.0, 400.1]], "aqi double")
    got = [r[0] for r in df.select(A.category_from_aqi("aqi")).collect()]
    assert got == ["Good", "Satisfactory", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"]


def test_season_of_every_month(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = [r[0] for r in df.orderBy("m").select(cal.season_of_month("m")).collect()]
    assert got == ["winter", "winter", "summer", "summer", "summer", "monsoon", "monsoon", "monsoon",
                   "monsoon", "post_monsoon", "post_monsoon", "winter"]


def test_weekday_numberings(spark):
    # 2024-01-07 is a Sunday, 2024-01-08 a Monday
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 10),), (dt.datetime(2024, 1, 8, 10),)], "t timestamp_ntz")
    got = df.select(cal.dow_sunday0("t"), cal.dow_monday0("t"), cal.weekend_flag(cal.dow_monday0("t"))).collect()
    assert [tuple(r) for r in got] == [(0, 6, 1), (1, 0, 0)]


def test_confidence_defaults_onehot(spark):
    df = spark.createDataFrame([(1.0, 2.0, "winter"), (0.0, 2.0, "summer"), (None, 2.0, "post_monsoon")],
                               "pm10 double, no2 double, season string")
    got = df.select(A.confidence(), M.default_zero("pm10"), M.one_hot("season", "winter")).collect()
    assert [tuple(r) for r in got] == [("high", 1.0, 1), ("medium", 0.0, 0), ("medium", 0.0, 0)]


def test_band_and_status(spark):
    df = spark.createDataFrame([(14.99, True), (15.0, False), (25.0, None), (35.0, True)], "p double, f boolean")
    got = df.select(A.pm25_band("p"), A.status_label("f")).collect()
    assert [r[0] for r in got] == ["green", "yellow", "red", "dark_red"]
    assert [r[1] for r in got] == ["🔴 OMS!", "🟢 OK", "🟢 OK", "🔴 OMS!"]


def test_pipe_and_bool_text(spark):
    df = spark.createDataFrame([("a|b|c", "True"), ("x", "true")], "p string, b string")
    got = df.select(M.split_pipe("p").alias("a"), M.text_to_bool("b").alias("t")).collect()
    assert got[0]["a"] == ["a", "b", "c"] and got[0]["t"] is True and got[1]["t"] is False


def test_rename_drop_numeric_and_alias_helpers(spark):
    from airshed.functions import misc as M
    df = spark.createDataFrame([(1, 2.0, "a", 3)], "pm2_5 long, temp double, name string, n int")
    r = M.rename(df, {"pm2_5": "pm2p5", "absent": "x"})                      # B5: absent ignored
    assert r.columns == ["pm2p5", "temp", "name", "n"]
    assert M.drop_if_present(r, ["temp", "absent"]).columns == ["pm2p5", "name", "n"]   # B6
    assert M.numeric_columns(r, exclude=["n"]) == ["pm2p5", "temp"]          # B16
    shown = M.aliased(r, {"name": "Station", "pm2p5": "PM2.5"})               # H31
    assert shown.columns == ["Station", "PM2.5"] and shown.collect()[0]["PM2.5"] == 1


def test_scale_conf_sizes_partitions():
    from airshed.session import scale_conf
    big = scale_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    small = scale_conf(37 * 10**6, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 32 << 20


def test_local_to_utc_nulls_skipped_and_repeated_wall_clocks(spark):
    import datetime as dt
    from airshed.functions import calendar as cal
    rows = [(dt.datetime(2024, 6, 1, 12, 0),), (dt.datetime(2024, 3, 31, 2, 30),),
            (dt.datetime(2024, 10, 27, 2, 30),), (dt.datetime(2024, 10, 27, 3, 30),),
            (dt.datetime(2024, 3, 31, 3, 0),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    out = df.select(cal.local_to_utc("t", "Europe/Paris").cast("timestamp_ntz").alias("u"),
                    cal.local_to_utc("t", "Asia/Kolkata").cast("timestamp_ntz").alias("k")).collect()
    assert out[0]["u"] == dt.datetime(2024, 6, 1, 10, 0)
    assert out[1]["u"] is None                                     # skipped: 02:00 -> 03:00
    assert out[2]["u"] is None                                     # repeated: 03:00 -> 02:00
    assert out[3]["u"] == dt.datetime(2024, 10, 27, 2, 30)         # after the repeat, +01:00
    assert out[4]["u"] == dt.datetime(2024, 3, 31, 1, 0)           # first valid wall clock
    assert [r["k"] for r in out] == [t - dt.timedelta(hours=5, minutes=30) for (t,) in rows]


def test_shared_paths_live_under_the_sessions_checkpoint_folder(spark):
    from airshed.session import ensure_checkpoint_dir, shared_path
    base = spark.sparkContext.getCheckpointDir()
    assert base and ensure_checkpoint_dir(spark) == base          # the session's folder is kept
    p1, p2 = shared_path(spark, "x"), shared_path(spark, "x")
    assert p1.startswith(base.rstrip("/") + "/airshed/x-") and p1 != p2
