"""Blocked time-series operators against pandas, with tiny blocks so halos and carries matter."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airshed.operators import series as ser


def _frame(spark, values, series_id=1):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(series_id, t0 + dt.timedelta(hours=i), None if v is None or np.isnan(v) else float(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id long, datetime timestamp_ntz, x double")


def _gappy(n=120, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(50, 10, n)
    v[[0, 1]] = np.nan                          # leading run
    v[10] = np.nan                              # run of 1
    v[20:23] = np.nan                           # run of 3
    v[30:34] = np.nan                           # run of 4
    v[40:45] = np.nan                           # run of 5
    v[n - 4:] = np.nan                          # trailing run of 4
    v[rng.choice(np.arange(50, n - 6), 15, replace=False)] = np.nan
    return v


@pytest.mark.parametrize("block,fanout", [(3, 2), (3, 512), (7, 3), (512, 512)])
def test_interpolation_matches_pandas(spark, block, fanout):
    v = _gappy()
    df = ser.with_position(_frame(spark, v), ["series_id"], ["datetime"], bucket=F.date_trunc("hour", "datetime"))
    got = ser.interpolate_linear(df, ["series_id"], ["x"], limit=3, block_rows=block,
                                 fanout=fanout).orderBy(ser.POS)
    got = np.array([np.nan if r["x"] is None else r["x"] for r in got.collect()])
    exp = pd.Series(v).interpolate(method="linear", limit=3).to_numpy()
    np.testing.assert_allclose(got, exp, rtol=1e-12, equal_nan=True)


@pytest.mark.parametrize("block", [24, 30, 512])
def test_lags_and_rolling_match_pandas(spark, block):
    v = _gappy(90, seed=5)
    df = ser.with_position(_frame(spark, v), ["series_id"], ["datetime"])
    out = ser.add_window_features(df, ["series_id"], "x", {"l1": 1, "l2": 2, "l24": 24},
                                  {"r3": 3, "r24": 24}, block_rows=block).orderBy(ser.POS).toPandas()
    s = pd.Series(v)
    for name, exp in [("l1", s.shift(1)), ("l2", s.shift(2)), ("l24", s.shift(24)),
                      ("r3", s.rolling(3).mean()), ("r24", s.rolling(24).mean())]:
        np.testing.assert_allclose(out[name].astype(float).to_numpy(), exp.to_numpy(), rtol=1e-12, equal_nan=True)


def test_position_with_many_series_and_multi_day_buckets(spark):
    frames = [_frame(spark, np.arange(60.0), sid) for sid in (1, 2, 3)]
    df = frames[0].unionByName(frames[1]).unionByName(frames[2])
    out = ser.with_position(df, ["series_id"], ["datetime"]).toPandas()
    for _, g in out.groupby("series_id"):
        g = g.sort_values("datetime")
        assert list(g[ser.POS]) == list(range(60))


def test_sequences_and_leads(spark):
    v = np.arange(40.0)
    df = ser.with_position(_frame(spark, v), ["series_id"], ["datetime"])
    seq = ser.add_sequences(df, ["series_id"], ["x"], "x", 5, block_rows=7).orderBy(ser.POS).collect()
    assert len(seq) == 35
    assert seq[0]["sequence"] == [[0.0], [1.0], [2.0], [3.0], [4.0]] and seq[0]["label"] == 5.0
    lead = ser.add_leads(df, ["series_id"], "x", {"nxt": 1}, block_rows=4).orderBy(ser.POS).collect()
    assert [r["nxt"] for r in lead] == list(np.arange(1.0, 40.0)) + [None]


def test_tail_head_and_split(spark):
    df = ser.with_position(_frame(spark, np.arange(10.0)), ["series_id"], ["datetime"])
    assert sorted(r["x"] for r in ser.last_n(df, ["series_id"], 4).collect()) == [6.0, 7.0, 8.0, 9.0]
    assert sorted(r["x"] for r in ser.first_n(df, 3).collect()) == [0.0, 1.0, 2.0]
    split = ser.chrono_split(df, ["series_id"], 0.8).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"train": 8, "test": 2}
    df7 = ser.with_position(_frame(spark, np.arange(7.0)), ["series_id"], ["datetime"])
    a = {r["split"]: r["count"] for r in ser.chrono_split(df7, ["series_id"], 0.8).groupBy("split").count().collect()}
    b = {r["split"]: r["count"] for r in ser.chrono_split(df7, ["series_id"], 0.8, "test_ceil").groupBy("split").count().collect()}
    assert a == {"train": 5, "test": 2} and b == {"train": 5, "test": 2}


def test_time_lags_follow_the_clock_not_positions(spark):
    v = _gappy(80)
    df = _frame(spark, v).where("x IS NOT NULL")          # dropped hours leave holes in time
    got = ser.add_time_lags(df, ["series_id"], "datetime", "x", {"l1": 1, "l24": 24}).toPandas()
    got = got.sort_values("datetime").reset_index(drop=True)
    s = pd.Series(v, index=pd.date_range("2024-01-01", periods=len(v), freq="h")).dropna()
    for name, k in (("l1", 1), ("l24", 24)):
        exp = s.shift(k, freq="h").reindex(s.index)
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), exp.to_numpy(dtype=float), equal_nan=True)


def test_interpolation_keeps_series_apart(spark):
    a, b = _gappy(100, seed=1), _gappy(130, seed=2)
    df = _frame(spark, a, 1).unionByName(_frame(spark, b, 2))
    df = ser.with_position(df, ["series_id"], ["datetime"], bucket=F.date_trunc("hour", "datetime"))
    out = ser.interpolate_linear(df, ["series_id"], ["x"], limit=3, block_rows=4, fanout=2)
    for sid, v in ((1, a), (2, b)):
        got = out.where(F.col("series_id") == sid).orderBy(ser.POS).collect()
        got = np.array([np.nan if r["x"] is None else r["x"] for r in got])
        exp = pd.Series(v).interpolate(method="linear", limit=3).to_numpy()
        np.testing.assert_allclose(got, exp, rtol=1e-12, equal_nan=True)


def test_hot_series_is_spread_over_many_tasks(spark):
    # one series holds 5,000 of 5,200 rows; its blocked windows must not run in one task
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(hours=i), float(i)) for i in range(5000)]
    rows += [(s, t0 + dt.timedelta(hours=i), float(i)) for s in (2, 3) for i in range(100)]
    df = spark.createDataFrame(rows, "series_id long, datetime timestamp_ntz, x double")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")                    # keep the shuffle's own partitioning visible
    try:
        d = ser.with_position(df, ["series_id"], ["datetime"])
        out = ser.add_lags(d, ["series_id"], "x", {"lag1": 1, "lag24": 24}, block_rows=100)
        # the lag columns must be used, or column pruning removes the window and its shuffle
        parts = (out.where("series_id = 1").select(F.spark_partition_id().alias("p"), "lag1", "lag24")
                 .groupBy("p").agg(F.count("lag1").alias("n1"), F.count(F.lit(1)).alias("count")).collect())
        assert len(parts) >= 6                      # 50 blocks over 8 shuffle partitions
        assert max(r["count"] for r in parts) < 2500
        got = {r["_pos"]: (r["lag1"], r["lag24"]) for r in out.where("series_id = 1").collect()}
        assert got[0] == (None, None) and got[100] == (99.0, 76.0) and got[4999] == (4998.0, 4975.0)
    finally:
        spark.conf.set(key, old)


def test_lags_and_windows_longer_than_a_block(spark):
    n = 3000
    df = spark.createDataFrame([(1, i, float(i)) for i in range(n)], "series_id long, _pos long, x double")
    got = ser.add_window_features(df, ["series_id"], "x", {"lag": 720}, {"roll": 600}).orderBy("_pos").collect()
    assert [r["lag"] for r in got] == [None] * 720 + [float(i) for i in range(n - 720)]
    assert got[598]["roll"] is None and got[2999]["roll"] == sum(range(2400, 3000)) / 600
