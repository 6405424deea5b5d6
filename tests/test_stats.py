"""Exploratory statistics against pandas / numpy on hand-made series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from airshed.plans import stats as ST


def _frame(spark, x, y=None):
    t0 = dt.datetime(2024, 1, 1)
    y = y if y is not None else [None] * len(x)
    rows = [(1, t0 + dt.timedelta(hours=i), None if np.isnan(a) else float(a),
             None if b is None or np.isnan(b) else float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "series_id long, datetime timestamp_ntz, x double, y double")


def _ar1(n=600, seed=7):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    for i in range(1, n):
        x[i] = 0.7 * x[i - 1] + rng.normal()
    return x + 50


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.gamma(2.0, 20.0, 1001), 3)
    x[[5, 50, 500]] = np.nan
    x[10:40] = 42.0                                   # a heavily repeated value
    got = {r["stat"]: r["value"] for r in ST.describe(_frame(spark, x), "x").collect()}
    exp = pd.Series(x).describe()
    for k in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        assert got[k] == pytest.approx(exp[k], rel=1e-9), k


def test_order_statistics_exact_with_small_buckets(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, 5000)
    df = _frame(spark, x)
    ks = [0, 1, 1234, 2500, 4999]
    got = ST.order_statistics(df, "x", ks, buckets=8)
    srt = np.sort(x)
    for k in ks:
        assert got[k] == srt[k]


def test_order_statistics_of_extreme_values_and_passes_that_run_out(spark):
    x = [0.0, 5e-324, 1e-300, 1.0, np.nextafter(1.0, 2), 1e308, -1e308, 7.0, 7.0, 7.0]
    df = _frame(spark, x)
    got = ST.order_statistics(df, "x", list(range(10)), buckets=4)
    assert [got[k] for k in range(10)] == sorted(x)
    with pytest.raises(RuntimeError):
        ST.order_statistics(df, "x", [4], buckets=4, max_passes=1)


def test_corr_with_target_and_constant_column(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    y = 2 * x + rng.normal(size=300)
    y[::7] = np.nan
    df = _frame(spark, x, list(y)).withColumn("c", ST.F.lit(1.0))
    got = {r["feature"]: r["corr"] for r in ST.corr_with_target(df, "x", ["y", "c"]).collect()}
    exp = pd.DataFrame({"x": x, "y": y}).corr()["x"]["y"]
    assert got["y"] == pytest.approx(exp, abs=1e-9)
    assert got["c"] is None                          # constant column: NULL, not an error


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.exponential(30, 2000)
    got = [r["count"] for r in ST.histogram(_frame(spark, x), "x", 60).orderBy("bin").collect()]
    exp, _ = np.histogram(x, bins=60)
    assert got == list(exp)


def test_acf_matches_numpy(spark):
    x = _ar1()
    got = ST.acf(_frame(spark, x), ["series_id"], ["datetime"], "x", nlags=30).orderBy("lag").collect()
    d = x - x.mean()
    n = len(x)
    exp = [np.sum(d[k:] * d[:n - k]) / np.sum(d * d) for k in range(31)]
    np.testing.assert_allclose([r["acf"] for r in got], exp, atol=1e-8)


def test_pacf_matches_yule_walker_solve(spark):
    x = _ar1()
    nl = 12
    got = ST.pacf_yule_walker(_frame(spark, x), ["series_id"], ["datetime"], "x", nlags=nl).orderBy("lag").collect()
    d = x - x.mean()
    n = len(x)
    gamma = np.array([np.sum(d[k:] * d[:n - k]) / (n - k) for k in range(nl + 1)])
    exp = [1.0]
    for k in range(1, nl + 1):
        toeplitz = np.array([[gamma[abs(i - j)] for j in range(k)] for i in range(k)])
        exp.append(np.linalg.solve(toeplitz, gamma[1:k + 1])[-1])
    np.testing.assert_allclose([r["pacf"] for r in got], exp, atol=1e-8)
    assert got[1]["pacf"] == pytest.approx(0.7, abs=0.1)


def test_daily_mean_keeps_empty_days(spark):
    x = np.arange(24 * 4, dtype=float)
    x[24:48] = np.nan                                  # day 2 has rows, all NULL
    df = _frame(spark, x).where("datetime < '2024-01-03' OR datetime >= '2024-01-04'")
    got = {r["day"].day: r["mean"] for r in ST.daily_mean(df, "datetime", "x").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[2] is None and got[3] is None and got[1] == pytest.approx(11.5)


def test_null_ratios_top_and_order(spark):
    df = spark.createDataFrame([(1.0, None, None), (None, None, 2.0), (3.0, None, 4.0), (4.0, 1.0, 5.0)],
                               "a double, b double, c double")
    got = [(r["column_name"], r["null_ratio"]) for r in ST.null_ratios(df, top=2).collect()]
    assert got == [("b", 0.75), ("a", 0.25)]


def test_eda_report_has_every_panel(spark):
    from airshed.plans import features as FE
    x = _ar1(200)
    df = (_frame(spark, x).withColumnRenamed("x", "pm2p5").drop("y")
          .withColumn("temp_c", ST.F.col("pm2p5") * 0.5))
    df = FE.add_calendar(df)
    rep = ST.eda_report(df, weather=["temp_c"], nlags=10)
    assert set(rep) == {"shape", "null_ratios", "describe", "daily_mean", "histogram", "recent_90_days", "by_hour",
                        "by_weekday", "by_month", "corr_weather", "corr_matrix", "acf", "pacf", "preview"}
    assert rep["shape"].collect()[0]["n_rows"] == 200
    assert rep["acf"].count() == 11 and rep["pacf"].count() == 11
    assert rep["corr_weather"].collect()[0]["corr"] == pytest.approx(1.0)
    assert rep["preview"].count() == 5


def test_describe_approx_is_close(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(100, 15, 5000)
    got = {r["stat"]: r["value"] for r in ST.describe(_frame(spark, x), "x", exact=False).collect()}
    exp = pd.Series(x).describe()
    assert got["count"] == 5000 and got["mean"] == pytest.approx(exp["mean"], rel=1e-9)
    for k in ["25%", "50%", "75%"]:
        assert got[k] == pytest.approx(exp[k], abs=0.5)
