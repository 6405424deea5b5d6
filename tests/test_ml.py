"""Model-facing data preparation: scaling, sequences and their chronological split."""

import datetime as dt

import numpy as np
import pytest

from airshed.plans import ml as ML


def _features(spark, n=120, seed=11):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(hours=i), float(50 + i + rng.normal()), float(rng.uniform(0, 10)))
            for i in range(n)]
    return spark.createDataFrame(rows, "series_id long, datetime timestamp_ntz, pm2p5 double, temp_c double")


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_sequences_scaled_split(spark, fit_on):
    w, n = 10, 120
    out = ML.lstm_sequences(_features(spark, n), ["pm2p5", "temp_c"], "pm2p5", w, fit_on=fit_on)
    rows = out.orderBy("_pos").collect()
    assert len(rows) == n - w
    assert [r["split"] for r in rows].count("train") == int((n - w) * 0.8)
    assert all(len(r["sequence"]) == w and len(r["sequence"][0]) == 2 for r in rows)
    train_vals = [v[0] for r in rows if r["split"] == "train" for v in r["sequence"]]
    assert min(train_vals) == pytest.approx(0.0)
    if fit_on == "all":
        assert max(r["label"] for r in rows) == pytest.approx(1.0)
    else:
        # a trend: the test period lies above the training range once fitted on train only
        assert max(r["label"] for r in rows) > 1.0
    # consecutive sequences overlap by w - 1 rows
    assert rows[1]["sequence"][:-1] == rows[0]["sequence"][1:]


def test_request_validation_rules(spark):
    cols = ("request_id long, pm25 double, pm10 double, no2 double, so2 double, co double, o3 double, "
            "hour_local int, day_of_week int, month int, season string")
    rows = [
        (1, 40.0, 0.0, 10.0, None, None, None, 5, 1, 1, "winter"),     # valid, pm10 = 0 -> medium
        (2, 40.0, None, 10.0, None, None, None, 5, 1, 1, "monsoon"),   # valid, pm10 NULL -> medium
        (3, 40.0, 50.0, 10.0, None, None, None, 24, 1, 1, "winter"),   # hour 24: rejected
        (4, 40.0, 50.0, 10.0, None, None, None, 5, 1, 1, "spring"),    # unknown season: rejected
        (5, None, 50.0, 10.0, None, None, None, 5, 1, 1, "summer"),    # pm25 required
        (6, 1000.0, 50.0, -1.0, None, None, None, 5, 7, 13, "summer"), # several at once
        (7, 40.0, 50.0, 10.0, 1.0, 2.0, 3.0, 23, 6, 12, "post_monsoon"),  # valid, high confidence
    ]
    v = {r["request_id"]: r for r in ML.validate_requests(spark.createDataFrame(rows, cols)).collect()}
    assert v[1]["valid"] and v[2]["valid"] and v[7]["valid"]
    assert v[3]["violations"] == ["hour_local_range"]
    assert v[4]["violations"] == ["season_pattern"]
    assert v[5]["violations"] == ["pm25_required"]
    assert v[6]["violations"] == ["pm25_range", "no2_min", "day_of_week_range", "month_range"]
    f = {r["request_id"]: r for r in ML.scoring_features(spark.createDataFrame(rows, cols)).collect()}
    assert f[2]["f_pm10"] == 0.0 and f[2]["season_monsoon"] == 1 and f[2]["season_winter"] == 0
    assert (f[7]["season_winter"], f[7]["season_monsoon"], f[7]["season_summer"]) == (0, 0, 0)


def test_batch_scoring_rounds_and_categorises(spark):
    rng = np.random.default_rng(3)
    cols = ("pm25 double, pm10 double, no2 double, so2 double, co double, o3 double, hour_local int, "
            "day_of_week int, month int, season string, aqi_pm25 double")
    train = [(float(x), float(rng.uniform(1, 9)), 5.0, 1.0, 1.0, 1.0, int(rng.integers(0, 24)),
              int(rng.integers(0, 7)), int(rng.integers(1, 13)), "winter", 2.0 * float(x))
             for x in rng.uniform(1, 240, 200)]
    model = ML.train_aqi_model(spark.createDataFrame(train, cols))
    req = spark.createDataFrame(
        [(1, 25.02, 0.0, 5.0, None, None, None, 3, 2, 1, "winter"),       # aqi 50.04 -> Satisfactory
         (2, 150.0, 40.0, 5.0, None, None, None, 3, 2, 1, "winter"),      # aqi 300 -> Poor, high
         (3, 40.0, 40.0, 5.0, None, None, None, 24, 2, 1, "winter")],     # rejected: not scored
        "request_id long, pm25 double, pm10 double, no2 double, so2 double, co double, o3 double, "
        "hour_local int, day_of_week int, month int, season string")
    out = {r["request_id"]: r for r in ML.score_requests(req, model).collect()}
    assert set(out) == {1, 2, 3}
    assert out[3]["violations"] == ["hour_local_range"] and out[3]["aqi_predicted"] is None
    assert out[1]["aqi_predicted"] == pytest.approx(50.0, abs=0.11)
    assert out[1]["aqi_category"] == "Satisfactory" and out[1]["confidence"] == "medium"
    assert out[2]["aqi_category"] in ("Poor", "Very Poor") and out[2]["confidence"] == "high"
    assert out[2]["model_version"] == "2.0.0"
