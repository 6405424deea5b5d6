"""Per-series additive models against a plain numpy solve; saved models and their cards."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from airshed.plans import additive as AD
from airshed.plans.models import ModelStore, held_out
from airshed.session import shared_path

T0 = dt.datetime(2024, 1, 1)
REGRESSORS = ["temp", "wind"]
HOLIDAYS = [dt.date(2024, 1, 15), dt.date(2024, 1, 26)]


def rows_of(series, hours, rng, bend=None):
    """Hours with a trend (that bends), a daily season, a regressor and noise."""
    out = []
    for h in hours:
        t = T0 + dt.timedelta(hours=int(h))
        temp, wind = float(rng.normal(20, 5)), 3.0
        trend = 50 + 0.05 * h - (0.2 * max(0, h - bend) if bend else 0)
        y = trend + 8 * math.sin(2 * math.pi * h / 24) + 0.7 * temp + (15 if t.date() in HOLIDAYS else 0) + float(rng.normal(0, 1))
        out.append((series, t, None if h % 97 == 5 else y, None if h % 89 == 7 else temp, wind))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(6)
    rows = rows_of(0, range(900), rng, bend=350) + rows_of(1, range(100, 700), rng) + rows_of(2, range(0, 300, 5), rng) + rows_of(3, [6], rng)
    split = lambda r: "train" if r[1] < T0 + dt.timedelta(hours={0: 720, 1: 580, 2: 240, 3: 10}[r[0]]) else "test"
    return spark.createDataFrame([(*r, split(r)) for r in rows], "series_id long, ds timestamp_ntz, y double, temp double, wind double, split string").repartition(7)


def plain_models(rows):
    """Per series: a function giving the design matrix, and coefficients by numpy on whole matrices."""
    out = {}
    for s in sorted({r.series_id for r in rows}):
        train = [r for r in rows if r.series_id == s and r.split == "train" and r.y is not None]
        days = lambda r: (r.ds - dt.datetime(1970, 1, 1)).total_seconds() / 86400
        begin, span = min(map(days, train)), (max(map(days, train)) - min(map(days, train))) or 1.0
        size = max(abs(r.y) for r in train) or 1.0
        stat = {c: (np.mean([getattr(r, c) for r in train if getattr(r, c) is not None]), np.std([getattr(r, c) for r in train if getattr(r, c) is not None]) or 1.0) for c in REGRESSORS}

        def vector(r, begin=begin, span=span, stat=stat, days=days):
            t = (days(r) - begin) / span
            x = [1.0, t] + [max(t - 0.8 * (i + 1) / 26, 0.0) for i in range(25)]
            for p, n in ((365.25, 10), (7.0, 3), (1.0, 4)):
                for k in range(1, n + 1):
                    x += [math.sin(2 * math.pi * k / p * days(r)), math.cos(2 * math.pi * k / p * days(r))]
            return x + [float(r.ds.date() in HOLIDAYS)] + [(getattr(r, c) - m) / v for c, (m, v) in stat.items()]

        use = [r for r in train if r.temp is not None]
        x, y = np.array([vector(r) for r in use]), np.array([r.y for r in use]) / size
        penalty = np.array([0, 0] + [(0.1 / 0.05) ** 2] * 25 + [(0.1 / 10) ** 2] * 37) + 1e-9
        # as least squares with a row for each penalty, not through the normal equations
        coefficients = np.linalg.lstsq(np.vstack([x, np.diag(np.sqrt(penalty))]), np.concatenate([y, np.zeros(len(penalty))]), rcond=None)[0]
        out[s] = (vector, coefficients, size)
    return out


@pytest.fixture(scope="module")
def scored(spark, frame):
    holidays = spark.createDataFrame([(h,) for h in HOLIDAYS + HOLIDAYS[:1]], "ds date")
    models = AD.train_additive(frame.where("split = 'train'"), REGRESSORS, holidays)
    return models, AD.forecast(frame, models, REGRESSORS, holidays).collect()


def test_forecasts_equal_a_plain_solve(frame, scored):
    rows = frame.collect()
    plain, (models, got) = plain_models(rows), scored
    assert len(got) == len(rows) and {r.series_id: r.n_train for r in got} == {
        s: sum(r.series_id == s and r.split == "train" and r.y is not None for r in rows) for s in plain}
    for r in got:
        vector, coefficients, size = plain[r.series_id]
        if r.temp is None:
            assert r.yhat is None
        else:
            assert r.yhat == pytest.approx(float(np.dot(vector(r), coefficients)) * size, rel=1e-5, abs=1e-4)
    assert {len(r.coefficients) for r in models.collect()} == {len(AD.columns(REGRESSORS))}


def test_the_trend_bends_and_metrics_are_right(spark, frame, scored):
    _, got = scored
    test = [r for r in got if r.split == "test"]
    df = spark.createDataFrame([(r.series_id, r.y, r.yhat) for r in test], "series_id long, y double, yhat double")
    cards = {r.series_id: r for r in AD.accuracy(df).collect()}
    for s, card in cards.items():
        y, p = np.array([(r.y, r.yhat) for r in test if r.series_id == s and r.y is not None and r.yhat is not None]).T
        assert card.n_test == len(y)
        assert card.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2))) and card.mae == pytest.approx(np.mean(np.abs(y - p)))
        assert card.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    seen = spark.createDataFrame([(r.series_id, r.y, r.yhat) for r in got if r.split == "train"], "series_id long, y double, yhat double")
    cards = {r.series_id: r for r in AD.accuracy(seen).collect()}
    assert cards[0].r2 > 0.9 and cards[1].r2 > 0.9 and cards[3].r2 is None   # of a bent trend too; one row has no spread


def test_matrices_add_up_however_rows_are_spread(spark, frame):
    train = frame.where("split = 'train'")
    fits = []
    for n in (1, 9):
        scale = AD.scales(train, REGRESSORS)
        rows = AD.fit(AD.design(train, scale, REGRESSORS, None).repartition(n), REGRESSORS).orderBy("series_id").collect()
        fits.append(np.array([r.coefficients for r in rows]))
    assert fits[0].shape == (4, len(AD.columns(REGRESSORS))) and np.allclose(*fits, atol=1e-6)
    assert AD.train_additive(train.limit(0), REGRESSORS).count() == 0


def test_saved_versions_score_alike_after_loading(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), 3.0 * a - b + float(rng.normal(0, 0.1))) for a, b in rng.normal(size=(200, 2)).tolist()]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    train, test = df.limit(150), df.subtract(df.limit(150))
    store = ModelStore(spark, shared_path(spark, "test-models"))
    with pytest.raises(ValueError):
        store.card()
    fitted = []
    for reg in (0.0, 5.0):
        model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression(labelCol="label", regParam=reg)]).fit(train)
        fitted.append(model)
        assert store.save(model, ["a", "b"], train, test, "label") == len(fitted)
    for version, model in enumerate(fitted, 1):
        again = store.load(version)
        a, b = (sorted(r.prediction for r in m.transform(df).collect()) for m in (model, again))
        assert a == b
    assert store.card()["version"] == 2 and store.card(1)["rmse"] < store.card(2)["rmse"] and store.card(1)["r2"] > 0.99
    assert store.card(1)["inputs"] == ["a", "b"] and store.card(1)["n_test"] == test.count()
    p = np.array([(r.label, r.prediction) for r in fitted[0].transform(test).collect()])
    assert held_out(fitted[0], test, "label")["mae"] == pytest.approx(np.mean(np.abs(p[:, 0] - p[:, 1])))
    # a save that failed before its card is no version
    fitted[0].write().overwrite().save(f"{store.path}/models/3")
    assert store.cards.version() == 2
    with pytest.raises(ValueError):
        store.load(3)
