"""Queries of the model-facing layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_series import feeds
from airshed.catalog.q_stats import feature_table
from airshed.operators import series as ser
from airshed.plans import additive as AD
from airshed.plans import features as FE
from airshed.plans import mart
from airshed.plans import ml as ML
from airshed.plans.models import ModelStore
from airshed.session import materialize, shared_path
from airshed.sources import driver_tables as D

LSTM_COLS = ["pm2p5", "pm10", "no2", "temp_c", "vent_kmh", "blh_m", "heure", "jour_semaine", "mois", "est_weekend"]
XGB_COLS = ["pm10", "no2", "temp_c", "vent_kmh", "blh_m", "heure", "jour_semaine", "mois", "est_weekend",
            "pm2p5_lag_1h", "pm2p5_lag_2h", "pm2p5_lag_24h"]


def _scaled_sql(c: str) -> str:
    rng = f"(max({c}) OVER () - min({c}) OVER ())"
    scale = f"(1.0 / CASE WHEN {rng} = 0 THEN 1.0 ELSE {rng} END)"
    return f"CAST({c} AS DOUBLE) * {scale} + (0.0 - min({c}) OVER () * {scale})"


@register("k1_minmax_scale_lstm", X.FEATURES + "\nSELECT series_id, datetime, " + ", ".join(
    f"{_scaled_sql(c)} AS {c}" for c in LSTM_COLS) + " FROM features")
def k1_minmax_scale_lstm(spark, sf_dir):
    """D20 + K1: LSTM columns min-max scaled (fitted on all rows, as the reference)."""
    f = feature_table(spark, sf_dir).select("series_id", "datetime", *LSTM_COLS)
    params = ML.minmax_fit(f, LSTM_COLS)
    return ML.minmax_transform(f, params, LSTM_COLS)


def _train_scaled_sql() -> str:
    fit = ", ".join(f"min({c}) AS {c}__mn, max({c}) AS {c}__mx" for c in LSTM_COLS)
    cols = []
    for c in LSTM_COLS:
        scale = f"(1.0 / CASE WHEN {c}__mx - {c}__mn = 0 THEN 1.0 ELSE {c}__mx - {c}__mn END)"
        cols.append(f"CAST({c} AS DOUBLE) * {scale} + (0.0 - {c}__mn * {scale}) AS {c}")
    return X.FEATURES + f""",
sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 < floor(0.8 * count(*) OVER (PARTITION BY series_id))
                      THEN 'train' ELSE 'test' END AS split FROM features),
fit AS (SELECT {fit} FROM sp WHERE split = 'train')
SELECT series_id, datetime, split, {", ".join(cols)} FROM sp, fit"""


@register("k1_minmax_scale_fit_on_train", _train_scaled_sql())
def k1_minmax_scale_fit_on_train(spark, sf_dir):
    """K1 + E11 with decision Q14: scaler fitted on the first 80 % (no leak), applied to all rows."""
    f = feature_table(spark, sf_dir).select("series_id", "datetime", *LSTM_COLS)
    return ML.scale_inputs(f, LSTM_COLS, fit_on="train").select("series_id", "datetime", "split", *LSTM_COLS)


def _scaled_sequences_sql(window: int = 48) -> str:
    vec = ", ".join(LSTM_COLS)
    return X.FEATURES + f""",
scaled AS (SELECT series_id, datetime, {", ".join(f"{_scaled_sql(c)} AS {c}" for c in LSTM_COLS)} FROM features),
seq AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS pos,
               list([{vec}]) OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING) AS sequence,
               pm2p5 AS label
        FROM scaled),
full_seq AS (SELECT series_id, pos - {window} AS position, sequence, label FROM seq WHERE len(sequence) = {window})
SELECT series_id, position, sequence, label,
       CASE WHEN position < floor(0.8 * count(*) OVER (PARTITION BY series_id)) THEN 'train' ELSE 'test' END AS split
FROM full_seq"""


@register("e7_lstm_sequences_48_scaled", _scaled_sequences_sql(48))
def e7_lstm_sequences_48_scaled(spark, sf_dir):
    """E7 + K1 + E11 (second sequence trainer): 48-step windows of the min-max scaled LSTM
    columns, scaled pm2p5 of the next hour as label, 80/20 split of the sequences."""
    f = feature_table(spark, sf_dir).select("series_id", "datetime", *LSTM_COLS)
    s = ML.lstm_sequences(f, LSTM_COLS, "pm2p5", 48)
    return s.select("series_id", F.col(ser.POS).alias("position"), "sequence", "label", "split")


@register("k2_inverse_scale", X.FEATURES + "\nSELECT series_id, datetime, round(pm2p5, 9) AS pm2p5_restored FROM features")
def k2_inverse_scale(spark, sf_dir):
    """K2: scaled target mapped back to the original unit."""
    f = feature_table(spark, sf_dir).select("series_id", "datetime", *LSTM_COLS)
    params = ML.minmax_fit(f, LSTM_COLS)
    scaled = ML.minmax_transform(f, params, LSTM_COLS)
    return scaled.select("series_id", "datetime", F.round(ML.minmax_inverse(F.col("pm2p5"), params, "pm2p5"), 9)
                         .alias("pm2p5_restored"))


@register("k3_xgb_matrix", X.FEATURES + "\nSELECT series_id, datetime, " + ", ".join(XGB_COLS) + ", pm2p5 AS label FROM features")
def k3_xgb_matrix(spark, sf_dir):
    """B6 + K3: model inputs (target, rolling means and time dropped) and label."""
    m, cols = ML.xgb_matrix(feature_table(spark, sf_dir))
    return m


@register("k3_prophet_frame", X.FEATURES + """
SELECT series_id, datetime AS ds, pm2p5 AS y, pm10, no2, temp_c, vent_kmh, blh_m, heure, jour_semaine, mois, est_weekend FROM features""")
def k3_prophet_frame(spark, sf_dir):
    """B5 + H10 + K3: ds / y frame with the 9 regressors."""
    return ML.prophet_frame(feature_table(spark, sf_dir))


def _split(frame, order: str, rule: str):
    """Chronological 80/20 split of each series."""
    return ser.chrono_split(ser.with_position(frame, ["series_id"], [order]), ["series_id"], 0.8, rule).drop(ser.POS)


def _model_card(model, train, test, label: str):
    """One row on a fitted model: what can be checked without fitting it again.  ``fits_train``: smaller
    squared error on its training rows than their mean has."""
    mean = train.agg(F.avg(label)).first()[0]
    e, base = F.col(label) - F.col("prediction"), F.col(label) - F.lit(mean)
    finite = F.bool_and(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    seen = model.transform(train).agg(F.count("prediction").alias("n_train"), (F.sum(e * e) < F.sum(base * base)).alias("fits_train")).first()
    return model.transform(test).agg(F.lit(seen["n_train"]).cast("long").alias("n_train"), F.count("prediction").alias("n_test"),
                                     F.lit(seen["fits_train"]).alias("fits_train"), finite.alias("all_finite"))


def _card_sql(first_test: str) -> str:
    return X.FEATURES + f""",
sp AS (SELECT row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 >= {first_test} AS test FROM features)
SELECT count_if(NOT test) AS n_train, count_if(test) AS n_test, true AS fits_train, true AS all_finite FROM sp"""


@register("k4_gbt_train_predict", _card_sql("count(*) OVER (PARTITION BY series_id) - ceil(0.2 * count(*) OVER (PARTITION BY series_id))"))
def k4_gbt_train_predict(spark, sf_dir):
    """E11 + K4: gradient-boosted trees (100 x depth 6, rate 0.1, seed 42) on the first 80 % of each
    series: number of test predictions, all finite, and a fit better than the mean."""
    m, cols = ML.xgb_matrix(feature_table(spark, sf_dir))
    d = _split(m, "datetime", "test_ceil")
    train = d.where(F.col("split") == "train")
    model = ML.train_gbt(train, cols)
    return _model_card(model, train, d.where(F.col("split") == "test"), "label")


#: Public holidays of the season of the data (fixture choice; the reference asks a calendar library).
HOLIDAYS = ["2024-01-15", "2024-01-26", "2024-03-08", "2024-03-25", "2024-03-29", "2024-08-15", "2024-10-02", "2024-12-25"]


@register("k5_seasonal_regression", _card_sql("floor(0.8 * count(*) OVER (PARTITION BY series_id))"))
def k5_seasonal_regression(spark, sf_dir):
    """K5: trend + yearly/weekly/daily Fourier terms + holidays + all 9 regressors, fitted on the first
    80 % of each series, predicting the last 20 %."""
    frame = _split(ML.prophet_frame(feature_table(spark, sf_dir)), "ds", "floor")
    holidays = spark.createDataFrame([(h,) for h in HOLIDAYS], "ds string").select(F.to_date("ds").alias("ds"))
    design, cols = ML.seasonal_design(frame, holidays)
    train = design.where(F.col("split") == "train")
    model = ML.train_seasonal(train, cols)
    return _model_card(model, train, design.where(F.col("split") == "test"), "y")


@register("k5_additive_per_series")
def k5_additive_per_series(spark, sf_dir):
    """K5: an additive model for each series (25 changepoints, three seasons, holidays, all 9 regressors) fitted on its first 80 %:
    RMSE, MAE and R2 of its last 20 %."""
    frame = materialize(_split(ML.prophet_frame(feature_table(spark, sf_dir)), "ds", "floor"))
    regressors = [c for c in ML.regressors(frame) if c != "split"]
    holidays = spark.createDataFrame([(h,) for h in HOLIDAYS], "ds string").select(F.to_date("ds").alias("ds"))
    models = AD.train_additive(frame.where(F.col("split") == "train"), regressors, holidays)
    scored = AD.forecast(frame.where(F.col("split") == "test"), models, regressors, holidays)
    cards = AD.accuracy(scored)
    return cards.join(models.select("series_id", "n_train"), "series_id").select("series_id", "n_train", "n_test", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@register("k4_saved_model")
def k4_saved_model(spark, sf_dir):
    """K4 + K7: the trees saved as a version, loaded again and scored: held-out RMSE, MAE and R2, and the largest difference that
    saving and loading made to a prediction."""
    m, cols = ML.xgb_matrix(feature_table(spark, sf_dir))
    d = materialize(_split(m, "datetime", "test_ceil"))
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    model, store = ML.train_gbt(train, cols), ModelStore(spark, shared_path(spark, "gbt-models"))
    store.save(model, cols, train, test, "label")
    card, again = store.card(), store.load()
    both = again.transform(test).select("series_id", "datetime", F.col("prediction").alias("loaded")).join(
        model.transform(test).select("series_id", "datetime", "prediction"), ["series_id", "datetime"])
    return both.agg(F.lit(card["version"]).alias("version"), F.lit(card["n_train"]).alias("n_train"), F.count(F.lit(1)).alias("n_test"),
                    *[F.lit(card[c]).cast("double").alias(c) for c in ("rmse", "mae", "r2")], F.max(F.abs(F.col("loaded") - F.col("prediction"))).alias("largest_difference"))


def requests(spark, sf_dir):
    """Scoring requests: one per mart row (fields of the request schema)."""
    m = mart.mart_hourly(D.measurements(spark, sf_dir))
    return m.select("location_id", "hour_utc", "latitude", "longitude", "pm25", "pm10", "no2", "so2", "co", "o3",
                    "hour_local", "day_of_week", "month", "season", "aqi_pm25")


_RULES = [("pm25_required", "pm25 IS NULL"), ("pm25_range", "pm25 < 0 OR pm25 > 999"),
          ("pm10_range", "pm10 < 0 OR pm10 > 999"), ("no2_min", "no2 < 0"), ("so2_min", "so2 < 0"),
          ("co_min", "co < 0"), ("o3_min", "o3 < 0"),
          ("hour_local_range", "hour_local IS NULL OR hour_local < 0 OR hour_local > 23"),
          ("day_of_week_range", "day_of_week IS NULL OR day_of_week < 0 OR day_of_week > 6"),
          ("month_range", "month IS NULL OR month < 1 OR month > 12"),
          ("season_pattern", "season IS NULL OR NOT regexp_matches(season, '^(winter|summer|monsoon|post_monsoon)$')")]
_VIOL = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _RULES) + "], lambda x: x IS NOT NULL)"


@register("b14_request_validation", X.MART_CHAIN + f"""
SELECT location_id, hour_utc, latitude, longitude, {_VIOL} AS violations, len({_VIOL}) = 0 AS valid FROM mart""")
def b14_request_validation(spark, sf_dir):
    """B14 + B15: request-table validation (bounds, required fields, season pattern)."""
    v = ML.validate_requests(requests(spark, sf_dir))
    return v.select("location_id", "hour_utc", "latitude", "longitude", "violations", "valid")


#: Coefficients of the fixed model of the scoring queries (a documented example, not a fit).
AQI_MODEL = ML.FixedLinearModel(12.5, (("pm25", 1.75), ("f_pm10", 0.25), ("f_no2", 0.5), ("f_so2", 0.125), ("f_co", 2.0), ("f_o3", 0.25),
                                       ("hour_local", 0.5), ("day_of_week", -0.25), ("month", 0.125), ("season_winter", 20.0),
                                       ("season_monsoon", -10.0), ("season_summer", 5.0)))
NOWCAST_MODEL = ML.FixedLinearModel(2.5, (("pm10", 0.25), ("no2", 0.125), ("temp_c", -0.0625), ("vent_kmh", -0.125), ("blh_m", 0.03125),
                                          ("heure", 0.25), ("jour_semaine", 0.5), ("mois", -0.25), ("est_weekend", 1.5),
                                          ("pm2p5_lag_1h", 0.5), ("pm2p5_lag_2h", 0.125), ("pm2p5_lag_24h", 0.0625)))


def linear_sql(model: ML.FixedLinearModel) -> str:
    return " + ".join([f"{model.intercept}e0"] + [f"{c}e0 * CAST({n} AS DOUBLE)" for n, c in model.coefficients]).replace("+ -", "- ")


_SCORED = """
req AS (SELECT *, coalesce(pm10, 0e0) AS f_pm10, coalesce(no2, 0e0) AS f_no2, coalesce(so2, 0e0) AS f_so2, coalesce(co, 0e0) AS f_co,
               coalesce(o3, 0e0) AS f_o3, CAST(season = 'winter' AS INTEGER) AS season_winter,
               CAST(season = 'monsoon' AS INTEGER) AS season_monsoon, CAST(season = 'summer' AS INTEGER) AS season_summer,
               """ + _VIOL + """ AS violations FROM mart),
scored AS (SELECT *, CASE WHEN len(violations) = 0 THEN """ + linear_sql(AQI_MODEL) + """ END AS p FROM req)"""
REQUEST_KEYS = ["location_id", "hour_utc", "hour_local", "latitude", "longitude"]


@register("k7_batch_scoring", X.MART_CHAIN + "," + _SCORED + f"""
SELECT {", ".join(REQUEST_KEYS)}, violations, {X.spark_round("p", 1)} AS aqi_predicted,
       CASE WHEN p IS NULL THEN NULL WHEN p <= 50 THEN 'Good' WHEN p <= 100 THEN 'Satisfactory' WHEN p <= 200 THEN 'Moderate'
            WHEN p <= 300 THEN 'Poor' WHEN p <= 400 THEN 'Very Poor' ELSE 'Severe' END AS aqi_category,
       CASE WHEN p IS NULL THEN NULL WHEN f_pm10 <> 0 AND f_no2 <> 0 THEN 'high' ELSE 'medium' END AS confidence,
       CASE WHEN p IS NOT NULL THEN '2.0.0' END AS model_version
FROM scored""")
def k7_batch_scoring(spark, sf_dir):
    """K7: all requests, scored in batch with the fixed model (defaults, one-hot, round, category,
    confidence) or returned with the rules they violate."""
    return ML.score_requests(requests(spark, sf_dir), AQI_MODEL, keys=REQUEST_KEYS)


@register("b15_nowcast_input_contract", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f""",
rt AS (SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM merged_full)
SELECT series_id, datetime, list_filter([""" + ", ".join(
    "'vent_kmh:missing'" if c == "vent_kmh" else
    f"CASE WHEN {c} IS NULL THEN '{c}:null'" + (f" WHEN try_cast({c} AS DOUBLE) IS NULL THEN '{c}:type'" if c == "heure" else "") + " END"
    for c in XGB_COLS) + """], lambda x: x IS NOT NULL) AS violations
FROM (SELECT * REPLACE (CASE WHEN heure % 6 = 0 THEN 'noon' ELSE CAST(heure AS VARCHAR) END AS heure) FROM rt)""")
def b15_nowcast_input_contract(spark, sf_dir):
    """Contract of the 12 nowcast inputs on rows with NULLs, a text in a number field and a field
    that the table lacks."""
    rt = FE.realtime_features(*feeds(spark, sf_dir)).drop("vent_kmh")
    rt = rt.withColumn("heure", F.when(F.col("heure") % 6 == 0, "noon").otherwise(F.col("heure").cast("string")))
    return rt.select("series_id", "datetime", ML.input_violations(rt).alias("violations"))


@register("b13_complete_vectors", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f""",
rt AS (SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM merged_full)
SELECT CASE WHEN """ + " AND ".join(f"{c} IS NOT NULL" for c in XGB_COLS) + """ THEN 'complete' ELSE 'skipped' END AS status,
       count(*) AS n FROM rt GROUP BY 1""")
def b13_complete_vectors(spark, sf_dir):
    """B12 + B13: realtime feature vectors with all 12 inputs vs skipped ones."""
    rt = FE.realtime_features(*feeds(spark, sf_dir))
    ok, bad = ML.complete_vectors(rt.select("datetime", *XGB_COLS))
    return (ok.select(F.lit("complete").alias("status")).unionByName(bad.select(F.lit("skipped").alias("status")))
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")))


@register("b13_vectors_and_skipped", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f""",
rt AS (SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM merged_full)
SELECT series_id, datetime, {", ".join(XGB_COLS)}, list_filter([{", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in XGB_COLS)}], lambda x: x IS NOT NULL) AS missing FROM rt""")
def b13_vectors_and_skipped(spark, sf_dir):
    """B12 + B13: every hour's input vector; those that are skipped come with the inputs they lack."""
    rt = FE.realtime_features(*feeds(spark, sf_dir))
    ok, bad = ML.complete_vectors(rt.select("series_id", "datetime", *XGB_COLS))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in XGB_COLS]))
    return ok.withColumn("missing", F.array().cast("array<string>")).unionByName(bad.withColumn("missing", missing))


@register("k8_nowcast_backfill", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f""",
rt AS (SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")},
              lead(pm2_5, 1) OVER (PARTITION BY series_id ORDER BY datetime) AS nxt FROM merged_full),
p AS (SELECT *, {linear_sql(NOWCAST_MODEL)} AS p FROM rt WHERE {" AND ".join(f"{c} IS NOT NULL" for c in XGB_COLS)})
SELECT series_id, datetime, {X.spark_round("pm2_5", 2)} AS pm25_observe, {X.spark_round("p", 2)} AS pm25_xgboost,
       {X.spark_round("nxt", 2)} AS pm25_cams, {X.spark_round("p", 2)} > 15 AS depasse_oms FROM p""")
def k8_nowcast_backfill(spark, sf_dir):
    """K8: every hour's nowcast from the realtime features with the fixed model, paired with the
    next hour's forecast, rounded and flagged."""
    return ML.nowcast_backfill(FE.realtime_features(*feeds(spark, sf_dir)), NOWCAST_MODEL)
