"""Model-facing data work with ``pyspark.ml``.

Scaling statistics come from one aggregation whose one-row result is the model, applied as
literals; models are ``pyspark.ml`` estimators trained on the distributed
feature table; scoring is ``transform`` over a request *table*.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed import schemas as S
from airshed.functions import aqi as A
from airshed.functions.misc import default_zero, drop_if_present, one_hot
from airshed.operators import series as ser

# ---- K1 / K2: min-max scaling ---------------------------------------------------


def minmax_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Fit a min-max scaler: ``{column: (scale, offset)}`` in sklearn's form
    (``x * scale + offset``, ``scale = 1 / (max - min)``, 1 for a constant column).

    One distributed aggregation (partial min/max on every task); its one-row result, two
    numbers per column, is the model, kept on the driver as ``pyspark.ml`` scalers keep theirs.
    Applying it is then a projection with literals: no subquery re-runs the fit.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"), F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    row = df.agg(*aggs).first()
    params = {}
    for c in cols:
        lo, hi = row[f"{c}__min"], row[f"{c}__max"]
        if lo is None:
            params[c] = (None, None)
            continue
        scale = 1.0 / (1.0 if hi - lo == 0 else hi - lo)
        params[c] = (scale, 0.0 - lo * scale)
    return params


def minmax_transform(df: DataFrame, params: dict[str, tuple[float, float]], cols: list[str]) -> DataFrame:
    """K1: apply a fitted scaling (literals; NULL parameters for an all-NULL column)."""
    def lit(x):
        return F.lit(x).cast("double")
    return df.withColumns({c: F.col(c).cast("double") * lit(params[c][0]) + lit(params[c][1]) for c in cols})


def minmax_inverse(col: Column, params: dict[str, tuple[float, float]], name: str) -> Column:
    """K2: inverse scaling of one column, ``(x - offset) / scale``."""
    scale, offset = params[name]
    return (col - F.lit(offset).cast("double")) / F.lit(scale).cast("double")


def scale_inputs(features: DataFrame, cols: list[str], fit_on: str = "all", series=("series_id",),
                 order: str = "datetime", train_share: float = 0.8) -> DataFrame:
    """K1 with decision Q14: ``fit_on="all"`` fits the scaler on every row (the reference,
    which leaks the test period); ``fit_on="train"`` fits on the chronological training
    share only and applies it to all rows.  Adds ``split`` (E11) in both modes."""
    series = list(series)
    d = ser.chrono_split(ser.with_position(features, series, [order]), series, train_share).drop(ser.POS)
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    params = minmax_fit(d if fit_on == "all" else d.where(F.col("split") == "train"), cols)
    return minmax_transform(d, params, cols)


def lstm_sequences(features: DataFrame, cols: list[str], target: str = "pm2p5", window: int = 48,
                   series=("series_id",), order: str = "datetime", train_share: float = 0.8,
                   fit_on: str = "all") -> DataFrame:
    """E7 + K1 + E11 for the sequence models: min-max scaled columns, sliding windows of
    ``window`` rows (oldest first) with the next row's scaled target as label, and a
    chronological split of the *sequences* (the first ``floor(share * n)`` train).

    ``fit_on="all"`` scales with all rows (the reference); ``"train"`` with the rows before the
    first test label only.  Windows run per (series, block) with a halo, so a long series is
    never one task.
    """
    series = list(series)
    d = ser.with_position(features, series, [order])
    if fit_on == "all":
        fit = d
    elif fit_on == "train":
        # rows up to the last training label: positions < window + floor(share * (n - window))
        sized = ser.with_size(d, series)
        n_seq = F.greatest(F.col("_size") - F.lit(window), F.lit(0))
        fit = sized.where(F.col(ser.POS) < F.lit(window) + F.floor(n_seq * F.lit(train_share))).drop("_size")
    else:
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    scaled = minmax_transform(d, minmax_fit(fit, cols), cols)
    seq = ser.add_sequences(scaled, series, cols, target, window)
    # sequence index: the first full window ends at position ``window``
    seq = seq.withColumn(ser.POS, F.col(ser.POS) - F.lit(window))
    return ser.chrono_split(seq, series, train_share, rule="floor")


# ---- K3: feature matrices ----------------------------------------------------------

XGB_DROP = ["pm2p5", "pm2p5_rolling_3h", "pm2p5_rolling_24h", "datetime", "index", "series_id"]


def xgb_matrix(features: DataFrame, target: str = "pm2p5") -> tuple[DataFrame, list[str]]:
    """K3: XGBoost inputs (all columns but target, rolling means, time) plus ``label``."""
    x = drop_if_present(features, XGB_DROP)
    cols = x.columns
    return features.select(*[c for c in ("series_id", "datetime") if c in features.columns],
                           *cols, F.col(target).alias("label")), cols


PROPHET_DROP = ["pm2p5_rolling_3h", "pm2p5_rolling_24h", "pm2p5_lag_1h", "pm2p5_lag_2h", "pm2p5_lag_24h", "index"]


def prophet_frame(features: DataFrame, series=("series_id",)) -> DataFrame:
    """K3: ``ds`` (zone-free local wall clock), ``y`` and ALL other columns but lags and rolling
    means as regressors; series columns are kept as keys."""
    d = drop_if_present(features, PROPHET_DROP)
    keys = [c for c in series if c in d.columns]
    rest = [c for c in d.columns if c not in keys + ["datetime", "pm2p5"]]
    return d.select(*keys, F.col("datetime").cast("timestamp_ntz").alias("ds"), F.col("pm2p5").alias("y"), *rest)


def regressors(frame: DataFrame, series=("series_id",)) -> list[str]:
    return [c for c in frame.columns if c not in (*series, "ds", "y")]


# ---- K4: gradient-boosted trees ---------------------------------------------------------

def train_gbt(train: DataFrame, feature_cols: list[str], label: str = "label",
              max_iter: int = 100, max_depth: int = 6, step: float = 0.1, seed: int = 42) -> PipelineModel:
    """K4: gradient-boosted regression with the reference's settings (100 trees, depth 6,
    rate 0.1, seed 42); ``pyspark.ml`` trains tree levels in parallel across partitions."""
    asm = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step, seed=seed)
    return Pipeline(stages=[asm, gbt]).fit(train)


# ---- K5: additive seasonal regression ---------------------------------------------------

def fourier_terms(ds: Column, period_days: float, order: int, prefix: str) -> list[Column]:
    """Fourier columns ``sin/cos(2 pi k t / P)`` with ``t`` in days since the epoch."""
    t = F.unix_micros(ds.cast("timestamp")).cast("double") / F.lit(86400e6)
    out = []
    for k in range(1, order + 1):
        arg = F.lit(2.0 * math.pi * k / period_days) * t
        out += [F.sin(arg).alias(f"{prefix}_sin{k}"), F.cos(arg).alias(f"{prefix}_cos{k}")]
    return out


def seasonal_design(frame: DataFrame, holidays: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """K5 design matrix: trend + yearly (10), weekly (3), daily (4) Fourier terms, holiday flag
    (left join on the day; ``holidays`` has a ``ds`` column), regressors."""
    ds = F.col("ds")
    t = (F.unix_micros(ds.cast("timestamp")).cast("double") / F.lit(86400e6)).alias("trend")
    terms = fourier_terms(ds, 365.25, 10, "yearly") + fourier_terms(ds, 7.0, 3, "weekly") \
        + fourier_terms(ds, 1.0, 4, "daily")
    d = frame.select("*", t, *terms)
    if holidays is not None:
        h = holidays.select(F.to_date("ds").alias("_day")).distinct().withColumn("holiday", F.lit(1.0))
        d = d.withColumn("_day", F.to_date("ds")).join(h, "_day", "left").drop("_day")
        d = d.withColumn("holiday", F.coalesce("holiday", F.lit(0.0)))
    cols = [c for c in d.columns if c not in ("ds", "y", "series_id", "split")]
    return d, cols


def train_seasonal(design: DataFrame, cols: list[str]) -> PipelineModel:
    """K5 (re-aimed): same inputs as the reference's additive model, fitted as a ridge-regularised
    linear model (trend and seasons of a short series are nearly collinear)."""
    asm = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol="y", regParam=0.1)
    return Pipeline(stages=[asm, lr]).fit(design.where(F.col("y").isNotNull()))


# ---- B14/B15/K7: request validation and batch scoring --------------------------------

def request_violations(req: DataFrame) -> Column:
    """Array of violated rule names (empty when the request is valid)."""
    c = F.col
    hi_pm = F.lit(S.REQUEST_PM_MAX)

    def outside(col, bounds):
        lo, hi = bounds
        return c(col).isNull() | (c(col) < lo) | (c(col) > hi)

    checks = [
        ("pm25_required", c("pm25").isNull()),
        ("pm25_range", (c("pm25") < 0) | (c("pm25") > hi_pm)),
        ("pm10_range", (c("pm10") < 0) | (c("pm10") > hi_pm)),
        ("no2_min", c("no2") < 0), ("so2_min", c("so2") < 0), ("co_min", c("co") < 0), ("o3_min", c("o3") < 0),
        ("hour_local_range", outside("hour_local", S.REQUEST_HOUR_RANGE)),
        ("day_of_week_range", outside("day_of_week", S.REQUEST_DOW_RANGE)),
        ("month_range", outside("month", S.REQUEST_MONTH_RANGE)),
        ("season_pattern", c("season").isNull() | ~c("season").rlike(S.SEASON_PATTERN)),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]))


def validate_requests(req: DataFrame) -> DataFrame:
    """Every request with ``violations`` and ``valid``; split downstream with a filter."""
    return req.withColumn("violations", request_violations(req)).withColumn(
        "valid", F.size("violations") == 0)


def scoring_features(req: DataFrame) -> DataFrame:
    """H18 + H19: missing pollutants -> 0.0, season one-hot (post_monsoon = all zeros)."""
    return req.select(
        "*",
        *[default_zero(c).alias(f"f_{c}") for c in ["pm10", "no2", "so2", "co", "o3"]],
        one_hot("season", "winter").alias("season_winter"),
        one_hot("season", "monsoon").alias("season_monsoon"),
        one_hot("season", "summer").alias("season_summer"))


SCORING_INPUTS = ["pm25", "f_pm10", "f_no2", "f_so2", "f_co", "f_o3", "hour_local", "day_of_week", "month",
                  "season_winter", "season_monsoon", "season_summer"]


def train_aqi_model(mart_rows: DataFrame) -> PipelineModel:
    """A model for the scoring path: AQI from the 12 request features, fitted on the mart."""
    d = scoring_features(mart_rows.where(F.col("pm25").isNotNull() & F.col("aqi_pm25").isNotNull()))
    asm = VectorAssembler(inputCols=SCORING_INPUTS, outputCol="features", handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol="aqi_pm25", regParam=0.0)
    return Pipeline(stages=[asm, lr]).fit(d)


@dataclass(frozen=True)
class FixedLinearModel:
    """A linear model given by its coefficients; scores like a fitted ``PipelineModel``.

    ``prediction = intercept + c1 * x1 + c2 * x2 + ...``, summed in the order given.
    """

    intercept: float
    coefficients: tuple[tuple[str, float], ...]

    def transform(self, df: DataFrame) -> DataFrame:
        out = F.lit(float(self.intercept))
        for name, c in self.coefficients:
            out = out + F.lit(float(c)) * F.col(name).cast("double")
        return df.withColumn("prediction", out)


def score_requests(req: DataFrame, model, version: str = S.MODEL_VERSION, keys=("request_id",)) -> DataFrame:
    """K7: every request once.  Valid ones are scored: AQI (rounded to 1), category from the
    unrounded value (H16), confidence (H17), model version; rejected ones come back with their
    violated rules in ``violations`` and NULL results."""
    v = validate_requests(req)
    results = {"aqi_predicted": F.round("prediction", 1), "aqi_category": A.category_from_aqi("prediction"),
               "confidence": A.confidence("pm10", "no2"), "model_version": F.lit(version)}
    scored = model.transform(scoring_features(v.where("valid")))
    scored = scored.select(*keys, "violations", *[c.alias(n) for n, c in results.items()])
    return scored.unionByName(v.where("NOT valid").select(*keys, "violations"), allowMissingColumns=True)


def input_violations(df: DataFrame, inputs=None) -> Column:
    """B15 for the 12 nowcast inputs: names of the rules that a row breaks.  A field the table lacks is
    ``<field>:missing``; one that is no number ``<field>:type``; a NULL ``<field>:null``."""
    checks = []
    for c in inputs or S.NOWCAST_FEATURES:
        if c not in df.columns:
            checks.append(F.lit(f"{c}:missing"))
        elif not isinstance(df.schema[c].dataType, T.NumericType):
            number = F.expr(f"try_cast(`{c}` AS double)")
            checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}:null")).when(number.isNull(), F.lit(f"{c}:type")))
        else:
            checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}:null")))
    return F.array_compact(F.array(*checks))


# ---- K8: nowcast ----------------------------------------------------------------------

def complete_vectors(df: DataFrame, cols=None) -> tuple[DataFrame, DataFrame]:
    """(rows with all model inputs present, rows skipped for a NULL input)."""
    cols = cols or S.NOWCAST_FEATURES
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    return df.where(~bad), df.where(bad)


def nowcast_backfill(features: DataFrame, model: PipelineModel, series=("series_id",),
                     block_rows: int = ser.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """K8 over every hour and series at once: B13 guard, predict, round to 2 (H20), pair with
    the next hour's forecast (C4, by position), WHO flag (H22).  The result feeds the upsert."""
    series = list(series)
    d = ser.with_position(features, series, ["datetime"])
    d = ser.add_leads(d, series, "pm2_5", {"pm2_5_next": 1}, block_rows)
    ok, _ = complete_vectors(d)
    scored = model.transform(ok)
    pred = F.round("prediction", 2)
    return scored.select(*series, "datetime", F.round("pm2_5", 2).alias("pm25_observe"),
                         pred.alias("pm25_xgboost"), F.round("pm2_5_next", 2).alias("pm25_cams"),
                         A.exceeds_who(pred).alias("depasse_oms"))
