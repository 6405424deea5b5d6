"""K5: an additive model for each series: piecewise-linear trend, Fourier seasons, holidays, regressors.

    y = level + slope t + sum of bends at changepoints + yearly, weekly, daily seasons + holiday + regressors

Fitted for all series at once from sufficient statistics.  One aggregation gives each series' time range and the scale of its
columns.  With these every row's design vector is a plain Spark expression; each task adds up the Gram matrix of its rows for each
series it meets, the matrices are summed in two steps (so a series that is spread over all tasks still meets in bounded groups), and the normal
equations of a series, some 70 numbers square, are solved where its last sum is made.  Neither rows nor matrices reach the
driver, and a series may have any number of rows.

The fit is the most probable one under normal priors, which is a ridge regression with a penalty of its own for each kind of
column (``PRIOR``: the standard deviations of scaled coefficients).  Level and slope are free.  ``CHANGEPOINTS`` lie at equal distances over
the first ``CHANGE_RANGE`` of a series' training time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.session import materialize

#: Seasons as (name, days, order), as the reference's library has them by default.
SEASONS = [("yearly", 365.25, 10), ("weekly", 7.0, 3), ("daily", 1.0, 4)]
CHANGEPOINTS, CHANGE_RANGE = 25, 0.8
PRIOR = {"level": None, "slope": None, "bend": 0.05, "season": 10.0, "holiday": 10.0, "regressor": 10.0}
#: Standard deviation of the noise in scaled units that the penalties are stated against.
NOISE = 0.1
#: Series whose matrices a task holds at a time.
HELD = 512
SPREAD = 64


def columns(regressors: list[str]) -> list[tuple[str, str]]:
    """(name, kind) of each entry of the design vector."""
    out = [("level", "level"), ("slope", "slope")] + [(f"bend_{i}", "bend") for i in range(CHANGEPOINTS)]
    for name, _, order in SEASONS:
        out += [(f"{name}_{f}{k}", "season") for k in range(1, order + 1) for f in ("sin", "cos")]
    return out + [("holiday", "holiday")] + [(r, "regressor") for r in regressors]


def _days(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp")).cast("double") / F.lit(86400e6)


def scales(train: DataFrame, regressors: list[str], series=("series_id",)) -> DataFrame:
    """One row a series: ``_begin`` and ``_span`` of its training time in days, ``_size`` of y, mean and deviation of each regressor."""
    aggs = [F.min(_days("ds")).alias("_begin"), (F.max(_days("ds")) - F.min(_days("ds"))).alias("_span"), F.max(F.abs("y")).alias("_size"), F.count("y").alias("n_train")]
    for r in regressors:
        aggs += [F.avg(F.col(r).cast("double")).alias(f"_m_{r}"), F.stddev_pop(F.col(r).cast("double")).alias(f"_s_{r}")]
    d = train.where(F.col("y").isNotNull()).groupBy(*series).agg(*aggs)
    # constant columns keep their distance from the mean (nought); a series of one moment has no span
    fix = {c: F.when(F.col(c) > 0, F.col(c)).otherwise(1.0) for c in ["_span", "_size", *[f"_s_{r}" for r in regressors]]}
    return d.withColumns(fix)


def design(rows: DataFrame, scale: DataFrame, regressors: list[str], holidays: DataFrame | None, series=("series_id",)) -> DataFrame:
    """``rows`` of the series in ``scale`` with ``_x``, the design vector (null if a regressor is), and the scales."""
    d = rows.join(scale, list(series))
    if holidays is not None:
        h = holidays.select(F.to_date("ds").alias("_day")).distinct().withColumn("_holiday", F.lit(1.0))
        d = d.withColumn("_day", F.to_date("ds")).join(h, "_day", "left").drop("_day")
    else:
        d = d.withColumn("_holiday", F.lit(0.0))
    t = (_days("ds") - F.col("_begin")) / F.col("_span")
    x = [F.lit(1.0), t] + [F.greatest(t - F.lit(CHANGE_RANGE * (i + 1) / (CHANGEPOINTS + 1)), F.lit(0.0)) for i in range(CHANGEPOINTS)]
    for _, days, order in SEASONS:
        for k in range(1, order + 1):
            angle = F.lit(2.0 * math.pi * k / days) * _days("ds")
            x += [F.sin(angle), F.cos(angle)]
    x.append(F.coalesce("_holiday", F.lit(0.0)))
    x += [(F.col(r).cast("double") - F.col(f"_m_{r}")) / F.col(f"_s_{r}") for r in regressors]
    vector = F.array(*x)
    return d.withColumn("_x", F.when(~F.exists(vector, lambda v: v.isNull()), vector)).drop("_holiday")


def gram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sums of products of (x, y) with itself."""
    z = np.column_stack([x, y])
    return z.T @ z


def solve(g: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Coefficients from the sums; a singular system gives the smallest of its solutions."""
    a, b = g[:-1, :-1] + np.diag(penalty), g[:-1, -1]
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, b, rcond=None)[0]


def penalties(regressors: list[str]) -> np.ndarray:
    return np.array([0.0 if PRIOR[k] is None else (NOISE / PRIOR[k]) ** 2 for _, k in columns(regressors)]) + 1e-9


def fit(designed: DataFrame, regressors: list[str], series: str = "series_id") -> DataFrame:
    """One row a series with ``coefficients`` (of scaled y, in the order of ``columns``); ``designed``: training rows."""
    width, fixed = len(columns(regressors)) + 1, penalties(regressors)
    kind = designed.schema[series].dataType.simpleString()
    rows = designed.where(F.col("_x").isNotNull() & F.col("y").isNotNull()).select(series, "_x", (F.col("y") / F.col("_size")).alias("_y"))

    def sums(batches):
        held: dict = {}

        def out():
            keys = list(held)
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array([held[k].ravel() for k in keys], pa.list_(pa.float64()))], names=[series, "sums"])
            held.clear()

        b = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.array(b.column(0).to_pylist(), dtype=object)
            x = b.column(1).values.to_numpy(zero_copy_only=False).reshape(b.num_rows, width - 1)
            y = b.column(2).to_numpy(zero_copy_only=False)
            for k in dict.fromkeys(keys.tolist()):
                mine = keys == k
                g = gram(x[mine], y[mine])
                held[k] = held[k] + g if k in held else g
            if len(held) > HELD:
                yield from out()
        if held:
            yield from out()

    def added(pdf: pd.DataFrame) -> np.ndarray:
        return np.sum(np.stack(pdf["sums"].to_numpy()), axis=0)

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({series: [pdf[series].iloc[0]], "sums": [added(pdf)]})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({series: [pdf[series].iloc[0]], "coefficients": [solve(added(pdf).reshape(width, width), fixed)]})

    partial = rows.mapInArrow(sums, f"{series} {kind}, sums array<double>")
    merged = partial.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).groupBy(series, "_part").applyInPandas(part, f"{series} {kind}, sums array<double>")
    return merged.groupBy(series).applyInPandas(whole, f"{series} {kind}, coefficients array<double>")


def train_additive(train: DataFrame, regressors: list[str], holidays: DataFrame | None = None, series: str = "series_id") -> DataFrame:
    """The models as a table, one row a series: scales and coefficients.  Written, so that scoring does not fit again."""
    scale = materialize(scales(train, regressors, (series,)))
    models = fit(design(train, scale, regressors, holidays, (series,)), regressors, series)
    return materialize(scale.join(models, series))


def forecast(rows: DataFrame, models: DataFrame, regressors: list[str], holidays: DataFrame | None = None, series: str = "series_id") -> DataFrame:
    """``rows`` of the modelled series with ``yhat`` (null where a regressor is)."""
    scale_columns = [c for c in models.columns if c not in rows.columns or c == series]
    d = design(rows, models.select(*scale_columns), regressors, holidays, (series,))
    dot = F.aggregate(F.zip_with("_x", "coefficients", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return d.withColumn("yhat", dot * F.col("_size")).select(*rows.columns, "yhat", "n_train")


def accuracy(scored: DataFrame, truth: str = "y", guess: str = "yhat", series=("series_id",)) -> DataFrame:
    """Rows, RMSE, MAE and R2 of each series (R2 null where the truth is constant)."""
    e = F.col(truth) - F.col(guess)
    d = scored.where(F.col(truth).isNotNull() & F.col(guess).isNotNull())
    spread = F.var_pop(truth)
    return d.groupBy(*series).agg(F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                                  (1 - F.avg(e * e) / F.when(spread > 0, spread)).alias("r2"))
