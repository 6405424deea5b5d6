"""Dashboard panels over the predictions table.

Every panel takes ``asof`` explicitly (the reference used the wall clock).  The
"latest" panels use ``max_by`` (one partial aggregate per task) or a bounded
``TakeOrderedAndProject`` for the top-k history; neither sorts the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions import aqi as A
from airshed.functions.misc import abs_error


def trailing(pred: DataFrame, asof: Column, hours: int = 48, t: str = "datetime") -> DataFrame:
    """Rows at or after ``asof - hours`` (inclusive; no upper bound, as the panels)."""
    return pred.where(F.col(t) >= asof - F.make_dt_interval(F.lit(0), F.lit(hours)))


SERIES = ("series_id",)


def latest_values(pred: DataFrame, t: str = "datetime", series=SERIES) -> DataFrame:
    """E4 + K10 stat/gauge panels: each series' newest observed, model and forecast values, gauge band."""
    row = pred.groupBy(*series).agg(F.max_by(F.struct("pm25_observe", "pm25_xgboost", "pm25_cams"), F.col(t)).alias("r"),
                   F.max(t).alias(t))
    return row.select(*series, t, "r.pm25_observe", "r.pm25_xgboost", "r.pm25_cams",
                      A.pm25_band(F.col("r.pm25_observe")).alias("gauge_band"))


def exceedances(pred: DataFrame, asof: Column, hours: int = 48, series=SERIES) -> DataFrame:
    """Each series' number of exceedance flags in the trailing window."""
    return trailing(pred, asof, hours).groupBy(*series).agg(F.count_if(F.col("depasse_oms")).alias("exceedances"))


def benchmark(pred: DataFrame, asof: Column, hours: int = 48, series=SERIES) -> DataFrame:
    """K9/F2: observed vs model vs forecast over the trailing window, oldest first."""
    return (trailing(pred, asof, hours)
            .select(*series, F.col("datetime").alias("time"), "pm25_observe", "pm25_xgboost", "pm25_cams")
            .orderBy("time", *series))


def abs_errors(pred: DataFrame, asof: Column, hours: int = 48, series=SERIES) -> DataFrame:
    """Absolute errors of model and forecast over the trailing window."""
    return (trailing(pred, asof, hours)
            .select(*series, F.col("datetime").alias("time"),
                    abs_error("pm25_observe", "pm25_xgboost").alias("error_xgboost"),
                    abs_error("pm25_observe", "pm25_cams").alias("error_cams"))
            .orderBy("time", *series))


def history(pred: DataFrame, n: int = 20, series=SERIES) -> DataFrame:
    """F1 + H23: newest ``n`` predictions with gap and status label (top-k, no full sort); ties in
    time go by series."""
    return (pred.orderBy(F.col("datetime").desc(), *series).limit(n)
            .select(*series, "datetime", "pm25_observe", "pm25_xgboost", "pm25_cams",
                    abs_error("pm25_observe", "pm25_xgboost").alias("gap_xgboost"),
                    A.status_label("depasse_oms").alias("status")))


def error_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """K6: RMSE, MAE and R2 in one aggregation over rows where both are present.

    ``R2 = 1 - SSE / (n * var_pop(y))``; NULL for a constant target.
    """
    d = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    e = F.col(y) - F.col(yhat)
    sst = F.var_pop(y) * F.count(F.lit(1))
    return d.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.sqrt(F.avg(e * e)), 9).alias("rmse"),
                 F.round(F.avg(F.abs(e)), 9).alias("mae"),
                 F.round(F.lit(1.0) - F.sum(e * e) / F.when(sst != 0, sst), 9).alias("r2"))
