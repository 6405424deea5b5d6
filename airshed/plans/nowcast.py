"""Realtime nowcast job (B8, B9, B13, C4, E4-E6, H22, K8) over all series at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.operators import series as ser
from airshed.plans import features as FE


def latest_window(feed: DataFrame, asof: Column, hours: int = 48) -> DataFrame:
    """B8 + E5: rows at or before ``asof`` (already floored to the hour), each series' last ``hours``.

    A bounded ``row_number``: every task cuts each of its series to ``hours`` rows before the only
    shuffle (WindowGroupLimit), so a long series never meets in one task.
    """
    return _first_rows(feed.where(F.col(FE.TIME) <= asof), F.col(FE.TIME).desc(), hours)


def _first_rows(feed: DataFrame, order: Column, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*FE.SERIES).orderBy(order))
    return feed.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def forecast_head(feed: DataFrame, asof: Column, hours: int = 24, value: str = "pm2_5",
                  out: str = "pm2_5_cams") -> DataFrame:
    """B9 + E6: rows strictly after ``asof``, each series' first ``hours``, value renamed."""
    d = _first_rows(feed.where(F.col(FE.TIME) > asof), F.col(FE.TIME).asc(), hours)
    return d.select(*FE.SERIES, FE.TIME, F.col(value).alias(out))


def persistence_predictions(air: DataFrame, block_rows: int = ser.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Predictions table (FIXTURES M3) from the hourly air feed.

    ``pm25_xgboost`` is the persistence forecast (previous hour's observation by position),
    ``pm25_cams`` the pm10 column; values rounded to 2 decimals as the reference stores
    them; ``depasse_oms`` = prediction strictly above the WHO limit (H22).
    """
    d = ser.with_position(air, FE.SERIES, [FE.TIME])
    d = ser.add_lags(d, FE.SERIES, "pm2_5", {"_prev": 1}, block_rows)
    pred = F.round("_prev", 2)
    return d.select(*FE.SERIES, F.col(FE.TIME).alias("datetime"),
                    F.round("pm2_5", 2).alias("pm25_observe"), pred.alias("pm25_xgboost"),
                    F.round("pm10", 2).alias("pm25_cams"),
                    (pred > F.lit(S.WHO_PM25_LIMIT)).alias("depasse_oms"))
