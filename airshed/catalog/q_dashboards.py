"""Queries of the dashboard layer over the predictions table (FIXTURES M3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_series import ASOF, feeds
from airshed.operators import dedup
from airshed.operators import series as ser
from airshed.plans import dashboards as DB
from airshed.plans import nowcast as NC

UPSERT_OLD_BEFORE = "2024-01-21 00:00:00"
UPSERT_NEW_FROM = "2024-01-15 00:00:00"

PRED_SQL = "WITH " + X.AIR + f""",
pred AS (
  SELECT series_id, datetime, {X.spark_round("pm2_5", 2)} AS pm25_observe,
         {X.spark_round("lag(pm2_5, 1) OVER (PARTITION BY series_id ORDER BY datetime)", 2)} AS pm25_xgboost,
         {X.spark_round("pm10", 2)} AS pm25_cams
  FROM air
),
predictions AS (SELECT *, pm25_xgboost > 15.0 AS depasse_oms FROM pred)"""

W48 = f"datetime >= TIMESTAMP '{ASOF}' - INTERVAL 48 HOUR"
BAND = ("CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 15.0 THEN 'green' WHEN {x} < 25.0 THEN 'yellow' "
        "WHEN {x} < 35.0 THEN 'red' ELSE 'dark_red' END")


def predictions(spark, sf_dir):
    air, _ = feeds(spark, sf_dir)
    return NC.persistence_predictions(air)


def _asof():
    return F.lit(ASOF).cast("timestamp_ntz")


@register("m3_predictions", PRED_SQL + "\nSELECT * FROM predictions")
def m3_predictions(spark, sf_dir):
    """H20 + H22: predictions table (persistence model, rounded, WHO exceedance flag)."""
    return predictions(spark, sf_dir)


@register("k10_latest_values", PRED_SQL + """
SELECT series_id, datetime, pm25_observe, pm25_xgboost, pm25_cams, """ + BAND.format(x="pm25_observe") + """ AS gauge_band
FROM predictions QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) = 1""")
def k10_latest_values(spark, sf_dir):
    """E4 (global) + K10 stat and gauge panels + H24 band."""
    return DB.latest_values(predictions(spark, sf_dir))


@register("k10_exceedances_48h", PRED_SQL + f"""
SELECT series_id, count_if(depasse_oms) AS exceedances FROM predictions WHERE {W48} GROUP BY series_id""")
def k10_exceedances_48h(spark, sf_dir):
    """B10 + D3 + K10: exceedances in the trailing 48 hours."""
    return DB.exceedances(predictions(spark, sf_dir), _asof(), 48)


@register("k9_benchmark_48h", PRED_SQL + f"""
SELECT series_id, datetime AS time, pm25_observe, pm25_xgboost, pm25_cams FROM predictions WHERE {W48} ORDER BY time, series_id""")
def k9_benchmark_48h(spark, sf_dir):
    """K9 + F2: observed vs model vs forecast, trailing 48 h, ascending."""
    return DB.benchmark(predictions(spark, sf_dir), _asof(), 48)


@register("k10_abs_errors_48h", PRED_SQL + f"""
SELECT series_id, datetime AS time, abs(pm25_observe - pm25_xgboost) AS error_xgboost,
       abs(pm25_observe - pm25_cams) AS error_cams
FROM predictions WHERE {W48} ORDER BY time, series_id""")
def k10_abs_errors_48h(spark, sf_dir):
    """H21 + K10: absolute errors, trailing 48 h."""
    return DB.abs_errors(predictions(spark, sf_dir), _asof(), 48)


@register("f1_history_top20", PRED_SQL + """
SELECT series_id, datetime, pm25_observe, pm25_xgboost, pm25_cams, abs(pm25_observe - pm25_xgboost) AS gap_xgboost,
       CASE WHEN depasse_oms THEN '🔴 OMS!' ELSE '🟢 OK' END AS status
FROM predictions ORDER BY datetime DESC, series_id LIMIT 20""")
def f1_history_top20(spark, sf_dir):
    """F1 + H23: newest 20 predictions with status label."""
    return DB.history(predictions(spark, sf_dir), 20)


@register("k6_error_metrics", PRED_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n_all FROM predictions),
test AS (SELECT * FROM ranked WHERE pos >= floor(0.8 * n_all) AND pm25_observe IS NOT NULL AND pm25_xgboost IS NOT NULL)
SELECT count(*) AS n, round(sqrt(avg((pm25_observe - pm25_xgboost) * (pm25_observe - pm25_xgboost))), 9) AS rmse,
       round(avg(abs(pm25_observe - pm25_xgboost)), 9) AS mae,
       round(1.0 - sum((pm25_observe - pm25_xgboost) * (pm25_observe - pm25_xgboost))
             / CASE WHEN var_pop(pm25_observe) * count(*) != 0 THEN var_pop(pm25_observe) * count(*) END, 9) AS r2
FROM test""")
def k6_error_metrics(spark, sf_dir):
    """E11 + K6: RMSE, MAE, R2 of the model on the chronological test split (last 20 %)."""
    p = predictions(spark, sf_dir)
    d = ser.chrono_split(ser.with_position(p, ["series_id"], ["datetime"]), ["series_id"], 0.8)
    return DB.error_metrics(d.where(F.col("split") == "test"), "pm25_observe", "pm25_xgboost")


@register("a11_upsert_predictions", PRED_SQL + f""",
old AS (SELECT * FROM predictions WHERE datetime < TIMESTAMP '{UPSERT_OLD_BEFORE}'),
new AS (SELECT series_id, datetime, pm25_observe + 1.0 AS pm25_observe, pm25_xgboost + 1.0 AS pm25_xgboost,
               pm25_cams + 1.0 AS pm25_cams, pm25_xgboost + 1.0 > 15.0 AS depasse_oms
        FROM predictions WHERE datetime >= TIMESTAMP '{UPSERT_NEW_FROM}')
SELECT * FROM new UNION ALL SELECT * FROM old WHERE (series_id, datetime) NOT IN (SELECT (series_id, datetime) FROM new)""")
def a11_upsert_predictions(spark, sf_dir):
    """Insert-or-update on (series, hour) (later batch wins), as ON CONFLICT DO UPDATE."""
    p = predictions(spark, sf_dir)
    old = p.where(F.col("datetime") < F.lit(UPSERT_OLD_BEFORE).cast("timestamp_ntz"))
    new = (p.where(F.col("datetime") >= F.lit(UPSERT_NEW_FROM).cast("timestamp_ntz"))
           .select("series_id", "datetime", *[(F.col(c) + 1.0).alias(c) for c in ("pm25_observe", "pm25_xgboost", "pm25_cams")])
           .withColumn("depasse_oms", F.col("pm25_xgboost") > 15.0))
    return dedup.upsert(old, new, ["series_id", "datetime"])
