"""Queries of the exploratory-statistics layer (B11, D8-D17, E8, E9, F4) on the feature table."""

from __future__ import annotations

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_series import feeds
from airshed.plans import features as FE
from airshed.plans import stats as ST
from airshed.session import shared_path, table_path

NUMERIC = ["pm2p5", "pm10", "no2", "temp_c", "vent_kmh", "blh_m", "heure", "jour_semaine", "mois",
           "est_weekend", "pm2p5_lag_1h", "pm2p5_lag_2h", "pm2p5_lag_24h", "pm2p5_rolling_3h",
           "pm2p5_rolling_24h"]
WEATHER = ["temp_c", "vent_kmh", "blh_m", "no2"]
REALTIME_COLS = ["datetime", "pm2_5", "pm10", "no2", "temp_c", "vent_kmh", "blh_m", "heure",
                 "jour_semaine", "mois", "est_weekend", "pm2p5_lag_1h", "pm2p5_lag_2h", "pm2p5_lag_24h"]


_PROCESSED: dict = {}


def _version(spark, path: str) -> tuple:
    """Files, bytes and newest change of a table, from its file system's listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    total = fs.getContentSummary(hadoop)
    return total.getFileCount(), total.getLength(), fs.getFileStatus(hadoop).getModificationTime()


def feature_table(spark, sf_dir):
    """The processed feature table (E12 output, series key kept), as the EDA and the trainers
    read it: the batch pipeline writes it once to shared storage (A8), readers scan the file.  It is
    built anew when the events it comes from have changed."""
    key = (spark.sparkContext.applicationId, sf_dir, *_version(spark, table_path(sf_dir, "events")))
    if key not in _PROCESSED:
        path = shared_path(spark, "processed-features")
        FE.batch_features(FE.clean_and_merge(*feeds(spark, sf_dir))).write.parquet(path)
        _PROCESSED[key] = path
    return spark.read.parquet(_PROCESSED[key])


def _f(spark, sf_dir):
    return feature_table(spark, sf_dir).drop("series_id")


@register("d8_mean_std_by_hour", X.FEATURES + """
SELECT heure, round(avg(pm2p5), 9) AS mean, round(stddev_samp(pm2p5), 9) AS std,
       round(avg(pm2p5) - stddev_samp(pm2p5), 9) AS band_low, round(avg(pm2p5) + stddev_samp(pm2p5), 9) AS band_high
FROM features GROUP BY heure""")
def d8_mean_std_by_hour(spark, sf_dir):
    """Mean and sample std of pm2p5 per hour with the +-1 std band."""
    return ST.mean_std_by(_f(spark, sf_dir), "heure")


@register("d9_mean_by_weekday", X.FEATURES + """
SELECT jour_semaine, round(avg(pm2p5), 9) AS mean, jour_semaine >= 5 AS is_weekend
FROM features GROUP BY jour_semaine""")
def d9_mean_by_weekday(spark, sf_dir):
    """Mean pm2p5 per weekday (Monday=0) with weekend label."""
    return ST.mean_by_weekday(_f(spark, sf_dir))


@register("d10_mean_by_month", X.FEATURES + "\nSELECT mois, round(avg(pm2p5), 9) AS mean FROM features GROUP BY mois")
def d10_mean_by_month(spark, sf_dir):
    """Mean pm2p5 per month."""
    return ST.mean_by(_f(spark, sf_dir), "mois")


@register("d11_describe_pm25", X.FEATURES + """
SELECT stat, round(value, 9) AS value FROM (
  SELECT 'count' AS stat, CAST(count(pm2p5) AS DOUBLE) AS value FROM features UNION ALL
  SELECT 'mean', avg(pm2p5) FROM features UNION ALL
  SELECT 'std', stddev_samp(pm2p5) FROM features UNION ALL
  SELECT 'min', min(pm2p5) FROM features UNION ALL
  SELECT '25%', quantile_cont(pm2p5, 0.25) FROM features UNION ALL
  SELECT '50%', quantile_cont(pm2p5, 0.5) FROM features UNION ALL
  SELECT '75%', quantile_cont(pm2p5, 0.75) FROM features UNION ALL
  SELECT 'max', max(pm2p5) FROM features)""")
def d11_describe_pm25(spark, sf_dir):
    """Describe (count, mean, std, min, exact quartiles, max) of pm2p5."""
    return ST.describe(_f(spark, sf_dir), "pm2p5")


_RT_SQL = "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f""",
rt AS (SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM merged_full)"""


@register("d12_null_ratios", _RT_SQL + "\nSELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS DOUBLE)), 9) AS null_ratio FROM rt"
    for c in REALTIME_COLS) + ") WHERE null_ratio > 0")
def d12_null_ratios(spark, sf_dir):
    """NULL share per column of the realtime feature frame, > 0 only, top 20."""
    return ST.null_ratios(FE.realtime_features(*feeds(spark, sf_dir)).drop("series_id"))


@register("d13_shape", X.FEATURES + f"\nSELECT count(*) AS n_rows, CAST({len(NUMERIC) + 1} AS BIGINT) AS n_columns FROM features")
def d13_shape(spark, sf_dir):
    """Rows and columns of the feature table."""
    return ST.shape(_f(spark, sf_dir))


def _corr_sql(x: str, y: str) -> str:
    a = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    b = f"CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    den = f"(stddev_pop({a}) * stddev_pop({b}))"
    return f"covar_pop({a}, {b}) / CASE WHEN {den} != 0 THEN {den} END"


@register("d14_corr_with_target", X.FEATURES + "\nSELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round({_corr_sql('pm2p5', c)}, 9) AS corr FROM features" for c in WEATHER) + ")")
def d14_corr_with_target(spark, sf_dir):
    """Pearson correlation of pm2p5 with the weather columns (constant-safe)."""
    return ST.corr_with_target(_f(spark, sf_dir), "pm2p5", WEATHER)


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]
_MATRIX_SQL = X.FEATURES + ",\ncm AS (SELECT " + ", ".join(
    f"{_corr_sql(a, b)} AS c{k}" for k, (a, b) in enumerate(_PAIRS)) + " FROM features)\n" + "\nUNION ALL\n".join(
    [f"SELECT '{a}' AS row, '{b}' AS col, round(c{k}, 9) AS corr FROM cm" for k, (a, b) in enumerate(_PAIRS)]
    + [f"SELECT '{b}' AS row, '{a}' AS col, round(c{k}, 9) AS corr FROM cm" for k, (a, b) in enumerate(_PAIRS) if a != b])


@register("d15_corr_matrix_top15", _MATRIX_SQL)
def d15_corr_matrix_top15(spark, sf_dir):
    """Correlation matrix of the 15 columns most correlated with pm2p5 (one pass)."""
    return ST.corr_matrix_top(_f(spark, sf_dir), "pm2p5", NUMERIC, 15)


@register("d16_histogram_60", X.FEATURES + """,
mm AS (SELECT min(pm2p5) AS mn, max(pm2p5) AS mx FROM features),
cnt AS (SELECT coalesce(least(CAST(floor((pm2p5 - mn) / CASE WHEN mx > mn THEN mx - mn END * 60.0) AS INTEGER), 59), 0) AS bin,
               count(*) AS n FROM features, mm WHERE pm2p5 IS NOT NULL GROUP BY 1)
SELECT CAST(b.range AS INTEGER) AS bin, round(mn + CAST(b.range AS INTEGER) * ((mx - mn) / 60.0), 9) AS lo,
       round(mn + (CAST(b.range AS INTEGER) + 1) * ((mx - mn) / 60.0), 9) AS hi,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS count
FROM range(60) b CROSS JOIN mm LEFT JOIN cnt ON cnt.bin = b.range""")
def d16_histogram_60(spark, sf_dir):
    """60-bin equal-width histogram of pm2p5 (max in the last bin, empty bins 0)."""
    return ST.histogram(_f(spark, sf_dir), "pm2p5", 60)


@register("d17_daily_mean", X.FEATURES + """,
days AS (SELECT unnest(generate_series(min(date_trunc('day', datetime)), max(date_trunc('day', datetime)), INTERVAL 1 DAY)) AS day FROM features),
means AS (SELECT date_trunc('day', datetime) AS day, avg(pm2p5) AS mean FROM features GROUP BY 1)
SELECT CAST(days.day AS TIMESTAMP) AS day, round(means.mean, 9) AS mean FROM days LEFT JOIN means ON days.day = means.day""")
def d17_daily_mean(spark, sf_dir):
    """Daily resample mean with empty days kept (NULL)."""
    return ST.daily_mean(_f(spark, sf_dir))


@register("b11_trailing_90_days", X.FEATURES + """
SELECT series_id, datetime, pm2p5 FROM features WHERE datetime >= (SELECT max(datetime) FROM features) - INTERVAL 90 DAY""")
def b11_trailing_90_days(spark, sf_dir):
    """Rows within 90 days of the latest timestamp."""
    return ST.trailing_days(feature_table(spark, sf_dir), 90).select("series_id", "datetime", "pm2p5")


def _lag_sums_sql(nlags: int) -> str:
    """CTEs ``yv``, ``lagged`` and ``sums``: centred values and their lag products per series."""
    lags = ", ".join(f"lag(y, {k}) OVER (PARTITION BY series_id ORDER BY datetime) AS l{k}" for k in range(1, nlags + 1))
    sums = ", ".join(["sum(y * y) AS s0"] + [f"sum(y * l{k}) AS s{k}" for k in range(1, nlags + 1)])
    return f""",
yv AS (SELECT series_id, datetime, pm2p5 - avg(pm2p5) OVER (PARTITION BY series_id) AS y FROM features WHERE pm2p5 IS NOT NULL),
lagged AS (SELECT series_id, y, {lags} FROM yv),
sums AS (SELECT series_id, count(*) AS n, {sums} FROM lagged GROUP BY series_id)"""


def _acf_sql(nlags: int = 72) -> str:
    long = "\nUNION ALL\n".join(f"SELECT series_id, {k} AS lag, s{k} / s0 AS acf, n FROM sums" for k in range(nlags + 1))
    return X.FEATURES + _lag_sums_sql(nlags) + f""",
acf AS ({long}),
bounds AS (
  SELECT series_id, lag, acf, CASE WHEN lag = 0 THEN 0.0 WHEN lag = 1 THEN 1.0 / n
         ELSE (1.0 + 2.0 * (coalesce(sum(acf * acf) OVER (PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) - 1.0)) / n END AS var
  FROM acf)
SELECT series_id, lag, round(acf, 9) AS acf, round(acf - {ST.Z95} * sqrt(var), 9) AS lo95,
       round(acf + {ST.Z95} * sqrt(var), 9) AS hi95 FROM bounds"""


@register("e8_acf_72", _acf_sql(72))
def e8_acf_72(spark, sf_dir):
    """Autocorrelation of pm2p5 at lags 0..72 with Bartlett 95 % bounds (blocked lags), per series."""
    return ST.acf(feature_table(spark, sf_dir), FE.SERIES, [FE.TIME], "pm2p5", 72)


def _pacf_sql(nlags: int = 72) -> str:
    """Durbin-Levinson as a recursive CTE over the autocovariance sums (lists are 1-based)."""
    rho = ", ".join(f"(s{k} / (n - {k})) / (s0 / (n - 0))" for k in range(nlags + 1))
    num = "(r[m + 2] - list_sum(list_transform(range(m), lambda j: phi[j + 1] * r[m - j + 1])))"
    den = "(1.0 - list_sum(list_transform(range(m), lambda j: phi[j + 1] * r[j + 2])))"
    pkk = f"({num} / {den})"
    return "WITH RECURSIVE " + X.FEATURES[len("WITH "):] + _lag_sums_sql(nlags) + f""",
rho AS (SELECT series_id, n, [{rho}] AS r FROM sums WHERE n > {nlags}),
dl(series_id, m, phi, pkk, r, n) AS (
  SELECT series_id, 1, [r[2]], r[2], r, n FROM rho
  UNION ALL
  SELECT series_id, m + 1, list_transform(range(m), lambda j: phi[j + 1] - {pkk} * phi[m - j]) || [{pkk}], {pkk}, r, n
  FROM dl WHERE m < {nlags}
)
SELECT series_id, CAST(0 AS INTEGER) AS lag, CAST(1.0 AS DOUBLE) AS pacf, CAST(1.0 AS DOUBLE) AS lo95, CAST(1.0 AS DOUBLE) AS hi95 FROM rho
UNION ALL
SELECT series_id, CAST(m AS INTEGER) AS lag, round(pkk, 9) AS pacf, round(pkk - {ST.Z95} / sqrt(n), 9) AS lo95,
       round(pkk + {ST.Z95} / sqrt(n), 9) AS hi95 FROM dl"""


@register("e9_pacf_yw_72", _pacf_sql(72))
def e9_pacf_yw_72(spark, sf_dir):
    """Partial autocorrelation (Yule-Walker, adjusted) at lags 0..72 per series; the oracle runs the
    same recursion as a recursive CTE."""
    return ST.pacf_yule_walker(feature_table(spark, sf_dir), FE.SERIES, [FE.TIME], "pm2p5", 72)


@register("f4_preview_5", X.FEATURES_RAW + """
SELECT series_id, datetime, """ + ", ".join(
    f"{X.spark_round(c, 2)} AS {c}" if c in
    ("pm2p5", "pm10", "no2", "temp_c", "vent_kmh", "blh_m", "pm2p5_lag_1h", "pm2p5_lag_2h", "pm2p5_lag_24h",
     "pm2p5_rolling_3h", "pm2p5_rolling_24h") else c for c in NUMERIC) + """
FROM features ORDER BY datetime, series_id LIMIT 5""")
def f4_preview_5(spark, sf_dir):
    """first 5 rows by time, floats rounded to 2 decimals."""
    return ST.preview(feature_table(spark, sf_dir), ["datetime", "series_id"], 5, 2)
