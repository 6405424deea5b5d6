"""End-to-end runs of the lifecycle jobs over data landed from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.catalog import ORACLE, register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_quality import ASOF_CONTRACT
from airshed.catalog.q_ml import NOWCAST_MODEL, XGB_COLS, linear_sql
from airshed.catalog.q_series import feeds
from airshed.catalog.q_stats import WEATHER, _corr_sql, feature_table  # its SQL gives the report's panels
from airshed.operators import dedup
from airshed.plans import features as FE
from airshed.plans import runs as R
from airshed.plans import stats as ST
from airshed.session import shared_path
from airshed.sources import csv_tables as C
from airshed.sources import driver_tables as D
from airshed.sources import json_feed as JF
from airshed.sources import sinks as K


def land_csv(spark, sf_dir) -> tuple[str, str, str]:
    """Stations, measurements and latest snapshot landed as header CSV (the reference's inputs)."""
    m = D.measurements(spark, sf_dir)
    return (C.write_csv(D.stations_from_measurements(m), shared_path(spark, "land-stations")),
            C.write_csv(m, shared_path(spark, "land-measurements")),
            C.write_csv(dedup.latest_snapshot(D.with_station_names(m)), shared_path(spark, "land-latest")))


def land_payloads(spark, sf_dir) -> tuple[str, str]:
    """Hourly air and weather feeds landed as columnar JSON payloads, one per series and day."""
    air, weather = feeds(spark, sf_dir)
    paths = []
    for df, cols, name in ((air, S.AIR_FEED_COLUMNS, "land-air"), (weather, S.WEATHER_FEED_COLUMNS, "land-weather")):
        path = shared_path(spark, name)
        JF.to_hourly_payloads(df, cols, keys=FE.SERIES).write.json(path)
        paths.append(path)
    return paths[0], paths[1]


@register("e1_csv_to_mart_run", X.MART_CHAIN + "\nSELECT * FROM mart")
def e1_csv_to_mart_run(spark, sf_dir):
    """Lifecycle 1: CSV landing -> raw tables -> dedup -> staging -> mart table (and the
    contract report beside it); the mart table is read back."""
    stations, measurements, latest = land_csv(spark, sf_dir)
    paths = R.run_sql_models(spark, stations, measurements, latest, shared_path(spark, "sql-models"),
                             ASOF_CONTRACT, strict=False)
    return spark.read.parquet(paths["mart"])


@register("e2_payloads_to_feature_table", X.FEATURES + """
SELECT *, CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month FROM features""")
def e2_payloads_to_feature_table(spark, sf_dir):
    """Lifecycle 2: landed payloads -> clean, merged, interpolated series -> features ->
    table partitioned by year/month, read back whole."""
    air, weather = land_payloads(spark, sf_dir)
    path = R.run_feature_build(spark, air, weather, shared_path(spark, "feature-build"))
    f = K.read_partitioned(spark, path, schema=feature_table(spark, sf_dir).schema)
    return f.withColumns({c: F.round(c, 9) for c in FE.ROLLING})


EMPTY_AFTER = "2030-01-01 00:00:00"


@register("a15_empty_payload_features", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f"""
SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM merged_full WHERE datetime > TIMESTAMP '{EMPTY_AFTER}'""")
def a15_empty_payload_features(spark, sf_dir):
    """Feeds landed for a window after the data ends give empty payloads; reading them
    yields schema-bearing empty frames and the realtime feature build runs on them."""
    air, weather = feeds(spark, sf_dir)
    after = F.col("datetime") > F.lit(EMPTY_AFTER).cast("timestamp_ntz")
    paths = []
    for df, cols, name in ((air, S.AIR_FEED_COLUMNS, "empty-air"), (weather, S.WEATHER_FEED_COLUMNS, "empty-weather")):
        path = shared_path(spark, name)
        JF.to_hourly_payloads(df.where(after), cols, keys=FE.SERIES).write.json(path)
        paths.append(path)
    a, w = R.read_feeds(spark, paths[0], paths[1])
    return FE.realtime_features(a, w)


CYCLES = ["2024-01-29 14:20:00", "2024-04-28 17:40:00"]


def _cycle_sql(n: int, asof: str) -> str:
    """CTEs of one nowcast cycle: each feed cut to its last 48 rows, aligned, newest row scored."""
    at = f"date_trunc('hour', TIMESTAMP '{asof}')"
    last = lambda t: f"SELECT * FROM {t} WHERE datetime <= {at} QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) <= 48"
    full = X.MERGED_FULL.replace("merged_full", f"mf{n}").replace("FROM air a", f"FROM air{n} a").replace("JOIN weather w", f"JOIN weather{n} w")
    return f"""
air{n} AS ({last("air")}),
weather{n} AS ({last("weather")}),{full},
rt{n} AS (SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM mf{n}),
new{n} AS (SELECT * FROM (SELECT * FROM rt{n} QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) = 1)
           WHERE {" AND ".join(f"{c} IS NOT NULL" for c in XGB_COLS)}),
next{n} AS (SELECT series_id, pm2_5 AS nxt FROM air WHERE datetime > {at} QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime) = 1),
cycle{n} AS (SELECT series_id, datetime, pm2_5, nxt, {linear_sql(NOWCAST_MODEL)} AS p FROM new{n} LEFT JOIN next{n} USING (series_id))"""


@register("k8_nowcast_cycles", "WITH " + ",".join([X.AIR, X.WEATHER] + [_cycle_sql(i, a) for i, a in enumerate(CYCLES)]) + f""",
cycles AS (SELECT *, 0 AS n FROM cycle0 UNION ALL SELECT *, 1 FROM cycle1)
SELECT series_id, datetime, {X.spark_round("pm2_5", 2)} AS pm25_observe, {X.spark_round("p", 2)} AS pm25_xgboost,
       {X.spark_round("nxt", 2)} AS pm25_cams, {X.spark_round("p", 2)} > 15 AS depasse_oms
FROM cycles QUALIFY row_number() OVER (PARTITION BY series_id, datetime ORDER BY n DESC) = 1""")
def k8_nowcast_cycles(spark, sf_dir):
    """K8 + A11: two nowcast cycles over landed payloads, each scored for every series and upserted into a
    new version of the predictions table; the last version is read back."""
    air, weather = land_payloads(spark, sf_dir)
    path = None
    for i, asof in enumerate(CYCLES):
        path = R.run_nowcast_cycle(spark, air, weather, NOWCAST_MODEL, asof, path, shared_path(spark, f"nowcast-v{i}"))
    return spark.read.parquet(path).drop("inserted_at")


@register("k8_nowcast_skipped", "WITH " + ",".join([X.AIR, X.WEATHER] + [_cycle_sql(i, a).replace("AND ".join(f"{c} IS NOT NULL " for c in XGB_COLS), "") for i, a in enumerate(CYCLES)])
          + ",\ngone AS (" + " UNION ALL ".join(f"SELECT *, {i} AS cycle FROM rt{i} QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) = 1" for i in range(len(CYCLES)))
          + f""")
SELECT cycle, series_id, datetime, array_to_string(list_filter([{", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in XGB_COLS)}], lambda x: x IS NOT NULL), '|') AS missing
FROM gone WHERE NOT ({" AND ".join(f"{c} IS NOT NULL" for c in XGB_COLS)})""")
def k8_nowcast_skipped(spark, sf_dir):
    """K8 + B13: the series that a cycle skips, with the model inputs that its newest hour lacks."""
    air, weather = feeds(spark, sf_dir)
    out = None
    for i, asof in enumerate(CYCLES):
        _, skipped = R.nowcast_rows(air, weather, NOWCAST_MODEL, asof)
        missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in S.NOWCAST_FEATURES])), "|")
        rows = skipped.select(F.lit(i).alias("cycle"), "series_id", "datetime", missing.alias("missing"))
        out = rows if out is None else out.unionByName(rows)
    return out


#: The panels that ``k11_eda_report`` leaves out, each with the query whose SQL gives it: panel, query, key columns, value column.
MORE_PANELS = [("histogram", "d16_histogram_60", ["bin"], "count"), ("daily_mean", "d17_daily_mean", ["day"], "mean"), ("acf", "e8_acf_72", ["series_id", "lag"], "acf"),
               ("pacf", "e9_pacf_yw_72", ["series_id", "lag"], "pacf"), ("corr_matrix", "d15_corr_matrix_top15", ["row", "col"], "corr"),
               ("preview", "f4_preview_5", ["series_id", "datetime"], "pm2p5")]


@register("k11_more_panels", "\nUNION ALL ".join(f"""SELECT '{p}' AS panel, {" || '/' || ".join(f'CAST("{k}" AS VARCHAR)' for k in keys)} AS key, CAST("{v}" AS DOUBLE) AS value
FROM ({ORACLE[q]}) AS panel_{p}""" for p, q, keys, v in MORE_PANELS))
def k11_more_panels(spark, sf_dir):
    """The report's other panels in long form: histogram, daily means, autocorrelations, matrix, NULL ratios (none in
    the features) and preview."""
    panels = ST.eda_report(feature_table(spark, sf_dir))
    out = panels["null_ratios"].select(F.lit("null_ratios").alias("panel"), F.col("column_name").alias("key"), F.col("null_ratio").alias("value"))
    for name, _, keys, value in MORE_PANELS:
        out = out.unionByName(panels[name].select(F.lit(name).alias("panel"), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("key"), F.col(value).cast("double").alias("value")))
    return out


@register("k11_eda_report", X.FEATURES + """,
stat AS (SELECT count(pm2p5) AS n, avg(pm2p5) AS m, stddev_samp(pm2p5) AS s, min(pm2p5) AS lo, max(pm2p5) AS hi,
                quantile_cont(pm2p5, [0.25, 0.5, 0.75]) AS q FROM features)
SELECT 'describe' AS panel, key, round(value, 9) AS value FROM (
  SELECT unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS key,
         unnest([CAST(n AS DOUBLE), m, s, lo, q[1], q[2], q[3], hi]) AS value FROM stat)
UNION ALL SELECT 'shape', 'n_rows', CAST(count(*) AS DOUBLE) FROM features
UNION ALL SELECT 'by_hour', CAST(heure AS VARCHAR), round(avg(pm2p5), 9) FROM features GROUP BY heure
UNION ALL SELECT 'by_weekday', CAST(jour_semaine AS VARCHAR), round(avg(pm2p5), 9) FROM features GROUP BY jour_semaine
UNION ALL SELECT 'by_month', CAST(mois AS VARCHAR), round(avg(pm2p5), 9) FROM features GROUP BY mois
UNION ALL SELECT 'recent_90_days', 'rows', CAST(count(*) AS DOUBLE) FROM features WHERE datetime >= (SELECT max(datetime) FROM features) - INTERVAL 90 DAY
""" + "".join(f"UNION ALL SELECT 'corr_weather', '{c}', round({_corr_sql('pm2p5', c)}, 9) FROM features\n" for c in WEATHER))
def k11_eda_report(spark, sf_dir):
    """The panels of the exploratory report in long form (panel, key, value)."""
    panels = ST.eda_report(feature_table(spark, sf_dir))
    as_long = lambda name, key, value: panels[name].select(F.lit(name).alias("panel"), F.col(key).cast("string").alias("key"),
                                                           F.col(value).cast("double").alias("value"))
    parts = [as_long("describe", "stat", "value"), as_long("by_hour", "heure", "mean"), as_long("by_weekday", "jour_semaine", "mean"),
             as_long("by_month", "mois", "mean"), as_long("corr_weather", "feature", "corr"),
             panels["shape"].select(F.lit("shape").alias("panel"), F.lit("n_rows").alias("key"), F.col("n_rows").cast("double").alias("value")),
             panels["recent_90_days"].agg(F.count(F.lit(1)).cast("double").alias("value")).select(
                 F.lit("recent_90_days").alias("panel"), F.lit("rows").alias("key"), "value")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
