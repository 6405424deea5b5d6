"""Queries of the hourly time-series layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.operators import series as ser
from airshed.plans import features as FE
from airshed.plans import nowcast as NC
from airshed.session import materialize
from airshed.sources import driver_tables as D

ASOF = "2024-01-30 00:00:00"
LSTM_FEATURES = ["pm2p5", "pm10", "no2", "temp_c", "vent_kmh", "blh_m", "heure", "jour_semaine",
                 "mois", "est_weekend"]


def feeds(spark, sf_dir):
    """Hourly air and weather feeds from one aggregation over the raw table, checkpointed once:
    every positional step reads its input twice (summary + rows)."""
    return D.split_feeds(materialize(D.hourly_feeds(spark, sf_dir)), keys=["series_id"])


def _r9(df, cols):
    return df.withColumns({c: F.round(c, 9) for c in cols})


@register("c1_inner_join_hourly", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_INNER]) + "\nSELECT * FROM merged")
def c1_inner_join_hourly(spark, sf_dir):
    """C1 + B5: air and weather renamed and inner-joined on the hour."""
    return FE.merge_inner(*feeds(spark, sf_dir))


@register("c2_full_outer_hourly", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + "\nSELECT * FROM merged_full")
def c2_full_outer_hourly(spark, sf_dir):
    """C2 + B5: full outer align of air and weather (realtime renames)."""
    return FE.merge_full(*feeds(spark, sf_dir))


@register("e3_interpolate_limit3", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_INNER])
          + ",\nkept AS (SELECT * FROM merged WHERE pm2p5 IS NOT NULL)," + X.interp_sql("kept", "interp")
          + "\nSELECT * FROM interp")
def e3_interpolate_limit3(spark, sf_dir):
    """B7 + E3: rows without pm2p5 dropped, then linear interpolation (limit 3) by position."""
    return FE.interpolated(FE.merge_inner(*feeds(spark, sf_dir))).drop(ser.POS)


@register("c3_hourly_spine", "WITH " + X.AIR + """,
spine AS (SELECT series_id, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime FROM air GROUP BY series_id)
SELECT CAST(spine.datetime AS TIMESTAMP) AS datetime, pm2_5, pm10, nitrogen_dioxide, spine.series_id, air.datetime IS NULL AS filled
FROM spine LEFT JOIN air ON air.series_id = spine.series_id AND air.datetime = spine.datetime""")
def c3_hourly_spine(spark, sf_dir):
    """The air feed on a regular index: a row for every hour between each series' bounds."""
    return ser.hourly_spine(feeds(spark, sf_dir)[0], ["series_id"])


@register("c3_hourly_gaps", "WITH " + X.AIR + """,
n AS (SELECT series_id, datetime, lead(datetime) OVER (PARTITION BY series_id ORDER BY datetime) AS nxt FROM air)
SELECT series_id, datetime + INTERVAL 1 HOUR AS gap_start, nxt - INTERVAL 1 HOUR AS gap_end, date_diff('hour', datetime, nxt) - 1 AS hours
FROM n WHERE nxt > datetime + INTERVAL 1 HOUR""")
def c3_hourly_gaps(spark, sf_dir):
    """The missing hours of each series as gaps with their lengths."""
    return ser.hourly_gaps(feeds(spark, sf_dir)[0], ["series_id"])


@register("e14_clean_and_merge", X.CLEAN + "\nSELECT * FROM clean")
def e14_clean_and_merge(spark, sf_dir):
    """Rename, inner join, dropna(pm2p5), interpolate(limit 3), dropna()."""
    return FE.clean_and_merge(*feeds(spark, sf_dir))


@register("e1_e2_lags_rolling", X.CLEAN + f""",
f AS (SELECT series_id, datetime, pm2p5, {X.lags_sql("pm2p5")}, {X.rolling_sql("pm2p5")} FROM clean)
SELECT * FROM f""")
def e1_e2_lags_rolling(spark, sf_dir):
    """E1 + E2: positional lags 1/2/24 and full-window rolling means 3/24 (no dropna)."""
    clean = FE.clean_and_merge(*feeds(spark, sf_dir))
    d = ser.with_position(clean.select("series_id", "datetime", "pm2p5"), FE.SERIES, [FE.TIME])
    # lags and rolling means in one blocked pass (one shuffle, one sort)
    d = ser.add_window_features(d, FE.SERIES, "pm2p5", FE.LAGS, FE.ROLLING)
    return _r9(d.drop(ser.POS), list(FE.ROLLING))


@register("e12_batch_features", X.FEATURES + "\nSELECT * FROM features")
def e12_batch_features(spark, sf_dir):
    """Batch feature table (calendar, lags, rolling means, complete rows only)."""
    f = FE.batch_features(FE.clean_and_merge(*feeds(spark, sf_dir)))
    return _r9(f, list(FE.ROLLING))


@register("e13_realtime_features", "WITH " + ",".join([X.AIR, X.WEATHER, X.MERGED_FULL]) + f"""
SELECT *, {X.CALENDAR}, {X.lags_sql("pm2_5")} FROM merged_full""")
def e13_realtime_features(spark, sf_dir):
    """Full outer align, renames, calendar and lags of pm2_5 (no rolling, no dropna)."""
    return FE.realtime_features(*feeds(spark, sf_dir))


@register("e5_latest_window_48h", "WITH " + X.AIR + f"""
SELECT * FROM (SELECT * FROM air WHERE datetime <= TIMESTAMP '{ASOF}')
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) <= 48""")
def e5_latest_window_48h(spark, sf_dir):
    """B8 + E5: air feed at or before ``asof``, last 48 rows by position (``tail(48)``)."""
    air, _ = feeds(spark, sf_dir)
    return NC.latest_window(air, F.lit(ASOF).cast("timestamp_ntz"), 48)


@register("e6_forecast_head_24h", "WITH " + X.AIR + f"""
SELECT series_id, datetime, pm2_5 AS pm2_5_cams FROM (SELECT * FROM air WHERE datetime > TIMESTAMP '{ASOF}')
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime) <= 24""")
def e6_forecast_head_24h(spark, sf_dir):
    """B9 + E6: forecast rows strictly after ``asof``, first 24 by position, renamed."""
    air, _ = feeds(spark, sf_dir)
    return NC.forecast_head(air, F.lit(ASOF).cast("timestamp_ntz"), 24)


@register("e7_lstm_sequences_24", X.FEATURES + f"""
SELECT series_id, pos AS position, sequence, label FROM (
  SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS pos,
         list([{", ".join(f"CAST({c} AS DOUBLE)" for c in LSTM_FEATURES)}])
           OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS sequence,
         pm2p5 AS label
  FROM features)
WHERE len(sequence) = 24""")
def e7_lstm_sequences_24(spark, sf_dir):
    """Sliding 24-step sequences of the 10 LSTM features, label = next pm2p5."""
    f = FE.batch_features(FE.clean_and_merge(*feeds(spark, sf_dir)))
    d = ser.with_position(f, FE.SERIES, [FE.TIME])
    s = ser.add_sequences(d, FE.SERIES, LSTM_FEATURES, "pm2p5", 24)
    return s.select("series_id", F.col(ser.POS).alias("position"), "sequence", "label")


@register("e11_chrono_split", X.FEATURES + """
SELECT series_id, datetime, pm2p5,
       CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 < floor(0.8 * count(*) OVER (PARTITION BY series_id))
            THEN 'train' ELSE 'test' END AS split
FROM features""")
def e11_chrono_split(spark, sf_dir):
    """Positional chronological 80/20 split of the feature table (no global sort)."""
    f = FE.batch_features(FE.clean_and_merge(*feeds(spark, sf_dir)))
    d = ser.with_position(f.select("series_id", "datetime", "pm2p5"), FE.SERIES, [FE.TIME])
    return ser.chrono_split(d, FE.SERIES, 0.8).select("series_id", "datetime", "pm2p5", "split")


def _time_lags_sql() -> str:
    lags = ", ".join(f"l{k}.pm2p5 AS pm2p5_lag_{k}h" for k in (1, 2, 24))
    joins = "\n".join(f"LEFT JOIN clean l{k} ON l{k}.series_id = c.series_id AND l{k}.datetime = c.datetime - INTERVAL {k} HOUR" for k in (1, 2, 24))
    return X.CLEAN + f""",
tl AS (SELECT c.series_id, c.datetime, c.pm2p5, {lags} FROM clean c
{joins})
SELECT * FROM tl"""


@register("e1_time_lags", _time_lags_sql())
def e1_time_lags(spark, sf_dir):
    """E1 in ``mode="time"`` (decision Q15): pm2p5 exactly 1, 2 and 24 hours earlier, NULL
    where that hour was dropped or never existed; equi join on (series, hour), no window."""
    clean = FE.clean_and_merge(*feeds(spark, sf_dir))
    d = ser.add_time_lags(clean.select("series_id", "datetime", "pm2p5"), FE.SERIES, FE.TIME, "pm2p5", FE.LAGS)
    return d


@register("e12_batch_features_time_lags", X.CLEAN + f""",
tl AS (SELECT c.*, {X.CALENDAR.replace("datetime", "c.datetime")},
              l1.pm2p5 AS pm2p5_lag_1h, l2.pm2p5 AS pm2p5_lag_2h, l24.pm2p5 AS pm2p5_lag_24h,
              {X.rolling_sql("c.pm2p5").replace("PARTITION BY series_id ORDER BY datetime", "PARTITION BY c.series_id ORDER BY c.datetime")}
       FROM clean c
       LEFT JOIN clean l1 ON l1.series_id = c.series_id AND l1.datetime = c.datetime - INTERVAL 1 HOUR
       LEFT JOIN clean l2 ON l2.series_id = c.series_id AND l2.datetime = c.datetime - INTERVAL 2 HOUR
       LEFT JOIN clean l24 ON l24.series_id = c.series_id AND l24.datetime = c.datetime - INTERVAL 24 HOUR)
SELECT * FROM tl WHERE pm2p5_lag_24h IS NOT NULL AND pm2p5_lag_1h IS NOT NULL AND pm2p5_lag_2h IS NOT NULL
  AND pm2p5_rolling_3h IS NOT NULL AND pm2p5_rolling_24h IS NOT NULL""")
def e12_batch_features_time_lags(spark, sf_dir):
    """E12 with ``lag_mode="time"``: calendar, exact-hour lags, positional rolling means,
    complete rows only."""
    f = FE.batch_features(FE.clean_and_merge(*feeds(spark, sf_dir)), lag_mode="time")
    return _r9(f, list(FE.ROLLING))


@register("e11_chrono_split_test_ceil", X.FEATURES + """
SELECT series_id, datetime, pm2p5,
       CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1
                 < count(*) OVER (PARTITION BY series_id) - ceil(0.2 * count(*) OVER (PARTITION BY series_id))
            THEN 'train' ELSE 'test' END AS split
FROM features""")
def e11_chrono_split_test_ceil(spark, sf_dir):
    """E11 with the gradient-boosting script's rule: the last ``ceil(0.2 n)`` rows test."""
    f = FE.batch_features(FE.clean_and_merge(*feeds(spark, sf_dir)))
    d = ser.with_position(f.select("series_id", "datetime", "pm2p5"), FE.SERIES, [FE.TIME])
    return ser.chrono_split(d, FE.SERIES, 0.8, rule="test_ceil").select("series_id", "datetime", "pm2p5", "split")
