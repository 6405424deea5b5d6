"""Hourly feature pipelines.

Input feeds carry ``series_id`` and ``datetime`` (hour, naive local wall clock)
plus value columns.  Every ordered step goes through the block operators of
``airshed.operators.series``; nothing sorts a whole series in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from airshed import schemas as S
from airshed.functions import calendar as cal
from airshed.functions.misc import rename
from airshed.operators import series as ser
from airshed.session import materialize

SERIES = ["series_id"]
TIME = "datetime"
LAGS = {"pm2p5_lag_1h": 1, "pm2p5_lag_2h": 2, "pm2p5_lag_24h": 24}
ROLLING = {"pm2p5_rolling_3h": 3, "pm2p5_rolling_24h": 24}


def add_calendar(df: DataFrame, t: str = TIME) -> DataFrame:
    """heure, jour_semaine (Monday=0), mois, est_weekend."""
    return df.withColumns({
        "heure": cal.hour_of(t),
        "jour_semaine": cal.dow_monday0(t),
        "mois": cal.month_of(t),
        "est_weekend": cal.weekend_flag(cal.dow_monday0(t)),
    })


def merge_inner(air: DataFrame, weather: DataFrame) -> DataFrame:
    """C1 + B5: batch renames, inner join on (series, hour)."""
    a = rename(air, S.AIR_RENAMES_BATCH)
    w = rename(weather, S.WEATHER_RENAMES)
    return a.join(w, SERIES + [TIME], "inner")


def merge_full(air: DataFrame, weather: DataFrame) -> DataFrame:
    """C2 + B5: realtime renames, full outer align on (series, hour) (``USING`` coalesces keys)."""
    return rename(air.join(weather, SERIES + [TIME], "full_outer"), S.REALTIME_RENAMES)


def interpolated(merged: DataFrame, target: str = "pm2p5", limit: int = 3,
                 block_rows: int = ser.DEFAULT_BLOCK_ROWS, checkpoint: bool = False) -> DataFrame:
    """B7 + E3: drop rows without the target, then linear interpolation (limit 3) of every
    value column by position.  Result keeps ``_pos``.

    The position and the interpolation each read their input twice (a small summary and
    the rows): pass feeds that are already materialised, or ``checkpoint=True``.
    """
    d = merged.dropna(subset=[target])
    if checkpoint:
        d = materialize(d)
    values = [c for c in d.columns if c not in SERIES + [TIME]]
    # positions are read twice by the interpolation (block summaries and rows): checkpoint
    # them instead of recomputing the position plan for each reader
    d = materialize(ser.with_position(d, SERIES, [TIME]))
    return ser.interpolate_linear(d, SERIES, values, limit=limit, block_rows=block_rows)


def clean_and_merge(air: DataFrame, weather: DataFrame, target: str = "pm2p5",
                    block_rows: int = ser.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Rename, inner join, drop NULL target, interpolate (limit 3), drop remaining NULLs."""
    d = interpolated(merge_inner(air, weather), target, block_rows=block_rows)
    return materialize(d.drop(ser.POS).dropna())


def batch_features(clean: DataFrame, target: str = "pm2p5",
                   block_rows: int = ser.DEFAULT_BLOCK_ROWS, dropna: bool = True,
                   lag_mode: str = "rows") -> DataFrame:
    """Calendar + lags 1/2/24 + rolling means 3/24 by position, then drop incomplete rows.

    ``lag_mode="rows"`` reproduces the reference (positional lags, so after dropped rows a
    "24h" lag may reach further back); ``lag_mode="time"`` takes the value exactly 1/2/24
    hours earlier instead (rolling means stay positional).
    """
    d = add_calendar(clean)
    d = ser.with_position(d, SERIES, [TIME])
    if lag_mode == "rows":
        d = ser.add_window_features(d, SERIES, target, LAGS, ROLLING, block_rows)
    elif lag_mode == "time":
        base = d.columns
        d = ser.add_rolling_means(d, SERIES, target, ROLLING, block_rows)
        d = ser.add_time_lags(d, SERIES, TIME, target, LAGS).select(*base, *LAGS, *ROLLING)
    else:
        raise ValueError(f"lag_mode must be 'rows' or 'time', not {lag_mode!r}")
    d = d.drop(ser.POS)
    return d.dropna() if dropna else d


def realtime_features(air: DataFrame, weather: DataFrame, target: str = "pm2_5",
                      block_rows: int = ser.DEFAULT_BLOCK_ROWS, keep_position: bool = False) -> DataFrame:
    """Full outer align, renames, calendar, lags 1/2/24 of ``pm2_5`` (no rolling, no dropna)."""
    d = materialize(add_calendar(merge_full(air, weather)))
    d = ser.with_position(d, SERIES, [TIME])
    d = ser.add_lags(d, SERIES, target, LAGS, block_rows)
    return d if keep_position else d.drop(ser.POS)
