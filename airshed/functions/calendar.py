"""Calendar and time-zone column functions.

All are pure ``Column -> Column`` builders over built-in Spark expressions, so
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts) -> Column:
    """H1: hour of the (local) wall clock, 0..23, as int."""
    return F.hour(_c(ts)).cast("int")


def floor_hour(ts) -> Column:
    """Truncate to the hour, keeping ``timestamp_ntz`` (``date_trunc`` would widen it)."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def floor_day(ts) -> Column:
    return F.date_trunc("day", _c(ts)).cast("timestamp_ntz")


def dow_sunday0(ts) -> Column:
    """H3: SQL-style day of week, Sunday = 0 .. Saturday = 6."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def dow_monday0(ts) -> Column:
    """H4: pandas-style day of week, Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(ts)).cast("int")


def month_of(ts) -> Column:
    """H5: calendar month 1..12."""
    return F.month(_c(ts)).cast("int")


def season_of_month(month) -> Column:
    """H6: Indian season of a month number."""
    m = _c(month)
    expr = None
    for name, months in S.SEASON_MONTHS:
        cond = m.isin(months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(S.SEASON_OTHER))


def weekend_flag(dow_monday0_col) -> Column:
    """H7: 1 on Saturday/Sunday (Monday=0 numbering), else 0."""
    return (_c(dow_monday0_col) >= 5).cast("int")


def _offset_micros(instant: Column, zone: str) -> Column:
    """UTC offset of ``zone`` at ``instant``, in microseconds."""
    return F.unix_micros(F.from_utc_timestamp(instant, zone)) - F.unix_micros(instant)


def local_to_utc(ts_local, zone: str = S.LOCAL_ZONE, invalid_null: bool = True) -> Column:
    """H8: attach a zone to a naive local wall clock, giving an instant (``timestamp``).

    With ``invalid_null`` a wall clock that does not exist (skipped by a daylight-saving jump)
    or exists twice (repeated when clocks go back) gives NULL, as the reference's localisation
    does; ``to_utc_timestamp`` alone would silently pick one instant.  Detection uses the
    zone's offsets a day before and after the candidate instant, so it holds for any zone
    whose transitions are more than a day apart.
    """
    t = _c(ts_local).cast("timestamp")
    u = F.to_utc_timestamp(t, zone)
    if not invalid_null:
        return u
    day = F.lit(86_400_000_000)
    t_us = F.unix_micros(t)
    off_before = _offset_micros(F.timestamp_micros(F.unix_micros(u) - day), zone)
    off_after = _offset_micros(F.timestamp_micros(F.unix_micros(u) + day), zone)
    cand_a = F.timestamp_micros(t_us - off_before)
    cand_b = F.timestamp_micros(t_us - off_after)
    missing = F.unix_micros(F.from_utc_timestamp(u, zone)) != t_us
    twice = ((off_before != off_after)
             & (F.unix_micros(F.from_utc_timestamp(cand_a, zone)) == t_us)
             & (F.unix_micros(F.from_utc_timestamp(cand_b, zone)) == t_us))
    return F.when(missing | twice, F.lit(None).cast("timestamp")).otherwise(u)


def utc_to_local(ts_utc, zone: str = S.LOCAL_ZONE) -> Column:
    """Instant to the zone's wall clock, zone dropped (``timestamp_ntz``)."""
    return F.from_utc_timestamp(_c(ts_utc).cast("timestamp"), zone).cast("timestamp_ntz")


def add_fixed_offset(ts, minutes: int = S.LOCAL_OFFSET_MINUTES) -> Column:
    """Add a fixed offset (5 h 30 for the reference's city)."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def iso_text(ts, with_offset: bool = False) -> Column:
    """ISO-8601 text of a timestamp (``+00:00`` suffix when asked)."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    out = F.date_format(_c(ts), fmt)
    return F.concat(out, F.lit("+00:00")) if with_offset else out


def days_for_window(hours) -> Column:
    """Whole days to request for a trailing/leading window, ``max(1, h // 24 + 1)``."""
    h = _c(hours) if not isinstance(hours, int) else F.lit(hours)
    return F.greatest(F.lit(1), (h.cast("long") / 24).cast("long") + 1)
