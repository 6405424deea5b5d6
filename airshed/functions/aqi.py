"""Air-quality scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(x: float) -> Column:
    return F.lit(float(x))


def is_valid(parameter="parameter", value="value", limits: dict | None = None) -> Column:
    """B1: NULL or negative is invalid; above the parameter's upper limit is invalid; else valid.

    Limits are inclusive-valid; a parameter without a limit (e.g. ``bc``) is valid at any
    non-negative value.
    """
    p, v = _c(parameter), _c(value)
    limits = S.UPPER_LIMITS if limits is None else limits
    expr = F.when(v.isNull(), F.lit(False)).when(v < 0, F.lit(False))
    for name, hi in limits.items():
        expr = expr.when((p == name) & (v > _d(hi)), F.lit(False))
    return expr.otherwise(F.lit(True))


def validity_prefilter(value="value") -> Column:
    """Redundant range predicate implied by ``is_valid``, written so Parquet can prune on it."""
    return _c(value) >= 0


def aqi_from_pm25(pm25="pm25") -> Column:
    """NAQI sub-index of PM2.5, piecewise linear, rounded; NULL stays NULL; above 250 -> 400."""
    x = _c(pm25)
    expr = F.when(x.isNull(), F.lit(None).cast("double"))
    for hi, lo, a_lo, a_hi in S.AQI_PM25_SEGMENTS:
        # same operation order as the reference: base + ((x - lo) / width) * span
        lin = _d(a_lo) + ((x - _d(lo)) / _d(hi - lo)) * _d(a_hi - a_lo)
        if lo == 0.0:
            lin = (x / _d(hi)) * _d(a_hi)
        expr = expr.when(x <= _d(hi), F.round(lin))
    return expr.otherwise(_d(S.AQI_PM25_CAP))


def category_from_pm25(pm25="pm25", null_category: str | None = S.SEVERE) -> Column:
    """Category from the PM2.5 concentration.

    The reference has no NULL branch, so NULL falls through to ``Severe``; pass
    ``null_category=None`` for a NULL result instead.
    """
    x = _c(pm25)
    expr = None
    for hi, name in S.PM25_CATEGORY_BOUNDS:
        cond = x <= _d(hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    out = expr.otherwise(F.lit(S.SEVERE))
    if null_category != S.SEVERE:
        out = F.when(x.isNull(), F.lit(null_category).cast("string")).otherwise(out)
    return out


def category_from_aqi(aqi="aqi") -> Column:
    """Category from an AQI value (bounds 50/100/200/300/400)."""
    x = _c(aqi)
    expr = None
    for hi, name in S.AQI_CATEGORY_BOUNDS:
        cond = x <= _d(hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(S.SEVERE))


def confidence(pm10="pm10", no2="no2") -> Column:
    """``high`` when both pm10 and no2 are present and non-zero, else ``medium``."""
    a = F.coalesce(_c(pm10), _d(0.0))
    b = F.coalesce(_c(no2), _d(0.0))
    return F.when((a != 0) & (b != 0), F.lit(S.CONFIDENCE_HIGH)).otherwise(F.lit(S.CONFIDENCE_MEDIUM))


def exceeds_who(pred="pm25_xgboost", limit: float = S.WHO_PM25_LIMIT) -> Column:
    """Strictly above the WHO 24-hour guideline."""
    return _c(pred) > _d(limit)


def status_label(flag="depasse_oms") -> Column:
    """Dashboard status text; a NULL flag reads as OK."""
    return F.when(_c(flag), F.lit(S.STATUS_ALERT)).otherwise(F.lit(S.STATUS_OK))


def pm25_band(pm25="pm25") -> Column:
    """Dashboard colour band, lower bound inclusive."""
    x = _c(pm25)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for hi, name in S.PM25_BANDS:
        expr = expr.when(x < _d(hi), F.lit(name))
    return expr.otherwise(F.lit(S.PM25_BAND_TOP))


def unit_of(parameter="parameter") -> Column:
    """Unit by parameter (CO in mg/m3, the rest in ug/m3)."""
    return F.when(_c(parameter) == "co", F.lit(S.UNIT_MG)).otherwise(F.lit(S.UNIT_UG))
