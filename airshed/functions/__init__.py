"""Column functions: calendar, air-quality index and small helpers."""

from airshed.functions.aqi import (  # noqa: F401
    aqi_from_pm25, category_from_aqi, category_from_pm25, confidence,
    exceeds_who, is_valid, pm25_band, status_label, unit_of,
    validity_prefilter,
)
from airshed.functions.calendar import (  # noqa: F401
    add_fixed_offset, days_for_window, dow_monday0, dow_sunday0, floor_day, floor_hour, hour_of,
    iso_text, local_to_utc, month_of, season_of_month, utc_to_local, weekend_flag,
)
from airshed.functions.misc import (  # noqa: F401
    abs_error, aliased, default_zero, drop_if_present, join_pipe, numeric_columns, one_hot,
    rename, round_half_up, split_pipe, text_to_bool,
)
