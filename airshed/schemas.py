"""Schemas and fixed domain values.

Values in the "fixed values" block must equal the reference's for results to
match; they are stated plainly, in natural order, together.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------

# Pollutants pivoted into the hourly mart, in column order.
POLLUTANTS = ["pm25", "pm10", "no2", "so2", "co", "o3"]

# Upper validity limit per parameter (value above it is invalid; limit itself is valid).
UPPER_LIMITS = {"pm25": 999.0, "pm10": 999.0, "no2": 2000.0, "so2": 2000.0, "co": 50.0, "o3": 600.0}

# Indian seasons by calendar month; any other month is "post_monsoon".
SEASON_MONTHS = [
    ("winter", [12, 1, 2]),
    ("summer", [3, 4, 5]),
    ("monsoon", [6, 7, 8, 9]),
]
SEASON_OTHER = "post_monsoon"
SEASONS = ["winter", "summer", "monsoon", "post_monsoon"]

# NAQI sub-index for PM2.5: (pm25 upper bound, pm25 lower bound, aqi at lower, aqi at upper).
# Linear inside each segment, rounded; above the last bound the AQI is 400.
AQI_PM25_SEGMENTS = [
    (30.0, 0.0, 0.0, 50.0),
    (60.0, 30.0, 50.0, 100.0),
    (90.0, 60.0, 100.0, 200.0),
    (120.0, 90.0, 200.0, 300.0),
    (250.0, 120.0, 300.0, 400.0),
]
AQI_PM25_CAP = 400.0

# Category from PM2.5 concentration (upper bound inclusive); above the last: "Severe".
PM25_CATEGORY_BOUNDS = [(30.0, "Good"), (60.0, "Satisfactory"), (90.0, "Moderate"),
                        (120.0, "Poor"), (250.0, "Very Poor")]
# Category from AQI value (upper bound inclusive); above the last: "Severe".
AQI_CATEGORY_BOUNDS = [(50.0, "Good"), (100.0, "Satisfactory"), (200.0, "Moderate"),
                       (300.0, "Poor"), (400.0, "Very Poor")]
SEVERE = "Severe"
AQI_CATEGORIES = ["Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"]

# WHO 24-hour PM2.5 guideline; a prediction strictly above it is an exceedance.
WHO_PM25_LIMIT = 15.0
# Dashboard colour bands for PM2.5 (lower bound inclusive): green < 15 <= yellow < 25 <= red < 35 <= dark red.
PM25_BANDS = [(15.0, "green"), (25.0, "yellow"), (35.0, "red")]
PM25_BAND_TOP = "dark_red"

# Data contract.
CONTRACT_PARAMETERS = ["pm25", "pm10", "no2", "so2", "co", "o3", "bc"]
CONTRACT_UNITS = ["µg/m³", "ppm", "ppb"]
CONTRACT_EXPECTED_PARAMETERS = ["pm25", "pm10", "no2", "co"]
CONTRACT_MIN_STATIONS = 10
CONTRACT_MAX_DELAY_HOURS = 3
CONTRACT_COMPLETENESS = [("datetime_utc", 1.0), ("value", 0.90)]
CONTRACT_REQUIRED_FIELDS = ["location_id", "sensor_id", "parameter", "value", "unit", "datetime_utc"]
CONTRACT_VALIDITY_RULES = [
    ("pm25_range", "parameter != 'pm25' OR (value >= 0 AND value <= 999)"),
    ("no_negatives", "value >= 0"),
]
# Column tests of the SQL models: not-null columns per model, accepted values per column.
NOT_NULL_STAGING = ["location_id", "parameter", "datetime_utc", "is_valid"]
NOT_NULL_MART = ["hour_utc"]
ACCEPTED_STAGING_PARAMETER = ["pm25", "pm10", "no2", "so2", "co", "o3", "bc"]
ACCEPTED_MART_SEASON = ["winter", "summer", "monsoon", "post_monsoon"]

# Units of the parameters.
UNIT_UG = "µg/m³"
UNIT_MG = "mg/m³"

# Local offset of the reference's city (no daylight saving).
LOCAL_ZONE = "Asia/Kolkata"
LOCAL_OFFSET_MINUTES = 330

# Nowcast model inputs, in order.
NOWCAST_FEATURES = ["pm10", "no2", "temp_c", "vent_kmh", "blh_m", "heure", "jour_semaine",
                    "mois", "est_weekend", "pm2p5_lag_1h", "pm2p5_lag_2h", "pm2p5_lag_24h"]

# Renames of the hourly feeds.
AIR_RENAMES_BATCH = {"pm2_5": "pm2p5", "pm10": "pm10", "nitrogen_dioxide": "no2"}
WEATHER_RENAMES = {"temperature_2m": "temp_c", "wind_speed_10m": "vent_kmh",
                   "boundary_layer_height": "blh_m"}
REALTIME_RENAMES = {"nitrogen_dioxide": "no2", "temperature_2m": "temp_c",
                    "wind_speed_10m": "vent_kmh", "boundary_layer_height": "blh_m"}

# Dashboard status labels of an exceedance flag (alert, otherwise).
STATUS_ALERT = "🔴 OMS!"
STATUS_OK = "🟢 OK"

# Scoring request: accepted season text, value bounds (inclusive), confidence labels, version.
SEASON_PATTERN = "^(winter|summer|monsoon|post_monsoon)$"
REQUEST_PM_MAX = 999.0          # pm25 and pm10 upper bound
REQUEST_HOUR_RANGE = (0, 23)
REQUEST_DOW_RANGE = (0, 6)
REQUEST_MONTH_RANGE = (1, 12)
CONFIDENCE_HIGH = "high"
CONFIDENCE_MEDIUM = "medium"
MODEL_VERSION = "2.0.0"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

STATIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("locality", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("is_monitor", T.BooleanType()),
    T.StructField("provider", T.StringType()),
    T.StructField("parameters", T.ArrayType(T.StringType())),
    T.StructField("ingested_at", T.StringType()),
])

MEASUREMENTS = T.StructType([
    T.StructField("location_id", T.LongType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("datetime_utc", T.TimestampNTZType()),
    T.StructField("datetime_local", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("ingested_at", T.StringType()),
])

LATEST = T.StructType([
    T.StructField("location_id", T.LongType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("parameter", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("datetime_utc", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("ingested_at", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("pm25_observe", T.DoubleType()),
    T.StructField("pm25_xgboost", T.DoubleType()),
    T.StructField("pm25_cams", T.DoubleType()),
    T.StructField("depasse_oms", T.BooleanType()),
])

AIR_FEED_COLUMNS = ["pm2_5", "pm10", "nitrogen_dioxide"]
WEATHER_FEED_COLUMNS = ["temperature_2m", "wind_speed_10m", "boundary_layer_height"]


def hourly_payload_schema(columns: list[str]) -> T.StructType:
    """Schema of a landed columnar JSON payload ``{"hourly": {"time": [...], col: [...]}}``."""
    fields = [T.StructField("time", T.ArrayType(T.StringType()))]
    fields += [T.StructField(c, T.ArrayType(T.DoubleType())) for c in columns]
    return T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("hourly", T.StructType(fields)),
    ])


def all_string(schema: T.StructType) -> T.StructType:
    """Same field names, all text: the raw shape of a header CSV."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
