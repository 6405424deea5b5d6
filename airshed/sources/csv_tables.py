"""Header-CSV sources of the three raw tables (A1-A4).

Files are read with an explicit all-text schema (no inference pass over the
data) and typed with column expressions, so the scan stays a vectorised CSV
read split across files and blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.functions.misc import split_pipe, text_to_bool


def read_csv_text(spark: SparkSession, path: str, schema) -> DataFrame:
    """A1: header CSV, every column as text, taken BY NAME: the order of the file's columns does
    not matter, further columns are ignored, and a missing one raises.

    ``enforceSchema=false`` makes Spark compare every file's header with the first file's, so a
    folder of files in different column orders fails instead of mixing columns.  An unquoted
    empty field reads as NULL, a quoted empty one (``""``) as the empty string.
    """
    raw = (spark.read.option("header", True).option("enforceSchema", False)
           .option("nullValue", "\u0000").option("emptyValue", "").csv(path))
    have = {c.strip().lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{path}: the header has no column {', '.join(missing)}")
    return raw.select(*[F.col(f"`{have[f.name.lower()]}`").alias(f.name) for f in schema.fields])


def _num(c: str, kind: str, strict: bool) -> Column:
    return F.col(c).cast(kind) if strict else F.expr(f"try_cast(`{c}` AS {kind})")


def _opt_num(c: str, kind: str, strict: bool) -> Column:
    """Empty text -> NULL, otherwise a number."""
    return F.when(F.col(c) != "", _num(c, kind, strict))


def _ts(c: str) -> Column:
    # ISO-8601 text, optional "+00:00" suffix: the wall clock is kept, the offset dropped
    return F.to_timestamp_ntz(F.regexp_replace(F.col(c), r"(Z|[+-]\d\d:\d\d)$", ""))


def type_stations(raw: DataFrame, strict: bool = True) -> DataFrame:
    """A2: ints, floats, ``"True"`` -> boolean, ``a|b|c`` -> array."""
    return raw.select(
        _num("id", "bigint", strict).alias("id"), "name", "locality", "timezone",
        _num("latitude", "double", strict).alias("latitude"),
        _num("longitude", "double", strict).alias("longitude"),
        text_to_bool("is_monitor").alias("is_monitor"), "provider",
        split_pipe("parameters").alias("parameters"), "ingested_at")


def type_measurements(raw: DataFrame, strict: bool = True) -> DataFrame:
    """A3: typed measurements; empty latitude/longitude -> NULL.

    ``strict=True`` follows the reference: an empty or malformed ``value`` aborts the load
    (ANSI cast error).  ``strict=False`` turns it into NULL instead.
    """
    if strict:
        # the reference aborts on an empty value; an empty field arrives here as NULL
        value = F.coalesce(_num("value", "double", True),
                           F.raise_error(F.lit("measurements: empty value")).cast("double"))
    else:
        value = _opt_num("value", "double", False)
    return raw.select(
        _num("location_id", "bigint", strict).alias("location_id"),
        _num("sensor_id", "bigint", strict).alias("sensor_id"),
        "parameter", value.alias("value"), "unit",
        _ts("datetime_utc").alias("datetime_utc"), _ts("datetime_local").alias("datetime_local"),
        _opt_num("latitude", "double", strict).alias("latitude"),
        _opt_num("longitude", "double", strict).alias("longitude"),
        "ingested_at")


def type_latest(raw: DataFrame, strict: bool = True) -> DataFrame:
    """A4: typed latest snapshot."""
    return raw.select(
        _num("location_id", "bigint", strict).alias("location_id"), "location_name", "parameter",
        _num("value", "double", strict).alias("value"), "unit",
        _ts("datetime_utc").alias("datetime_utc"),
        _num("latitude", "double", strict).alias("latitude"),
        _num("longitude", "double", strict).alias("longitude"), "ingested_at")


def read_stations(spark, path, strict=True):
    return type_stations(read_csv_text(spark, path, S.STATIONS), strict)


def read_measurements(spark, path, strict=True):
    return type_measurements(read_csv_text(spark, path, S.MEASUREMENTS), strict)


def read_latest(spark, path, strict=True):
    return type_latest(read_csv_text(spark, path, S.LATEST), strict)


def to_csv_text(df: DataFrame) -> DataFrame:
    """Render a typed table as the reference's CSV text (ISO timestamps with micros,
    booleans as ``True``/``False``, arrays joined with ``|``, NULL as empty)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType.typeName()
        if t in ("timestamp_ntz", "timestamp"):
            e = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif t == "boolean":
            e = F.when(c, F.lit("True")).otherwise(F.lit("False"))
        elif t == "array":
            e = F.array_join(c, "|")
        else:
            e = c.cast("string")
        out.append(F.coalesce(e, F.lit("")).alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A5/A6 for CSV: header CSV of the text rendering."""
    to_csv_text(df).write.mode(mode).option("header", True).option("emptyValue", "").csv(path)
    return path
