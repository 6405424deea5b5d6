"""Deduplication and keyed upsert.

Both are grouped aggregations (``max_by`` over a version struct) rather than a
``row_number`` window: the aggregation combines partially on the map side, so a key delivered many
times is reduced before the shuffle.  The winner is a struct, so Spark aggregates by sorting (before
and after the shuffle, spilling if need be); a bounded ``row_number`` would sort as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep, per key, the row with the largest ``order_cols`` tuple (newest version wins).

    ``order_cols`` should end in a column that makes the order total within a key, so the
    winner is deterministic.
    """
    payload = [c for c in df.columns if c not in keys]
    ver = F.struct(*[F.col(c) for c in order_cols])
    win = (df.groupBy(*keys)
           .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), ver).alias("_row")))
    return win.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload]).select(*df.columns)


def dedup_measurements(df: DataFrame, keys=("location_id", "parameter", "datetime_utc")) -> DataFrame:
    """Newest ``ingested_at`` wins on the declared key; ties go to the larger value, then to the
    larger remaining columns, so rows that differ anywhere have one winner."""
    rest = sorted(c for c in df.columns if c not in keys and c not in ("ingested_at", "value"))
    return latest_per_key(df, list(keys), ["ingested_at", "value", *rest])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-or-overwrite of ``new`` into ``old`` on ``keys``.

    Rows of ``new`` win over rows of ``old`` with the same key (``ON CONFLICT DO UPDATE``).
    The caller writes the result to a new location and swaps it in (no in-place rewrite).
    """
    tagged = (old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1))))
    return latest_per_key(tagged, keys, ["_v"]).drop("_v")


def latest_snapshot(measurements: DataFrame, keys=("location_id", "parameter"),
                    time_col: str = "datetime_utc") -> DataFrame:
    """E4 per series / A4 shape: the newest non-NULL reading per (station, parameter).

    ``max_by`` over (time, value) is a partial aggregation: each task keeps one row per key,
    so a station holding a large share of all rows is reduced before the shuffle.  The other
    columns (a station's name, if the readings carry one) come from the newest reading.
    """
    m = measurements.where(F.col("value").isNotNull())
    latest = latest_per_key(m, list(keys), [time_col, "value", "ingested_at", "sensor_id"])
    wanted = ["location_id", "location_name", "parameter", "value", "unit", time_col, "latitude", "longitude", "ingested_at"]
    return latest.select(*[c for c in wanted if c in latest.columns])
