"""Sinks (A5, A6, A8, A11, A14): Parquet writes into shared storage.

``write_replace`` and ``write_partitioned`` overwrite their folder, so they are for folders that no one reads meanwhile (a fresh
one for each run).  ``upsert_table`` writes the new version of a table to a fresh folder of its own; ``sources.versioned`` adds the
pointer to the live version, committed atomically, for tables that are read while they are written.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed import schemas as S
from airshed.operators.dedup import upsert


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """Within it, an overwrite replaces the partitions that are written and no others; the caller's setting comes back."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def write_replace(df: DataFrame, path: str) -> str:
    """A5: replace the table."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_append(df: DataFrame, path: str) -> str:
    """Append a batch; duplicates are resolved on read by E10."""
    df.write.mode("append").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, t: str = "datetime") -> str:
    """Keep the time index as a column and partition by year/month so time filters prune.

    Rows of a month are brought together before the write, in parts of an even size however uneven the months are: not one
    file for each task and month.
    """
    (df.withColumn("year", F.year(t)).withColumn("month", F.month(t)).hint("rebalance", F.col("year"), F.col("month"))
       .write.mode("overwrite").partitionBy("year", "month").parquet(path))
    return path


def read_partitioned(spark: SparkSession, path: str, year: int | None = None,
                     month: int | None = None, schema=None) -> DataFrame:
    """A7 + partition pruning: only the matching ``year=/month=`` folders are listed and read.

    ``schema`` (of the written columns) lets a table without any row, which has no file, be read.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]))
    df = reader.parquet(path)
    if year is not None:
        df = df.where(F.col("year") == year)
    if month is not None:
        df = df.where(F.col("month") == month)
    return df


def with_result_defaults(df: DataFrame, inserted_at: Column | None = None, keys=()) -> DataFrame:
    """Conform to the predictions table schema (behind the key columns of a table of several
    series) and add ``inserted_at`` (default: now)."""
    ts = inserted_at if inserted_at is not None else F.current_timestamp()
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.PREDICTIONS.fields]
    return df.select(*keys, *cols, ts.cast("timestamp").alias("inserted_at"))


def upsert_table(spark: SparkSession, current_path: str | None, new_rows: DataFrame,
                 keys: list[str], target_path: str) -> str:
    """Write ``current (+) new_rows`` (new wins per key) as a new version at ``target_path``.

    The caller swaps the table pointer to ``target_path`` after this returns; the previous
    version stays readable until then (one writer at a time).
    """
    if current_path is None:
        merged = new_rows
    else:
        merged = upsert(spark.read.parquet(current_path), new_rows, keys)
    merged.write.mode("errorifexists").parquet(target_path)
    return target_path
