"""Mergeable sketches: distinct counts (D5) and quantiles (D11) stored by day and merged when read.

Both are small tables of plain rows, so days are merged by one grouped aggregation, and the merge of stored days is the
sketch of the whole, row by row.

* Distinct values: of each value's hash the low ``BITS`` bits name a register, which keeps the largest place of the
  first set bit of the rest.  Registers merge by ``max``.  Standard error of the count: 1.04 / sqrt(2^BITS).
* Quantiles: values fall into buckets whose bounds grow by a constant factor; buckets merge by ``sum``.  A quantile read
  from them is within ``ALPHA`` of the exact one (the value of that rank), relative to it.  Negative values mirror positive ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 10
REGISTERS = 1 << BITS
ERROR = 1.04 / math.sqrt(REGISTERS)
ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
#: Bits of the hash (the first eight digits of the value's MD5).
HASH_BITS = 32


def _hash(col: Column) -> Column:
    return F.conv(F.substring(F.md5(col.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def distinct_sketch(df: DataFrame, groups: list[str], col: str) -> DataFrame:
    """``groups``, ``register``, ``place``: at most ``REGISTERS`` rows a group.  Nulls are no values."""
    h = _hash(F.col(col))
    rest = F.shiftright(h, BITS)
    width = HASH_BITS - BITS
    # the place of the first set bit counted from the top of the rest, width + 1 if there is none
    place = F.when(rest == 0, F.lit(width + 1)).otherwise(F.lit(width + 1) - F.length(F.bin(rest))).cast("int")
    return (df.where(F.col(col).isNotNull()).select(*groups, h.bitwiseAND(F.lit(REGISTERS - 1)).cast("int").alias("register"), place.alias("place"))
            .groupBy(*groups, "register").agg(F.max("place").alias("place")))


def merge_distinct(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "register").agg(F.max("place").alias("place"))


def distinct_estimate(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """``groups``, ``estimate``: the harmonic mean of the registers; few values are counted by the registers still empty."""
    empty = F.lit(REGISTERS) - F.count(F.lit(1))
    alpha = 0.7213 / (1 + 1.079 / REGISTERS)
    raw = F.lit(alpha * REGISTERS * REGISTERS) / (F.sum(F.pow(F.lit(2.0), -F.col("place"))) + empty)
    d = sketch.groupBy(*groups).agg(raw.alias("raw"), empty.alias("empty"))
    few = (F.col("raw") <= 2.5 * REGISTERS) & (F.col("empty") > 0)
    return d.select(*groups, F.when(few, F.lit(float(REGISTERS)) * F.log(F.lit(float(REGISTERS)) / F.col("empty"))).otherwise(F.col("raw")).alias("estimate"))


def quantile_sketch(df: DataFrame, groups: list[str], col: str) -> DataFrame:
    """``groups``, ``side`` (-1, 0, 1), ``bucket``, ``count``.  Nulls and NaN are no values."""
    v = F.col(col).cast("double")
    side = F.signum(v).cast("int")
    bucket = F.when(side == 0, F.lit(0)).otherwise(F.ceil(F.log(F.abs(v)) / math.log(GAMMA))).cast("int")
    return (df.where(v.isNotNull() & ~F.isnan(v)).select(*groups, side.alias("side"), bucket.alias("bucket"))
            .groupBy(*groups, "side", "bucket").agg(F.count(F.lit(1)).alias("count")))


def merge_quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "side", "bucket").agg(F.sum("count").alias("count"))


def quantiles(sketch: DataFrame, groups: list[str], shares: list[float]) -> DataFrame:
    """``groups``, ``share``, ``value``: the bucket that holds the value of rank floor(share * (n - 1)), as its middle.

    A group has as many rows as buckets are in use (some hundreds for values over many powers of ten).
    """
    order = Window.partitionBy(*groups).orderBy("side", F.col("side") * F.col("bucket"))
    d = sketch.withColumns({"upto": F.sum("count").over(order), "n": F.sum("count").over(Window.partitionBy(*groups))})
    middle = F.col("side") * F.lit(2.0) * F.pow(F.lit(GAMMA), F.col("bucket").cast("double")) / F.lit(GAMMA + 1)
    d = d.withColumn("value", F.when(F.col("side") == 0, F.lit(0.0)).otherwise(middle))
    d = d.select(*groups, "n", "upto", (F.col("upto") - F.col("count")).alias("before"), "value", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    rank = F.floor(F.col("share") * (F.col("n") - 1))
    return d.where((F.col("before") <= rank) & (rank < F.col("upto"))).select(*groups, "share", "value")
