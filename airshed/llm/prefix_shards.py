"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-partitioned by key (only key, size and checksum travel, never the text) and written
sorted; each partition's byte and row totals give, by a running sum over the small table of
totals, the number of bytes in front of every partition.  With the running sum inside the partition
each row knows its global byte offset and falls into the shard its middle byte lies in: the cuts
are at equal targets, shards are contiguous in key order, and no task sees more than one
range partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import number_of, numbered, prepare, refuse, written


def contiguous_shards(df: DataFrame, shards: int, key: str, size: str) -> DataFrame:
    """``df`` (narrow: key, size and what else should be carried) with ``shard`` and ``slot``.

    Order: ``key`` (null first), then the other columns, then an arbitrary but fixed order among
    rows equal in all columns.  ``shard`` is ``floor(shards * middle / total)`` of the row's middle
    byte; shards are balanced to within one row's size.  ``slot`` numbers a shard's rows from 0
    without gaps.  A table with no bytes at all puts every row into shard 0; an empty table
    gives an empty result.  Null sizes count as 0.  Columns may have any name but ``shard`` and ``slot``, which
    raise ``ValueError``.
    """
    prepare(df.sparkSession)
    refuse(df.columns, ["shard", "slot"])
    key, size, names, df = number_of(df, key), number_of(df, size), df.columns, numbered(df)
    order = [key] + [c for c in df.columns if c != key]
    # the last column spreads a run of identical rows over several range partitions
    src = df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    ranged = src.repartitionByRange(*[F.col(f"`{c}`") for c in order], "_tie").withColumn("_part", F.spark_partition_id())
    # written once: offsets and rows below must see one and the same partitioning
    rows = written(ranged, "shards-rows")
    bytes_ = F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long")

    # one row for each range partition
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_part").agg(F.sum(bytes_).alias("_bytes"))
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("_part", F.coalesce(F.sum("_bytes").over(ahead), F.lit(0)).alias("_ahead"),
                           F.sum("_bytes").over(whole).alias("_total"))
    within = Window.partitionBy("_part").orderBy(*[F.col(f"`{c}`") for c in order], "_tie")
    placed = (rows.join(totals, "_part")
              .withColumn("_end", F.col("_ahead") + F.sum(bytes_).over(within.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("shard", F.when(F.col("_total") > 0, F.least(
                  F.lit(shards - 1), F.expr(f"((2 * _end - coalesce(`{size}`, 0)) * {shards}) div (2 * _total)")))
                  .otherwise(0).cast("int"))
              .drop("_ahead", "_end", "_total"))
    placed = written(placed, "shards-placed")
    # rows of a shard in front of each partition: one row for each (partition, shard)
    counts = placed.groupBy("_part", "shard").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_part = Window.partitionBy("_part", "shard").orderBy(*[F.col(f"`{c}`") for c in order], "_tie")
    return (placed.withColumn("_row", F.row_number().over(in_part))
            .join(counts, ["_part", "shard"])
            .withColumn("slot", (F.col("_before") + F.col("_row") - 1).cast("long"))
            .select(*df.columns, "shard", "slot").toDF(*names, "shard", "slot"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, UTF-8 size plus 1 and CRC-32 of each text (null text: no bytes)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
