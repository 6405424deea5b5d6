"""Streams that keep what they have landed instead of a long state: first deliveries (I5) and the mart with its late rows.

Both are ``foreachBatch`` sinks over a table in folders by day.  A batch reads back only the days it has rows of, so the work of
a batch follows the batch and nothing is held between batches but the table itself, and a replayed batch changes nothing.

* ``FirstDeliveries``: a row whose key has landed before, however long ago, is left out by an anti join.
* ``MartWithLateRows``: hourly windows close when the watermark has passed them; a row for a closed hour is kept
  as late, counted, and ``restate`` corrects the hours concerned.  No row is lost: rows in = rows in windows + late rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.plans import mart
from airshed.session import materialize
from airshed.sources.versioned import VersionedTable

HOUR = 3_600_000_000


class LandedTable:
    """Rows in folders ``day=/batch=``: each batch owns its folders, so writing it again replaces them."""

    def __init__(self, spark: SparkSession, path: str, schema, day: str):
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.withColumns({"day": F.to_date(self.day), "batch": F.lit(batch_id).cast("long")})
        # a day's rows together, in even parts however uneven the days are; the batch may be of a session of its own
        (rows.hint("rebalance", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch").parquet(self.path))

    def read(self) -> DataFrame:
        """All rows with ``day`` and ``batch``; filters on these prune folders."""
        empty = self.spark.createDataFrame([], self.schema).withColumns({"day": F.lit(None).cast("date"), "batch": F.lit(None).cast("long")})
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return empty
        return self.spark.read.schema(empty.schema).parquet(self.path)


# ---- I5: first deliveries --------------------------------------------------------------

class FirstDeliveries:
    """The first delivery of each key, over any distance.

    Of deliveries in one batch the one with the smallest ``order`` (then the smallest row) counts.  ``keys`` must hold the time
    that ``day`` is taken from, so a key has one day and only the batch's days are looked up.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], time: str, order: str):
        self.landed = LandedTable(spark, path, schema, time)
        self.columns, self.keys, self.time, self.order = [f.name for f in schema.fields], list(keys), time, order

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in self.columns if c not in self.keys]
        first = (batch.select(*self.columns).groupBy(*self.keys)
                 .agg(F.min(F.struct(self.order, *[c for c in rest if c != self.order])).alias("_row"))
                 .select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*self.columns))
        first = materialize(first)
        days = [r["day"] for r in first.select(F.to_date(self.time).alias("day")).distinct().collect()]  # a calendar's worth
        before = self.landed.read().where(F.col("day").isin(days) & (F.col("batch") < batch_id)).select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        on = same[0]
        for s in same[1:]:
            on = on & s
        self.landed.write(first.join(before, on, "left_anti"), batch_id)

    def read(self) -> DataFrame:
        return self.landed.read().select(*self.columns)


# ---- I1: the mart and its late rows ----------------------------------------------------

class MartWithLateRows:
    """Hourly mart of a measurement stream, its landed rows and those that came late.

    The watermark is the latest time of earlier batches less ``delay_hours``; it is committed with the mart's version, so a batch that
    comes again finds the watermark it had.  Each hour enters the mart once, when the watermark passes its end.
    """

    def __init__(self, spark: SparkSession, path: str, schema, delay_hours: float = 1.0, name: str = "mart"):
        self.spark, self.name, self.delay = spark, name, int(delay_hours * HOUR)
        self.schema = schema
        self.columns = [f.name for f in schema.fields]
        self.landed = LandedTable(spark, f"{path}/landed", spark.createDataFrame([], schema).withColumn("late", F.lit(False)).schema, "datetime_utc")
        self.mart = VersionedTable(spark, f"{path}/mart", mart.MART_KEYS)

    @staticmethod
    def _ends() -> Column:
        """The end of a row's hour, in microseconds."""
        return F.unix_micros(F.date_trunc("hour", F.col("datetime_utc").cast("timestamp"))) + F.lit(HOUR)

    def _mark(self, manifest: dict) -> int | None:
        return manifest["batches"].get(f"{self.name}.watermark")

    def _close(self, base: dict, upto: int | None, batch_id: int) -> None:
        """Commit the hours that end behind the old watermark and not behind ``upto``, and the new watermark."""
        old, marks = self._mark(base), {self.name: batch_id}
        rows = self.landed.read().where("not late").where(F.col("batch") <= batch_id)
        if upto is not None:
            marks[f"{self.name}.watermark"] = upto
            open_ = (self._ends() <= upto) & ((self._ends() > old) if old is not None else F.lit(True))
            days = F.col("day") <= F.to_date(F.timestamp_micros(F.lit(upto)))
            if old is not None:
                days = days & (F.col("day") >= F.to_date(F.timestamp_micros(F.lit(old - HOUR))))
            rows = rows.where(days & open_)
        else:
            rows = rows.where(F.lit(False))
        self.mart._next(mart.mart_hourly(rows.select(*self.columns)), "upsert", True, batches=base["batches"] | marks, base=base)

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        base = self.mart.manifest()
        if batch_id <= base["batches"].get(self.name, -1):
            return
        old = self._mark(base)
        late = (self._ends() <= old) if old is not None else F.lit(False)
        self.landed.write(batch.select(*self.columns, F.coalesce(late, F.lit(False)).alias("late")), batch_id)
        newest = batch.agg(F.max(F.unix_micros(F.col("datetime_utc").cast("timestamp")))).first()[0]
        upto = old if newest is None else max(newest - self.delay, old if old is not None else newest - self.delay)
        self._close(base, upto, batch_id)

    def close_all(self) -> None:
        """At the end of the stream: the hours that are still open enter the mart."""
        base = self.mart.manifest()
        newest = self.landed.read().agg(F.max(self._ends())).first()[0]
        if newest is not None:
            self._close(base, max(newest, self._mark(base) or newest), base["batches"].get(self.name, -1))

    def counts(self) -> dict[str, int]:
        """Rows in, rows in closed windows, rows in open ones and late rows."""
        mark = self._mark(self.mart.manifest())
        closed = ~F.col("late") & ((self._ends() <= mark) if mark is not None else F.lit(False))
        r = self.landed.read().agg(F.count(F.lit(1)).alias("rows"), F.count_if(closed).alias("closed"), F.count_if("late").alias("late")).first()
        return {"rows": r["rows"], "closed": r["closed"], "late": r["late"], "open": r["rows"] - r["closed"] - r["late"]}

    def restate(self) -> int:
        """Correct the mart's hours that late rows belong to, from all their rows; returns the late rows."""
        rows = self.landed.read()
        hour = F.date_trunc("hour", "datetime_utc")
        touched = materialize(rows.where("late").select("location_id", hour.alias("h"), "day").groupBy("location_id", "h", "day").agg(F.count(F.lit(1)).alias("n")))
        n, days = touched.agg(F.sum("n"), F.collect_set("day")).first()
        if not n:
            return 0
        again = (rows.where(F.col("day").isin(days)).withColumn("h", hour)
                 .join(touched.select("location_id", "h"), ["location_id", "h"], "left_semi"))
        self.mart.upsert(mart.mart_hourly(again.select(*self.columns)))
        return n


def run_sink(spark: SparkSession, stream: DataFrame, sink, checkpoint: str) -> None:
    """All that has landed and is not yet read, through a ``foreachBatch`` sink."""
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
