"""The models as named tables and views, refreshed by the days a delivery touches.

Staging and intermediate are views, the mart is a table, as the reference configures its models.  Raw measurements
and the mart are catalog tables in folders by day (UTC).  A reading's key holds its time, so re-deliveries of it lie in
one day, and an hour of the mart is in one day too: a delivery can only change the days it has rows of.  ``deliver`` appends its rows,
reads these days' folders alone, and overwrites these days of the mart.

Appending and overwriting are jobs of their own: after a failure between them ``refresh`` for the same days (or the delivery once
more, as later copies of a reading replace earlier ones) brings the mart up to date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.operators import dedup
from airshed.plans import mart
from airshed.session import materialize
from airshed.sources.sinks import dynamic_overwrite

@dataclass(frozen=True)
class MartTables:
    """Names of the two tables and two views."""

    spark: SparkSession
    prefix: str

    @property
    def measurements(self) -> str:
        return f"{self.prefix}_raw_measurements"

    @property
    def mart(self) -> str:
        return f"{self.prefix}_mart_hourly"

    def create(self, location: str) -> "MartTables":
        """Create the tables in folders below ``location`` (what lies there already is taken up) and the views."""
        empty = self.spark.createDataFrame([], S.MEASUREMENTS)
        for name, df in ((self.measurements, empty), (self.mart, mart.mart_hourly(empty))):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, day DATE) USING parquet PARTITIONED BY (day) LOCATION '{location.rstrip('/')}/{name}'")
            folder = self._folder(name)
            fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            if fs.exists(folder):
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        self.clean().createOrReplaceTempView(f"{self.prefix}_clean_measurements")
        mart.staging(self.spark.table(f"{self.prefix}_clean_measurements")).createOrReplaceTempView(f"{self.prefix}_stg_measurements")
        mart.intermediate(self.spark.table(f"{self.prefix}_stg_measurements")).createOrReplaceTempView(f"{self.prefix}_int_cleaned")
        return self

    def clean(self, days: list[dt.date] | None = None) -> DataFrame:
        """One row for each reading (E10), of all days or of those given: only their folders are read."""
        rows = self.spark.table(self.measurements)
        if days is not None:
            rows = rows.where(F.col("day").isin(days))
        return dedup.dedup_measurements(rows.drop("day"))

    def _insert(self, table: str, df: DataFrame, overwrite: bool) -> None:
        columns = [c for c in self.spark.table(table).columns]
        # rows of a day are brought together, in parts of an even size however uneven the days are
        df.select(*columns).hint("rebalance", F.col("day")).write.insertInto(table, overwrite=overwrite)

    def append(self, delivery: DataFrame) -> list[dt.date]:
        """Add a delivery to the raw table; returns the days it has rows of (a calendar's worth of dates)."""
        rows = delivery.where(F.col("datetime_utc").isNotNull()).withColumn("day", F.to_date("datetime_utc"))
        self._insert(self.measurements, rows, overwrite=False)
        return sorted(r["day"] for r in rows.select("day").distinct().collect())

    def refresh(self, days: list[dt.date] | None = None) -> list[dt.date]:
        """Rebuild the mart of ``days`` (of all, if none are given); returns the days that have rows in it now."""
        if days is not None and not days:
            return []
        if days is None:
            days = [r["day"] for r in self.spark.table(self.measurements).select("day").distinct().collect()]
        rows = materialize(mart.mart_hourly(self.clean(days)).withColumn("day", F.to_date("hour_utc")))
        now = {r["day"] for r in rows.select("day").distinct().collect()}
        with dynamic_overwrite(self.spark):
            self._insert(self.mart, rows, overwrite=True)
        # a day whose readings are all invalid now has written nothing, so nothing has overwritten its folder
        for day in sorted((set(days) - now) & self.mart_days()):
            self.spark.sql(f"ALTER TABLE {self.mart} DROP IF EXISTS PARTITION (day = DATE '{day}') PURGE")
            self._delete_folder(day)
        return sorted(now)

    def mart_days(self) -> set[dt.date]:
        """The days of the mart, by the catalog."""
        return {dt.date.fromisoformat(r["partition"].removeprefix("day=")) for r in self.spark.sql(f"SHOW PARTITIONS {self.mart}").collect()}

    def _folder(self, table: str, below: str = ""):
        location = self.spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location + below)

    def _delete_folder(self, day: dt.date) -> None:
        """Dropping a partition of a table with a location of its own leaves the files: a later repair would bring them back."""
        folder = self._folder(self.mart, f"/day={day}")
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def deliver(self, delivery: DataFrame) -> list[dt.date]:
        """Append a delivery and rebuild the days it touches; returns these."""
        days = self.append(delivery)
        self.refresh(days)
        return days
