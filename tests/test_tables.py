"""Named tables: a delivery rewrites the days it touches and no other, and gives what a full run gives."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.plans import mart
from airshed.plans.tables import MartTables
from airshed.session import shared_path


def readings(spark, rows):
    full = [(loc, loc * 10, p, v, "u", t, t + dt.timedelta(minutes=330), 28.0, 77.0, at) for loc, p, v, t, at in rows]
    return spark.createDataFrame(full, S.MEASUREMENTS)


def day_files(folder):
    return {d: sorted(f for f in os.listdir(os.path.join(folder, d)) if f.startswith("part-")) for d in os.listdir(folder) if d.startswith("day=")}


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_incremental_equals_full_and_rewrites_only_its_days(spark):
    t = lambda d, h: dt.datetime(2024, 3, d, h, 15)
    one = readings(spark, [(s, p, 10.0 * s + h, t(d, h), "a") for s in (1, 2) for p in ("pm25", "pm10") for d in (1, 2, 3, 4) for h in (0, 5, 23)])
    two = readings(spark, [(1, "pm25", 99.0, t(2, 5), "b"), (3, "pm25", 5.0, t(6, 1), "b"), (2, "pm25", None, t(2, 7), "b")])
    place, prefix = shared_path(spark, "test-tables").removeprefix("file:"), f"t_{uuid.uuid4().hex[:8]}"
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    tables = MartTables(spark, prefix).create(place)
    assert spark.table(tables.mart).count() == 0
    assert tables.deliver(one) == [dt.date(2024, 3, d) for d in (1, 2, 3, 4)]
    before = day_files(f"{place}/{tables.mart}")
    assert tables.deliver(two) == [dt.date(2024, 3, 2), dt.date(2024, 3, 6)]
    after = day_files(f"{place}/{tables.mart}")
    assert {d for d in after if after[d] != before.get(d)} == {"day=2024-03-02", "day=2024-03-06"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"                      # the caller's setting is back
    full = mart.mart_hourly(tables.clean()).withColumn("day", F.to_date("hour_utc"))
    assert rows_of(spark.table(tables.mart)) == rows_of(full)
    corrected = spark.table(tables.mart).where("location_id = 1 and hour_utc = timestamp_ntz'2024-03-02 05:00:00'").first()
    assert corrected["pm25"] == 99.0 and corrected["pm10"] == 15.0
    # the views beside the table
    assert spark.table(f"{prefix}_stg_measurements").count() == spark.table(f"{prefix}_int_cleaned").count() == one.count() + 1
    # the same folders under a catalog that does not know them
    again = MartTables(spark, prefix)
    for name in (tables.mart, tables.measurements):
        spark.sql(f"DROP TABLE {name}")
    again.create(place)
    assert rows_of(spark.table(again.mart)) == rows_of(full)


def test_a_day_that_loses_its_valid_readings_leaves_the_mart(spark):
    t = lambda d: dt.datetime(2024, 3, d, 3, 0)
    tables = MartTables(spark, f"t_{uuid.uuid4().hex[:8]}").create(shared_path(spark, "test-tables"))
    tables.deliver(readings(spark, [(1, "pm25", 10.0, t(1), "a"), (1, "pm25", 10.0, t(2), "a")]))
    tables.deliver(readings(spark, [(1, "pm25", -5.0, t(2), "b")]))       # corrected to an invalid value
    assert [r["day"] for r in spark.table(tables.mart).select("day").collect()] == [dt.date(2024, 3, 1)]
    tables.deliver(readings(spark, []))
    assert tables.refresh() == [dt.date(2024, 3, 1)] and spark.table(tables.mart).count() == 1


def test_only_the_days_asked_for_are_read(spark):
    tables = MartTables(spark, f"t_{uuid.uuid4().hex[:8]}").create(shared_path(spark, "test-tables"))
    tables.deliver(readings(spark, [(1, "pm25", 1.0, dt.datetime(2024, 3, d, 3), "a") for d in range(1, 9)]))
    read = {f.split("day=")[1][:10] for f in spark.table(tables.measurements).where(F.col("day").isin([dt.date(2024, 3, 4)])).inputFiles()}
    assert read == {"2024-03-04"} and tables.clean([dt.date(2024, 3, 4)]).count() == 1
