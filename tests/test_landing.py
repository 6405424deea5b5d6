"""Landed tables: first deliveries over any distance, the mart with late rows, replays; gaps and the hourly spine."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.operators import series as ser
from airshed.plans import mart
from airshed.session import shared_path
from airshed.streaming import landing as LD

T0, H = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)


def readings(spark, rows):
    """rows: (location, hours since T0, value, ingested_at)"""
    full = [(loc, loc * 10, "pm25", v, "u", T0 + h * H, T0 + h * H + dt.timedelta(minutes=330), 28.0, None if loc == 2 else 77.0, at) for loc, h, v, at in rows]
    return spark.createDataFrame(full, S.MEASUREMENTS)


def values(df):
    return sorted((r.location_id, (r.datetime_utc - T0) / H, r.value, r.ingested_at) for r in df.collect())


def test_first_deliveries_over_any_distance_and_replayed(spark):
    first = LD.FirstDeliveries(spark, shared_path(spark, "test-first"), S.MEASUREMENTS, ["location_id", "parameter", "datetime_utc"], "datetime_utc", "ingested_at")
    assert first.read().count() == 0
    a = readings(spark, [(1, 0, 1.0, "b"), (1, 0, 2.0, "a"), (1, 30, 3.0, "a"), (2, 0, None, "a")])
    b = readings(spark, [(1, 24 * 300, 4.0, "b"), (1, 0, 9.0, "0"), (2, 0, 9.0, "0"), (3, 0, 5.0, "b")])
    first.sink(a, 0)
    want = [(1, 0.0, 2.0, "a"), (1, 30.0, 3.0, "a"), (2, 0.0, None, "a")]
    assert values(first.read()) == want
    first.sink(b, 1)
    first.sink(b, 1)                                              # the same batch once more
    first.sink(a, 0)                                              # and an earlier one
    assert values(first.read()) == sorted(want + [(1, 7200.0, 4.0, "b"), (3, 0.0, 5.0, "b")])
    first.sink(readings(spark, []), 2)
    assert first.read().count() == 5


def test_no_row_of_the_mart_s_stream_is_lost(spark):
    ingest = LD.MartWithLateRows(spark, shared_path(spark, "test-late"), S.MEASUREMENTS)
    batches = [[(1, 0.1, 1.0, "a"), (1, 0.3, 3.0, "a"), (2, 5.5, 7.0, "a")],
               [(1, 0.2, 5.0, "a"), (2, 4.2, 1.0, "a"), (2, 8.0, None, "a")],       # hour 0 is closed (watermark 4:30), hour 4 is not
               [(1, 4.9, -1.0, "a"), (3, 2.5, 4.0, "a"), (1, 30.0, 6.0, "a")],
               []]
    for i, rows in enumerate(batches):
        ingest.sink(readings(spark, rows), i)
        if i == 1:
            version = ingest.mart.version()
            ingest.sink(readings(spark, rows), i)                  # committed: nothing happens
            assert ingest.mart.version() == version
    rows = [r for b in batches for r in b]
    assert ingest.counts() == {"rows": len(rows), "closed": 5, "late": 3, "open": 1}
    hours = lambda: {(r.location_id, int((r.hour_utc - T0) / H)): (r.pm25, r.measurement_count) for r in ingest.mart.read().collect()}
    assert hours() == {(1, 0): (2.0, 2), (2, 5): (7.0, 1), (2, 4): (1.0, 1)}
    ingest.close_all()
    assert hours()[1, 30] == (6.0, 1) and ingest.counts()["open"] == 0
    assert ingest.restate() == 3
    full = {(r.location_id, int((r.hour_utc - T0) / H)): (r.pm25, r.measurement_count) for r in mart.mart_hourly(readings(spark, rows)).collect()}
    assert hours() == full and full[1, 0] == (3.0, 3) and full[3, 2] == (4.0, 1)
    ingest.restate()
    assert hours() == full


def test_a_batch_that_failed_before_its_commit_is_written_again(spark):
    ingest = LD.MartWithLateRows(spark, shared_path(spark, "test-late"), S.MEASUREMENTS)
    ingest.sink(readings(spark, [(1, 0.1, 1.0, "a"), (1, 3.0, 2.0, "a")]), 0)
    half = readings(spark, [(1, 9.0, 3.0, "a")])
    ingest.landed.write(half.select(*ingest.columns, F.lit(False).alias("late")), 1)   # landed, but no version names it
    ingest.sink(half, 1)
    ingest.close_all()
    assert ingest.counts()["rows"] == 3 and sorted(r.measurement_count for r in ingest.mart.read().collect()) == [1, 1, 1]


@pytest.mark.parametrize("block", [4, 512])
def test_spine_and_gaps_equal_pandas(spark, block):
    hours = {1: [0, 1, 2, 5, 6, 30], 2: [10], 3: list(range(7, 40, 2))}
    rows = [(s, T0 + h * H, float(h) if h % 5 else None, f"x{h}") for s, hs in hours.items() for h in hs]
    df = spark.createDataFrame(rows, "series_id long, datetime timestamp_ntz, v double, note string").repartition(5)
    got = ser.hourly_spine(df, ["series_id"], block_rows=block).toPandas().sort_values(["series_id", "datetime"]).reset_index(drop=True)
    assert list(got.columns) == ["series_id", "datetime", "v", "note", "filled"]
    want = []
    for s, g in df.toPandas().groupby("series_id"):
        full = g.set_index("datetime").reindex(pd.date_range(g["datetime"].min(), g["datetime"].max(), freq="h"))
        want += [(s, t, None if pd.isna(r["v"]) else r["v"], None if pd.isna(r["note"]) else r["note"], pd.isna(r["note"])) for t, r in full.iterrows()]
    assert [(r.series_id, r.datetime, None if pd.isna(r.v) else r.v, None if pd.isna(r.note) else r.note, r.filled) for r in got.itertuples()] == want
    gaps = sorted((r.series_id, int((r.gap_start - T0) / H), int((r.gap_end - T0) / H), r.hours) for r in ser.hourly_gaps(df, ["series_id"], block_rows=block).collect())
    assert gaps == sorted((s, a + 1, b - 1, b - a - 1) for s, hs in hours.items() for a, b in zip(hs, hs[1:]) if b - a > 1)
    assert ser.hourly_spine(df.limit(0), ["series_id"]).count() == 0


def test_lags_on_the_spine_go_by_the_clock(spark):
    df = spark.createDataFrame([(1, T0 + h * H, float(h)) for h in (0, 1, 2, 4, 24, 26, 28)], "series_id long, datetime timestamp_ntz, v double")
    spine = ser.with_position(ser.hourly_spine(df, ["series_id"]), ["series_id"], ["datetime"])
    got = {r.datetime: (r.l2, r.l24) for r in ser.add_lags(spine, ["series_id"], "v", {"l2": 2, "l24": 24}).where("not filled").collect()}
    clock = {r.datetime: (r.l2, r.l24) for r in ser.add_time_lags(df, ["series_id"], "datetime", "v", {"l2": 2, "l24": 24}).collect()}
    assert got == clock
