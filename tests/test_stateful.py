"""transformWithState streams: order inside the delay, expiry, initial state, restarts, bounded state; the nowcast stream
against the batch cycles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.catalog.q_ml import NOWCAST_MODEL
from airshed.catalog import q_stateful as Q
from airshed.plans import runs as R
from airshed.session import materialize, shared_path
from airshed.sources.versioned import VersionedTable
from airshed.streaming import jobs as ST
from airshed.streaming import stateful as Z

T0, H = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
SCHEMA = "series_id long, datetime timestamp_ntz, pm2_5 double"


class Feed:
    """A landing folder, an output folder and a checkpoint."""

    def __init__(self, spark, history=None, delay="6 hours", idle=20):
        ST.configure_streaming(spark)
        self.spark, self.history, self.delay, self.idle = spark, history, delay, idle
        self.landing, self.out, self.checkpoint = (shared_path(spark, f"test-{x}") for x in ("in", "out", "ck"))

    def land(self, *hours):
        rows = [(s, T0 + h * H, v) for s, h, v in hours]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)

    def run(self):
        src = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.landing)
        out = Z.ordered_lag_stream(src, self.delay, self.idle * 3600, self.history)
        q = (out.writeStream.outputMode("append").format("parquet").option("path", self.out)
             .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        rows = self.spark.read.parquet(self.out).orderBy("series_id", "datetime", "event").collect()
        return [(r.series_id, int((r.datetime - T0) / H), r.pm2_5, r.pm2p5_lag_1h, r.pm2p5_lag_2h, r.pm2p5_lag_24h, r.event) for r in rows], q

    def state(self, name):
        return self.spark.read.format("statestore").option("path", self.checkpoint).option("stateVarName", name).load()


def test_order_history_expiry_and_restart(spark):
    past = spark.createDataFrame([(1, T0 + i * H, float(i)) for i in range(30)], SCHEMA)
    f = Feed(spark, Z.initial_history(past))
    f.land(*[(1, h, float(h)) for h in (33, 30, 32, 31, 34)], (2, 31, 1.5))
    f.land(*[(1, h, float(h)) for h in (37, 35, 36)], (1, 35, -1.0))        # out of turn; the second reading of an hour is none
    first, _ = f.run()
    assert first == [(1, 30, 30.0, 29.0, 28.0, 6.0, "reading"), (1, 31, 31.0, 30.0, 29.0, 7.0, "reading"), (2, 31, 1.5, None, None, None, "reading")]
    f.land((2, 60, 2.5), (1, 33, 99.0))                                     # 33 waits already; the watermark is at 31 while this is read
    f.land((2, 100, 3.5))
    again, _ = f.run()                                                      # a new run from the same checkpoint
    assert again[:len(first) - 1] == first[:2]
    assert [x for x in again if x[0] == 1 and x[6] == "reading"][2:] == [(1, h, float(h), h - 1.0, h - 2.0, h - 24.0, "reading") for h in range(32, 38)]
    assert [x for x in again if x[6] == "expired"] == [(1, 37, None, None, None, None, "expired")]
    assert [x for x in again if x[0] == 2] == [(2, 31, 1.5, None, None, None, "reading"), (2, 60, 2.5, 1.5, None, None, "reading")]
    assert [r[0] for r in f.state("history").select("key.series_id").distinct().collect()] == [2]  # series 1 is forgotten


def test_what_is_behind_the_watermark_is_counted(spark):
    f = Feed(spark, delay="2 hours", idle=1000)
    f.land((1, 10, 1.0))
    f.land((1, 20, 2.0))
    f.land((1, 5, 9.0), (1, 19, 3.0))
    f.land((1, 40, 4.0))
    rows, q = f.run()
    assert [x[1] for x in rows] == [10, 19, 20]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_state_of_a_hot_series_is_bounded(spark):
    f = Feed(spark, delay="3 hours", idle=10000)
    for part in range(4):
        f.land(*[(1, h, float(h)) for h in range(part * 200, part * 200 + 200)], (2, part * 200, 0.0))
    rows, _ = f.run()
    assert [x[1] for x in rows if x[0] == 1] == list(range(797))
    assert all(x[5] == (x[1] - 24.0 if x[1] >= 24 else None) for x in rows if x[0] == 1)
    per_key = {r["series_id"]: r["n"] for r in f.state("history").groupBy("key.series_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_key[1] == Z.HISTORY and f.state("pending").count() <= 4


@pytest.fixture(scope="module")
def feeds(spark):
    """Three series with every model input, overlapping in time, some hours and values missing."""
    air, weather = [], []
    for s in (1, 2, 3):
        for h in range(10 * s, 160):
            if (h + s) % 13:
                air.append((s, T0 + h * H, None if h % 29 == s else 10.0 + h % 7 + s, 20.0 + h % 5, 5.0 + h % 3))
            if (h * s) % 11 != 3:
                weather.append((s, T0 + h * H, 15.0 + h % 9, 3.0, 100.0 + h))
    return (spark.createDataFrame(air, "series_id long, datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in S.AIR_FEED_COLUMNS)),
            spark.createDataFrame(weather, "series_id long, datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in S.WEATHER_FEED_COLUMNS)))


def test_nowcast_stream_equals_the_batch_cycles_with_replays(spark, feeds, monkeypatch):
    monkeypatch.setattr(Q, "FIRST_CYCLE", "2024-01-03 00:00:00")
    monkeypatch.setattr(Q, "LAST_CYCLE", "2024-01-07 00:00:00")
    monkeypatch.setattr(Q, "CYCLE_HOURS", 4)
    rows = materialize(Q.cycle_deliveries(*feeds))
    assert rows.select("cycle").distinct().count() == 25
    landing, checkpoint = shared_path(spark, "test-landing"), shared_path(spark, "test-ck")
    table = VersionedTable(spark, shared_path(spark, "test-nowcast"), ["series_id", "datetime"])
    for lo, hi in ((0, 9), (9, 18)):
        Q.land_deliveries(rows.where((F.col("cycle") >= lo) & (F.col("cycle") < hi)), landing)
    Z.run_nowcast_stream(spark, landing, NOWCAST_MODEL, table, checkpoint, max_files=2)
    before = table.version()
    Z.run_nowcast_stream(spark, landing, NOWCAST_MODEL, table, checkpoint, max_files=2)
    assert table.version() == before                                        # nothing new: nothing committed
    Q.land_deliveries(rows.where(F.col("cycle") < 9), landing)              # delivered once more
    Q.land_deliveries(rows.where(F.col("cycle") >= 18), landing)
    Z.run_nowcast_stream(spark, landing, NOWCAST_MODEL, table, checkpoint, max_files=2)
    got = {(r.series_id, r.datetime): (r.pm25_observe, r.pm25_xgboost, r.pm25_cams, r.depasse_oms, r.status) for r in table.read().collect()}
    want, scored = {}, 0
    for c in range(25):
        ok, skipped = R.nowcast_rows(*feeds, NOWCAST_MODEL, str(dt.datetime(2024, 1, 3, 0, 20) + 4 * c * H))
        for r in ok.collect():
            want[r.series_id, r.datetime] = (r.pm25_observe, r.pm25_xgboost, r.pm25_cams, r.depasse_oms, "scored")
        for r in skipped.collect():
            want[r.series_id, r.datetime] = "skipped"
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k][4] == "skipped" if v == "skipped" else got[k] == v
    assert len({k[0] for k, v in want.items() if v != "skipped"}) == 3 and "skipped" in want.values()
    # a batch that was committed to the table but not to the checkpoint comes again under the same number
    replay = table.write_batches("nowcast", lambda b: Z.scored_cycles(b, NOWCAST_MODEL))
    replay(spark.createDataFrame([], Z.nowcast_stream(Z.delivery_stream(spark, landing, 1)).schema), 0)
    assert len(got) == table.read().count()
