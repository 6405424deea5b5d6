"""Stateful streams on ``transformWithState``: ordered lags (I4) and the nowcast cycle (I3 + K8).

Both keep a bounded state for each series, in typed state variables of the RocksDB store, and read it whole with
one call a micro-batch, not once a row.

* ``ordered_lag_stream``: readings wait in a list until the watermark has passed them, so what comes late inside
  the delay is put in order before lags are taken.  The last 24 readings are the only history.  An event-time timer ends an
  idle series and frees its state.  A batch table can give each series its first history.
* ``nowcast_stream``: deliveries (a series' new air and weather hours and its forecast at a cycle) update the two windows of 48
  hours; each cycle gives one feature row.  ``score_into`` guards, scores and upserts these in the same query.

Times travel as whole seconds since the epoch (UTC) in state and as ``timestamp_ntz`` outside.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from airshed import schemas as S
from airshed.functions import aqi as A
from airshed.operators.dedup import latest_per_key
from airshed.plans import features as FE
from airshed.plans import ml as ML
from airshed.sources.versioned import VersionedTable
from airshed.streaming.jobs import configure_streaming

HISTORY = 24
LAGS = (("pm2p5_lag_1h", 1), ("pm2p5_lag_2h", 2), ("pm2p5_lag_24h", 24))


def seconds(col) -> Column:
    return F.unix_seconds(F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp"))


def from_seconds(col) -> Column:
    return F.timestamp_seconds(col).cast("timestamp_ntz")


# ---- I4: ordered lags ------------------------------------------------------------------

class LagProcessor(StatefulProcessor):
    """State of a series: ``history`` (its last 24 readings given out), ``pending`` (readings that the watermark has not
    passed), ``last`` (time of its newest reading).

    Timers: one at the earliest pending reading and one at the end of the idle time.  A reading is given out once,
    in order of time, when the watermark has reached it; of readings of one time the first to come counts.
    """

    READING = "at long, value double"

    def __init__(self, idle_seconds: int):
        self.idle = idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", self.READING)
        self.pending = handle.getListState("pending", self.READING)
        self.last = handle.getValueState("last", "at long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        given = sorted((r["at"], r["value"]) for r in initialState["readings"])[-HISTORY:]
        if given:
            self.history.put(given)
            self._touch(given[-1][0])

    def _touch(self, newest: int) -> None:
        """Move the end of the idle time behind the newest reading."""
        known = self.last.get()[0] if self.last.exists() else None
        if known is None or newest > known:
            if known is not None:
                self.handle.deleteTimer(1000 * (known + self.idle))
            self.last.update((newest,))
            self.handle.registerTimer(1000 * (newest + self.idle))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        waiting = list(self.pending.get()) if self.pending.exists() else []
        given_out = {r[0] for r in self.history.get()} if self.history.exists() else set()
        new, seen = [], given_out | {r[0] for r in waiting}
        for r in rows:  # one micro-batch of one series
            if r["at"] not in seen:
                seen.add(r["at"])
                new.append((r["at"], r["value"]))
        if new:
            earliest = min(r[0] for r in new)
            before = min((r[0] for r in waiting), default=None)
            if before is None or earliest < before:
                if before is not None:
                    self.handle.deleteTimer(1000 * before)
                self.handle.registerTimer(1000 * earliest)
            self.pending.appendList(new)
            self._touch(max(r[0] for r in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(self.pending.get(), key=lambda r: r[0]) if self.pending.exists() else []
        due = [r for r in waiting if 1000 * r[0] <= watermark]
        if due:
            rest = waiting[len(due):]
            if rest:
                self.pending.put(rest)
                self.handle.registerTimer(1000 * rest[0][0])
            else:
                self.pending.clear()
            line = (list(self.history.get()) if self.history.exists() else [])
            start, line = len(line), line + due
            self.history.put(line[-HISTORY:])
            for i in range(start, len(line)):
                lags = {name: line[i - k][1] if i >= k else None for name, k in LAGS}
                yield Row(series_id=key[0], at=line[i][0], pm2_5=line[i][1], **lags, event="reading")
        last = self.last.get()[0] if self.last.exists() else None
        if last is not None and expiredTimerInfo.getExpiryTimeInMs() == 1000 * (last + self.idle) and not self.pending.exists():
            self.history.clear()
            self.last.clear()
            yield Row(series_id=key[0], at=last, pm2_5=None, **{name: None for name, _ in LAGS}, event="expired")


LAG_ROW = "series_id long, at long, pm2_5 double, " + ", ".join(f"{n} double" for n, _ in LAGS) + ", event string"


def initial_history(readings: DataFrame) -> DataFrame:
    """The last 24 readings of each series of a batch table (series_id, datetime, pm2_5), one row a series.

    Bounded before it is gathered: each task keeps 24 rows of a series.
    """
    rank = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("datetime")))
    last = readings.select("series_id", "datetime", "pm2_5", rank.alias("rank")).where(F.col("rank") <= HISTORY)
    return last.groupBy("series_id").agg(F.collect_list(F.struct(seconds("datetime").alias("at"), F.col("pm2_5").alias("value"))).alias("readings"))


def ordered_lag_stream(feed: DataFrame, delay: str, idle_seconds: int, history: DataFrame | None = None) -> DataFrame:
    """I4: series_id, datetime, pm2_5 of a stream with the lags of ``pm2_5`` in order of time, and ``event``.

    ``event`` is ``reading``, or ``expired`` for the row that says that a series had no reading for ``idle_seconds`` of event
    time and has been forgotten.  Readings later than ``delay`` are left out by the watermark (the query's progress counts them as
    ``numRowsDroppedByWatermark``).  ``history``: ``initial_history`` of what came before the stream.
    """
    rows = feed.select("series_id", F.col("datetime").cast("timestamp").alias("event_time"), seconds("datetime").alias("at"), F.col("pm2_5").cast("double").alias("value"))
    out = (rows.withWatermark("event_time", delay).groupBy("series_id")
           .transformWithState(LagProcessor(idle_seconds), LAG_ROW, "Append", "EventTime", history.groupBy("series_id") if history is not None else None))
    return out.select("series_id", from_seconds("at").alias("datetime"), "pm2_5", *[n for n, _ in LAGS], "event")


# ---- I3 + K8: nowcast ------------------------------------------------------------------

WINDOW = 48
AIR = ["pm2_5", "pm10", "no2"]
WEATHER = ["temp_c", "vent_kmh", "blh_m"]


class NowcastProcessor(StatefulProcessor):
    """State of a series: its last 48 air and 48 weather hours and the last cycle given out.

    A delivery's hours replace those of equal time.  A cycle gives the newest hour of the two windows, aligned, with its
    positional lags and the first forecast value; a cycle that is not newer than the last one (a delivery that came twice, or out of
    turn) corrects hours but gives nothing out again.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.air = handle.getListState("air", "at long, " + ", ".join(f"{c} double" for c in AIR))
        self.weather = handle.getListState("weather", "at long, " + ", ".join(f"{c} double" for c in WEATHER))
        self.cycle = handle.getValueState("cycle", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        windows = [{r[0]: tuple(r[1:]) for r in s.get()} if s.exists() else {} for s in (self.air, self.weather)]
        done = self.cycle.get()[0] if self.cycle.exists() else None
        out = []
        for r in sorted(rows, key=lambda r: r["asof"]):  # one micro-batch of one series
            for window, new, columns in zip(windows, (r["air"], r["weather"]), (AIR, WEATHER)):
                window.update({x["at"]: tuple(x[c] for c in columns) for x in new or [] if x["at"] <= r["asof"]})
                for old in sorted(window)[:-WINDOW]:
                    del window[old]
            if done is not None and r["asof"] <= done:
                continue
            done = r["asof"]
            air, weather = windows
            hours = sorted(set(air) | set(weather))
            if hours:
                pm = [air.get(h, (None,) * 3)[0] for h in hours]
                ahead = min((x for x in r["forecast"] or [] if x["at"] > done), key=lambda x: x["at"], default=None)
                out.append(Row(series_id=key[0], asof=done, at=hours[-1], **dict(zip(AIR, air.get(hours[-1], (None,) * 3))),
                               **dict(zip(WEATHER, weather.get(hours[-1], (None,) * 3))),
                               **{name: pm[-1 - k] if len(pm) > k else None for name, k in LAGS}, cams=ahead["pm2_5"] if ahead else None))
        for state, window in zip((self.air, self.weather), windows):
            if window:
                state.put([(h, *window[h]) for h in sorted(window)])
        if done is not None:
            self.cycle.update((done,))
        return iter(out)


NOWCAST_ROW = ("series_id long, asof long, at long, " + ", ".join(f"{c} double" for c in AIR + WEATHER + [n for n, _ in LAGS]) + ", cams double")

_HOURLY = lambda columns: "struct<time: array<string>, " + ", ".join(f"{c}: array<double>" for c in columns) + ">"
#: A delivery as landed: one JSON document for a series and a cycle.
DELIVERY = (f"series_id long, asof string, air {_HOURLY(S.AIR_FEED_COLUMNS)}, weather {_HOURLY(S.WEATHER_FEED_COLUMNS)}, "
            f"forecast {_HOURLY(['pm2_5'])}")


def _hours(block: str, columns: list[str]) -> Column:
    """A columnar block as an array of hours, columns renamed as the features call them; an absent block is no hours."""
    zipped = F.arrays_zip(*[F.col(f"{block}.{c}").alias(c) for c in ["time", *columns]])
    # an element of a block is an hour; names are the features' own
    return F.transform(zipped, lambda x: F.struct(F.unix_seconds(F.to_timestamp_ntz(x["time"]).cast("timestamp")).alias("at"),
                                                  *[x[c].alias(S.REALTIME_RENAMES.get(c, c)) for c in columns]))


def delivery_stream(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """Landed deliveries below ``path`` as a stream, ``max_files`` files a micro-batch, in the order of landing."""
    raw = spark.readStream.schema(DELIVERY).option("maxFilesPerTrigger", max_files).json(path)
    return raw.where("series_id is not null and asof is not null").select(
        "series_id", F.date_trunc("hour", F.to_timestamp_ntz("asof")).alias("asof"), _hours("air", S.AIR_FEED_COLUMNS).alias("air"),
        _hours("weather", S.WEATHER_FEED_COLUMNS).alias("weather"), _hours("forecast", ["pm2_5"]).alias("forecast"))


def nowcast_stream(deliveries: DataFrame) -> DataFrame:
    """One row a series and cycle: the newest aligned hour (``datetime``) with calendar, lags and ``cams``."""
    rows = deliveries.withColumn("asof", seconds("asof"))
    out = rows.groupBy("series_id").transformWithState(NowcastProcessor(), NOWCAST_ROW, "Append", "None")
    return FE.add_calendar(out.withColumns({"asof": from_seconds("asof"), "datetime": from_seconds("at")}).drop("at"))


def scored_cycles(rows: DataFrame, model, features=None) -> DataFrame:
    """Feature rows of a micro-batch as prediction rows, the newest cycle of each (series, hour).

    ``missing`` names the model inputs that are null; such a row is not scored (B13) but kept, with ``status`` skipped.
    """
    features = features or S.NOWCAST_FEATURES
    ok, skipped = ML.complete_vectors(rows, features)
    pred = F.round("prediction", 2)
    kept = ["series_id", "datetime", "asof", F.round("pm2_5", 2).alias("pm25_observe")]
    scored = model.transform(ok).select(*kept, pred.alias("pm25_xgboost"), F.round("cams", 2).alias("pm25_cams"), A.exceeds_who(pred).alias("depasse_oms"),
                                        F.lit("scored").alias("status"), F.lit(None).cast("string").alias("missing"))
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in features])), "|")
    left = skipped.select(*kept, F.lit(None).cast("double").alias("pm25_xgboost"), F.round("cams", 2).alias("pm25_cams"), F.lit(None).cast("boolean").alias("depasse_oms"),
                          F.lit("skipped").alias("status"), missing.alias("missing"))
    return latest_per_key(scored.unionByName(left), ["series_id", "datetime"], ["asof"])


def run_nowcast_stream(spark: SparkSession, landing: str, model, table: VersionedTable, checkpoint: str, max_files: int = 8, query: str = "nowcast") -> None:
    """All deliveries landed and not yet read: features from state, scored, upserted into ``table`` in one query.

    Started again with the same checkpoint it goes on with what has landed since; a batch that was committed to the table but
    not to the checkpoint is replayed by Spark and left out by the table.
    """
    configure_streaming(spark)
    sink = table.write_batches(query, lambda batch: scored_cycles(batch, model))
    q = (nowcast_stream(delivery_stream(spark, landing, max_files)).writeStream.outputMode("append").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
