"""Queries of the stateful streams (I3 + K8, I4) and of the versioned and named tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.catalog.q_dashboards import PRED_SQL, UPSERT_NEW_FROM, UPSERT_OLD_BEFORE, predictions
from airshed.catalog.q_ml import NOWCAST_MODEL, XGB_COLS, linear_sql
from airshed.catalog.q_series import feeds
from airshed.catalog.q_streaming import FILES, event_stream, land_event_folder
from airshed.plans.tables import MartTables
from airshed.session import materialize, shared_path
from airshed.sources import driver_tables as D
from airshed.sources.versioned import VersionedTable
from airshed.streaming import jobs as ST
from airshed.streaming import landing as LD
from airshed.streaming import stateful as SF

# ---- I4: lags in order of time ---------------------------------------------------------

HISTORY_BEFORE = "2024-01-10 00:00:00"
DELAY_HOURS, IDLE_DAYS, JITTER_HOURS, SLICES = 12, 10, 7, 5


def land_jittered(spark, air, slices: int = SLICES) -> str:
    """Readings landed in slices of two files each; a reading comes up to ``JITTER_HOURS`` hours out of turn."""
    jitter = F.pmod(F.xxhash64("series_id", "datetime"), F.lit(JITTER_HOURS)) * 3600
    rows = materialize(air.select("series_id", "datetime", "pm2_5", (SF.seconds("datetime") + jitter).alias("comes")))
    cuts = rows.select(F.percentile_approx("comes", [i / slices for i in range(1, slices)], 10000).alias("q")).first()["q"] or []
    path = shared_path(spark, "jittered-feed")
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = rows if lo is None else rows.where(F.col("comes") > lo)
        part = part if hi is None else part.where(F.col("comes") <= hi)
        part.drop("comes").repartition(2).write.mode("append").parquet(path)
    return path


@register("i4_ordered_lags", "WITH " + X.AIR + f""",
later AS (SELECT * FROM air WHERE datetime >= TIMESTAMP '{HISTORY_BEFORE}'),
wm AS (SELECT max(datetime) - INTERVAL {DELAY_HOURS} HOUR AS w FROM later),
lagged AS (SELECT series_id, datetime, pm2_5, lag(pm2_5, 1) OVER s AS pm2p5_lag_1h, lag(pm2_5, 2) OVER s AS pm2p5_lag_2h,
                  lag(pm2_5, 24) OVER s AS pm2p5_lag_24h FROM air WINDOW s AS (PARTITION BY series_id ORDER BY datetime))
SELECT *, 'reading' AS event FROM lagged WHERE datetime >= TIMESTAMP '{HISTORY_BEFORE}' AND datetime <= (SELECT w FROM wm)
UNION ALL
SELECT series_id, max(datetime), NULL, NULL, NULL, NULL, 'expired' FROM air GROUP BY series_id
HAVING max(datetime) + INTERVAL {IDLE_DAYS} DAY <= (SELECT w FROM wm)""")
def i4_ordered_lags(spark, sf_dir):
    """I4: readings that land out of turn, lags in order of time from typed state; the first days come from a batch table
    as initial state, and a series without a reading for ten days is forgotten (``event``)."""
    ST.configure_streaming(spark)
    air, _ = feeds(spark, sf_dir)
    cut = F.lit(HISTORY_BEFORE).cast("timestamp_ntz")
    landing = land_jittered(spark, air.where(F.col("datetime") >= cut))
    stream = spark.readStream.schema("series_id long, datetime timestamp_ntz, pm2_5 double").option("maxFilesPerTrigger", 2).parquet(landing)
    history = SF.initial_history(air.where(F.col("datetime") < cut))
    out = SF.ordered_lag_stream(stream, f"{DELAY_HOURS} hours", IDLE_DAYS * 86400, history)
    return spark.read.parquet(ST.run_to_parquet(spark, out, "i4-ordered"))


# ---- I3 + K8: streaming nowcast --------------------------------------------------------

FIRST_CYCLE, LAST_CYCLE, CYCLE_HOURS = "2024-01-02 00:00:00", "2024-04-30 00:00:00", 3


def cycle_deliveries(air, weather):
    """What a landing job would fetch at each cycle: for every series one document with its hours since the cycle before
    (all earlier ones at the first) and the first forecast value; ``cycle`` numbers the cycles."""
    first, step = F.unix_seconds(F.lit(FIRST_CYCLE).cast("timestamp")), CYCLE_HOURS * 3600
    last = F.unix_seconds(F.lit(LAST_CYCLE).cast("timestamp"))
    n = F.floor((last - first) / step) + 1
    cycle = F.greatest(F.lit(0), F.least(F.ceil((SF.seconds("datetime") - first) / step), n)).cast("int")
    time = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm")

    def field(name):
        return lambda x: x[name]

    def block(df, columns, name):
        rows = df.withColumn("cycle", cycle).where(F.col("cycle") < n).groupBy("series_id", "cycle").agg(
            F.array_sort(F.collect_list(F.struct("datetime", *columns))).alias("r"))  # the hours of one cycle
        return rows.select("series_id", "cycle", F.struct(F.transform("r", lambda x: time(x["datetime"])).alias("time"),
                                                          *[F.transform("r", field(c)).alias(c) for c in columns]).alias(name))

    heads = air.withColumn("cycle", cycle).groupBy("series_id", "cycle").agg(F.min_by(F.struct("datetime", "pm2_5"), "datetime").alias("head"))
    spine = air.select("series_id").union(weather.select("series_id")).distinct().select("series_id", F.explode(F.sequence(F.lit(0), n.cast("int"))).alias("cycle"))
    behind = Window.partitionBy("series_id").orderBy("cycle").rowsBetween(1, Window.unboundedFollowing)
    out = spine.join(heads, ["series_id", "cycle"], "left").withColumn("next", F.first("head", ignorenulls=True).over(behind)).where(F.col("cycle") < n)
    out = out.join(block(air, S.AIR_FEED_COLUMNS, "air"), ["series_id", "cycle"], "left").join(block(weather, S.WEATHER_FEED_COLUMNS, "weather"), ["series_id", "cycle"], "left")
    asof = F.timestamp_seconds(first + F.col("cycle") * step + 1200)  # some minutes past the hour, as a scheduler would start it
    forecast = F.when(F.col("next").isNotNull(), F.struct(F.array(time("next.datetime")).alias("time"), F.array("next.pm2_5").alias("pm2_5")))
    return out.select("cycle", "series_id", F.date_format(asof, "yyyy-MM-dd'T'HH:mm").alias("asof"), "air", "weather", forecast.alias("forecast"))


def land_deliveries(rows, path: str) -> None:
    """Deliveries as JSON documents; a series' documents of one landing are in one file, so they are read in order."""
    rows.drop("cycle").repartition(2, "series_id").write.mode("append").json(path)


def _by_cycle(sql: str) -> str:
    return sql.replace("PARTITION BY series_id", "PARTITION BY cyc, series_id")


_NOWCAST_SQL = "WITH " + ",".join([X.AIR, X.WEATHER]) + f""",
c AS (SELECT unnest(generate_series(TIMESTAMP '{FIRST_CYCLE}', TIMESTAMP '{LAST_CYCLE}', INTERVAL {CYCLE_HOURS} HOUR)) AS cyc),
a AS (SELECT cyc, air.* FROM c JOIN air ON datetime <= cyc QUALIFY row_number() OVER (PARTITION BY cyc, series_id ORDER BY datetime DESC) <= 48),
w AS (SELECT cyc, weather.* FROM c JOIN weather ON datetime <= cyc QUALIFY row_number() OVER (PARTITION BY cyc, series_id ORDER BY datetime DESC) <= 48),
mf AS (SELECT cyc, series_id, datetime, a.pm2_5, a.pm10, a.nitrogen_dioxide AS no2, w.temperature_2m AS temp_c, w.wind_speed_10m AS vent_kmh,
              w.boundary_layer_height AS blh_m FROM a FULL OUTER JOIN w USING (cyc, series_id, datetime)),
rt AS (SELECT *, {X.CALENDAR}, {_by_cycle(X.lags_sql("pm2_5"))} FROM mf),
nw AS (SELECT * FROM rt QUALIFY row_number() OVER (PARTITION BY cyc, series_id ORDER BY datetime DESC) = 1),
nx AS (SELECT cyc, series_id, pm2_5 AS nxt FROM c JOIN air ON datetime > cyc QUALIFY row_number() OVER (PARTITION BY cyc, series_id ORDER BY datetime) = 1),
sc AS (SELECT *, {" AND ".join(f"{x} IS NOT NULL" for x in XGB_COLS)} AS complete, {linear_sql(NOWCAST_MODEL)} AS p,
              array_to_string(list_filter([{", ".join(f"CASE WHEN {x} IS NULL THEN '{x}' END" for x in S.NOWCAST_FEATURES)}], lambda x: x IS NOT NULL), '|') AS gone
       FROM nw LEFT JOIN nx USING (cyc, series_id))
SELECT series_id, datetime, cyc AS "asof", {X.spark_round("pm2_5", 2)} AS pm25_observe, CASE WHEN complete THEN {X.spark_round("p", 2)} END AS pm25_xgboost,
       {X.spark_round("nxt", 2)} AS pm25_cams, CASE WHEN complete THEN {X.spark_round("p", 2)} > 15 END AS depasse_oms,
       CASE WHEN complete THEN 'scored' ELSE 'skipped' END AS status, CASE WHEN NOT complete THEN gone END AS missing
FROM sc QUALIFY row_number() OVER (PARTITION BY series_id, datetime ORDER BY cyc DESC) = 1"""


@register("i3_streaming_nowcast", _NOWCAST_SQL)
def i3_streaming_nowcast(spark, sf_dir, landings: int = 4):
    """I3 + K8 in one query: deliveries land over several micro-batches and a restart, features come from state, rows are scored
    or skipped, and each batch is an upsert into a versioned table; the second landing is delivered twice."""
    rows = materialize(cycle_deliveries(*feeds(spark, sf_dir)))
    n = (rows.agg(F.max("cycle")).first()[0] or 0) + 1
    landing, checkpoint = shared_path(spark, "nowcast-landing"), shared_path(spark, "nowcast-checkpoint")
    table = VersionedTable(spark, shared_path(spark, "nowcast-table"), ["series_id", "datetime"])
    part = lambda i: rows.where((F.col("cycle") >= i * n // landings) & (F.col("cycle") < (i + 1) * n // landings))
    for i in range(landings):
        land_deliveries(part(i), landing)
        if i == landings // 2:
            SF.run_nowcast_stream(spark, landing, NOWCAST_MODEL, table, checkpoint, max_files=2)
            land_deliveries(part(1), landing)
    SF.run_nowcast_stream(spark, landing, NOWCAST_MODEL, table, checkpoint, max_files=2)
    table.compact()
    return table.read()


# ---- A11 + A14: versioned table --------------------------------------------------------

@register("a11_versioned_table", PRED_SQL + f""",
v1 AS (SELECT * FROM predictions WHERE datetime < TIMESTAMP '{UPSERT_OLD_BEFORE}'),
new AS (SELECT series_id, datetime, pm25_observe + 1.0 AS pm25_observe, pm25_xgboost + 1.0 AS pm25_xgboost,
               pm25_cams + 1.0 AS pm25_cams, pm25_xgboost + 1.0 > 15.0 AS depasse_oms
        FROM predictions WHERE datetime >= TIMESTAMP '{UPSERT_NEW_FROM}'),
v2 AS (SELECT * FROM new UNION ALL SELECT v1.* FROM v1 ANTI JOIN new USING (series_id, datetime))
SELECT 1 AS version, * FROM v1 UNION ALL SELECT 2, * FROM v2 UNION ALL SELECT 3, * FROM v2""")
def a11_versioned_table(spark, sf_dir):
    """A11 + A14: the predictions as a versioned table: first delivery, upsert of the corrected rows, compaction; all
    three versions are read after the last commit."""
    p = materialize(predictions(spark, sf_dir))
    table = VersionedTable(spark, shared_path(spark, "predictions-table"), ["series_id", "datetime"])
    table.replace(p.where(F.col("datetime") < F.lit(UPSERT_OLD_BEFORE).cast("timestamp_ntz")))
    new = p.where(F.col("datetime") >= F.lit(UPSERT_NEW_FROM).cast("timestamp_ntz"))
    table.upsert(new.select("series_id", "datetime", *[(F.col(c) + 1.0).alias(c) for c in ("pm25_observe", "pm25_xgboost", "pm25_cams")])
                 .withColumn("depasse_oms", F.col("pm25_xgboost") > 15.0))
    table.compact()
    versions = [table.read(v).withColumn("version", F.lit(v)) for v in table.versions()]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


# ---- A12: named tables -----------------------------------------------------------------

FIRST_DELIVERY_BEFORE = "2024-01-20 00:00:00"


@register("a12_mart_table_incremental", X.MART_CHAIN + "\nSELECT *, CAST(hour_utc AS DATE) AS day FROM mart")
def a12_mart_table_incremental(spark, sf_dir):
    """Raw measurements and the mart as named tables by day, filled by two deliveries; the second, which also brings every
    seventh reading once more, rebuilds only the days it touches."""
    ev = D.events(spark, sf_dir)
    early = F.col("ts") < F.lit(FIRST_DELIVERY_BEFORE).cast("timestamp_ntz")
    tables = MartTables(spark, f"run_{uuid.uuid4().hex[:8]}").create(shared_path(spark, "mart-tables"))
    tables.deliver(D.measurements_from_events(ev.where(early)))
    again = D.measurements_from_events(ev.where(early & (F.col("event_id") % 7 == 0))).withColumn("ingested_at", F.lit(D.REINGESTED_AT))
    tables.deliver(D.measurements_from_events(ev.where(~early)).unionByName(again))
    return spark.table(tables.mart)


# ---- I1, I5: landed rows instead of long state -----------------------------------------

@register("i5_first_deliveries", X.WITH_M1 + "\nSELECT * FROM m1")
def i5_first_deliveries(spark, sf_dir):
    """I5 over any distance: a second folder delivers every seventh event again with another value; each key's first delivery is
    kept, found by an anti join with what has landed on its day."""
    base = land_event_folder(spark, sf_dir, 2)
    again = D.events(spark, sf_dir).where(F.col("event_id") % 7 == 0).withColumn("value", F.col("value") + 1000.0)
    again.repartition(FILES).write.mode("append").parquet(f"{base}/events.parquet")
    m = D.measurements_from_events(event_stream(spark, base, FILES))
    first = LD.FirstDeliveries(spark, shared_path(spark, "first-deliveries"), m.schema, ["location_id", "parameter", "datetime_utc"], "datetime_utc", "ingested_at")
    LD.run_sink(spark, m, first.sink, shared_path(spark, "first-checkpoint"))
    return first.read()


def land_with_late_rows(spark, sf_dir, slices: int = 4) -> str:
    """``events`` in time slices, but every thirteenth event comes a slice late; the folder above them."""
    base = shared_path(spark, "late-events")
    ev = D.events(spark, sf_dir)
    at = F.unix_micros((F.col("ts") + F.make_dt_interval((F.lit(30) * (F.col("event_id") % 12)).cast("int"))).cast("timestamp"))
    ev = materialize(ev.withColumn("at", at))
    cuts = ev.select(F.percentile_approx("at", [i / slices for i in range(1, slices)], 1000).alias("q")).first()["q"] or []
    own = sum([(F.col("at") > c).cast("int") for c in cuts], F.lit(0))
    ev = materialize(ev.withColumn("slice", F.least(F.lit(slices - 1), own + (F.col("event_id") % 13 == 5).cast("int"))).drop("at"))
    for i in range(slices):
        ev.where(F.col("slice") == i).drop("slice").repartition(FILES).write.mode("append").parquet(f"{base}/events.parquet")
    return base


@register("i1_mart_with_late_rows", X.MART_CHAIN + "\nSELECT * FROM mart")
def i1_mart_with_late_rows(spark, sf_dir):
    """I1 without loss: hours enter the mart when the watermark has passed them, rows for closed hours are kept as late, and a
    restatement corrects their hours: the batch mart, row by row."""
    m = D.measurements_from_events(event_stream(spark, land_with_late_rows(spark, sf_dir), FILES))
    ingest = LD.MartWithLateRows(spark, shared_path(spark, "late-mart"), m.schema)
    LD.run_sink(spark, m, ingest.sink, shared_path(spark, "late-checkpoint"))
    ingest.close_all()
    ingest.restate()
    return ingest.mart.read()
