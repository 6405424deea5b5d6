"""The lifecycle jobs on sf0.001 landings: SQL models with contract report, and two nowcast
cycles upserted into successive versions of the predictions table."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.catalog import q_runs
from airshed.catalog.q_quality import ASOF_CONTRACT
from airshed.plans import features as FE
from airshed.plans import runs as R
from airshed.session import shared_path

from conftest import SF0001


def test_sql_models_write_mart_and_contract_report(spark):
    stations, measurements, latest = q_runs.land_csv(spark, SF0001)
    paths = R.run_sql_models(spark, stations, measurements, latest, shared_path(spark, "t-models"),
                             ASOF_CONTRACT, strict=False)
    report = {r["rule"]: r for r in spark.read.parquet(paths["contract_report"]).collect()}
    assert not report["enum:unit"]["passed"]              # CO in mg/m3 breaks the contract (Q7)
    assert not report["validity:no_negatives"]["passed"]  # seeded negative values
    assert report["integrity:expected_parameters"]["passed"]
    assert spark.read.parquet(paths["mart"]).count() > 0


def _model(spark, air, weather):
    rt = FE.realtime_features(air, weather).dropna(subset=S.NOWCAST_FEATURES + ["pm2_5"])
    asm = VectorAssembler(inputCols=S.NOWCAST_FEATURES, outputCol="features")
    return Pipeline(stages=[asm, LinearRegression(featuresCol="features", labelCol="pm2_5")]).fit(rt)


def test_two_nowcast_cycles_upsert_by_series_and_hour(spark):
    # sf0.01: at sf0.001 the sparse feeds leave no row with all twelve model inputs
    air_p, weather_p = q_runs.land_payloads(spark, SF0001.replace("0.001", "0.01"))
    air, weather = R.read_feeds(spark, air_p, weather_p)
    model = _model(spark, air, weather)
    a1, a2 = "2024-01-20 10:30:00", "2024-03-21 06:00:00"
    n = []
    for asof in (a1, a2):
        rows, skipped = R.nowcast_rows(air, weather, model, asof)
        got = rows.collect()
        at = F.lit(asof).cast("timestamp_ntz")
        begun = air.unionByName(weather, allowMissingColumns=True).where(F.col("datetime") <= F.date_trunc("hour", at))
        assert len(got) + skipped.count() == begun.select("series_id").distinct().count()  # each series' newest row
        for r in got:
            nxt = air.where((F.col("datetime") > F.date_trunc("hour", at)) & (F.col("series_id") == r["series_id"])).orderBy("datetime").first()
            assert str(r["datetime"]) <= asof
            assert r["pm25_cams"] == (None if nxt is None or nxt["pm2_5"] is None else round(nxt["pm2_5"], 2))
            assert r["depasse_oms"] == (r["pm25_xgboost"] > S.WHO_PM25_LIMIT)
        n.append(len(got))
    v1 = R.run_nowcast_cycle(spark, air_p, weather_p, model, a1, None, shared_path(spark, "t-pred-v1"))
    v2 = R.run_nowcast_cycle(spark, air_p, weather_p, model, a2, v1, shared_path(spark, "t-pred-v2"))
    assert spark.read.parquet(v1).count() == n[0]
    both = spark.read.parquet(v2)
    assert both.count() == both.select("series_id", "datetime").distinct().count() <= n[0] + n[1]
    # replaying the second cycle replaces its row instead of adding one
    v3 = R.run_nowcast_cycle(spark, air_p, weather_p, model, a2, v2, shared_path(spark, "t-pred-v3"))
    assert spark.read.parquet(v3).count() == both.count()
