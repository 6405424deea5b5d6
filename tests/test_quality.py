"""Contract and quality checks on hand-made frames (FIXTURES M4 'contract'): each seeded
defect must make exactly its rule fail, and the clean frame must pass everything."""

import datetime as dt

import pytest

from airshed import schemas as S
from airshed.plans import quality as Q

ASOF = "2024-01-30 12:00:00"
T_FRESH = dt.datetime(2024, 1, 30, 11, 0)


def _measurements(spark, stations=10, co_unit=S.UNIT_UG, t=T_FRESH, null_values=0, negative=False):
    rows = []
    params = ["pm25", "pm10", "no2", "co"]
    i = 0
    for s in range(stations):
        for p in params:
            v = None if i < null_values else (-1.0 if negative and i == 5 else 10.0 + i)
            unit = co_unit if p == "co" else S.UNIT_UG
            rows.append((s, s * 10, p, v, unit, t))
            i += 1
    return spark.createDataFrame(rows, "location_id long, sensor_id long, parameter string, value double, "
                                       "unit string, datetime_utc timestamp_ntz")


def _result(df):
    return {r["rule"]: r for r in df.collect()}


def _raw_rules():
    return (Q.completeness_rules("m") + Q.expression_rules("m") + Q.pm25_range_rule("m")
            + Q.min_stations_rule("m") + Q.expected_parameters_rule("m"))


def test_clean_frame_passes_everything(spark):
    res = _result(Q.evaluate(_measurements(spark), _raw_rules()))
    assert all(r["passed"] for r in res.values()), res
    sch = _result(Q.contract_schema_rules(_measurements(spark)))
    assert all(r["passed"] for r in sch.values()), sch


def test_mg_unit_is_a_contract_violation(spark):
    sch = _result(Q.contract_schema_rules(_measurements(spark, co_unit=S.UNIT_MG)))
    assert not sch["enum:unit"]["passed"]
    assert sch["enum:unit"]["observed"] == 10.0          # one CO row per station
    assert sch["enum:parameter"]["passed"]


def test_nine_stations_fail_minimum(spark):
    res = _result(Q.evaluate(_measurements(spark, stations=9), Q.min_stations_rule("m")))
    assert not res["integrity:min_stations"]["passed"]
    assert res["integrity:min_stations"]["observed"] == 9.0


@pytest.mark.parametrize("hours,passed", [(2.999, True), (3.0, False), (3.5, False)])
def test_freshness_is_strict(spark, hours, passed):
    t = dt.datetime(2024, 1, 30, 12, 0) - dt.timedelta(hours=hours)
    res = _result(Q.evaluate(_measurements(spark, t=t), Q.freshness_rule("latest", ASOF)))
    assert res["freshness:datetime_utc"]["passed"] is passed


def test_empty_table_passes_ratio_and_freshness(spark):
    empty = _measurements(spark).limit(0)
    res = _result(Q.evaluate(empty, Q.completeness_rules("m") + Q.freshness_rule("m", ASOF)))
    assert all(r["passed"] for r in res.values())
    assert res["completeness:value"]["observed"] is None


def test_completeness_threshold_90_percent(spark):
    # 40 rows; 4 NULL values = 90 % complete (passes), 5 = 87.5 % (fails)
    ok = _result(Q.evaluate(_measurements(spark, null_values=4), Q.completeness_rules("m")))
    bad = _result(Q.evaluate(_measurements(spark, null_values=5), Q.completeness_rules("m")))
    assert ok["completeness:value"]["passed"] and not bad["completeness:value"]["passed"]


def test_negative_value_breaks_validity(spark):
    res = _result(Q.evaluate(_measurements(spark, negative=True), Q.expression_rules("m") + Q.pm25_range_rule("m")))
    assert not res["validity:no_negatives"]["passed"]
    assert not res["validity:no_negative_values"]["passed"]


def test_missing_expected_parameter(spark):
    m = _measurements(spark).where("parameter != 'co'")
    res = _result(Q.evaluate(m, Q.expected_parameters_rule("m")))
    assert res["integrity:expected_parameters"]["observed"] == 1.0
    assert not res["integrity:expected_parameters"]["passed"]


def test_winter_vs_monsoon(spark):
    rows = [("winter", 80.0), ("winter", 100.0), ("monsoon", 30.0)]
    mart = spark.createDataFrame(rows, "season string, pm25 double")
    assert _result(Q.evaluate(mart, Q.winter_vs_monsoon_rule("x")))["coherence:winter_gt_monsoon"]["passed"]
    rows = [("winter", 10.0), ("monsoon", 30.0)]
    mart = spark.createDataFrame(rows, "season string, pm25 double")
    assert not _result(Q.evaluate(mart, Q.winter_vs_monsoon_rule("x")))["coherence:winter_gt_monsoon"]["passed"]
    only_winter = spark.createDataFrame([("winter", 10.0)], "season string, pm25 double")
    assert _result(Q.evaluate(only_winter, Q.winter_vs_monsoon_rule("x")))["coherence:winter_gt_monsoon"]["passed"]


def test_daily_completeness_keeps_empty_slots(spark):
    t0 = dt.datetime(2024, 1, 1, 5)
    rows = [(1, "pm25", 10.0, t0), (1, "pm25", None, t0 + dt.timedelta(hours=1)),
            (2, "no2", 5.0, t0 + dt.timedelta(days=2))]
    m = spark.createDataFrame(rows, "location_id long, parameter string, value double, datetime_utc timestamp_ntz")
    out = Q.daily_completeness(m, parameters=["pm25", "no2"]).collect()
    assert len(out) == 2 * 2 * 3                       # stations x parameters x days
    got = {(r["location_id"], r["parameter"], r["day"].day): (r["n_rows"], r["n_values"]) for r in out}
    assert got[(1, "pm25", 1)] == (2, 1)
    assert got[(2, "no2", 3)] == (1, 1)
    assert got[(2, "pm25", 2)] == (0, 0)


def test_min_stations_approx_matches_exact_on_small_counts(spark):
    m = _measurements(spark, stations=12)
    exact = _result(Q.evaluate(m, Q.min_stations_rule("m")))["integrity:min_stations"]
    approx = _result(Q.evaluate(m, Q.min_stations_rule("m", approx=True)))["integrity:min_stations"]
    assert exact["observed"] == approx["observed"] == 12.0 and approx["passed"]
