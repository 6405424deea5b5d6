"""Sources and sinks on hand-made files: CSV typing (strict and tolerant), partition pruning,
nested JSON flattening, replace and append writes."""

import datetime as dt

import pytest

from airshed.sources import csv_tables as C
from airshed.sources import json_feed as JF
from airshed.sources import sinks as K

HEADER = "location_id,sensor_id,parameter,value,unit,datetime_utc,datetime_local,latitude,longitude,ingested_at\n"


def _csv(tmp_path, body):
    p = tmp_path / "m.csv"
    p.write_text(HEADER + body)
    return str(p)


def test_measurements_csv_types_and_empty_coordinates(spark, tmp_path):
    path = _csv(tmp_path, "7,70,pm25,12.5,µg/m³,2024-01-01T00:00:00+00:00,2024-01-01T05:30:00+00:00,,77.1,x\n")
    r = C.read_measurements(spark, path).collect()[0]
    assert r["location_id"] == 7 and r["value"] == 12.5
    assert r["latitude"] is None and r["longitude"] == 77.1          # empty text -> NULL
    assert r["datetime_local"] == dt.datetime(2024, 1, 1, 5, 30)      # offset dropped, wall clock kept


def test_empty_value_aborts_strict_load_and_is_null_when_tolerant(spark, tmp_path):
    path = _csv(tmp_path, "7,70,pm25,,µg/m³,2024-01-01T00:00:00+00:00,2024-01-01T05:30:00+00:00,28.1,77.1,x\n")
    with pytest.raises(Exception):
        C.read_measurements(spark, path, strict=True).collect()
    assert C.read_measurements(spark, path, strict=False).collect()[0]["value"] is None


def test_stations_csv_bool_and_pipe_list(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("id,name,locality,timezone,latitude,longitude,is_monitor,provider,parameters,ingested_at\n"
                 "1,A,L,Asia/Kolkata,28.6,77.2,True,p,pm25|pm10|no2,x\n"
                 "2,B,L,Asia/Kolkata,28.7,77.3,true,p,co,x\n")
    rows = {r["id"]: r for r in C.read_stations(spark, str(p)).collect()}
    assert rows[1]["is_monitor"] is True and rows[2]["is_monitor"] is False   # exactly "True"
    assert rows[1]["parameters"] == ["pm25", "pm10", "no2"] and rows[2]["parameters"] == ["co"]


def test_partitioned_write_prunes_folders(spark, tmp_path):
    t0 = dt.datetime(2023, 12, 30)
    df = spark.createDataFrame([(t0 + dt.timedelta(days=i), float(i)) for i in range(70)],
                               "datetime timestamp_ntz, v double")
    path = K.write_partitioned(df, str(tmp_path / "p"))
    jan = K.read_partitioned(spark, path, 2024, 1)
    plan = jan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan
    assert jan.count() == 31
    assert {r["month"] for r in jan.select("month").distinct().collect()} == {1}


def test_replace_then_append(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1,), (2,)], "k int")
    K.write_replace(a, path)
    K.write_replace(a, path)
    assert spark.read.parquet(path).count() == 2
    K.write_append(a, path)
    assert spark.read.parquet(path).count() == 4


def test_nested_locations_round_trip(spark, tmp_path):
    st = spark.createDataFrame(
        [(1, "A", "L", "Asia/Kolkata", 28.6, 77.2, True, "p", ["pm25", "no2"], "x")],
        "id long, name string, locality string, timezone string, latitude double, longitude double, "
        "is_monitor boolean, provider string, parameters array<string>, ingested_at string")
    path = str(tmp_path / "nested")
    JF.to_nested_locations(st).write.json(path)
    r = JF.flatten_locations(spark, path).collect()[0]
    assert r["id"] == 1 and r["timezone"] == "Asia/Kolkata" and r["latitude"] == 28.6
    assert list(r["parameters"]) == ["pm25", "no2"]


def test_hourly_payloads_keep_series_keys(spark, tmp_path):
    p = tmp_path / "air.json"
    p.write_text('{"series_id": 3, "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], '
                 '"pm2_5": [1.5, null]}}\n')
    rows = JF.read_hourly_payloads(spark, str(p), ["pm2_5"], keys=["series_id"]).orderBy("datetime").collect()
    assert [(r["series_id"], r["datetime"].hour, r["pm2_5"]) for r in rows] == [(3, 0, 1.5), (3, 1, None)]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("name,id,remark,locality,timezone,latitude,longitude,is_monitor,provider,parameters,ingested_at\n"
                 "A,7,x,L,Z,28.6,77.2,True,p,pm25,x\n")
    r = C.read_stations(spark, str(p)).collect()[0]
    assert (r["id"], r["name"], r["latitude"]) == (7, "A", 28.6)
    p.write_text("name,id\nA,7\n")
    with pytest.raises(ValueError, match="locality"):
        C.read_stations(spark, str(p))


def test_unreadable_documents_raise_or_are_counted(spark, tmp_path):
    good = '{"series_id": 1, "hourly": {"time": ["2024-01-01T00:00"], "a": [1.5]}}'
    (tmp_path / "lines.json").write_text(good + "\n" + good[:-9] + "\n\n" + '{"series_id": 1, "hourly": {"time": ["2024-01-01T01:00"], "a": ["x"]}}\n')
    (tmp_path / "pretty.json").write_text('{\n  "series_id": 2,\n  "hourly": {\n    "time": ["2024-01-02T00:00"],\n    "a": [\n 2.5\n]\n  }\n}\n')
    (tmp_path / "empty.json").write_text('{"series_id": 3, "hourly": {"time": [], "a": []}}\n{"series_id": 4}\n')
    (tmp_path / "broken.json").write_text('{\n "series_id": 5,\n "hourly"\n')
    rows, rejected = JF.hourly_payloads(spark, str(tmp_path), ["a"], keys=["series_id"])
    assert sorted((r["series_id"], r["a"]) for r in rows.collect()) == [(1, 1.5), (2, 2.5)]
    assert sorted(r["file"].rsplit("/", 1)[1] for r in rejected.collect()) == ["broken.json", "lines.json", "lines.json"]
    with pytest.raises(ValueError, match="3 unreadable"):
        JF.read_hourly_payloads(spark, str(tmp_path), ["a"])
    assert JF.read_hourly_payloads(spark, str(tmp_path), ["a"], on_bad="drop").count() == 2
