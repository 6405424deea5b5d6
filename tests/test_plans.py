"""Plan-shape guards for the scale properties the operators are built around (physical plans of
small hand-made inputs): partial aggregation before every shuffle of a hot key, no nested-loop
or cartesian joins, no window where an equi join suffices, bounded shuffle counts."""

import datetime as dt

from pyspark.sql import functions as F

from airshed.operators import dedup, joins
from airshed.operators import series as ser
from airshed.plans import quality as Q


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _measurements(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1 + i % 3, 10, ["pm25", "no2"][i % 2], float(i), "u", t0 + dt.timedelta(hours=i),
             t0 + dt.timedelta(hours=i, minutes=330), 28.0, 77.0, "x") for i in range(200)]
    df = spark.createDataFrame(rows, "location_id long, sensor_id long, parameter string, value double, "
                                     "unit string, datetime_utc timestamp_ntz, datetime_local timestamp_ntz, "
                                     "latitude double, longitude double, ingested_at string")
    path = str(tmp_path / "m")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_dedup_and_snapshot_combine_before_one_shuffle(spark, tmp_path):
    m = _measurements(spark, tmp_path)
    for df in (dedup.dedup_measurements(m), dedup.latest_snapshot(m)):
        plan = _plan(df)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_max_by" in plan and "Window" not in plan


def test_spine_and_completeness_have_no_pair_joins(spark, tmp_path):
    m = _measurements(spark, tmp_path)
    plan = _plan(Q.daily_completeness(m))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Generate explode(sequence" in plan


def test_completeness_spine_is_not_shuffled(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 3)
    rows = [(s, "pm25", 1.0 + s, t0 + dt.timedelta(days=d)) for s in range(20) for d in (0, 5 * s, 99)]
    rows += [(None, "pm25", 1.0, t0), (7, None, 1.0, t0), (8, "other", 1.0, t0), (50, "co", 1.0, None), (51, "no2", None, t0 + dt.timedelta(days=50))]
    path = str(tmp_path / "slots")
    spark.createDataFrame(rows, "location_id long, parameter string, value double, datetime_utc timestamp_ntz").write.parquet(path)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a slot table that is too large to broadcast
    try:
        out = Q.daily_completeness(spark.read.parquet(path), ["pm25", "no2", "co"])
        plan, got = _plan(out), out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Join" not in plan
    top = plan.index("Generate explode(sequence")
    assert "Exchange" not in plan[:top] and "Sort" not in plan[:top]  # nothing moves the days brought forth
    exp = {(s, p, t0.replace(hour=0) + dt.timedelta(days=d)): (0, 0, None)
           for s in [None, *range(20), 50, 51] for p in ("pm25", "no2", "co") for d in range(100)}
    for s, p, v, t in rows[:60]:
        k = (s, p, t.replace(hour=0))
        exp[k] = (exp[k][0] + 1, exp[k][1] + 1, v)
    exp[(51, "no2", dt.datetime(2024, 2, 20))] = (1, 0, None)
    assert len(got) == len(exp)
    assert {(r["location_id"], r["parameter"], r["day"]): (r["n_rows"], r["n_values"], r["mean"]) for r in got} == exp


def test_time_lags_are_an_equi_join_without_windows(spark, tmp_path):
    m = _measurements(spark, tmp_path).select(F.col("location_id").alias("s"), "datetime_utc", "value")
    plan = _plan(ser.add_time_lags(m, ["s"], "datetime_utc", "value", {"l1": 1, "l24": 24}))
    assert "Window" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def test_blocked_windows_shuffle_on_series_and_block(spark, tmp_path):
    m = _measurements(spark, tmp_path).select(F.col("location_id").alias("s"), "datetime_utc", "value")
    d = ser.with_position(m, ["s"], ["datetime_utc"])
    plan = _plan(ser.add_lags(d, ["s"], "value", {"l1": 1}, block_rows=16))
    assert "hashpartitioning(s#" in plan and "_blk" in plan
    assert "Exchange SinglePartition" not in plan


def test_dimension_join_is_a_checked_broadcast(spark, tmp_path):
    m = _measurements(spark, tmp_path)
    st = m.groupBy("location_id").agg(F.max("latitude").alias("st_lat"))
    plan = _plan(joins.join_dimension(m, st, "location_id", "left"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
