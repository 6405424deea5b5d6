"""Data-quality checks and the contract runner.

Every check produces rows ``(rule, scope, observed, threshold, passed)``.  All
rules on one table are evaluated by a single global aggregation (one scan,
partial aggregation on every task, a one-row final stage) and turned into rows
with ``inline`` over the one-row result, so adding rules never adds scans.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.functions import calendar as cal
from airshed.operators import joins as J
from airshed.operators.dedup import latest_snapshot
from airshed.plans import mart
from airshed.session import materialize

RESULT_COLUMNS = ["rule", "scope", "observed", "threshold", "passed"]


@dataclass
class Rule:
    name: str
    scope: str
    metric: Column                                  # aggregate expression
    threshold: float
    passed: Callable[[Column, Column], Column]      # (observed, threshold) -> boolean


def _zero(obs: Column, thr: Column) -> Column:
    return F.coalesce(obs <= thr, F.lit(True))


def _at_least(obs: Column, thr: Column) -> Column:
    # empty input (NULL ratio) passes, as in the reference's guard
    return F.coalesce(obs >= thr, F.lit(True))


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate all ``rules`` over ``df`` in one aggregation; one output row per rule."""
    return results(df.agg(*[r.metric.cast("double").alias(f"_m{i}") for i, r in enumerate(rules)]), rules)


def results(row: DataFrame, rules: list[Rule]) -> DataFrame:
    """One output row per rule from a row with the metrics ``_m0``, ``_m1``, ..."""
    structs = []
    for i, r in enumerate(rules):
        obs, thr = F.col(f"_m{i}"), F.lit(float(r.threshold))
        # observed is rounded to 9 decimals: ratios of aggregates are stable to that precision
        # whatever the summation order of the partial aggregates
        structs.append(F.struct(F.lit(r.name).alias("rule"), F.lit(r.scope).alias("scope"),
                                F.round(obs, 9).alias("observed"), thr.alias("threshold"),
                                r.passed(obs, thr).alias("passed")))
    return row.select(F.inline(F.array(*structs)))


def observed(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` with the rules' metrics computed on its rows as they pass by (no scan of their own), once it is written."""
    seen = Observation()
    return df.observe(seen, *[r.metric.cast("double").alias(f"_m{i}") for i, r in enumerate(rules)]), seen


def observed_results(spark: SparkSession, seen: Observation, rules: list[Rule]) -> DataFrame:
    """The rules' rows from an observation whose write has ended."""
    got = seen.get
    schema = ", ".join(f"_m{i} double" for i in range(len(rules)))
    return results(spark.createDataFrame([tuple(got[f"_m{i}"] for i in range(len(rules)))], schema), rules)


# ---- rule builders ---------------------------------------------------------

def not_null_rules(scope: str, cols) -> list[Rule]:
    """Number of NULLs per column must be 0."""
    return [Rule(f"not_null:{c}", scope, F.count_if(F.col(c).isNull()), 0.0, _zero) for c in cols]


def accepted_values_rules(scope: str, col: str, values) -> list[Rule]:
    """Rows whose value is outside the accepted set (NULL never counts)."""
    return [Rule(f"accepted_values:{col}", scope,
                 F.count_if(~F.col(col).isin(list(values))), 0.0, _zero)]


def completeness_rules(scope: str, fields=None) -> list[Rule]:
    """Share of non-NULL values >= threshold; an empty table passes."""
    fields = fields or S.CONTRACT_COMPLETENESS
    return [Rule(f"completeness:{c}", scope,
                 F.try_divide(F.count(F.col(c)).cast("double"), F.count(F.lit(1)).cast("double")),
                 thr, _at_least) for c, thr in fields]


def expression_rules(scope: str, rules=None) -> list[Rule]:
    """Rows violating a boolean rule given as SQL text (NULL results are not violations)."""
    rules = rules or S.CONTRACT_VALIDITY_RULES
    return [Rule(f"validity:{name}", scope, F.count_if(~F.expr(text)), 0.0, _zero)
            for name, text in rules]


def pm25_range_rule(scope: str) -> list[Rule]:
    """J5 (test form): pm25 rows outside 0..999."""
    v = F.col("value")
    bad = (F.col("parameter") == "pm25") & ((v < 0) | (v > 999.0))
    return [Rule("validity:pm25_0_999", scope, F.count_if(bad), 0.0, _zero),
            Rule("validity:no_negative_values", scope, F.count_if(v < 0), 0.0, _zero)]


def freshness_rule(scope: str, asof: str, col: str = "datetime_utc",
                   max_hours: float = S.CONTRACT_MAX_DELAY_HOURS) -> list[Rule]:
    """Hours between ``max(col)`` and ``asof`` must be strictly below the limit; empty passes."""
    asof_us = F.unix_micros(F.lit(asof).cast("timestamp"))
    delay = (asof_us - F.unix_micros(F.max(F.col(col)).cast("timestamp"))).cast("double") / F.lit(3.6e9)
    return [Rule(f"freshness:{col}", scope, delay, float(max_hours),
                 lambda o, t: F.coalesce(o < t, F.lit(True)))]


def min_stations_rule(scope: str, n: int = S.CONTRACT_MIN_STATIONS, approx: bool = False) -> list[Rule]:
    """Distinct stations >= n (``approx=True``: HyperLogLog++ sketch, one pass, ~1 %
    error, for tables where an exact distinct shuffle is not worth it)."""
    station = F.col("location_id")
    metric = F.approx_count_distinct(station, 0.01) if approx else F.count_distinct(station)
    return [Rule("integrity:min_stations", scope, metric, float(n), lambda o, t: o >= t)]


def expected_parameters_rule(scope: str, expected=None) -> list[Rule]:
    """Number of expected parameters that never occur must be 0.

    One bounded flag per expected parameter instead of collecting the distinct set.
    """
    expected = expected or S.CONTRACT_EXPECTED_PARAMETERS
    missing = sum((F.lit(1) - F.coalesce(F.max((F.col("parameter") == p).cast("int")), F.lit(0))
                   for p in expected), F.lit(0))
    return [Rule("integrity:expected_parameters", scope, missing, 0.0, _zero)]


def winter_vs_monsoon_rule(scope: str) -> list[Rule]:
    """Winter mean pm25 must exceed the monsoon mean; passes if either is NULL or 0.

    ``observed`` is the winter mean, ``threshold`` column carries 0 and the monsoon mean is
    compared inside the pass expression.
    """
    w = F.avg(F.when((F.col("season") == "winter") & F.col("pm25").isNotNull(), F.col("pm25")))
    m = F.avg(F.when((F.col("season") == "monsoon") & F.col("pm25").isNotNull(), F.col("pm25")))
    # ratio winter / monsoon: > 1 means winter is worse; NULL (either missing) or 0 passes
    ratio = F.try_divide(w, F.nullif(m, F.lit(0.0)))
    return [Rule("coherence:winter_gt_monsoon", scope, ratio, 1.0,
                 lambda o, t: F.coalesce((o > t) | (o == 0), F.lit(True)))]


# ---- checks on the library's models ----------------------------------------

def column_tests(stg: DataFrame, mart_df: DataFrame) -> DataFrame:
    """J1 + J2: the SQL models' declared column tests."""
    stg_rules, mart_rules = column_test_rules()
    return evaluate(stg, stg_rules).unionByName(evaluate(mart_df, mart_rules))


def column_test_rules() -> tuple[list[Rule], list[Rule]]:
    """J1 + J2: (staging rules, mart rules)."""
    return (not_null_rules("stg_measurements", S.NOT_NULL_STAGING)
            + accepted_values_rules("stg_measurements", "parameter", S.ACCEPTED_STAGING_PARAMETER),
            not_null_rules("mart_hourly", S.NOT_NULL_MART)
            + accepted_values_rules("mart_hourly", "season", S.ACCEPTED_MART_SEASON))


def contract_schema_rules(df: DataFrame, scope: str = "measurements") -> DataFrame:
    """Required fields present in the schema (metadata) and non-NULL, enums respected."""
    return evaluate(df, schema_rules(df, scope))


def with_missing(df: DataFrame, fields) -> DataFrame:
    """``df`` with the fields it lacks as NULL columns, so value rules report them instead of failing to plan."""
    return df.withColumns({c: F.lit(None).cast(S.MEASUREMENTS[c].dataType) for c in fields if c not in df.columns})


def schema_rules(df: DataFrame, scope: str = "measurements") -> list[Rule]:
    """The rules of the required fields; a missing one is a failed ``required_present`` rule."""
    missing = [c for c in S.CONTRACT_REQUIRED_FIELDS if c not in df.columns]
    rules = [Rule(f"required:{c}", scope, F.count_if(F.col(c).isNull()), 0.0, _zero)
             for c in S.CONTRACT_REQUIRED_FIELDS if c in df.columns]
    rules += [Rule(f"required_present:{c}", scope, F.lit(1), 0.0, _zero) for c in missing]
    for name, values in (("parameter", S.CONTRACT_PARAMETERS), ("unit", S.CONTRACT_UNITS)):
        if name in df.columns:
            rules += accepted_values_rules(scope, name, values)
            rules[-1].name = f"enum:{name}"
    return rules


def contract_report(measurements: DataFrame, latest: DataFrame, mart_df: DataFrame,
                    asof: str) -> DataFrame:
    """The full contract and quality-test suite.

    One aggregation per table: raw measurements (schema, completeness, validity, integrity), the
    staging and mart column tests (J1, J2), the latest snapshot (freshness) and the mart
    (category domain, coherence).  A required field that the measurements lack is reported as a
    failed rule (J3) and its value rules see NULLs.
    """
    raw_rules = schema_rules(measurements)
    measurements = with_missing(measurements, S.CONTRACT_REQUIRED_FIELDS)
    raw_rules += completeness_rules("measurements")
    raw_rules += expression_rules("measurements")
    raw_rules += pm25_range_rule("measurements")
    raw_rules += min_stations_rule("measurements")
    raw_rules += expected_parameters_rule("measurements")
    stg_rules, mart_rules = column_test_rules()
    mart_rules += accepted_values_rules("mart_hourly", "aqi_category", S.AQI_CATEGORIES)
    mart_rules += winter_vs_monsoon_rule("mart_hourly")
    return (evaluate(measurements, raw_rules)
            .unionByName(evaluate(mart.staging(with_missing(measurements, S.MEASUREMENTS.names)), stg_rules))
            .unionByName(evaluate(latest, freshness_rule("latest", asof)))
            .unionByName(evaluate(mart_df, mart_rules)))


def build_with_report(measurements: DataFrame, out_dir: str, asof: str) -> tuple[dict[str, str], DataFrame]:
    """J11 while building: staging, mart and latest snapshot are written below ``out_dir``, and the contract's metrics are taken
    from the rows as they are written.  Returns the tables' paths and the report.

    The measurements are scanned twice: once for staging (raw and staging rules ride on its write), once, one column only, for
    the number of stations, as a distinct count cannot ride.  Mart and snapshot are made from the written staging table.
    """
    spark, out = measurements.sparkSession, out_dir.rstrip("/")
    paths = {name: f"{out}/{name}" for name in ("stg_measurements", "mart_hourly", "latest")}
    raw_rules = schema_rules(measurements)
    m = with_missing(measurements, S.CONTRACT_REQUIRED_FIELDS)
    raw_rules += completeness_rules("measurements") + expression_rules("measurements") + pm25_range_rule("measurements") + expected_parameters_rule("measurements")
    stations = min_stations_rule("measurements")
    stg_rules, mart_rules = column_test_rules()
    mart_rules += accepted_values_rules("mart_hourly", "aqi_category", S.AQI_CATEGORIES) + winter_vs_monsoon_rule("mart_hourly")

    raw, raw_seen = observed(with_missing(m, S.MEASUREMENTS.names), raw_rules)
    stg, stg_seen = observed(mart.staging(raw), stg_rules)
    stg.write.parquet(paths["stg_measurements"])
    stg = spark.read.parquet(paths["stg_measurements"])
    made, mart_seen = observed(mart.with_aqi(mart.pivot_hourly(mart.intermediate(stg))), mart_rules)
    made.write.parquet(paths["mart_hourly"])
    fresh = freshness_rule("latest", asof)
    snapshot, latest_seen = observed(latest_snapshot(stg), fresh)
    snapshot.write.parquet(paths["latest"])
    report = observed_results(spark, raw_seen, raw_rules).unionByName(evaluate(m, stations))
    for seen, rules in ((stg_seen, stg_rules), (latest_seen, fresh), (mart_seen, mart_rules)):
        report = report.unionByName(observed_results(spark, seen, rules))
    return paths, report


# ---- C3: completeness over the station x parameter x day spine ---------------------------

def daily_completeness(measurements: DataFrame, parameters=None, t: str = "datetime_utc") -> DataFrame:
    """C3 + D3: readings per (station, parameter, day) on the full spine of stations seen,
    expected parameters and every day between the table's first and last day.

    Slots without a reading are kept with zero counts (the reference's stations x parameters x
    time grid).  No join: each slot with readings brings forth the empty days up to the next one of its
    station and parameter, and a start row per station and parameter those before the first.  So only the
    readings, pre-aggregated to one row per slot, are shuffled and sorted, never the spine; a station holding
    a third of all rows contributes at most one row per (parameter, day) to the shuffle.
    """
    parameters = parameters or S.POLLUTANTS
    day = cal.floor_day(t)
    # one pass over the raw rows; the slot table (one row per station, parameter and day) is
    # checkpointed and gives the station dimension and the day bounds as well
    daily = materialize(measurements.groupBy("location_id", "parameter", day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"), F.avg("value").alias("mean")))
    first = daily.select(F.min("day")).scalar()
    last = daily.select(F.max("day")).scalar()
    dim = (daily.select("location_id").distinct()
           .select("location_id", F.explode(F.array(*[F.lit(p) for p in parameters])).alias("parameter")))
    # a start row stands a day before the first and is no slot itself
    one = F.expr("INTERVAL 1 DAY")
    known = daily.where(F.col("location_id").isNotNull() & F.col("day").isNotNull() & F.col("parameter").isin(list(parameters)))
    rows = known.withColumn("from", F.col("day")).unionByName(
        dim.withColumns({"day": first - one, "from": first}), allowMissingColumns=True)
    series = Window.partitionBy("location_id", "parameter").orderBy("day")
    rows = (rows.withColumn("to", F.coalesce(F.lead("day").over(series) - one, last))
            .where(F.col("from") <= F.col("to")))
    spine = J.spine_product(rows, F.col("from"), F.col("to"), "1 DAY", out="slot", by=["location_id", "parameter", "from"])
    read = F.col("slot") == F.col("day")
    return spine.select("location_id", "parameter", F.col("slot").cast("timestamp_ntz").alias("day"),
                        F.when(read, F.col("n_rows")).otherwise(F.lit(0)).cast("long").alias("n_rows"),
                        F.when(read, F.col("n_values")).otherwise(F.lit(0)).cast("long").alias("n_values"),
                        F.when(read, F.round("mean", 9)).alias("mean"))
