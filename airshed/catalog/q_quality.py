"""Queries of the data-quality layer (J1-J11) and the snapshot / set operators behind them."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from airshed import schemas as S
from airshed.catalog import register
from airshed.catalog import sql_fixtures as X
from airshed.operators import dedup, joins
from airshed.plans import mart, quality as Q
from airshed.plans import sketches as SK
from airshed.plans import stats as ST
from airshed.session import materialize, shared_path
from airshed.sources import driver_tables as D
from airshed.sources import sinks

ASOF_CONTRACT = "2024-12-26 00:00:00"

ZERO = "coalesce({o} <= {t}, true)"
AT_LEAST = "coalesce({o} >= {t}, true)"

LATEST_SQL = """
latest AS (
  SELECT location_id, 'station-' || CAST(location_id AS VARCHAR) AS location_name, parameter,
         value, unit, datetime_utc, latitude, longitude, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY location_id, parameter
                                     ORDER BY datetime_utc DESC, value DESC) AS rn
        FROM m1 WHERE value IS NOT NULL)
  WHERE rn = 1
)"""


def rules_sql(source: str, rules: list[tuple[str, str, str, float, str]]) -> str:
    """SQL text of a rule set: one aggregate over ``source``, one row per rule."""
    aggs = ", ".join(f"CAST({m} AS DOUBLE) AS m{i}" for i, (_, _, m, _, _) in enumerate(rules))
    rows = []
    for i, (name, scope, _, thr, passed) in enumerate(rules):
        t = f"CAST({float(thr)} AS DOUBLE)"
        rows.append(f"SELECT '{name}' AS rule, '{scope}' AS scope, round(m{i}, 9) AS observed, "
                    f"{t} AS threshold, {passed.format(o=f'm{i}', t=t)} AS passed FROM (SELECT {aggs} FROM {source})")
    return "\nUNION ALL\n".join(rows)


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---- column tests (J1, J2) -------------------------------------------------

J1_STG = [(f"not_null:{c}", "stg_measurements", f"count_if({c} IS NULL)", 0.0, ZERO)
          for c in S.NOT_NULL_STAGING]
J1_MART = [(f"not_null:{c}", "mart_hourly", f"count_if({c} IS NULL)", 0.0, ZERO) for c in S.NOT_NULL_MART]
J2_STG = [("accepted_values:parameter", "stg_measurements",
           f"count_if(NOT (parameter IN ({_in(S.ACCEPTED_STAGING_PARAMETER)})))", 0.0, ZERO)]
J2_MART = [("accepted_values:season", "mart_hourly",
            f"count_if(NOT (season IN ({_in(S.ACCEPTED_MART_SEASON)})))", 0.0, ZERO)]


@register("j1_j2_column_tests", X.MART_CHAIN + "\n" + rules_sql("stg", J1_STG + J2_STG)
          + "\nUNION ALL\n" + rules_sql("mart", J1_MART + J2_MART))
def j1_j2_column_tests(spark, sf_dir):
    """J1 not_null + J2 accepted_values on the staging model and the mart."""
    m = D.measurements(spark, sf_dir)
    return Q.column_tests(mart.staging(m), mart.mart_hourly(m))


# ---- contract (J3-J11) -------------------------------------------------------

REQUIRED = [(f"required:{c}", "measurements", f"count_if({c} IS NULL)", 0.0, ZERO)
            for c in S.CONTRACT_REQUIRED_FIELDS]
ENUMS = [("enum:parameter", "measurements", f"count_if(NOT (parameter IN ({_in(S.CONTRACT_PARAMETERS)})))", 0.0, ZERO),
         ("enum:unit", "measurements", f"count_if(NOT (unit IN ({_in(S.CONTRACT_UNITS)})))", 0.0, ZERO)]
COMPLETENESS = [(f"completeness:{c}", "measurements",
                 f"CAST(count({c}) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0)", thr, AT_LEAST)
                for c, thr in S.CONTRACT_COMPLETENESS]
VALIDITY = [(f"validity:{n}", "measurements", f"count_if(NOT ({t}))", 0.0, ZERO)
            for n, t in S.CONTRACT_VALIDITY_RULES]
PM25_RANGE = [("validity:pm25_0_999", "measurements",
               "count_if(parameter = 'pm25' AND (value < 0 OR value > 999))", 0.0, ZERO),
              ("validity:no_negative_values", "measurements", "count_if(value < 0)", 0.0, ZERO)]
MIN_STATIONS = [("integrity:min_stations", "measurements", "count(DISTINCT location_id)",
                 float(S.CONTRACT_MIN_STATIONS), "{o} >= {t}")]
EXPECTED = [("integrity:expected_parameters", "measurements",
             " + ".join(f"(1 - coalesce(max(CAST(parameter = '{p}' AS INTEGER)), 0))"
                        for p in S.CONTRACT_EXPECTED_PARAMETERS), 0.0, ZERO)]
FRESHNESS = [("freshness:datetime_utc", "latest",
              f"CAST(epoch_us(TIMESTAMP '{ASOF_CONTRACT}') - epoch_us(max(datetime_utc)) AS DOUBLE) / 3.6e9",
              float(S.CONTRACT_MAX_DELAY_HOURS), "coalesce({o} < {t}, true)")]
AQI_DOMAIN = [("accepted_values:aqi_category", "mart_hourly",
               f"count_if(NOT (aqi_category IN ({_in(S.AQI_CATEGORIES)})))", 0.0, ZERO)]
COHERENCE = [("coherence:winter_gt_monsoon", "mart_hourly",
              "avg(CASE WHEN season = 'winter' AND pm25 IS NOT NULL THEN pm25 END)"
              " / nullif(avg(CASE WHEN season = 'monsoon' AND pm25 IS NOT NULL THEN pm25 END), 0.0)",
              1.0, "coalesce(({o} > {t}) OR ({o} = 0), true)")]


@register("j3_contract_schema", X.WITH_M1 + "\n" + rules_sql("m1", REQUIRED + ENUMS))
def j3_contract_schema(spark, sf_dir):
    """Required fields non-NULL and enums (parameter, unit) of the contract."""
    return Q.contract_schema_rules(D.measurements(spark, sf_dir))


@register("j4_completeness", X.WITH_M1 + "\n" + rules_sql("m1", COMPLETENESS))
def j4_completeness(spark, sf_dir):
    """Completeness ratios (100 % datetime_utc, 90 % value), empty table passes."""
    return Q.evaluate(D.measurements(spark, sf_dir), Q.completeness_rules("measurements"))


@register("j5_validity", X.WITH_M1 + "\n" + rules_sql("m1", VALIDITY + PM25_RANGE))
def j5_validity(spark, sf_dir):
    """Contract rule expressions given as text, plus the test-suite range checks."""
    return Q.evaluate(D.measurements(spark, sf_dir),
                      Q.expression_rules("measurements") + Q.pm25_range_rule("measurements"))


@register("j6_aqi_category_domain", X.MART_CHAIN + "\n" + rules_sql("mart", AQI_DOMAIN))
def j6_aqi_category_domain(spark, sf_dir):
    """Mart categories inside the six-name domain (NOT IN)."""
    return Q.evaluate(mart.mart_hourly(D.measurements(spark, sf_dir)),
                      Q.accepted_values_rules("mart_hourly", "aqi_category", S.AQI_CATEGORIES))


@register("j7_freshness", X.WITH_M1 + "," + LATEST_SQL + "\n" + rules_sql("latest", FRESHNESS))
def j7_freshness(spark, sf_dir):
    """Latest snapshot no older than 3 h at ``asof`` (strict); empty passes."""
    latest = dedup.latest_snapshot(D.with_station_names(D.measurements(spark, sf_dir)))
    return Q.evaluate(latest, Q.freshness_rule("latest", ASOF_CONTRACT))


@register("j8_min_stations", X.WITH_M1 + "\n" + rules_sql("m1", MIN_STATIONS))
def j8_min_stations(spark, sf_dir):
    """At least 10 distinct stations."""
    return Q.evaluate(D.measurements(spark, sf_dir), Q.min_stations_rule("measurements"))


@register("j9_expected_parameters", X.WITH_M1 + "\n" + rules_sql("m1", EXPECTED))
def j9_expected_parameters(spark, sf_dir):
    """The expected parameters pm25, pm10, no2, co all occur."""
    return Q.evaluate(D.measurements(spark, sf_dir), Q.expected_parameters_rule("measurements"))


@register("j10_winter_vs_monsoon", X.MART_CHAIN + "\n" + rules_sql("mart", COHERENCE))
def j10_winter_vs_monsoon(spark, sf_dir):
    """Winter mean pm25 above monsoon mean (ratio > 1); NULL or 0 passes."""
    return Q.evaluate(mart.mart_hourly(D.measurements(spark, sf_dir)), Q.winter_vs_monsoon_rule("mart_hourly"))


_J11_SQL = (X.MART_CHAIN + "," + LATEST_SQL + "\n"
          + rules_sql("m1", REQUIRED + ENUMS + COMPLETENESS + VALIDITY + PM25_RANGE + MIN_STATIONS + EXPECTED)
          + "\nUNION ALL\n" + rules_sql("stg", J1_STG + J2_STG)
          + "\nUNION ALL\n" + rules_sql("latest", FRESHNESS)
          + "\nUNION ALL\n" + rules_sql("mart", J1_MART + J2_MART + AQI_DOMAIN + COHERENCE))


@register("j11_contract_report", _J11_SQL)
def j11_contract_report(spark, sf_dir):
    """The whole contract in one aggregation per table (measurements, staging, latest, mart)."""
    m = D.measurements(spark, sf_dir)
    return Q.contract_report(m, dedup.latest_snapshot(D.with_station_names(m)), mart.mart_hourly(m), ASOF_CONTRACT)


@register("j11_contract_while_writing", _J11_SQL)
def j11_contract_while_writing(spark, sf_dir):
    """J11 without scans of its own: the metrics are observed while staging, mart and snapshot are written."""
    _, report = Q.build_with_report(D.with_station_names(D.measurements(spark, sf_dir)), shared_path(spark, "observed-models"), ASOF_CONTRACT)
    return report


@register("j11_contract_missing_field", X.WITH_M1 + "\n" + rules_sql("m1", [r for r in REQUIRED if "sensor_id" not in r[0]])
          + "\nUNION ALL\nSELECT 'required_present:sensor_id', 'measurements', CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), false")
def j11_contract_missing_field(spark, sf_dir):
    """J11 + J3 on measurements without ``sensor_id``: the missing field is a failed rule, the
    others are still evaluated (the required-field rows of the report)."""
    m = D.measurements(spark, sf_dir)
    report = Q.contract_report(m.drop("sensor_id"), dedup.latest_snapshot(D.with_station_names(m)), mart.mart_hourly(m), ASOF_CONTRACT)
    return report.where("rule LIKE 'required%'")


# ---- snapshot and set operators --------------------------------------------

@register("e4_latest_snapshot", X.WITH_M1 + "," + LATEST_SQL + "\nSELECT * FROM latest")
def e4_latest_snapshot(spark, sf_dir):
    """E4 (per series) / A4 shape: newest reading per (station, parameter) via max_by."""
    return dedup.latest_snapshot(D.with_station_names(D.measurements(spark, sf_dir)))


@register("d6_distinct_parameters", X.WITH_M1 + "\nSELECT DISTINCT parameter FROM m1")
def d6_distinct_parameters(spark, sf_dir):
    """Select distinct parameter."""
    return D.measurements(spark, sf_dir).select("parameter").distinct()


@register("c5_absent_contract_parameters", X.WITH_M1 + """
SELECT parameter FROM (VALUES """ + ", ".join(f"('{p}')" for p in S.CONTRACT_PARAMETERS) + """) AS e(parameter)
WHERE parameter NOT IN (SELECT parameter FROM m1 WHERE parameter IS NOT NULL)""")
def c5_absent_contract_parameters(spark, sf_dir):
    """C5/G: contract parameters never measured (expected minus present, anti join)."""
    expected = spark.createDataFrame([(p,) for p in S.CONTRACT_PARAMETERS], "parameter string")
    return joins.expected_minus_present(expected, D.measurements(spark, sf_dir), "parameter")


SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


@register("d5_d11_day_sketches", X.WITH_M1 + f""",
h AS (SELECT parameter, CAST('0x' || substr(md5(CAST(location_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM m1),
reg AS (SELECT parameter, h & {SK.REGISTERS - 1} AS r, max(CASE WHEN h >> {SK.BITS} = 0 THEN {SK.HASH_BITS - SK.BITS + 1}
               ELSE {SK.HASH_BITS - SK.BITS + 1} - length(ltrim(bin(h >> {SK.BITS}), '0')) END) AS place FROM h GROUP BY ALL),
est AS (SELECT parameter, {0.7213 / (1 + 1.079 / SK.REGISTERS) * SK.REGISTERS ** 2!r} / (sum(pow(2e0, -place)) + {SK.REGISTERS} - count(*)) AS raw, {SK.REGISTERS} - count(*) AS e
        FROM reg GROUP BY parameter),
cnt AS (SELECT parameter, CASE WHEN raw <= {2.5 * SK.REGISTERS} AND e > 0 THEN {float(SK.REGISTERS)!r} * ln({float(SK.REGISTERS)!r} / e) ELSE raw END AS estimate FROM est),
v AS (SELECT parameter, value, row_number() OVER (PARTITION BY parameter ORDER BY value) - 1 AS rank, count(*) OVER (PARTITION BY parameter) AS n
      FROM m1 WHERE value IS NOT NULL),
s AS (SELECT CAST(unnest({SHARES}) AS DOUBLE) AS share),
ex AS (SELECT parameter, share, value AS exact FROM v CROSS JOIN s WHERE rank = floor(share * (n - 1))),
b AS (SELECT *, CASE WHEN exact = 0 THEN 0e0 ELSE sign(exact) * 2e0 * pow({SK.GAMMA!r}, ceil(ln(abs(exact)) / {math.log(SK.GAMMA)!r})) / {SK.GAMMA + 1!r} END AS sketched FROM ex),
st AS (SELECT parameter, count(DISTINCT location_id) AS n_stations FROM m1 GROUP BY parameter)
SELECT b.parameter, share, n_stations, round(estimate, 6) AS stations_estimate, exact, round(sketched, 6) AS sketched,
       abs(sketched - exact) <= {SK.ALPHA + 1e-9!r} * abs(exact) AND abs(estimate - n_stations) <= {4 * SK.ERROR!r} * n_stations AS within_bounds
FROM b JOIN cnt USING (parameter) JOIN st USING (parameter)""")
def d5_d11_day_sketches(spark, sf_dir):
    """D5 + D11: distinct stations and quantiles of each parameter from sketches stored by day and merged, beside the exact
    figures and whether they are within the stated bounds (four standard errors; ``ALPHA``)."""
    m = materialize(D.measurements(spark, sf_dir).select("parameter", "location_id", "value", F.to_date("datetime_utc").alias("day")))
    by_day = ["parameter", "day"]
    stored = {name: sinks.write_replace(df, shared_path(spark, f"sketch-{name}")) for name, df in (
        ("distinct", SK.distinct_sketch(m, by_day, "location_id")), ("quantile", SK.quantile_sketch(m, by_day, "value")))}
    count = SK.distinct_estimate(SK.merge_distinct(spark.read.parquet(stored["distinct"]), ["parameter"]), ["parameter"])
    read = SK.quantiles(SK.merge_quantiles(spark.read.parquet(stored["quantile"]), ["parameter"]), ["parameter"], SHARES)
    stations = m.groupBy("parameter").agg(F.count_distinct("location_id").alias("n_stations"))
    exact = []  # of the few parameters, ranks settled by narrowing
    for r in m.groupBy("parameter").agg(F.count("value").alias("n")).where("n > 0").collect():
        ranks = {s: math.floor(s * (r["n"] - 1)) for s in SHARES}
        found = ST.order_statistics(m.where(F.col("parameter") == r["parameter"]), "value", list(ranks.values()))
        exact += [(r["parameter"], s, found[k]) for s, k in ranks.items()]
    exact = spark.createDataFrame(exact, "parameter string, share double, exact double")
    d = read.join(exact, ["parameter", "share"]).join(count, "parameter").join(stations, "parameter")
    close = (F.abs(F.col("value") - F.col("exact")) <= (SK.ALPHA + 1e-9) * F.abs("exact")) & (F.abs(F.col("estimate") - F.col("n_stations")) <= 4 * SK.ERROR * F.col("n_stations"))
    return d.select("parameter", "share", "n_stations", F.round("estimate", 6).alias("stations_estimate"), "exact", F.round("value", 6).alias("sketched"), close.alias("within_bounds"))
