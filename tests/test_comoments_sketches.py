"""Pairwise co-moments against pandas; sketches: merging days, bounds, edge cases."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airshed.operators import comoments as CM
from airshed.plans import sketches as SK
from airshed.plans import stats as ST


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4)) + [0, 1e6, -5, 1e-3]
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["flat"], pdf["none"] = 7.0, np.nan
    pdf = pdf.mask(pd.DataFrame(rng.random(pdf.shape) < 0.15, columns=pdf.columns))
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in pdf.to_numpy().tolist()]
    return pdf, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))


@pytest.mark.parametrize("parts", [1, 13])
def test_correlations_equal_pandas_with_nulls(spark, table, parts):
    pdf, df = table
    got = {(r["row"], r["col"]): (r["n"], r["corr"]) for r in CM.correlations(df.repartition(parts), list(pdf.columns)).collect()}
    want = pdf.corr()
    assert len(got) == len(pdf.columns) ** 2
    for (a, b), (n, corr) in got.items():
        assert n == int((pdf[a].notna() & pdf[b].notna()).sum())
        if "flat" in (a, b) or "none" in (a, b):
            assert corr is None
        else:
            assert corr == pytest.approx(want.loc[a, b], abs=1e-9)


def test_merging_is_exact_and_far_means_keep_digits():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) + 1e9
    x[rng.random(x.shape) < 0.2] = np.nan
    whole, parts = CM.of_batch(x), None
    for at in range(0, 300, 37):
        b = CM.of_batch(x[at:at + 37])
        parts = b if parts is None else CM.merged(parts, b)
    for p in CM.PARTS:
        assert np.allclose(parts[p], whole[p], rtol=1e-5, atol=1e-4)  # of numbers near 1e9
    has = ~np.isnan(x[:, 0]) & ~np.isnan(x[:, 1])
    assert parts["sxy"][0, 1] == pytest.approx(np.sum((x[has, 0] - x[has, 0].mean()) * (x[has, 1] - x[has, 1].mean())), rel=1e-5)


def test_no_row_is_multiplied_and_empty_tables_have_no_pairs(spark, table):
    _, df = table
    plan = CM.comoments(df, ["a", "b", "c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    assert CM.correlations(df.limit(0), ["a", "b"]).count() == 0
    assert ST.corr_matrix_top(df, "a", ["a", "b", "c"], 2).count() == 4


def test_merged_days_are_the_sketch_of_the_whole(spark):
    rng = np.random.default_rng(5)
    rows = [(int(d), int(s), float(v)) for d, s, v in zip(rng.integers(0, 9, 4000), rng.integers(0, 3000, 4000), rng.normal(0, 50, 4000))]
    df = spark.createDataFrame(rows, "day int, station long, v double").withColumn("g", F.col("station") % 2)
    for make, merge, col in ((SK.distinct_sketch, SK.merge_distinct, "station"), (SK.quantile_sketch, SK.merge_quantiles, "v")):
        merged = sorted(tuple(r) for r in merge(make(df, ["g", "day"], col), ["g"]).collect())
        assert merged == sorted(tuple(r) for r in make(df, ["g"], col).collect())


@pytest.mark.parametrize("n", [1, 50, 3000, 200000])
def test_distinct_counts_are_within_four_standard_errors(spark, n):
    df = spark.range(n).union(spark.range(n)).withColumn("g", F.lit(1))
    got = SK.distinct_estimate(SK.distinct_sketch(df, ["g"], "id"), ["g"]).first()["estimate"]
    assert abs(got - n) <= max(1.0, 4 * SK.ERROR * n)


def test_quantiles_are_within_the_relative_bound(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.lognormal(0, 3, 2000), -rng.lognormal(0, 2, 700), np.zeros(150), [1e300, -1e-300]])
    df = spark.createDataFrame([(1, float(x)) for x in v] + [(1, None), (1, float("nan"))], "g int, v double")
    shares = [0.0, 0.01, 0.25, 0.3, 0.5, 0.9, 1.0]
    got = {r["share"]: r["value"] for r in SK.quantiles(SK.quantile_sketch(df, ["g"], "v"), ["g"], shares).collect()}
    for s in shares:
        exact = np.sort(v)[math.floor(s * (len(v) - 1))]
        assert abs(got[s] - exact) <= (SK.ALPHA + 1e-9) * abs(exact)
    assert SK.quantiles(SK.quantile_sketch(df.limit(0), ["g"], "v"), ["g"], shares).count() == 0
