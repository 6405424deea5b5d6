"""Exploratory statistics behind the reference's EDA report.

Global constants a row needs (min, max, mean, n) enter as scalar subqueries
(``DataFrame.scalar()``): Spark runs the one-row aggregation first and inlines
the value, so there is no cross join and nothing passes through the driver.
Exact quantiles use iterative histogram narrowing: every pass is a distributed
count per bucket; only bucket counts (bounded) reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import calendar as cal
from airshed.functions.misc import numeric_columns
from airshed.operators import series as ser
from airshed.operators.comoments import correlations
from airshed.session import materialize

Z95 = 1.959963984540054  # two-sided 95 % normal quantile


def _r(c: Column, digits: int = 9) -> Column:
    return F.round(c, digits)


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate of ``df`` as a scalar-subquery column."""
    return df.select(expr).scalar()


# ---- grouped means (D8-D10) ---------------------------------------------------

def mean_std_by(df: DataFrame, key: str, target: str = "pm2p5") -> DataFrame:
    """Mean and sample std of ``target`` per ``key`` plus the +-1 std band."""
    g = df.groupBy(key).agg(F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"))
    return g.select(key, _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"),
                    _r(F.col("mean") - F.col("std")).alias("band_low"),
                    _r(F.col("mean") + F.col("std")).alias("band_high"))


def mean_by_weekday(df: DataFrame, key: str = "jour_semaine", target: str = "pm2p5") -> DataFrame:
    """Mean per weekday (Monday=0) with the weekend label used for colouring."""
    g = df.groupBy(key).agg(_r(F.avg(target)).alias("mean"))
    return g.withColumn("is_weekend", F.col(key) >= 5)


def mean_by(df: DataFrame, key: str, target: str = "pm2p5") -> DataFrame:
    """Mean per key (month)."""
    return df.groupBy(key).agg(_r(F.avg(target)).alias("mean"))


# ---- exact quantiles by histogram narrowing ---------------------------------

def order_statistics(df: DataFrame, col: str, ks: list[int], buckets: int = 1024,
                     max_passes: int = 1100) -> dict[int, float | None]:
    """Exact k-th smallest (0-based) non-NULL values of ``col`` for several ranks at once.

    Each pass is ONE distributed aggregation for all ranks: the values inside each rank's current
    range are counted per equal-width bucket (at most ``buckets`` rows per rank reach the
    driver); the bucket that holds the rank, narrowed to its own min/max, is the next range.
    A rank is settled when its range holds one distinct value, so a value repeated in a third
    of all rows settles at once.  A range loses at least one distinct value per pass and shrinks
    about ``buckets``-fold; if ``max_passes`` were ever not enough it raises, it never guesses.
    The input should be materialised: every pass scans it.
    """
    v = F.col("v")
    base = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    lo, hi = base.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return {k: None for k in ks}
    out: dict[int, float | None] = {}
    todo = {k: (lo, hi, 0) for k in sorted(set(ks))}      # rank -> (range lo, range hi, rows below)
    for _ in range(max_passes):
        for k, (a, b, _) in list(todo.items()):
            if a == b:
                out[k] = float(a)
                del todo[k]
        if not todo:
            return out
        ranges = sorted(set(todo.values()))               # disjoint: each value lies in one at most
        which, bucket = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (a, b, _) in reversed(list(enumerate(ranges))):
            inside = (v >= a) & (v <= b)
            width = b / buckets - a / buckets              # b - a may overflow
            pos = (F.least(F.floor(v / F.lit(width) - F.lit(a / width)), F.lit(buckets - 1)) if width > 0 and math.isfinite(a / width)
                   else F.when(v == a, 0).otherwise(1))
            which = F.when(inside, F.lit(i)).otherwise(which)
            # the ends get buckets of their own, so rounding cannot keep a range as it is
            bucket = F.when(inside, F.when(v == a, -1).when(v == b, buckets).otherwise(pos).cast("int")).otherwise(bucket)
        rows = (base.select(which.alias("r"), bucket.alias("b"), "v").where(F.col("r").isNotNull())
                .groupBy("r", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
                .orderBy("r", "b").collect())
        for k, rng in list(todo.items()):
            acc = rng[2]
            for r in rows:
                if ranges[r["r"]] != rng:
                    continue
                if acc + r["n"] > k:
                    todo[k] = (r["mn"], r["mx"], acc)
                    break
                acc += r["n"]
            else:                                          # a rank beyond the number of values
                out[k] = None
                del todo[k]
    raise RuntimeError(f"order statistics not settled after {max_passes} passes: {todo}")


def quantiles_linear(df: DataFrame, col: str, probs, n: int) -> dict[float, float | None]:
    """Exact quantiles with linear interpolation between order statistics (pandas/numpy default)."""
    hs = {p: (n - 1) * p for p in probs}
    ranks = sorted({i for h in hs.values() for i in (math.floor(h), math.ceil(h))})
    stat = order_statistics(df, col, ranks)
    out = {}
    for p, h in hs.items():
        lo_i, hi_i = math.floor(h), math.ceil(h)
        a, b = stat[lo_i], stat[hi_i]
        out[p] = None if a is None else a + (h - lo_i) * (b - a)
    return out


def describe(df: DataFrame, col: str = "pm2p5", exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, std, min, 25 %, 50 %, 75 %, max (pandas ``describe``).

    ``exact=True`` gives pandas' linearly interpolated quartiles by histogram narrowing (a few
    distributed passes over the materialised column); ``exact=False`` uses one
    ``percentile_approx`` pass (relative rank error ``1 / accuracy``, no interpolation).
    """
    spark = df.sparkSession
    c = F.col(col)
    moments = [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
               F.min(c).alias("min"), F.max(c).alias("max")]
    if not exact:
        q = F.percentile_approx(c.cast("double"), [0.25, 0.5, 0.75], accuracy)
        row = df.agg(*moments, q.alias("q")).first()
        qs = row["q"] or [None, None, None]
        q = {0.25: qs[0], 0.5: qs[1], 0.75: qs[2]}
        n = int(row["count"])
    else:
        # one column, materialised once: the quantile passes each scan it
        base = materialize(df.where(c.isNotNull()).select(c))
        row = base.agg(*moments).first()
        n = int(row["count"])
        q = quantiles_linear(base, col, [0.25, 0.5, 0.75], n) if n else {0.25: None, 0.5: None, 0.75: None}
    stats = [("count", float(n)), ("mean", row["mean"]), ("std", row["std"]), ("min", row["min"]),
             ("25%", q[0.25]), ("50%", q[0.5]), ("75%", q[0.75]), ("max", row["max"])]
    out = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in stats],
                                "stat string, value double")
    return out.select("stat", _r(F.col("value")).alias("value"))


# ---- NULL ratios, shape (D12, D13) ---------------------------------------------

def null_ratios(df: DataFrame, top: int = 20) -> DataFrame:
    """Share of NULLs per column, only > 0, largest first, top ``top`` (one scan)."""
    cols = df.columns
    agg = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_ratio"))
                      for i, c in enumerate(cols)])
    long = agg.select(F.inline(pairs)).where(F.col("null_ratio") > 0)
    return (long.orderBy(F.col("null_ratio").desc(), F.col("column_name")).limit(top)
            .select("column_name", _r(F.col("null_ratio")).alias("null_ratio")))


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count (the latter is schema metadata)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


# ---- correlation (D14, D15) ------------------------------------------------------

def guarded_corr(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are non-NULL; NULL for a constant column.

    Built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column.
    """
    a = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    b = F.when(F.col(x).isNotNull(), F.col(y).cast("double"))
    den = F.stddev_pop(a) * F.stddev_pop(b)
    return F.covar_pop(a, b) / F.when(den != 0, den)


def corr_with_target(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Correlation of ``target`` with each column present, one pass, ascending."""
    cols = [c for c in cols if c in df.columns]
    agg = df.agg(*[guarded_corr(target, c).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("corr"))
                      for i, c in enumerate(cols)])
    return agg.select(F.inline(pairs)).select("feature", _r(F.col("corr")).alias("corr")).orderBy("corr")


def corr_matrix_top(df: DataFrame, target: str, cols: list[str], top: int = 15) -> DataFrame:
    """All pairwise correlations, then the ``top`` columns by |corr with target| (NULL
    last, name as tie-breaker) and their full matrix.

    All pairs' co-moments come from one pass over the rows (``operators.comoments``): no row is multiplied.
    """
    # k * k rows, read three times below
    full = materialize(correlations(df, cols))
    # top-k of the target's k correlations: an ordered limit (TakeOrderedAndProject)
    ranked = (full.where(F.col("row") == target)
              .orderBy(F.abs("corr").desc_nulls_last(), F.col("col")).limit(top)
              .select(F.col("col").alias("_keep")))
    out = (full.join(ranked.select(F.col("_keep").alias("row")), "row", "left_semi")
           .join(ranked.select(F.col("_keep").alias("col")), "col", "left_semi"))
    return out.select("row", "col", _r(F.col("corr")).alias("corr"))


# ---- histogram, resample, trailing window (D16, D17, B11) -------------------------

def histogram(df: DataFrame, col: str = "pm2p5", bins: int = 60) -> DataFrame:
    """Equal-width histogram between min and max, the max value in the last bin, empty bins 0."""
    spark = df.sparkSession
    v = F.col(col).cast("double")
    base = df.where(F.col(col).isNotNull())
    mn, mx = scalar(base, F.min(v)), scalar(base, F.max(v))
    width = (mx - mn) / F.lit(float(bins))
    # a constant column (max == min) puts every value in bin 0
    b = F.least(F.floor((v - mn) / F.when(mx > mn, mx - mn) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    counts = base.groupBy(F.coalesce(b, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = spine.join(counts, "bin", "left")
    return out.select("bin", _r(mn + F.col("bin") * width).alias("lo"),
                      _r(mn + (F.col("bin") + 1) * width).alias("hi"),
                      F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def daily_mean(df: DataFrame, t: str = "datetime", col: str = "pm2p5") -> DataFrame:
    """Daily resample mean; days without data between first and last are kept as NULL."""
    day = cal.floor_day(t)
    means = df.groupBy(day.alias("day")).agg(F.avg(col).alias("mean"))
    first, last = scalar(df, F.min(day)), scalar(df, F.max(day))
    spine = (df.sparkSession.range(1)
             .select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("day")))
    return spine.join(means, "day", "left").select(F.col("day").cast("timestamp_ntz").alias("day"),
                                                   _r(F.col("mean")).alias("mean"))


def trailing_days(df: DataFrame, days: int = 90, t: str = "datetime") -> DataFrame:
    """Rows within ``days`` of the latest timestamp (inclusive)."""
    latest = scalar(df, F.max(t))
    return df.where(F.col(t) >= latest - F.make_dt_interval(F.lit(days)))


# ---- autocorrelation (E8, E9) ---------------------------------------------------------

def autocovariances(df: DataFrame, series, order, col: str, max_lag: int,
                    block_rows: int = ser.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Sums ``S_k = sum_t (x_t - m)(x_{t-k} - m)`` for k = 0..max_lag and n, per series.

    NULLs are dropped first (positions close up, as ``dropna`` does); the mean enters per
    series through a small equi join; lags come from one blocked window pass.
    """
    series = ser._cols(series)
    base = df.where(F.col(col).isNotNull()).select(*series, *ser._cols(order), F.col(col).cast("double").alias("_x"))
    stats = base.groupBy(*series).agg(F.avg("_x").alias("_m"), F.count(F.lit(1)).alias("n"))
    d = ser.with_position(base, series, order)
    d = d.join(stats, series, "inner").withColumn("_y", F.col("_x") - F.col("_m"))
    w = ser.block_window(series)
    d = ser.blocked(d, max_lag, block_rows)
    prods = [(F.col("_y") * F.lag("_y", k).over(w)).alias(f"_p{k}") for k in range(max_lag + 1)]
    d = ser.unblock(d.select(*series, "n", ser.HALO, ser.BLK, *prods))
    sums = d.groupBy(*series).agg(F.first("n").alias("n"),
                                  *[F.sum(f"_p{k}").alias(f"s{k}") for k in range(max_lag + 1)])
    return sums


def acf(df: DataFrame, series, order, col: str = "pm2p5", nlags: int = 72) -> DataFrame:
    """Autocorrelation at lags 0..nlags (denominator n) with Bartlett 95 % bounds.

    ``var_k = (1 + 2 * sum_{j<k} acf_j^2) / n`` for k >= 2, ``1/n`` at k = 1, 0 at k = 0; the
    bounds are ``acf_k -+ z * sqrt(var_k)``.  The cumulative sum runs over the 73-row result.
    """
    series = ser._cols(series)
    sums = autocovariances(df, series, order, col, nlags)
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(f"s{k}") / F.col("s0")).alias("acf"))
                     for k in range(nlags + 1)])
    long = sums.select(*series, "n", F.inline(lags))
    w = Window.partitionBy(*series).orderBy("lag")
    # cumulative sum of acf_j^2 over 1 <= j < k (the running sum from 0 minus acf_0^2 = 1)
    sq = F.sum(F.col("acf") * F.col("acf")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cum = F.coalesce(sq, F.lit(0.0)) - F.lit(1.0)
    var = (F.when(F.col("lag") == 0, F.lit(0.0))
           .when(F.col("lag") == 1, F.lit(1.0) / F.col("n"))
           .otherwise((F.lit(1.0) + F.lit(2.0) * cum) / F.col("n")))
    half = F.lit(Z95) * F.sqrt(var)
    return long.select(*series, "lag", _r(F.col("acf")).alias("acf"),
                       _r(F.col("acf") - half).alias("lo95"), _r(F.col("acf") + half).alias("hi95"))


def _durbin_levinson(gamma: np.ndarray) -> np.ndarray:
    """Partial autocorrelations 0..k of every row of autocovariances (rows x k + 1) at once."""
    rho = gamma / gamma[:, :1]
    lags = gamma.shape[1] - 1
    pac = np.ones_like(rho)
    phi = np.zeros((len(rho), lags + 1))
    for k in range(1, lags + 1):
        back = rho[:, k - 1:0:-1]                                   # rho[k - 1] .. rho[1]
        num = rho[:, k] - (phi[:, 1:k] * back).sum(axis=1)
        den = 1.0 - (phi[:, 1:k] * rho[:, 1:k]).sum(axis=1)
        new = np.divide(num, den, out=np.full(len(rho), np.nan), where=den != 0)
        phi[:, 1:k] = phi[:, 1:k] - new[:, None] * phi[:, k - 1:0:-1]
        phi[:, k] = pac[:, k] = new
    return pac


def pacf_yule_walker(df: DataFrame, series, order, col: str = "pm2p5", nlags: int = 72) -> DataFrame:
    """Partial autocorrelation by Yule-Walker with the adjusted (n - k) denominator.

    The autocovariance sums are distributed (E8, one row per series).  The Durbin-Levinson recursion
    runs over batches of these rows, all series of a batch at once and without another shuffle.
    Series of ``nlags`` values or fewer have no such estimate and give no rows.
    """
    series = ser._cols(series)
    sums = autocovariances(df, series, order, col, nlags).where(F.col("n") > nlags)
    types = {f.name: f.dataType.simpleString() for f in sums.schema.fields}
    schema = ", ".join([f"{s} {types[s]}" for s in series] + ["lag int", "pacf double", "lo95 double", "hi95 double"])

    def rows_of(batches):
        for pdf in batches:
            n = pdf["n"].to_numpy(float)[:, None]
            pac = _durbin_levinson(pdf[[f"s{k}" for k in range(nlags + 1)]].to_numpy(float) / (n - np.arange(nlags + 1)))
            half = np.where(np.arange(nlags + 1) > 0, Z95 / np.sqrt(n), 0.0)
            out = pdf.loc[pdf.index.repeat(nlags + 1), series].reset_index(drop=True)
            yield out.assign(lag=np.tile(np.arange(nlags + 1, dtype=np.int32), len(pdf)), pacf=pac.ravel(),
                             lo95=(pac - half).ravel(), hi95=(pac + half).ravel())

    out = sums.mapInPandas(rows_of, schema)
    return out.select(*series, "lag", *[_r(F.col(c)).alias(c) for c in ("pacf", "lo95", "hi95")])


def preview(df: DataFrame, order="datetime", n: int = 5, digits: int = 2) -> DataFrame:
    """first ``n`` rows by ``order`` (time, then a key that breaks ties) with floating columns rounded to ``digits``."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    top = df.orderBy(order).limit(n)
    return top.select(*[F.round(c, digits).alias(c) if c in floats else F.col(c) for c in df.columns])


# ---- K11: the whole report --------------------------------------------------------------

def eda_report(features: DataFrame, target: str = "pm2p5", series=("series_id",), t: str = "datetime",
               weather=("temp_c", "vent_kmh", "blh_m", "no2"), nlags: int = 72) -> dict[str, DataFrame]:
    """Every table behind the reference's EDA report, one lazy DataFrame per panel.

    The input is checkpointed once (every panel scans it); the panels are independent jobs,
    each a distributed aggregation, so a caller writes or shows whichever it needs.  ``describe``
    is the only eager panel (its exact quartiles narrow a range pass by pass).
    """
    base = materialize(features)
    series = list(series)
    numeric = numeric_columns(base, exclude=series)
    plain = base.drop(*series)
    return {
        "shape": shape(plain),
        "null_ratios": null_ratios(plain),
        "describe": describe(plain, target),
        "daily_mean": daily_mean(plain, t, target),
        "histogram": histogram(plain, target, 60),
        "recent_90_days": trailing_days(base, 90, t).select(*series, t, target),
        "by_hour": mean_std_by(plain, "heure", target),
        "by_weekday": mean_by_weekday(plain, "jour_semaine", target),
        "by_month": mean_by(plain, "mois", target),
        "corr_weather": corr_with_target(plain, target, list(weather)),
        "corr_matrix": corr_matrix_top(plain, target, numeric, 15),
        "acf": acf(base, series, [t], target, nlags),
        "pacf": pacf_yule_walker(base, series, [t], target, nlags),
        "preview": preview(base, [t, *series], 5, 2),
    }
