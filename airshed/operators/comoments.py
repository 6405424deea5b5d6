"""Pairwise co-moments of many columns in one pass over the rows.

For every pair of columns the rows where both have a value count: their number, means, squared deviations and co-deviation.  A task
keeps these as k x k matrices and updates them batch by batch with matrix products; two sets merge exactly like the moments of two
samples.  So no row is multiplied by the number of pairs, and one row a task is shuffled.  Sums are taken around each batch's
own means, which keeps digits when values lie far from nought.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of the matrices: rows, mean and squared deviations of the first and of the second column, co-deviation.
PARTS = ("n", "mx", "my", "sxx", "syy", "sxy")
SPREAD = 64
ROW = ", ".join(f"{p} array<double>" for p in PARTS)


def of_batch(x: np.ndarray) -> dict[str, np.ndarray]:
    """Co-moments of a batch; NaN stands for no value."""
    has = ~np.isnan(x)
    center = np.where(has.any(axis=0), np.where(has, x, 0.0).sum(axis=0) / np.maximum(has.sum(axis=0), 1), 0.0)
    m, v = has.astype(float), np.where(has, x - center, 0.0)
    n = m.T @ m
    some = np.maximum(n, 1)
    sum_x, sum_y = v.T @ m, m.T @ v  # of the first and of the second column, over the pair's rows
    return {"n": n, "mx": sum_x / some + center[:, None], "my": sum_y / some + center[None, :],
            "sxx": (v * v).T @ m - sum_x * sum_x / some, "syy": m.T @ (v * v) - sum_y * sum_y / some, "sxy": v.T @ v - sum_x * sum_y / some}


def merged(a: dict, b: dict) -> dict:
    n = a["n"] + b["n"]
    some, weight = np.maximum(n, 1), a["n"] * b["n"] / np.maximum(n, 1)
    dx, dy = np.where(weight > 0, b["mx"] - a["mx"], 0.0), np.where(weight > 0, b["my"] - a["my"], 0.0)
    mean = lambda p: (a[p] * a["n"] + b[p] * b["n"]) / some
    return {"n": n, "mx": mean("mx"), "my": mean("my"), "sxx": a["sxx"] + b["sxx"] + dx * dx * weight,
            "syy": a["syy"] + b["syy"] + dy * dy * weight, "sxy": a["sxy"] + b["sxy"] + dx * dy * weight}


def comoments(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the matrices in ``PARTS`` (row by row); no row for an empty table.

    Nulls and NaN are no values.  Columns are taken as doubles.
    """
    k = len(cols)

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
                total = of_batch(x) if total is None else merged(total, of_batch(x))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total[p].ravel()], pa.list_(pa.float64())) for p in PARTS], names=list(PARTS))

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [{p: np.asarray(r[p]).reshape(k, k) for p in PARTS} for r in pdf.sort_values("n", key=lambda s: s.map(lambda v: tuple(v))).to_dict("records")]
        total = rows[0]
        for r in rows[1:]:
            total = merged(total, r)
        return pd.DataFrame({p: [total[p].ravel()] for p in PARTS})

    tasks = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(run, ROW)
    parts = tasks.groupBy(F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("part")).applyInPandas(together, ROW)
    return parts.groupBy(F.lit(0).alias("all")).applyInPandas(together, ROW)


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """``row``, ``col``, ``n`` and ``corr`` of every ordered pair of columns; null where a column does not vary over the
    pair's rows, or there are none."""
    k = len(cols)
    names = F.array(*[F.lit(c) for c in cols])
    cell = F.posexplode(F.arrays_zip("n", "sxx", "syy", "sxy")).alias("at", "m")
    rows = comoments(df, cols).select(cell).select(
        F.element_at(names, (F.floor(F.col("at") / k) + 1).cast("int")).alias("row"), F.element_at(names, (F.col("at") % k + 1).cast("int")).alias("col"), "m.*")
    spread = F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy"))
    # a constant column's squared deviations are nought but for rounding
    varies = (F.col("n") > 0) & (spread > 0)
    return rows.select("row", "col", F.col("n").cast("long").alias("n"), (F.col("sxy") / F.when(varies, spread)).alias("corr"))
