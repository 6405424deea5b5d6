"""Join operators.

No join carries a broadcast hint: a hint would override Spark's own check of the side's size in
bytes.  Spark broadcasts a side whose files (or, with AQE, whose finished shuffle stage) are
under its threshold, and sorts or hashes both sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.session import shared_path

def join_derived_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a small table derived inside the same plan (offsets, per-series summaries).

    No hint and no extra job: with AQE on, the small side is a finished shuffle stage when
    the join is planned, and AQE converts the join to a broadcast only if the materialised
    size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
    shuffle join.  Counting first would re-run the whole upstream lineage.
    """
    return big.join(small, on, how)


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left", derived: bool = True) -> DataFrame:
    """Join a fact table to a dimension.

    A ``derived`` dimension (an aggregation, e.g. stations summarised from the facts) is first
    written to the shared folder, so Spark knows its size in bytes when it plans the join and
    nothing is computed twice.
    """
    if derived:
        path = shared_path(dim.sparkSession, "dimension")
        dim.write.parquet(path)
        dim = dim.sparkSession.read.schema(dim.schema).parquet(path)
    return fact.join(dim, on, how)


def expected_minus_present(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """C5 / G: expected values that never occur (anti join; NULLs never match)."""
    return expected.join(present.select(key).distinct(), key, "left_anti")


def time_spine(start: Column, end: Column, step: str) -> Column:
    """``sequence(start, end, INTERVAL step)`` exploded later; both ends included."""
    return F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}")))


def spine_product(dim: DataFrame, start: Column, end: Column, step: str, out: str = "slot",
                  partitions: int | None = None, by: list[str] | None = None) -> DataFrame:
    """Every dimension row times every time slot ``start .. end`` (both ends included).

    No join: each dimension row generates its own slots (``explode(sequence(...))``, a
    Generate inside the stage), so nothing pairs rows and no side is broadcast.  The
    dimension is hash-spread over ``partitions`` tasks first (by all its columns, or by those named): it is usually the small output
    of a distinct/aggregate that AQE coalesces into very few partitions, and the generated
    product is what is large.  ``start``/``end`` may be scalar subqueries or columns of ``dim``.
    """
    spark = dim.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = dim.repartition(n, *[F.col(c) for c in by or dim.columns])
    return spread.select("*", time_spine(start, end, step).alias(out))


def pair_next_after(left: DataFrame, forecasts: DataFrame, keys: list[str], asof: Column,
                    t_col: str, value: str, out: str) -> DataFrame:
    """C4: store beside each series' row the first forecast value strictly after ``asof``.

    A grouped ``min_by`` (partial aggregation, one row per series) followed by an equi join
    on the series key: no pairs are enumerated.
    """
    nxt = (forecasts.where(F.col(t_col) > asof)
           .groupBy(*keys).agg(F.min_by(value, t_col).alias(out)))
    return left.join(nxt, keys, "left")
