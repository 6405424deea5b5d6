"""Connected components by alternating large-star and small-star rounds.

Each round is two passes of: smallest neighbour per node (a partial aggregation), joined back to
the edges (an equi-join that Spark splits where a node has very many neighbours), distinct.  No
neighbour list, link or label is ever collected.  Rounds are written to the shared folder, so a
lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import written


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star pass over undirected edges given as (u, v)."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else \
        pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` but the roots themselves; a component's
    root is its smallest node.  Self-loops and null ends are ignored, order and repeats don't matter.

    Raises if the rounds do not settle (they do after about the logarithm of the longest path).
    """
    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = mark(now)
    for _ in range(max_rounds):
        if not was[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = written(_star(_star(now, True), False), "cc-round")
        is_ = mark(now)
        if is_ == was:  # a round that changes nothing: every edge is a (node, root) pair
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        was = is_
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
