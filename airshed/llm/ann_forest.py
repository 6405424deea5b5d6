"""Approximate nearest neighbours with a hash-prefix forest.

Each tree maps a vector to a long hash string (one bit per random hyperplane, cut at the median
of a bounded sample) and keeps the strings sorted.  A query descends in every tree to its longest
matching prefix and then ascends in all trees at once, one bit at a time, until the prefixes of the
current length have ``m`` entries together; these entries are scored exactly.

On the cluster a tree's sorted array is cut into blocks by the leading ``p`` bits (about
``BLOCK_ENTRIES`` each; a block that is much larger is split into salted parts, each asked in turn,
and the queries of a block that very many visit into salted slices, so both sides of a task are bounded).
One pass over the strings counts the entries under each prefix of each query, which fixes the
query's final prefix length; a second pass brings the vectors, and a query is sent to the blocks
its final prefix covers (several, if it is shorter than ``p``).  Each block returns its best few.

Equal vectors are one entry: an entry keeps its ``k + 1`` smallest ids, all that a list of ``k``
can show.  Both cuts of a list (in a block, then per query) go by the score summed in order of the
components and, among equal scores, by the entry's smallest id, so a list of ``k + 1`` entries holds
every id that the result can show, however many entries tie.  Largest inner product is reduced to the smallest angle by one more component
(sqrt(R^2 - |x|^2), zero for queries).

``m`` is tuned on a bounded set of queries (``CALIBRATION_QUERIES``), compared with every entry: the
smallest power-of-two ladder step whose recall reaches ``recall``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import prepare, written

#: Documented bounds: vectors the cuts are fitted on, and queries ``m`` is tuned on.
SAMPLE_VECTORS = 4096
CALIBRATION_QUERIES = 64
BLOCK_ENTRIES = 4096


@dataclass
class Forest:
    """Hyperplanes (trees x bits x dimension + 1), their cuts, and the largest norm."""

    planes: np.ndarray
    cuts: np.ndarray
    radius: float

    @property
    def bits(self) -> int:
        return self.planes.shape[1]

    def strings(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Hash strings (rows x trees) as integers of ``bits`` bits."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            x = np.hstack([x / np.maximum(norm, 1e-300), np.zeros_like(norm)])
        else:
            x = np.hstack([x / self.radius, np.sqrt(np.maximum(0.0, 1 - (norm / self.radius) ** 2))])
        trees, bits, width = self.planes.shape
        on = (x @ self.planes.reshape(-1, width).T).reshape(-1, trees, bits) > self.cuts
        return on @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def plant(sample: np.ndarray, radius: float, trees: int, bits: int, seed: int) -> Forest:
    """A forest whose cuts are the sample's medians."""
    planes = np.random.default_rng(seed).standard_normal((trees, bits, sample.shape[1] + 1))
    forest = Forest(planes, np.zeros((trees, bits)), radius)
    norm = np.linalg.norm(sample, axis=1, keepdims=True)
    x = np.hstack([sample / radius, np.sqrt(np.maximum(0.0, 1 - (norm / radius) ** 2))])
    forest.cuts = np.median(x @ planes.reshape(trees * bits, -1).T, axis=0).reshape(trees, bits)
    return forest


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``vec`` of the rows that take part: id and vector not null, all components finite,
    not all zero, and of the most frequent dimension (ties: the smaller)."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(finite & F.exists("vec", lambda x: x != 0))
    top = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (top["d"] if top else 0))


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: two hash keys, ``vec`` and its ``k + 1`` smallest ids.

    The ids of a vector are cut down in salted parts first, so a vector that very many rows share is
    never in one task.
    """
    best = lambda df, *key: df.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy("id"))).where(F.col("rn") <= k + 1).drop("rn")
    keyed = rows.withColumn("k1", F.xxhash64("vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec")).dropDuplicates(["k1", "k2", "id"])
    few = best(keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))), "k1", "k2", "salt")
    return best(few, "k1", "k2").groupBy("k1", "k2").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))


def _matrix(col) -> np.ndarray:
    """A list column as a matrix of doubles."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def common_prefix(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Length of the common prefix of strings of ``bits`` bits."""
    x = a ^ b
    return bits - np.where(x > 0, np.frexp(x.astype(np.float64))[1], 0)  # exact below 2^53


def calibrate(entries: DataFrame, forest: Forest, n: int, k: int, recall: float) -> int:
    """The smallest ``m`` on a ladder of factor sqrt(2) with the wanted mean recall of the ``k`` nearest entries.

    A few queries meet every entry, in blocks; each task keeps their best ``k`` and the number of
    entries under each prefix length.
    """
    probe = entries.where("is_query").orderBy(F.xxhash64("k1"), "k2").limit(CALIBRATION_QUERIES).select("k1", "k2", "vec").toPandas()
    if not len(probe):
        return k
    keys = probe[["k1", "k2"]].to_numpy(np.int64)
    q = np.stack(probe["vec"].to_numpy()).astype(np.float64)
    hq, bits = forest.strings(q, True), forest.bits

    def run(batches):
        counts = np.zeros((len(q), bits + 1), np.int64)
        top = [np.empty((0, 2)) for _ in q]
        for b in batches:
            x = _matrix(b.column(2))
            scores = q @ x.T
            hp = forest.strings(x, False)
            own = (keys[:, :1] == b.column(0).to_numpy()) & (keys[:, 1:] == b.column(1).to_numpy())
            for i in range(len(q)):
                common = common_prefix(hq[i], hp, bits)
                counts[i] += np.bincount(common.ravel(), minlength=bits + 1)
                s = np.where(own[i], -np.inf, scores[i])
                best = np.argsort(-s, kind="stable")[:k]
                both = np.vstack([top[i], np.stack([s[best], common.max(axis=1)[best]], axis=1)])
                top[i] = both[np.argsort(-both[:, 0], kind="stable")[:k]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(q)), pa.int32()), pa.array(counts.tolist(), pa.list_(pa.int64())),
             pa.array([t.ravel().tolist() for t in top], pa.list_(pa.float64()))], names=["q", "counts", "best"])

    # a row per task and calibration query: merged here, k pairs and a few dozen counts each
    got = written(entries.select("k1", "k2", "vec").mapInArrow(run, "q int, counts array<long>, best array<double>"), "ann-calibration")
    counts = np.zeros((len(q), bits + 1), np.int64)
    for r in got.select("q", F.posexplode("counts").alias("d", "c")).groupBy("q", "d").agg(F.sum("c").alias("c")).collect():
        counts[r["q"], r["d"]] = r["c"]
    under = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # entries with a common prefix of d bits or more
    pairs = got.where("size(best) > 0").select(
        "q", F.explode(F.expr("transform(sequence(0, int(size(best) / 2) - 1), i -> struct(best[2 * i] as s, best[2 * i + 1] as d))")).alias("x"))
    near = (pairs.select("q", "x.s", "x.d").withColumn("rn", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "d")))
            .where(F.col("rn") <= k).where("s > -1e300").collect())
    m = float(k)
    while m < forest.planes.shape[0] * n:
        stop = np.array([np.flatnonzero(u >= m).max(initial=0) for u in under])
        if not near or np.mean([r["d"] >= stop[r["q"]] for r in near]) >= recall:
            break
        m *= 2 ** 0.5
    return int(np.ceil(m))


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, trees: int = 16, bits: int = 32,
            recall: float = 0.95, m: int | None = None, seed: int = 7, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """For each row whose id satisfies ``is_query`` (a condition on the column ``id``, as text or Column) its ``k``
    nearest other rows found: ``query_id``, ``rank``, ``vec_id``, ``score`` (inner product in double precision).

    Rows with a null id take no part (see ``valid_vectors`` for the vectors); rows equal in id and
    vector count once.  With fewer than ``k`` other rows all of them are returned.
    """
    spark = prepare(df.sparkSession)
    if not 1 <= bits <= 52:
        raise ValueError("bits must be between 1 and 52")
    rows = valid_vectors(df, id_col, vec_col)
    rows = rows.withColumn("k1", F.xxhash64("vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec"))
    queries = written(rows.where(is_query).select("id", "k1", "k2").distinct(), "ann-queries")
    asked = queries.select(F.col("k1").alias("a1"), F.col("k2").alias("a2")).distinct()
    entries = entries_of(rows.select("id", "vec"), k)
    entries = written(entries.join(asked, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")), "left")
                      .withColumn("is_query", F.col("a1").isNotNull()).drop("a1", "a2"), "ann-entries")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, radius = entries.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.stack(entries.orderBy(F.xxhash64("k2"), "k1").limit(SAMPLE_VECTORS).select("vec").toPandas()["vec"].to_numpy()).astype(np.float64)
    forest = plant(sample, radius, trees, bits, seed)
    m = calibrate(entries, forest, n, k, recall) if m is None else m
    depth = min(bits, max(0, (n - 1) // block_entries).bit_length())

    def strings(query: bool):
        def run(batches):
            for b in batches:
                h = forest.strings(_matrix(b.column(2)), query)
                rep = np.repeat(np.arange(len(h)), trees)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rep)), b.column(1).take(pa.array(rep)), pa.array(np.tile(np.arange(trees, dtype=np.int32), len(h))),
                     pa.array(h.ravel())], names=["k1", "k2", "tree", "h"])
        return run

    light = entries.select("k1", "k2", "vec")
    block = F.shiftright("h", bits - depth).alias("block")
    kind = "k1 long, k2 long, tree int, h long"
    points = written(light.mapInArrow(strings(False), kind).select("*", block), "ann-points")
    asks = written(entries.where("is_query").select("k1", "k2", "vec").mapInArrow(strings(True), kind).select("*", block), "ann-asks")

    # blocks far over the usual size are split into salted parts; their queries, if there are many, into salted slices
    sizes = written(points.groupBy("tree", "block").count(), "ann-blocks")

    def large(counts: DataFrame) -> DataFrame | None:
        found = counts.where(F.col("count") > 4 * block_entries).select(
            F.col("tree").alias("t"), F.col("block").alias("b"), F.ceil(F.col("count") / block_entries).cast("int").alias("splits"))
        return None if found.isEmpty() else found

    def salted(frame: DataFrame, split: DataFrame | None, name: str, copies: bool) -> DataFrame:
        if split is None:
            return frame.withColumn(name, F.lit(0))
        frame = frame.join(split, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("b")), "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
        salt = F.explode(F.sequence(F.lit(0), F.col("splits") - 1)) if copies else F.pmod(F.xxhash64("k1", "k2"), F.col("splits")).cast("int")
        return frame.withColumn(name, salt).drop("t", "b", "splits")

    parts = large(sizes)
    points = salted(points, parts, "part", False)

    # first pass: entries under each prefix of depth..bits bits of each query, in its own block of each tree
    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        h, q = np.sort(left["h"].to_numpy(np.int64)), right["h"].to_numpy(np.int64)
        under = np.empty((len(q), bits - depth + 1), np.int64)
        for d in range(depth, bits + 1):
            low = (q >> (bits - d)) << (bits - d)
            under[:, d - depth] = np.searchsorted(h, low + (1 << (bits - d))) - np.searchsorted(h, low)
        return pd.DataFrame({"k1": right["k1"].to_numpy(), "k2": right["k2"].to_numpy(), "under": pd.Series(list(under), dtype=object)})

    at = ["tree", "block", "part", "slice"]
    slices = large(written(asks.groupBy("tree", "block").count(), "ann-ask-blocks"))
    counts = (salted(points, slices, "slice", True).select(*at, "h").groupBy(*at)
              .cogroup(salted(salted(asks, slices, "slice", False), parts, "part", True).select(*at, "h", "k1", "k2").groupBy(*at))
              .applyInPandas(count, "k1 long, k2 long, under array<long>"))
    sums = counts.groupBy("k1", "k2").agg(F.array(*[F.sum(F.col("under")[i]) for i in range(bits - depth + 1)]).alias("under"))
    # final prefix length: the longest with m entries; -1: the blocks together have fewer
    stop = written(sums.select("k1", "k2", F.expr(f"aggregate(sequence(0, {bits - depth}), -1, (a, i) -> if(under[i] >= {m}, i, a))").alias("i")), "ann-stops")
    short = asks.join(stop.where("i < 0").select(F.col("k1").alias("s1"), F.col("k2").alias("s2")), (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left_semi")
    if depth:
        level = F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("d")
        above = (sizes.select("tree", "block", "count", level).groupBy("tree", "d", F.expr(f"shiftright(block, {depth} - d)").alias("prefix")).agg(F.sum("count").alias("c")))
        over = (short.select("k1", "k2", "tree", "block", level).withColumn("prefix", F.expr(f"shiftright(block, {depth} - d)"))
                .join(above, ["tree", "d", "prefix"]).groupBy("k1", "k2", "d").agg(F.sum("c").alias("c")).where(F.col("c") >= m)
                .groupBy("k1", "k2").agg(F.max("d").alias("up")))
        stop = stop.join(over, ["k1", "k2"], "left").select("k1", "k2", F.when(F.col("i") >= 0, F.col("i") + depth).otherwise(F.coalesce("up", F.lit(0))).alias("stop"))
    else:
        stop = stop.select("k1", "k2", F.greatest("i", F.lit(0)).alias("stop"))
    stop = written(stop, "ann-lengths")

    # second pass: with vectors, each query to all blocks its final prefix covers
    go = asks.join(stop, ["k1", "k2"])
    wide = F.expr(f"if(stop >= {depth}, array(block), sequence(shiftleft(shiftright(block, {depth} - stop), {depth} - stop), "
                  f"shiftleft(shiftright(block, {depth} - stop) + 1, {depth} - stop) - 1))")
    go = go.select("k1", "k2", "tree", "h", "stop", F.explode(wide).alias("block"))
    visits = large(written(go.groupBy("tree", "block").count(), "ann-visits"))
    go = salted(salted(go, visits, "slice", False), parts, "part", True)

    def with_vec(frame: DataFrame, name: str, *more) -> DataFrame:
        vectors = entries.select(F.col("k1").alias("v1"), F.col("k2").alias("v2"), F.col("vec").alias(name), *more)
        return frame.join(vectors, (F.col("k1") == F.col("v1")) & (F.col("k2") == F.col("v2"))).drop("v1", "v2")

    keep = k + 1

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows, place, scores = [], [], []
        if len(left) and len(right):
            left = left.sort_values("h", kind="stable")
            h, p1, p2, least = (left[c].to_numpy(np.int64) for c in ("h", "k1", "k2", "least"))
            x = np.stack(left["pv"].to_numpy()).astype(np.float64)
            # four times the rounding of a sum of products: what two ways of summing can differ by, at the edge and at a candidate
            rounding = 4 * x.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(x, axis=1).max()
            s = right["stop"].to_numpy(np.int64)
            low = np.where(s > depth, (right["h"].to_numpy(np.int64) >> (bits - s)) << (bits - s), 0)
            begin = np.where(s > depth, np.searchsorted(h, low), 0)
            end = np.where(s > depth, np.searchsorted(h, low + (1 << (bits - s))), len(h))
            for i, (a, b, v) in enumerate(zip(begin.tolist(), end.tolist(), right["qv"])):
                if b > a:
                    v = np.asarray(v, np.float64)
                    near = np.arange(a, b)
                    if b - a > keep:
                        score = x[a:b] @ v
                        near = near[score >= np.partition(score, b - a - keep)[b - a - keep] - rounding * np.linalg.norm(v)]
                    score = np.cumsum(x[near] * v, axis=1)[:, -1] + 0.0  # in order of the components; no negative zero
                    top = np.lexsort((least[near], -score))[:keep]
                    rows.append(np.full(len(top), i))
                    place.append(near[top])
                    scores.append(score[top])
        rows, place = (np.concatenate([np.empty(0, np.int64), *c]) for c in (rows, place))
        if not len(rows):
            return pd.DataFrame({c: [] for c in ("q1", "q2", "p1", "p2", "least", "score")})
        return pd.DataFrame({"q1": right["k1"].to_numpy()[rows], "q2": right["k2"].to_numpy()[rows], "p1": p1[place], "p2": p2[place], "least": least[place],
                             "score": np.concatenate(scores)})

    found = (salted(with_vec(points.select("tree", "block", "part", "h", "k1", "k2"), "pv", F.col("ids")[0].alias("least")), visits, "slice", True).groupBy(*at)
             .cogroup(with_vec(go.select(*at, "h", "stop", "k1", "k2"), "qv").groupBy(*at))
             .applyInPandas(search, "q1 long, q2 long, p1 long, p2 long, least long, score double"))
    best = found.groupBy("q1", "q2", "p1", "p2").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    per_query = Window.partitionBy("q1", "q2")
    best = best.withColumn("rn", F.row_number().over(per_query.orderBy(F.desc("score"), "least"))).where(F.col("rn") <= keep).drop("rn")
    # ids for entries
    ids = entries.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), "ids")
    hits = best.drop("least").join(ids, ["p1", "p2"]).select("q1", "q2", "score", F.explode("ids").alias("vec_id"))
    order = [F.desc("score"), F.col("vec_id")]
    hits = hits.withColumn("rn", F.row_number().over(per_query.orderBy(*order))).where(F.col("rn") <= k + 1).drop("rn")
    hits = hits.join(queries.select(F.col("id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2")), ["q1", "q2"]).where("vec_id <> query_id")
    return (hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
