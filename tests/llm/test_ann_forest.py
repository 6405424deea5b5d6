import numpy as np
import pytest


import __spark_entry__ as E
from airshed.llm import ann_forest as af

from conftest import SF0001

QUERY = "id % 20 = 0"


def brute(rows, k, is_query=lambda i: i % 20 == 0):
    """{query: [(score, vec_id)]} over the valid rows, nearest first, ties to the smaller id."""
    ok = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    sizes = sorted({len(v) for _, v in ok}, key=lambda d: (-sum(len(v) == d for _, v in ok), d))
    ok = [(i, v) for i, v in ok if len(v) == sizes[0]] if sizes else []
    seen = {(i, v.tobytes()): (i, v) for i, v in ok}
    ok = list(seen.values())
    return {i: sorted(((sum((v * w).tolist()), j) for j, w in ok if j != i), key=lambda x: (-x[0], x[1]))[:k] for i, v in ok if is_query(i)}


def lists(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert len(got[r["query_id"]]) == r["rank"]
    return got


def test_query_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    want, got = brute(rows, 20), lists(E.queries()["op1_prefix_forest"](spark, SF0001))
    assert set(got) == set(want)
    vec = {i: np.asarray(v, float) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 20 and q not in {j for _, j in found}
        assert found == sorted(found, key=lambda x: (-x[0], x[1]))
        assert all(abs(s - vec[q] @ vec[j]) < 1e-12 for s, j in found)
    assert np.mean([len({j for _, j in got[q]} & {j for _, j in want[q]}) / 20 for q in want]) >= 0.9


def test_odd_rows_ties_and_copies_are_exact_when_everything_is_near(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(30)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]       # one vector on many rows, queries among them
    rows += [(100, [1.0, 2.0, 3.0, 4.0]), (40, rows[0][1]), (None, [1.0] * 4), (200, None), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]),
             (260, [float("nan"), 1.0, 1.0, 1.0]), (280, [float("inf"), 0.0, 0.0, 1.0]), (300, [1.0, 1.0]), (320, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, vec int")
    got, want = lists(af.nearest(df, QUERY, k=25, m=10**6)), brute(rows, 25)
    assert {q: [j for _, j in v] for q, v in got.items()} == {q: [j for _, j in v] for q, v in want.items()}
    assert all(abs(a - b) < 1e-12 for q in want for (a, _), (b, _) in zip(got[q], want[q]))


@pytest.mark.parametrize("block_entries", [4096, 32])
def test_ties_of_many_distinct_vectors_go_to_the_smaller_ids(spark, block_entries):
    rng = np.random.default_rng(4)
    codes = rng.permutation(1 << 10)[:500]
    rows = [(int(i), (2.0 * ((c >> np.arange(10)) & 1) - 1).tolist()) for i, c in zip(rng.permutation(2000), codes)]
    rows += [(3000 + i, rows[7 * i][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = lists(af.nearest(df, QUERY, k=20, m=10**6, block_entries=block_entries)), brute(rows, 20)
    assert got == want and all(len(v) == 20 for v in got.values())


def test_scores_that_differ_by_rounding_keep_their_order(spark):
    # permutations of one vector against all ones: equal sums but for the rounding of each order
    rng = np.random.default_rng(5)
    base = rng.standard_normal(24)
    rows = [(0, [1.0] * 24)] + [(20 * i + 1, rng.permutation(base).tolist()) for i in rng.permutation(400).tolist()]
    want = sorted(((float(np.cumsum(v)[-1]), i) for i, v in rows[1:]), key=lambda x: (-x[0], x[1]))
    assert len({s for s, _ in want}) > 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(af.nearest(df, "id = 0", k=10, m=10**6))[0]
    assert got == want[:10]


def test_few_rows_empty_table_and_blocks(spark):
    schema = "vec_id long, embedding array<float>"
    assert af.nearest(spark.createDataFrame([], schema), QUERY).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)
    assert lists(af.nearest(few, QUERY)) == {0: [(0.5, 1), (0.5, 2)]}
    # blocks smaller than what a query needs: prefixes shorter than a block's, and large blocks in parts
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(8) + (i % 3 == 0) * 6).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = lists(af.nearest(df, QUERY, k=5, trees=6, m=1500, block_entries=8)), brute(rows, 5)
    assert set(got) == set(want)
    assert np.mean([len({j for _, j in got[q]} & {j for _, j in want[q]}) / 5 for q in want]) >= 0.9


def test_both_sides_of_a_task_are_bounded(spark, tmp_path, monkeypatch):
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps
    apply, folder = PandasCogroupedOps.applyInPandas, str(tmp_path)

    def noting(self, func, schema):
        def noted(left, right):
            import uuid
            with open(f"{folder}/{uuid.uuid4()}", "w") as f:
                f.write(f"{len(left)} {len(right)}")
            return func(left, right)
        return apply(self, noted, schema)

    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", noting)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(8) + (i % 3 == 0) * 6).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # every vector asks, and visits every block
    got, want = lists(af.nearest(df, "true", k=5, trees=2, m=1500, block_entries=32)), brute(rows, 5, lambda i: True)
    assert {q: [j for _, j in v] for q, v in got.items()} == {q: [j for _, j in v] for q, v in want.items()}
    noted = [tuple(map(int, f.read_text().split())) for f in tmp_path.iterdir()]
    assert noted and max(a for a, _ in noted) <= 4 * 32 and max(b for _, b in noted) <= 4 * 32


def test_prefix_lengths():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 20, 500), rng.integers(0, 1 << 20, 500)
    a[:50] = b[:50]
    want = [next((k for k in range(20) if (x >> (19 - k)) & 1 != (y >> (19 - k)) & 1), 20) for x, y in zip(a.tolist(), b.tolist())]
    assert af.common_prefix(a, b, 20).tolist() == want


def test_bits_are_checked(spark):
    with pytest.raises(ValueError):
        af.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), QUERY, bits=60)
