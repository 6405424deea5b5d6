import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
from airshed.llm import simhash_gray as sg
from airshed.llm.components import components

from conftest import SF0001

from .conftest import ODD


def slow_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=2):
    """(id, fingerprint, component) by comparing all pairs of fingerprints."""
    codes = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1:]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            comp[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, f"{c:016x}", least.get(find(i))) for i, ((k, _), c) in enumerate(zip(rows, codes.tolist()))), key=str)


def test_query_against_all_pairs(spark, documents):
    rows = [tuple(r) for r in E.queries()["op3_simhash_gray"](spark, SF0001).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(rows, key=str) == brute(documents)


def test_odd_rows(spark, odd, empty):
    from pyspark.sql import functions as F
    df = odd.withColumn("fingerprint_", F.lit("x")).withColumn("code", F.lit(1)).withColumn("_least", F.lit(2))
    rows = [tuple(r) for r in sg.near_duplicates(df).collect()]
    assert sorted(rows, key=str) == brute(ODD)
    assert sg.near_duplicates(empty).count() == 0


def test_gray_rank_is_the_inverse_of_the_gray_code():
    n = np.arange(5000, dtype=np.uint64)
    assert (sg.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def pairs(parts):
    return sorted(p for q, e in parts for p in zip(q.tolist(), e.tolist()))


@pytest.mark.parametrize("frontier", [40, 1 << 20])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_index_finds_all_pairs_and_only_them(bits, frontier, monkeypatch):
    monkeypatch.setattr(sg, "FRONTIER", frontier)
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2**64, 150, dtype=np.uint64)
    codes = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) for _ in range(5)]))
    index = sg.GrayIndex(codes)
    near = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :]) <= bits
    assert pairs(index.search(index.codes, bits, np.arange(len(codes)))) == [(i, j) for i, j in zip(*np.nonzero(near)) if i < j]
    assert pairs(index.search(index.codes[:40], bits)) == [(i, j) for i, j in zip(*np.nonzero(near)) if i < 40]


@pytest.mark.parametrize("region", [1, 7, 60, 10000])
def test_regions_lose_no_link(spark, region):
    """Chains of codes one or two bits apart, cut across regions of any size."""
    rng = np.random.default_rng(11)
    codes = set()
    for _ in range(12):
        c = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(25):
            codes.add(c)
            for b in rng.choice(64, rng.integers(1, 3), replace=False):
                c ^= 1 << int(b)
    codes = np.array(sorted(codes), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "code long")
    tree = components(sg.link_entries(df, "code", 2, region_entries=region), "a", "b").collect()
    root = {r["node"]: r["root"] for r in tree}
    got = {}
    for c in codes.view(np.int64).tolist():
        got.setdefault(root.get(c, c), set()).add(c)
    comp = {c: {c} for c in codes.view(np.int64).tolist()}
    signed = codes.view(np.int64).tolist()
    for i, j in zip(*np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2)):
        a, b = comp[signed[i]], comp[signed[j]]
        if a is not b:
            a |= b
            for x in b:
                comp[x] = a
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in comp.values()}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 400)}
