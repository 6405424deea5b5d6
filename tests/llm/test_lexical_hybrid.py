"""Hybrid ranked search against a plain scorer over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from airshed.llm import lexical_hybrid as X
from airshed.llm.lexical_hybrid import Best, Lists, search, search_block, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """Sorted rows (item_id, rank, doc_id, score)."""
    tfs = [(d, Counter(plain_terms(t))) for d, t in docs]
    tfs = [(d, c) for d, c in tfs if c]
    n_all, l_all = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in tfs:
            m = 100 - 25 + 25 * sum(c.values()) * n_all // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in plain_terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(n, seed):
    """Words of very uneven frequency, copies, ties."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Éa", "中文", "B2"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(60)]
    rng.shuffle(docs)
    items = [(i, ", ".join(rng.choices(words, k=6) + rng.choices(words, weights, k=6))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("text", ["a b", "A-b_c0:É éÉ\x00x\x7fy", "中文，x", "", None, "a b", "0@9`z{Z[", "\U0001f600ok"])
def test_terms_are_the_pattern_s_matches(text):
    assert [t.decode() for t in terms_of(None if text is None else text.encode())] == plain_terms(text)


@pytest.mark.parametrize("blocks", [{}, {"block_docs": 50}, {"block_postings": 300}])
def test_equal_to_scoring_every_document(spark, blocks):
    docs, items = corpus(900, 3)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert got(search(d, spark.createDataFrame(items, "item_id long, text string"), 10, **blocks)) == brute(docs, items, 10)


def test_whole_vocabulary_and_slices_of_queries_give_the_same(spark):
    docs, items = corpus(300, 4)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(search(d, q, 7, vocabulary_terms=5, slice_queries=6)) == brute(docs, items, 7)


def block_of(docs, seen=None):
    """The lists of one block over ``docs`` with N and L of its own."""
    block = X._Block(seen)
    for d, t in docs:
        block.add(d, t.encode())
    return Lists(block.row().to_pylist()[0], set(block.numbers), block.n_docs, block.n_terms)


def test_windows_that_cannot_reach_the_threshold_are_skipped():
    rng = random.Random(1)
    docs = [(i, " ".join(["common"] * rng.randint(1, 3) + rng.choices(["x", "y", "z"], k=30))) for i in range(20000)]
    for i in range(1000, 1030):  # the best documents, by a rare term, lie in a few windows
        docs[i] = (i, "common rare " + docs[i][1])
    lists, best = block_of(docs), Best(20)
    assert lists.is_short(b"rare") and not lists.is_short(b"common")
    scored = search_block(lists, {b"rare": 6000, b"common": 10}, best)
    assert scored < len(docs) / 4
    assert len(best.keys) == 20 and all(1000 <= k < 1030 for k in best.keys)


def test_ties_at_the_threshold_go_to_smaller_keys_in_later_blocks():
    best = Best(3)
    for part in ([9, 8, 7, 6], [5, 4, 3], [2]):
        search_block(block_of([(k, "one two") for k in part] + [(100 + k, "two") for k in part]), {b"one": 5}, best)
    assert len(set(best.scores)) == 1 or list(best.scores) == sorted(best.scores, reverse=True)
    equal = Best(2)
    for part in ([9, 8], [3, 1], [2]):
        lists = block_of([(k, "t") for k in part])
        lists.gain = {t: np.ones_like(g) for t, g in lists.gain.items()}
        search_block(lists, {b"t": 1}, equal)
    assert list(equal.keys) == [1, 2]


def test_odd_rows_clashing_columns_and_repeats(spark, odd):
    rows = [tuple(r) for r in odd.collect()]
    items = [(1, "two WORDS in a text"), (2, None), (3, ""), (4, "nowhere"), (None, "café 中文"), (5, "one"), (5, "one")]
    d = spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], "doc_id long, text string, item_id int, score int, no int, rank int")
    q = spark.createDataFrame([(*r, 0, 0, 0) for r in items], "item_id long, text string, doc_id int, key int, query_key int")
    assert got(search(d, q, 4)) == brute(rows, items, 4)


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    assert got(search(empty, some, 5)) == [] and got(search(docs, none, 5)) == [] and got(search(empty, none, 5)) == []
    assert search(empty, some, 5).dtypes == search(docs, some, 5).dtypes


def test_given_documents(spark, documents):
    import duckdb
    from conftest import SF0001
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF0001}/benchmark.parquet')").fetchall()
    d = spark.createDataFrame(documents, "doc_id long, text string")
    assert got(search(d, spark.createDataFrame(items, "item_id long, text string"), 20, block_docs=64)) == brute(documents, items, 20)
