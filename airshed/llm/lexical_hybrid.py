"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Index.  ``build_index`` cuts the documents, where they lie, into blocks of at most ``BLOCK_DOCS`` documents and about
``BLOCK_POSTINGS`` postings; a row of the index is one block with the postings lists of its terms.  Nothing is shuffled.
If the queries' vocabulary is small enough to be sent to the tasks (``VOCABULARY_TERMS``), only its terms are indexed,
else all are; documents and terms are counted over everything either way.

Search.  A task goes through its blocks and keeps the ``k`` best documents of each query so far.  In a block, a
query's short lists (less than one posting a window of ``WINDOW`` documents) are summed term at a time into
accumulators, in document order.  These then act as one iterator with a bound, beside the long lists with theirs:
windows are visited in document order, and skipped if the accumulators' largest sum there plus the long lists' largest
contributions cannot reach the query's ``k``-th best score.  In the windows that are visited the lists are added from the
highest bound to the lowest, and documents drop out as soon as what is left cannot lift them there.  The threshold
rises as documents are found and is kept from block to block; a document that ties with it is always scored.
Each task gives at most ``k`` rows a query, which are ranked in two steps.

Queries are searched in slices of about ``SLICE_QUERIES`` queries and ``SLICE_BYTES`` bytes, one pass over the index each,
so what is sent to a task does not grow with the number of queries.

Scores are 64-bit integers; see ``search``.  Defined results: null and empty texts have no terms, such documents and queries
give no rows; a null key sorts before all others; each row of either table counts on its own, so repeated rows
are found repeatedly, and the order among rows equal in score and key is free.  Texts are taken whole.  Empty
tables give an empty result.  Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import prepare, written

WINDOW = 64
BLOCK_DOCS = 1 << 16
BLOCK_POSTINGS = 1 << 21
VOCABULARY_TERMS = 500_000
SLICE_QUERIES = 1024
SLICE_BYTES = 8 << 20
#: Contributions of long lists kept spread out over a block's documents, in numbers (4 bytes each).
SPREAD = 1 << 24

#: Letters A-Z become lower case, digits, a-z and all bytes of other characters stay, the rest separates.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text: maximal runs of ASCII letters, digits and other characters beyond ASCII."""
    return text.translate(FOLD).split() if text else []


# ---- index --------------------------------------------------------------------------------------

BLOCK = ("n_docs long, n_terms long, keys array<long>, lengths binary, terms array<binary>, dfs array<long>, "
         "docs binary, tfs binary")


class _Numbers(dict):
    def __missing__(self, term):
        self[term] = n = len(self)
        return n


class _Block:
    """Documents gathered until a block is full."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.n_docs = self.n_terms = 0
        self.keys, self.lengths, self.own = [], array("q"), array("q")
        self.numbers, self.ids, self.tfs = _Numbers(), array("I"), array("q")

    def add(self, key, text) -> None:
        words = terms_of(text)
        if not words:
            return
        self.n_docs += 1
        self.n_terms += len(words)
        found = Counter(words if self.vocabulary is None else filter(self.vocabulary.__contains__, words))
        if found:
            self.keys.append(key)
            self.lengths.append(len(words))
            self.own.append(len(found))
            self.ids.extend(map(self.numbers.__getitem__, found))
            self.tfs.extend(found.values())

    def row(self) -> pa.RecordBatch:
        ids = np.frombuffer(self.ids, np.uint32)
        order = np.argsort(ids, kind="stable")
        docs = np.repeat(np.arange(len(self.keys), dtype=np.uint32), np.frombuffer(self.own, np.int64))[order]
        values = [self.n_docs, self.n_terms, self.keys, self.lengths.tobytes(), list(self.numbers),
                  np.bincount(ids, minlength=len(self.numbers)).tolist(), docs.tobytes(), np.frombuffer(self.tfs, np.int64)[order].tobytes()]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        names = ["n_docs", "n_terms", "keys", "lengths", "terms", "dfs", "docs", "tfs"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: frozenset | None = None,
                block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The index of ``docs`` as a written table, one row a block; ``vocabulary``: the terms to keep (all, if none)."""
    prepare(docs.sparkSession)

    def run(batches):
        block = _Block(vocabulary)
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                block.add(k, t)
                if len(block.keys) >= block_docs or len(block.ids) >= block_postings:
                    yield block.row()
                    block = _Block(vocabulary)
        if block.n_docs:
            yield block.row()

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    return written(rows.mapInArrow(run, BLOCK), "lexical-index")


# ---- search -------------------------------------------------------------------------------------

class Best:
    """The ``k`` best (score, key) of a query so far: higher scores first, then null keys, then smaller ones."""

    def __init__(self, k: int):
        self.k, self.scores, self.some, self.keys = k, *(np.empty(0, np.int64) for _ in range(3))
        self.least = 1  # a document below this score cannot come in

    def add(self, scores, some, keys) -> None:
        s, f, i = (np.concatenate(x) for x in ((self.scores, scores), (self.some, some), (self.keys, keys)))
        order = np.lexsort((i, f, -s))[:self.k]
        self.scores, self.some, self.keys = s[order], f[order], i[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


class Lists:
    """The postings of a block's terms that the queries use, as contributions (without the terms' weights)."""

    def __init__(self, row: dict, wanted, n_all: int, l_all: int):
        self.some = np.array([x is not None for x in row["keys"]], np.int64)
        self.keys = np.array([0 if x is None else x for x in row["keys"]], np.int64)
        self.n = len(self.keys)
        self.windows = -(-self.n // WINDOW)
        lengths = np.frombuffer(row["lengths"], np.int64)
        norm = 12 * (100 - 25 + 25 * lengths * n_all // l_all)
        docs, tfs = np.frombuffer(row["docs"], np.uint32), np.frombuffer(row["tfs"], np.int64)
        ends = np.cumsum(row["dfs"])
        self.docs, self.gain, self.spread, self.kept = {}, {}, {}, 0
        self.most: dict[bytes, np.ndarray] = {}
        for i, term in enumerate(row["terms"]):
            if term in wanted:
                at = slice(ends[i] - row["dfs"][i], ends[i])
                self.docs[term] = docs[at].astype(np.int64)
                self.gain[term] = 10 ** 9 * tfs[at] // (1000 * tfs[at] + norm[self.docs[term]])

    def is_short(self, term: bytes) -> bool:
        return len(self.docs[term]) < self.windows

    def bounds(self, term: bytes) -> np.ndarray:
        """The largest contribution of a term in each window."""
        if term not in self.most:
            self.most[term] = by = np.zeros(self.windows, np.int64)
            np.maximum.at(by, self.docs[term] // WINDOW, self.gain[term])
        return self.most[term]

    def over(self, term: bytes) -> np.ndarray:
        """A long list's contribution for each document of the block; some are kept for the next query."""
        if term not in self.spread:
            if self.kept + self.n > SPREAD:
                self.spread, self.kept = {}, 0
            self.spread[term] = by = np.zeros(self.windows * WINDOW, np.int32)
            by[self.docs[term]] = self.gain[term]
            self.kept += self.n
        return self.spread[term]


def accumulators(lists: Lists, short: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Short lists added up: documents in order and their sums."""
    if not short:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    docs = np.concatenate([lists.docs[t] for t, _ in short])
    gains = np.concatenate([w * lists.gain[t] for t, w in short])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return docs[first], np.add.reduceat(gains[order], first)


def search_block(lists: Lists, weights: dict[bytes, int], best: Best) -> int:
    """Take a block's documents into ``best``; returns the number of documents scored."""
    have = [(t, w) for t, w in weights.items() if t in lists.docs]
    acc_docs, acc_sums = accumulators(lists, [x for x in have if lists.is_short(x[0])])
    long = sorted(((t, w, lists.bounds(t)) for t, w in have if not lists.is_short(t)), key=lambda x: -x[1] * int(x[2].max()))
    # bounds of a window: of the accumulators, and of the long lists from each on
    bound = np.zeros(lists.windows, np.int64)
    np.maximum.at(bound, acc_docs // WINDOW, acc_sums)
    rest = [np.zeros(lists.windows, np.int64)]
    for _, w, most in reversed(long):
        rest.append(rest[-1] + w * most)
    rest.reverse()
    bound += rest[0]
    todo, stride, scored = np.flatnonzero(bound >= best.least), 4, 0
    while len(todo):
        windows, todo = todo[:stride], todo[stride:]
        stride = min(4 * stride, 1024)
        docs = (windows[:, None] * WINDOW + np.arange(WINDOW)).ravel()
        docs = docs[:np.searchsorted(docs, lists.n)]
        score = np.zeros(len(docs), np.int64)
        lo, hi = np.searchsorted(acc_docs, (docs[0], docs[-1] + 1))
        at = np.searchsorted(docs, acc_docs[lo:hi])
        inside = docs[at] == acc_docs[lo:hi]
        score[at[inside]] = acc_sums[lo:hi][inside]
        scored += len(docs)
        for (term, w, _), left in zip(long, rest):
            can = score + left[docs // WINDOW] >= best.least
            if not can.all():
                docs, score = docs[can], score[can]
            score = score + w * lists.over(term)[docs].astype(np.int64)
        good = score >= best.least
        if good.any():
            docs = docs[good]
            best.add(score[good], lists.some[docs], lists.keys[docs])
            todo = todo[bound[todo] >= best.least]
    return scored


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _found(queries: list[tuple[int, dict[bytes, int]]], n_all: int, l_all: int, k: int):
    wanted = {t for _, terms in queries for t in terms}

    def run(batches):
        best = {no: Best(k) for no, _ in queries}
        for b in batches:
            for row in b.to_pylist():
                lists = Lists(row, wanted, n_all, l_all)
                for no, weights in queries:
                    search_block(lists, weights, best[no])
        for no, x in best.items():
            if len(x.scores):
                keys = [int(i) if f else None for i, f in zip(x.keys, x.some)]
                yield pa.RecordBatch.from_arrays([pa.array([no] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(x.scores)],
                                                 names=["no", "key", "score"])
    return run


def _terms(batches):
    """(no, text) -> (no, term, times)."""
    for b in batches:
        for no, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            got = Counter(terms_of(text))
            yield pa.RecordBatch.from_arrays([pa.array([no] * len(got), pa.int64()), pa.array(list(got), pa.binary()), pa.array(list(got.values()), pa.int64())],
                                             names=["no", "term", "times"])


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("key"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int, key: str = "doc_id", text: str = "text", query_key: str = "item_id",
           query_text: str = "text", vocabulary_terms: int = VOCABULARY_TERMS, slice_queries: int = SLICE_QUERIES, **blocks) -> DataFrame:
    """The ``k`` best documents of each query: query_key, rank (from 1), key, score (above 0).

    With ``N`` documents that have a term, ``L`` terms in all of them, ``n`` in one document, ``df`` documents that hold a term
    and ``tf`` occurrences of it, a term weighs ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``, a document's norm is
    ``m = 75 + (25nN div L)`` and its score the sum of ``w * (10^9 tf div (1000 tf + 12m))`` over the query's terms, repeats
    included.  Equal scores are ordered by key.
    """
    spark = prepare(docs.sparkSession)
    asked = written(queries.select(F.monotonically_increasing_id().alias("no"), F.col(f"`{query_key}`").alias("query_key"),
                                   F.col(f"`{query_text}`").cast("string").cast("binary").alias("text")), "lexical-queries")
    terms = written(asked.select("no", "text").mapInArrow(_terms, "no long, term binary, times long"), "lexical-terms")
    distinct = terms.select("term").distinct()
    vocabulary = None
    if distinct.limit(vocabulary_terms + 1).count() <= vocabulary_terms:
        vocabulary = frozenset(bytes(r.term) for r in distinct.collect())  # bounded by vocabulary_terms
    index = build_index(docs, key, text, vocabulary, **blocks)
    n_all, l_all = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    dfs = (index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select("x.terms", "x.dfs")
           .groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df")))
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    slices = max(1, -(-count // slice_queries), -(-size // SLICE_BYTES))
    weighed = written(terms.join(dfs, "term").withColumn("slice", F.pmod(F.xxhash64("no"), F.lit(slices))), "lexical-weighed")
    found = None
    for i in range(slices if n_all else 0):
        own: dict[int, dict[bytes, int]] = {}
        for r in weighed.where(F.col("slice") == i).select("no", "term", "times", "df").collect():  # one slice: bounded
            if w := r.times * weight(n_all, r.df):
                own.setdefault(r.no, {})[bytes(r.term)] = w
        if own:
            rows = index.mapInArrow(_found(sorted(own.items()), n_all, l_all, k), "no long, key long, score long")
            # as many rows a query as there are tasks, times k: ranked in parts first
            rows = _best(rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))), ["no", "part"], k)
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = spark.createDataFrame([], "no long, key long, score long")
    return (_best(found.select("no", "key", "score"), ["no"], k).join(asked.select("no", "query_key"), "no")
            .select(F.col("query_key").alias(query_key), "rank", F.col("key").alias(key), "score"))
