"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are 64-bit majority votes over the XXH64 of word shingles.  Equal fingerprints are
one index entry.  Entries are sorted by Gray rank, so neighbours agree in most leading bits;
eight neighbours at a time share an upper node that holds the bits all of them agree in (mask
and pattern), and a node's own mask leaves out what its parent has already factored out.  A search
carries the differences accumulated on the way down and drops a node, with all below it, as soon as
they exceed the limit; at the leaves the count is the exact bit distance.

The top of the tree is spread over the cluster: the leading ``p`` bits name a region.  An entry
lives in its region and visits the regions whose leading bits differ in ``max_bits`` places at
most (the others are pruned at the top), each unordered pair of regions once.  ``p`` follows the
number of entries, so a region keeps about ``REGION_ENTRIES``.  A region returns a spanning
forest of its links, not all pairs, so groups of thousands of near copies stay linear.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import fresh_name, prepare, refuse, written
from airshed.llm.components import components

#: Entries a region of the index keeps on average.
REGION_ENTRIES = 2048
FANOUT = 8
#: Queries that start together, and open (query, node) pairs of a step: the memory of a search.
QUERY_BLOCK = 8192
FRONTIER = 1 << 20
SEED = 42


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit SimHash: A-Z lower-cased, words between ASCII white space, shingles with
    repeats; a text of fewer words is one shingle, one without words has fingerprint 0."""
    import xxhash
    words = (text or "").encode().lower().split()  # bytes.lower() touches A-Z only
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, len(words))
    hash64 = xxhash.xxh64_intdigest
    h = np.array([hash64(data[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint", shingle_words: int = 3,
                 carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) with the fingerprint as a long (its 64 bits, signed)."""
    prepare(df.sparkSession)
    keep = list(df.columns if carry is None else carry)
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(fresh_name(df, "sim_text")))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(out, T.LongType())])

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle_words) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(np.array(fps, np.uint64).view(np.int64))],
                                             names=schema.names)

    return src.mapInArrow(run, schema)


def gray_rank(f: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    r = f.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """The tree over one region's entries, bottom level first."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        both, any_ = self.codes, self.codes
        levels = []  # of each level: agreed bits, their values
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        while len(both) > 1:
            at = np.arange(0, len(both), FANOUT)
            both, any_ = np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(any_, at)
            levels.append((full ^ (both ^ any_), both))
        levels.reverse()
        self.levels = [(mask & ~(np.repeat(levels[i - 1][0], FANOUT)[:len(mask)] if i else np.uint64(0)), pattern)
                       for i, (mask, pattern) in enumerate(levels)]
        last = levels[-1][0] if levels else np.zeros(1, np.uint64)
        self.leaf_mask = ~np.repeat(last, FANOUT)[:len(self.codes)] if levels else np.full(len(self.codes), full)

    def search(self, queries: np.ndarray, max_bits: int, after: np.ndarray | None = None):
        """Yield (query numbers, entry numbers) of all entries within ``max_bits``, in parts; ``after``:
        only entries behind that number (each pair of entries once).

        A part of the search that has more than ``FRONTIER`` open (query, node) pairs goes on in halves,
        so a dense group of near copies costs time but not memory.
        """
        steps = [*self.levels, (self.leaf_mask, self.codes)]
        todo = [(0, np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.uint8))]
        while todo:
            i, q, node, acc = todo.pop()
            if len(q) * FANOUT > FRONTIER and len(q) > 1:
                half = len(q) // 2
                todo += [(i, q[half:], node[half:], acc[half:]), (i, q[:half], node[:half], acc[:half])]
                continue
            mask, pattern = steps[i]
            if i or not self.levels:
                width = FANOUT if i else len(pattern)
                q, acc = np.repeat(q, width), np.repeat(acc, width)
                node = (node[:, None] * FANOUT + np.arange(width)).ravel()
                real = node < len(pattern)
                q, acc, node = q[real], acc[real], node[real]
            if after is not None:  # the last entry below the node
                ahead = (node + 1) * FANOUT ** (len(steps) - 1 - i) - 1 > after[q]
                q, acc, node = q[ahead], acc[ahead], node[ahead]
            acc = acc + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = acc <= max_bits
            q, acc, node = q[near], acc[near], node[near]
            if i + 1 < len(steps):
                todo.append((i + 1, q, node, acc))
            elif len(q):
                yield q, node


def join_roots(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots (smallest member of each component) after linking x[i] with y[i]."""
    while True:
        a, b = root[x], root[y]
        open_ = a != b
        if not open_.any():
            return root
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def link_forest(residents: np.ndarray, visitors: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (as rows of two codes) that connect what the links of one region connect: from each
    code to one code of its local component."""
    index = GrayIndex(residents)
    codes = np.concatenate([index.codes, visitors])
    root, n = np.arange(len(codes)), len(residents)
    for begin in range(0, len(codes), QUERY_BLOCK):
        own = np.arange(begin, min(begin + QUERY_BLOCK, len(codes)))
        for q, e in index.search(codes[own], max_bits, np.where(own < n, own, -1)):
            root = join_roots(root, own[q], e)
    linked = root != np.arange(len(codes))
    return np.stack([codes[linked], codes[root[linked]]], axis=1)


def link_entries(entries: DataFrame, col: str, max_bits: int, region_entries: int = REGION_ENTRIES) -> DataFrame:
    """Links (``a``, ``b``) whose connected components are those of all pairs of distinct codes
    within ``max_bits``.  ``entries``: one row per distinct code, written (it is read twice)."""
    n = entries.count()
    p = max(0, (n - 1) // region_entries).bit_length()
    if not 0 <= max_bits <= 16:
        raise ValueError("max_bits must be between 0 and 16")
    region = F.shiftrightunsigned(F.col(col), 64 - p) if p else F.lit(0).cast("long")
    masks = [sum(1 << b for b in bits) for k in range(1, min(max_bits, p) + 1) for bits in combinations(range(p), k)]
    home = entries.select(F.col(col).alias("code"), region.alias("home"))
    rows = home.select("code", F.explode(F.array(*[F.lit(m).cast("long") for m in [0, *masks]])).alias("flip"), "home")
    rows = (rows.select("code", F.col("home").bitwiseXOR(F.col("flip")).alias("region"), (F.col("flip") == 0).alias("resident"), "home")
            .where("region >= home").drop("home"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        code, here = pdf["code"].to_numpy(np.int64).view(np.uint64), pdf["resident"].to_numpy(bool)
        found = link_forest(code[here], code[~here], max_bits) if here.any() else np.empty((0, 2), np.uint64)
        return pd.DataFrame({"a": found[:, 0].astype(np.uint64).view(np.int64), "b": found[:, 1].astype(np.uint64).view(np.int64)})

    return rows.groupBy("region").applyInPandas(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_bits: int = 2, carry: list[str] | None = None, with_root: bool = False) -> DataFrame:
    """``id_col``, ``carry``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row;
    ``with_root=True`` adds ``component_root``, the fingerprint that names the component.

    Rows link at ``max_bits`` differing bits or fewer; a component is everything reachable and is
    named by its smallest id.  Texts without words (null, empty, white space) have fingerprint 0
    and link like any other.  Null ids take part; a component of null ids only has a null name.
    Repeated rows are one entry and come back each.  An empty table gives an empty result.  Carried columns
    may have any name but those of the outputs, which raise ``ValueError``.
    """
    prepare(df.sparkSession)
    outputs = ["fingerprint", "component_id", *["component_root"] * with_root]
    keep = [id_col, *(carry or [])]
    refuse(keep, outputs)
    own = [f"c{i}" for i in range(len(keep))]
    plain = df.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keep, own)], F.col(f"`{text_col}`").alias("text"))
    docs = written(fingerprints(plain, "text", "_code", shingle_words, own), "simhash-docs")
    entries = written(docs.groupBy("_code").agg(F.min("c0").alias("_least")), "simhash-entries")
    tree = components(link_entries(entries, "_code", max_bits), "a", "b")
    rooted = (entries.join(tree, F.col("_code") == F.col("node"), "left")
              .select(F.col("_code").alias("_entry"), "_least", F.coalesce("root", "_code").alias("_root")))
    rooted = written(rooted, "simhash-roots")
    names = rooted.groupBy(F.col("_root").alias("_r")).agg(F.min("_least").alias("component_id"))
    named = rooted.join(names, F.col("_root") == F.col("_r")).select("_entry", "component_id", F.col("_root").alias("component_root"))
    return (docs.join(named, F.col("_code") == F.col("_entry"), "left")
            .select(*own, F.lower(F.lpad(F.hex("_code"), 16, "0")).alias("fingerprint"), "component_id", *["component_root"] * with_root)
            .toDF(*keep, *outputs))


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``df`` with one document of each component: that with the smallest id.

    Of rows that share the smallest id (repeated rows) the one with the smallest text hash stays,
    and one of rows equal in both; a component without any id keeps one row likewise.
    """
    prepare(df.sparkSession)
    # the row's place in the scan tells repeated rows apart; it is drawn once and written with the texts
    place = fresh_name(df, "sim_row")
    rows = written(df.withColumn(place, F.monotonically_increasing_id()), "simhash-rows")
    light = rows.select(F.col(place).alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("t"),
                        F.col(f"`{text_col}`").alias("text"))
    found = near_duplicates(light, "id", "text", shingle_words, max_bits, carry=["row", "t"], with_root=True)
    # a partial aggregation picks one row for each component
    chosen = (found.groupBy("component_root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t", "row")).alias("w"))
              .select("w.row"))
    kept = fresh_name(rows, "sim_kept")
    return rows.join(chosen.select(F.col("row").alias(kept)), F.col(place) == F.col(kept), "left_semi").drop(place)
