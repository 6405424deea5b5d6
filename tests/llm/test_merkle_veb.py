"""Merkle manifest: addresses, trees and proofs against a plain recursive version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from airshed.llm import merkle_veb as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i - i % 8:i - i % 8 + 8]
        out.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return out


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """rows: (doc_id, grp, text) -> sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for d, g, t in rows:
        changed = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        leaf = H(field(d), field(g), field(t))
        groups.setdefault(g, []).append((d, leaf, H(field(d), field(g), field(lower(t))) if changed else leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = plain_levels([x[1] for x in groups[g]])
    whole = plain_levels([trees[g][-1][0] for g in names])
    root, out = whole[-1][0], []
    for k, g in enumerate(names):
        for i, (d, leaf, own) in enumerate(groups[g]):
            path = plain_path(trees[g], i) + plain_path(whole, k)
            out.append((d, leaf, trees[g][-1][0], root, H(*(x for p in path for x in p)), M.fold(own, path), M.fold(own, path) == root))
    return sorted(out, key=repr)


def run(df):
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    m = M.build(df, ["doc_id", "grp", "text"], "grp", "doc_id", {"text": text}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    rows = M.verify(m).select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return m, sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 64, 65, 511, 512, 513, 4096, 4097, 4609, 33000])
def test_addresses_are_a_dense_order_with_aligned_blocks(leaves):
    levels = M.height(leaves)
    all_nodes = [(k, i) for k in range(levels) for i in range(-(-leaves // 8 ** k))]
    at = {n: M.address(levels, leaves, *n) for n in all_nodes}
    assert sorted(at.values()) == list(range(M.nodes_of(levels, leaves)))
    # a block of four levels is contiguous, in the order the block has on its own
    for k, i in all_nodes:
        layer, inside = k // M.LEVELS, k % M.LEVELS
        top = min(levels, (layer + 1) * M.LEVELS) - layer * M.LEVELS  # levels of its block
        wide = 8 ** (top - 1 - inside)
        lowest = min(8 ** (top - 1), -(-leaves // 8 ** (layer * M.LEVELS)) - i // wide * 8 ** (top - 1))
        own = M.address(top, lowest, inside, i % wide)
        assert at[k, i] == M.block_address(levels, leaves, layer, i // wide, top) + own


def test_equal_to_the_plain_trees_over_two_layers_of_blocks(spark):
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "é", "", None]), f"Text {i} OF É") for i in range(2500)]
    rng.shuffle(rows)
    m, got = run(spark.createDataFrame(rows, "doc_id long, grp string, text string"))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}
    assert len(m.groups.layers) == 2
    # the stored manifest: every node by its address
    trees = {}
    for r in m.stored().collect():
        for j, node in enumerate(r.nodes):
            trees.setdefault(r.tree, {})[r.address + j] = node
    hot = plain_levels([x[1] for x in sorted((d, H(field(d), field(g), field(t))) for d, g, t in rows if g == "hot")])
    want = {M.address(len(hot), len(hot[0]), k, i): n for k, level in enumerate(hot) for i, n in enumerate(level)}
    assert trees["=hot"] == want
    assert len(trees[None]) == 1 + 5


def test_many_groups_of_one_row(spark):
    rows = [(i, f"g{i:04d}", None) for i in range(700)]
    assert run(spark.createDataFrame(rows, "doc_id long, grp string, text string"))[1] == brute(rows)


def test_odd_rows_and_clashing_columns(spark, odd):
    rows = [(r.doc_id, None if r.doc_id in (1, 2) else "g", r.text) for r in odd.collect()]
    clash = ["tree", "place", "leaf", "carried", "tie", "number", "part", "here", "first", "ahead", "start", "n", "rank", "block",
             "entries", "nodes", "above", "path", "subroot", "root", "verified", "key", "KEY", "stored"]
    df = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], "doc_id long, grp string, text string, " + ", ".join(
        f"{c}{'_2' if c == 'KEY' else ''} string" for c in clash))
    assert run(df)[1] == brute(rows)


def test_one_row_and_none(spark):
    assert run(spark.createDataFrame([(1, "a", "B")], "doc_id long, grp string, text string"))[1] == brute([(1, "a", "B")])
    assert run(spark.createDataFrame([], "doc_id long, grp string, text string"))[1] == []
