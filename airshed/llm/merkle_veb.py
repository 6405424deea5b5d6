"""Merkle manifest of a table: one hash tree per group, one tree over the groups' roots, van Emde Boas order.

Every row is a leaf; every ``FAN`` consecutive nodes become their digest until one is left.  A tree is
split at half height, over and over, down to aligned subtrees of ``LEVELS`` levels: these blocks are
what a task builds and what a row of the manifest stores.  A block's digests lie in van Emde Boas order (the upper
half of its levels first, then each lower subtree whole), and ``address`` gives any node's place from its level
and index alone, in a block and in a whole tree, ragged right edges included.  Construction recurses over the
blocks' roots: they are the entries of the next layer of blocks, 8^3 times fewer after the first layer and
8^4 times fewer after each further one, so no task ever holds more than 4,096 entries however large
a group is.  Sibling retrieval goes the other way: each layer's block hands the path above it
down to its entries' blocks, and a leaf's own siblings are read from its block by address.

Defined results.  Null values count as ``-`` in a leaf; a null group is a group of its own, before all others; rows are
ordered by the order column (null first), rows equal in it by their leaf digest, so repeated rows are leaves of
their own whose positions may be exchanged freely.  A lone leaf is its group's root.  An
empty table has no leaves and no root.  Texts of any length are hashed whole by Spark.  Columns that are not
named take no part, and the named ones are renamed at once: a column may have any name.  The results have the
fixed columns named in ``stored`` and ``verify``.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import prepare, written

FAN = 8
#: Levels of a block, a power of two: halving any tree's height in steps of powers of two ends in such blocks.
LEVELS = 4


# ---- address arithmetic -------------------------------------------------------------------------

def nodes_of(levels: int, leaves: int) -> int:
    """Nodes of a tree with ``leaves`` nodes at its lowest level and ``levels`` levels."""
    return sum(-(-leaves // FAN ** k) for k in range(levels))


def height(leaves: int) -> int:
    """Levels of a tree over ``leaves`` leaves."""
    levels = 1
    while FAN ** (levels - 1) < leaves:
        levels += 1
    return levels


def address(levels: int, leaves: int, level: int, index: int) -> int:
    """Place of node ``index`` of ``level`` (0: lowest) in the van Emde Boas order of a tree.

    The lower part gets the largest power of two of levels below ``levels``.  Only the last subtree of
    each height can be ragged, so all that lies in front of a subtree is full and counted in closed form.
    """
    at = 0
    while levels > 1:
        low = 1 << (levels - 1).bit_length() - 1
        wide = FAN ** (low - 1)
        if level >= low:
            levels, leaves, level = levels - low, -(-leaves // (wide * FAN)), level - low
        else:
            sub = index // FAN ** (low - 1 - level)
            at += nodes_of(levels - low, -(-leaves // (wide * FAN))) + sub * nodes_of(low, wide)
            levels, leaves, index = low, min(wide, leaves - sub * wide), index - sub * FAN ** (low - 1 - level)
    return at


@lru_cache(maxsize=64)
def places(levels: int, leaves: int) -> list[list[int]]:
    """``address`` of every node, by level."""
    return [[address(levels, leaves, k, i) for i in range(-(-leaves // FAN ** k))] for k in range(levels)]


def block_address(levels: int, leaves: int, layer: int, block: int, layer_levels: int) -> int:
    """Place of a block's first node (its root) in the whole tree's order."""
    return address(levels, leaves, layer * LEVELS + layer_levels - 1, block)


# ---- one block ----------------------------------------------------------------------------------

def digest(texts) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def parents(level: list[str]) -> list[str]:
    return [digest(level[i:i + FAN]) for i in range(0, len(level), FAN)]


def shape(layer: int, entries: int, top: bool) -> tuple[int, int]:
    """Levels that a block stores and nodes at the lowest of them.

    The first layer stores its entries (the leaves); further layers' entries are stored in the blocks below.
    """
    lowest = entries if layer == 0 else -(-entries // FAN)
    return (height(lowest) if top else LEVELS), lowest


def build_block(layer: int, entries: list[str], top: bool) -> list[str]:
    """The digests of a block in van Emde Boas order; the first is its root."""
    levels, lowest = shape(layer, len(entries), top)
    level, out = entries if layer == 0 else parents(entries), [""] * nodes_of(levels, lowest)
    for k, at in enumerate(places(levels, lowest)):
        level = parents(level) if k else level
        for a, node in zip(at, level):
            out[a] = node
    return out


def run_of(level: list[str], at: list[int] | None, i: int) -> tuple[str, str]:
    """What stands before and behind node ``i`` in its run of siblings (by address, if ``at`` is given)."""
    first = i - i % FAN
    run = level[first:first + FAN] if at is None else [level[a] for a in at[first:first + FAN]]
    return "".join(run[:i - first]), "".join(run[i - first + 1:])


def block_paths(layer: int, entries: list[str], top: bool, nodes: list[str], above: list[tuple[str, str]]):
    """For each entry the siblings before and behind it, level by level up to the root of all."""
    levels, lowest = shape(layer, len(entries), top)
    at, upper = places(levels, lowest), {}

    def from_level(k: int, i: int) -> list[tuple[str, str]]:
        """The path of node ``i`` of stored level ``k``; that of its parent is shared by the whole run."""
        if k == levels - 1:
            return above
        if (k, i) not in upper:
            if len(upper) > 4 * FAN ** (LEVELS - 1):
                upper.clear()
            upper[k, i] = [run_of(nodes, at[k], i), *from_level(k + 1, i // FAN)]
        return upper[k, i]

    for i in range(len(entries)):
        if layer == 0:
            yield from_level(0, i)
        else:
            yield [run_of(entries, None, i), *from_level(0, i // FAN)]


# ---- the distributed forest ---------------------------------------------------------------------

def leaf_digest(columns: list[str], replaced: dict[str, Column] | None = None) -> Column:
    """SHA-256 of the columns, each ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    parts = []
    for c in columns:
        text = (replaced or {}).get(c, F.col(f"`{c}`")).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_key(col: Column) -> Column:
    """A group's name as a string that is never null and sorts like the group, null first."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("-"))


def positions(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (tree, place, leaf, carried) with ``rank`` within the tree and ``n``, its number of leaves.

    Rows are range-partitioned by (tree, place, leaf) and numbered where they lie; a running sum over one
    row a partition and the first number of each tree do the rest.  The join key (tree, partition) is as
    fine as the partitions, so a group holding a third of all rows makes no hot key.
    """
    # the last column spreads a run of identical rows over several partitions
    ranged = (rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
              .repartitionByRange("tree", "place", "leaf", "tie")
              .sortWithinPartitions("tree", "place", "leaf", "tie").drop("tie", "place"))
    # written once: numbers and counts must see one and the same partitioning
    rows = written(ranged.withColumn("number", F.monotonically_increasing_id()), name)
    part, inside = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("here"), F.min(inside).alias("first"))
    counts = written(counts, name + "-counts")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (counts.groupBy("part").agg(F.sum("here").alias("here"))
             .select("part", F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("ahead")))
    counts = counts.join(parts, "part").withColumn("first", F.col("first") + F.col("ahead"))
    trees = counts.groupBy("tree").agg(F.min("first").alias("start"), F.sum("here").alias("n"))
    offsets = written(counts.join(trees, "tree").select("tree", "part", (F.col("ahead") - F.col("start")).alias("shift"), "n"),
                      name + "-offsets")
    return (rows.withColumn("part", part).join(offsets, ["tree", "part"])
            .withColumn("rank", inside + F.col("shift")).drop("number", "part", "shift"))


@dataclass
class Forest:
    """Layers of blocks, lowest first: tree, layer, block, n (leaves of the tree), last (block that ends its tree),
    entries (in order), nodes (van Emde Boas order)."""
    layers: list[DataFrame]

    def roots(self) -> DataFrame:
        """tree, n and the root of each tree."""
        tops = [x.where("last").select("tree", "n", F.col("nodes")[0].alias("root")) for x in self.layers]
        out = tops[0]
        for x in tops[1:]:
            out = out.unionByName(x)
        return out


BLOCK = "tree string, layer int, block long, n long, last boolean, entries array<struct<rank: long, leaf: string, carried: binary>>, nodes array<string>"


def _built(layer: int):
    def run(batches):
        for b in batches:
            got = {c: b.column(c).to_pylist() for c in ("last", "entries")}
            nodes = [build_block(layer, [e["leaf"] for e in es], top) for es, top in zip(got["entries"], got["last"])]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("tree", "layer", "block", "n", "last", "entries")), pa.array(nodes, pa.list_(pa.string()))],
                names=["tree", "layer", "block", "n", "last", "entries", "nodes"])
    return run


def grow(rows: DataFrame, name: str) -> Forest:
    """The trees over ``rows``: tree, place, leaf, carried (binary, handed through)."""
    rows = positions(rows, name)
    layers, left, layer = [], None, 0
    while left is None or left > 1:
        per_block = FAN ** (LEVELS - 1 if layer == 0 else LEVELS)
        shrink = FAN ** (LEVELS * layer)
        # entries of the tree at this layer: its leaves, or the blocks of the layer below
        here = F.ceil(F.col("n") / F.lit(shrink // FAN if layer else 1)).cast("long")
        blocks = (rows.groupBy("tree", F.floor(F.col("rank") / per_block).cast("long").alias("block"))
                  .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "leaf", "carried"))).alias("entries"))
                  .select("tree", F.lit(layer).alias("layer"), "block", "n", (here <= per_block).alias("last"), "entries"))
        done = written(blocks.mapInArrow(_built(layer), BLOCK), f"{name}-layer{layer}")
        layers.append(done)
        rows = done.where("not last").select("tree", F.col("block").alias("rank"), F.col("nodes")[0].alias("leaf"),
                                             F.lit(None).cast("binary").alias("carried"), "n")
        if left is None:
            left = done.agg(F.max("n")).first()[0] or 0
        left, layer = -(-left // per_block), layer + 1
    return Forest(layers)


PATH = "array<struct<before: string, behind: string>>"


def _handed_down(layer: int):
    """Block rows with ``above`` -> one row for each entry with its path (for the entry's own block)."""
    fields = pa.list_(pa.struct([("before", pa.string()), ("behind", pa.string())]))

    def run(batches):
        for b in batches:
            for tree, top, entries, nodes, above in zip(*(b.column(c).to_pylist() for c in ("tree", "last", "entries", "nodes", "above"))):
                path = [(x["before"], x["behind"]) for x in above]
                out = list(block_paths(layer, [e["leaf"] for e in entries], top, nodes, path))
                for i in range(0, len(out), 512):
                    part = [[{"before": x, "behind": y} for x, y in p] for p in out[i:i + 512]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * len(part)), pa.array([e["rank"] for e in entries[i:i + 512]], pa.int64()),
                         pa.array([e["carried"] for e in entries[i:i + 512]], pa.binary()), pa.array(part, fields)],
                        names=["tree", "rank", "carried", "path"])
    return run


def leaf_blocks(forest: Forest, tops: DataFrame) -> DataFrame:
    """The lowest blocks with ``above``: the path from the block's root to the root of all.

    ``tops`` has tree and ``above`` of each tree's root.  Each layer hands paths to the layer
    below it by an equi-join on (tree, block).
    """
    given = None
    for layer in range(len(forest.layers) - 1, -1, -1):
        blocks = forest.layers[layer]
        out = blocks.where("last").join(tops, "tree")
        if given is not None:
            out = out.unionByName(blocks.where("not last").join(given, ["tree", "block"]))
        if layer:
            given = written(out.mapInArrow(_handed_down(layer), f"tree string, rank long, carried binary, path {PATH}")
                            .select("tree", F.col("rank").alias("block"), F.col("path").alias("above")), f"merkle-paths{layer}")
    return out


@dataclass
class Manifest:
    """``groups``: the trees over the rows; ``whole``: the tree over their roots."""
    groups: Forest
    whole: Forest

    def stored(self) -> DataFrame:
        """The manifest as a table: tree (null: the tree over the roots), layer, block, address of the block's
        first node in its tree's van Emde Boas order, nodes."""
        def run(batches):
            for b in batches:
                layers, blocks, ns = (b.column(c).to_pylist() for c in ("layer", "block", "n"))
                sizes = b.column("size").to_pylist()
                at = [block_address(height(n), n, k, i, shape(k, size, top)[0])
                      for k, i, n, size, top in zip(layers, blocks, ns, sizes, b.column("last").to_pylist())]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("tree", "layer", "block", "n")), pa.array(at, pa.int64()), b.column("nodes")],
                                                 names=["tree", "layer", "block", "n", "address", "nodes"])
        out = None
        for forest, name in ((self.groups, F.col("tree")), (self.whole, F.lit(None).cast("string"))):
            for x in forest.layers:
                rows = x.select(name.alias("tree"), "layer", "block", "n", "last", F.size("entries").alias("size"), "nodes")
                out = rows if out is None else out.unionByName(rows)
        return out.mapInArrow(run, "tree string, layer int, block long, n long, address long, nodes array<string>")


def build(df: DataFrame, columns: list[str], group: str, order: str, tampered: dict[str, Column] | None = None,
          where: Column | None = None) -> Manifest:
    """The manifest of ``df``: leaves over ``columns``, a tree for each value of ``group``, in ``order``.

    ``tampered`` gives changed values of columns for the rows where ``where`` holds: their changed leaf is kept
    beside the leaf, for ``verify``.  It never enters a tree.
    """
    prepare(df.sparkSession)
    changed = F.when(where, leaf_digest(columns, tampered)) if tampered else F.lit(None).cast("string")
    key = F.col(f"`{order}`")
    rows = df.select(tree_key(F.col(f"`{group}`")).alias("tree"), key.alias("place"), leaf_digest(columns).alias("leaf"),
                     F.to_json(F.struct(key.alias("key"), changed.alias("changed"))).cast("binary").alias("carried"))
    groups = grow(rows, "merkle-leaves")
    subroots = groups.roots().select(F.lit("").alias("tree"), F.col("tree").alias("place"), F.col("root").alias("leaf"),
                                     F.col("tree").cast("binary").alias("carried"))
    return Manifest(groups, grow(subroots, "merkle-roots"))


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that ``leaf`` and its siblings give."""
    for before, behind in path:
        leaf = digest((before, leaf, behind))
    return leaf


def _proved(kind):
    """Leaf blocks with ``above`` and the tree's and the whole's root -> one row for each leaf."""
    def run(batches):
        for b in batches:
            for top, entries, nodes, above, subroot, root in zip(*(b.column(c).to_pylist() for c in ("last", "entries", "nodes", "above", "subroot", "root"))):
                path = [(x["before"], x["behind"]) for x in above]
                rows = []
                for e, p in zip(entries, block_paths(0, [e["leaf"] for e in entries], top, nodes, path)):
                    own = json.loads(e["carried"])
                    folded = fold(own.get("changed") or e["leaf"], p)
                    rows.append((own.get("key"), e["leaf"], subroot, root, digest(x for pair in p for x in pair), folded, folded == root))
                types = [kind, *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                                 names=["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def verify(manifest: Manifest, key_type: str = "long") -> DataFrame:
    """Per leaf: key, leaf, subroot, root, digest of its siblings, the root folded from its (if changed: changed)
    leaf, and whether that is the root."""
    whole = leaf_blocks(manifest.whole, manifest.whole.roots().select("tree", F.array().cast(PATH).alias("above")))
    tops = (whole.mapInArrow(_handed_down(0), f"tree string, rank long, carried binary, path {PATH}")
            .select(F.col("carried").cast("string").alias("tree"), F.col("path").alias("above")))
    tops = written(tops.join(manifest.groups.roots().select("tree", F.col("root").alias("subroot")), "tree"), "merkle-tops")
    blocks = leaf_blocks(manifest.groups, tops.select("tree", "above"))
    # one root for all: a scalar subquery, not a join
    rows = blocks.join(tops.select("tree", "subroot"), "tree").withColumn("root", manifest.whole.roots().select("root").scalar())
    kind = {"long": pa.int64(), "string": pa.string()}[key_type]
    return rows.mapInArrow(_proved(kind), f"key {key_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
