"""Merkle manifest of a dataset, its nodes stored in van Emde Boas layout.

Every row is a leaf.  The leaves of a tree (a source) are cut into aligned
blocks of 3^BLOCK_LEVELS; a task builds the complete ternary subtree of a block
and stores it as one array whose nodes lie in van Emde Boas order: a subtree is
cut at half its height, its upper part comes first and the lower parts follow,
each laid out in the same way.  Addresses are arithmetic on (depth, place), so
a walk from a leaf to the root touches few cache lines whatever their size, and
no pointers are stored.  The roots of the blocks are the leaves of the next
layer; the roots of the trees are the leaves of the manifest's own tree.

Texts are hashed where they are read; afterwards a row is about 200 bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .shared import ship_package, stored

#: Children of a node, and levels of a full block above its leaves: at most 2,187 leaves in a group of rows.
FANOUT, BLOCK_LEVELS = 3, 7
#: The name of the tree over the trees' roots (names of sources begin with a plus sign, the null source's is empty).
TOP = "top"


# ---- van Emde Boas arithmetic ---------------------------------------------------------------------------------

def subtree_size(levels: int) -> int:
    """Nodes of a complete tree with so many levels of nodes."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, place: np.ndarray) -> np.ndarray:
    """Addresses of the nodes `place` (0, 1, ... from the left) at `depth` (root: 0) of a tree with `levels` levels."""
    if levels == 1:
        return np.zeros_like(place)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, place)
    wide = FANOUT ** (depth - upper)  # nodes at this depth in each lower part
    return (subtree_size(upper) + place // wide * subtree_size(levels - upper)
            + address(levels - upper, depth - upper, place % wide))


@lru_cache(maxsize=None)
def layout(levels: int) -> list[np.ndarray]:
    """Addresses by depth: the arithmetic above for all nodes of a tree, at most BLOCK_LEVELS + 1 trees a worker."""
    return [address(levels, d, np.arange(FANOUT ** d)) for d in range(levels)]


@lru_cache(maxsize=None)
def _inner_nodes(levels: int) -> list[tuple[int, int, int]]:
    """(address, depth, place) of the nodes above the leaves, the highest address first.

    Upper parts come before lower ones, so every node's children are complete
    when it is reached, and the sweep stays inside a subtree until it is done.
    """
    nodes = [(int(a), d, p) for d, row in enumerate(layout(levels)[:-1]) for p, a in enumerate(row)]
    return sorted(nodes, reverse=True)


def _h(digests: list[bytes]) -> bytes:
    """H of digests, which enter it as hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def levels_above(n: int) -> int:
    """Levels above n leaves until one node remains."""
    k = 0
    while n > 1:
        n, k = -(-n // FANOUT), k + 1
    return k


def widths(leaves: int, levels: int) -> list[int]:
    """Nodes present at each depth of a block (root: first)."""
    out = [leaves]
    for _ in range(levels):
        out.append(-(-out[-1] // FANOUT))
    return out[::-1]


def build_block(leaves: list[bytes], up: int) -> bytes:
    """The block's array of 32-byte digests; places without a node hold zeros."""
    at, wide = layout(up + 1), widths(len(leaves), up)
    nodes = [b"\0" * 32] * subtree_size(up + 1)
    for a, leaf in zip(at[up].tolist(), leaves):
        nodes[a] = leaf
    for a, d, p in _inner_nodes(up + 1):
        if p < wide[d]:
            below = at[d + 1]
            nodes[a] = _h([nodes[below[c]] for c in range(FANOUT * p, min(FANOUT * p + FANOUT, wide[d + 1]))])
    return b"".join(nodes)


def sibling_path(nodes: bytes, leaves: int, up: int, place: int) -> bytes:
    """Steps from a leaf to the block's root: a byte (4 * place in the run + siblings), then the siblings' digests."""
    at, wide, out = layout(up + 1), widths(leaves, up), []
    for d in range(up, 0, -1):
        first = place - place % FANOUT
        others = [c for c in range(first, min(first + FANOUT, wide[d])) if c != place]
        out.append(bytes([4 * (place - first) + len(others)]))
        for c in others:
            a = 32 * int(at[d][c])
            out.append(nodes[a:a + 32])
        place //= FANOUT
    return b"".join(out)


def fold(leaf: bytes, path: bytes) -> tuple[bytes, list[bytes]]:
    """The root that a leaf and its steps give, and all siblings in the order of the steps."""
    node, siblings, at = leaf, [], 0
    while at < len(path):
        place, n = divmod(path[at], 4)
        run = [path[at + 1 + 32 * i:at + 33 + 32 * i] for i in range(n)]
        siblings += run
        node = _h([*run[:place], node, *run[place:]])
        at += 1 + 32 * n
    return node, siblings


# ---- leaves ---------------------------------------------------------------------------------------------------

def tagged(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    v = value.cast("string")
    return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[tagged(v) for v in values]), 256))


def tree_name(source: Column) -> Column:
    """A source as a name that is never null; the null source comes first."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("+"), source.cast("string")))


def ranked(rows: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """`rows` (stored) with `rank`: place among the rows of the same `tree` in the order of `order`, from 0.

    Rows are dealt to ranges of (tree, order), so one tree may hold any share
    of them; each range is numbered in one pass, and the counts of the ranges
    before (one row per range and tree) are added.  Rows equal in all of
    `order` are told apart by a number, so they may spread over ranges.
    """
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "_row"]
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_row")
    schema = T.StructType([*dealt.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])

    def number(batches):
        tree, n, part = None, 0, TaskContext.get().partitionId()
        for b in batches:
            at = np.empty(b.num_rows, np.int64)
            start = 0
            names = b.column("tree").to_pylist()
            while start < len(names):  # a run of rows of one tree
                if names[start] != tree:
                    tree, n = names[start], 0
                end = start
                while end < len(names) and names[end] == tree:
                    end += 1
                at[start:end] = np.arange(n, n + end - start)
                n, start = n + end - start, end
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part), pa.int32()), pa.array(at)],
                                             names=[*b.schema.names, "part", "at"])

    ship_package()
    placed = stored(dealt.mapInArrow(number, schema), "ranked")
    held = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(offsets, ["tree", "part"]).withColumn("rank", F.col("before") + F.col("at")).drop("part", "at", "before")


# ---- blocks and layers ----------------------------------------------------------------------------------------

@dataclass
class Layer:
    """`leaves`: (tree, rank, block, digest, ...); `blocks`: (tree, block, n, up, nodes), one row per block."""
    leaves: DataFrame
    blocks: DataFrame


@dataclass
class Forest:
    """The layers from the bottom up, and one row per tree: (tree, root)."""
    layers: list[Layer] = field(default_factory=list)
    roots: DataFrame | None = None


def build_layer(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> Layer:
    """Blocks over the leaves (tree, rank, digest); a tree that fits one block ends at its root.

    A block behind the first, or a full one, has all its levels; a first block
    that is not full is its whole tree.
    """
    leaves = leaves.withColumn("block", F.floor(F.col("rank") / FANOUT ** block_levels).cast("long"))

    def build(key, t):
        up = levels_above(t.num_rows) if key[1].as_py() == 0 else block_levels
        nodes = build_block(t.sort_by("rank").column("digest").to_pylist(), up)
        return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "n": [t.num_rows], "up": [up], "nodes": [nodes]},
                        schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("up", pa.int32()), ("nodes", pa.binary())]))

    ship_package()
    blocks = (leaves.select("tree", "block", "rank", "digest").groupBy("tree", "block")
              .applyInArrow(build, "tree string, block long, n long, up int, nodes binary"))
    return Layer(leaves, stored(blocks, "blocks"))


def build_forest(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> Forest:
    """All layers of all trees; each layer has 3^block_levels times fewer rows than the one below."""
    out, rest = Forest(), leaves
    while True:
        layer = build_layer(rest, block_levels)
        out.layers.append(layer)
        goes_on = layer.blocks.where("block = 1").select("tree")  # trees with a second block
        tops = layer.blocks.select("tree", F.col("block").alias("rank"), F.substring("nodes", 1, 32).alias("digest"))
        done = tops.join(goes_on, "tree", "left_anti").select("tree", F.col("digest").alias("root"))
        out.roots = done if out.roots is None else out.roots.unionByName(done)
        if goes_on.isEmpty():
            return out
        rest = stored(tops.join(goes_on, "tree", "left_semi"), "tops")


def sibling_paths(layer: Layer, above: DataFrame) -> DataFrame:
    """The layer's leaves with `path` to the block's root and on, and `subroot`; `above` (tree, block, path, subroot) has the rest.

    A block's array and the rest of its path meet its leaves once, in a group
    of at most a full block; nothing is joined to the leaves one by one.
    """

    def walk(key, rows, block):
        nodes, n, up, rest, subroot = (block.column(c)[0].as_py() for c in ("nodes", "n", "up", "path", "subroot"))
        wide = FANOUT ** up
        paths = [sibling_path(nodes, n, up, r % wide) + rest for r in rows.column("rank").to_pylist()]
        return rows.append_column("path", pa.array(paths, pa.binary())).append_column("subroot", pa.array([subroot] * rows.num_rows, pa.binary()))

    schema = T.StructType([*layer.leaves.schema.fields, T.StructField("path", T.BinaryType()), T.StructField("subroot", T.BinaryType())])
    blocks = layer.blocks.join(above, ["tree", "block"])
    ship_package()
    return layer.leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(walk, schema)


def all_paths(forest: Forest, beyond: DataFrame | None = None) -> DataFrame:
    """The bottom leaves with `path` to the tree's root and on through `beyond` (tree, path), and `subroot`, the tree's root."""
    ends = forest.roots.withColumnRenamed("root", "subroot")
    ends = ends.withColumn("path", F.lit(b"")) if beyond is None else ends.join(beyond.select("tree", "path"), "tree")
    ends, upper = stored(ends.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot"), "ends"), None
    for layer in reversed(forest.layers):
        above = ends  # of the trees whose last layer this is; of the others the layer above has the blocks' own paths
        if upper is not None:
            above = upper.unionByName(ends.join(upper.select("tree").distinct(), "tree", "left_anti"))
        found = sibling_paths(layer, above)
        if layer is forest.layers[0]:
            return found
        upper = stored(found.select("tree", F.col("rank").alias("block"), "path", "subroot"), "upper")


# ---- manifest -------------------------------------------------------------------------------------------------

@dataclass
class Manifest:
    """The leaves with their ranks, the forest of the sources, the tree over the sources' roots, and the root."""
    leaves: DataFrame
    forest: Forest
    top: Forest
    root: DataFrame


def build_manifest(digests: DataFrame, order: list[str], block_levels: int = BLOCK_LEVELS) -> Manifest:
    """Manifest of rows (tree, digest, and any others), ordered by `order` and then digest within a tree."""
    leaves = stored(ranked(digests, [*order, "digest"]), "leaves")
    forest = build_forest(leaves, block_levels)
    subroots = stored(forest.roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("source_tree"), F.col("root").alias("digest")), "subroots")
    top = build_forest(stored(ranked(subroots, ["source_tree"]), "top"), block_levels)
    return Manifest(leaves, forest, top, top.roots.select("root"))


def proofs(m: Manifest) -> DataFrame:
    """The leaves with `path` to the manifest's root, `subroot` and `root` (32 bytes each)."""
    beyond = all_paths(m.top).select(F.col("source_tree").alias("tree"), "path")
    return all_paths(m.forest, beyond).withColumn("root", F.lit(m.root.first()["root"]))


def manifest_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
                  chars_col: str = "n_chars", text_col: str = "text", block_levels: int = BLOCK_LEVELS,
                  tampered_text: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of `docs`.

    Nulls in any column enter the leaf as `-`; the null source is a source of
    its own and comes first; null ids come first in theirs.  Rows with equal
    ids are ordered by their leaves, so repeated rows are leaves of their own
    with interchangeable places.  Other columns are ignored; an empty table
    gives an empty result.  A source of one row is its own subroot, and with no
    sibling anywhere the proof is the hash of nothing.  `tampered_text` (null: an
    untampered row) is the text whose leaf is folded with the original siblings.
    """
    fields = [F.col(c) for c in (id_col, source_col, lang_col, chars_col)]
    changed = F.lit(None).cast("string") if tampered_text is None else tampered_text
    digests = docs.select(F.col(id_col).alias("id"), tree_name(F.col(source_col)).alias("tree"),
                          leaf_digest(*fields, F.col(text_col)).alias("digest"),
                          F.when(changed.isNotNull(), leaf_digest(*fields, changed)).alias("other"))
    digests = stored(digests, "digests")
    id_type = digests.schema["id"].dataType.simpleString()
    if digests.isEmpty():
        found = digests.select("id", "digest", "other", F.lit(b"").alias("subroot"), F.lit(b"").alias("root"), F.lit(b"").alias("path"))
    else:
        found = proofs(build_manifest(digests, ["id"], block_levels)).select("id", "digest", "other", "subroot", "root", "path")

    def judge(batches):
        for b in batches:
            out = [(leaf.hex(), sub.hex(), root.hex(), *_judged(leaf, other, root, path))
                   for leaf, other, sub, root, path in zip(*(b.column(i).to_pylist() for i in range(1, 6)))]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.string()) for c in columns[:5]], pa.array(columns[5], pa.bool_())],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    ship_package()
    rows = found.mapInArrow(judge, f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return rows.withColumnRenamed("id", id_col)


def _judged(leaf: bytes, other: bytes | None, root: bytes, path: bytes) -> tuple[str, str, bool]:
    folded, siblings = fold(leaf if other is None else other, path)
    return _h(siblings).hex(), folded.hex(), folded == root
