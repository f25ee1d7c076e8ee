import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgespark.llm import merkle, queries
from tests.llm.helpers import EDGE_TEXTS

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def fold_up(digests, members):
    """(root, steps of every member), by lists of whole levels."""
    steps = {m: [] for ms in members for m in ms}
    nodes = list(zip(digests, members))
    while len(nodes) > 1:
        above = []
        for a in range(0, len(nodes), 3):
            run = nodes[a:a + 3]
            for k, (_, ms) in enumerate(run):
                for m in ms:
                    steps[m].append((k, [d for d, _ in run[:k] + run[k + 1:]]))
            above.append((h(*[d for d, _ in run]), [m for _, ms in run for m in ms]))
        nodes = above
    return nodes[0][0], steps


def brute(rows, tampered=lambda r: None):
    leaves, sources = [leaf_of(r) for r in rows], {}
    for i, r in enumerate(rows):
        sources.setdefault(r[1], []).append(i)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    subroots, steps, of_row = [], {}, {}
    for s in order:
        ids = sorted(sources[s], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        root, found = fold_up([leaves[i] for i in ids], [[i] for i in ids])
        subroots.append(root)
        steps.update(found)
        of_row.update(dict.fromkeys(ids, root))
    root, top = fold_up(subroots, [[s] for s in order])
    out = []
    for i, r in enumerate(rows):
        path, new = steps[i] + top[r[1]], tampered(r)
        node = leaves[i] if new is None else leaf_of((*r[:4], new))
        for k, others in path:
            node = h(*others[:k], node, *others[k:])
        out.append((r[0], leaves[i], of_row[i], root, h(*[d for _, others in path for d in others]), node, node == root))
    return out


def same(got, want):
    return sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 7, 8])
def test_layout_is_recursive_and_complete(levels):
    rows = merkle.layout(levels)
    assert sorted(np.concatenate(rows).tolist()) == list(range(merkle.subtree_size(levels)))
    if levels > 1:  # the upper half first, then each lower part in one piece
        upper = levels // 2
        assert max(a for row in rows[:upper] for a in row) == merkle.subtree_size(upper) - 1
        size, wide = merkle.subtree_size(levels - upper), 3 ** (levels - 1 - upper)
        for part in range(3 ** upper):
            bottom = rows[-1][part * wide:(part + 1) * wide] - merkle.subtree_size(upper) - part * size
            assert bottom.tolist() == merkle.layout(levels - upper)[-1].tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27])
def test_block_and_paths_against_whole_levels(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    up = merkle.levels_above(n)
    nodes = merkle.build_block(leaves, up)
    root, steps = fold_up([d.hex() for d in leaves], [[i] for i in range(n)])
    assert nodes[:32].hex() == root
    for i in range(n):
        got, siblings = merkle.fold(leaves[i], merkle.sibling_path(nodes, n, up, i))
        assert got.hex() == root and [s.hex() for s in siblings] == [d for _, others in steps[i] for d in others]


@pytest.mark.parametrize("block_levels", [1, 2, 7])
def test_edges(spark, block_levels):
    rows = [(i if i % 7 else None, [None, "", "a", "é", "hot", "hot", "hot"][i % 7], ["en", None][i % 2], len(t or "") or None, t)
            for i, t in enumerate(EDGE_TEXTS * 4)]
    rows += [rows[5]] * 5 + [(3, "lone", None, None, None)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], COLUMNS + ", leaf string, rank int").repartition(3)
    tampered = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    got = merkle.manifest_rows(docs, block_levels=block_levels, tampered_text=tampered).collect()
    assert same(got, brute(rows, lambda r: r[4].replace("\n", "") if r[0] is not None and r[0] % 3 == 0 and r[4] is not None else None))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "a", "en", 1, "x"), (1, "b", "en", 1, "x")]])
def test_none_one_and_two_trees(spark, rows):
    got = merkle.manifest_rows(spark.createDataFrame(rows, COLUMNS)).collect()
    assert same(got, brute(rows) if rows else [])


def test_ranks_do_not_depend_on_the_ranges(spark):
    rows = spark.createDataFrame([("a" if i % 3 else "b", i % 11, i) for i in range(200)], "tree string, k int, v int")
    want, seen = {}, {"a": 0, "b": 0}
    for t, k in sorted((r["tree"], r["k"]) for r in rows.collect()):
        want.setdefault((t, k), []).append(seen[t])
        seen[t] += 1
    for parts in (1, 5, 40):
        got = {}
        for r in merkle.ranked(rows, ["k"], parts).collect():
            got.setdefault((r["tree"], r["k"]), []).append(r["rank"])
        assert {x: sorted(v) for x, v in got.items()} == want


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = queries.QUERIES["op12_merkle_manifest"](spark, SF)
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    tampered = lambda r: r[4].replace("\n", "") if zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None else None
    assert same(got.collect(), brute(rows, tampered))
