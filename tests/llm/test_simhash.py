import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from lodgespark.llm import simhash
from lodgespark.llm.components import connected_components
from tests.llm.helpers import ascii_words, components, documents


def brute_fingerprint(text):
    words = ascii_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for t in [None, "", " \n", "One", "One two", "one two three", "É Ä one TWO É Ä one", "a b c a b c a b c", "x y " * 40000]:
        assert simhash.simhash(t) == brute_fingerprint(t)


@pytest.mark.parametrize("radius", [1, 2])
def test_masks_cover_every_pair_in_reach(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(64), radius):
        diff = sum(1 << b for b in bits)
        assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("radius", [1, 2])
def test_links_against_brute_force(spark, radius):
    rng = random.Random(radius)
    values = [0, (1 << 64) - 1, 1 << 63, 1]
    for _ in range(40):  # clouds around random centres, some dense
        c = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 30])):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            values.append(x)
    values = sorted(set(values))
    links = [(i, j) for i, j in itertools.combinations(range(len(values)), 2) if (values[i] ^ values[j]).bit_count() <= radius]
    want = components(len(values), links)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    got = {r.node: r.component for r in connected_components(simhash.near_links(df, radius)).collect()}
    place = {simhash._signed(v): i for i, v in enumerate(values)}
    groups = {}
    for v, i in place.items():
        groups.setdefault(got.get(v, v), set()).add(i)
    expect = {}
    for i, c in enumerate(want):
        expect.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200, 300)] + [(0, i) for i in range(1, 80)] + [(400, 400), (None, 3), (500, 501), (501, 500), (500, 501)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 200 for i in range(200, 301)}, **{i: 0 for i in range(80)}, 500: 500, 501: 500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        words = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 99)) for _ in range(200)]
        for _ in range(4):
            w = list(words)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(200)] = "changed"
            texts.append(" ".join(w))
    texts += [None, "", " ", "Hello there", "hello THERE"]
    ids = rng.sample(range(1000), len(texts))
    docs = documents(spark, texts, ids)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicate_components(docs).collect()}
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    fps = [brute_fingerprint(texts[k]) for k in order]
    comp = components(len(fps), [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2])
    assert got == {ids[k]: (f"{fps[i]:016x}", ids[order[comp[i]]]) for i, k in enumerate(order)}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got.values()})


def test_nulls_repeats_and_empty_tables(spark):
    docs = documents(spark, ["a b c", "a b c", "a b c", None, "q"], [4, 4, None, None, 9])
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicate_components(docs).collect())
    assert got == [("4", "4"), ("4", "4"), ("9", "9"), ("None", "4"), ("None", "None")]
    assert sorted(str(r.doc_id) for r in simhash.drop_near_copies(docs).collect()) == ["4", "9", "None", "None"]
    assert simhash.near_duplicate_components(documents(spark, [])).count() == 0


def test_no_pairs_and_no_python_beside_the_fingerprint(spark):
    plan = simhash.near_links(spark.range(10).select(F.col("id").alias("fp")))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
