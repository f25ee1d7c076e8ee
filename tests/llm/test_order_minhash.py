import hashlib
import random
import re

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from lodgespark.llm import order_minhash as omh, queries
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.001"
TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|(?:(?![\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}])[\p{L}\p{M}\p{N}]){1,16}|[^ \t\n\x0b\f\r]")


def chained(parts):
    """Spark's xxhash64 of several values: each hash is the next one's seed."""
    h = 42
    for p in parts:
        if isinstance(p, str):
            h = xxhash.xxh64_intdigest(p.encode(), h)
        else:
            size = 4 if isinstance(p, tuple) else 8
            v = p[0] if isinstance(p, tuple) else p
            h = xxhash.xxh64_intdigest((v & (1 << 8 * size) - 1).to_bytes(size, "little"), h)
    return h - (1 << 64) if h >> 63 else h


def brute(text):
    tokens = [m.group() for m in TOKEN.finditer(text or "")]
    kmers = [tokens[i:i + omh.KMER] for i in range(len(tokens) - omh.KMER + 1)] if len(tokens) >= omh.KMER else [tokens] if tokens else []
    seen, numbered = {}, []
    for k in kmers:
        h = chained(k)
        n = seen[h] = seen.get(h, -1) + 1
        numbered.append(h if n == 0 else chained([h, n]))
    out = []
    for r in range(omh.REPEATS):
        mask = r << (64 - omh.CLASS_BITS)
        mask -= (mask >> 63) << 64
        chosen = set(sorted(set(numbered), key=lambda x: x ^ mask)[:omh.TUPLE])
        out.append(chained([x for x in dict.fromkeys(numbered) if x in chosen]))
    return out


def test_signatures_against_brute_force(spark):
    rng = random.Random(3)
    words = "the of and to in is was with that this".split()
    texts = EDGE_TEXTS + [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 3, 10, 60, 120, 400, 3000)]
    texts += [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n)) for n in (5, 50, 100, 1000)] + ["東京 tower ラーメン x", "a-b, c!"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: list(r.s) for r in omh.signatures(df, "t", "s").select("i", "s").collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t), (i, (t or "")[:40])


def test_likeness_sees_order(spark):
    rng = random.Random(9)
    blocks = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(10)]
    moved = blocks[5:] + blocks[:5]
    edited = blocks[:9] + ["nothing of the kind"]
    df = spark.createDataFrame([(" ".join(blocks), " ".join(moved), " ".join(edited))], "a string, b string, c string")
    for x in "abc":
        df = omh.signatures(df, x, f"s{x}")
    r = df.select(omh.likeness(F.col("sa"), F.col("sa")).alias("same"), omh.likeness(F.col("sa"), F.col("sb")).alias("moved"),
                  omh.likeness(F.col("sa"), F.col("sc")).alias("edited")).first()
    assert r.same == 1.0 and r.edited > r.moved > 0.1


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        f = len(t) // 3
        yield i, len(t), t[:len(t) - f] + nxt[:f], nxt


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_next_in_descending_order(spark, buckets):
    rng = random.Random(buckets)
    rows = [(i, f"text {i} " * rng.randint(0, 5)) for i in rng.sample(range(-500, 10**9), 60)] + [(77, "b"), (77, "a"), (None, "n")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(5)
    got = sorted(((r.id, r.text, r.nxt) for r in omh.with_next(df, "id", {"text": "nxt"}, "text", buckets).collect()), key=str)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted(((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)), key=str)
    assert got == want


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op2_order_minhash"](spark, SF).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for k, (i, n, edited, nxt) in enumerate(expected(docs)):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        if k % 9 == 0:
            own = brute(dict(docs)[i])
            like = lambda a, b: sum(x == y for x, y in zip(a, b)) / omh.REPEATS
            assert r.fingerprint == "".join(f"{x & 0xFFFFFFFF:08x}" for x in own)
            assert (r.near_edited, r.near_next) == (like(own, brute(edited)), like(own, brute(nxt)))


def test_edges(spark):
    rows = omh.fingerprint_with_edits(documents(spark)).collect()
    assert len(rows) == len(EDGE_TEXTS) and all(re.fullmatch("[0-9a-f]{256}", r.fingerprint) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[4].fingerprint == by[5].fingerprint and by[0].fingerprint == by[1].fingerprint == by[2].fingerprint
    assert omh.fingerprint_with_edits(documents(spark, [])).count() == 0
    (one,) = omh.fingerprint_with_edits(documents(spark, ["abc def"])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()
    assert omh.fingerprint_with_edits(documents(spark, ["x", "y"], [None, None])).count() == 2


def test_texts_cross_once_and_no_python(spark):
    plan = omh.fingerprint_with_edits(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan and "Python" not in plan
