import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lodgespark.llm import exact_dedup, queries
from lodgespark.llm.oracle import ORACLE_SQL
from tests.llm.helpers import documents

SF = "/root/testdata/sf0.001"


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
            first = False
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("key", [exact_dedup.chunk_key, lambda c: F.length(c) % 3, lambda c: F.lit(0)], ids=["hash", "weak", "constant"])
def test_groups_whatever_the_chunk_key(spark, key):
    texts = ["a b", "a\t\nb", None, "", " ", "x " * 2000, "x  " * 2000, "x " * 1999 + "y ", "a b", "long " * 900 + "end", "long " * 900 + "eNd"]
    ids = [5, 3, 9, 8, 10, 11, 12, 13, 5, None, 15]
    got = exact_dedup.exact_groups(documents(spark, texts, ids), key=key)
    assert rows_of(got) == sorted(brute(zip(ids, texts)), key=str)


def test_chunks_concatenate_and_follow_content(spark):
    import random
    rng = random.Random(4)
    words = ["the", "sea", "an", "of", "light", "no", "edge", "ton", "3k", "Öl"]
    body = " ".join(rng.choice(words) for _ in range(3000))
    df = spark.createDataFrame([(body,), ("Another beginning: " + body,), ("",)], "t string")
    a, b, none = (r[0] for r in df.select(exact_dedup.chunks(F.col("t"))).collect())
    assert "".join(a) == body and none == []
    assert all(256 <= len(c) <= 2048 for c in a[:-1])
    assert len(set(a) & set(b)) > len(a) / 2


def test_empty_table(spark):
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0
    assert exact_dedup.drop_exact_copies(documents(spark, [])).count() == 0


def test_rows_that_stay_keep_their_columns(spark):
    docs = documents(spark, ["a b", "a  b", "c", "c", None, ""], [2, 1, 7, 7, None, None])
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    assert got == [(-1, ""), (1, "a  b"), (7, "c")]


def test_query_against_sql(spark):
    got = queries.QUERIES["op7_exact_dedup"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op7_exact_dedup"]).df().sort_values("doc_id").reset_index(drop=True)
    assert got.astype(str).equals(want[got.columns].astype(str))


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6, "x"), (2, "a", 7, 8, "z"), (3, "b", 9, 1, None)], "doc_id long, text string, __key int, sha int, `a.b` string")
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a", 5, 6, "x"), (3, "b", 9, 1, None)]
