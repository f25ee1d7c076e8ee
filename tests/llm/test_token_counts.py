import pytest
from tokenizers import Tokenizer

from lodgespark.llm import queries, token_counts
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.001"
AWKWARD = ["a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "é ́x", "!\x1c! \x85 ! ! a b", "it's THEY'LL 'd", "日本語" * 400,
           "１２ 3²", "\x00 \x01", "Σας ΟΔΟΣ İ", "a\x0b\x0cb\r\nc", "​᠎", "🎉" * 70]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(token_counts.tokenizer_path())
    return lambda text: len(t.encode(text or "", add_special_tokens=False))


def test_counts_are_the_librarys(spark, library):
    texts = EDGE_TEXTS + AWKWARD
    ids = [None, None, *range(len(texts) - 2)]
    got = token_counts.token_counts(documents(spark, texts, ids), limit=100).collect()
    want = [(i, len((t or "").encode()), library(t), library(t) > 100) for i, t in zip(ids, texts)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("entries,cache", [(1, 0), (1000, 5)])
def test_small_tables_change_nothing(library, entries, cache):
    texts = [t.encode() if t is not None else None for t in EDGE_TEXTS + AWKWARD]
    table = token_counts.packed_table(["the", "same"][:entries], token_counts.tokenizer_path())
    lengths = token_counts.PieceLengths(token_counts.tokenizer_path(), table, cache)
    for _ in range(2):
        assert lengths.counts(iter(texts)) == [library((t or b"").decode()) for t in texts]
    assert len(lengths) <= len(lengths.table) + max(cache, 0)


def test_long_texts_are_cut_at_space_and_counted_whole(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 50)
    text = "word, and  others.\n" * 40 + "x" * 500 + " tail" * 30
    lengths = token_counts.PieceLengths(token_counts.tokenizer_path(), (b"", b""))
    assert lengths.counts(iter([text.encode(), None, b"a"])) == [library(text), 0, 1]
    assert b"".join(token_counts._parts(text.encode(), 50)) == text.encode()


def test_frequent_pieces_are_the_frequent_ones(spark):
    docs = spark.createDataFrame([("a a a b\tb c " + "y" * 100,), (None,), ("a b",)], "text string")
    assert token_counts.frequent_pieces(docs, entries=2) == ["a", "b"]
    assert token_counts.frequent_pieces(docs.where("false")) == []


def test_frequent_pieces_with_empty_partitions(spark):
    docs = spark.createDataFrame([("a a a b\tb c",), (None,), ("a b",)], "text string").repartition(3)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # no coalescing of empty partitions
    try:
        assert token_counts.frequent_pieces(docs, entries=2) == ["a", "b"]
        assert token_counts.frequent_pieces(docs.where("false")) == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_empty_table(spark):
    assert token_counts.token_counts(documents(spark, [])).collect() == []


def test_query_against_the_library_on_every_row(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op11_token_counts"](spark, SF)
    assert got.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = library(docs[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((docs[r["doc_id"]] or "").encode()), n, n > 2048)


def test_no_piece_is_shuffled(spark):
    plan = token_counts.token_counts(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
