import random

import pytest
from pyspark.sql import functions as F

from lodgespark.llm import lang_id, queries
from lodgespark.llm.shared import fold
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.01"
WORDS = {"xx": "kala mina toru sepi lano", "yy": "whrt brnkd strmp qwzz vlkt"}


def made(lang, n, seed):
    rng = random.Random(seed)
    words = WORDS[lang].split()
    return " ".join(rng.choice(words) + rng.choice(["", rng.choice(words)]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, made(lang, 40, i), lang) for i in range(60) for lang in WORDS] + [(900, "nothing", None), (901, None, "xx"), (902, "123", "zz")]
    return lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def test_model_is_bounded_and_learns_only_from_letters(model):
    assert set(model.pieces) == set(WORDS)
    assert all(len(p) <= lang_id.PIECE_CHARS for ps in model.pieces.values() for p in ps)


def test_sizes_decide(model):
    for lang in WORDS:
        for n in (8, 200, 6000):
            text = made(lang, n, 1000 + n)
            got = model.predict(text)
            raw = lang_id.letters(text).encode()
            blocks = [raw[i:i + model.block_bytes] for i in range(0, len(raw), model.block_bytes)]
            sizes = {name: sum(len(c.compress(b)) for b in blocks) for name, c, _ in model.coders()}
            assert got[0] == lang == min(sizes, key=sizes.get) and not got[3] and 0.5 < got[1] <= 1
    assert model.predict(made("xx", 30, 1).upper() + "!!") [0] == "xx"


def test_edges(spark, model):
    docs = documents(spark)
    rows = docs.select("doc_id", lang_id.identify(model)(F.col("text")).alias("p")).orderBy("doc_id").collect()
    for r, text in zip(rows, EDGE_TEXTS):
        if not lang_id.has_letter(text):
            assert tuple(r.p) == ("und", 0.0, 0.0, True)
        else:
            assert r.p.lang_pred in WORDS and 0 <= r.p.score <= 1
    assert rows[4].p == rows[5].p
    assert lang_id.drop_undetermined(docs, model).columns == docs.columns
    assert lang_id.drop_undetermined(documents(spark, []), model).count() == 0


def test_no_letter_means_no_unicode_letter():
    assert not lang_id.has_letter("123 ²½ ①_ !?") and lang_id.has_letter("1é") and lang_id.has_letter("語") and not lang_id.has_letter(None)


def test_mixture_is_rejected_when_the_margin_is_narrow(model):
    strict = lang_id.LanguageModel(model.pieces, min_margin=0.5)
    assert strict.predict(made("xx", 50, 3) + " " + made("yy", 50, 3))[3]


def test_nothing_learnt(spark):
    none = lang_id.learn(documents(spark, []), F.lit(True))
    assert none.predict("some words") == ("und", 0.0, 0.0, True)


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op1_language_id"](spark, SF).drop("rejected").toPandas()
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", (fold(F.col("doc_id"), 4) == 2).alias("h")).toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth) and (both.held_out == both.h).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
