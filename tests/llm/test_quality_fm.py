import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgespark.llm import quality_fm as fm, queries
from lodgespark.llm.shared import fold
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    f = fm.Features()
    good = [f"calm words about topic {i} flow on and on here" for i in range(60)]
    bad = [f"BUY!! NOW!! {i}$$$ ###CLICK### {i} !!!" for i in range(60)]
    return fm.fit([(*f(t), 1) for t in good] + [(*f(t), 0) for t in bad], f)


def test_linear_time_sum_is_the_sum_over_pairs(model):
    at, value = model.features("some words of mine, words!")
    x = model.scaled(at, value)
    pairs = sum(model.factors[a] @ model.factors[b] * p * q for (a, p), (b, q) in itertools.combinations(list(zip(at, x)), 2))
    assert np.isclose(model.margin(at, x), model.bias + model.linear[at] @ x + pairs)


def test_gradient_descends(model):
    assert model.score("calm words about topic 99 flow on") > 0.5 > model.score("BUY!! NOW!! 7$$$ ###CLICK### !!!")


def test_same_sample_same_model():
    f = fm.Features()
    rows = [(*f(t or ""), k % 2) for k, t in enumerate(EDGE_TEXTS)]
    a, b = fm.fit(rows, f), fm.fit(rows, fm.Features())
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_edges(spark, model):
    docs = documents(spark)
    got = {r.doc_id: r.s for r in docs.select("doc_id", fm.scorer(model)(F.col("text")).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[0] == got[1] and got[4] == got[5]
    labels = spark.createDataFrame([(0, 1), (4, 0), (4, 1), (None, 1), (5, None), (99, 1)], "doc_id long, quality int")
    assert 0 <= fm.learn(docs, labels, F.lit(True)).score("x") <= 1
    empty = fm.learn(documents(spark, []), labels.limit(0), F.lit(True))
    assert abs(empty.score("anything") - 0.5) < 0.01


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op9_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = got.join(labels, "doc_id").where("held_out").toPandas()
    assert held.doc_id.map(lambda i: True).all() and (held.predicted == (held.score >= 0.5)).all()
    assert (held.predicted == held.quality).mean() > 0.97
    n = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == n.count()
    assert got.where("held_out").count() == n.where(fold(F.col("doc_id"), 3) == 1).count()
