import numpy as np
import pytest

import corpus_pipeline
from lodgespark.llm import lang_id
from lodgespark.llm.shared import fold
from pyspark.sql import functions as F
from tests.llm.helpers import documents
from tests.llm.test_exact_dedup import brute as exact_groups
from tests.llm.test_simhash import brute_fingerprint
from tests.llm.helpers import components

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    # language: each text by itself, one by one
    one = stages["language_id"](spark, docs, SF)
    model = lang_id.learn(docs, fold(F.col("doc_id"), 4) != 2)
    assert ids(one) == {r.doc_id for r in docs.collect() if not model.predict(r.text)[3]}
    # exact copies
    two = stages["exact_dedup"](spark, one, SF)
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert ids(two) == {i for i, keep, *_ in exact_groups(rows) if i == keep}
    # near copies: all pairs
    three = stages["simhash_near_dedup"](spark, two, SF)
    rows = sorted((r.doc_id, r.text) for r in two.collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    assert ids(three) == {rows[c][0] for c in comp}
    # mixing: no row twice, none changed
    four = stages["mixing"](spark, three, SF)
    assert four.count() == len(ids(four)) and ids(four) <= ids(three)
    for df in (one, two, three, four):
        assert df.columns == docs.columns
    assert four.join(docs, docs.columns, "left_anti").count() == 0
    # pieces: lossless
    five = stages["sentencepiece"](spark, four, SF)
    assert ids(five) == ids(four) and five.where("not lossless").count() == 0
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, five.collect()))


@pytest.mark.parametrize("texts", [[], ["words of one text here", "words of one text here", None, "", "12 34"]])
def test_small_and_empty_tables(spark, tmp_path, texts):
    documents(spark, texts).withColumn("lang", F.lit("en")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (None, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [r.doc_id for r in got.collect()] == ([0] if texts else [])


def test_mixing_tells_the_shares_it_reaches(spark, tmp_path, monkeypatch):
    rows = [(i, "good calm words here" if i % 4 else "bad noise there now", "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(i, int(i % 4 > 0), 0) for i in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = []
    mix = corpus_pipeline.mixing.mix
    monkeypatch.setattr(corpus_pipeline.mixing, "mix", lambda *a, **k: found.append(mix(*a, **k)) or found[-1])
    with pytest.warns(UserWarning, match="miss the target shares: q0t0 .* for 0.0208, q1t0 .* for 0.9792"):
        corpus_pipeline.mixing_stage(spark, docs, str(tmp_path))
    rates, domains = found[0]
    p, n, rate = (rates.toPandas()[c].to_numpy() for c in (["p0", "p1"], "n_tokens", "rate"))
    mass, share = p * n[:, None], np.array([0.02, 0.94]) / 0.96
    target, best = n.sum() * share, np.ones(len(n))
    width = np.maximum(target, mass.sum(0))
    for _ in range(3000):
        best = np.clip(best - p @ ((mass.T @ best - target) / width), 0, 1)
    assert domains == ["q0t0", "q1t0"] and rates.fit.converged and rate.max() <= 1
    assert np.allclose(mass.T @ rate, mass.T @ best, rtol=1e-3, atol=1e-3 * n.sum())
    assert np.allclose(list(rates.fit.tokens.values()), mass.T @ rate)


def test_sql_is_declared():
    assert corpus_pipeline.ORACLE_SQL is None
