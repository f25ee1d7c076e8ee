import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgespark.llm import mixing, queries
from lodgespark.llm.shared import stored
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.01"


def members(spark, n=300, k=3, seed=1):
    rng = np.random.default_rng(seed)
    p, tokens = rng.dirichlet([0.3] * k, n), rng.integers(0, 500, n)
    rows = [(int(i), int(i), int(t), *map(float, q)) for i, (t, q) in enumerate(zip(tokens, p))]
    return stored(spark.createDataFrame(rows, "id long, text_key long, n_tokens long, " + ", ".join(f"p{i} double" for i in range(k))), "m"), p, tokens


@pytest.mark.parametrize("cap", [None, 1.0])
def test_rates_against_numpy(spark, cap):
    m, p, tokens = members(spark)
    weights = {"a": 0.6, "b": 0.3, "c": 0.1}
    got = mixing.fit_rates(m, ["a", "b", "c"], weights, max_rate=cap).orderBy("id").toPandas().rate.to_numpy()
    mass = p * tokens[:, None]
    s0, r = mass.sum(0), np.ones(len(p))
    target = s0.sum() * np.array([0.6, 0.3, 0.1])
    width = np.maximum(s0, target)
    for _ in range(3000):
        r = np.clip(r - p @ ((mass.T @ r - target) / width), 0, cap or np.inf)
    loss = lambda x: (((mass.T @ x - target) ** 2) / width).sum()
    assert (got >= 0).all() and (cap is None or got.max() <= cap)
    assert loss(got) <= loss(r) * 1.01 + 1e-3 * s0.sum()
    if cap is None:
        assert np.allclose(mass.T @ got, target, rtol=2e-3)


def test_flat_posteriors_reach_the_targets(spark):
    rng = np.random.default_rng(5)
    base = np.array([0.76, 0.16, 0.05, 0.03])
    p, tokens = rng.dirichlet(20 * base, 2000), rng.integers(1, 500, 2000)
    rows = [(int(i), int(i), int(t), *map(float, q)) for i, (t, q) in enumerate(zip(tokens, p))]
    m = stored(spark.createDataFrame(rows, "id long, text_key long, n_tokens long, p0 double, p1 double, p2 double, p3 double"), "m")
    weights = {"a": 0.85, "b": 0.09, "c": 0.04, "d": 0.02}
    got = mixing.fit_rates(m, list("abcd"), weights)
    rate = got.orderBy("id").toPandas().rate.to_numpy()
    target = tokens.sum() * np.array(list(weights.values()))
    assert got.fit.converged and (rate >= 0).all()
    assert np.allclose((p * tokens[:, None]).T @ rate, target, rtol=1e-3)
    with pytest.warns(UserWarning, match="not fitted"):
        assert not mixing.fit_rates(m, list("abcd"), weights, max_steps=2).fit.converged


def test_impossible_and_empty_targets(spark):
    m, *_ = members(spark, 50, 2)
    assert mixing.fit_rates(m, ["a", "b"], {}).agg(F.min("rate"), F.max("rate")).first()[0] == 1.0
    lone = mixing.fit_rates(m, ["a", "b"], {"a": 1.0}).agg(F.min("rate").alias("r")).first().r
    assert lone >= 0


def test_memberships_against_python(spark):
    docs = documents(spark, ["good calm words", "good words too", "bad noise!!", "BAD noise noise!!", "good noise", None, ""], extra=False)
    labels = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y"), (3, "y"), (None, "x"), (4, None)], "doc_id long, domain string")
    model = mixing.learn(docs, labels)
    assert model.domains == ["x", "y"]
    table = {r.bucket: r.evidence for r in model.table.collect()}
    got = {r.id: r for r in mixing.memberships(docs, model).collect()}
    for r in docs.select("doc_id", "text", F.transform(mixing.words(F.col("text")), lambda w: F.array(
            mixing.word_bucket(w), mixing.shape_bucket(w))).alias("b")).collect():
        m = len(r.b)
        logit = [model.prior[i] + sum(table.get(b, [0, 0])[i] for pair in r.b for b in pair) * mixing.SOFT_WORDS / (mixing.SOFT_WORDS + m) for i in (0, 1)]
        want = np.exp(logit) / np.exp(logit).sum()
        assert np.allclose([got[r.doc_id].p0, got[r.doc_id].p1], want)
        assert got[r.doc_id].n_tokens == len((r.text or "").split())
    assert got[0].p0 > 0.5 > got[3].p0


def test_draw(spark):
    docs = documents(spark, ["a", "b", "c", "c", None, "f"], [1, 2, 3, 3, None, 6])
    keys = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    rates = keys.withColumn("rate", F.when(F.col("id") == 1, 0.0).when(F.col("id") == 6, 2.0).otherwise(1.0))
    got = mixing.draw(docs, rates)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["2", "3", "3", "6", "6", "None"]
    half = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rate = half.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), F.lit(0.3).alias("rate"))
    first, second = (sorted(r.doc_id for r in mixing.draw(x, rate).collect()) for x in (half, half.repartition(7)))
    assert first == second and 500 < len(first) < 700


def test_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, domain string")
    rates, domains = mixing.mix(documents(spark), labels, {"x": 1.0})
    assert domains == [] and rates.count() == len(EDGE_TEXTS) and rates.agg(F.min("rate")).first()[0] == 1.0
    some = spark.createDataFrame([(4, "x"), (7, "y")], "doc_id long, domain string")
    rates, _ = mixing.mix(documents(spark), some, {"x": 0.5, "y": 0.5})
    assert rates.count() == len(EDGE_TEXTS) and rates.where("rate < 0 or rate is null").count() == 0
    rates, _ = mixing.mix(documents(spark, []), some, {"x": 1.0})
    assert rates.count() == 0


def test_a_rare_domain_keeps_its_target(spark):
    docs = spark.createDataFrame([(i, "rare odd talk" if i == 77 else "good calm words" if i % 2 else "bad noise here") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, "rare" if i == 77 else "a" if i % 2 else "b") for i in range(400)], "doc_id long, domain string")
    model = mixing.learn(docs, labels, sample_docs=20)
    assert model.domains == ["a", "b", "rare"] and np.allclose(np.exp(model.prior), [199 / 400, 0.5, 1 / 400])
    rates, domains = mixing.mix(docs, labels, {"a": 0.4, "b": 0.4, "rare": 0.2})
    assert domains == ["a", "b", "rare"] and rates.fit.target["rare"] / sum(rates.fit.target.values()) == pytest.approx(0.2)
    with pytest.warns(UserWarning, match="without a label: none"):
        mixing.mix(docs, labels, {"a": 0.5, "none": 0.5})


def test_draw_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6, "x.y"), (2, "b", 7, 8, "z")], "doc_id long, text string, __text int, row int, `a.b` string")
    rates = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), F.lit(1.0).alias("rate"))
    got = mixing.draw(docs, rates)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


def test_query_meets_the_targets(spark):
    got = queries.QUERIES["op6_mixing"](spark, SF).toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and (got.rate >= 0).all()
    names = [c for c in got.columns if c.startswith("p_")]
    assert np.allclose(got[names].sum(1), 1)
    start = {c: (got[c] * got.n_tokens).sum() for c in names}
    for c in names:
        target = queries.TARGET_WEIGHTS[c[2:]] * got.n_tokens.sum()
        if start[c] > 0.01 * got.n_tokens.sum():
            assert abs((got.rate * got[c] * got.n_tokens).sum() / target - 1) < 0.1


def test_no_python(spark):
    model = mixing.DomainModel(["x"], [0.0], spark.createDataFrame([(1, [0.5])], "bucket int, evidence array<double>"))
    plan = mixing.memberships(documents(spark), model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
