import numpy as np
import pytest

from lodgespark.llm import queries, whitening

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("a", [
    np.cov(np.random.default_rng(1).standard_normal((40, 300))), np.eye(5) * 3, np.diag([5.0, 5, 5, 1, 1, 0]), np.ones((8, 8)), np.zeros((4, 4)),
    np.array([[2.0]]), np.diag([1, 1 + 1e-13, 2, 3.0]), np.diag([-2.0, 0, 3, 0, 1]), np.diag(10.0 ** np.arange(-8, 8)),
], ids=["random", "equal", "repeated", "rank1", "zero", "one", "close", "signs", "graded"])
def test_components_against_an_eigensolver(a):
    values, vectors = whitening.components(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * scale * len(a)
    assert np.abs(vectors @ vectors.T - np.eye(len(a))).max() < 1e-13 * len(a)
    assert np.abs(vectors.T * values @ vectors - a).max() <= 1e-13 * scale * len(a)


def test_polar_factor_is_orthogonal_and_leaves_a_definite_part():
    a = np.random.default_rng(2).standard_normal((30, 30))
    a = a + a.T
    u = whitening.polar_factor(a)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-12
    assert np.linalg.eigvalsh((u @ a + a @ u) / 2).min() > 0


def brute(vectors, most=32):
    """(deviations, whitened up to sign, explained) by numpy's eigensolver."""
    x = np.floor(64 * np.array(vectors, float)).astype(object).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-12 * e[0]).sum()))
    return ((n * x - s) ** 2).sum(axis=1), z @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v)


def check(rows, ids, vectors, most=32):
    dev, y, share = brute(vectors, most)
    k = y.shape[1]
    assert len(rows) == len(ids) * k
    table = {(r[0], r["component"]): r for r in rows}
    signs = np.sign([sum(table[i, c + 1]["whitened"] * y[a, c] for a, i in enumerate(ids)) for c in range(k)])
    for a, i in enumerate(ids):
        for c in range(k):
            r = table[i, c + 1]
            assert r["n"] == len(ids) and r["deviation"] == dev[a]
            assert abs(r["whitened"] - signs[c] * y[a, c]) < 1e-7 and abs(r["explained"] - share[c]) < 1e-9 and r["identity_error"] < 1e-9


def test_query_against_an_eigensolver(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = queries.QUERIES["op13_embedding_whitening"](spark, SF)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


SCHEMA = "vec_id long, embedding array<float>, component string, y string"


def test_edges(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(np.float32(v)) for v in rng.standard_normal(3) * 5]) for i in range(20)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [0.0, float("-inf"), 0.0]), (104, []), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "c", "y") for r in good + bad], SCHEMA).repartition(4)
    check(whitening.whiten(df).collect(), [i for i, _ in good], [v for _, v in good])
    assert {r["component"] for r in whitening.whiten(df, most=2).collect()} == {1, 2}


def test_constant_dimensions_have_no_component(spark):
    rows = [(i, [float(i), 7.0, float(-2 * i)]) for i in range(10)]
    got = whitening.whiten(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)).collect()
    check(got, [i for i, _ in rows], [v for _, v in rows])
    assert {r["component"] for r in got} == {1}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0, 4.0])] * 4])
def test_no_variance_gives_no_rows(spark, rows):
    got = whitening.whiten(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_repeated_rows_null_ids_and_whole_numbers(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (1, [0.0, 5.0]), (1, [0.0, 5.0]), (2, [-1.0, 1.0])], "id long, v array<double>")
    got = whitening.whiten(df, "id", "v").collect()
    assert sorted(str(r["id"]) for r in got) == ["1"] * 4 + ["2"] * 2 + ["None"] * 2
    ints = spark.createDataFrame([(1, [1, 2]), (2, [3, 1]), (3, [4, 4])], "id long, v array<int>")
    check(whitening.whiten(ints, "id", "v").collect(), [1, 2, 3], [[1, 2], [3, 1], [4, 4]])


def test_entries_beyond_64_bits_end_the_job(spark):
    df = spark.createDataFrame([(1, [1e300]), (2, [0.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        whitening.whiten(df, "id", "v").collect()
