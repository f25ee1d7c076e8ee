"""Whitening of embeddings by spectral divide and conquer on polar decompositions.

Tasks sum the vectors and their centred outer products; only dimension-sized
sums reach the driver.  There the covariance is split without an eigensolver:
the polar factor U of the covariance less a shift (QDWH iterations of Nakatsukasa
and Higham: dynamically weighted Halley steps by QR, or Cholesky once well
conditioned) gives the projector (U + I) / 2 on the space of the eigenvalues above
the shift; bases of it and of its complement split the matrix in two, and each
part is split again until single components remain.  The whitening matrix is
broadcast (COMPONENTS * MAX_DIM doubles at most, 256 KB) and applied by the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .shared import ship_package

#: Entries become whole numbers: floor(SCALE * c) + OFFSET.  Components returned, and the largest dimension taken.
SCALE, OFFSET, COMPONENTS, MAX_DIM = 64, 1_000_000, 32, 1024
#: Share of the largest eigenvalue up to which a component counts as absent, spread (of the matrix's norm) up to which
#: eigenvalues count as one, and how far the polar factor may be from an involution.
ABSENT, SAME, INVOLUTION = 1e-12, 1e-15, 1e-9


# ---- QDWH ------------------------------------------------------------------------------------------------------

def polar_factor(a: np.ndarray, most: int = 12) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    d = len(a)
    eye, norm = np.eye(d), np.linalg.norm(a)
    x, low = a / norm, 1e-16  # low: bound from below of x's singular values
    for _ in range(most):
        q = np.cbrt(4 * (1 - low * low) / low ** 4)
        h = np.sqrt(1 + q) + 0.5 * np.sqrt(8 - 4 * q + 8 * (2 - low * low) / (low * low * np.sqrt(1 + q)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        if c > 100:  # badly conditioned: inverse-free step by QR
            z = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            new = b / c * x + (h - b / c) / np.sqrt(c) * z[:d] @ z[d:].T
        else:
            r = np.linalg.cholesky(eye + c * x.T @ x)
            new = b / c * x + (h - b / c) * np.linalg.solve(r.T, np.linalg.solve(r, x.T)).T
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * low * low) / (1 + c * low * low))
        moved, x = np.linalg.norm(new - x), new
        if abs(1 - low) < 1e-14 and moved < 1e-5 * np.sqrt(d):
            break
    return x


def _shifts(a: np.ndarray):
    """Places to cut the spectrum: near the middle first, always between the smallest and the largest eigenvalue."""
    yield float(np.median(np.diag(a)))
    mean = float(np.trace(a)) / len(a)
    spread = float(np.linalg.norm(a - mean * np.eye(len(a)))) / len(a)
    for step in range(40):
        yield mean + spread * (-1) ** step * 0.0137 * step


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """(orthogonal basis, k): its first k columns span the space of the eigenvalues above a shift.  None: no cut found."""
    d, eye = len(a), np.eye(len(a))
    for shift in _shifts(a):
        moved = a - shift * eye
        if not np.linalg.norm(moved):
            continue
        u = polar_factor(moved)
        if np.linalg.norm(u @ u - eye) > INVOLUTION * d:  # the shift is an eigenvalue
            continue
        projector = (u + eye) / 2
        k = round(float(np.trace(projector)))
        if 0 < k < d:
            basis = projector @ np.random.default_rng(d).standard_normal((d, k))
            for _ in range(2):
                basis = projector @ np.linalg.qr(basis)[0]
            return np.linalg.qr(basis, mode="complete")[0], k
    return None


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as rows) of a symmetric matrix."""
    a = (a + a.T) / 2
    scale = float(np.linalg.norm(a))
    values, vectors, todo = [], [], [(a, np.eye(len(a)))]
    while todo:
        part, basis = todo.pop()
        cut = None
        if len(part) > 1 and np.linalg.norm(part - np.trace(part) / len(part) * np.eye(len(part))) > SAME * scale * len(part):
            cut = split(part)
        if cut is None:  # one component, or eigenvalues that are one to working precision
            values += np.diag(part).tolist()
            vectors += list(basis.T)
            continue
        q, k = cut
        for side in (q[:, :k], q[:, k:]):
            inner = side.T @ part @ side
            todo.append(((inner + inner.T) / 2, basis @ side))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order]


# ---- sums over the vectors -------------------------------------------------------------------------------------

def whole_vectors(df: DataFrame, vector_col: str) -> DataFrame:
    """`df` with x, the whole-number vector, in place of `vector_col`; only rows whose vector has finite entries alone."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))  # NaN is above infinity
    x = F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(OFFSET).cast("long"))
    return df.where(v.isNotNull() & (F.size(v) > 0) & finite).withColumn("x", x).drop(vector_col)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(df: DataFrame, part, d: int) -> np.ndarray:
    """The sum over all tasks of a d-by-d matrix that `part` adds up over a task's batches; its upper half moves."""
    i, j = np.triu_indices(d)

    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            total += part(b)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    ship_package()
    rows = df.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # d * (d + 1) / 2
    out = np.zeros((d, d))
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


class Whitening:
    """What is fitted: n, sums S, eigenvalues and vectors of the components kept, trace, and the matrix that whitens."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, most: int):
        self.n, self.sums = n, sums
        values, vectors = components(covariance)
        keep = min(most, int((values > ABSENT * max(values[0], 0.0)).sum()))
        self.trace = float(np.trace(covariance))
        self.values, self.vectors = values[:keep], vectors[:keep]
        self.matrix = self.vectors / np.sqrt(self.values)[:, None]
        self.base, rest = zip(*(divmod(s, n) for s in sums))
        self.fraction = np.array(rest, float) / n

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.base)).astype(float) - self.fraction


def _dimension(xs: DataFrame) -> int:
    """The most frequent length of a vector, the longer of equals; 0 without any vector."""
    found = xs.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if found is None:
        return 0
    if found["d"] > MAX_DIM:
        raise ValueError(f"vectors of {found['d']} entries; the largest dimension is {MAX_DIM}")
    return found["d"]


def fit(xs: DataFrame, d: int, most: int = COMPONENTS) -> Whitening:
    """Whitening of all vectors of `xs`, which have d entries."""

    def add(batches):
        n, total = 0, np.zeros(d, np.int64)
        for b in batches:
            x = _matrix(b.column(0), d)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.append(total, n))], names=["i", "s"])

    ship_package()
    sums = {r["i"]: r["s"] for r in xs.select("x").mapInArrow(add, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n, s = sums[d], [sums[i] for i in range(d)]
    whole, rest = (np.array(v) for v in zip(*(divmod(v, n) for v in s)))

    def products(b):
        z = (_matrix(b.column(0), d) - whole).astype(float) - rest / n
        return z.T @ z

    return Whitening(n, s, _summed(xs.select("x"), products, d) / n, most)


def whitened_vectors(xs: DataFrame, w: Whitening) -> DataFrame:
    """`xs` with y, the whitened components of its vector."""
    sent, d = xs.sparkSession.sparkContext.broadcast(w), len(w.sums)

    def run(batches):
        for b in batches:
            y = sent.value.centred(_matrix(b.column("x"), d)) @ sent.value.matrix.T
            offsets = np.arange(0, y.size + 1, y.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(y.ravel()))], names=[*b.schema.names, "y"])

    ship_package()
    return xs.mapInArrow(run, T.StructType([*xs.schema.fields, T.StructField("y", T.ArrayType(T.DoubleType()))]))


def identity_error(ys: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened vectors less the identity."""
    k = len(w.values)

    def products(b):
        y = np.column_stack([np.ones(b.num_rows), _matrix(b.column(0), k)])
        return y.T @ y

    g = _summed(ys.select("y"), products, k + 1) / w.n
    return float(np.abs(g[1:, 1:] - np.outer(g[0, 1:], g[0, 1:]) - np.eye(k)).max())


def deviation(x: Column, w: Whitening) -> Column:
    """Sum over the dimensions of (n x - S)^2, exact; beyond 64 bits the job ends with an overflow error, not a wrong number."""
    sums = F.split(F.lit(",".join(map(str, w.sums))), ",").cast("array<bigint>")
    off = F.zip_with(x, sums, lambda a, s: F.lit(w.n).cast("long") * a - s)
    return F.aggregate(off, F.lit(0).cast("long"), lambda total, o: total + o * o)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): per remaining row one row per component.

    Rows go whose vector is null, empty or holds null or non-finite entries, and
    those whose vector has another length than most vectors have (of lengths
    equally frequent the longer stays).  Components are numbered from 1 by
    falling eigenvalue, at most `most`; directions without variance (ABSENT)
    have none, so equal vectors, a single row or an empty table give an empty
    result.  Repeated rows and null ids come back as often as they came; of
    equal eigenvalues any basis may stand.  Other columns are ignored.
    """
    xs = whole_vectors(df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector")
    d = _dimension(xs)
    kind = df.select(id_col).schema[0].dataType.simpleString()
    empty = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return df.sparkSession.createDataFrame([], empty)
    xs = xs.where(F.size("x") == d)
    w = fit(xs, d, most)
    if not len(w.values):
        return df.sparkSession.createDataFrame([], empty)
    ys = whitened_vectors(xs, w)
    error = identity_error(ys, w)
    share = F.split(F.lit(",".join(repr(float(v / w.trace)) for v in w.values)), ",").cast("array<double>")
    rows = (ys.select("id", deviation(F.col("x"), w).alias("deviation"), "y")
            .select("id", "deviation", F.posexplode("y").alias("at", "whitened")))
    return rows.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
