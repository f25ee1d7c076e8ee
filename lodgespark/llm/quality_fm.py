"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).  The
pairwise sum is computed in linear time as
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .shared import ship_package

#: Buckets of hashed words, rank of the interactions, and the bound of the labelled sample that is fitted.
WORD_BUCKETS, RANK, SAMPLE_DOCS = 1 << 15, 6, 4000
EPOCHS, BATCH, RATE, DECAY, SEED = 6, 32, 0.03, 1e-5, 7

_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = b"!#$%&*|<>{}[]=_^~\\/@+"
_STOPS = b".,;:?'\"-()"
STRUCTURE = ("log_chars", "log_words", "word_length", "upper", "digits", "marks", "stops", "non_ascii",
             "distinct_words", "repeated_lines", "words_per_line", "marked_words", "common_word")


def structure(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Statistics of the form of a text, each about 0 to 10; all 0 for an empty text."""
    n, m = len(raw), len(words)
    if not m:
        return [0.0] * len(STRUCTURE)
    share = lambda drop: (n - len(raw.translate(None, drop))) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(c for w, c in counts.items() if w[-1] in _MARKS)
    return [np.log1p(n), np.log1p(m), min(10.0, n / m), share(_UPPER), share(_DIGIT), share(_MARKS), share(_STOPS),
            share(bytes(range(128, 256))), len(counts) / m, 1 - len(set(lines)) / len(lines),
            min(5.0, np.log1p(m / len(lines))), ends / m, counts.most_common(1)[0][1] / m]


class Features:
    """Text -> (indices, values): L2-normalised damped counts of hashed words, then the structure statistics."""

    def __init__(self, buckets: int = WORD_BUCKETS):
        self.buckets, self._bucket = buckets, {}

    def __getstate__(self):
        return {"buckets": self.buckets, "_bucket": {}}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        raw = (text or "").encode("utf-8", "replace")
        words = raw.split()
        counts = Counter(words)
        known = self._bucket
        if len(known) > 400_000:
            known.clear()
        at = []
        for w in counts:
            b = known.get(w)
            if b is None:
                b = known[w] = zlib.crc32(w.lower().strip(_STOPS + _MARKS)) % self.buckets
            at.append(b)
        value = np.log1p(np.fromiter(counts.values(), np.float64, len(at)))
        if len(at):
            value /= np.sqrt((value ** 2).sum())
        extra = np.arange(self.buckets, self.buckets + len(STRUCTURE))
        return np.concatenate([np.array(at, np.int64), extra]), np.concatenate([value, structure(raw, words, counts)])


@dataclass
class FactorisationMachine:
    """Weights over the buckets and the structure statistics (standardised by `mean` and `scale`)."""
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    features: Features

    def scaled(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        out, k = value.copy(), len(STRUCTURE)
        out[-k:] = np.clip((value[-k:] - self.mean) / self.scale, -3, 3) * 0.3
        return out

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at] * x[:, None]
        return float(self.bias + self.linear[at] @ x + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum()))

    def score(self, text: str | None) -> float:
        at, value = self.features(text)
        return float(1 / (1 + np.exp(-np.clip(self.margin(at, self.scaled(at, value)), -30, 30))))


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], features: Features, rank: int = RANK, epochs: int = EPOCHS) -> FactorisationMachine:
    """AdaGrad on the logistic loss, in mini-batches of a fixed order; the same sample gives the same model."""
    size, k, rng = features.buckets + len(STRUCTURE), len(STRUCTURE), np.random.default_rng(SEED)
    stats = np.array([v[-k:] for _, v, _ in samples]) if samples else np.zeros((1, k))
    scale = stats.std(0)
    share = float(np.clip(np.mean([y for *_, y in samples]) if samples else 0.5, 0.01, 0.99))
    fm = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, rank)),
                              stats.mean(0), np.where(scale > 1e-9, scale, 1.0), features)
    rows = [(at, fm.scaled(at, v), y) for at, v, y in samples]
    g_lin, g_fac, g_bias = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            part = [rows[i] for i in order[lo:lo + BATCH]]
            at = np.concatenate([r[0] for r in part])
            x = np.concatenate([r[1] for r in part])
            cut = np.cumsum([0, *(len(r[0]) for r in part)])[:-1]
            of = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
            v = fm.factors[at]
            vx = v * x[:, None]
            sums = np.add.reduceat(vx, cut)
            z = fm.bias + np.add.reduceat(fm.linear[at] * x, cut) + 0.5 * (
                (sums ** 2).sum(1) - np.add.reduceat((vx ** 2).sum(1), cut))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - [r[2] for r in part]) / len(part)
            bias_step = float(err.sum())
            g_bias += bias_step ** 2
            fm.bias -= RATE * bias_step / np.sqrt(g_bias)
            seen, back = np.unique(at, return_inverse=True)
            lin = np.bincount(back, err[of] * x, len(seen)) + DECAY * fm.linear[seen]
            fac = (err[of] * x)[:, None] * (sums[of] - vx)
            fac = np.stack([np.bincount(back, fac[:, f], len(seen)) for f in range(rank)], 1) + DECAY * fm.factors[seen]
            g_lin[seen] += lin ** 2
            g_fac[seen] += fac ** 2
            fm.linear[seen] -= RATE * lin / np.sqrt(g_lin[seen])
            fm.factors[seen] -= RATE * fac / np.sqrt(g_fac[seen])
    return fm


def learn(docs: DataFrame, labels: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> FactorisationMachine:
    """Fit on a bounded sample: the first `sample_docs` labelled rows, in the order of the id's hash, where `learnable` holds.

    Features of the sample are made on the executors; only they reach the
    driver.  Rows with a null id, label or text teach nothing; an id with
    several labels teaches each.  Without any label every score is 0.5.
    """
    ship_package()
    features = Features()
    known = (labels.where(learnable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .orderBy(F.xxhash64("id"), "id", "y").limit(sample_docs))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("y", T.IntegerType()),
                           T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.DoubleType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [features(t) for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"].astype(str), "y": frame["y"], "at": [a for a, _ in made], "value": [v for _, v in made]})

    got = texts.join(F.broadcast(known), "id").mapInPandas(run, schema).collect()  # `known` has sample_docs rows at most
    got.sort(key=lambda r: (zlib.crc32(r["id"].encode()), r["id"], r["y"], len(r["at"])))
    return fit([(np.array(r["at"], np.int64), np.array(r["value"]), r["y"]) for r in got], features)


def scorer(model: FactorisationMachine):
    """A column function: text -> score 0..1, from the whole text alone.  Null counts as empty; an empty text is scored
    by its (absent) features like any other."""
    ship_package()

    @pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")
    return run
