import itertools
import math
from collections import Counter

import numpy as np
import pytest

from lodgespark.llm import sp_sampling
from tests.llm.helpers import EDGE_TEXTS, documents


@pytest.fixture(scope="module")
def sampler():
    return sp_sampling.Sampler()


def spellings(sampler, text):
    """All ways to spell a text with pieces, with their weights."""
    out = {}
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[at:i])
                at = i
        parts.append(text[at:])
        if all(p in sampler.pieces for p in parts):
            ids = tuple(sampler.pieces[p] for p in parts)
            out[ids] = math.prod(sampler.weight[i] for i in ids)
    return out


def test_samples_follow_the_weights(sampler):
    want = spellings(sampler, " therein")
    total = sum(want.values())
    n = 20000
    flat, counts = sampler.sample(["therein"] * n, list(range(n)))
    ends = np.cumsum(counts)
    got = Counter(tuple(flat[e - c:e].tolist()) for c, e in zip(counts, ends))
    assert set(got) <= set(want)
    for ids, w in want.items():
        p = w / total
        assert abs(got[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_long_parts_keep_the_weights(sampler):
    """Rescaling must not change ratios: the last pieces of a long part follow the same law as those of a short one."""
    n = 4000
    last = []
    for text in ("zq" * 3 + "there", "zq" * 200 + "there"):
        flat, counts = sampler.sample([text] * n, list(range(n)))
        last.append(Counter(sampler.spelt[i] for i in flat[np.cumsum(counts) - 1].tolist()))
    for piece in set(last[0]) | set(last[1]):
        assert abs(last[0][piece] - last[1][piece]) < 5 * math.sqrt(n) * 0.5 + 5


def test_round_trip_and_reproducible(sampler):
    texts = EDGE_TEXTS + ["a▁b ▁", "  two  spaces  ", "tab\tnew\nline\r\n", "\x00\x01", "日本語のテキスト🎉", " " * 100]
    texts = [t or "" for t in texts]
    for order in (texts, texts[::-1]):
        flat, counts = sampler.sample(order, order)
        ends = np.cumsum(counts)
        for t, c, e in zip(order, counts, ends):
            ids = flat[e - c:e].tolist()
            assert sampler.decode(ids) == t
            alone, _ = sp_sampling.Sampler().sample([t], [t]) if len(t) < 100 else (flat[e - c:e], None)
            assert alone.tolist() == ids


def test_seed_key_and_alpha_matter():
    texts = ["international understanding of the theatre"] * 50
    base, _ = sp_sampling.Sampler().sample(texts, range(50))
    other, _ = sp_sampling.Sampler(seed=1).sample(texts, range(50))
    sharp, n_sharp = sp_sampling.Sampler(alpha=8.0).sample(texts, range(50))
    free, n_free = sp_sampling.Sampler(alpha=0.1).sample(texts, range(50))
    assert base.tolist() != other.tolist()
    assert n_free.sum() > n_sharp.sum()
    _, n = sp_sampling.Sampler().sample(texts, range(50))
    assert len(set(n.tolist())) > 1


def test_frames(spark):
    docs = documents(spark)
    got = {r.doc_id: r for r in sp_sampling.decode_pieces(sp_sampling.encode_sampled(docs, prefix="sp_"), "sp_piece_ids").collect()}
    for i, t in enumerate(EDGE_TEXTS):
        assert got[i].decoded == t and got[i].sp_lossless and got[i].sp_n_pieces == len(got[i].sp_piece_ids or [])
        assert got[i].score == 1.0 and got[i].id == f"extra{i}"
    again = {r.doc_id: r.piece_ids for r in sp_sampling.encode_sampled(docs.repartition(5)).collect()}
    assert all(again[i] == got[i].sp_piece_ids for i in again)
    assert sp_sampling.encode_sampled(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        sp_sampling.encode_sampled(sp_sampling.encode_sampled(docs))


def test_slices_cover_all_rows():
    lengths = np.array([0, 5, 100, 3, 0, 7, 50, 0, 0])
    runs = list(sp_sampling._slices(lengths, 10))
    assert runs[0][0] == 0 and runs[-1][1] == len(lengths) and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
