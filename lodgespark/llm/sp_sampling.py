"""SentencePiece segmentation sampled by forward filtering and backward sampling.

A text's lattice holds every way to spell it with the vocabulary's pieces.
Forward filtering sums the weights of all spellings up to each position;
backward sampling walks from the end, choosing each piece in proportion to
what the filter says, which draws a segmentation exactly in proportion to its
weight.  The draws come from a counter-based generator keyed by the row, so a
row gets the same segmentation in every run, partitioning and batch.

No piece has a space behind another character, so the lattice falls apart at
such places: each word's filter is computed once, and all words of a batch walk
backwards together in numpy.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, types as T

from .shared import ship_package

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Memory bounds of a worker: edges of filtered words kept, and code points handled at once.
MAX_EDGES, SLICE_CHARS = 1_000_000, 500_000
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: 64 well mixed bits of a counter."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Trie:
    """Prefix tree of the pieces, walked by many positions at once (open hashing of (node, character))."""

    def __init__(self, pieces: dict[str, int]):
        chars = sorted({c for p in pieces for c in p})
        self.of_char = np.zeros(0x110000, np.int64)
        self.of_char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.wide = len(chars) + 1
        steps: dict[tuple[int, int], int] = {}
        self.piece = [-1]
        for p, i in pieces.items():
            node = 0
            for c in p:
                at = (node, int(self.of_char[ord(c)]))
                if at not in steps:
                    steps[at] = len(self.piece)
                    self.piece.append(-1)
                node = steps[at]
            self.piece[node] = i
        self.piece = np.array(self.piece, np.int32)
        self.bits = max(4, (4 * len(steps)).bit_length())
        self.keys, self.next = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        for (node, c), to in steps.items():
            slot = int(self._slot(np.array([node * self.wide + c]))[0])
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.next[slot] = node * self.wide + c, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The node behind each character, -1 where there is none."""
        key = node * self.wide + char
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.next[slot], -1)
        left = np.nonzero((found != key) & (found >= 0))[0]
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[left]]
            hit = found == key[left]
            out[left[hit]] = self.next[slot[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class Sampler:
    """Encoder and decoder of one vocabulary.

    A piece weighs (rank + 2)^-alpha, rank being its place in the order of
    scores (merge order for a BPE vocabulary): small alpha spells freely,
    large alpha prefers early pieces.  Characters without a piece are spelt as
    byte pieces.  The space is the vocabulary's meta symbol; that symbol
    itself, should it occur in a text, goes through its bytes, so decoding
    gives back every text exactly.
    """

    def __init__(self, model_path: str = MODEL_PATH, alpha: float = 1.0, seed: int = 0):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i).replace(SPACE, " "): i for i in ids}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.spelt = [b""] * sp.get_piece_size()
        for piece, i in self.pieces.items():
            self.spelt[i] = piece.encode()
        for b, i in enumerate(self.byte_ids):
            self.spelt[i] = bytes([b])
        self.weight = np.ones(sp.get_piece_size())
        for n, i in enumerate(sorted(ids, key=lambda i: (-sp.get_score(i), i))):
            self.weight[i] = (n + 2.0) ** -alpha
        self.seed = seed
        chars = {c for p in self.pieces for c in p}
        if missing := chars - self.pieces.keys():
            raise ValueError(f"characters within pieces that are no piece themselves: {sorted(missing)[:5]}")
        self.longest = max(map(len, self.pieces))
        known = "".join(map(re.escape, sorted(chars - {" "})))
        crossing = any(re.search("[^ ] ", p) for p in self.pieces)
        #: Parts between which no piece reaches: spaces with the word behind them, or one character without a piece.
        self.part = re.compile(f"[{known} ]+|[^{known} ]" if crossing else f" *[{known}]+| +|[^{known} ]")
        self.trie = _Trie(self.pieces)
        self._reset()

    def _reset(self) -> None:
        # A state is a position in a part; its edges are the pieces that end there, `cum` their cumulative
        # probability, `prev` the state where they begin (-1: the part's start).
        self.ends: dict[str, int] = {}
        self.first = np.zeros(0, np.int64)
        self.cum, self.prev, self.piece = np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _append(self, first: np.ndarray, cum: np.ndarray, prev: np.ndarray, piece: np.ndarray) -> None:
        self.first = np.concatenate([self.first, first + len(self.cum)])
        self.cum = np.concatenate([self.cum, cum])
        self.prev = np.concatenate([self.prev, prev.astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece.astype(np.int32)])

    def _add(self, parts: list[str]) -> None:
        """Filter new parts forwards, all at once, and keep the states of their ends."""
        plain = [p for p in parts if p[0] in self.pieces]
        for p in parts:
            if p[0] not in self.pieces:  # one chain of byte pieces
                spelt = [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
                s, n = len(self.first), len(spelt)
                self._append(np.arange(n), np.ones(n), np.array([-1, *range(s, s + n - 1)]), np.array(spelt))
                self.ends[p] = s + n - 1
        if not plain:
            return
        lens = np.array([len(p) for p in plain])
        stop = np.cumsum(lens)
        start = stop - lens
        chars = self.trie.of_char[np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32)]
        n, base = len(chars), len(self.first)
        stop_of = np.repeat(stop, lens)
        # every piece at every place
        at, node, ends, kinds = np.arange(n), np.zeros(n, np.int64), [], []
        for d in range(self.longest):
            node = self.trie.step(node, chars[at + d])
            hit = node >= 0
            at, node = at[hit], node[hit]
            got = self.trie.piece[node]
            ok = got >= 0
            ends.append(((at[ok] + d) * self.longest + (self.longest - 1 - d)))  # by end, longest piece first
            kinds.append(got[ok])
            on = at + d + 1 < stop_of[at]
            at, node = at[on], node[on]
        key, piece = np.concatenate(ends), np.concatenate(kinds)
        order = np.argsort(key)
        key, piece = key[order], piece[order]
        end = key // self.longest
        begin = end - (self.longest - 1 - key % self.longest)
        count = np.bincount(end, minlength=n)
        first = np.cumsum(count) - count
        prev = np.where(begin == np.repeat(start, lens)[end], -1, begin - 1)
        total, cum, weight, origin = np.empty(n), np.empty(len(key)), self.weight[piece], np.ones(len(plain))
        alive = np.argsort(-lens, kind="stable")
        for r in range(int(lens.max())):
            alive = alive[:int(np.searchsorted(-lens[alive], -r, side="left"))]  # parts longer than r
            f = start[alive] + r
            acc, deg, edge0 = np.zeros(len(f)), count[f], first[f]
            for k in range(int(deg.max())):
                m = np.nonzero(deg > k)[0]
                e = edge0[m] + k
                p = prev[e]
                acc[m] += weight[e] * np.where(p < 0, origin[alive[m]], total[p])
                cum[e] = acc[m]
            total[f] = acc
            for k in range(int(deg.max())):
                m = np.nonzero(deg > k)[0]
                cum[edge0[m] + k] /= acc[m]
            if r % 16 == 15:  # keep long parts in range: only the ratios within reach of a piece count
                for x in range(min(r, self.longest) + 1):
                    total[f - x] /= acc
                if r < self.longest:
                    origin[alive] /= acc
        cum[first + count - 1] = 1.0
        self._append(first, cum, np.where(prev < 0, -1, prev + base), piece)
        self.ends.update(zip(plain, (base + stop - 1).tolist()))

    def row_seed(self, key) -> int:
        return xxhash.xxh64_intdigest(str(key), seed=self.seed)

    def sample(self, texts: list[str | None], keys: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        find = self.part.findall
        parts = [find(" " + t) if t else [] for t in texts]
        if len(self.cum) > MAX_EDGES:
            self._reset()
        new = set().union(*parts) - self.ends.keys()
        if new:
            self._add(list(new))
        n_parts = np.array([len(p) for p in parts], np.int64)
        n = int(n_parts.sum())
        state = np.fromiter(map(self.ends.__getitem__, chain.from_iterable(parts)), np.int64, n)
        seeds = np.repeat(np.array([self.row_seed(k) for k in keys], np.uint64), n_parts)
        begin = np.repeat(np.cumsum(n_parts) - n_parts, n_parts)
        counter = _mix(seeds + _GOLDEN * (np.arange(n) - begin + 1).astype(np.uint64))
        at, steps, lengths = np.arange(n), [], np.zeros(n, np.int64)
        while len(at):
            counter = _mix(counter + _GOLDEN)
            u = (counter >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            edge = self.first[state]
            more = np.nonzero(u >= self.cum[edge])[0]
            while len(more):
                edge[more] += 1
                more = more[u[more] >= self.cum[edge[more]]]
            steps.append((at, self.piece[edge]))
            lengths[at] += 1
            state = self.prev[edge].astype(np.int64)
            on = state >= 0
            at, state, counter = at[on], state[on], counter[on]
        last = np.cumsum(lengths) - 1
        out = np.empty(int(lengths.sum()), np.int32)
        for k, (at, got) in enumerate(steps):  # the walk goes backwards
            out[last[at] - k] = got
        sums = np.concatenate([[0], np.cumsum(lengths)])
        of_text = np.concatenate([[0], np.cumsum(n_parts)])
        return out, sums[of_text[1:]] - sums[of_text[:-1]]

    def decode(self, ids) -> str:
        spelt = self.spelt
        return b"".join([spelt[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def _slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about `most` code points; a longer text is a run of its own."""
    sums = np.cumsum(lengths).tolist()
    a = 0
    while a < len(sums):
        b = min(max(a + 1, bisect_left(sums, (sums[a - 1] if a else 0) + most)), len(sums))
        yield a, b
        a = b


_samplers: dict[tuple, Sampler] = {}


def encode_sampled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH,
                   alpha: float = 1.0, seed: int = 0, prefix: str = "") -> DataFrame:
    """`docs` with piece_ids (array of int), n_pieces and lossless, each behind `prefix`.

    `piece_ids` is one sampled segmentation, the same for the same id, text,
    alpha and seed; `lossless` tells that decoding gives the very text.  A null
    text gives null ids, 0 pieces and lossless; an empty one an empty list.
    Repeated rows get the same segmentation.  Columns of `docs` stay; should
    one bear an output's name, choose another prefix.
    """
    names = [prefix + x for x in ("piece_ids", "n_pieces", "lossless")]
    if set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(set(names) & set(docs.columns))} exist; choose another prefix")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.ArrayType(T.IntegerType())),
                           T.StructField(names[1], T.LongType()), T.StructField(names[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (model_path, alpha, seed)
        if key not in _samplers:
            _samplers[key] = Sampler(*key)
        sampler = _samplers[key]
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
            for a, b in _slices(lengths, SLICE_CHARS):
                rows = batch.slice(a, b - a)
                texts = rows.column(text_col).to_pylist()
                flat, counts = sampler.sample(texts, rows.column(id_col).to_pylist())
                ends = np.cumsum(counts)
                back = [t is None or (sampler.decode(flat[e - c:e].tolist()) == t) for t, c, e in zip(texts, counts.tolist(), ends.tolist())]
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(rows.num_columns)), ids, pa.array(counts, pa.int64()), pa.array(back)],
                    names=[*rows.schema.names, *names])

    ship_package()
    return docs.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded", model_path: str = MODEL_PATH) -> DataFrame:
    """`encoded` with the text that the pieces spell (null ids: null)."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (model_path, 1.0, 0)
        if key not in _samplers:
            _samplers[key] = Sampler(*key)
        for batch in batches:
            texts = [None if x is None else _samplers[key].decode(x) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])

    ship_package()
    return encoded.mapInArrow(run, schema)
