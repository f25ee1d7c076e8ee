"""Token counts by a two-tier lookup on the map side.

A tokenizer that never lets a token cross white space gives a text as many
tokens as its space-delimited pieces have in sum.  Pieces repeat, so most are
looked up instead of encoded: the first tier is a compact table of the lengths
of frequent pieces, broadcast once; the second is a cache in each Python
worker, filled by encoding the pieces the first lacks.  No piece is shuffled:
frequent pieces are named by sketches of bounded size, and each text is counted
where it is read.

The tables only save work.  Every count is the tokenizer's own.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from .shared import ship_package

#: Entries of the broadcast table, counters of a sketch, sketches merged in the first step, and the longest piece (bytes)
#: that a table or cache holds: the table stays below TABLE_ENTRIES * (LONGEST + 2) bytes, 1.1 MB.
TABLE_ENTRIES, SKETCH_ITEMS, SKETCH_GROUPS, LONGEST = 1 << 14, 1 << 16, 64, 64
#: Bounds of a worker: pieces in its cache, and bytes of text split at once.
CACHE_ENTRIES, SLICE_BYTES = 400_000, 1_000_000
#: White space that every tokenizer here splits at and drops, and that bytes.split() knows.
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
MAX_TOKENS = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def frequent_pieces(docs: DataFrame, text_col: str = "text", entries: int = TABLE_ENTRIES) -> list[str]:
    """At most `entries` of the most frequent pieces of all texts, by sketches with bounded error.

    Each map task keeps one sketch, the sketches of SKETCH_GROUPS groups of
    tasks are merged apart and then together; only the chosen pieces reach the
    driver.
    """
    pieces = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+")).alias("piece"))
    short = pieces.where((F.col("piece") != "") & (F.octet_length("piece") <= LONGEST))
    by_group = (short.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part"))
                .agg(F.call_function("approx_top_k_accumulate", F.col("piece"), F.lit(SKETCH_ITEMS)).alias("sketch")))
    # one group rather than none: without a key, Spark merges a sketch for empty partitions too and fails on it
    whole = by_group.groupBy(F.lit("all").alias("all")).agg(F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(SKETCH_ITEMS)).alias("sketch"))
    top = whole.select(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(entries)).alias("top")).first()
    return [x["item"] for x in top["top"]] if top else []


def _encoder(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _encoded_lengths(tokenizer: Tokenizer, pieces: list[bytes]) -> Iterator[int]:
    return map(len, tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False))


def packed_table(pieces: list[str], path: str) -> tuple[bytes, bytes]:
    """The first tier: the pieces one after another, and one byte with each one's length."""
    raw = [p.encode() for p in pieces]
    return b"\n".join(raw), bytes(_encoded_lengths(_encoder(path), raw)) if raw else b""


class PieceLengths(dict):
    """Both tiers as one dictionary: the broadcast table, and the pieces encoded since the cache was last emptied."""

    def __init__(self, path: str, table: tuple[bytes, bytes], most: int = CACHE_ENTRIES):
        self.table = dict(zip(table[0].split(b"\n"), table[1])) if table[1] else {}
        super().__init__(self.table)
        self.tokenizer, self.most = _encoder(path), most

    def _count(self, slice_: list[tuple[int, bytes]], into: list[int]) -> None:
        found = [(row, text.split()) for row, text in slice_]
        missing = list(set(chain.from_iterable(p for _, p in found)) - self.keys())
        self.update(zip(missing, _encoded_lengths(self.tokenizer, missing)))
        for row, pieces in found:
            into[row] += sum(map(self.__getitem__, pieces))
        if len(self) > len(self.table) + self.most:
            self.clear()
            self.update(self.table)
        else:
            for p in missing:
                if len(p) > LONGEST:
                    del self[p]

    def counts(self, texts: Iterator[bytes | None]) -> list[int]:
        """Tokens of each text (None: 0), the texts taken in slices; a long text is cut at white space."""
        out, slice_, size = [], [], 0
        for row, text in enumerate(texts):
            out.append(0)
            for part in _parts(text or b"", SLICE_BYTES):
                slice_.append((row, part))
                size += len(part)
                if size >= SLICE_BYTES:
                    self._count(slice_, out)
                    slice_, size = [], 0
        self._count(slice_, out)
        return out


def _parts(text: bytes, most: int) -> Iterator[bytes]:
    """Pieces of whole words, of about `most` bytes each."""
    start = 0
    while len(text) - start > most:
        cut = _SPACE.search(text, start + most)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


_workers: dict[str, PieceLengths] = {}


def token_counter(docs: DataFrame, text_col: str = "text", path: str | None = None, entries: int = TABLE_ENTRIES):
    """A function Column -> Column that counts the tokens of whole texts (null: 0).

    The frequent pieces are those of all of `docs`; the tokenizer's file goes
    to the executors through Spark.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    table = spark.sparkContext.broadcast(packed_table(frequent_pieces(docs, text_col, entries), path))
    name, run = os.path.basename(path), uuid.uuid4().hex
    spark.sparkContext.addFile(path)
    ship_package()

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        if run not in _workers:  # a worker serves one table at a time
            _workers.clear()
            _workers[run] = PieceLengths(SparkFiles.get(name), table.value)
        raw = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
        return pa.array(_workers[run].counts(x.as_py() for x in raw), pa.int64())

    return lambda text: count(text)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = MAX_TOKENS) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit), one row per row of `docs`.

    Tokens are counted without begin, end or other added ones; strings of
    special tokens inside a text count as the tokenizer takes them.  Null and
    empty texts have 0 bytes and 0 tokens, null ids stay null, repeated rows
    come back as often, an empty table gives an empty result, and other columns
    (whatever their names) are ignored.  A text of any length is counted whole,
    in parts cut at white space.
    """
    n = token_counter(docs, text_col, path)(F.col(text_col))
    counted = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"), n.alias("n_tokens"))
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
