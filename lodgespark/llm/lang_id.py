"""Language identification by compression.

Every language gets a zstandard raw-content dictionary of sample text.  A text
is encoded once per language, block by block with that language's dictionary,
and the language with the smallest total wins; a narrow win is rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .shared import ship_package

UNDETERMINED = "und"
#: The learning sample: documents per language, and code points of each (a piece at a place chosen by the id's hash).
SAMPLE_DOCS, PIECE_CHARS = 320, 400
#: Bytes of a language's dictionary; number and bytes of the samples that decide ties.
DICT_BYTES, TIE_SAMPLES, TIE_BYTES = 64 << 10, 8, 4096
LEVEL, BLOCK_BYTES = 5, 4096
#: Smallest share by which the best size must be below the second.
MIN_MARGIN = 0.003

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_WORD_PARTS = re.compile(r"[^\W\d_]+")


def letters(text: str) -> str:
    """Lower-case letters of a text, other runs as one space: case and punctuation say nothing of the language."""
    return _NOT_LETTERS.sub(" ", text.lower())


def has_letter(text: str | None) -> bool:
    return bool(text) and any(any(map(str.isalpha, m.group())) for m in _WORD_PARTS.finditer(text))


@dataclass
class LanguageModel:
    """Sample text by language; `order` breaks what ties remain (most sample text first)."""
    pieces: dict[str, list[str]]
    level: int = LEVEL
    block_bytes: int = BLOCK_BYTES
    min_margin: float = MIN_MARGIN
    _ready: list | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_ready": None}

    def coders(self) -> list[tuple]:
        """Per language: name, compressor with its dictionary, tie samples with their own sizes; built once a worker."""
        if self._ready is None:
            self._ready = []
            for lang in sorted(self.pieces, key=lambda k: (-sum(map(len, self.pieces[k])), k)):
                enc = [p.encode("utf-8", "replace") + b" " for p in self.pieces[lang]]
                d = zstandard.ZstdCompressionDict(b"".join(enc)[:DICT_BYTES] or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=self.level)
                coder = zstandard.ZstdCompressor(level=self.level, dict_data=d, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False)
                parts = [b"".join(enc[i::TIE_SAMPLES])[:TIE_BYTES] for i in range(TIE_SAMPLES)]
                self._ready.append((lang, coder, [(x, len(self._plain.compress(x))) for x in parts]))
        return self._ready

    @property
    def _plain(self):
        return zstandard.ZstdCompressor(level=3, write_content_size=False)

    def _close_call(self, blocks: list[bytes]) -> np.ndarray:
        """What the blocks add to frames that begin with sample text: there the sample's letter
        statistics count too, which tells apart texts too short for a dictionary match."""
        plain = self._plain
        return np.array([sum(len(plain.compress(x + b)) - own for x, own in ties for b in blocks)
                         for _, _, ties in self.coders()])

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score 0..1, margin, rejected)."""
        if not self.pieces or not has_letter(text):
            return UNDETERMINED, 0.0, 0.0, True
        raw = letters(text).encode("utf-8", "replace")
        blocks = [raw[i:i + self.block_bytes] for i in range(0, len(raw), self.block_bytes)]
        sizes = np.array([sum(len(coder.compress(b)) for b in blocks) for _, coder, _ in self.coders()])
        if len(sizes) == 1:
            return self.coders()[0][0], 1.0, 1.0, False
        best, second = np.partition(sizes, 1)[:2]
        if second - best <= self.min_margin * second:
            sizes = self._close_call(blocks)
            best, second = np.partition(sizes, 1)[:2]
        margin = float((second - best) / max(1, second))
        score = float(1 / np.exp(-(sizes - best) / (1 + 0.02 * max(0, best))).sum())
        return self.coders()[int(sizes.argmin())][0], score, margin, bool(margin < self.min_margin)


def learn(docs: DataFrame, labelled, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS, **settings) -> LanguageModel:
    """Fit on a bounded sample: `sample_docs` documents of each non-null language among the rows where `labelled` holds.

    The sample is the first documents in the order of their id's hash, and of
    each a piece of PIECE_CHARS code points; `sample_docs * PIECE_CHARS` per
    language reach the driver, whatever the table's size.  Rows without a
    letter or a language teach nothing.
    """
    start = F.pmod(F.xxhash64(F.lit("piece"), id_col), F.greatest(F.length(text_col) - PIECE_CHARS, F.lit(0)) + 1)
    rows = (docs.where(labelled & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("turn"), F.col(id_col).cast("string").alias("id"),
                    F.substr(text_col, (start + 1).cast("int"), F.lit(PIECE_CHARS)).alias("piece")))
    turn = Window.partitionBy("lang").orderBy("turn", "id", "piece")
    got = rows.withColumn("n", F.row_number().over(turn)).where(F.col("n") <= sample_docs).select("lang", "n", "piece").collect()
    pieces: dict[str, list[str]] = {}
    for r in sorted(got, key=lambda r: (r["lang"], r["n"])):
        pieces.setdefault(r["lang"], []).append(letters(r["piece"]))
    return LanguageModel(pieces, **settings)


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def identify(model: LanguageModel):
    """A column function: text -> struct(lang_pred, score, margin, rejected).

    Null texts and texts without a letter are `und`, score 0, rejected.  Whole
    texts are encoded whatever their length; equal texts get equal answers.
    Without any language learned every text is `und`.
    """
    ship_package()

    @pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=RESULT.names)
    return run


def drop_undetermined(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows whose language is told clearly, with all their columns."""
    return docs.where(~identify(model)(F.col(text_col))["rejected"])
