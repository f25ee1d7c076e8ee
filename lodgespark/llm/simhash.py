"""SimHash near-duplicates with covering locality-sensitive hashing.

Pagh's CoveringLSH: give every bit position a non-zero vector of radius + 1
bits, and let mask v (one of the 2^(radius+1) - 1 non-zero vectors) hold the
positions whose vector has an odd inner product with v.  Any `radius` vectors
leave some non-zero v orthogonal to all of them, so two fingerprints that
differ in at most `radius` bits agree under at least one mask: no link is
missed.  For radius 2 these are 7 masks of about 36 of the 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .components import connected_components
from .shared import hex64, ship_package, stored

BITS, SEED = 64, 42
SHINGLE_WORDS, MAX_DISTANCE = 3, 2
_BLOCK = 1 << 16


def simhash(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint (unsigned) of a whole text; null, empty or blank: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    k, n, h64 = words_per_shingle, len(words), xxhash.xxh64_intdigest
    total = max(1, n - k + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, _BLOCK):
        part = words[at:at + _BLOCK + k - 1]
        if n < k:
            hashes = [h64(b" ".join(words), SEED)]
        else:
            hashes = [h64(s, SEED) for s in map(b" ".join, zip(*(part[i:] for i in range(k))))]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


@pandas_udf(T.LongType())
def simhash_udf(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([simhash(t) for t in texts], dtype="<u8").view("<i8"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    ship_package()
    return docs.select(F.col(id_col).alias("id"), simhash_udf(F.col(text_col)).alias("fp"))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """Masks such that any two words that differ in at most `radius` bits agree under one of them."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + i % vectors for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (of_bit[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def near_links(fps: DataFrame, radius: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints of `fp` at most `radius` (1 or 2) bits apart.

    Tables: each fingerprint goes to one bucket per mask; buckets with one
    fingerprint are done.  Inside a bucket the pairs are not listed: a
    fingerprint that shares some bucket names the words that differ from it in
    no or one of the bits its buckets leave open.  Two fingerprints two bits
    apart meet at the word half way, one bit apart at either of them, and
    whatever meets at a word is within 2 bits of each other (for radius 1, a
    word must be one of the two).  At most 65 distinct fingerprints can meet
    at a word, so every group is bounded whatever the bucket's size, and a
    bucket of m fingerprints costs at most 65 m rows.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(radius)
    full = (1 << BITS) - 1
    distinct = fps.select("fp").distinct()
    slots = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"), F.lit(_signed(full ^ m)).alias("open"))
        for i, m in enumerate(masks)])).alias("s")).select("fp", "s.t", "s.key", "s.open")
    shared = slots.groupBy("t", "key").count().where("count > 1").select("t", "key")
    open_bits = slots.join(shared, ["t", "key"]).groupBy("fp").agg(F.expr("bit_or(open)").alias("open"))
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    words = open_bits.select("fp", F.explode(F.concat(
        F.array(F.lit(0).cast("long")), F.filter(flips, lambda f: f.bitwiseAND(F.col("open")) != 0))).alias("flip"))
    words = words.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    met = words.groupBy("word").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    if radius == 1:
        met = met.where(F.array_contains("fps", F.col("word")))
        return met.select(F.col("word").alias("a"), F.explode("fps").alias("b")).where("a != b").distinct()
    return met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b").distinct()


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              radius: int = MAX_DISTANCE) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    `component_id` is the smallest id reachable over links of at most
    `radius` differing bits.  Null, empty and blank texts share fingerprint 0
    and link like any other; null ids take part but are never the smallest
    (a component of null ids has a null component).  Repeated rows come back
    as often as they came.  Copies share a fingerprint, so the graph has
    distinct fingerprints only.
    """
    fps = stored(fingerprints(docs, id_col, text_col), "simhash")
    parts = connected_components(near_links(fps, radius))
    least = fps.groupBy("fp").agg(F.min("id").alias("least"))
    named = least.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = named.select("fp", "component").join(roots, "component").select("fp", "component_id")
    return (fps.join(of_fp, "fp").select(F.col("id").alias(id_col), hex64(F.col("fp")).alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = MAX_DISTANCE) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component, with all their columns.

    Of rows repeated under that id one stays; a component without any id
    keeps none of its rows apart, so rows with a null id all stay.
    """
    from pyspark.sql import Window
    keep = (near_duplicate_components(docs, id_col, text_col, radius)
            .where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__id")).distinct())
    d = docs.alias("d")
    stays = d.join(keep.alias("k"), F.col(f"d.{id_col}") == F.col("k.__id"), "left_semi")
    order = [F.col(c) for c in docs.columns if c != id_col]
    one = (stays.withColumn("__n", F.row_number().over(Window.partitionBy(id_col).orderBy(*order)))
           .where("__n = 1").drop("__n"))
    return one.unionByName(docs.where(F.col(id_col).isNull()))
