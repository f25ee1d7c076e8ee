"""Order MinHash fingerprints, sensitive to edit distance (Marcais et al., 2019).

The k-mers of a text (runs of k tokens) are numbered by occurrence, so equal
k-mers are told apart.  Each of REPEATS hash functions selects the TUPLE
smallest numbered k-mers; these are put back in text order and the tuple is
hashed.  Two texts agree in a repeat only if the same k-mers were selected in
the same order, which common words in another order do not give.

The hash functions are g(x) XOR (r << 59) for r = 0..31, g a signed 64-bit
hash: each is a uniform order of the k-mers, and all 32 selections can be read
off one sorted array, since the TUPLE smallest of every leading-bits class hold
the selection of every r; that of r is class r's, counted from the most
negative, where it is full.  Only built-in column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A token: an ideograph or kana, up to 16 letters, marks and digits, or any other sign.
TOKEN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]{1,16}|[^\s]"
KMER, TUPLE, CLASS_BITS = 3, 2, 5
REPEATS = 1 << CLASS_BITS
_SHIFT = 64 - CLASS_BITS


def _shl(x: Column, n: Column | int) -> Column:
    return F.call_function("shiftleft", x, n if isinstance(n, Column) else F.lit(n))


def _shr(x: Column, n: Column | int) -> Column:
    return F.call_function("shiftright", x, n if isinstance(n, Column) else F.lit(n))


def _bits(n: Column) -> Column:
    return F.length(F.bin(n.cast("long")))


def _kmers(tokens: str, k: int) -> Column:
    t, n = F.col(tokens), F.size(tokens)
    runs = F.transform(F.slice(t, F.lit(1), n - (k - 1)), lambda w, i: F.xxhash64(w, *[F.get(t, i + j) for j in range(1, k)]))
    return F.when(n >= k, runs).when(n > 0, F.array(F.xxhash64(t))).otherwise(F.array().cast("array<bigint>"))


def signatures(df: DataFrame, text_col: str, out_col: str, k: int = KMER) -> DataFrame:
    """`df` with `out_col`: array of REPEATS 64-bit tuple hashes of the text (null: as empty).

    Whole texts, in time n log n of their tokens.  A text with fewer than k
    tokens is one k-mer; texts without a token share one signature.  Helper
    columns `__omh_*` come and go.
    """
    c = lambda x: F.col(f"__omh_{x}")
    df = df.withColumn("__omh_t", F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn("__omh_h", _kmers("__omh_t", k))
    df = df.withColumn("__omh_d", F.size("__omh_h") - F.size(F.array_distinct("__omh_h")))  # how many are repeats
    # where k-mers repeat: sort (hash, place) packed in one number, ...
    p, q = _bits(F.size("__omh_h")), _bits(c("d"))
    place = lambda x: x.bitwiseAND(_shl(F.lit(1).cast("long"), p) - 1)
    df = df.withColumn("__omh_s", F.when(c("d") > 0, F.sort_array(F.transform("__omh_h", lambda h, i: _shl(h, p).bitwiseOR(i.cast("long"))))))
    # ... point each at the one before it in its run and follow the pointers by doubling to the run's first, ...
    back = F.transform(c("s"), lambda x, j: F.when((j > 0) & (_shr(x, p) == _shr(F.get(c("s"), j - 1), p)), j - 1).otherwise(j))
    df = df.withColumn("__omh_f", F.when(c("d") > 0, F.aggregate(
        F.sequence(F.lit(1), q), back, lambda acc, _: F.transform(acc, lambda f: F.get(acc, f)))))
    # ... and give every place its occurrence number, back in text order
    df = df.withColumn("__omh_o", F.when(c("d") > 0, F.sort_array(F.transform(
        c("f"), lambda f, j: _shl(place(F.get(c("s"), j)), q).bitwiseOR((j - f).cast("long"))))))
    number = lambda x: x.bitwiseAND(_shl(F.lit(1).cast("long"), q) - 1)
    df = df.withColumn("__omh_g", F.when(c("d") > 0, F.transform(
        c("o"), lambda x, i: F.when(number(x) == 0, F.get(c("h"), i)).otherwise(F.xxhash64(F.get(c("h"), i), number(x))))).otherwise(c("h")))
    df = df.withColumn("__omh_a", F.sort_array("__omh_g"))
    df = df.withColumn("__omh_k", F.filter(
        "__omh_a", lambda x, j: (j < TUPLE) | (_shr(F.get(c("a"), j - TUPLE), _SHIFT) != _shr(x, _SHIFT))))
    df = df.withColumn("__omh_x", F.array_intersect("__omh_g", "__omh_k"))  # the selected, in text order
    classes = F.sequence(F.lit(0), F.lit(REPEATS - 1))
    # every class full: its smallest stand together; else the nearest by XOR
    full = F.transform(classes, lambda r: F.xxhash64(F.array_intersect(c("x"), F.slice(c("k"), r * TUPLE + 1, TUPLE))))

    def nearest(r: Column) -> Column:
        mask = _shl(r.cast("long"), _SHIFT)
        chosen = F.slice(F.sort_array(F.transform(c("k"), lambda x: x.bitwiseXOR(mask))), 1, TUPLE)
        return F.xxhash64(F.array_intersect(c("x"), F.transform(chosen, lambda y: y.bitwiseXOR(mask))))

    df = df.withColumn(out_col, F.when(F.size("__omh_k") == REPEATS * TUPLE, full).otherwise(F.transform(classes, nearest)))
    return df.drop(*[f"__omh_{x}" for x in "thdsfogakx"])


def likeness(a: Column, b: Column) -> Column:
    """Share of repeats in which two signatures agree."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.lit(float(REPEATS))


def as_text(sig: Column) -> Column:
    """A signature as hex digits, 8 a repeat."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x.bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def with_next(df: DataFrame, id_col: str, next_cols: dict[str, str], tie_col: str, buckets: int | None = None) -> DataFrame:
    """`df` with columns of the next row in descending id order; the last row's next is the first.

    A global order without a single task: ids are cut into ranges at
    quantiles that are ids of the table, each range is one window, and the row
    at a range's upper end is sent a second time to the range above, where it
    follows the last row.  Only the range ends (eight a shuffle partition)
    reach the driver.  Rows with equal ids follow the order of `tie_col`;
    rows with a null id come last.  In a table of null ids only, the last row
    has no next.
    """
    spark = df.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [(i + 1) / buckets for i in range(buckets)]
    got = df.agg(F.percentile_approx(id_col, at, 100 * buckets).alias("q"), F.max(id_col).alias("m")).first()
    ends = sorted({*(got["q"] or []), *([got["m"]] if got["m"] is not None else [])})
    group = max(1, int(len(ends) ** 0.5))
    listed = lambda xs: (F.split(F.lit(",".join(map(str, xs))), ",") if xs else F.array()).cast("array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda e: e < F.col(id_col)))
    coarse = below(listed(ends[group - 1::group]))
    df = df.withColumn("__coarse", coarse)
    df = df.withColumn("__range", F.col("__coarse") * group + below(F.slice(listed(ends), F.col("__coarse") * group + 1, group)))
    is_end = F.coalesce(F.get(listed(ends), F.col("__range")) == F.col(id_col), F.lit(False))
    here = F.struct(F.col("__range").alias("range"), F.lit(0).alias("again"))
    above = F.struct(((F.col("__range") + 1) % max(1, len(ends))).alias("range"), F.lit(1).alias("again"))
    kept = [c for c in df.columns if not c.startswith("__")]
    sent = df.select(*kept, F.inline(F.when(is_end, F.array(here, above)).otherwise(F.array(here))).alias("__to", "__again"))
    turn = Window.partitionBy("__to").orderBy("__again", F.col(id_col).desc_nulls_last(), tie_col)
    led = sent.select(*kept, "__again", *[F.lead(col).over(turn).alias(new) for col, new in next_cols.items()])
    return led.where("__again = 0").drop("__again")


def edited_texts(text: Column, following: Column) -> Column:
    """`text` with its last third of code points replaced by as many (or all) of the beginning of `following`."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - third), F.substr(F.coalesce(following, F.lit("")), F.lit(1), third))


def fingerprint_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    Null texts count as empty.  Rows may repeat; an empty table gives an empty
    result; other columns are ignored.  Texts cross the network once.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = signatures(base, "text", "sig")
    pairs = with_next(own, "id", {"text": "next_text", "sig": "next_sig"}, "text")
    pairs = pairs.withColumn("edited", edited_texts(F.col("text"), F.col("next_text")))
    pairs = signatures(pairs.select("id", F.length("text").cast("long").alias("n_chars"), "sig", "next_sig", "edited"), "edited", "edited_sig")
    return pairs.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sig")).alias("fingerprint"),
        as_text(F.col("edited_sig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        F.coalesce(likeness(F.col("sig"), F.col("next_sig")), F.lit(0.0)).alias("near_next"))
