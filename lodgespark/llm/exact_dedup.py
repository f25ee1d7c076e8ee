"""Exact deduplication by content-defined chunk recipes.

A text is cut where its own content says so, each chunk gets an identifier
that is checked against the chunk's content, and two texts are equal exactly
when their ordered lists of identifiers are.  Only distinct chunks cross the
network, once; afterwards long documents are represented by 16 bytes a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import one_space

#: Smallest and largest chunk in code points.
MIN_CHUNK, MAX_CHUNK = 256, 2048
#: A chunk ends behind a word whose last two characters are in these classes (about one word in ten of Latin text);
#: where a text has no such word, at MAX_CHUNK.
CUT_BEHIND = r"(?<=[aeiou0-4][a-m5-9,.] )"


def chunk_key(chunk: Column) -> Column:
    """128 bits of hash; collisions are found and resolved, so any function of the chunk would do."""
    return F.struct(F.xxhash64(chunk).alias("h1"), F.xxhash64(F.lit(1), chunk).alias("h2"))


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Ordered chunks whose concatenation is the text (empty: no chunk).

    A cut needs `least` code points since the last one, so it depends on
    nearby content alone and equal passages fall back into step.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{least},{most}}}?{CUT_BEHIND}|.{{1,{most}}}"), F.lit(0))


def clashing_chunks(pieces: DataFrame) -> DataFrame:
    """Of (key, chunk) rows, the distinct chunks whose key belongs to several chunks, numbered within the key.

    Rows: key, chunk, ordinal.  Empty when every key stands for one content.
    """
    contents = pieces.select("key", "chunk").distinct()
    several = contents.groupBy("key").count().where("count > 1").select("key")
    return (contents.join(several, "key", "left_semi")
            .withColumn("ordinal", F.row_number().over(Window.partitionBy("key").orderBy("chunk"))))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            key: Callable[[Column], Column] = chunk_key) -> DataFrame:
    """(id, text_sha256, recipe, n_rows): one row per distinct (id, normalised text).

    The recipe is the ordered list of verified chunk identifiers.  A key that
    stands for several contents gets the ordinal of the content as part of the
    identifier; without any such key (checked over all chunks) the ordinal is
    0 throughout and the lists are built where the text is read.
    """
    norm = docs.select(F.col(id_col).alias("id"), one_space(F.col(text_col)).alias("norm"))
    cut = norm.select("id", F.sha2("norm", 256).alias("text_sha256"), chunks(F.col("norm")).alias("chunks"))
    pieces = norm.select(F.explode(chunks(F.col("norm"))).alias("chunk")).select(key(F.col("chunk")).alias("key"), "chunk")
    clashes = clashing_chunks(pieces)
    if clashes.limit(1).count() == 0:
        listed = cut.select("id", "text_sha256", F.transform(
            "chunks", lambda c: F.struct(key(c).alias("key"), F.lit(0).alias("ordinal"))).alias("recipe"))
        return listed.groupBy("id", "text_sha256", "recipe").agg(F.count(F.lit(1)).alias("n_rows"))
    counted = cut.groupBy("id", "text_sha256", "chunks").agg(F.count(F.lit(1)).alias("n_rows"))
    rows = (counted.select("id", "text_sha256", "n_rows", F.posexplode_outer("chunks").alias("pos", "chunk"))
            .withColumn("key", key(F.col("chunk"))))
    named = rows.join(clashes, ["key", "chunk"], "left")
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", "key", F.coalesce("ordinal", F.lit(0)).alias("ordinal")))
    return (named.groupBy("id", "text_sha256", "n_rows").agg(F.array_sort(F.collect_list(item)).alias("items"))
            .select("id", "text_sha256", F.transform("items", lambda x: F.struct(
                x["key"].alias("key"), x["ordinal"].alias("ordinal"))).alias("recipe"), "n_rows"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 key: Callable[[Column], Column] = chunk_key) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each white-space run became one
    space; null counts as empty.  `keep_id` is the smallest id of the group
    (null only if all its ids are null), `group_size` counts rows.  Of rows
    repeated with the same id and text one is kept.  Rows with different texts
    under one id are different documents.  Extra columns are ignored; an empty
    table gives an empty result.  The group's aggregate combines on the map
    side, so a group with a third of all rows sends one row a task; the join
    back is one that adaptive execution splits.
    """
    r = recipes(docs, id_col, text_col, key)
    groups = r.groupBy("recipe").agg(F.min("id").alias("keep_id"), F.sum("n_rows").alias("group_size"))
    return (r.join(groups, "recipe")
            .select("id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1), F.col("n_rows"))).alias("copy"))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns, whatever their names; each text crosses the network once.
    """
    # the id as text that is never null: plain equality, whose partitioning serves the aggregate as well
    name = lambda c: F.concat(F.when(c.isNull(), "-").otherwise("+"), F.coalesce(c.cast("string"), F.lit("")))
    keep = exact_groups(docs, id_col, text_col).where("kept").select(name(F.col(id_col)).alias("keep_key"), F.col("text_sha256").alias("keep_sha"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    d = docs.select(row.alias("row"), name(F.col(f"`{id_col}`")).alias("key"), F.sha2(one_space(F.col(f"`{text_col}`")), 256).alias("sha"))
    turn = Window.partitionBy("key", "sha").orderBy(F.lit(0))  # of repeated rows one
    return (d.join(keep, (F.col("key") == F.col("keep_key")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
            .withColumn("turn", F.row_number().over(turn)).where("turn = 1").select("row.*"))
