"""Line deduplication by a log-template tree.

As in fixed-depth log parsing, a line first goes down a tree by its number of
tokens and its leading tokens; tokens with digits are variable from the start.
Lines that meet in a leaf and agree with the leaf's leading line in most
places share one template, in which the places that vary are wild.  The lines
left over vote again, until no group of them can recur, so every family of a
leaf gets its own template.  A template that recurs across documents is
boilerplate: its lines are dropped everywhere.

Only names of lines and leaves (hashes) move, but for two steps: the lines of
recurring leaves, whose tokens are compared, and the texts that are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import drop_stored, stored

#: Leading tokens in the tree, share of places to agree in, share from which a place is fixed, and the number of
#: different texts from which a template counts as recurring.
DEPTH, AGREE, FIXED, MIN_DOCS = 3, 0.7, 0.6, 3
WILD = "<*>"
_BLANK = r"\x20\t\n\x0B\f\r"
#: Tokens without a digit, then one with a digit: a match starts where the last one ended, so no character is tried twice.
VARIABLE = rf"\G((?:[^0123456789{_BLANK}]*+[{_BLANK}])*+)[^0123456789{_BLANK}]*+[0123456789][^{_BLANK}]*+"


def masked_lines(text: Column) -> Column:
    """The lines of a text, in order, with one space between tokens and variable tokens wild; blank lines are empty."""
    text = F.coalesce(text, F.lit(""))
    runs = text.contains("  ")  # most texts have no run of blanks to replace
    for c in "\t\x0B\f\r":
        runs = runs | text.contains(c)
    blanks = F.when(runs, F.regexp_replace(text, r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+", " ")).otherwise(text)
    return F.transform(F.split(F.regexp_replace(blanks, VARIABLE, f"$1{WILD}"), "\n"), lambda x: F.trim(x))


def leaf(line: Column) -> Column:
    """The tree's leaf of a masked line: token count and leading tokens."""
    return F.xxhash64(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))), F.substring_index(line, " ", DEPTH))


def _text_name(text: Column) -> list[Column]:
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2")]


def masked_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h1, h2, lines): every row's text as its masked lines; h1 and h2 name the text."""
    return docs.select(F.col(id_col).alias("id"), *_text_name(F.col(text_col)), masked_lines(F.col(text_col)).alias("lines"))


def occurrences(masked: DataFrame) -> DataFrame:
    """(id, h1, h2, pos, leaf, name): every line that is not blank; `name` names the masked line."""
    rows = masked.select("id", "h1", "h2", F.posexplode("lines").alias("pos", "line"))
    return rows.where("line != ''").select("id", "h1", "h2", "pos", leaf(F.col("line")).alias("leaf"), F.xxhash64("line").alias("name"))


def known_lines(masked: DataFrame, found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(grp, name, line, n), stored: the different lines of every leaf that recurs in `min_docs` texts, the leaf as first group."""
    texts = found.select("h1", "h2", "leaf").distinct()
    busy = texts.groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf")
    lines = masked.select(F.explode(F.array_distinct("lines")).alias("line")).where("line != ''")
    known = (lines.select(leaf(F.col("line")).alias("leaf"), "line").join(busy, "leaf", "left_semi")
             .groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n")))
    return stored(known.select(F.col("leaf").alias("grp"), F.xxhash64("line").alias("name"), "line", "n"), "lines")


def counted(lines: DataFrame) -> DataFrame:
    """(grp, place, token, n, m): for every token at a place of a group, its weight and its number of lines."""
    places = lines.select("grp", "n", F.posexplode(F.split("line", " ")).alias("place", "token"))
    return places.groupBy("grp", "place", "token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"))


def less(votes: DataFrame, gone: DataFrame) -> DataFrame:
    """The counts `votes` without those of lines that left their groups."""
    minus = gone.select("grp", "place", "token", (-F.col("n")).alias("n"), (-F.col("m")).alias("m"))
    return votes.unionByName(minus).groupBy("grp", "place", "token").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where("m > 0")


def vote(known: DataFrame, votes: DataFrame) -> DataFrame:
    """`known` with `agrees` (with the group's leading line) and `template`: the shared pattern, or the line itself."""
    lead = votes.groupBy("grp", "place").agg(F.max_by("token", F.struct("n", "token")).alias("token"), (F.max("n") / F.sum("n")).alias("share"))
    leading = lead.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("place", "token", "share"))).alias("lead"))
    both = known.join(leading, "grp").withColumn("tokens", F.split("line", " "))
    agree = F.size(F.filter("lead", lambda p: F.get(F.col("tokens"), p["place"]) == p["token"])) / F.size("lead")
    shared = F.array_join(F.transform("lead", lambda p: F.when(p["share"] >= FIXED, p["token"]).otherwise(WILD)), " ")
    judged = both.select("grp", "name", "line", "n", (agree >= AGREE).alias("agrees"), shared.alias("shared"))
    pattern = F.when(F.col("agrees"), F.col("shared")).otherwise(F.col("line"))
    return judged.withColumn("template", F.xxhash64("grp", pattern)).drop("shared")


def regroup(voted: DataFrame, votes: DataFrame, often: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old, grp, name, line, n), the lines that got no shared template that recurs, in the groups of the next vote; and
    the counts of the groups that are split, without the lines that are settled.  Both are stored.

    Where the vote settled half of a group or more, the rest votes again as
    one group.  Elsewhere several families are mixed: the rest is split by
    its tokens at the place with the fewest different ones, tokens of one
    line together.  So a group halves or is split for good each round.
    """
    settled = voted.where("agrees").join(often, "template", "left_semi").select("grp", "name", F.lit(True).alias("settled"))
    state = stored(voted.join(settled, ["grp", "name"], "left").select("grp", "name", "line", "n", F.coalesce("settled", F.lit(False)).alias("settled")), "state")
    weights = state.groupBy("grp").agg((2 * F.sum(F.when(F.col("settled"), F.col("n")).otherwise(0)) >= F.sum("n")).alias("half"))
    halves, split = weights.where("half").select("grp"), weights.where("not half").select("grp")
    rest = state.where("not settled").drop("settled")
    mixed, same = rest.join(split, "grp", "left_semi"), rest.join(halves, "grp", "left_semi")
    of_token = stored(less(votes.join(split, "grp", "left_semi"), counted(state.where("settled").join(split, "grp", "left_semi"))), "votes")
    tried = of_token.groupBy("grp", "place").agg(F.count(F.lit(1)).alias("tokens"), F.sum("m").alias("lines"))
    place = (tried.where((F.col("tokens") > 1) & (F.col("tokens") < F.col("lines")))
             .groupBy("grp").agg(F.min(F.struct("tokens", "place"))["place"].alias("place")))
    repeated = of_token.where("m > 1").select("grp", "place", "token", F.lit(True).alias("again"))
    parts = (mixed.join(place, "grp").withColumn("token", F.get(F.split("line", " "), F.col("place")))
             .join(repeated, ["grp", "place", "token"], "left"))
    key = F.xxhash64("grp", "place", F.when(F.col("again"), F.col("token")))
    moved = (same.select(F.col("grp").alias("old"), "grp", "name", "line", "n")
             .unionByName(parts.select(F.col("grp").alias("old"), key.alias("grp"), "name", "line", "n")))
    rest = stored(moved, "rest")
    drop_stored(state)
    return rest, of_token


def next_votes(rest: DataFrame, known: DataFrame, of_token: DataFrame) -> DataFrame:
    """The counts of the groups of `known`, the next vote, stored.

    The largest part of a split group takes that group's counts less those of
    the other parts.  So the tokens of a line are counted again only where its
    group has halved, however many parts are split off one by one.
    """
    sizes = rest.where("grp != old").groupBy("old", "grp").agg(F.count(F.lit(1)).alias("lines"))
    largest = sizes.groupBy("old").agg(F.max(F.struct("lines", "grp"))["grp"].alias("largest"))
    largest = stored(largest.join(known.select(F.col("grp").alias("largest")).distinct(), "largest", "left_semi"), "largest")
    others = rest.join(largest, "old").where("grp != largest").select(F.col("largest").alias("grp"), "n", "line")
    parents = of_token.join(largest, F.col("grp") == F.col("old")).select(F.col("largest").alias("grp"), "place", "token", "n", "m")
    fresh = known.join(largest.select(F.col("largest").alias("grp")), "grp", "left_anti")
    return stored(counted(fresh).unionByName(less(parents, counted(others))), "votes")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, h1, h2, n_lines, dropped): per distinct (id, text) its count of non-blank lines and the sorted numbers of those to drop."""
    masked = stored(masked_texts(docs, id_col, text_col), "masked")  # masking costs most by far: once a text
    found = stored(occurrences(masked), "occurrences")
    known, where_ = known_lines(masked, found, min_docs), found.withColumnRenamed("leaf", "grp")
    drop_stored(masked)
    gone, votes = None, stored(counted(known), "votes")
    while True:  # a vote per round, until no group is left in which a template can recur
        voted = stored(vote(known, votes), "voted")
        named = stored(where_.join(voted.select("grp", "name", "template"), ["grp", "name"])
                       .select("id", "h1", "h2", "pos", "grp", "name", "template"), "named")
        often = stored(named.select("template", "h1", "h2").distinct().groupBy("template").count()
                       .where(F.col("count") >= min_docs).select("template"), "often")
        out = named.join(often, "template", "left_semi").select("id", "h1", "h2", "pos")
        gone = out if gone is None else gone.unionByName(out)
        rest, of_token = regroup(voted, votes, often)
        drop_stored(votes)
        if rest.isEmpty():
            break
        where_ = stored(named.select("id", "h1", "h2", "pos", F.col("grp").alias("old"), "name")
                        .join(rest.select("old", "grp", "name"), ["old", "name"]).drop("old"), "left")
        busy = (where_.select("grp", "h1", "h2").distinct().groupBy("grp").count().where(F.col("count") >= min_docs)
                .join(rest.groupBy("grp").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1"), "grp", "left_semi").select("grp"))
        known = stored(rest.drop("old").join(busy, "grp", "left_semi"), "lines")
        if known.isEmpty():
            break
        votes = next_votes(rest, known, of_token)
        drop_stored(of_token)
    gone = gone.groupBy("id", "h1", "h2").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    lines = found.select("id", "h1", "h2", "pos").distinct().groupBy("id", "h1", "h2").agg(F.count(F.lit(1)).alias("n_lines"))
    a, b = lines.alias("a"), gone.alias("b")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
    return a.join(b, same, "left").select("a.id", "a.h1", "a.h2", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, prefix: str = "") -> DataFrame:
    """`docs` with `clean_text`, `n_lines` and `n_dropped`, each behind `prefix`.

    A line goes when its template occurs in at least `min_docs` different
    texts (exact copies of a text count once).  Blank lines and all else stay
    as they are, line breaks included.  Null texts stay null with 0 lines;
    repeated rows come back as often; an empty table gives an empty result.
    A very common line is one hot leaf: its rows are joined, never gathered.
    """
    names = [prefix + x for x in ("clean_text", "n_lines", "n_dropped")]
    if set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(set(names) & set(docs.columns))} exist; choose another prefix")
    d = docs.select("*", *[c.alias(f"__{n}") for n, c in zip(("h1", "h2"), _text_name(F.col(text_col)))]).alias("d")
    g = dropped_lines(docs, id_col, text_col, min_docs).alias("g")
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("g.id")) & (F.col("d.__h1") == F.col("g.h1")) & (F.col("d.__h2") == F.col("g.h2"))
    kept = F.array_join(F.filter(F.split(F.col(f"d.{text_col}"), "\n"), lambda x, i: ~F.array_contains("g.dropped", i)), "\n")
    return d.join(g, same, "left").select(
        *[F.col(f"d.{c}") for c in docs.columns], F.when(F.size("g.dropped") > 0, kept).otherwise(F.col(f"d.{text_col}")).alias(names[0]),
        F.coalesce("g.n_lines", F.lit(0)).alias(names[1]), F.coalesce(F.size("g.dropped"), F.lit(0)).cast("long").alias(names[2]))
