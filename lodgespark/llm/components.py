"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import drop_stored, stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """Smallest node reachable from every node that has an edge to another.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    each round re-hangs every neighbour list on its smallest node with one
    aggregate and one join, so chains shrink geometrically and no list of
    neighbours is gathered in a task.  A node with very many neighbours is one
    key of the joins, which adaptive execution splits.  Each round is written
    to the shared folder; the driver sees two numbers a round.

    Returns (node, component); edges with a null end and self-loops are
    ignored, an empty edge table gives an empty result.
    """
    kind = edges.schema[a].dataType
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).cast(kind).alias("u"), F.least(a, b).cast(kind).alias("v")).distinct())
    e = stored(e, "edges")
    seen = _state(e)
    for _ in range(max_rounds):
        # large star: the larger neighbours of u go to the smallest of u's neighbours and u
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of u, and u, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), "m")
                 .where("u != m").select("u", F.col("m").alias("v")).distinct())
        nxt = stored(small, "edges")
        drop_stored(e)
        e, now = nxt, _state(nxt)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
