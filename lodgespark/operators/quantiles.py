"""Exact quantiles at any number of distinct values, as one lazy plan.

A KLL sketch of the values (a few ten KB a task, merged on the way) gives each
wanted rank a bracket of two values; a second sketch of the values inside the
bracket narrows it.  A last pass counts the values below the bracket and keeps
the distinct ones inside, about one in five thousand, which are counted up to the
rank.  No values are stored, no job runs while the frame is built, and the
sketches decide only how much is kept, never the result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, places read from it, and rank error allowed for: three times the sketch's own at 99 % confidence
#: (2.296 / k^0.9021), so a bracket that misses its rank is not to be expected; the last pass would find it.
SKETCH_K, GRID = 4096, 256
MARGIN = 3 * 2.296 / SKETCH_K ** 0.9021
#: Parts of a group whose rows meet their brackets in different tasks.
SALT = 16


def _qname(p: float) -> str:
    return "q" + f"{p * 100:g}".replace(".", "_")


def exact_quantiles(df: DataFrame, column: str, probs: Iterable[float], approx: bool = False,
                    accuracy: int = 10000) -> DataFrame:
    """One row with the quantiles of the non-null values, linearly interpolated
    as pandas does; null for a column without values.  ``approx=True`` gives
    ``percentile_approx`` (an element of the data, no interpolation)."""
    probs = [float(p) for p in probs]
    names = [_qname(p) for p in probs]
    if approx:
        one = df.agg(F.percentile_approx(F.col(column), probs, accuracy).alias("q"))
        return one.select(*[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    found = _quantiles(df.select(F.col(column).cast("double").alias("x")), [], probs)
    # the aggregate without keys gives a row of nulls where there is no value
    return found.agg(F.first("q").alias("q")).select(*[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def grouped_quantiles(df: DataFrame, keys: list[str], probs: Iterable[float], value: str = "x", few: bool = False) -> DataFrame:
    """(keys..., n, q) per group: exact quantiles of the non-null values with
    linear interpolation, as ``percentile`` and pandas' ``quantile`` give, but
    no task ever merges a group's distinct values (``percentile`` does, in
    one task per group).

    Groups with a null key are groups like others; groups without any value
    are absent.  A group with most of the rows is met in SALT parts.  Where
    the groups are known to be few (the columns of a profile) their brackets
    are broadcast and the rows do not move.
    """
    return _quantiles(df.select(*keys, F.col(value).cast("double").alias("x")), keys, [float(p) for p in probs], few)


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _grid(sketch: str, n: str) -> str:
    places = ",".join(str(i / GRID) for i in range(GRID + 1))
    return f"CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double({sketch}, cast(split('{places}', ',') AS array<double>)) END"


def _bracket(grid: str, n: str, low: str, high: str, least: str, most: str) -> str:
    """Values that hold the ranks `low` to `high` of n between them; `least` and `most` where the grid ends."""
    a = f"int(floor((try_divide({low}, {n}) - {MARGIN}D) * {GRID})) - 1"
    b = f"int(ceil((try_divide({high} + 1, {n}) + {MARGIN}D) * {GRID})) + 1"
    return (f"named_struct('lo', CASE WHEN {a} < 0 THEN {least} ELSE get({grid}, {a}) END, "
            f"'hi', CASE WHEN {b} > {GRID} THEN {most} ELSE get({grid}, {b}) END)")


def _meet(values: DataFrame, found: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """`values` with `__at` of their group.

    The values must never be the side that is broadcast: repeated ones shuffle
    to so few bytes that adaptive execution would send them all, unpacked, to
    the driver and every executor.  Few groups are broadcast themselves, many
    meet the values in a sort-merge join.
    """
    if not keys:
        return values.withColumn("__at", found.select("__at").scalar())
    right = found.selectExpr(*[f"{_name(k)} AS {_name('__' + k)}" for k in keys], "__at")
    same = " AND ".join(f"{_name(k)} <=> {_name('__' + k)}" for k in keys)
    if few:
        met = values.join(F.broadcast(right), F.expr(same))
    else:
        right = right.selectExpr("*", f"explode(sequence(0, {SALT - 1})) AS __part")
        met = values.selectExpr("*", f"spark_partition_id() % {SALT} AS __salt").join(right.hint("merge"), F.expr(f"__salt = __part AND {same}"))
    return met.select(*map(_name, keys), "x", "__at")


def _quantiles(values: DataFrame, keys: list[str], probs: list[float], few: bool = False) -> DataFrame:
    """As SQL text where expressions repeat: a plan of a thousand small columns takes the driver seconds to put together."""
    values = values.where("x IS NOT NULL AND NOT isnan(x)")
    named, each = list(map(_name, keys)), range(len(probs))
    place = [f"((n - 1) * {p!r}D)" for p in probs]
    low, high = [f"floor({x})" for x in place], [f"ceil({x})" for x in place]
    inf = "double('infinity')"

    first = values.groupBy(*named).agg(F.count("x").alias("n"), F.kll_sketch_agg_double("x", F.lit(SKETCH_K)).alias("__s"))
    first = first.selectExpr(*named, "n", f"{_grid('__s', 'n')} AS __g")
    wide = ", ".join(_bracket("__g", "n", low[i], high[i], f"-{inf}", inf) for i in each)
    wide = first.selectExpr(*named, f"named_struct('n', n, 'b', array({wide})) AS __at")

    aggs = ["first(__at) AS __at"]
    for i in each:
        inside = f"x >= __at.b[{i}].lo AND x <= __at.b[{i}].hi"
        aggs += [f"count_if(x < __at.b[{i}].lo) AS __below{i}", f"count_if({inside}) AS __n{i}",
                 f"kll_sketch_agg_double(CASE WHEN {inside} THEN x END, {SKETCH_K}) AS __s{i}"]
    second = _meet(values, wide, keys, few).groupBy(*named).agg(*map(F.expr, aggs))
    second = second.selectExpr(*named, "__at", "__at.n AS n", *[c for i in each for c in (f"__below{i}", f"__n{i}", f"{_grid(f'__s{i}', f'__n{i}')} AS __g{i}")])
    narrow = []
    for i in each:
        a, z = f"({low[i]} - __below{i})", f"({high[i]} - __below{i})"
        inner = _bracket(f"__g{i}", f"__n{i}", a, z, f"__at.b[{i}].lo", f"__at.b[{i}].hi")
        # a first bracket without its rank: all values are kept
        narrow.append(f"CASE WHEN {a} < 0 OR {z} >= __n{i} THEN named_struct('lo', -{inf}, 'hi', {inf}) ELSE {inner} END")
    narrow = second.selectExpr(*named, f"named_struct('n', n, 'b', array({', '.join(narrow)})) AS __at")

    # per bracket the rows below as one null, then the distinct values inside with their counts
    held = ("filter(transform(__at.b, (b, i) -> CASE WHEN x <= b.hi THEN named_struct('__i', i, '__v', CASE WHEN x >= b.lo THEN x END) END), "
            "h -> h IS NOT NULL)")
    counted = (_meet(values, narrow, keys, few).selectExpr(*named, "__at.n AS n", f"inline({held})")
               .groupBy(*named, "n", "__i", "__v").agg(F.count(F.lit(1)).alias("__c")))
    over = f"(PARTITION BY {', '.join([*named, '__i'])} ORDER BY __v ASC NULLS FIRST ROWS UNBOUNDED PRECEDING)"
    ends = counted.selectExpr("*", f"sum(__c) OVER {over} AS __end", f"get(array({', '.join(place)}), __i) AS __rank")
    hit = lambda f: f"max(CASE WHEN {f}(__rank) >= __end - __c AND {f}(__rank) < __end THEN __v END)"
    per = ends.groupBy(*named, "n", "__i").agg(F.expr(f"{hit('floor')} AS __a"), F.expr(f"{hit('ceil')} AS __z"), F.expr("any_value(__rank) AS __rank"))
    exact = ("CASE WHEN __a IS NULL OR __z IS NULL THEN double(raise_error(\"a sketch's bracket missed its rank; run the query again\")) "
             "WHEN __a = __z THEN __a ELSE __a + (__z - __a) * (__rank - floor(__rank)) END")
    # one row a group, however many brackets
    return (per.selectExpr(*named, "n", "__i", f"{exact} AS __q").groupBy(*named, "n")
            .agg(*[F.expr(f"max(CASE WHEN __i = {i} THEN __q END) AS __q{i}") for i in each])
            .selectExpr(*named, "n", f"array({', '.join(f'__q{i}' for i in each)}) AS q"))
