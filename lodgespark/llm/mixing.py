"""Mixing documents to target weights of domains with soft membership.

A naive Bayes classifier learnt from a labelled table gives every document
posteriors over the domains.  Projected least squares then fits a
nonnegative rate per document so that the expected tokens of each domain,
sum over documents of rate * tokens * posterior, match the targets.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .shared import SPACE_RUN, stored

#: Hashed words, marks that end a word, labelled rows fitted (bounded sample), pseudo-counts, and most domains.
BUCKETS, MARKS, SAMPLE_DOCS, PSEUDO, MAX_DOMAINS = 1 << 14, '.,;:!?#$%&*|"()', 20_000, 20.0, 64
#: Evidence of a text counts as that of at most about so many words, which keeps memberships soft.
SOFT_WORDS = 40.0
#: Aggregates at most, relative miss that counts as met, and weight of the pull to the last multipliers in the first and last rounds.
MAX_STEPS, TOLERANCE, FIRST_PULL, LAST_PULL = 200, 1e-4, 0.1, 1e-7


def words(text: Column) -> Column:
    """Distinct words of a text as they are written."""
    return F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != ""))


def word_bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(F.lower(F.rtrim(word, F.lit(MARKS)))), F.lit(BUCKETS)).cast("int")


def shape_bucket(word: Column) -> Column:
    """The mark that ends a word, and whether its letters are capitals."""
    capitals = (word == F.upper(word)) & (word != F.lower(word)) & (F.length(word) > 1)
    return F.lit(BUCKETS) + 2 * F.instr(F.lit(MARKS), F.right(word, F.lit(1))) + capitals.cast("int")


@dataclass
class DomainModel:
    """`table`: bucket -> log-likelihood of each domain against all (at most BUCKETS + 2 * len(MARKS) + 2 rows)."""
    domains: list[str]
    prior: list[float]
    table: DataFrame


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "domain",
          sample_docs: int = SAMPLE_DOCS) -> DomainModel:
    """Fit on at most `sample_docs` labelled rows, a documented bound, chosen by the hash of the id.

    The domains and their priors are those of the whole label table.  A domain
    of less than an even share is sampled as if it had one, so a rare domain
    has its own rows in the sample however few they are.  Word counts are summed
    in Spark; the driver sees one row per domain.  Null ids and null domains
    teach nothing.
    """
    all_known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                 .select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("domain")))
    size = {r["domain"]: r["n"] for r in all_known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).limit(MAX_DOMAINS + 1).collect()}
    if len(size) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    domains, labelled = sorted(size), sum(size.values())
    # a row's turn is its hash as a share, shrunk where its domain is rare: one top-k gathers the smallest
    chance = {d: max(size[d] / labelled, 1 / len(size)) / size[d] for d in domains}
    turn = F.lit(0.0)
    for d in domains:
        turn = F.when(F.col("domain") == d, F.lit(1.0 / chance[d])).otherwise(turn)
    known = all_known.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 52)) * turn, "id", "domain").limit(sample_docs)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    of_word = texts.join(F.broadcast(known), "id").select("domain", F.explode(words(F.col("text"))).alias("w"))
    counts = stored(of_word.select("domain", F.explode(F.array(word_bucket(F.col("w")), shape_bucket(F.col("w")))).alias("bucket"))
                    .groupBy("domain", "bucket").agg(F.count(F.lit(1)).alias("n")), "domains")
    # words and shapes are two multinomials; each domain is smoothed towards all domains together
    kind = (F.col("bucket") >= BUCKETS).cast("int").alias("kind")
    total = {(r["domain"], r["kind"]): r["n"] for r in counts.groupBy("domain", kind).agg(F.sum("n").alias("n")).collect()}
    every = {k: sum(total.get((d, k), 0) for d in domains) for k in (0, 1)}
    n_of = counts.groupBy("bucket").pivot("domain", domains).agg(F.sum("n")) if domains else counts.select("bucket").limit(0)
    n_of = n_of.na.fill(0)
    here = sum((F.col(f"`{d}`") for d in domains), F.lit(0))

    def evidence(d: str) -> Column:
        def of(k: int) -> Column:
            share = here / F.lit(float(max(1, every[k])))
            expected = share * float(total.get((d, k), 0))
            return F.log((F.col(f"`{d}`") + F.lit(PSEUDO)) / (expected + F.lit(PSEUDO)))
        return F.when(F.col("bucket") >= BUCKETS, of(1)).otherwise(of(0))

    table = n_of.select("bucket", F.array(*[evidence(d) for d in domains]).cast("array<double>").alias("evidence"))
    return DomainModel(domains, [math.log(size[d] / labelled) for d in domains], stored(table, "domain-model"))


def memberships(docs: DataFrame, model: DomainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, n_tokens, p0, p1, ...) per row: posteriors in the order of `model.domains`.

    `n_tokens` counts words; null, empty and blank texts have none and the
    prior as posterior.  `text_key` is the text's hash: (id, text_key) names
    the row for joins.
    """
    k = range(len(model.domains))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"),
                       F.size(F.filter(F.split(text, SPACE_RUN), lambda w: w != "")).cast("long").alias("n_tokens"),
                       words(text).alias("ws"))
    each = (rows.select("row", "id", "text_key", "n_tokens", F.explode_outer("ws").alias("w"))
            .select("row", "id", "text_key", "n_tokens", word_bucket(F.col("w")).alias("b0"), shape_bucket(F.col("w")).alias("b1")))
    small = F.broadcast(model.table)  # a row per bucket
    for b in ("b0", "b1"):
        each = each.join(small.select(F.col("bucket").alias(b), F.col("evidence").alias("e" + b)), b, "left")
    value = lambda i: F.coalesce(F.col("eb0")[i], F.lit(0.0)) + F.coalesce(F.col("eb1")[i], F.lit(0.0))
    sums = each.groupBy("row", "id", "text_key", "n_tokens").agg(
        F.count("b0").alias("m"), *[F.sum(value(i)).alias(f"s{i}") for i in k])
    soft = F.lit(SOFT_WORDS) / (F.lit(SOFT_WORDS) + F.col("m"))
    logit = sums.select("id", "text_key", "n_tokens", *[(F.lit(model.prior[i]) + F.col(f"s{i}") * soft).alias(f"l{i}") for i in k])
    top = F.greatest(*[F.col(f"l{i}") for i in k]) if len(k) > 1 else F.col("l0") if len(k) else F.lit(0.0)
    raised = logit.select("id", "text_key", "n_tokens", *[F.exp(F.col(f"l{i}") - top).alias(f"x{i}") for i in k])
    all_ = sum((F.col(f"x{i}") for i in k), F.lit(0.0))
    return raised.select("id", "text_key", "n_tokens", *[(F.col(f"x{i}") / all_).alias(f"p{i}") for i in k])


@dataclass
class Fit:
    """How rates were fitted: expected and target tokens per domain, and whether the optimum was reached."""
    converged: bool
    steps: int
    tokens: dict[str, float]
    target: dict[str, float]

    @property
    def residuals(self) -> dict[str, float]:
        """Expected tokens over target, less 1; of a target of 0 the tokens over all tokens."""
        total = sum(self.tokens.values()) or 1.0
        return {d: s / self.target[d] - 1 if self.target[d] > 0 else s / total for d, s in self.tokens.items()}


def fit_rates(members: DataFrame, domains: list[str], weights: Mapping[str, float], total_tokens: float | None = None,
              max_rate: float | None = None, max_steps: int = MAX_STEPS) -> DataFrame:
    """`members` (stored) with `rate` >= 0 per row, and the `Fit` as attribute `fit`.

    Minimises sum_k (S_k - T_k)^2 / W_k over rates in [0, max_rate], S_k the
    expected tokens of domain k, T_k the target and W_k the larger of T_k and
    S_k at rate 1; of the rates that do, it takes those nearest to 1 where
    rows weigh as their tokens.  Such rates are the projection onto
    [0, max_rate] of 1 less the posteriors times one multiplier per domain.
    The multipliers solve a k-by-k system by Newton steps with line search,
    within rounds of the method of multipliers; a step is one aggregate of
    one row over the table, and no rates are stored between steps.
    Without `total_tokens` the total is that of all rows at rate 1.  Domains
    without a weight have target 0.  Targets that no rates reach (a domain
    without tokens, or rates held by `max_rate`) are met as closely as can be;
    `fit.converged` is false, and a warning tells, where `max_steps` steps
    missed the optimum.
    """
    k = len(domains)
    scale = sum(weights.get(d, 0.0) for d in domains)
    state = members.withColumn("rate", F.lit(1.0))
    if not k or scale <= 0:
        state.fit = Fit(True, 0, {}, {})
        return state
    share = np.array([weights.get(d, 0.0) / scale for d in domains])
    p = [F.col(f"p{i}") for i in range(k)]
    start = np.array([x or 0.0 for x in members.agg(*[F.sum(F.col("n_tokens") * x) for x in p]).first()])
    total = float(start.sum()) if total_tokens is None else float(total_tokens)
    target = total * share
    width = np.maximum(target, start)
    width = np.where(width > 0, width, 1.0)

    def pull(dual: np.ndarray) -> Column:
        return sum((x * F.lit(float(m)) for x, m in zip(p, dual)), F.lit(0.0))

    def rate(dual: np.ndarray) -> Column:
        moved = F.greatest(F.lit(0.0), F.lit(1.0) - pull(dual))
        return moved if max_rate is None else F.least(F.lit(float(max_rate)), moved)

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    steps = 0

    def measure(dual: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected tokens, their slopes and the value of the dual."""
        nonlocal steps
        steps += 1
        r, n = F.col("r"), F.col("n_tokens")
        free = (r > 0) if max_rate is None else (r > 0) & (r < float(max_rate))
        got = members.withColumn("r", rate(dual)).agg(
            *[F.sum(r * n * x) for x in p], *[F.sum(F.when(free, n * p[i] * p[j]).otherwise(0.0)) for i, j in pairs],
            F.sum(n * ((r - 1) * (r - 1) / 2 + r * pull(dual)))).first()
        got = [x or 0.0 for x in got]
        slope = np.zeros((k, k))
        for (i, j), x in zip(pairs, got[k:-1]):
            slope[i, j] = slope[j, i] = x
        return np.array(got[:k]), slope, got[-1]

    dual, converged, old, weight = np.zeros(k), False, None, FIRST_PULL
    tokens, slope, value = measure(dual)
    while True:
        off = (tokens - target) / width
        # met, or (no rates meet the targets) a whole round of the last weight left the misses as they were
        met = (np.abs(tokens - target) <= TOLERANCE * np.where(target > 0, target, width)).all()
        converged = bool(met or (old is not None and np.abs(off - old).max() <= TOLERANCE * np.abs(off).max()))
        if converged or steps >= max_steps:
            break
        old, centre, settled = (off if weight == LAST_PULL else None), dual, False
        objective = lambda v, x: v - x @ target - weight / 2 * (width * (x - centre) ** 2).sum()  # noqa: B023, E731
        while not settled and steps < max_steps:
            gradient = tokens - target - weight * width * (dual - centre)
            settled = (np.abs(gradient) <= TOLERANCE / 100 * width).all()
            if settled:
                break
            move = np.linalg.solve(slope + np.diag(weight * width), gradient)
            now, length = objective(value, dual), 1.0
            while steps < max_steps:
                tried = dual + length * move
                tokens, slope, value = measure(tried)
                if objective(value, tried) >= now + 1e-4 * length * (gradient @ move) - 1e-12 * abs(now) or length < 1e-6:
                    break
                length /= 2
            dual = tried
        if not settled:  # the steps ran out within a round: only met targets count as the optimum
            converged = bool((np.abs(tokens - target) <= TOLERANCE * np.where(target > 0, target, width)).all())
            break
        weight = max(LAST_PULL, weight / 10)
    state = members.withColumn("rate", rate(dual))
    state.fit = Fit(converged, steps, dict(zip(domains, map(float, tokens))), dict(zip(domains, map(float, target))))
    if not converged:
        warnings.warn(f"rates not fitted after {steps} steps; residuals {state.fit.residuals}", stacklevel=2)
    return state


def mix(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "domain", total_tokens: float | None = None, max_rate: float | None = None) -> tuple[DataFrame, list[str]]:
    """(rows of id, text_key, n_tokens, p0.., rate; the domains in order).

    One row per row of `docs`.  Without any label all rates are 1.  A weighted
    domain that no row of `labels` has cannot be aimed at: a warning names it,
    and the other weights are scaled to fill its share.
    """
    model = learn(docs, labels, id_col, text_col, label_col)
    unknown = sorted(d for d, w in weights.items() if w > 0 and d not in model.domains)
    if unknown and model.domains:
        warnings.warn(f"weighted domains without a label: {', '.join(unknown)}", stacklevel=2)
    members = stored(memberships(docs, model, id_col, text_col), "members")
    return fit_rates(members, model.domains, weights, total_tokens, max_rate), model.domains


def draw(docs: DataFrame, rates: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with every row as often as its rate says: the whole part, and once more with the chance of the rest,
    decided by the hash of id, text and seed, so a second run draws the same rows."""
    copies = (rates.select("id", "text_key", "rate").distinct()
              .withColumn("u", F.pmod(F.xxhash64(F.lit(seed), "id", "text_key"), F.lit(1 << 52)) / F.lit(float(1 << 52)))
              .select(F.col("id").alias("__id"), F.col("text_key").alias("__key"),
                      (F.floor("rate") + (F.col("u") < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("__n"))
              .where("__n > 0"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.struct()
    d = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text_key")).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("c.__id")) & (F.col("d.text_key") == F.col("c.__key"))
    out = d.join(copies.alias("c"), same).select("row", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    return out.select("row.*")
