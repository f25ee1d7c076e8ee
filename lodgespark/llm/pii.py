"""Personal data: fixed base rules, and boosted trees over the proposals of high-recall generators.

Base spans (email, ip, card, phone) come from patterns and validity checks and
always stay.  Generators propose further spans, which may overlap each other:
written-out addresses, numbers inside longer runs that the base rules drop
whole, phone numbers without a plus.  Gradient-boosted trees score a proposal
by its format and context; a threshold per kind, calibrated on rows the trees
did not see, selects the ones to redact; all spans are used for both.  Everything is a column expression:
positions come from the pieces between the matches, the fitted trees are
nested CASE expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, possessive where that changes no match, so that long runs take linear time and no stack:
#: a run of local-part characters or digits can only match from its start or from the end of the match before.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has no base span of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
#: Generators, two or more a kind; they see the text with the kind's base spans blanked out.
GENERATORS = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]++(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]++)++",
              r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s@\s?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"(?<![0-9])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}", r"(?<![0-9])[0-9]{1,3}+(?:[,\x20]?\.[\x20]?[0-9]{1,3}+){3}(?![0-9])"),
    "card": (r"(?<![0-9])[0-9]{13,19}+(?![0-9])", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
             r"(?<![0-9])[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])"),
    "phone": (r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[\x20.-]{1,2}[0-9]{2,4}){2,4}(?![0-9])", r"(?<![0-9])00[1-9][0-9\x20()-]{7,16}[0-9](?![0-9])"),
}
PROPOSAL_NEEDS = {"email": r"@|[(\[{]at[)\]}]", "ip": r"[0-9]\.[\x20]?[0-9]", "card": "[0-9]{4}", "phone": "[0-9]{2}"}
CONTEXT = {"email": r"(?i)(mail|contact|write)", "ip": r"(?i)(\bip\b|host|server|addr)", "card": r"(?i)(card|visa|credit|pay)",
           "phone": r"(?i)(tel|phone|call|fax|mobile|cell|dial)"}
FEATURES = ("email", "ip", "card", "phone", "length", "digits", "separators", "letters", "plus", "luhn", "octets",
            "left", "right", "left_joined", "right_joined", "context")
#: Fill of blanked spans: a sign that no pattern holds.
BLANK = "￼"
#: Trees, depth, wanted precision, and steps of the thresholds.
TREES, DEPTH, PRECISION, BINS = 12, 3, 0.95, 20
LEFT_CHARS, RIGHT_CHARS = 24, 8


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running sums, maxima, ...: log2(n) passes, each combining a value with the one 2^t places before."""
    n = F.size(values)
    steps = F.sequence(F.lit(0), F.length(F.bin((n - 1).cast("long"))) - 1)
    both = F.aggregate(steps, values, lambda acc, t: F.transform(
        acc, lambda x, i: F.coalesce(op(x, F.get(acc, i - F.call_function("shiftleft", F.lit(1), t))), x)))
    return F.when(n > 1, both).otherwise(values)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _octets(x: Column) -> Column:
    """All parts of digits at most 255, however many zeros lead them."""
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.filter(F.split(x, "[^0-9]+"), lambda p: part(p) != ""), lambda p: F.when(
        F.length(part(p)) <= 3, part(p).try_cast("int") <= 255).otherwise(False))


def valid(kind: str, x: Column) -> Column:
    d = _digits(x)
    if kind == "ip":
        return _octets(x)
    if kind == "card":
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(d).between(9, 15)
    return F.lit(True)


def _features(kind: str, x: Column, left: Column, right: Column) -> Column:
    def char_class(c: Column) -> Column:
        return F.when(c.rlike(r"^[0-9]"), 3.0).when(c.rlike(r"^\p{L}"), 2.0).when(c.rlike(r"^\S"), 1.0).otherwise(0.0)
    d = _digits(x)
    flag = lambda c: c.cast("double")
    return F.array(*[F.lit(float(k == kind)) for k in KINDS], flag(F.length(x)), flag(F.length(d)),
                   flag(F.length(F.regexp_replace(x, r"[^ .()\-]", ""))), flag(F.length(F.regexp_replace(x, r"[^A-Za-z]", ""))),
                   flag(x.startswith("+")), flag(F.call_function("luhn_check", F.when(d != "", d).otherwise("1"))), flag(_octets(x)),
                   char_class(F.right(left, F.lit(1))), char_class(right),
                   flag(left.rlike(r"[0-9][ .-]?$")), flag(right.rlike(r"^[ .-]?[0-9]")), flag(left.rlike(CONTEXT[kind])))


_SPANS = "array<struct<kind:string,start:int,end:int,text:string,ok:boolean,features:array<double>>>"


def _pieces(df: DataFrame, text: str, pattern: str, needs: str) -> DataFrame:
    """`df` with __match, the matches of a pattern, and __between, the pieces around them (null where nothing matches)."""
    found = F.when(F.col(text).rlike(needs), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    df = df.withColumn("__match", found).withColumn("__match", F.when(F.size("__match") > 0, F.col("__match")))
    return df.withColumn("__between", F.when(F.col("__match").isNotNull(), F.split(F.col(text), pattern, -1)))


def _found(df: DataFrame, text: str, kind: str, pattern: str, needs: str, out: str) -> DataFrame:
    """`df` with `out`: the matches as spans in code points, with their validity and features."""
    df = _pieces(df, text, pattern, needs)
    b, steps = F.col("__between"), F.transform("__match", lambda m, i: F.length(F.get(F.col("__between"), i)) + F.length(m))
    df = df.withColumn("__ends", steps).withColumn("__ends", F.when(F.col("__match").isNotNull(), _running(F.col("__ends"), lambda x, y: x + y)))
    end = lambda i: F.get(F.col("__ends"), i)
    spans = F.transform("__match", lambda m, i: F.struct(
        F.lit(kind).alias("kind"), (end(i) - F.length(m)).alias("start"), end(i).alias("end"), m.alias("text"), valid(kind, m).alias("ok"),
        _features(kind, m, F.right(F.get(b, i), F.lit(LEFT_CHARS)), F.left(F.get(b, i + 1), F.lit(RIGHT_CHARS))).alias("features")))
    return df.withColumn(out, F.coalesce(spans.cast(_SPANS), F.array().cast(_SPANS))).drop("__match", "__between", "__ends")


def _blank(df: DataFrame, text: str, kind: str) -> DataFrame:
    """`df` with the kind's valid base spans in `text` overwritten, length kept."""
    df = _pieces(df, text, BASE[kind], NEEDS[kind])
    filled = F.transform("__match", lambda m, i: F.concat(
        F.get(F.col("__between"), i), F.when(valid(kind, m), F.repeat(F.lit(BLANK), F.length(m))).otherwise(m)))
    whole = F.concat(F.array_join(filled, ""), F.element_at("__between", -1))
    return df.withColumn(text, F.coalesce(whole, F.col(text))).drop("__match", "__between")


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, proposed) per row: arrays of struct(kind, start, end, text, ok, features), from one pass over the texts.

    `base` holds the valid base spans by kind and start; `proposed` the
    generators' spans in the text with the base spans blanked out.
    """
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    for kind in KINDS:
        df = _found(df, "__text", kind, BASE[kind], NEEDS[kind], f"__{kind}")
        df = df.withColumn(f"__{kind}", F.filter(f"__{kind}", lambda s: s["ok"]))
    for kind in KINDS:
        df = _blank(df, "__text", kind)
    made = []
    for kind in KINDS:
        for i, pattern in enumerate(GENERATORS[kind]):
            df = _found(df, "__text", kind, pattern, PROPOSAL_NEEDS[kind], f"__{kind}{i}")
            made.append(F.col(f"__{kind}{i}"))
    return df.select("id", F.concat(*[F.col(f"__{k}") for k in KINDS]).alias("base"), F.array_distinct(F.concat(*made)).alias("proposed"))


@dataclass
class SpanModel:
    """Trees as (weight, nested (feature, threshold, left, right) or leaf value); `threshold` per kind, above 1 where none is met."""
    trees: list[tuple[float, object]]
    threshold: dict[str, float]

    def score(self, features: Column) -> Column:
        def of(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            i, cut, low, high = node
            return F.when(F.get(features, F.lit(i)) <= cut, of(low)).otherwise(of(high))
        if not self.trees:
            return F.lit(0.5)
        total = F.aggregate(F.array(*[F.lit(w) * of(t) for w, t in self.trees]), F.lit(0.0), lambda a, b: a + b)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))


def _nested(node) -> object:
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _nested(node.leftChild()), _nested(node.rightChild()))


def examples(found: DataFrame) -> DataFrame:
    """(kind, held, features, label, n): all examples, those alike as one row with their number.

    Base spans are examples of personal data, proposals that fail their kind's
    validity check are counter-examples; valid proposals beyond the base are
    what the trees are to judge and teach nothing.  One in three, by the hash
    of their text, is held back.
    """
    span = lambda col: found.select(F.explode(col).alias("s"))
    one = span("base").select("s.*", F.lit(1.0).alias("label"))
    none = span("proposed").where(~F.col("s.ok")).select("s.*", F.lit(0.0).alias("label"))
    held = F.pmod(F.xxhash64(F.lit(1), "kind", "text"), F.lit(3)) == 0
    return one.unionByName(none).groupBy("kind", held.alias("held"), "features", "label").agg(F.count(F.lit(1)).cast("double").alias("n"))


def learn(found: DataFrame, precision: float = PRECISION) -> SpanModel:
    """Boosted trees on all examples that are not held back, weighted by their number.

    The held ones calibrate the thresholds: per kind the lowest score from
    which on at least `precision` of them are personal data.  Without examples
    of both classes nothing is added to the base.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = stored(examples(found), "spans")
    held = F.col("held")
    if rows.where(~held).select("label").distinct().count() < 2:
        return SpanModel([], {k: 2.0 for k in KINDS})
    fitted = rows.where(~held).select("label", array_to_vector("features").alias("features"), F.col("n").alias("weight"))
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, stepSize=0.3, weightCol="weight").fit(fitted)
    model = SpanModel([(float(w), _nested(t._java_obj.rootNode())) for w, t in zip(gbt.treeWeights, gbt.trees)], {})
    bins = (rows.where(held).withColumn("bin", F.floor(model.score(F.col("features")) * BINS)).groupBy("kind", "bin")
            .agg(F.sum(F.col("label") * F.col("n")).alias("hit"), F.sum("n").alias("n")).collect())
    for kind in KINDS:
        hit = n = 0.0
        best = 2.0
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            hit, n = hit + r["hit"], n + r["n"]
            if hit >= precision * n and r["bin"] >= BINS // 2:
                best = r["bin"] / BINS
        model.threshold[kind] = best
    return model


def _unions(df: DataFrame, spans: str, kind: str) -> DataFrame:
    """`df` with column `spans` (sorted array of start, end) as unions of what overlaps, tagged with the kind."""
    reach, first = f"{spans}_reach", f"{spans}_first"
    df = df.withColumn(reach, _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)))
    # a span starts a union where nothing before it reaches it; the union ends where the last span before the next start reaches
    marked = F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), i.alias("i"), (
        (i == 0) | (F.get(F.col(reach), i - 1) <= s["start"])).alias("new")))
    df = df.withColumn(first, F.filter(marked, lambda s: s["new"]))
    after = lambda i: F.coalesce(F.get(F.col(first), i + 1)["i"], F.size(reach))
    return df.withColumn(spans, F.transform(first, lambda s, i: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), F.get(F.col(reach), after(i) - 1).alias("end"))))


def selected(found: DataFrame, model: SpanModel) -> DataFrame:
    """`found` with `added`: the chosen proposals by kind, those that overlap in a kind as their union."""
    df, out = found, [F.array().cast("array<struct<kind:string,start:int,end:int>>")]
    for kind in KINDS:
        if model.trees and model.threshold[kind] <= 1:
            chosen = F.filter("proposed", lambda s: (s["kind"] == kind) & s["ok"] & (  # noqa: B023
                model.score(s["features"]) >= model.threshold[kind]))  # noqa: B023
            df = df.withColumn(f"__{kind}", F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
            df = _unions(df, f"__{kind}", kind)
            out.append(F.col(f"__{kind}"))
    return df.select(*found.columns, F.concat(*out).alias("added"))


def _listed(spans: Column) -> Column:
    """kind:start:end, by kind as listed in KINDS, then start."""
    key = F.transform(spans, lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["start"].alias("start"),
                                                s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(key), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added per row.

    Counts and hash are those of the base spans; `spans` lists base and added
    ones.  Positions are code points, ends exclusive.  Null texts count as
    empty; repeated rows come back as often; other columns are ignored; an
    empty table gives an empty result.
    """
    found = stored(proposals(docs, id_col, text_col), "spans-found")
    got = selected(found, learn(found))
    short = lambda col: F.transform(col, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    got = got.withColumn("__base", short("base"))
    count = lambda kind: F.size(F.filter("__base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select(F.col("id").alias(id_col), *[count(k) for k in KINDS], F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
                      _listed(F.concat("__base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` (ids unique) with the spans of `find_personal_data` replaced by [kind], as column `redacted`.

    Overlapping spans become one mark, named after the first.
    """
    parts = F.split(F.col("spans"), ",")
    item = F.array_sort(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.struct(
        F.split(p, ":")[1].cast("int").alias("start"), F.split(p, ":")[2].cast("int").alias("end"), F.split(p, ":")[0].alias("kind"))))
    df = docs.join(spans.select(id_col, item.alias("__s")), id_col, "left")
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
        F.struct(F.concat(acc["out"], F.substr(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"), s["end"].alias("at")))
    done = F.aggregate(F.coalesce("__s", F.array().cast("array<struct<start:int,end:int,kind:string>>")),
                       F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    df = df.withColumn("__done", done)
    return df.withColumn("redacted", F.concat(F.col("__done.out"), F.substr(F.col(text_col), F.col("__done.at") + 1))).drop("__s", "__done")
