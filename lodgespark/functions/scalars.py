"""Scalar (row-level) functions, each ``Column -> Column``.

All are built from Spark built-ins, so Catalyst fuses them into one
projection under whole-stage code generation.  ``try_cast`` is used wherever a
raw value is parsed, because ANSI mode turns a bad cast into an error.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgespark import constants as K

__all__ = [
    "col_of", "normalize_null_token", "parse_price", "parse_price_signed", "parse_numeric",
    "categorize_price", "quartile_or_default", "count_list_items", "parse_list", "parse_date", "parse_id",
    "format_date_iso", "month_period", "map_flag", "flag_to_int", "weekday_monday0",
    "iso_week", "is_weekend", "fill_comment", "truncate_text", "display_text",
    "round_half_even", "parse_percent",
]

# A whole ISO date, or date and time of day; nothing may follow.
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_ISO_DATE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _built_once(fn: Callable[..., Column]) -> Callable[..., Column]:
    """The expression of a column given by name is put together once per JVM.

    A parsing expression takes hundreds of small calls from Python to the JVM;
    it is immutable and refers to its column by name alone, so every table
    with such a column can use the same one.
    """
    built: dict[tuple, tuple] = {}

    @wraps(fn)
    def once(c, *args) -> Column:
        if not isinstance(c, str):
            return fn(c, *args)
        gateway, expression = built.get((c, *args), (None, None))
        if expression is None or gateway is not SparkContext._gateway:
            expression = fn(c, *args)
            built[c, *args] = (SparkContext._gateway, expression)
        return expression

    return once


def normalize_null_token(c, tokens=None) -> Column:
    """Missing-value tokens of the raw reader (empty, NA, NaN, None, ...) -> null."""
    c = col_of(c)
    return F.when(c.isin(*(tokens or K.NULL_TOKENS)), F.lit(None)).otherwise(c)


@_built_once
def parse_price(c) -> Column:
    """Keep only digits and dots, then to double; empty or malformed -> null.
    The sign is lost ('-$5' -> 5.0) and an exponent is merged ('1e3' -> 13.0)."""
    digits = F.regexp_replace(col_of(c).cast("string"), r"[^0-9.]", "")
    return _try_double(F.nullif(digits, F.lit("")))


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


# pandas' parser keeps at most this many mantissa digits, and gives up (null)
# when the decimal exponent it scales by exceeds the largest double exponent.
_MANTISSA_DIGITS = 17
_MAX_DECIMAL_EXPONENT = 308
_MANTISSA_TEXT = r"^\s*[+-]?(\d*)\.?(\d*)"


def _exponent_in_range(s: Column) -> Column:
    """For exponent text: the scale pandas applies, i.e. the written exponent
    plus the integer digits past the mantissa limit, minus the fraction digits
    read into the mantissa, is at most 308 ('0e309' -> null, '0.0e309' -> 0)."""
    int_digits = F.length(F.regexp_extract(s, _MANTISSA_TEXT, 1))
    frac_digits = F.length(F.regexp_extract(s, _MANTISSA_TEXT, 2))
    written = F.coalesce(F.regexp_extract(s, r"[eE]([+-]?\d+)\s*$", 1).try_cast("double"), F.lit(0.0))
    scale = (written + F.greatest(int_digits - _MANTISSA_DIGITS, F.lit(0))
             - F.least(frac_digits, F.greatest(F.lit(_MANTISSA_DIGITS) - int_digits, F.lit(0))))
    return scale <= _MAX_DECIMAL_EXPONENT


_BLANKS = " \t\n\r\f\u000b"
_INF_TEXT = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


@_built_once
def parse_numeric(c) -> Column:
    """Text -> double as pandas' coercing parser does: blanks, sign, exponent and
    inf accepted; anything else (including 'nan', '5d', '1,000') -> null.  A
    finite text that overflows ('1e309', '10e308') is null, as in pandas.

    The cast does the parsing.  The tests before it read only the text: they
    reject what Java's parser takes and pandas' does not (NaN, a type suffix,
    hex), so a plain number costs one cast and one character-class test.
    Only text with an exponent (or over 300 characters) is checked for
    overflow.
    """
    raw = col_of(c).cast("string")
    t = F.btrim(raw, F.lit(_BLANKS))
    v = t.try_cast("double")
    low = F.lower(t)
    java_only = low.rlike("[nx_]|[df]$")  # nan, hex, digit groups, type suffix
    may_overflow = (F.instr(low, "e") > 0) | (F.length(t) > 300)
    return (F.when(F.lower(raw).isin(*_INF_TEXT), v)  # inf words only without blanks, as in pandas
             .when(java_only, F.lit(None))
             .when(~may_overflow, v)
             .when(_exponent_in_range(t) & ~F.abs(v).eqNullSafe(F.lit(float("inf"))), v))


def parse_price_signed(c) -> Column:
    """The analysis variant: drop only '$' and ',' and parse the rest."""
    return parse_numeric(F.regexp_replace(col_of(c).cast("string"), r"[$,]", ""))


def quartile_or_default(q, default: float) -> Column:
    """A quartile of exactly 0 falls back to the default (NaN/null do not)."""
    q = col_of(q) if not isinstance(q, (int, float)) else F.lit(float(q))
    return F.when(q == 0, F.lit(float(default))).otherwise(q)


def categorize_price(price, q25, q50, q75) -> Column:
    """null or <= 0 -> unknown; then < q25, < q50, < q75, else the top class."""
    p = col_of(price)
    lit = lambda v: F.lit(float(v)) if isinstance(v, (int, float)) else col_of(v)
    return (F.when(p.isNull() | (p <= 0), F.lit(K.CATEGORY_UNKNOWN))
            .when(p < lit(q25), F.lit(K.CATEGORY_LOW))
            .when(p < lit(q50), F.lit(K.CATEGORY_MID))
            .when(p < lit(q75), F.lit(K.CATEGORY_HIGH))
            .otherwise(F.lit(K.CATEGORY_TOP)))


_LIST_TYPE = "array<string>"

# Lists as JSON or as Python literals write them.  Every repetition is
# possessive, so the match is linear and needs no stack on long text.
_DQ = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SQ = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_ESCAPE = r"\\(?:u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2}|[0-7]{1,3}|.)"
# Python's numbers: no leading zero but in 0, other bases, fractions, exponents, imaginary ones.
_P_NUMBER = (r"[+-]?(?:0[xX][0-9A-Fa-f]++|0[oO][0-7]++|0[bB][01]++|(?:\d[\d_]*+)?\.\d++(?:[eE][+-]?\d++)?"
             r"|\d[\d_]*+(?:\.(?:[eE][+-]?\d++)?|[eE][+-]?\d++)|0[0_]*+|[1-9][\d_]*+)[jJ]?")
_J_NUMBER = r"-?(?:0|[1-9]\d*+)(?:\.\d++)?(?:[eE][+-]?\d++)?"


def _listed(element: str, trailing: str = "") -> str:
    return rf"\s*+(?:{element}\s*+(?:,\s*+{element}\s*+)*+{trailing})?"


_J_ATOM = rf"(?:{_DQ}|{_J_NUMBER}|true|false|null)"
_J_PAIR = rf"{_DQ}\s*+:\s*+{_J_ATOM}"
_J_ELEMENT = rf"(?:{_J_ATOM}|\[{_listed(_J_ATOM)}\]|\{{{_listed(_J_PAIR)}\}})"
_JSON_LIST = rf"(?s)^\s*+\[{_listed(_J_ELEMENT)}\]\s*+$"
_P_TEXT = rf"(?:{_DQ}|{_SQ})"
_P_ATOM = rf"(?:{_P_TEXT}(?:\s*+{_P_TEXT})*+|{_P_NUMBER}|True|False|None)"
_P_BODY = _listed(_P_ATOM, r"(?:,\s*+)?")
_P_PAIRS = _listed(rf"{_P_ATOM}\s*+:\s*+{_P_ATOM}", r"(?:,\s*+)?")
_P_ELEMENT = rf"(?:{_P_ATOM}|\[{_P_BODY}\]|\({_P_BODY}\)|\{{{_P_BODY}\}}|\{{{_P_PAIRS}\}})"
_P_ITEMS = _listed(_P_ELEMENT, r"(?:,\s*+)?")
_P_HASHED = _listed(rf"(?:{_P_ATOM}|\({_P_BODY}\))", r"(?:,\s*+)?")
# one element in round brackets is a tuple only with a comma; empty braces are a dict
_PYTHON_LIST = (rf"(?s)^\s*+(?:\[{_P_ITEMS}\]|\((?!\s*+{_P_ELEMENT}\s*+\)){_P_ITEMS}\)|\{{(?!\s*+\}}){_P_HASHED}\}})\s*+$")


def _inner(s: Column) -> Column:
    t = F.btrim(s, F.lit(_BLANKS))
    return F.substring(t, F.lit(2), F.length(t) - 2)


def _json_item(item: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), item, F.lit("]")), _LIST_TYPE)[0]


def _unquoted(part: Column) -> Column:
    """Text of one quoted part.  Its escapes are spelt as JSON spells them and read by ``from_json``; an escape that
    Python does not know keeps its backslash."""
    body = F.substring(part, F.lit(2), F.length(part) - 2)
    rest = lambda e: F.substring(e, F.lit(3), F.length(e) - 2)
    code = lambda digits: F.concat(F.lit(r"\u"), F.lpad(F.lower(digits), 4, "0"))
    value = lambda e: F.conv(rest(e), 16, 10).cast("long")
    half = lambda n: F.concat(F.lit(r"\u"), F.lower(F.hex(n)))

    def spelt(e: Column) -> Column:
        return (F.when(~e.startswith("\\"), F.replace(F.replace(e, F.lit('"'), F.lit(r'\"')), F.lit("\t"), F.lit(r"\t")))
                .when(e.rlike(r"^\\u[0-9A-Fa-f]{4}$"), code(rest(e)))
                .when(e.rlike(r"^\\x[0-9A-Fa-f]{2}$"), code(rest(e)))
                .when(e.rlike(r"^\\U[0-9A-Fa-f]{8}$"), F.when(value(e) < 0x10000, code(F.hex(value(e)))).otherwise(F.concat(
                    half(F.lit(0xD800) + F.call_function("shiftright", value(e) - 0x10000, F.lit(10))),
                    half(F.lit(0xDC00) + (value(e) - 0x10000).bitwiseAND(F.lit(0x3FF))))))
                .when(e.rlike(r"^\\[0-7]{1,3}$"), code(F.conv(F.substring(e, F.lit(2), F.length(e)), 8, 16)))
                .when(e == "\\\n", F.lit(""))
                .when(e.isin("\\a", "\\v", "\\'"), F.replace(F.replace(F.replace(
                    e, F.lit("\\a"), F.lit(r"\u0007")), F.lit("\\v"), F.lit(r"\u000b")), F.lit("\\'"), F.lit("'")))
                .when(e.isin('\\"', "\\\\", "\\n", "\\t", "\\r", "\\b", "\\f"), e)
                .otherwise(F.concat(F.lit("\\"), e)))

    pieces = F.regexp_extract_all(body, F.lit(f"(?s){_ESCAPE}|[^\\\\]++"), F.lit(0))
    text = F.array_join(F.transform(pieces, spelt), "")
    return F.when(F.instr(body, "\\") == 0, body).otherwise(_json_item(F.concat(F.lit('"'), text, F.lit('"'))))


def _python_item(item: Column) -> Column:
    """Text of a Python element: quoted parts joined and unescaped, None -> null, the rest as written."""
    parts = F.regexp_extract_all(item, F.lit(f"(?s){_P_TEXT}"), F.lit(0))
    quoted = item.rlike("^[\"']")
    return F.when(quoted, F.array_join(F.transform(parts, _unquoted), "")).when(item != "None", item)


def _deep_json(s: Column) -> Column:
    """Items of a JSON array of any depth, null for any other text.

    The reader stops behind a complete value, so the text is read inside an
    array and inside an object: whatever follows the array breaks one of the two.
    """
    strict = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
    in_array = F.from_json(F.concat(F.lit("["), s, F.lit("]")), f"array<{_LIST_TYPE}>", strict)
    in_object = F.from_json(F.concat(F.lit('{"v":'), s, F.lit("}")), f"v {_LIST_TYPE}", strict)
    return F.when((F.size(in_array) == 1) & in_object["v"].isNotNull(), in_array[0])


# Values while a Python literal is reduced from the inside: H atom, T tuple of values that can be hashed, V other
# tuple, L list, E set, D dict.  S is quoted text, the blank white space.
_ANY, _HASHED = "[HTVLED]", "[HT]"
_REDUCTIONS = [
    (rf"\[(?:{_ANY}(?:,{_ANY})*+,?)?\]", "L"),
    (rf"\{{(?:{_HASHED}:{_ANY}(?:,{_HASHED}:{_ANY})*+,?)?\}}", "D"),
    (rf"\{{{_HASHED}(?:,{_HASHED})*+,?\}}", "E"),
    (rf"\((?:{_HASHED},(?:{_HASHED}(?:,{_HASHED})*+,?)?)?\)", "T"),
    (rf"\({_ANY},(?:{_ANY}(?:,{_ANY})*+,?)?\)", "V"),
    # brackets around one value, but for those around the whole text
    (rf"(?<=[^(]\({{0,199}})\(({_ANY})\)|\(({_ANY})\)(?!\)*+$)", "$1$2"),
]
#: Python's own limit of open brackets.
_MAX_DEPTH = 200


def _deep_python(s: Column) -> Column:
    """Items of a Python list, tuple (its brackets may be left out) or set of any depth, null for any other text.

    The text is cut into tokens.  Whether they are one literal is decided on
    one letter a token, by reducing the innermost brackets to the kind of
    value they hold, level by level.  Its items are what the running depth of
    the brackets shows to stand between the commas of the outermost ones.
    """
    tokens = F.regexp_extract_all(F.btrim(s, F.lit(_BLANKS)), F.lit(rf"(?s){_DQ}|{_SQ}|{_P_NUMBER}|\w++|\s++|."), F.lit(0))
    kind = lambda t: (F.when(t.rlike("^[\\[\\](){},:]$"), t).when(t.rlike("^\\s"), " ")
                      .when(t.rlike("^[\"'].") , "S").when(t.rlike(rf"^(?:{_P_NUMBER}|True|False|None)$"), "H").otherwise("?"))
    # one struct, so that the tokens are made once
    cut = F.transform(F.array(tokens), lambda ts: F.struct(ts.alias("tokens"), F.transform(ts, kind).alias("kinds")))[0]

    def reduced(c: Column) -> Column:
        start = F.regexp_replace(F.replace(F.array_join(c["kinds"], ""), F.lit(" "), F.lit("")), "S++", "H")

        def step(now: Column, _: Column) -> Column:
            new = now["text"]
            for pattern, kind_of in _REDUCTIONS:
                new = F.regexp_replace(new, pattern, kind_of)
            return F.when(now["done"], now).otherwise(F.struct(new.alias("text"), (new == now["text"]).alias("done")))

        opened = F.length(start) - F.length(F.translate(start, "[({", ""))
        levels = F.sequence(F.lit(1), F.least(opened, F.lit(_MAX_DEPTH)) + 1)
        return F.aggregate(levels, F.struct(start.alias("text"), F.lit(False).alias("done")), step)["text"]

    def items(c: Column, base: Column) -> Column:
        begin = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("cuts"))

        def step(now: Column, k: Column) -> Column:
            depth = now["depth"] + F.when(k.isin("[", "(", "{"), 1).when(k.isin("]", ")", "}"), -1).otherwise(0)
            # before the outermost opening bracket's items, at their commas, and behind them
            cut_here = (((k == ",") & (now["depth"] == base))
                        | ((base > 0) & k.isin("[", "(", "{") & (depth == base)) | ((base > 0) & k.isin("]", ")", "}") & (now["depth"] == base)))
            cuts = F.when(cut_here, F.concat(now["cuts"], F.array(now["at"] + 1))).otherwise(now["cuts"])
            return F.struct(depth.alias("depth"), (now["at"] + 1).alias("at"), cuts.alias("cuts"))

        cuts = F.aggregate(c["kinds"], begin, step)["cuts"]
        ends = F.when(base > 0, cuts).otherwise(F.concat(F.array(F.lit(0)), cuts, F.array(F.size(c["kinds"]) + 1)))
        between = F.transform(F.slice(ends, F.lit(2), F.size(ends) - 1), lambda e, i: F.btrim(F.array_join(
            F.slice(c["tokens"], F.get(ends, i) + 1, e - F.get(ends, i) - 1), ""), F.lit(_BLANKS)))
        return F.transform(F.filter(between, lambda t: t != ""), _python_item)

    def read(c: Column) -> Column:
        text = c["reduced"]
        wrapped = F.regexp_extract(text, r"^(\(*+)([LETV])(\)*+)$", 1)
        base = (F.when(text.rlike(r"^\(*+[LETV]\)*+$") & (2 * F.length(wrapped) + 1 == F.length(text)), F.length(wrapped) + 1)
                .when(text.rlike(rf"^{_ANY}(?:,{_ANY})*+,?$") & (F.length(text) > 1), F.lit(0)))
        found = items(c["cut"], base)
        return F.when(base.isNotNull(), F.when(text.contains("E") & ~text.contains(","), F.array_distinct(found)).otherwise(found))

    known = F.transform(F.array(cut), lambda c: F.struct(c.alias("cut"), reduced(c).alias("reduced")))
    return F.transform(known, read)[0]


@_built_once
def _parse_list_or_null(c) -> Column:
    """Items of a text that is one complete list; null for any other text.

    Lists of at most one level of nesting are matched by one pattern each;
    only what may be a deeper one is taken apart.
    """
    s = col_of(c).cast("string")
    json_items = F.transform(F.regexp_extract_all(_inner(s), F.lit(f"(?s){_J_ELEMENT}"), F.lit(0)), _json_item)
    items = F.transform(F.regexp_extract_all(_inner(s), F.lit(f"(?s){_P_ELEMENT}"), F.lit(0)), _python_item)
    python_items = F.when(F.btrim(s, F.lit(_BLANKS)).startswith("{"), F.array_distinct(items)).otherwise(items)
    maybe = s.rlike(r"(?s)^\s*+[\[({].*[\])}],?\s*+$") | s.rlike(rf"(?s)^\s*+(?:[\"'\[({{]|{_P_NUMBER}|True|False|None).*,")
    return (F.when(s.rlike(_JSON_LIST), json_items).when(s.rlike(_PYTHON_LIST), python_items)
            .when(maybe, F.coalesce(_deep_json(s), _deep_python(s))))


def count_list_items(c) -> Column:
    """Size of a list encoded as JSON or as a Python literal; anything else -> 0."""
    return F.coalesce(F.size(_parse_list_or_null(c)), F.lit(0)).cast("int")


def parse_list(c) -> Column:
    """Encoded list -> array<string>; null or malformed -> empty array."""
    return F.coalesce(_parse_list_or_null(c), F.array().cast(_LIST_TYPE))


@_built_once
def parse_date(c) -> Column:
    """ISO text, with a valid time of day or none -> date; anything else,
    text with more behind it included, -> null (never an error)."""
    s = col_of(c).cast("string")
    timed = s.rlike(_ISO_DATE_TIME) & s.try_cast("timestamp").isNotNull()
    return F.when(s.rlike(_ISO_DATE) | timed, F.substring_index(F.substring_index(s, "T", 1), " ", 1).try_cast("date"))


@_built_once
def parse_id(c) -> Column:
    """Identifier text -> bigint: integer text directly, else through the
    numeric parser (so '12.0' and ' 12' still give 12); a fraction or junk -> null."""
    s = F.trim(col_of(c).cast("string"))
    v = parse_numeric(s)
    return F.coalesce(s.try_cast("long"), F.when(v == F.floor(v), v.try_cast("long")))


def format_date_iso(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM-dd")


def month_period(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM")


def map_flag(c) -> Column:
    """'t' -> true, 'f' -> false, anything else -> null (not cast(boolean))."""
    c = col_of(c)
    return F.when(c == "t", F.lit(True)).when(c == "f", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def flag_to_int(c, unknown=None) -> Column:
    c = col_of(c)
    out = F.when(c == "t", F.lit(1)).when(c == "f", F.lit(0))
    return F.coalesce(out, F.lit(int(unknown))) if unknown is not None else out


def weekday_monday0(c) -> Column:
    return F.weekday(col_of(c))


def iso_week(c) -> Column:
    return F.weekofyear(col_of(c))


def is_weekend(c) -> Column:
    """1 for Saturday/Sunday, 0 otherwise and for a null date."""
    return F.coalesce(F.weekday(col_of(c)).isin(5, 6), F.lit(False)).cast("int")


def fill_comment(c, text: str = K.MISSING_COMMENT) -> Column:
    return F.coalesce(col_of(c), F.lit(text))


def truncate_text(c, n: int = K.COMMENT_MAX_CHARS) -> Column:
    """First ``n`` characters (characters, not bytes)."""
    return F.substring(col_of(c), 1, n)


def display_text(c, n: int = K.DISPLAY_MAX_CHARS) -> Column:
    s = col_of(c).cast("string")
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def round_half_even(c, scale: int) -> Column:
    """Round a double the way pandas/numpy do: scale by 10**scale, round the
    binary value half to even (``rint``), scale back.  ``bround`` rounds the
    decimal text instead, so 1.035 (binary 1.03499...) would give 1.04."""
    f = float(10 ** scale)
    return F.rint(col_of(c).cast("double") * f) / f


def parse_percent(c) -> Column:
    """'97%' -> 0.97; 'N/A' and junk -> null."""
    return parse_numeric(F.regexp_replace(col_of(c).cast("string"), "%", "")) / 100.0
