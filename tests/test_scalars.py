"""Edge tables of the row-level functions (values follow the original code)."""

import ast
import datetime as dt
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgespark import constants as K
from lodgespark.functions import scalars as S


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_parse_price(spark):
    vals = ["$1,234.50", "-$5", "1e3", "$0.00", "1.2.3", ".", "abc", "", None]
    assert one_col(spark, vals, S.parse_price) == [1234.5, 5.0, 13.0, 0.0, None, None, None, None, None]


def test_parse_price_signed(spark):
    assert one_col(spark, ["-$5", "$1,2", "abc", None], S.parse_price_signed) == [-5.0, 12.0, None, None]


def test_categorize_price(spark):
    vals = [None, 0.0, -1.0, 9.99, 10.0, 20.0, 30.0]
    got = one_col(spark, vals, lambda c: S.categorize_price(c, 10, 20, 30), "double")
    assert got == [K.CATEGORY_UNKNOWN] * 3 + [K.CATEGORY_LOW, K.CATEGORY_MID, K.CATEGORY_HIGH, K.CATEGORY_TOP]


def test_quartile_fallback_only_at_zero(spark):
    got = one_col(spark, [0.0, 5.0, None], lambda c: S.quartile_or_default(c, 60000), "double")
    assert got == [60000.0, 5.0, None]


def test_count_list_items(spark):
    vals = ['["a","b"]', "['a','b']", "('a','b')", "{'a','a'}", "[1, 2,]", "[None, True]", "[]",
            '{"a":1}', "3", '["a",', "", None]
    assert one_col(spark, vals, S.count_list_items) == [2, 2, 2, 1, 2, 2, 0, 0, 0, 0, 0, 0]


def test_parse_list(spark):
    got = one_col(spark, ['["a","b"]', "not json", None], S.parse_list)
    assert got == [["a", "b"], [], []]


def test_parse_date(spark):
    got = one_col(spark, ["2024-01-05", "2024-13-01", "bad", None], S.parse_date)
    assert got == [dt.date(2024, 1, 5), None, None, None]
    got = one_col(spark, ["2020-01-01 junk", "2020-01-01T99:99", "2020-1-5", "2020-01-01 10:30", "2020-01-01T10:30:00Z", "2020-02-30"], S.parse_date)
    assert got == [None, None, dt.date(2020, 1, 5), dt.date(2020, 1, 1), dt.date(2020, 1, 1), None]


def test_parse_id(spark):
    assert one_col(spark, ["12", " 12", "12.0", "1.5", "abc", "", None, "1e3"], S.parse_id) == [12, 12, 12, None, None, None, None, 1000]


def test_lists_are_complete_and_words_in_strings_stay(spark):
    texts = ['["a","b"] junk', '["a"]["b"]', "['a', ('b','c')]", "['a' 'b']", '["True north", None]', "('a')", "('a',)", "{}", "{'a','a'}",
             "['a', null]", '["a", null]', "[1, 2.5]", '["' + "x" * 50000 + '"]', "[" + "1," * 20000 + "1]"]
    assert one_col(spark, texts, S.count_list_items) == [0, 0, 2, 1, 2, 0, 1, 0, 1, 0, 2, 2, 1, 20001]
    got = one_col(spark, ['["True north", None]', "['it\\'s', \"d\"]", "['a' 'b']"], S.parse_list)
    assert got == [["True north", None], ["it's", "d"], ["ab"]]


def test_parse_numeric_agrees_on_both_sides_of_300_characters(spark):
    for n in (298, 299, 300, 301, 302, 310):
        text = "0." + "1" * (n - 2)
        big = "1" * n
        got = one_col(spark, [text, big], S.parse_numeric)
        assert abs(got[0] - float(text)) < 1e-15 and got[1] == (float(big) if n <= 308 else None)


def test_date_parts_review(spark):
    df = spark.createDataFrame([("2024-01-06",), ("2024-01-01",), (None,)], "v string")
    d = S.parse_date("v")
    rows = df.select(S.weekday_monday0(d), S.is_weekend(d)).collect()
    assert [tuple(r) for r in rows] == [(5, 1), (0, 0), (None, 0)]


def test_iso_week(spark):
    df = spark.createDataFrame([("2021-01-03",), ("2024-12-30",)], "v string")
    rows = df.select(S.iso_week(S.parse_date("v")), F.year(S.parse_date("v"))).collect()
    assert [tuple(r) for r in rows] == [(53, 2021), (1, 2024)]


def test_map_flag(spark):
    assert one_col(spark, ["t", "f", "T", "yes", "1", None], S.map_flag) == [True, False, None, None, None, None]


def test_parse_numeric(spark):
    vals = ["1", "1.5 ", " 2", "1e3", "inf", "x", "nan", "5d", "1_0", "1,000", "0x10", "True", "", None]
    got = one_col(spark, vals, S.parse_numeric)
    assert got[:4] == [1.0, 1.5, 2.0, 1000.0]
    assert math.isinf(got[4])
    assert got[5:] == [None] * 9


def test_parse_numeric_exponent_range(spark):
    # pandas gives up when the decimal exponent it scales by passes 308, and
    # when a finite text overflows; inf words count only without blanks
    vals = ["0e309", "0.0e309", "0.1e309", "1e308", "1e309", "10e308", "1e-400", " inf", "-Infinity", "1E5 "]
    got = one_col(spark, vals, S.parse_numeric)
    assert got[:4] == [None, 0.0, 1e308, 1e308]
    assert got[4:8] == [None, None, 0.0, None]
    assert got[8] == float("-inf") and got[9] == 100000.0


def test_null_tokens(spark):
    got = one_col(spark, ["", "NA", "NaN", "None", " x ", "#N/A", "n/a"], S.normalize_null_token)
    assert got == [None, None, None, None, " x ", None, None]


@pytest.mark.parametrize("value,scale,expected", [(0.125, 2, 0.12), (2.675, 2, 2.68), (0.25, 1, 0.2),
                                                  (0.35, 1, 0.4), (2.25, 1, 2.2),
                                                  # binary 1.03499..., 1234.5649...: pandas rounds down
                                                  (1.035, 2, 1.03), (1234.565, 2, 1.23456e3)])
def test_round_half_even(spark, value, scale, expected):
    assert one_col(spark, [value], lambda c: S.round_half_even(c, scale), "double") == [expected]


def test_parse_percent(spark):
    assert one_col(spark, ["97%", "N/A", None], S.parse_percent) == [0.97, None, None]


def test_truncate_and_display(spark):
    long = "x" * 5000
    assert one_col(spark, [long], lambda c: F.length(S.truncate_text(c))) == [4000]
    assert one_col(spark, [long], S.display_text) == ["x" * 70 + "..."]


def test_fill_comment(spark):
    assert one_col(spark, [None, "ok"], S.fill_comment) == [K.MISSING_COMMENT, "ok"]


def test_flag_to_int(spark):
    assert one_col(spark, ["t", "f", "x"], S.flag_to_int) == [1, 0, None]
    assert one_col(spark, ["t", "f", "x"], lambda c: S.flag_to_int(c, unknown=0)) == [1, 0, 0]


def _python_list(text):
    """What json and ast read as a list, tuple or set; None for anything else."""
    for read in (json.loads, ast.literal_eval):
        try:
            found = read(text.strip())
        except Exception:
            continue
        if isinstance(found, list) or (read is ast.literal_eval and isinstance(found, (tuple, set))):
            return list(found)
    return None


DEEP_LISTS = [
    '["a", ["b", ["c"]]]', '[{"k": [1]}, "z"]', "[[[[]]]]", '["a"]] junk', '["a"]} junk', '["a"],"w":1', '["a"],["b"]', "[1,2", "[",
    "['\\u00e9', '\\x41\\'s', 'a\\tb', \"q\\\"\", '\\101', '\\U0001F600']", "['x', ['y', ('z', {'k': [1, 2]})], {'a', 'b'}]", "('a',)", "('a')",
    "([1,2])", "((([1,2],3)))", "((((1),)))", "(((1)))", "(1,((2)))", "1,2,3", "'a','b'", "[1],[2]", "{1,1,2}", "{[1]}", "{(1,[2])}", "{(1,2):[3]}",
    "[{1:2,},(3,),((4)),]", "[1,,2]", "[,]", "[()  ,{}, []]", "[None, True, -1.5e3, 0x1F, 1_000, .5, 2j]", "[foo]", "['a', ['b' 'c',\n 'd']]",
    '["a", {"b": "]"}, "[,"]', "['a]', ['b,', \"c'\"]]", "[[1,2],[3,4],]", " [ [ 1 ] , 2 ] ", "a, b", "[[01]]", "[[012.5]]", "['a\\\nb', [1]]",
    "[" * 150 + "]" * 150, "[" * 201 + "]" * 201, "('x', ['" + "y" * 3000 + "'])", "[\"a\", ['b']]", "1,2 3", "[[1],[2]] [3]", "[1](2)", "{'a':1},",
    '["\\ud83d\\ude00", [1]]', "[" + "[1]," * 500 + "]",
]


def test_lists_of_any_depth_as_json_and_ast_read_them(spark):
    rows = spark.createDataFrame([(t,) for t in DEEP_LISTS], "t string").select("t", S.count_list_items("t").alias("n"), S.parse_list("t").alias("items"))
    for r in rows.collect():
        want = _python_list(r["t"])
        assert (r["n"], len(r["items"])) == (len(want or []),) * 2, r["t"][:80]
        for got, item in zip(r["items"], want or []):
            if isinstance(item, str):
                assert got == item
            elif isinstance(item, (list, tuple, dict)) and item and len(r["t"]) < 200:  # nested items stay lists or dicts that can be read
                back = _python_list(f"[{got}]")[0]
                assert back == item


_ITEMS = st.lists(st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-999, 999), st.text("ab'\"\\[](){},: \té\n", max_size=6)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.tuples(inner, inner), st.dictionaries(st.text("k'", max_size=2), inner, max_size=2)),
    max_leaves=8), max_size=5)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_ITEMS, st.sampled_from([list, tuple]), st.sampled_from(["", "", "]", ")", ",", " x"])), min_size=40, max_size=40))
def test_lists_written_by_repr_and_json(spark, cases):
    texts = [repr(kind(items)) + tail for items, kind, tail in cases] + [json.dumps(items) + tail for items, _, tail in cases]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.parse_list("t").alias("items")).collect()
    for r in rows:
        want = _python_list(r["t"])
        assert len(r["items"]) == len(want or []), r["t"]
        assert [g for g, w in zip(r["items"], want or []) if isinstance(w, str)] == [w for w in want or [] if isinstance(w, str)]
