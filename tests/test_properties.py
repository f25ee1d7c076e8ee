"""Property tests: the row functions against the library behaviour they
stand for (pandas' coercing numeric parser, pandas' rounding), on generated
text.  Each example is a batch of values checked in one Spark job."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodgespark.functions import scalars as S

NUMERIC_ALPHABET = st.sampled_from(list("0123456789.eE+- x,"))
numeric_text = st.one_of(
    st.text(NUMERIC_ALPHABET, min_size=0, max_size=8),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(str),
    st.integers(-10**6, 10**6).map(str),
    st.sampled_from(["inf", "-inf", "Infinity", " 7 ", "1e3", ".5", "5.", "nan", "NaN", "1_0", "0x1f"]),
)

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _pandas_numeric(v):
    out = pd.to_numeric(pd.Series([v], dtype="object"), errors="coerce").iloc[0]
    return None if pd.isna(out) else float(out)


@SETTINGS
@given(st.lists(numeric_text, min_size=50, max_size=200))
def test_parse_numeric_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(S.parse_numeric("v")).collect()]
    for v, g in zip(values, got):
        want = _pandas_numeric(v)
        if want is None:
            assert g is None, (v, g)
        elif math.isinf(want):
            assert g == want, (v, g)
        else:
            assert g is not None and math.isclose(g, want, rel_tol=1e-12, abs_tol=0.0), (v, g, want)


@SETTINGS
@given(st.lists(st.integers(-10**7, 10**7), min_size=50, max_size=200), st.sampled_from([1, 2]))
def test_round_half_even_matches_pandas(spark, ints, scale):
    # values with ties at the rounding digit, as means of small integer sets produce
    values = [i / 1000.0 for i in ints]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(S.round_half_even("v", scale)).collect()]
    want = pd.Series(values).round(scale).tolist()
    assert got == want
