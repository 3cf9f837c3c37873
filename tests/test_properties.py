"""Property tests: the column helpers against plain-Python statements of the rules."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from staffline.functions import semantics

NUMERIC_TEXT = st.one_of(
    st.integers(-10**6, 10**6).map(str),
    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False).map(lambda f: f"{f:.3f}"),
    st.sampled_from(["", " ", "n/a", "NaN", "1,234", "12d", "7F", " 42 ", "1e3", "-0", "abc", "Inf", "-INF",
                     "infinity", "0x1f", "-0x10", "0xZZ"]),
    st.none(),
)


def py_to_number(s):
    """Text -> number; anything missing or not a number -> 0 (NaN too)."""
    if s is None:
        return 0.0
    t = s.strip(" ")
    if re.fullmatch(r"[+-]?0[xX][0-9a-fA-F]+", t):
        return float(int(t, 16))
    if re.search(r"[dDfF]$", t) and not re.fullmatch(r"(?i)[+-]?inf(inity)?", t):
        return 0.0
    try:
        v = float(t)
    except ValueError:
        return 0.0
    return 0.0 if math.isnan(v) else v


@settings(max_examples=25, deadline=None)
@given(st.lists(NUMERIC_TEXT, min_size=1, max_size=30))
def test_to_number_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(semantics.to_number("s")).collect()]
    assert got == [py_to_number(v) for v in values]


PAIRS = st.tuples(st.one_of(st.none(), st.sampled_from([0.0, -0.5, 2.0, 3.0, -7.0, float("nan")])),
                  st.one_of(st.none(), st.sampled_from([0.0, 4.0, -2.0, 0.5])))


def py_div(n, d):
    if n is None or d is None:
        return None
    if d == 0:
        if math.isnan(n) or n == 0:
            return float("nan")
        return math.copysign(math.inf, n)
    return n / d


@settings(max_examples=25, deadline=None)
@given(st.lists(PAIRS, min_size=1, max_size=20))
def test_ieee_div_matches_python(spark, pairs):
    df = spark.createDataFrame(pairs, "n double, d double")
    got = [r[0] for r in df.select(semantics.ieee_div("n", "d")).collect()]
    for g, (n, d) in zip(got, pairs):
        e = py_div(n, d)
        assert (g is None and e is None) or (g is not None and e is not None and
                                             ((math.isnan(g) and math.isnan(e)) or g == e))


GROUPS = st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-5, 5).map(float))),
                  min_size=1, max_size=30)


@settings(max_examples=25, deadline=None)
@given(GROUPS)
def test_strict_and_na_rm_sums(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: (r.s, r.n) for r in df.groupBy("k").agg(
        semantics.strict_sum("v").alias("s"), semantics.sum_na_rm("v").alias("n")).collect()}
    for k in {k for k, _ in data}:
        vals = [v for kk, v in data if kk == k]
        strict = None if any(v is None for v in vals) else float(sum(vals))
        na_rm = float(sum(v for v in vals if v is not None))
        assert got[k] == (strict, na_rm)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=20))
def test_split_is_a_partition(spark, values):
    from staffline.operators.filters import split_in
    df = spark.createDataFrame([(v,) for v in values], "k string")
    a, b = split_in(df, "k", ["a", "b"])
    assert sorted(map(repr, [r.k for r in a.collect()] + [r.k for r in b.collect()])) == sorted(map(repr, values))


SIDE = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, None]),
                          st.integers(0, 9)), max_size=12)


@settings(max_examples=20, deadline=None)
@given(SIDE, SIDE)
def test_skew_safe_full_outer_join_is_a_full_outer_join(spark, left, right):
    from staffline.operators import joins
    l = spark.createDataFrame(left, "k string, m int, a int")
    r = spark.createDataFrame(right, "k string, m int, b int")
    safe = joins.full_outer_coalesced(l, r, ["k", "m"])
    plain = joins.full_outer_coalesced(l, r, ["k", "m"], skew_safe=False)
    key = lambda t: repr(t)
    assert sorted(map(tuple, safe.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
