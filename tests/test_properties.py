"""Invariants on random data, driven by Hypothesis."""

import math
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.functions import sum_skip_missing
from panelspark.operators import detail_plus_total, lag_values, with_totals

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

series_rows = st.lists(
    st.tuples(st.sampled_from("abcd"), st.integers(2010, 2013), st.integers(1, 4),
              st.one_of(st.none(), st.integers(-50, 50).map(float))),
    min_size=1, max_size=40, unique_by=lambda t: t[:3])


def _brute_lags(rows, n, scope):
    out = {}
    items = sorted(rows, key=lambda t: t[:3])
    groups = [items] if scope == "global" else [[r for r in items if r[0] == s] for s in sorted({r[0] for r in items})]
    for g in groups:
        for i, r in enumerate(g):
            out[r[:3]] = g[i - n][3] if i >= n else None
    return out


@SETTINGS
@given(rows=series_rows, n=st.sampled_from([1, 4]), block=st.sampled_from([2, 5, 1 << 16]))
def test_global_lag_equals_brute_force(spark, rows, n, block):
    df = spark.createDataFrame(rows, "s string, y int, q int, v double")
    got = {(r["s"], r["y"], r["q"]): r["p"]
           for r in lag_values(df, {"p": ("v", n)}, ["s"], ["y", "q"], "global", block_rows=block).collect()}
    assert got == _brute_lags(rows, n, "global")


@SETTINGS
@given(rows=series_rows, n=st.sampled_from([1, 4]))
def test_global_and_series_lag_agree_after_first_rows(spark, rows, n):
    df = spark.createDataFrame(rows, "s string, y int, q int, v double")
    g = {(r["s"], r["y"], r["q"]): r["p"] for r in lag_values(df, {"p": ("v", n)}, ["s"], ["y", "q"], "global").collect()}
    s = {(r["s"], r["y"], r["q"]): r["p"] for r in lag_values(df, {"p": ("v", n)}, ["s"], ["y", "q"]).collect()}
    assert s == _brute_lags(rows, n, "series")
    position = {}
    for key in sorted(g):
        position[key] = sum(1 for k in g if k[0] == key[0] and k[1:] < key[1:])
    for key in g:
        if position[key] >= n:
            assert g[key] == s[key]


@SETTINGS
@given(rows=series_rows)
def test_grouping_sets_equal_stacked_aggregates(spark, rows):
    df = spark.createDataFrame(rows, "r string, y int, q int, v double")
    a = sorted(tuple(r) for r in with_totals(df, "r", ["y", "q"], {"t": "v"}).select("r", "y", "q", "t").collect())
    b = sorted(tuple(r) for r in detail_plus_total(df, "r", ["y", "q"], {"t": "v"}).select("r", "y", "q", "t").collect())
    assert a == b
    totals = {(r[1], r[2]): r[3] for r in a if r[0] == "Total"}
    for (y, q), t in totals.items():
        assert t == sum(r[3] for r in a if r[0] != "Total" and (r[1], r[2]) == (y, q))


money = st.decimals(min_value=-10**9, max_value=10**9, places=2, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), money), min_size=1, max_size=60), parts=st.integers(1, 7))
def test_exact_sum_is_order_independent(spark, values, parts):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double").repartition(parts)
    got = df.agg(sum_skip_missing("v", 2).alias("s")).first()["s"]
    exact = sum((Fraction(v) for v in values if v is not None), Fraction(0))
    assert got == float(exact)
    assert not math.isnan(got)


@SETTINGS
@given(rows=series_rows)
def test_pivot_sum_matches_grouped_sums(spark, rows):
    from panelspark.operators import pivot_sum
    df = spark.createDataFrame(rows, "k string, y int, q int, v double")
    wide = {r["y"]: r for r in pivot_sum(df, "k", "v", ids=["y"], values=list("abcd")).collect()}
    for y, row in wide.items():
        for k in "abcd":
            cell = [r[3] for r in rows if r[0] == k and r[1] == y]
            expected = None if not cell else sum(v for v in cell if v is not None)
            assert row[k] == (None if expected is None else float(expected))
    assert set(wide) == {r[1] for r in rows}
    assert df.select(F.col("y")).distinct().count() == len(wide)


@SETTINGS
@given(rows=series_rows, n=st.sampled_from([1, 4]), block=st.sampled_from([2, 5, 1 << 16]))
def test_global_lag_with_restart_equals_separate_concatenations(spark, rows, n, block):
    """Grouping the series into two restart groups = two independent global lags."""
    df = spark.createDataFrame(rows, "s string, y int, q int, v double").withColumn(
        "g", F.when(F.col("s") < "c", F.lit("first")).otherwise(F.lit("second")))
    got = {(r["s"], r["y"], r["q"]): r["p"] for r in lag_values(
        df, {"p": ("v", n)}, ["s"], ["y", "q"], "global", block_rows=block, restart=["g"]).collect()}
    expected = {}
    for part in ("ab", "cd"):
        expected.update(_brute_lags([r for r in rows if r[0] in part], n, "global"))
    assert got == expected
