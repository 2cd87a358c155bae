"""Medians by counting against sorted lists."""

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamgauge.operators.medians import exact_median, ordered_bits


@pytest.mark.parametrize("store", [True, False])
@pytest.mark.parametrize("n", [1, 2, 7, 1000, 30001])
def test_exact_median(spark, n, store):
    rng = random.Random(n)
    xs = [rng.choice([rng.gauss(0, 1), round(rng.gauss(0, 3)), 1.5]) for _ in range(n)]
    df = spark.createDataFrame([(k % 2, float(x)) for k, x in enumerate(xs)] + [(0, None)], "g int, x double")
    assert exact_median(df, [], "x", "m", store).collect()[0].m == statistics.median(xs)
    got = {r.g: r.m for r in exact_median(df, ["g"], "x", "m", store).collect()}
    assert got == {g: statistics.median(xs[g::2]) for g in {k % 2 for k in range(n)}}


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.0, math.nextafter(1.0, 2), -1.0, math.nextafter(-1.0, -2), 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf]


def test_bits_sort_like_doubles(spark):
    rows = spark.createDataFrame([(x,) for x in EDGES + [math.nan]], "x double").select("x", ordered_bits(F.col("x")).alias("b")).collect()
    bits = {repr(r.x): r.b for r in rows}
    assert bits["0.0"] == bits["-0.0"]
    in_order = sorted(x for x in EDGES if repr(x) != "-0.0")
    assert all(bits[repr(a)] < bits[repr(b)] for a, b in zip(in_order, in_order[1:]))
    assert max(bits.values()) == bits["nan"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.one_of(st.none(), st.sampled_from(EDGES[:-2]), st.floats(allow_nan=False, allow_infinity=False, width=64))), min_size=1, max_size=40))
def test_any_doubles_and_null_groups(spark, rows):
    known = {}
    for g, x in rows:
        if x is not None:
            known.setdefault(g, []).append(x)
    # A mean of two equal numbers is that number, also where their sum overflows.
    known = {g: [statistics.median_low(xs)] if statistics.median_low(xs) == statistics.median_high(xs) else xs for g, xs in known.items()}
    got = {r.g: r.m for r in exact_median(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", "m").collect()}
    assert got == {g: statistics.median(xs) for g, xs in known.items()}


def test_ties_of_two_keys_and_empty(spark):
    df = spark.createDataFrame([("a", 1, 2.0)] * 5 + [("a", 2, 2.0), ("a", 2, 3.0)], "g string, h int, x double")
    assert {(r.g, r.h): r.m for r in exact_median(df, ["g", "h"], "x", "m").collect()} == {("a", 1): 2.0, ("a", 2): 2.5}
    assert exact_median(df.filter("false"), ["g"], "x", "m").collect() == []
