"""Ranks, running sums and gap filling of long series against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from streamgauge.operators import series
from streamgauge.operators.ranges import RANGE, in_ranges, row_numbers, running_sums

SCHEMA = "k string, at long, x double"


def make(seed, hot=3000):
    dice = random.Random(seed)
    rows = []
    for key, n in (("hot", hot), ("a", 500), (None, 300), ("b", 1), ("none", 20)):
        for at in dice.sample(range(n * 2), n):
            rows.append((key, at, None if key == "none" or dice.random() < 0.4 else round(dice.uniform(-5, 5), 2)))
    dice.shuffle(rows)
    return rows


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.setdefault(r[0], []).append(r)
    return out


def test_row_numbers(spark):
    rows = make(1)
    got = {(r.k, r.at): r.n for r in row_numbers(spark.createDataFrame(rows, SCHEMA).repartition(9), ["k"], ["at"], "n").collect()}
    assert got == {r[:2]: i for items in by_key(rows).values() for i, r in enumerate(items)}


def test_row_numbers_of_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", 3, 2.0), ("a", 3, 2.0), (None, None, None)], SCHEMA)
    got = sorted((str(r.k), r.n, str(r.at)) for r in row_numbers(df, ["k"], ["at"], "n").collect())
    assert got == [("None", 0, "None"), ("a", 0, "None"), ("a", 1, "3"), ("a", 2, "3")]
    assert row_numbers(df.filter("false"), ["k"], ["at"], "n").collect() == []


def test_running_sums(spark):
    rows = make(2)
    got = {(r.k, r.at): r.total for r in running_sums(spark.createDataFrame(rows, SCHEMA).repartition(9), ["k"], ["at"], {"total": "x"}).collect()}
    for items in by_key(rows).values():
        total = None
        for k, at, x in items:
            total = total if x is None else x + (total or 0.0)
            assert got[k, at] == (None if total is None else pytest.approx(total, abs=1e-9))


def test_a_hot_series_spreads_over_ranges(spark):
    """A series with a third of all rows fills about a third of the ranges, and no range holds much more than its share."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("k"), F.col("id").alias("at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = in_ranges(rows, ["k"], ["at"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in ranged.groupBy(RANGE).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 3 * 30_000 / len(sizes)
    assert ranged.filter("k = 'hot'").select(RANGE).distinct().count() >= 2


@pytest.mark.parametrize("span", [7, 100, 10**6])
def test_fill_linear(spark, span):
    rows = [r for r in make(3, 600) if r[0] is not None]
    gap = [("gap", at, 1.0 if at == 3 else 9.0 if at == 400 else None) for at in range(500)]
    got = {(r.k, r.at): r.y for r in series.fill_linear(spark.createDataFrame(rows + gap, SCHEMA), ["k"], "at", "x", "y", span).collect()}
    for items in by_key(rows + gap).values():
        known = [(at, x) for _, at, x in items if x is not None]
        for k, at, x in items:
            before = [p for p in known if p[0] <= at]
            after = [p for p in known if p[0] >= at]
            want = None
            if before:
                (p0, v0), (p1, v1) = before[-1], (after or before[-1:])[0]
                want = v0 if p1 == p0 else v0 + (v1 - v0) / (p1 - p0) * (at - p0)
            assert got[k, at] == (None if want is None else pytest.approx(want, abs=1e-9))


def test_fill_linear_carries_across_chunks(spark):
    """The carried side has one row per chunk, so a long series is windowed in many tasks."""
    df = spark.createDataFrame([("hot", at, float(at) if at % 100 == 0 else None) for at in range(1000)], SCHEMA)
    chunks = series.with_chunk(df, "at", 10).select(series.CHUNK).distinct().count()
    assert chunks == 100
    assert {r.y - r.at for r in series.fill_linear(df, ["k"], "at", "x", "y", 10).filter("at <= 900").collect()} == {0.0}
