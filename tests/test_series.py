"""Chunked windows against plain loops, with chunks so small that carries matter."""

import random

import pytest
from pyspark.sql import functions as F

from streamgauge.operators import series
from streamgauge.plans import retention

SPAN = 300


def make_rows(seed, hot=400):
    """One series with most of the rows, some short ones, gaps in the positions."""
    rng = random.Random(seed)
    rows = []
    for video, n in [("hot", hot), ("a", 7), ("b", 1), ("c", 40)]:
        positions = sorted(rng.sample(range(0, n * 3), n))
        level = 3.0
        for p in positions:
            level = max(0.0, level + rng.choice([-1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0]))
            viewers = None if rng.random() < 0.02 else level
            rows.append((video, p * 60, viewers))
    rng.shuffle(rows)
    return rows


SCHEMA = "video_id string, livestream_position int, average_concurrent_viewers double"


def by_video(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_previous_and_next(spark, seed):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    args = (["video_id"], "livestream_position", "average_concurrent_viewers")
    got = series.next_value(series.previous_value(df, *args, "prev", SPAN), *args, "next", SPAN)
    want = {}
    for video, items in by_video(rows).items():
        for k, (v, p, x) in enumerate(items):
            before = items[k - 1][2] if k else None
            after = items[k + 1][2] if k + 1 < len(items) else None
            want[v, p] = (before, after)
    assert {(r.video_id, r.livestream_position): (r.prev, r.next) for r in got.collect()} == want


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_run_length(spark, seed):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    hit = F.col("average_concurrent_viewers") >= 3
    got = series.run_length(df, ["video_id"], "livestream_position", hit, "run", span=SPAN)
    want = {}
    for items in by_video(rows).values():
        run = 0
        for v, p, x in items:
            run = run + 1 if x is not None and x >= 3 else 0
            want[v, p] = run
    assert {(r.video_id, r.livestream_position): r.run for r in got.collect()} == want


def loop_streaks(rows):
    want = {}
    for items in by_video(rows).values():
        run, before = 0, None
        for v, p, x in items:
            diff = None if x is None or before is None else x - before
            label = "NULL"
            if diff is not None:
                if x > 1 and diff > 0:
                    label = "spike"
                elif x > 1 and diff == 0:
                    label = "retain"
            run = 0 if label == "NULL" else run + 1
            want[v, p] = (label, run)
            before = x
    return want


@pytest.mark.parametrize("seed", [5, 6, 7, 8])
def test_movement_streaks_both_forms(spark, seed, monkeypatch):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    want = loop_streaks(rows)
    small = lambda f: lambda *a, **k: f(*a, **{"span": SPAN, **k})
    monkeypatch.setattr(retention, "run_length", small(series.run_length))
    monkeypatch.setattr(retention, "change", small(series.change))
    fused = retention.movement_streaks(df)
    staged = retention.retention_streak(retention.view_movement(df))
    for frame in (fused, staged):
        got = {(r.video_id, r.livestream_position): (r.view_movement, r.scenario_1_run) for r in frame.collect()}
        assert got == want


def test_attach_group(spark):
    rows = make_rows(10)
    df = spark.createDataFrame(rows, SCHEMA)
    value = "average_concurrent_viewers"
    got = series.attach_group(
        df, ["video_id"], "livestream_position", {"hi": ("max", value), "n": ("count", value)}, span=SPAN
    ).collect()
    assert len(got) == len(rows)
    groups = {v: [x for *_, x in items if x is not None] for v, items in by_video(rows).items()}
    for r in got:
        assert r.n == len(groups[r.video_id])
        assert r.hi == max(groups[r.video_id], default=None)


def test_short_series_need_no_join(spark):
    df = spark.createDataFrame(make_rows(11, hot=20), SCHEMA)
    out = series.previous_value(df, ["video_id"], "livestream_position", "average_concurrent_viewers", "prev")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan
