"""Trailing vectors against plain loops, with chunks so small that rows look back across several."""

import random

import numpy as np
import pytest

from streamgauge.operators import trailing
from streamgauge.operators.trailing import trailing_vectors

SCHEMA = "video_id string, at long, v array<float>, note string"


def make(seed, dims=3):
    dice = random.Random(seed)
    rows = []
    for video, n in (("hot", 300), ("a", 4), ("b", 1), ("c", 40)):
        for at in dice.sample(range(n * 3), n):
            v = None if dice.random() < 0.25 else [0.0] * dims if dice.random() < 0.1 else [dice.gauss(0, 1) for _ in range(dims)]
            rows.append((video, at * 60, v, f"{video}{at}"))
    dice.shuffle(rows)
    return rows


def by_hand(rows, n):
    out = {}
    series = {}
    for r in sorted(rows, key=lambda r: r[:2]):
        series.setdefault(r[0], []).append(r)
    for items in series.values():
        for k, (video, at, v, note) in enumerate(items):
            before = items[max(0, k - n) : k]
            known = [np.array(np.float32(b[2]), float) for b in before if b[2] is not None]
            mean = np.mean(known, axis=0) if known else None
            cos = None
            if known and v is not None:
                own = np.array(np.float32(v), float)
                size = np.linalg.norm(own) * np.linalg.norm(mean)
                cos = float(own @ mean / size) if size else 0.0
            out[video, at] = (len(before), len(known), mean, cos, note)
    return out


@pytest.mark.parametrize("span", [61, 600, 60 * 1024, 10**9])
@pytest.mark.parametrize("kind", ["mean", "cosine"])
def test_equals_loops(spark, monkeypatch, span, kind):
    monkeypatch.setattr(trailing, "ROWS", 7)
    rows = make(1)
    got = trailing_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4), ["video_id"], "at", "v", [5, 2], kind, span).collect()
    assert len(got) == len(rows)
    for n in (5, 2):
        want = by_hand(rows, n)
        for r in got:
            seen, valid, mean, cos, note = want[r.video_id, r.at]
            assert min(r.rows_before, n) == seen and r[f"valid_{n}"] == valid and r.note == note
            value, wanted = r[f"{kind}_{n}"], mean if kind == "mean" else cos
            assert (value is None) == (wanted is None)
            if value is not None:
                assert np.allclose(value, wanted, atol=1e-9, rtol=0)


def test_series_beyond_all_chunks(spark):
    """Rows so far apart that each is alone in its chunk on every level but the last."""
    step = 61 * 1024 * 2
    rows = [("a", i * step, [float(i), 1.0], "") for i in range(12)]
    got = {r.at // step: r.mean_3 for r in trailing_vectors(spark.createDataFrame(rows, SCHEMA), ["video_id"], "at", "v", [3], "mean", 61).collect()}
    assert got[0] is None and got[1] == [0.0, 1.0] and got[11] == [9.0, 1.0]


def test_no_vectors_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, None, ""), ("a", 2, None, "")], SCHEMA)
    assert [(r.rows_before, r.valid_1, r.cosine_1) for r in trailing_vectors(df, ["video_id"], "at", "v", [1], "cosine").orderBy("at").collect()] == [(0, 0, None), (1, 0, None)]
    assert trailing_vectors(df.filter("false"), ["video_id"], "at", "v", [1], "mean").collect() == []


def test_vectors_are_shuffled_once(spark):
    df = spark.createDataFrame(make(2), SCHEMA)
    out = trailing_vectors(df, ["video_id"], "at", "v", [5], "cosine")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "collect_list" not in plan and "ReusedExchange" in plan
