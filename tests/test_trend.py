"""Bending trends against a dense solution and on series with planted changes."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamgauge.plans import forecast, trend

START = date(2020, 1, 5)
SCHEMA = "ds date, platform string, y double"


def weekly(values, platform="A"):
    return [(START + timedelta(days=7 * i), platform, None if v is None else float(v)) for i, v in enumerate(values)]


def bent(n, places, slopes, noise, seed, season=0.0):
    dice = np.random.default_rng(seed)
    slope = np.zeros(n)
    for place, s in zip([0, *places], slopes):
        slope[place:] = s
    day = np.array([(START + timedelta(days=7 * i)).toordinal() for i in range(n)])
    return 100 + np.cumsum(slope) + season * np.sin(2 * np.pi * day / 365.25) + dice.normal(0, noise, n)


def test_sparse_solution_is_the_optimum():
    """No condition of the optimum is broken, and the dense equations of what isn't zero give the same."""
    dice = np.random.default_rng(2)
    for _ in range(20):
        x = np.column_stack([np.ones(60), np.linspace(0, 1, 60), np.maximum(np.linspace(0, 1, 60)[:, None] - trend.knots(12), 0)])
        y = dice.normal(0, 0.1, 60) + np.maximum(np.linspace(0, 1, 60) - 0.4, 0) * dice.normal(0, 2)
        gram, cross = x.T @ x, x.T @ y
        penalty, ridge = np.r_[0, 0, np.full(12, 0.05)], np.zeros(14)
        b = trend.sparse_solution(gram, cross, penalty, ridge)
        pull = cross - gram @ b
        assert np.all(np.abs(pull[:2]) < 1e-6) and np.all(np.abs(pull[2:]) <= 0.05 + 1e-6)
        used = b != 0
        assert np.allclose(pull[used][2:] if used[:2].all() else 0, (penalty * np.sign(b))[used][2:], atol=1e-6)
        dense = np.linalg.lstsq(gram[np.ix_(used, used)], (cross - penalty * np.sign(b))[used], rcond=None)[0]
        assert np.allclose(dense, b[used], atol=1e-5)


def test_sums_of_tasks_equal_one_matrix(spark):
    values = bent(90, [40], [1, -2], 3, 1)
    frame = spark.createDataFrame(weekly(values) + weekly(values[::-1], "B") + weekly([1.0, None, 3.0], None), SCHEMA).repartition(5)
    models = {r.platform: r for r in trend.fit_trends(frame, 8, 2).collect()}
    assert set(models) == {"A", "B", None}
    day = np.array([(START + timedelta(days=7 * i) - date(1970, 1, 1)).days for i in range(90)], float)
    x = trend.features(day, day.min(), np.full(90, np.ptp(day)), 8, 2)
    y = values / np.abs(values).max()
    r = models["A"]
    fit = x @ np.array(r.coef)
    assert r.rows == 90 and r.scale == pytest.approx(np.abs(values).max())
    free = 2 + int((np.array(r.coef[2:10]) != 0).sum()) + 4
    assert r.sigma == pytest.approx(np.sqrt(((y - fit) ** 2).sum() / (90 - free)), rel=1e-6)
    got = trend.predicted(frame, trend.fit_trends(frame, 8, 2), 8, 2).filter("platform = 'A'").orderBy("ds").collect()
    assert np.allclose([g.yhat for g in got], fit * r.scale)


def test_planted_breaks_are_found(spark):
    values = bent(260, [70, 150], [4, -3, 2], 5, 3)
    frame = spark.createDataFrame(weekly(values) + weekly(bent(260, [], [2], 5, 4), "straight"), SCHEMA)
    found = trend.trend_changes(trend.fit_trends(frame)).orderBy("ds").collect()
    mine = [r for r in found if r.platform == "A" and abs(r.change) > 0.5]
    for place, size in ((70, -7), (150, 5)):
        near = [r.change for r in found if r.platform == "A" and abs((r.ds - START).days / 7 - place) <= 17]
        assert sum(near) == pytest.approx(size, rel=0.25)
    assert len(mine) <= 8 and len({r.ds for r in found if r.platform == "A"}) < 25
    assert sum(abs(r.change) for r in found if r.platform == "straight") < 0.5


def test_coverage_of_the_interval(spark):
    """Of held-out weeks inside and of known weeks, about the stated share lies within the bounds."""
    rows, truth = [], {}
    for s in range(12):
        values = bent(200, [80], [3, -1], 6, 50 + s, season=20)
        held = np.arange(200) % 5 == 3
        rows += weekly([None if h else v for v, h in zip(values, held)], f"p{s}")
        truth |= {(f"p{s}", START + timedelta(days=7 * i)): (values[i], held[i]) for i in range(200)}
    frame = spark.createDataFrame(rows, SCHEMA)
    got = trend.changepoint_fit()(frame).collect()
    inside = {True: [], False: []}
    for r in got:
        value, held = truth[r.platform, r.ds]
        inside[bool(held)].append(r.yhat_lower <= value <= r.yhat_upper)
    assert 0.7 < np.mean(inside[True]) < 0.9 and 0.72 < np.mean(inside[False]) < 0.9


def test_interval_widens_beyond_the_known_weeks(spark):
    frame = spark.createDataFrame(weekly([*bent(150, [60], [3, -3], 4, 9), *[None] * 40]), SCHEMA)
    got = trend.changepoint_fit()(frame).orderBy("ds").collect()
    widths = [r.yhat_upper - r.yhat_lower for r in got]
    assert np.allclose(widths[:150], widths[0]) and all(a < b for a, b in zip(widths[151:], widths[152:]))


def test_few_weeks_none_and_no_rows(spark):
    frame = spark.createDataFrame(weekly([5.0], "one") + weekly([None, None], "none") + [(None, "one", 3.0)], SCHEMA)
    got = {(r.platform, r.ds): r.yhat for r in trend.changepoint_fit()(frame).collect()}
    assert got["one", START] == pytest.approx(5.0, abs=1e-6) and got["none", START] is None
    assert trend.changepoint_fit()(frame.filter("false")).collect() == []


def test_long_forecast_uses_it(spark):
    days = spark.range(686).select(F.date_add(F.lit(START), F.col("id").cast("int") + 1).alias("metric_date"), F.lit("A").alias("platform"), F.lit(9).alias("subscribers_gained"), F.lit(2).alias("subscribers_lost"))
    got = forecast.long_forecast(days, "2022-02-01").orderBy("ds").collect()
    assert [c for c in got[0].asDict() if c.startswith("yhat")] == ["yhat", "yhat_lower", "yhat_upper"]
    assert got[50].yhat == pytest.approx(49, abs=0.1) and got[50].predicted_running_sub == pytest.approx(51 * 49, rel=0.01)
