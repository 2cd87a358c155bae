"""Retention, KPI, forecast, engagement, curves and semantics: hand cases."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamgauge.plans import curves, engagement, forecast, kpi, retention, semantic

MINUTES = "video_id string, livestream_position int, average_concurrent_viewers double, peak_concurrent_viewers double"


def series(spark, values, video="v"):
    numbers = [None if x is None else float(x) for x in values]
    return spark.createDataFrame([(video, 60 * i, x, x) for i, x in enumerate(numbers)], MINUTES)


def column(df, name):
    return [r[name] for r in df.orderBy("livestream_position").collect()]


def test_viewer_shift(spark):
    levels = [10.0]
    for shift in (2, 1.5, 1, -1, -1.5):
        levels.append(levels[-1] + shift)
    got = column(retention.viewer_shift_label(series(spark, levels)), "viewer_shift_segment")
    assert got == ["NULL", "Gain", "NULL", "Retain", "Retain", "Dip"]


def test_movement_and_streak(spark):
    moves = retention.view_movement(series(spark, [2.0, 3, 3, 2, 1, 1]))
    assert column(moves, "view_movement") == ["NULL", "spike", "retain", "drop", "drop", "NULL"]
    assert column(retention.retention_streak(moves), "scenario_1_run") == [0, 1, 2, 0, 0, 0]
    labels = spark.createDataFrame(
        [("v", 60 * i, m) for i, m in enumerate(["spike", "retain", "drop", "spike"])],
        "video_id string, livestream_position int, view_movement string",
    )
    assert column(retention.retention_streak(labels), "scenario_1_run") == [1, 2, 0, 1]


def test_constant_series(spark):
    rows = series(spark, [5.0, 5, 5], "flat").union(series(spark, [None, None], "none")).union(series(spark, [1.0, None, 2.0], "live"))
    kept = {r.video_id for r in retention.drop_constant_series(rows).collect()}
    assert kept == {"none", "live"}


def test_segments_tie_with_the_median(spark):
    rows = []
    for video, viewers, hits in [("a", 1.0, 1), ("b", 2.0, 2), ("c", 3.0, 3)]:
        rows += [(video, 60 * i, viewers, 1 if i < hits else 0) for i in range(5)]
    streaks = spark.createDataFrame(rows, "video_id string, livestream_position int, average_concurrent_viewers double, hit int")
    streaks = streaks.withColumn("scenario_1_run", F.when(F.col("hit") == 1, F.col("livestream_position") / 60 + 1).otherwise(0))
    got = {r.video_id: r.segments for r in retention.retention_segments(streaks, min_rows=4).collect()}
    assert got == {"a": "low_viewers_low_ret", "b": "NULL", "c": "high_viewers_high_ret"}
    assert retention.retention_segments(streaks, min_rows=5).count() == 0


def test_share_skips_missing_values(spark):
    rows = series(spark, [1.0, 1.0, None, 2.0])
    got = {r.average_concurrent_viewers: r.proportion for r in retention.value_share(rows, "video_id", "average_concurrent_viewers").collect()}
    assert got == {1.0: pytest.approx(2 / 3), 2.0: pytest.approx(1 / 3)}


# ------------------------------------------------------------- semantics

EMBEDDED = "video_id string, livestream_position int, embedding array<double>, text string, duration_text_coverage_pct double"


def embedded(spark, vectors, coverage=1.0):
    rows = [("v", 60 * i, v, "" if v is None else "t", coverage) for i, v in enumerate(vectors)]
    rows = [(a, b, [9.0, 9.0] if e is None else [float(x) for x in e], t, c) for a, b, e, t, c in rows]
    return spark.createDataFrame(rows, EMBEDDED)


def test_shift_of_one_minute(spark):
    got = column(semantic.semantic_shift(embedded(spark, [[1.0, 0], [1.0, 0], [0, 1.0]]), 1), "semantic_shift_1m")
    assert got == [0, pytest.approx(0), pytest.approx(1)]


def test_shift_needs_enough_context(spark):
    vectors = [[1.0, 0], None, None, None, [1.0, 0], [1.0, 0], None, [1.0, 0], [1.0, 0]]
    got = column(semantic.semantic_shift(embedded(spark, vectors), 5), "semantic_shift_5m")
    assert got == [0, 0, 0, 0, 0, None, None, None, pytest.approx(0)]
    other = column(semantic.semantic_shift(embedded(spark, vectors), 7), "semantic_shift_7m")
    assert other == [0] * 7 + [None, None]


def test_low_coverage_blanks_the_minute(spark):
    got = column(semantic.semantic_shift(embedded(spark, [[1.0, 0], [1.0, 0]], 0.49), 1), "semantic_shift_1m")
    assert got == [0, None]


def test_shift_against_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = [None if rng.random() < 0.3 else rng.normal(size=2).tolist() for _ in range(60)]
    got = semantic.semantic_shift(embedded(spark, vectors), [5, 4, 2])
    for n in (5, 4, 2):
        want = [0.0] * n
        for i in range(n, len(vectors)):
            known = [v for v in vectors[i - n : i] if v is not None]
            if vectors[i] is None or len(known) < semantic.MIN_VALID[n]:
                want.append(None)
                continue
            mean, now = np.mean(known, axis=0), np.array(vectors[i])
            want.append(1 - mean @ now / np.linalg.norm(mean) / np.linalg.norm(now))
        assert column(got, f"semantic_shift_{n}m") == [None if w is None else pytest.approx(w, abs=1e-9) for w in want]


def test_bands(spark):
    xs = [0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 9.0, None]
    df = spark.createDataFrame([(float(i), x) for i, x in enumerate(xs)], "i double, s double")
    got = [r.s_seg for r in semantic.sd_bands(df, "s").orderBy("i").collect()]
    assert got[1] == "Moderate Change" and got[8] == "Very High Change" and got[9] == "NULL"


def test_embedding_is_unit_length(spark):
    df = spark.createDataFrame([("a b c",), ("a b d",), ("e f",), (None,)], "text string")
    rows = semantic.embed_text(df).collect()
    norms = [sum(x * x for x in r.embedding) for r in rows]
    assert norms[:3] == [pytest.approx(1)] * 3 and norms[3] in (0, pytest.approx(1))
    dot = lambda a, b: sum(x * y for x, y in zip(rows[a].embedding, rows[b].embedding))
    assert dot(0, 1) > dot(0, 2)


# ------------------------------------------------------------------- KPI


def daily(spark, weeks, platform="YOUTUBE"):
    start = date(2024, 1, 1)  # a Monday
    rows = [(start + timedelta(days=7 * i + d), platform, g, 0, v) for i, (g, v) in enumerate(weeks) for d in (0, 6)]
    return spark.createDataFrame(rows, "metric_date date, platform string, subscribers_gained long, subscribers_lost long, views_count long")


def test_weekly_deviation(spark):
    weeks = [(1000, 1)] * 3 + [(10 + i, 5) for i in range(12)] + [(30, 5), (999, 1)]
    d = kpi.with_net_subscribers(daily(spark, weeks))
    got = {(r.point_type, str(r.week_commencing_dt)): r for r in kpi.weekly_deviation(d, ["net_subscribers", "views_count"]).collect()}
    assert len(got) == 14
    week13 = "2024-04-15"
    assert got["COMPARISON - ACTUAL", week13].net_subscribers == 60
    predicted = got["COMPARISON - PREDICTED", week13]
    assert (predicted.net_subscribers, predicted.views_count, predicted.derived_metric) == (44, 10, 4.4)
    card = kpi.kpi_summary(d, "net_subscribers").first()
    assert card.total == f"{2 * sum(g for g, _ in weeks):,}"
    assert card.deviation == "WC 15 Apr 2024: 36% vs forecast"
    rate = kpi.kpi_summary(d, ["net_subscribers", "views_count"]).first()
    assert rate.total == f"{sum(g for g, _ in weeks) / sum(v for _, v in weeks):,.2f}"


def test_platforms_do_not_mix(spark):
    a, b = daily(spark, [(10, 1)] * 20, "A"), daily(spark, [(50, 1)] * 20, "B")
    d = kpi.with_net_subscribers(a.union(b))
    got = kpi.weekly_deviation(d, "net_subscribers").filter("point_type = 'COMPARISON - PREDICTED'").collect()
    assert {r.platform: r.net_subscribers for r in got} == {"A": 20, "B": 100}


def test_monthly_trend(spark):
    got = kpi.monthly_trend(daily(spark, [(1, 7)] * 60), "views_count", n=3).orderBy("month_start_dt").collect()
    assert [str(r.month_start_dt) for r in got] == ["2024-11-01", "2024-12-01", "2025-01-01"]
    assert got[0].end_label == got[0].views_count and got[1].end_label is None and got[2].end_label == got[2].views_count


# -------------------------------------------------------------- forecast


def test_golden_goal_deviation(spark):
    """Two published totals against their goals."""
    rows = [(date(2026, 5, 3), "YOUTUBE", 1369.070055377019), (date(2026, 11, 1), "YOUTUBE", 1668.6181427419262)]
    df = spark.createDataFrame(rows, "ds date, platform string, predicted_running_sub double")
    assert forecast.goal_deviation(df, {"2026-05-03": 1500, "2026-11-01": 2000}).first().deviation == "-8% -16%"


def test_golden_running_totals(spark):
    """Rows around the border between actual and predicted weeks of a published forecast."""
    rows = [
        (date(2021, 2, 8), 1.0, 1.079830634367926),
        (date(2021, 2, 15), 0.0, 1.6687372573997876),
        (date(2021, 2, 22), 2.0, 1.4729174828648435),
        (date(2021, 3, 1), 4.0, 0.7650545500539745),
        (date(2021, 3, 14), None, 9.0),
    ]
    df = spark.createDataFrame([(d, "YOUTUBE", y, p) for d, y, p in rows], "ds date, platform string, y double, yhat double")
    got = forecast.running_totals(df).orderBy("ds").collect()
    assert [r.actual_running_sub for r in got] == [1, 1, 3, 7, None]
    assert [r.predicted_running_sub for r in got[:4]] == [
        pytest.approx(x, abs=1e-12) for x in (1.079830634367926, 2.7485678917677134, 4.221485374632557, 4.986539924686532)
    ]


def test_long_forecast_frame(spark):
    d = daily(spark, [(10 + i % 3, 1) for i in range(80)])
    got = forecast.long_forecast(d, "2025-09-01").orderBy("ds").collect()
    future = [r for r in got if r.y is None]
    assert len(got) - len(future) == 80
    assert all(r.ds.weekday() == 6 for r in future) and all(r.ds.weekday() == 0 for r in got if r.y is not None)
    assert future[0].ds == date(2025, 7, 20) and future[-1].ds == date(2025, 8, 31)
    mondays = forecast.long_forecast(d, "2025-09-01", align="monday").filter("y is null").collect()
    assert all(r.ds.weekday() == 0 for r in mondays)
    assert forecast.current_total(forecast.long_forecast(d, "2025-09-01")).first().current_subs == 2 * sum(10 + i % 3 for i in range(80))


def test_seasonal_fit_follows_trend_and_season(spark):
    start = date(2020, 1, 6)
    days = [start + timedelta(weeks=i) for i in range(260)]
    truth = [5 + 0.02 * i + 3 * np.sin(2 * np.pi * (d - date(1970, 1, 1)).days / 365.25) for i, d in enumerate(days)]
    rows = [(d, "A", float(y) if i < 200 else None) for i, (d, y) in enumerate(zip(days, truth))]
    frame = spark.createDataFrame(rows, "ds date, platform string, y double")
    got = [r.yhat for r in forecast.seasonal_fit()(frame).orderBy("ds").collect()]
    assert max(abs(a - b) for a, b in zip(got, truth)) < 0.2


def test_chart_frame(spark):
    d = daily(spark, [(10, 1)] * 80)
    frame = forecast.forecast_chart(forecast.long_forecast(d, "2025-09-01", forecast.line_fit()), "2025-06-01")
    rows = frame.orderBy("ds").collect()
    assert rows[0].first_ds == rows[0].ds and rows[0].label_ds == rows[-7].ds and rows[0].last_ds == rows[-1].ds
    assert rows[0].predicted_line is None and rows[-1].predicted_line == rows[-1].last_total
    assert rows[0].forecast_ds == date(2025, 7, 20)


# ------------------------------------------------------------ engagement


def test_quadrants(spark):
    rows = [("a", 4.0, 4.0), ("b", 1.0, 4.0), ("c", 1.0, 1.0), ("d", 4.0, 1.0), ("e", 1.0, 2.0), ("f", 4.0, 2.0)]
    df = spark.createDataFrame(rows, "video_id string, avg_view_duration_mins double, engagement_metric double")
    got = {r.video_id: r.quadrant for r in engagement.engagement_quadrants(df).collect()}
    assert got == {
        "a": "Top Performers", "b": "High Interaction", "c": "Low Performers", "d": "Strong Retention", "e": "NULL", "f": "Top Performers",
    }
    fixed = {r.video_id: r.quadrant for r in engagement.engagement_quadrants(df, 5, 5).collect()}
    assert set(fixed.values()) == {"Low Performers"}


def test_no_views_no_metric(spark):
    df = spark.createDataFrame(
        [("a", "Livestream", 0, 10, 1, 1, 60)],
        "video_id string, video_type string, video_views int, video_estimated_minutes_watched int, video_likes int, video_comments int, video_duration_sec int",
    )
    row = engagement.video_engagement(df).first()
    assert row.avg_view_duration_mins is None and row.engagement_metric is None and row.avg_pct_video_watched is None


# ---------------------------------------------------------------- curves


def test_interpolation(spark):
    df = spark.createDataFrame([("v", i, x) for i, x in enumerate([None, 1.0, None, None, 4.0, None])], "k string, i int, x double")
    got = [r.y for r in curves.interpolate(df, ["k"], "i", "x", "y").orderBy("i").collect()]
    assert got == [None, 1, 2, 3, 4, 4]


def test_resample_folds_versions(spark):
    rows = [("v", 60, 2.0, 3.0), ("v", 60, 4.0, 9.0), ("v", 120, 6.0, 1.0), ("w", 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, MINUTES)
    got = {(r.video_id, r.pct): (r.average_concurrent_viewers, r.peak_concurrent_viewers) for r in curves.percent_resample(df).collect()}
    assert got == {("v", 50): (3.0, 9.0), ("v", 100): (6.0, 1.0)}


def test_normalised_curves(spark):
    filled = spark.createDataFrame(
        [("a", 0, 10.0), ("a", 50, 20.0), ("a", 100, 30.0), ("f", 0, 50.0), ("f", 100, 50.0), ("low", 0, 1.0), ("short", 0, 99.0)],
        "video_id string, pct long, average_concurrent_viewers double",
    )
    dim = spark.createDataFrame(
        [("a", "A", "Livestream"), ("f", "F", "Livestream"), ("low", "L", "Livestream"), ("short", "S", "Short")],
        "video_id string, video_title string, video_type string",
    )
    got = {(r.video_id, r.pct): r.norm for r in curves.normalise_curves(filled, dim).collect()}
    assert got == {("a", 0): 0, ("a", 50): 0.5, ("a", 100): 1, ("f", 0): 0, ("f", 100): 0}


def test_clusters_are_named_by_shape(spark):
    rng = random.Random(1)
    shapes = {
        "Mid-Peak Drop": [0.3, 0.5, 0.7, 0.9, 1.0, 0.9, 0.5, 0.1],
        "Mid-Peak Stable": [0.1, 0.3, 0.5, 0.7, 0.8, 0.8, 0.8, 0.8],
        "Irregular": [0.0, 1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0],
        "Early-Rise Stable": [0.9, 1.0, 0.9, 0.9, 0.9, 0.9, 0.9, 0.9],
    }
    rows, truth = [], {}
    for name, shape in shapes.items():
        for i in range(8):
            video = f"{name[:4]}{name[-4:]}{i}"
            truth[video] = name
            rows += [(video, p, None if p == 0 and i == 0 else x + rng.uniform(-0.03, 0.03)) for p, x in enumerate(shape)]
    norm = spark.createDataFrame(rows, "video_id string, pct long, norm double")
    got = {r.video_id: r.cluster for r in curves.cluster_curves(norm, restarts=4).collect()}
    assert got == truth
