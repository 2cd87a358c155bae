"""Engagement per video and its quadrants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.functions.numbers import ratio

# The video types that count as live.
LIVE_TYPES = ("Livestream", "Luton Livestream")


def video_engagement(dim_video: DataFrame, types: Sequence[str] = LIVE_TYPES) -> DataFrame:
    """Minutes per view, percent watched and interactions per 100 views; NULL without views."""
    watched, views = F.col("video_estimated_minutes_watched"), F.col("video_views")
    return (
        dim_video.filter(F.col("video_type").isin(*types))
        .withColumn("avg_view_duration_mins", F.bround(ratio(watched, views), 1))
        .withColumn("avg_pct_video_watched", ratio(watched * 60, views * F.col("video_duration_sec")) * 100)
        .withColumn(
            "engagement_metric", F.bround(ratio(F.col("video_likes") + F.col("video_comments"), views) * 100, 1)
        )
    )


def half_max(df: DataFrame, *columns: str):
    """Half of each column's maximum, rounded to even, as one struct value."""
    return df.agg(F.struct(*[F.bround(F.max(c) / 2, 0).alias(c) for c in columns])).scalar()


def engagement_quadrants(df: DataFrame, dur_cut: float | None = None, eng_cut: float | None = None) -> DataFrame:
    """Quadrant per video; cut-offs default to half of the maxima.

    Borders are uneven: below the duration cut-off, a video exactly on the
    engagement cut-off belongs to no quadrant.
    """
    duration, engagement = F.col("avg_view_duration_mins"), F.col("engagement_metric")
    rows = df
    if dur_cut is None or eng_cut is None:
        rows = rows.withColumn("_half", half_max(df, "avg_view_duration_mins", "engagement_metric"))
    d = F.col("_half.avg_view_duration_mins") if dur_cut is None else F.lit(float(dur_cut))
    e = F.col("_half.engagement_metric") if eng_cut is None else F.lit(float(eng_cut))
    quadrant = (
        F.when((duration >= d) & (engagement >= e), "Top Performers")
        .when((duration < d) & (engagement > e), "High Interaction")
        .when((duration < d) & (engagement < e), "Low Performers")
        .when((duration >= d) & (engagement < e), "Strong Retention")
        .otherwise("NULL")
    )
    return rows.withColumn("quadrant", quadrant).drop("_half")
