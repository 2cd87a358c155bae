"""Hub, satellites, daily fact and the presentation views on top of them.

``target`` is the current content of the product; with it only unseen rows
come back. ``tie`` names columns that decide between equal load times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamgauge.functions.text import clean_title
from streamgauge.functions.times import iso_duration_seconds
from streamgauge.operators.latest import latest_per, latest_per_day
from streamgauge.operators.loads import HASH, changed_versions, hash_versions, new_keys, new_versions
from streamgauge.functions.hashing import version_hash
from streamgauge.schemas import DAY_METRICS, MINUTE_METRICS, VIDEO_DATA
from streamgauge.sources.lookups import canonical_names

DETAIL_HASHED = [
    "video_title",
    "video_description",
    "video_published_at",
    "video_duration_sec",
    "video_topic",
    "video_category",
    "likes_count",
    "view_count",
    "comment_count",
    "estimated_minutes_watched",
]
MINUTE_HASHED = ["livestream_position", "peak_concurrent_viewers", "average_concurrent_viewers"]
DAY_HASHED = [
    "likes",
    "views",
    "shares",
    "comments",
    "dislikes",
    "subscribers_lost",
    "subscribers_gained",
    "average_view_duration",
    "average_view_percentage",
    "estimated_minutes_watched",
]


def hub(stage_video: DataFrame, target: DataFrame | None = None, per_load: bool = False) -> DataFrame:
    """Videos the hub does not hold yet, with their first source and load.

    ``per_load=True`` keeps one row per (video, source, load) instead.
    """
    named = stage_video.filter(F.col("video_id").isNotNull()).select("video_id", "record_source", "load_ts")
    if per_load:
        return new_keys(named.distinct(), target, ["video_id"])
    first = F.min(F.struct("load_ts", "record_source"))
    rows = named.groupBy("video_id").agg(first.alias("_first"))
    rows = rows.select("video_id", "_first.record_source", "_first.load_ts")
    return rows if target is None else rows.join(target.select("video_id"), "video_id", "left_anti")


def extract_details(stage_video: DataFrame) -> DataFrame:
    """Attributes of the video JSON as text; one parse per row."""
    dropped = ("video_data", "minute_metrics", "estimatedminuteswatched")
    others = [c for c in stage_video.columns if c.lower() not in dropped]
    return stage_video.withColumn("_d", F.from_json("video_data", VIDEO_DATA)).select(
        *others,
        F.col("_d.snippet.title").alias("video_title_raw"),
        F.col("_d.snippet.description").alias("video_description"),
        F.col("_d.snippet.publishedAt").alias("video_published_at"),
        F.col("_d.contentDetails.duration").alias("video_duration"),
        F.col("_d.topicDetails.topicCategories").alias("video_topic"),
        F.col("_d.snippet.categoryId").alias("video_category"),
        F.col("_d.statistics.likeCount").alias("likes_count"),
        F.col("_d.statistics.viewCount").alias("view_count"),
        F.col("_d.statistics.commentCount").alias("comment_count"),
        F.col("estimatedMinutesWatched").alias("estimated_minutes_watched"),
    )


def type_details(texts: DataFrame) -> DataFrame:
    """Typed attributes with the cleaned title; bad numbers or times are errors."""
    counts = {c: F.col(c).cast("int") for c in ("likes_count", "view_count", "comment_count")}
    return texts.withColumns(
        counts
        | {
            "video_title": clean_title(F.col("video_title_raw")),
            "video_published_at": F.col("video_published_at").cast("timestamp_ntz"),
            "video_duration_sec": iso_duration_seconds(F.col("video_duration")),
            "estimated_minutes_watched": F.col("estimated_minutes_watched").cast("double"),
        }
    ).drop("video_duration")


def _versions(daily: DataFrame, key: str, hashed: Sequence[str], tie: Sequence[str], detect: str) -> DataFrame:
    if detect == "hash":
        return hash_versions(daily, key, hashed, tie=tie, daily=False)
    if detect == "change":
        return changed_versions(daily.withColumn(HASH, version_hash(daily, hashed)), key, tie=tie)
    raise ValueError("detect must be hash or change")


def sat_details(
    stage_video: DataFrame, target: DataFrame | None = None, tie: Sequence[str] = (), detect: str = "hash"
) -> DataFrame:
    """Versions of the video attributes; the raw title is not part of the hash.

    The JSON is cut down to its attributes before the shuffle and typed after
    it, so only the rows that count can fail a cast.
    """
    parsed = type_details(latest_per_day(extract_details(stage_video), "video_id", "load_ts", tie))
    rows = _versions(parsed, "video_id", DETAIL_HASHED, tie, detect)
    rows = rows.select("video_id", "video_title_raw", *DETAIL_HASHED, "load_ts", HASH)
    return new_versions(rows, target, "video_id")


def unnest_minutes(stage_video: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """One row per minute of the keyed JSON; NULL or empty objects add nothing."""
    minutes = F.explode(F.from_json("minute_metrics", MINUTE_METRICS)).alias("_key", "_value")
    rows = stage_video.select("video_id", "load_ts", *tie, minutes)
    return rows.select(
        "video_id",
        "load_ts",
        *tie,
        F.col("_key").cast("int").alias("livestream_position"),
        F.col("_value.peakConcurrentViewers").cast("double").alias("peak_concurrent_viewers"),
        F.col("_value.averageConcurrentViewers").cast("double").alias("average_concurrent_viewers"),
    )


def sat_minute_viewers(stage_video: DataFrame, target: DataFrame | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Versions of each minute's viewers.

    Equal rows need no separate distinct: one row per (video, hash) is kept.
    """
    daily = latest_per_day(stage_video, "video_id", "load_ts", tie)
    rows = hash_versions(unnest_minutes(daily, tie), "video_id", MINUTE_HASHED, tie=tie, daily=False)
    return new_versions(rows.select("video_id", *MINUTE_HASHED, "load_ts", HASH), target, "video_id")


# The metrics of the day JSON, their column and type.
DAY_METRIC_TYPES = {
    "likes": ("likes", "int"),
    "views": ("views", "int"),
    "shares": ("shares", "int"),
    "comments": ("comments", "int"),
    "dislikes": ("dislikes", "int"),
    "subscribersLost": ("subscribers_lost", "int"),
    "subscribersGained": ("subscribers_gained", "int"),
    "averageViewDuration": ("average_view_duration", "int"),
    "averageViewPercentage": ("average_view_percentage", "double"),
    "estimatedMinutesWatched": ("estimated_minutes_watched", "double"),
}


def extract_day(stage_day: DataFrame) -> DataFrame:
    """The channel metrics of the day JSON as text."""
    others = [c for c in stage_day.columns if c != "date_metrics"]
    parsed = stage_day.withColumn("_d", F.from_json("date_metrics", DAY_METRICS))
    return parsed.select(*others, *[F.col(f"_d.{m}").alias(c) for m, (c, _) in DAY_METRIC_TYPES.items()])


def type_day(texts: DataFrame) -> DataFrame:
    return texts.withColumns({c: F.col(c).cast(kind) for c, kind in DAY_METRIC_TYPES.values()})


def channel_daily(
    stage_day: DataFrame, target: DataFrame | None = None, tie: Sequence[str] = (), detect: str = "hash"
) -> DataFrame:
    """Versions of the channel's daily metrics."""
    parsed = type_day(latest_per_day(extract_day(stage_day), "date", "load_ts", tie))
    rows = _versions(parsed, "date", DAY_HASHED, tie, detect)
    return new_versions(rows.select("date", *DAY_HASHED, "load_ts", HASH), target, "date")


def dim_video(
    details: DataFrame,
    video_type: Column,
    video_speaker: Column,
    names: DataFrame | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Newest attributes per video under the presentation names.

    The rules for ``video_type`` and ``video_speaker`` are not fixed anywhere,
    so both are expressions on the satellite's columns.
    """
    newest = latest_per(details, ["video_id"], "load_ts", tie)
    view = newest.select(
        "video_id",
        "video_title",
        video_type.alias("video_type"),
        video_speaker.alias("video_speaker"),
        "video_published_at",
        F.col("likes_count").alias("video_likes"),
        F.col("comment_count").alias("video_comments"),
        F.col("view_count").alias("video_views"),
        F.col("estimated_minutes_watched").alias("video_estimated_minutes_watched"),
        "video_duration_sec",
    )
    return view if names is None else canonical_names(view, names, "video_speaker")


def fct_daily(daily: DataFrame, platform: str = "YOUTUBE", tie: Sequence[str] = ()) -> DataFrame:
    """Newest metrics per date under the presentation names."""
    return latest_per(daily, ["date"], "load_ts", tie).select(
        F.col("date").alias("metric_date"),
        F.lit(platform).alias("platform"),
        "subscribers_gained",
        "subscribers_lost",
        F.col("views").alias("views_count"),
        F.col("likes").alias("likes_count"),
        F.col("dislikes").alias("dislikes_count"),
        F.col("comments").alias("comments_count"),
        F.col("shares").alias("shares_count"),
        F.col("estimated_minutes_watched").alias("estimated_watch_minutes"),
    )


def dim_minutes(minutes: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Newest viewers per (video, minute)."""
    newest = latest_per(minutes, ["video_id", "livestream_position"], "load_ts", tie)
    return newest.select("video_id", *MINUTE_HASHED, "load_ts")
