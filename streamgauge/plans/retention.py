"""Viewer movement, retention streaks and retention segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamgauge.operators.joins import spread_join
from streamgauge.operators.latest import latest_per
from streamgauge.operators.medians import exact_median
from streamgauge.operators.series import attach_group, change, run_length
from streamgauge.session import materialize

VIDEO = ["video_id"]
POSITION = "livestream_position"
VIEWERS = "average_concurrent_viewers"
NO_LABEL = "NULL"


def current_minute_viewers(
    sat_min: DataFrame,
    details: DataFrame,
    max_sec: float = 5400,
    tie: Sequence[str] = (),
    details_tie: Sequence[str] = (),
) -> DataFrame:
    """Newest viewers per (video, minute) for videos shorter than ``max_sec``.

    Duration comes from the newest version of the details.
    """
    newest = latest_per(sat_min, [*VIDEO, POSITION], "load_ts", tie)
    viewers = newest.select("video_id", POSITION, "peak_concurrent_viewers", VIEWERS)
    short = (
        latest_per(details.select("video_id", "video_duration_sec", "load_ts", *details_tie), VIDEO, "load_ts", details_tie)
        .filter(F.col("video_duration_sec") < max_sec)
        .select("video_id")
    )
    return spread_join(viewers, short, VIDEO, "left_semi", [POSITION])


def viewer_shift_label(minutes: DataFrame) -> DataFrame:
    """Change of viewers per minute: Gain from 2 up, Retain within 1, Dip below -1.

    A change between 1 and 2, like a missing one, has no label.
    """
    shifted = change(minutes, VIDEO, POSITION, VIEWERS, "viewer_shift")
    return shifted.withColumn("viewer_shift_segment", shift_segment(F.col("viewer_shift")))


def shift_segment(shift):
    return (
        F.when(shift >= 2, "Gain")
        .when(shift.between(-1, 1), "Retain")
        .when(shift < -1, "Dip")
        .otherwise(NO_LABEL)
    )


def movement_label(viewers: Column, diff: Column) -> Column:
    return (
        F.when((viewers > 1) & (diff > 0), "spike")
        .when((viewers > 0) & (diff < 0), "drop")
        .when((viewers > 1) & (diff == 0), "retain")
        .otherwise(NO_LABEL)
    )


def view_movement(minutes: DataFrame) -> DataFrame:
    """spike, drop or retain per minute from the change of average viewers."""
    moved = change(minutes, VIDEO, POSITION, VIEWERS, "diff")
    return moved.withColumn("view_movement", movement_label(F.col(VIEWERS), F.col("diff")))


def drop_constant_series(minutes: DataFrame) -> DataFrame:
    """Rows of videos whose viewer value changes at least once, or is never known."""
    extremes = {"_low": ("min", VIEWERS), "_high": ("max", VIEWERS)}
    known = attach_group(minutes, VIDEO, POSITION, extremes)
    constant = F.coalesce(F.col("_low") == F.col("_high"), F.lit(False))
    return known.filter(~constant).drop("_low", "_high")


def value_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share of each non-NULL ``value`` within ``key``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    totals = counts.groupBy(key).agg(F.sum("_n").alias("_total"))
    shares = spread_join(counts, totals, [key], "inner", [value])
    return shares.select(key, value, (F.col("_n") / F.col("_total")).alias("proportion"))


def movement_share(moves: DataFrame, label: str | None = "retain") -> DataFrame:
    """Share of each movement per video; one ``label`` only, lowest share first."""
    shares = value_share(moves, "video_id", "view_movement")
    if label is None:
        return shares
    return shares.filter(F.col("view_movement") == label).orderBy("proportion", "video_id")


def retention_streak(moves: DataFrame) -> DataFrame:
    """Minutes since viewers last dropped or were missing: a run of spike and retain."""
    kept = moves.withColumn(
        "view_movement", F.when(F.col("view_movement") == "drop", NO_LABEL).otherwise(F.col("view_movement"))
    )
    return run_length(kept, VIDEO, POSITION, F.col("view_movement") != NO_LABEL, "scenario_1_run")


def movement_streaks(minutes: DataFrame) -> DataFrame:
    """``retention_streak(view_movement(minutes))`` with one carry pass for both."""
    viewers = F.col(VIEWERS)

    def kept(before: Column) -> Column:
        return movement_label(viewers, viewers - before).isin("spike", "retain")

    runs = run_length(minutes, VIDEO, POSITION, kept, "scenario_1_run", value=VIEWERS)
    diff = viewers - F.col("_before")
    label = movement_label(viewers, diff)
    return runs.withColumns(
        {"diff": diff, "view_movement": F.when(label == "drop", NO_LABEL).otherwise(label)}
    ).drop("_before")


def retention_segments(streaks: DataFrame, min_rows: int = 60) -> DataFrame:
    """Longest streak, minutes and mean viewers per video, placed against the medians.

    Videos of ``min_rows`` minutes or fewer are left out; a value equal to its
    median has no segment. The per-video rows are stored while the plan is built;
    both medians and the result read them.
    """
    videos = (
        streaks.groupBy("video_id")
        .agg(
            F.max("scenario_1_run").alias("max_run"),
            F.count("*").alias("total_rows"),
            F.avg(VIEWERS).alias("avg_viewers_per_min"),
        )
        .withColumn("retain_pct", F.col("max_run") / F.col("total_rows"))
        .filter(F.col("total_rows") > min_rows)
    )
    videos = materialize(videos, "video_measures")
    measures = videos.select(
        F.inline(
            F.array(
                F.struct(F.lit("viewers").alias("measure"), F.col("avg_viewers_per_min").alias("value")),
                F.struct(F.lit("retain").alias("measure"), F.col("retain_pct").alias("value")),
            )
        )
    )
    medians = exact_median(measures, ["measure"], "value", "median", store=False)
    cuts = medians.agg(
        F.struct(
            F.max(F.when(F.col("measure") == "viewers", F.col("median"))).alias("viewers"),
            F.max(F.when(F.col("measure") == "retain", F.col("median"))).alias("retain"),
        )
    ).scalar()
    cut_viewers, cut_retain = F.col("_cuts.viewers"), F.col("_cuts.retain")
    viewers, retain = F.col("avg_viewers_per_min"), F.col("retain_pct")
    segment = (
        F.when((viewers > cut_viewers) & (retain > cut_retain), "high_viewers_high_ret")
        .when((viewers > cut_viewers) & (retain < cut_retain), "high_viewers_low_ret")
        .when((viewers < cut_viewers) & (retain < cut_retain), "low_viewers_low_ret")
        .when((viewers < cut_viewers) & (retain > cut_retain), "low_viewers_high_ret")
        .otherwise(NO_LABEL)
    )
    return videos.withColumn("_cuts", cuts).withColumn("segments", segment).drop("_cuts")


def retention_report(segments: DataFrame, details: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Segments with the newest raw title and publish time of each video."""
    info = latest_per(
        details.select("video_id", "video_title_raw", "video_published_at", "load_ts", *tie), VIDEO, "load_ts", tie
    ).drop("load_ts", *tie)
    return segments.join(info, "video_id", "left")
