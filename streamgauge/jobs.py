"""Batch jobs: land feeds into staging, build the warehouse, publish it to SQL.

    python -m streamgauge.jobs daily  --landing DIR --root DIR --mode append
    python -m streamgauge.jobs weekly --landing DIR --root DIR --mode append [--names CSV]

``landing`` holds folders of API responses (``videos``, ``minutes``,
``watched``, ``days``) and of transcripts (``transcripts``). ``root`` holds one
folder per layer and table. Each step writes through ``sources.tables``, so a
rerun after a failure adds only what is missing.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from streamgauge.operators.joins import spread_join
from streamgauge.operators.loads import lookback
from streamgauge.plans import transcript, vault
from streamgauge.session import build_session
from streamgauge.sources import landing, lookups, tables, transcripts

# Fixed value: the first day the channel's reports cover.
ORIGIN = "2022-09-16"

VIDEO, DAY, TRANSCRIPT = "sc_yt_video_data", "sc_yt_day_data", "sc_yt_video_transcript"


def stage_daily(spark: SparkSession, source: str, root: str, mode: str, today: date) -> None:
    """Combine the video feeds and load them and the channel's days into staging.

    Days start a week before the newest loaded one, so late corrections come in.
    """
    combined = landing.combine_feeds(
        landing.read_items(spark, f"{source}/videos"),
        landing.minute_feed(landing.read_reports(spark, f"{source}/minutes", ["video_id"])),
        landing.first_row_values(landing.read_reports(spark, f"{source}/watched")),
    )
    days = landing.day_feed(landing.read_reports(spark, f"{source}/days"))
    loaded = tables.newest_loaded(spark, root, DAY).withColumnRenamed("max_date", "date") if mode == "append" else None
    tables.load_stage(combined, root, VIDEO, mode)
    tables.load_stage(lookback(days, loaded, "date", today, origin=ORIGIN), root, DAY, mode)


def stage_weekly(spark: SparkSession, source: str, root: str, mode: str, today: date, days: int = 7) -> None:
    """Load the gap-filled transcripts of recently published videos into staging.

    A truncating load takes every transcript of the folder.
    """
    segments = transcripts.read_files(spark, f"{source}/transcripts")
    if mode == "append":
        videos = landing.read_items(spark, f"{source}/videos")
        recent = landing.recent_videos(videos, today, days).select("video_id").distinct()
        segments = spread_join(segments, recent, ["video_id"], "left_semi", ["start_time"])
    tables.load_stage(transcript.fill_gaps(segments), root, TRANSCRIPT, mode)


def load_product(
    spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame], truncate_reload: bool = False
) -> None:
    """Append what the target lacks; a first or a truncating run builds the whole.

    Of two runs at once the second one fails and adds nothing.
    """
    state = tables.table_state(spark, path)
    if truncate_reload:
        tables.write_snapshot(build(None), path, state)
    else:
        tables.append_rows(build(tables.read_table(spark, path, at=state)), path, state)


def build_raw_vault(spark: SparkSession, root: str, truncate_reload: bool = False) -> None:
    """Hub, satellites and daily fact from staging."""
    videos, days = tables.read_stage(spark, root, VIDEO), tables.read_stage(spark, root, DAY)
    products = {
        "social_content_sat_details": lambda t: vault.sat_details(videos, t),
        "social_content_sat_min_viewers": lambda t: vault.sat_minute_viewers(videos, t),
        "fct_channel_metrics_daily": lambda t: vault.channel_daily(days, t),
    }
    load_product(spark, f"{root}/rdv/social_content_hub", lambda t: vault.hub(videos, t))
    for name, build in products.items():
        load_product(spark, f"{root}/rdv/{name}", build, truncate_reload)


def build_business_vault(spark: SparkSession, root: str) -> None:
    """Minute text of videos that have none yet."""
    segments = tables.read_stage(spark, root, TRANSCRIPT)
    load_product(
        spark, f"{root}/bdv/fct_video_transcript_segment", lambda t: transcript.transcript_minutes(segments, target=t)
    )


def load_names(spark: SparkSession, csv: str, root: str) -> None:
    """Replace the lookup of speaker names."""
    tables.write_snapshot(lookups.read_speaker_names(spark, csv), f"{root}/rdv/speaker_name_correction")


def publish(spark: SparkSession, root: str) -> None:
    """Every built table as ``layer.table`` for SQL."""
    names = {
        "stage": [VIDEO, DAY, TRANSCRIPT],
        "rdv": [
            "social_content_hub",
            "social_content_sat_details",
            "social_content_sat_min_viewers",
            "fct_channel_metrics_daily",
            "speaker_name_correction",
        ],
        "bdv": ["fct_video_transcript_segment"],
    }
    for layer, members in names.items():
        paths = {n: f"{root}/{layer}/{n}" for n in members}
        tables.publish_layer(spark, layer, {n: p for n, p in paths.items() if tables.has_snapshot(spark, p)})


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=["daily", "weekly"])
    parser.add_argument("--landing", required=True)
    parser.add_argument("--root", required=True)
    parser.add_argument("--mode", choices=tables.ACTIONS, required=True)
    parser.add_argument("--today", type=date.fromisoformat, default=date.today())
    parser.add_argument("--truncate-reload", action="store_true", help="rebuild satellites and fact as a whole")
    parser.add_argument("--names", help="CSV of speaker names that replaces the lookup")
    args = parser.parse_args()
    spark = build_session(f"streamgauge {args.job}")
    if args.job == "daily":
        stage_daily(spark, args.landing, args.root, args.mode, args.today)
        build_raw_vault(spark, args.root, args.truncate_reload)
    else:
        stage_weekly(spark, args.landing, args.root, args.mode, args.today)
        build_business_vault(spark, args.root)
    if args.names:
        load_names(spark, args.names, args.root)
    publish(spark, args.root)
    spark.stop()


if __name__ == "__main__":
    main()
