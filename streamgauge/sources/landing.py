"""Landed API responses, one JSON document per line (or per file).

Every response carries when it ``landed``: its own field of that name, or else
its file's time. Of several values for one key the latest landed counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from streamgauge.schemas import API_ITEMS, API_PAGE, API_REPORT


def read_json(spark: SparkSession, path: str, schema: StructType, per_file: bool = False) -> DataFrame:
    rows = spark.read.schema(StructType([*schema.fields, StructField("landed", TimestampType())])).option("multiLine", per_file).json(path)
    return rows.withColumn("landed", F.coalesce("landed", F.col("_metadata.file_modification_time")))


def _landed(df: DataFrame) -> list[str]:
    return ["landed"] if "landed" in df.columns else []


def read_items(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return api_items(read_json(spark, path, API_ITEMS, per_file))


def read_reports(spark: SparkSession, path: str, ids: Sequence[str] = (), per_file: bool = False) -> DataFrame:
    """Reports, with ``ids`` (such as the video asked for) landed next to them."""
    schema = StructType(list(API_REPORT.fields))
    for name in ids:
        schema = schema.add(name, StringType())
    return read_json(spark, path, schema, per_file)


def read_pages(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return page_ids(read_json(spark, path, API_PAGE, per_file))


def api_items(responses: DataFrame) -> DataFrame:
    """List responses -> one row per item: its id, its full JSON and, if known, when it landed."""
    landed = _landed(responses)
    items = responses.select(*landed, F.explode("items").alias("video_data"))
    return items.select(F.get_json_object("video_data", "$.id").alias("video_id"), "video_data", *landed)


def report_records(reports: DataFrame, key: str, ids: Sequence[str] = ()) -> DataFrame:
    """Columnar reports -> one ``record`` map per key; the last row of the report landed last wins."""
    landed = _landed(reports)
    rows = reports.select(
        *ids, *landed, F.col("columnHeaders.name").alias("_names"), F.posexplode("rows").alias("_pos", "_row")
    )
    records = rows.select(*ids, F.struct(*landed, "_pos").alias("_pos"), F.map_from_arrays("_names", "_row").alias("_record"))
    return (
        records.withColumn(key, F.col("_record")[key])
        .groupBy(*ids, key)
        .agg(F.max_by("_record", "_pos").alias("record"))
    )


def day_feed(reports: DataFrame) -> DataFrame:
    """Daily report -> ``(date, date_metrics)`` with the metrics as JSON."""
    days = report_records(reports, "day")
    return days.select(F.col("day").cast("date").alias("date"), F.to_json("record").alias("date_metrics"))


def minute_feed(reports: DataFrame) -> DataFrame:
    """Per-video minute reports -> ``(video_id, minute_metrics)``, keyed JSON by position.

    Videos whose report has no rows are absent, as they add no row.
    """
    minutes = report_records(reports, "livestreamPosition", ["video_id"])
    entries = F.array_sort(
        F.collect_list(
            F.struct(F.col("livestreamPosition").cast("int").alias("_at"), "livestreamPosition", "record")
        ),
        lambda a, b: a["_at"] - b["_at"],
    )
    keyed = F.map_from_entries(
        F.transform("_entries", lambda e: F.struct(e["livestreamPosition"], e["record"]))
    )
    return (
        minutes.groupBy("video_id")
        .agg(entries.alias("_entries"))
        .select("video_id", F.to_json(keyed).alias("minute_metrics"))
    )


def first_row_values(reports: DataFrame) -> DataFrame:
    """First report row -> ``(video_id, estimatedMinutesWatched)``, the latest landed; empty reports add nothing."""
    first = F.get("rows", F.lit(0))
    values = reports.filter(first.isNotNull()).select(
        F.get(first, F.lit(0)).alias("video_id"),
        F.get(first, F.lit(1)).cast("double").alias("value"),
        *_landed(reports),
    )
    return values.groupBy("video_id").agg(F.max_by("value", F.struct(*_landed(reports), "value")).alias("estimatedMinutesWatched"))


def page_ids(pages: DataFrame) -> DataFrame:
    """Pages of playlist items -> flat list of video ids."""
    items = pages.select(F.explode("items").alias("item"))
    return items.select(F.col("item.contentDetails.videoId").alias("video_id"))


def combine_feeds(videos: DataFrame, minutes: DataFrame, watched: DataFrame) -> DataFrame:
    """Three feeds -> one staging row per video, its latest item; videos without minutes or time stay."""
    newest = videos.groupBy("video_id").agg(F.max_by("video_data", F.struct(*_landed(videos), "video_data")).alias("video_data"))
    return (
        newest.join(minutes, "video_id", "left")
        .join(watched, "video_id", "left")
        .select("video_id", "video_data", "minute_metrics", "estimatedMinutesWatched")
    )


def recent_videos(videos: DataFrame, today, days: int = 7) -> DataFrame:
    """Distinct (id, publish date) of items published in the last ``days`` days."""
    published = F.get_json_object("video_data", "$.snippet.publishedAt")
    end = F.lit(today).cast("date")
    return (
        videos.select("video_id", F.to_date(published.cast("timestamp_ntz")).alias("video_publish_dt"))
        .filter(F.col("video_publish_dt").between(F.date_sub(end, days), end))
        .distinct()
    )
