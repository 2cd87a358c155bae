"""Transcripts: gaps, minute buckets, coverage, rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamgauge.functions.text import blank_if_null, bucket_label, watch_url
from streamgauge.functions.times import bucket_start
from streamgauge.operators.joins import keep_unseen, spread_join
from streamgauge.operators.series import next_value
from streamgauge.sources import transcripts as files
from streamgauge.sources.tables import write_snapshot

COPIES_PER_TASK = 1_000_000


def _expand(df: DataFrame, times: str) -> DataFrame:
    """Repeat each row ``times`` times; huge counts are cut up and spread over tasks first."""
    blocks = F.floor((F.col(times) - 1) / COPIES_PER_TASK)
    cut = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), blocks)))
    size = F.least(F.col(times) - F.col("_block") * COPIES_PER_TASK, F.lit(COPIES_PER_TASK))
    spread = cut.withColumn("_size", size).repartition(*df.columns, "_block")
    return spread.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "_size"))).select(*df.columns)


def gap_rows(segments: DataFrame) -> DataFrame:
    """A blank row wherever a segment does not end where its successor starts.

    Segments are ordered by start and end. "Not equal" includes overlaps, so a
    blank row can have a negative length. Of the segments with one start time
    only the last is followed by a later start; the others, copies included,
    are followed by their own start.
    """
    starts = segments.groupBy("video_id", "start_time").agg(
        F.max("end_time").alias("_last_end"), F.count("*").alias("_n")
    )
    following = next_value(starts, ["video_id"], "start_time", "start_time", "_next", span=3600 * 4)
    between = following.filter(F.col("_last_end") != F.col("_next")).select(
        "video_id", F.col("_last_end").alias("start_time"), F.col("_next").alias("end_time")
    )
    shared = starts.filter(F.col("_n") > 1).drop("_n")
    ends = segments.groupBy("video_id", "start_time", "end_time").agg(F.count("*").alias("_copies"))
    same_start = (
        spread_join(ends, shared, ["video_id", "start_time"], "inner", ["end_time"])
        .withColumn("_copies", F.col("_copies") - (F.col("end_time") == F.col("_last_end")).cast("long"))
        .filter((F.col("_copies") > 0) & (F.col("end_time") != F.col("start_time")))
        .select(
            "video_id",
            F.col("end_time").alias("start_time"),
            F.col("start_time").alias("end_time"),
            "_copies",
        )
    )
    return between.unionByName(_expand(same_start, "_copies").drop("_copies")).withColumn("text", F.lit(""))


def fill_gaps(segments: DataFrame) -> DataFrame:
    """Segments plus one blank row per gap or overlap between neighbours."""
    rows = segments.select("video_id", "start_time", "end_time", "text")
    return rows.unionByName(gap_rows(rows))


def split_at_buckets(segments: DataFrame, bucket: int = 60, split: str = "once") -> DataFrame:
    """Pieces of segments that cross a bucket border; the text goes to every piece.

    ``once`` cuts only at the border of the last bucket, so a segment over
    three or more buckets keeps a long first piece. ``all`` cuts at each one.
    """
    start, end = F.col("start_time"), F.col("end_time")
    first, last = bucket_start(start, bucket), bucket_start(end, bucket)

    def piece(a, b):
        return F.struct(a.cast("double").alias("start_time"), b.cast("double").alias("end_time"))

    if split == "once":
        pieces = F.when(first != last, F.array(piece(start, last), piece(last, end))).otherwise(
            F.array(piece(start, end))
        )
    elif split == "all":
        lower = F.sequence(first, last, F.lit(bucket).cast("long"))
        cuts = F.transform(
            lower, lambda lb: piece(F.greatest(start, lb.cast("double")), F.least(end, (lb + bucket).cast("double")))
        )
        pieces = F.when(first < last, cuts).when(
            first > last, F.array(piece(start, last), piece(last, end))
        ).otherwise(F.array(piece(start, end)))
    else:
        raise ValueError("split must be once or all")
    others = [c for c in segments.columns if c not in ("start_time", "end_time")]
    return segments.select(*others, F.inline(pieces))


def transcript_minutes(
    segments: DataFrame,
    bucket: int = 60,
    split: str = "once",
    target: DataFrame | None = None,
    copies: str = "drop",
) -> DataFrame:
    """Spoken seconds and text per (video, bucket); with ``target`` only unseen videos.

    Pieces are gathered per bucket in one shuffle: the set drops copies on the
    map side and holds just what the bucket's text is made of. ``copies="keep"``
    counts equal pieces as often as they occur. Text is joined by start, end,
    text, NULLs skipped; a bucket without any text has NULL.
    """
    rows = segments.select("video_id", "start_time", "end_time", "text").filter(F.col("video_id").isNotNull())
    if target is not None:
        rows = keep_unseen(rows, target, ["video_id"])
    lower = bucket_start(F.col("start_time"), bucket)
    pieces = split_at_buckets(rows, bucket, split).withColumn("minute_boundaries_lb", lower)
    if copies == "keep":
        counted = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("n"))
    elif copies == "drop":
        counted = pieces.withColumn("n", F.lit(1).cast("long"))
    else:
        raise ValueError("copies must be drop or keep")
    parts = counted.groupBy("video_id", "minute_boundaries_lb").agg(
        F.array_sort(F.collect_set(F.struct("start_time", "end_time", "text", "n"))).alias("_parts")
    )
    spoken = F.aggregate(
        "_parts",
        F.lit(0.0),
        lambda acc, p: acc
        + F.when(p["text"] != "", (p["end_time"] - p["start_time"]) * p["n"]).otherwise(0.0),
    )
    # array_join skips NULL elements, as the concatenating aggregate does.
    words = F.array_join(F.transform("_parts", lambda p: F.repeat(p["text"], p["n"].cast("int"))), "")
    return parts.select(
        "video_id",
        "minute_boundaries_lb",
        (F.col("minute_boundaries_lb") + bucket).alias("minute_boundaries_ub"),
        spoken.alias("duration_secs_valid"),
        F.when(F.exists("_parts", lambda p: p["text"].isNotNull()), words).alias("text"),
    )


def transcript_coverage(segments: DataFrame, bucket: int = 60) -> DataFrame:
    """Gap-filled minutes with bucket label and the covered share of the bucket."""
    minutes = transcript_minutes(fill_gaps(segments), bucket, copies="keep")
    return minutes.select(
        "video_id",
        "minute_boundaries_lb",
        "minute_boundaries_ub",
        bucket_label(F.col("minute_boundaries_lb"), F.col("minute_boundaries_ub")).alias("minute_boundaries"),
        blank_if_null(F.col("text")).alias("text"),
        "duration_secs_valid",
        (F.col("duration_secs_valid") / bucket).alias("duration_text_coverage_pct"),
    )


def full_text(segments: DataFrame) -> DataFrame:
    """The whole text of each video in order.

    Joined per ten-minute part first, so the parts of a long video are built
    in parallel.
    """
    rows = segments.filter(F.col("text").isNotNull())
    part = bucket_start(F.col("start_time"), 600)
    parts = rows.groupBy("video_id", part.alias("_part")).agg(
        F.expr("listagg(text, '') within group (order by start_time, end_time, text)").alias("_text")
    )
    return parts.groupBy("video_id").agg(F.expr("listagg(_text, '') within group (order by _part)").alias("text"))


def missing_transcripts(videos: DataFrame, file_ids: DataFrame) -> DataFrame:
    """Watch URLs of videos without a transcript file."""
    missing = files.missing_transcripts(videos, file_ids)
    return missing.select("video_id", watch_url(F.col("video_id")).alias("url"))


def rebuild_transcripts(spark: SparkSession, folder: str, table_path: str) -> None:
    """Rebuild the whole transcript stage from a folder of text files."""
    write_snapshot(fill_gaps(files.read_files(spark, folder)), table_path)
