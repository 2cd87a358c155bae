"""Explicit schemas of staging tables, JSON payloads and landed API files."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


STAGE_VIDEO = _struct(
    video_id=StringType(),
    video_data=StringType(),
    minute_metrics=StringType(),
    estimatedMinutesWatched=DoubleType(),
    record_source=StringType(),
    load_ts=TimestampNTZType(),
)

STAGE_DAY = _struct(date=DateType(), date_metrics=StringType(), load_ts=TimestampNTZType())

STAGE_TRANSCRIPT = _struct(
    video_id=StringType(), start_time=DoubleType(), end_time=DoubleType(), text=StringType()
)

STAGE_TABLES = {
    "sc_yt_video_data": STAGE_VIDEO,
    "sc_yt_day_data": STAGE_DAY,
    "sc_yt_video_transcript": STAGE_TRANSCRIPT,
}

SPEAKER_NAMES = _struct(original_name=StringType(), canonical_name=StringType())

FORECAST_CSV = _struct(
    _index=IntegerType(),
    ds=DateType(),
    y=DoubleType(),
    yhat=DoubleType(),
    actual_running_sub=DoubleType(),
    predicted_running_sub=DoubleType(),
)

# Payloads. Counts arrive as text and are cast by the vault plans.
VIDEO_DATA = _struct(
    id=StringType(),
    snippet=_struct(
        title=StringType(),
        description=StringType(),
        publishedAt=StringType(),
        categoryId=StringType(),
    ),
    contentDetails=_struct(duration=StringType()),
    topicDetails=_struct(topicCategories=StringType()),
    statistics=_struct(likeCount=StringType(), viewCount=StringType(), commentCount=StringType()),
)

MINUTE_METRICS = MapType(
    StringType(),
    _struct(peakConcurrentViewers=StringType(), averageConcurrentViewers=StringType()),
)

DAY_METRICS = _struct(
    likes=StringType(),
    views=StringType(),
    shares=StringType(),
    comments=StringType(),
    dislikes=StringType(),
    subscribersLost=StringType(),
    subscribersGained=StringType(),
    averageViewDuration=StringType(),
    averageViewPercentage=StringType(),
    estimatedMinutesWatched=StringType(),
)

# Landed API responses; values inside a report row have mixed types.
API_ITEMS = _struct(items=ArrayType(StringType()))
API_REPORT = _struct(
    columnHeaders=ArrayType(_struct(name=StringType())),
    rows=ArrayType(ArrayType(StringType())),
)
API_PAGE = _struct(items=ArrayType(_struct(contentDetails=_struct(videoId=StringType()))))

# Empty results.
VIDEO_ITEMS = _struct(video_id=StringType(), video_data=StringType())
VIDEO_MINUTES = _struct(video_id=StringType(), minute_metrics=StringType())
VIDEO_WATCHED = _struct(video_id=StringType(), estimatedMinutesWatched=DoubleType())
RECENT_VIDEOS = _struct(video_id=StringType(), video_publish_dt=DateType())
