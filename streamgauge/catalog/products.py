"""Data products (m keys) and model operators (g keys)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.catalog.registry import Input, query
from streamgauge.operators.latest import latest_per
from streamgauge.plans import curves, engagement, forecast, kpi, retention, semantic, transcript, trend, vault, wordvectors
from streamgauge.sources import landing, transcripts
from streamgauge.session import materialize, scratch_path

UNTIL = "2002-06-30"


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


# ---------------------------------------------------------------- vault


def video_stage(i: Input) -> DataFrame:
    """Staging rows with the video payload as JSON."""
    v = i.v("stage_video")
    payload = F.struct(
        F.col("video_id").cast("string").alias("id"),
        F.struct(
            F.col("title_raw").alias("title"),
            F.col("description"),
            F.date_format("load_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.col("category").alias("categoryId"),
        ).alias("snippet"),
        F.struct(F.col("duration_iso").alias("duration")).alias("contentDetails"),
        F.when(F.col("topic").isNotNull(), F.struct(F.array("topic", F.lit("talk")).alias("topicCategories"))).alias("topicDetails"),
        F.struct(
            F.col("like_count").cast("string").alias("likeCount"),
            F.col("view_count").cast("string").alias("viewCount"),
            F.col("comment_count").cast("string").alias("commentCount"),
        ).alias("statistics"),
    )
    return v.select(
        "video_id",
        F.to_json(payload).alias("video_data"),
        F.lit(None).cast("string").alias("minute_metrics"),
        F.col("minutes_watched").alias("estimatedMinutesWatched"),
        "record_source",
        "load_ts",
        "tie",
    )


def minute_stage(i: Input) -> DataFrame:
    """One staging row per video and load hour, several a day, with its minutes as a keyed JSON object."""
    m = i.v("minute_viewers").withColumn("hour", F.date_trunc("hour", "load_ts"))
    newest = latest_per(m, ["video_id", "hour", "livestream_position"], "load_ts", ["tie"])
    entry = F.struct(
        F.col("livestream_position").cast("string").alias("k"),
        F.struct(
            F.col("livestream_position").alias("livestreamPosition"),
            F.col("peak_concurrent_viewers").alias("peakConcurrentViewers"),
            F.col("average_concurrent_viewers").alias("averageConcurrentViewers"),
        ).alias("v"),
    )
    return newest.groupBy("video_id", "hour").agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("minute_metrics"),
        F.max("load_ts").alias("load_ts"),
    ).drop("hour")


def day_stage(i: Input) -> DataFrame:
    """Staging rows with the daily metrics as JSON."""
    metrics = F.struct(*[F.col(c).cast("string").alias(m) for m, (c, _) in vault.DAY_METRIC_TYPES.items()])
    return i.v("stage_day").select(
        F.col("date_key").alias("date"), F.to_json(metrics).alias("date_metrics"), "load_ts", "tie"
    )


@query(
    "m1_hub",
    """select video_id, record_source, load_ts from (
         select *, row_number() over (partition by video_id order by load_ts, record_source) as rn
         from stage_video where video_id is not null) t
       where rn = 1""",
    "stage_video",
)
def m1(i):
    return vault.hub(i.v("stage_video"))


# Details as the vault derives them, from plain columns.
DETAIL_CTES = """
    with src as (
      select *, row_number() over (partition by video_id, cast(load_ts as date)
                                   order by load_ts desc, tie desc) as rn from stage_video
    ), typed as (
      select video_id, title_raw as video_title_raw, topic,
             trim(case when title_raw ilike 'session%' or title_raw ilike 'series%' then split_part(title_raw, '|', 2)
                       when title_raw ilike '[luton%' then split_part(title_raw, '-', 1)
                       else split_part(title_raw, '|', 1) end) as video_title,
             description as video_description,
             load_ts as video_published_at, cast(duration_sec as double) as video_duration_sec,
             concat('["' || topic, '","talk"]') as video_topic_text, category as video_category,
             cast(like_count as int) as likes_count, cast(view_count as int) as view_count,
             cast(comment_count as int) as comment_count, minutes_watched as estimated_minutes_watched, load_ts, tie
      from src where rn = 1
    ), hashed as (
      select *, case when topic is not null then video_topic_text end as video_topic,
             md5(concat_ws('|', video_title, video_description, cast(video_published_at as varchar),
                    cast(cast(video_duration_sec as decimal(20,6)) as varchar),
                    case when topic is not null then video_topic_text end, video_category,
                    cast(likes_count as varchar), cast(view_count as varchar), cast(comment_count as varchar),
                    cast(cast(estimated_minutes_watched as decimal(20,6)) as varchar))) as hashdiff from typed
    ), details as (
      select * from (select *, row_number() over (partition by video_id, hashdiff
                                                  order by load_ts desc, tie desc) as r2 from hashed) t
      where r2 = 1
    )"""

DETAIL_COLUMNS = (
    "video_id, video_title_raw, video_title, video_description, video_published_at, video_duration_sec, "
    "video_topic, video_category, likes_count, view_count, comment_count, estimated_minutes_watched, load_ts, hashdiff"
)


def details(i: Input, target: DataFrame | None = None) -> DataFrame:
    return vault.sat_details(video_stage(i), target, tie=["tie"])


@query("m2_sat_details", f"{DETAIL_CTES} select {DETAIL_COLUMNS} from details", "stage_video")
def m2(i):
    return details(i).select(*DETAIL_COLUMNS.split(", "))


MINUTE_CTES = """
    with newest as (
      select *, max(load_ts) over (partition by video_id, date_trunc('hour', load_ts)) as day_ts,
             dense_rank() over (partition by video_id, cast(load_ts as date)
                                order by date_trunc('hour', load_ts) desc) as snapshot,
             row_number() over (partition by video_id, date_trunc('hour', load_ts), livestream_position
                                order by load_ts desc, tie desc) as rn from minute_viewers
    ), hashed as (
      select video_id, livestream_position, peak_concurrent_viewers, average_concurrent_viewers, day_ts as load_ts,
             md5(concat_ws('|', cast(livestream_position as varchar),
                 cast(cast(peak_concurrent_viewers as decimal(20,6)) as varchar),
                 cast(cast(average_concurrent_viewers as decimal(20,6)) as varchar))) as hashdiff
      from newest where rn = 1 and snapshot = 1
    ), versions as (
      select video_id, livestream_position, peak_concurrent_viewers, average_concurrent_viewers,
             max(load_ts) as load_ts, hashdiff
      from hashed group by all
    )"""


@query("m3_sat_minute_viewers", f"{MINUTE_CTES} select * from versions", "minute_viewers")
def m3(i):
    return vault.sat_minute_viewers(minute_stage(i))


DAY_COLUMNS = ["date", *vault.DAY_HASHED, "load_ts", "hashdiff"]

DAY_METRICS = ", ".join(vault.DAY_HASHED)
# Doubles hash at a fixed scale.
DAY_HASHED_TEXT = ", ".join(
    f"cast(cast({c} as decimal(20,6)) as varchar)" if kind == "double" else f"cast({c} as varchar)"
    for c in vault.DAY_HASHED for name, kind in vault.DAY_METRIC_TYPES.values() if name == c
)

DAY_CTES = f"""
    with newest as (
      select *, row_number() over (partition by date_key, cast(load_ts as date)
                                   order by load_ts desc, tie desc) as rn from stage_day
    ), hashed as (
      select date_key as date, {DAY_METRICS}, load_ts, tie, md5(concat_ws('|', {DAY_HASHED_TEXT})) as hashdiff
      from newest where rn = 1
    ), versions as (
      select date, {DAY_METRICS}, load_ts, hashdiff from (
        select *, row_number() over (partition by date, hashdiff order by load_ts desc, tie desc) as r2
        from hashed) t where r2 = 1
    )"""


@query("m4_channel_daily", f"{DAY_CTES} select * from versions", "stage_day")
def m4(i):
    return vault.channel_daily(day_stage(i), tie=["tie"]).select(*DAY_COLUMNS)


@query(
    "m38_presentation_views",
    f"""{DETAIL_CTES}
    select video_id, video_title, video_published_at, likes_count as video_likes, view_count as video_views,
           comment_count as video_comments, estimated_minutes_watched as video_estimated_minutes_watched, video_duration_sec,
           case when video_duration_sec >= 3600 then 'Livestream' else 'Short' end as video_type,
           split_part(video_title_raw, '|', 2) as video_speaker
    from (select *, row_number() over (partition by video_id order by load_ts desc, hashdiff desc) as r3 from details) t
    where r3 = 1""",
    "stage_video",
)
def m38(i):
    kind = F.when(F.col("video_duration_sec") >= 3600, "Livestream").otherwise("Short")
    speaker = F.split_part("video_title_raw", F.lit("|"), F.lit(2))
    return vault.dim_video(details(i), kind, speaker, tie=["hashdiff"])


@query(
    "m38_presentation_daily",
    f"""{DAY_CTES}
    select date as metric_date, 'YOUTUBE' as platform, subscribers_gained, subscribers_lost, views as views_count,
           likes as likes_count, dislikes as dislikes_count, comments as comments_count, shares as shares_count,
           estimated_minutes_watched as estimated_watch_minutes
    from (select *, row_number() over (partition by date order by load_ts desc, hashdiff desc) as r3 from versions) t
    where r3 = 1""",
    "stage_day",
)
def m38_daily(i):
    return vault.fct_daily(vault.channel_daily(day_stage(i), tie=["tie"]), tie=["hashdiff"])


@query(
    "m38_presentation_minutes",
    f"""{MINUTE_CTES}
    select video_id, livestream_position, peak_concurrent_viewers, average_concurrent_viewers, load_ts
    from (select *, row_number() over (partition by video_id, livestream_position
                                       order by load_ts desc, hashdiff desc) as r3 from versions) t
    where r3 = 1""",
    "minute_viewers",
)
def m38_minutes(i):
    return vault.dim_minutes(vault.sat_minute_viewers(minute_stage(i)), tie=["hashdiff"])


@query(
    "m36_daily_stage_combine",
    """with v as (select distinct video_id from stage_video),
       m as (select video_id, count(distinct livestream_position) as n_minutes from minute_viewers group by video_id),
       w as (select video_id, cast(sum(like_count) as double) as watched from stage_video
             group by video_id having max(record_source) = 'src3')
       select v.video_id, v.video_id as json_id, coalesce(m.n_minutes, 0) as n_minutes,
              w.watched as estimated_minutes_watched
       from v left join m on v.video_id = m.video_id left join w on v.video_id = w.video_id""",
    "stage_video",
    "minute_viewers",
)
def m36(i):
    response = i.v("stage_video").select("video_id").distinct().select(
        F.array(F.to_json(F.struct(F.col("video_id").cast("string").alias("id")))).alias("items")
    )
    combined = landing.combine_feeds(landing.api_items(response), landing.minute_feed(minute_reports(i)), landing.first_row_values(watch_reports(i)))
    keys = F.map_keys(F.from_json("minute_metrics", "map<string,string>"))
    return combined.select(
        F.col("video_id").cast("long").alias("video_id"),
        F.get_json_object("video_data", "$.id").cast("long").alias("json_id"),
        F.coalesce(F.size(keys), F.lit(0)).cast("long").alias("n_minutes"),
        F.col("estimatedMinutesWatched").alias("estimated_minutes_watched"),
    )


def minute_reports(i: Input) -> DataFrame:
    """Per-video minute reports in the columnar form of the API, one for each load.

    The n-th load of a position stands in the n-th report, so a report stays as
    short as a video is long, and later ones replace its rows.
    """
    names = ["livestreamPosition", "averageConcurrentViewers", "peakConcurrentViewers"]
    row = F.array(
        F.col("livestream_position").cast("string"),
        F.col("average_concurrent_viewers").cast("string"),
        F.col("peak_concurrent_viewers").cast("string"),
    )
    loads = Window.partitionBy("video_id", "livestream_position").orderBy("load_ts", "tie")
    ranked = i.v("minute_viewers").withColumn("landed", F.timestamp_seconds(F.row_number().over(loads)))
    ordered = F.array_sort(F.collect_list(F.struct("load_ts", "tie", row.alias("row"))))
    return (
        ranked.groupBy(F.col("video_id").cast("string").alias("video_id"), "landed")
        .agg(F.transform(ordered, lambda r: r["row"]).alias("rows"))
        .withColumn("columnHeaders", F.array(*[F.struct(F.lit(n).alias("name")) for n in names]))
    )


def watch_reports(i: Input) -> DataFrame:
    """Watch-time reports; videos without a load of the last source have an empty one."""
    total = i.v("stage_video").groupBy("video_id").agg(
        F.sum("like_count").alias("n"), F.max("record_source").alias("last")
    )
    row = F.array(F.col("video_id").cast("string"), F.col("n").cast("string"))
    rows = F.when(F.col("last") == "src3", F.array(row)).otherwise(F.array().cast("array<array<string>>"))
    return total.select(rows.alias("rows"))


@query(
    "m35_recent_videos",
    """select distinct cast(video_id as varchar) as video_id, cast(load_ts as date) as video_publish_dt from stage_video
       where cast(load_ts as date) between date '1998-06-23' and date '1998-06-30'""",
    "stage_video",
)
def m35(i):
    items = video_stage(i).select(F.col("video_id").cast("string").alias("video_id"), "video_data")
    return landing.recent_videos(items, "1998-06-30", 7)


# ---------------------------------------------------------- transcripts

PIECES = """
    pieces as (
      select distinct video_id, start_time, end_time, text from (
        select video_id, start_time, floor(end_time/60)*60 as end_time, text from {src}
         where floor(start_time/60) <> floor(end_time/60)
        union all
        select video_id, floor(end_time/60)*60 as start_time, end_time, text from {src}
         where floor(start_time/60) <> floor(end_time/60)
        union all
        select video_id, start_time, end_time, text from {src}
         where floor(start_time/60) = floor(end_time/60)) u
    ), buckets as (
      select video_id, cast(floor(start_time/60)*60 as bigint) as minute_boundaries_lb,
             cast(floor(start_time/60)*60 + 60 as bigint) as minute_boundaries_ub,
             round(sum(case when text <> '' then end_time - start_time else 0 end), 6) as duration_secs_valid,
             string_agg(text, '' order by start_time, end_time, text) as text
      from pieces group by 1, 2, 3
    )"""

M5 = "with " + PIECES.format(src="segments") + " select * from buckets"


@query("m5_transcript_minutes", M5, "segments")
def m5(i):
    return rounded(transcript.transcript_minutes(i.v("segments")), 6, "duration_secs_valid")


GAPS = """
    nexts as (
      select *, lead(start_time) over (partition by video_id order by start_time, end_time) as next_start from segments
    ), filled as (
      select video_id, start_time, end_time, text from segments
      union all
      select video_id, end_time, next_start, '' from nexts where next_start is not null and next_start <> end_time
    )"""


@query("m6_transcript_gap_fill", "with " + GAPS + " select * from filled", "segments")
def m6(i):
    return transcript.fill_gaps(i.v("segments"))


@query(
    "m7_transcript_coverage",
    "with " + GAPS + "," + PIECES.format(src="filled").replace("select distinct", "select") + """
    select video_id, minute_boundaries_lb, minute_boundaries_ub,
           concat(cast(minute_boundaries_lb as varchar), '-', cast(minute_boundaries_ub as varchar)) as minute_boundaries,
           coalesce(text, '') as text, duration_secs_valid,
           round(duration_secs_valid / 60, 6) as duration_text_coverage_pct
    from buckets""",
    "segments",
)
def m7(i):
    return rounded(
        transcript.transcript_coverage(i.v("segments")), 6, "duration_secs_valid", "duration_text_coverage_pct"
    )


def transcript_folder(i: Input) -> str:
    """The segments written as transcript files, a file for each video and day of it."""
    folder = scratch_path(i.spark, "transcripts")
    transcripts.write_partitioned(i.v("file_segments"), folder)
    return folder


def read_back(i: Input) -> DataFrame:
    return transcripts.read_partitioned(i.spark, transcript_folder(i)).withColumn(
        "video_id", F.col("video_id").cast("long")
    )


@query(
    "m18_missing_transcripts",
    """select distinct cast(o_custkey as varchar) as video_id,
              concat('https://www.youtube.com/watch?v=', cast(o_custkey as varchar)) as url
       from orders where o_custkey not in (select conv_id from conversations)""",
)
def m18(i):
    videos = i.t("orders").select(F.col("o_custkey").cast("string").alias("video_id"))
    have = i.t("conversations").select(F.col("conv_id").cast("string").alias("video_id")).distinct()
    return transcript.missing_transcripts(videos, have)


@query(
    "m19_transcript_rebuild",
    "with " + GAPS.replace("from segments", "from file_segments").replace(
        "end_time, text from file_segments", "end_time, concat(' ', text) as text from file_segments"
    ) + " select * from filled",
    "file_segments",
)
def m19(i):
    from streamgauge.sources.tables import read_table, write_snapshot

    path = scratch_path(i.spark, "stage_transcript")
    write_snapshot(transcript.fill_gaps(read_back(i)), path)
    return read_table(i.spark, path)


# ------------------------------------------------------------ retention

CURRENT = """
    cur as (
      select video_id, livestream_position, peak_concurrent_viewers, average_concurrent_viewers from (
        select *, row_number() over (partition by video_id, livestream_position
                                     order by load_ts desc, tie desc) as rn from minute_viewers) t
      where rn = 1
    )"""

MOVES = CURRENT + """,
    moved as (
      select *, average_concurrent_viewers - lag(average_concurrent_viewers)
                over (partition by video_id order by livestream_position) as diff from cur
    ), moves as (
      select *, case when average_concurrent_viewers > 1 and diff > 0 then 'spike'
                     when average_concurrent_viewers > 0 and diff < 0 then 'drop'
                     when average_concurrent_viewers > 1 and diff = 0 then 'retain' else 'NULL' end as view_movement
      from moved
    )"""

STREAKS = MOVES + """,
    resets as (
      select * exclude (view_movement),
             case when view_movement = 'drop' then 'NULL' else view_movement end as view_movement,
             sum(case when view_movement in ('drop', 'NULL') then 1 else 0 end)
               over (partition by video_id order by livestream_position) as island
      from moves
    ), streaks as (
      select * exclude (island), cast(sum(case when view_movement = 'NULL' then 0 else 1 end)
               over (partition by video_id, island order by livestream_position) as bigint) as scenario_1_run
      from resets
    )"""

SEGMENTS = STREAKS + """,
    per_video as (
      select video_id, max(scenario_1_run) as max_run, count(*) as total_rows,
             avg(average_concurrent_viewers) as avg_viewers_per_min,
             cast(max(scenario_1_run) as double) / count(*) as retain_pct
      from streaks group by video_id having count(*) > 40
    ), cuts as (select median(avg_viewers_per_min) as mv, median(retain_pct) as mr from per_video),
    quadrants as (
      select video_id, max_run, total_rows, round(avg_viewers_per_min, 6) as avg_viewers_per_min,
             round(retain_pct, 6) as retain_pct,
             case when avg_viewers_per_min > mv and retain_pct > mr then 'high_viewers_high_ret'
                  when avg_viewers_per_min > mv and retain_pct < mr then 'high_viewers_low_ret'
                  when avg_viewers_per_min < mv and retain_pct < mr then 'low_viewers_low_ret'
                  when avg_viewers_per_min < mv and retain_pct > mr then 'low_viewers_high_ret'
                  else 'NULL' end as segments
      from per_video, cuts
    )"""


def current(i: Input) -> DataFrame:
    m = latest_per(i.v("minute_viewers"), ["video_id", "livestream_position"], "load_ts", ["tie"])
    return m.drop("load_ts", "tie")


def moves(i: Input) -> DataFrame:
    return retention.view_movement(current(i))


@query(
    "m9_viewer_shift_label",
    "with " + CURRENT + """,
    s as (select *, average_concurrent_viewers - lag(average_concurrent_viewers)
                 over (partition by video_id order by livestream_position) as viewer_shift from cur)
    select *, case when viewer_shift >= 2 then 'Gain' when viewer_shift >= -1 and viewer_shift <= 1 then 'Retain'
                   when viewer_shift < -1 then 'Dip' else 'NULL' end as viewer_shift_segment from s""",
    "minute_viewers",
)
def m9(i):
    return retention.viewer_shift_label(current(i))


@query(
    "m11_current_minute_viewers",
    "with " + CURRENT + """,
    dur as (select video_id, duration_sec from (
              select *, row_number() over (partition by video_id order by load_ts desc, tie desc) as rn
              from stage_video) t where rn = 1)
    select cur.* from cur join dur on cur.video_id = dur.video_id where dur.duration_sec < 5400""",
    "minute_viewers",
    "stage_video",
)
def m11(i):
    details = i.v("stage_video").withColumnRenamed("duration_sec", "video_duration_sec")
    return retention.current_minute_viewers(i.v("minute_viewers"), details, tie=["tie"], details_tie=["tie"])


@query("m12_view_movement", "with " + MOVES + " select * from moves", "minute_viewers")
def m12(i):
    return moves(i)


@query(
    "m13_constant_series_out",
    "with " + CURRENT + """, coarse as (
      select video_id, livestream_position, floor(average_concurrent_viewers / 8) as average_concurrent_viewers from cur)
    select * from coarse where video_id not in (
      select video_id from coarse group by video_id having count(distinct average_concurrent_viewers) = 1)""",
    "minute_viewers",
)
def m13(i):
    # In steps of eight viewers, as no video is constant at full detail.
    steps = F.floor(F.col("average_concurrent_viewers") / 8).cast("double")
    coarse = current(i).withColumn("average_concurrent_viewers", steps).drop("peak_concurrent_viewers")
    return retention.drop_constant_series(coarse)


@query(
    "m14_movement_share",
    "with " + MOVES + """
    select video_id, view_movement, round(proportion, 6) as proportion from (
      select video_id, view_movement,
             count(*) / cast(sum(count(*)) over (partition by video_id) as double) as proportion
      from moves group by video_id, view_movement) t
    where view_movement = 'retain'""",
    "minute_viewers",
)
def m14(i):
    return rounded(retention.movement_share(moves(i)), 6, "proportion")


@query("m15_retention_streak", "with " + STREAKS + " select * from streaks", "minute_viewers")
def m15(i):
    return retention.movement_streaks(current(i))


def segments(i: Input) -> DataFrame:
    return retention.retention_segments(retention.movement_streaks(current(i)), min_rows=40)


@query("m16_retention_segments", "with " + SEGMENTS + " select * from quadrants", "minute_viewers")
def m16(i):
    return rounded(segments(i), 6, "avg_viewers_per_min", "retain_pct")


@query(
    "m17_retention_report",
    "with " + SEGMENTS + """,
    info as (select video_id, title_raw as video_title_raw, load_ts as video_published_at from (
               select *, row_number() over (partition by video_id order by load_ts desc, tie desc) as rn
               from stage_video) t where rn = 1)
    select q.*, info.video_title_raw, info.video_published_at
    from quadrants q left join info on q.video_id = info.video_id""",
    "minute_viewers",
    "stage_video",
)
def m17(i):
    details = i.v("stage_video").select(
        "video_id", F.col("title_raw").alias("video_title_raw"), F.col("load_ts").alias("video_published_at"), "load_ts", "tie"
    )
    return retention.retention_report(rounded(segments(i), 6, "avg_viewers_per_min", "retain_pct"), details, ["tie"])


# ------------------------------------------------------------- semantic

# Scores by unnested dimensions and a self-join on row numbers.
SHIFT = """
    numbered{tag} as (
      select video_id, livestream_position, duration_text_coverage_pct,
             case when duration_text_coverage_pct < 0.5 then null else embedding end as e,
             row_number() over (partition by video_id order by livestream_position) as rn
      from embedded_minutes
    ), dims{tag} as (
      select video_id, rn, unnest(range(1, 65)) as d, unnest(e) as x from numbered{tag} where e is not null
    ), means{tag} as (
      select c.video_id, c.rn, p.d, avg(cast(p.x as double)) as m, count(*) as n
      from numbered{tag} c join dims{tag} p
        on p.video_id = c.video_id and p.rn between c.rn - {n} and c.rn - 1
      group by 1, 2, 3
    ), cosines{tag} as (
      select a.video_id, a.rn, min(m.n) as n,
             sum(cast(a.x as double) * m.m) / (sqrt(sum(cast(a.x as double) * a.x)) * sqrt(sum(m.m * m.m))) as cs
      from dims{tag} a join means{tag} m on a.video_id = m.video_id and a.rn = m.rn and a.d = m.d
      group by 1, 2
    ), shift{tag} as (
      select k.video_id, k.livestream_position, k.duration_text_coverage_pct,
             case when k.rn <= {n} then 0.0
                  when k.e is not null and c.n >= {need} then 1 - c.cs end as semantic_shift_{n}m
      from numbered{tag} k left join cosines{tag} c on k.video_id = c.video_id and k.rn = c.rn
    )"""

SHIFT5 = SHIFT.format(tag="5", n=5, need=3)
SHIFT1 = SHIFT.format(tag="1", n=1, need=1)

BANDS = """
    stats as (select avg(semantic_shift_5m) as a, stddev_samp(semantic_shift_5m) as s
              from {src} where semantic_shift_5m <> 0)"""

BAND_CASE = """
    case when semantic_shift_5m < a - 2*s then 'Very Low Change'
         when semantic_shift_5m >= a - 2*s and semantic_shift_5m < a - s then 'Low Change'
         when semantic_shift_5m >= a - s and semantic_shift_5m <= a + s then 'Moderate Change'
         when semantic_shift_5m > a + s and semantic_shift_5m <= a + 2*s then 'High Change'
         when semantic_shift_5m > a + 2*s then 'Very High Change' else 'NULL' end as semantic_shift_5m_seg"""


def shifted(i: Input, n=5) -> DataFrame:
    return semantic.semantic_shift(i.v("embedded_minutes"), n)


@query(
    "m8_semantic_shift",
    "with " + SHIFT5 + """
    select video_id, livestream_position, round(duration_text_coverage_pct, 6) as duration_text_coverage_pct,
           round(semantic_shift_5m, 6) as semantic_shift_5m from shift5""",
    "embedded_minutes",
)
def m8(i):
    return rounded(shifted(i), 6, "duration_text_coverage_pct", "semantic_shift_5m")


@query(
    "m10_shift_bands",
    "with " + SHIFT5 + "," + BANDS.format(src="shift5") + f"""
    select video_id, livestream_position, {BAND_CASE} from shift5, stats""",
    "embedded_minutes",
)
def m10(i):
    return semantic.shift_bands(shifted(i)).select("video_id", "livestream_position", "semantic_shift_5m_seg")


# The report needs viewers and vectors of the same minutes.
REPORT = SHIFT.replace("from embedded_minutes", "from report_minutes")


@query(
    "m37_minute_content_report",
    "with " + CURRENT + """,
    report_minutes as (
      select cur.*, t.duration_text_coverage_pct, t.embedding from cur
      left join embedded_minutes t on cur.video_id = t.video_id and cur.livestream_position = t.livestream_position
    ),""" + REPORT.format(tag="5", n=5, need=3) + "," + REPORT.format(tag="1", n=1, need=1) + """,
    joined as (
      select r.video_id, r.livestream_position, r.peak_concurrent_viewers, r.average_concurrent_viewers,
             round(r.duration_text_coverage_pct, 6) as duration_text_coverage_pct,
             round(a.semantic_shift_5m, 6) as semantic_shift_5m, round(b.semantic_shift_1m, 6) as semantic_shift_1m,
             r.average_concurrent_viewers - lag(r.average_concurrent_viewers)
               over (partition by r.video_id order by r.livestream_position) as viewer_shift
      from report_minutes r
      join shift5 a on a.video_id = r.video_id and a.livestream_position = r.livestream_position
      join shift1 b on b.video_id = r.video_id and b.livestream_position = r.livestream_position
    ),""" + BANDS.format(src="joined") + f"""
    select joined.*, case when viewer_shift >= 2 then 'Gain' when viewer_shift >= -1 and viewer_shift <= 1 then 'Retain'
                   when viewer_shift < -1 then 'Dip' else 'NULL' end as viewer_shift_segment, {BAND_CASE}
    from joined, stats""",
    "minute_viewers",
    "embedded_minutes",
)
def m37(i):
    coverage = i.v("embedded_minutes").withColumnRenamed("livestream_position", "minute_boundaries_lb")
    report = semantic.minute_content_report(current(i), coverage)
    return rounded(report, 6, "duration_text_coverage_pct", "semantic_shift_5m", "semantic_shift_1m")


@query("g1_embed_text")
def g1(i):
    docs = i.t("documents").select("doc_id", "text")
    return semantic.embed_text(docs).select("doc_id", "embedding")


@query("g1_word_vectors")
def g1_trained(i):
    """Every turn by vectors of words that are trained on all turns."""
    turns = i.t("conversations").select("conv_id", "turn", "text")
    vectors = materialize(wordvectors.word_vectors(turns), "word_vectors")
    return wordvectors.embed_by_words(turns, vectors).select("conv_id", "turn", "embedding")


@query(
    "g1_pair_counts",
    r"""with words as (select conv_id, turn, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from conversations),
    places as (select w, unnest(range(1, len(w) + 1)) as p from words),
    common as (select w[p] as word from places group by 1 having count(*) >= 5),
    near as (select w[p] as a, w[p + d] as b from places, (select unnest([1, 2, 3, 4]) as d) gaps where p + d <= len(w)),
    two_way as (select a, b from near union all select b, a from near)
    select a, b, cast(count(*) as bigint) as n from two_way where a in (select word from common) and b in (select word from common) group by a, b""",
)
def g1_pairs(i):
    return wordvectors.pair_counts(i.t("conversations"))


# ------------------------------------------------------------------ KPI

NET = ", daily as (select *, subscribers_gained - subscribers_lost as net_subscribers from channel_daily)"


def daily(i: Input) -> DataFrame:
    return kpi.with_net_subscribers(i.v("channel_daily"))


WEEKS = """
    weeks as (
      select cast(date_trunc('week', metric_date) as date) as week_commencing_dt, platform,
             sum(estimated_watch_minutes) as w, sum(views_count) as v, sum(subscribers_gained - subscribers_lost) as s
      from channel_daily group by 1, 2
    ), ranked as (
      select *, row_number() over (partition by platform order by week_commencing_dt desc) as rn from weeks
    ), points as (
      select week_commencing_dt, platform, case when rn = 2 then 'COMPARISON - ACTUAL' else 'ACTUAL' end as point_type,
             cast(w as double) as w, cast(v as double) as v, cast(s as double) as s
      from ranked where rn between 2 and 14
    ), lines as (
      select platform, max(week_commencing_dt) + 7 as week_commencing_dt,
             regr_slope(w, d) as aw, regr_intercept(w, d) as bw, regr_slope(v, d) as av, regr_intercept(v, d) as bv,
             regr_slope(s, d) as as_, regr_intercept(s, d) as bs
      from (select *, week_commencing_dt - date '1970-01-01' as d from points where point_type = 'ACTUAL') t
      group by platform
    ), compared as (
      select * from points union all
      select cast(week_commencing_dt as date), platform, 'COMPARISON - PREDICTED',
             round_even(round(aw * (cast(week_commencing_dt as date) - date '1970-01-01') + bw, 6), 0),
             round_even(round(av * (cast(week_commencing_dt as date) - date '1970-01-01') + bv, 6), 0),
             round_even(round(as_ * (cast(week_commencing_dt as date) - date '1970-01-01') + bs, 6), 0)
      from lines
    )"""


@query(
    "m20_weekly_deviation",
    "with " + WEEKS + """
    select week_commencing_dt, platform, point_type, w as estimated_watch_minutes, v as views_count,
           round(w / nullif(v, 0), 6) as derived_metric from compared""",
    "channel_daily",
)
def m20(i):
    rows = kpi.weekly_deviation(daily(i), ["estimated_watch_minutes", "views_count"])
    return rounded(rows, 6, "derived_metric")


# The cards' metrics by week, one row per card.
CARD_ROWS = " union all ".join(
    f"select week, platform, '{card}' as card, cast({metrics[0]} as double) as top, "
    f"{f'cast({metrics[1]} as double)' if len(metrics) == 2 else 'cast(null as double)'} as bottom, {len(metrics) == 2} as is_ratio from sums"
    for card, metrics in kpi.CARDS.items()
)
CARD_SUMS = ", ".join(
    f"sum({'subscribers_gained - subscribers_lost' if m == 'net_subscribers' else m}) as {m}" for m in sorted({m for ms in kpi.CARDS.values() for m in ms})
)


@query(
    "m21_kpi_summary",
    f"""with sums as (
      select cast(date_trunc('week', metric_date) as date) as week, platform, {CARD_SUMS} from channel_daily group by 1, 2
    ), long as ({CARD_ROWS}
    ), ranked as (
      select *, row_number() over (partition by platform, card order by week desc) as rn, week - date '1970-01-01' as d from long
    ), totals as (
      select platform, card, case when is_ratio then format('{{:,.2f}}', sum(top) / sum(bottom)) else format('{{:,}}', cast(sum(top) as bigint)) end as total
      from long group by platform, card, is_ratio
    ), lines as (
      select platform, card, is_ratio, max(week) + 7 as week, cast(max(week) + 7 as date) - date '1970-01-01' as d,
             regr_slope(top, d) as a1, regr_intercept(top, d) as b1, regr_slope(bottom, d) as a2, regr_intercept(bottom, d) as b2
      from ranked where rn between 3 and 14 group by platform, card, is_ratio
    ), predicted as (
      select *, round_even(round(a1 * d + b1, 6), 0) as top, round_even(round(a2 * d + b2, 6), 0) as bottom from lines
    ), texts as (
      select a.platform, a.card, greatest(a.week, cast(p.week as date)) as week,
             case when a.is_ratio then a.top / a.bottom else a.top end as actual,
             case when p.is_ratio then p.top / p.bottom else p.top end as predicted
      from ranked a join predicted p on a.platform = p.platform and a.card = p.card where a.rn = 2
    )
    select t.platform, t.card, t.total,
           concat('WC ', strftime(week, '%d %b %Y'), ': ',
                  cast(cast(round_even(round(coalesce(actual / nullif(predicted, 0) - 1, 0) * 100, 6), 0) as bigint) as varchar), '% vs forecast') as deviation
    from totals t join texts x on t.platform = x.platform and t.card = x.card""",
    "channel_daily",
)
def m21(i):
    return kpi.kpi_cards(daily(i))


@query(
    "m22_monthly_trend",
    """with months as (
      select cast(date_trunc('month', metric_date) as date) as month_start_dt, platform,
             cast(sum(estimated_watch_minutes) as bigint) as estimated_watch_minutes,
             cast(sum(views_count) as bigint) as views_count
      from channel_daily group by 1, 2
    ), ranked as (
      select *, row_number() over (partition by platform order by month_start_dt desc) as rn,
             estimated_watch_minutes / cast(nullif(views_count, 0) as double) as r from months
    ), kept as (select *, max(rn) over (partition by platform) as oldest from ranked where rn between 2 and 13)
    select month_start_dt, platform, estimated_watch_minutes, views_count, round(r, 6) as derived_metric,
           case when rn = 2 or rn = oldest then round_even(round(r, 6), 0) end as end_label from kept""",
    "channel_daily",
)
def m22(i):
    rows = kpi.monthly_trend(daily(i), ["estimated_watch_minutes", "views_count"])
    return rounded(rows, 6, "derived_metric")


# ------------------------------------------------------------- forecast

FORECAST = """
    weeks as (
      select cast(date_trunc('week', metric_date) as date) as ds, platform,
             cast(sum(subscribers_gained - subscribers_lost) as double) as y
      from channel_daily group by 1, 2
    ), ends as (select platform, max(ds) as newest from weeks group by platform),
    future as (
      select cast(s as date) as ds, platform, cast(null as double) as y from (
        select platform, unnest(generate_series(newest + 13, timestamp '2002-06-30', interval 7 day)) as s from ends) t
    ), frame as (select * from weeks union all select * from future),
    fitted as (
      select f.ds, f.platform, f.y, a * (f.ds - date '1970-01-01') + b as yhat
      from frame f join (select platform, regr_slope(y, ds - date '1970-01-01') as a,
                                regr_intercept(y, ds - date '1970-01-01') as b from weeks group by platform) l
        on f.platform = l.platform
    ), totals as (
      select *, case when y is not null then sum(y) over w end as actual_running_sub,
             sum(yhat) over w as predicted_running_sub
      from fitted window w as (partition by platform order by ds)
    )"""


def long_forecast(i: Input) -> DataFrame:
    return forecast.long_forecast(i.v("channel_daily"), UNTIL, forecast.line_fit())


@query(
    "m23_long_forecast",
    "with " + FORECAST + """
    select ds, platform, y, round(yhat, 4) as yhat, actual_running_sub,
           round(predicted_running_sub, 3) as predicted_running_sub from totals""",
    "channel_daily",
)
def m23(i):
    return rounded(rounded(long_forecast(i), 4, "yhat"), 3, "predicted_running_sub")


@query(
    "m24_goal_deviation",
    "with " + FORECAST + """
    select platform, string_agg(concat(cast(cast(trunc((predicted_running_sub / goal - 1) * 100) as bigint) as varchar),
                                       '%'), ' ' order by ds) as deviation
    from totals join (values (date '2002-01-27', 150000.0), (date '2002-06-30', 200000.0)) g(d, goal) on d = ds
    group by platform""",
    "channel_daily",
)
def m24(i):
    return forecast.goal_deviation(long_forecast(i), {"2002-01-27": 150000, "2002-06-30": 200000})


@query(
    "m25_forecast_chart_frame",
    "with " + FORECAST + """,
    shown as (
      select *, row_number() over (partition by platform order by ds desc) as back
      from totals where ds >= date '2001-01-01'
    )
    select platform, ds, actual_running_sub,
           round(case when actual_running_sub is null then predicted_running_sub end, 3) as predicted_line,
           min(ds) over p as first_ds, min(actual_running_sub) over p as first_total, max(ds) over p as last_ds,
           max(case when back = 7 then ds end) over p as label_ds,
           round(max(predicted_running_sub) over p, 3) as last_total,
           min(case when actual_running_sub is null then ds end) over p as forecast_ds
    from shown window p as (partition by platform)""",
    "channel_daily",
)
def m25(i):
    return rounded(forecast.forecast_chart(long_forecast(i), "2001-01-01"), 3, "predicted_line", "last_total")


@query("g2_series_forecast")
def g2(i):
    return forecast.long_forecast(i.v("channel_daily"), UNTIL)


@query("g2_trend_changes")
def g2_changes(i):
    """How often each platform's slope changes, by how much in all, and the noise around its trend."""
    weekly = kpi.week_rollup(daily(i), ["net_subscribers"])
    models = trend.fit_trends(weekly.select(F.col("week_commencing_dt").alias("ds"), "platform", F.col("net_subscribers").alias("y")))
    bends = trend.trend_changes(models).groupBy("platform").agg(F.count("*").alias("n_changes"), F.sum(F.abs("change")).alias("all_changes"))
    noise = models.select("platform", "rows", (F.col("sigma") * F.col("scale")).alias("noise"))
    return noise.join(bends, "platform", "left").fillna(0, ["n_changes", "all_changes"])


# ----------------------------------------------------------- engagement

ENGAGED = """
    engaged as (
      select *, round_even(video_estimated_minutes_watched / cast(nullif(video_views, 0) as double), 1) as avg_view_duration_mins,
             video_estimated_minutes_watched * 60
               / cast(nullif(video_views * video_duration_sec, 0) as double) * 100 as avg_pct_video_watched,
             round_even((video_likes + video_comments) / cast(nullif(video_views, 0) as double) * 100, 1) as engagement_metric
      from dim_video where video_type in ('Livestream', 'Luton Livestream')
    )"""


@query(
    "m26_video_engagement",
    "with " + ENGAGED + """
    select * replace (round(avg_pct_video_watched, 6) as avg_pct_video_watched) from engaged""",
    "dim_video",
)
def m26(i):
    return rounded(engagement.video_engagement(i.v("dim_video")), 6, "avg_pct_video_watched")


@query(
    "m27_engagement_quadrants",
    "with " + ENGAGED + """,
    cuts as (select round_even(max(avg_view_duration_mins) / 2, 0) as d, round_even(max(engagement_metric) / 2, 0) as e
             from engaged)
    select video_id, avg_view_duration_mins, engagement_metric,
           case when avg_view_duration_mins >= d and engagement_metric >= e then 'Top Performers'
                when avg_view_duration_mins < d and engagement_metric > e then 'High Interaction'
                when avg_view_duration_mins < d and engagement_metric < e then 'Low Performers'
                when avg_view_duration_mins >= d and engagement_metric < e then 'Strong Retention'
                else 'NULL' end as quadrant
    from engaged, cuts""",
    "dim_video",
)
def m27(i):
    rows = engagement.engagement_quadrants(engagement.video_engagement(i.v("dim_video")))
    return rows.select("video_id", "avg_view_duration_mins", "engagement_metric", "quadrant")


# --------------------------------------------------------------- curves

RESAMPLED = """
    placed as (
      select *, max(livestream_position / 60.0) over (partition by video_id) as longest from minute_viewers
    ), resampled as (
      select video_id, cast(floor(cast(livestream_position / 60.0 as double) / cast(longest as double) * 100) as bigint) as pct,
             avg(average_concurrent_viewers) as average_concurrent_viewers,
             max(peak_concurrent_viewers) as peak_concurrent_viewers
      from placed where longest > 0 group by 1, 2
    )"""

FILLED = RESAMPLED + """,
    grid as (
      select v.video_id, g.pct, g.place, r.average_concurrent_viewers as v
      from (select distinct video_id from resampled) v
      cross join (select pct, row_number() over (order by pct) as place from (select distinct pct from resampled) d) g
      left join resampled r on r.video_id = v.video_id and r.pct = g.pct
    ), sides as (
      select *, last_value(v ignore nulls) over b as v0, last_value(case when v is not null then place end ignore nulls) over b as i0,
             first_value(v ignore nulls) over a as v1, first_value(case when v is not null then place end ignore nulls) over a as i1
      from grid
      window b as (partition by video_id order by place rows between unbounded preceding and current row),
             a as (partition by video_id order by place rows between current row and unbounded following)
    ), filled as (
      select video_id, pct, coalesce(v, v0 + (v1 - v0) / nullif(i1 - i0, 0) * (place - i0), v0) as average_concurrent_viewers
      from sides
    )"""

NORMED = FILLED + """,
    stats as (
      select video_id, avg(average_concurrent_viewers) as m, min(average_concurrent_viewers) as lo,
             max(average_concurrent_viewers) as hi from filled group by video_id
    ), normed as (
      select f.video_id, f.pct, f.average_concurrent_viewers, d.video_title, s.m as avg_viewers,
             case when f.average_concurrent_viewers is null then null when hi = lo then 0.0
                  else (f.average_concurrent_viewers - lo) / (hi - lo) end as norm
      from filled f join stats s on f.video_id = s.video_id
      join dim_video d on d.video_id = f.video_id and d.video_type = 'Livestream'
      where s.m > 1.2
    )"""


def resampled(i: Input) -> DataFrame:
    return curves.percent_resample(i.v("minute_viewers"))


def filled(i: Input) -> DataFrame:
    return curves.fill_curves(resampled(i))


def normed(i: Input) -> DataFrame:
    return curves.normalise_curves(filled(i), i.v("dim_video"), min_avg=1.2)


@query(
    "m28_percent_resample",
    "with " + RESAMPLED + """
    select video_id, pct, round(average_concurrent_viewers, 6) as average_concurrent_viewers, peak_concurrent_viewers
    from resampled""",
    "minute_viewers",
)
def m28(i):
    return rounded(resampled(i), 6, "average_concurrent_viewers")


@query(
    "m29_curve_matrix",
    "with " + RESAMPLED + " select video_id, " + ", ".join(
        f"round(max(case when pct = {p} then average_concurrent_viewers end), 6) as pct_{p}" for p in curves.PERCENTS
    ) + " from resampled group by video_id",
    "minute_viewers",
)
def m29(i):
    return rounded(curves.curve_matrix(resampled(i)), 6, *[f"pct_{p}" for p in curves.PERCENTS])


@query(
    "m30_curve_filled",
    "with " + FILLED + """
    select video_id, pct, round(average_concurrent_viewers, 6) as average_concurrent_viewers from filled""",
    "minute_viewers",
)
def m30(i):
    return rounded(filled(i), 6, "average_concurrent_viewers")


@query(
    "m31_curve_normalised",
    "with " + NORMED + """
    select video_id, pct, video_title, round(average_concurrent_viewers, 6) as average_concurrent_viewers,
           round(avg_viewers, 6) as avg_viewers, round(norm, 6) as norm from normed""",
    "minute_viewers",
    "dim_video",
)
def m31(i):
    return rounded(normed(i), 6, "average_concurrent_viewers", "avg_viewers", "norm")


@query("m32_curve_clusters")
def m32(i):
    return curves.cluster_curves(normed(i))


def by_id(i: Input) -> DataFrame:
    """A stand-in for fitted clusters that SQL can repeat."""
    return i.v("dim_video").select("video_id", (F.col("video_id") % 4).cast("string").alias("cluster"))


@query(
    "m33_cluster_median_curve",
    "with " + NORMED + """
    select cast(video_id % 4 as varchar) as cluster, pct, round(median(average_concurrent_viewers), 6) as average_viewers
    from normed where average_concurrent_viewers is not null group by 1, 2""",
    "minute_viewers",
    "dim_video",
)
def m33(i):
    return rounded(curves.cluster_medians(normed(i), by_id(i)), 6, "average_viewers")


@query(
    "m34_cluster_members",
    "with " + NORMED + """
    select video_id, pct, video_title, round(average_concurrent_viewers, 6) as average_concurrent_viewers
    from normed where video_id % 4 = 3""",
    "minute_viewers",
    "dim_video",
)
def m34(i):
    members = curves.cluster_members(normed(i), by_id(i), "3")
    return rounded(members, 6, "average_concurrent_viewers").drop("avg_viewers", "norm")
