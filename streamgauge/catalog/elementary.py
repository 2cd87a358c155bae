"""Elementary keys: sources, projections, joins, aggregates, windows, sorts, sets, functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.catalog import products as P
from streamgauge.catalog.registry import Input, query
from streamgauge.functions import numbers, text, times, vectors
from streamgauge.functions.hashing import version_hash
from streamgauge.operators.joins import keep_unseen, spread_join
from streamgauge.operators.latest import latest_per, latest_per_day, newest_n
from streamgauge.operators.medians import exact_median
from streamgauge.operators.ranges import running_sums
from streamgauge.operators.series import attach_group, change, fill_linear, next_value, run_length
from streamgauge.operators.trailing import trailing_vectors
from streamgauge.plans import curves, engagement, forecast, kpi, retention, semantic, transcript, vault
from streamgauge.schemas import VIDEO_DATA
from streamgauge.session import scratch_path
from streamgauge.sources import landing, lookups, tables, transcripts

rounded = P.rounded


def landed(i: Input, docs: DataFrame, name: str) -> str:
    """Write documents as JSON lines, the way responses land."""
    path = scratch_path(i.spark, name)
    docs.write.json(path)
    return path


# -------------------------------------------------------------- sources


@query("s1_stage_scan", "select * from orders")
def s1(i):
    return i.t("orders")


S2 = """select event_type, count(*) as n, count(distinct user_id) as users, round(sum(value), 4) as total
        from {events} group by event_type"""


@query("s2_sql_query", S2.format(events="events"))
def s2(i):
    return tables.run_query(i.spark, S2, events=i.t("events"))


@query("s3_select_star", "select * from events")
def s3(i):
    return tables.run_query(i.spark, "select * from {events}", events=i.t("events"))


@query("s4_api_items", "select cast(o_orderkey as varchar) as video_id, o_orderpriority as title from orders")
def s4(i):
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.struct(F.col("o_orderpriority").alias("title")).alias("snippet")
    )
    responses = i.t("orders").groupBy(F.floor(F.col("o_orderkey") / 50)).agg(F.collect_list(item).alias("items"))
    items = landing.read_items(i.spark, landed(i, responses.select("items"), "items"))
    return items.select("video_id", F.get_json_object("video_data", "$.snippet.title").alias("title"))


@query(
    "s5_api_report_rows",
    """select cast(video_id as varchar) as video_id, cast(livestream_position as varchar) as livestream_position,
              average_concurrent_viewers, peak_concurrent_viewers from (
         select *, row_number() over (partition by video_id, livestream_position order by load_ts desc, tie desc) as rn
         from minute_viewers) t where rn = 1""",
    "minute_viewers",
)
def s5(i):
    reports = landing.read_reports(i.spark, landed(i, P.minute_reports(i), "reports"), ["video_id"])
    records = landing.report_records(reports, "livestreamPosition", ["video_id"])
    return records.select(
        "video_id",
        F.col("livestreamPosition").alias("livestream_position"),
        F.col("record")["averageConcurrentViewers"].cast("double").alias("average_concurrent_viewers"),
        F.col("record")["peakConcurrentViewers"].cast("double").alias("peak_concurrent_viewers"),
    )


@query(
    "s6_api_scalar_row",
    """select cast(video_id as varchar) as video_id, cast(sum(like_count) as double) as "estimatedMinutesWatched"
       from stage_video group by video_id having max(record_source) = 'src3'""",
    "stage_video",
)
def s6(i):
    return landing.first_row_values(landing.read_reports(i.spark, landed(i, P.watch_reports(i), "watched")))


@query("s7_api_pages_flatten", "select cast(c_custkey as varchar) as video_id from customer")
def s7(i):
    item = F.struct(F.struct(F.col("c_custkey").cast("string").alias("videoId")).alias("contentDetails"))
    pages = i.t("customer").groupBy(F.floor(F.col("c_custkey") / 50)).agg(F.collect_list(item).alias("items"))
    return landing.read_pages(i.spark, landed(i, pages.select("items"), "pages"))


@query(
    "s8_transcript_source",
    "select video_id, start_time, end_time, concat(' ', text) as text from file_segments",
    "file_segments",
)
def s8(i):
    return P.read_back(i)


@query("s9_dir_listing_ids", "select distinct cast(conv_id as varchar) as video_id from conversations")
def s9(i):
    return transcripts.listed_ids(i.spark, P.transcript_folder(i))


@query(
    "s10_seed_csv",
    "select distinct trim(original_name) as original_name, trim(canonical_name) as canonical_name from speaker_variants",
    "speaker_variants",
)
def s10(i):
    return speaker_names(i)


def speaker_names(i: Input) -> DataFrame:
    path = scratch_path(i.spark, "speaker_names")
    i.v("speaker_variants").write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return lookups.read_speaker_names(i.spark, path)


@query(
    "s11_transcript_sink",
    """select cast(video_id as varchar) as video_id,
              printf('[%.2f -> %.2f] %s', start_time, end_time, text) as line from file_segments""",
    "file_segments",
)
def s11(i):
    folder = scratch_path(i.spark, "transcript_files")
    transcripts.write_files(i.v("file_segments"), folder)
    lines = i.spark.read.option("pathGlobFilter", "*.txt").text(folder)
    return lines.select(text.file_stem(F.col("_metadata.file_path")).alias("video_id"), F.col("value").alias("line"))


@query(
    "s12_stage_sink",
    "select cast(video_id as varchar) as video_id, start_time, end_time, text from segments",
    "segments",
)
def s12(i):
    root, s = scratch_path(i.spark, "warehouse"), i.v("segments")
    table = "sc_yt_video_transcript"
    tables.load_stage(s, root, table, "append")
    tables.load_stage(s.filter("start_time < 100"), root, table, "truncate")
    tables.load_stage(s.filter("start_time >= 100"), root, table, "append")
    return tables.read_stage(i.spark, root, table)


@query(
    "s13_empty_result",
    "select cast(o_orderkey as varchar) as video_id, cast(o_orderdate as date) as video_publish_dt from orders where false",
)
def s13(i):
    items = P.video_stage(i).select(F.col("video_id").cast("string").alias("video_id"), "video_data")
    return landing.recent_videos(items, "1970-01-01", 7)


@query(
    "s14_projection_csv",
    "with " + P.FORECAST + """
    select cast(row_number() over (partition by platform order by ds) - 1 as int) as _index, platform, ds, y, round(yhat, 4) as yhat, actual_running_sub,
           round(predicted_running_sub, 3) as predicted_running_sub
    from totals""",
    "channel_daily",
)
def s14(i):
    path = scratch_path(i.spark, "projections")
    rows = P.m23(i)
    index = F.row_number().over(Window.partitionBy("platform").orderBy("ds")) - 1  # calendar weeks of a platform
    rows.select(index.alias("_index"), *rows.columns).write.partitionBy("platform").option("header", True).csv(path)
    return lookups.read_forecast(i.spark, path)


@query("s16_max_watermark_read", "select max(cast(ts as date)) as max_date from events")
def s16(i):
    root, days = scratch_path(i.spark, "days"), i.t("events").select(F.to_date("ts").alias("date"), F.col("props").alias("date_metrics"))
    tables.load_stage(days, root, "sc_yt_day_data", "truncate")
    return tables.newest_loaded(i.spark, root, "sc_yt_day_data")


# ------------------------------------------- projections and predicates


@query("p1_project", "select o_orderkey, o_custkey, o_totalprice from orders")
def p1(i):
    return i.t("orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("p2_rename", "select o_orderdate as ds, o_totalprice as y from orders")
def p2(i):
    return i.t("orders").select("o_orderdate", "o_totalprice").withColumnsRenamed({"o_orderdate": "ds", "o_totalprice": "y"})


@query(
    "p3_not_null",
    "select video_id, tie, comment_count from stage_video where comment_count is not null",
    "stage_video",
)
def p3(i):
    return i.v("stage_video").filter(F.col("comment_count").isNotNull()).select("video_id", "tie", "comment_count")


@query(
    "p4_in_list",
    "select video_id, video_type from dim_video where video_type in ('Livestream', 'Luton Livestream')",
    "dim_video",
)
def p4(i):
    return i.v("dim_video").filter(F.col("video_type").isin(*engagement.LIVE_TYPES)).select("video_id", "video_type")


@query("p5_in_loop_ids", "select * from minute_viewers where video_id in (1, 2, 3, 5, 8)", "minute_viewers")
def p5(i):
    return i.v("minute_viewers").filter(F.col("video_id").isin(1, 2, 3, 5, 8))


@query(
    "p6_compare",
    "select video_id, tie, duration_sec from stage_video where duration_sec < 5400 and record_source = 'src1'",
    "stage_video",
)
def p6(i):
    rows = i.v("stage_video").filter((F.col("duration_sec") < 5400) & (F.col("record_source") == "src1"))
    return rows.select("video_id", "tie", "duration_sec")


@query(
    "p7_between",
    "select o_orderkey, o_orderdate from orders where o_orderdate between timestamp '1997-12-25' and timestamp '1998-01-01'",
)
def p7(i):
    today = F.lit("1998-01-01").cast("date")
    rows = i.t("orders").filter(F.col("o_orderdate").cast("date").between(F.date_sub(today, 7), today))
    return rows.select("o_orderkey", "o_orderdate")


@query("p8_null_predicate", "select video_id, tie from stage_video where comment_count is null", "stage_video")
def p8(i):
    return i.v("stage_video").filter(F.col("comment_count").isNull()).select("video_id", "tie")


ROUTED = """
    routed as (
      select *, floor(start_time/60) <> floor(end_time/60) as spans from segments
    )"""


@query(
    "p9_flag_route",
    "with " + ROUTED + """
    select video_id, start_time, cast(floor(end_time/60)*60 as double) as end_time from routed where spans
    union all select video_id, cast(floor(end_time/60)*60 as double), end_time from routed where spans
    union all select video_id, start_time, end_time from routed where not spans""",
    "segments",
)
def p9(i):
    return transcript.split_at_buckets(i.v("segments").drop("text"))


@query(
    "p10_ilike_prefix",
    "select video_id, tie, title_raw from stage_video where title_raw ilike 'session%' or title_raw ilike '[luton%'",
    "stage_video",
)
def p10(i):
    title = F.col("title_raw")
    rows = i.v("stage_video").filter(text.starts_with_ci(title, "session") | text.starts_with_ci(title, "[luton"))
    return rows.select("video_id", "tie", "title_raw")


@query(
    "p11_case_classify",
    """select event_id, case when value >= 400 then 'Gain' when value between 100 and 300 then 'Retain'
                             when value < 100 then 'Dip' else 'NULL' end as label from events""",
)
def p11(i):
    v = F.col("value")
    label = F.when(v >= 400, "Gain").when(v.between(100, 300), "Retain").when(v < 100, "Dip").otherwise("NULL")
    return i.t("events").select("event_id", label.alias("label"))


@query(
    "p12_value_replace",
    "select event_id, case when event_type = 'error' then 'NULL' else event_type end as event_type from events",
)
def p12(i):
    return i.t("events").select("event_id", "event_type").replace("error", "NULL", "event_type")


@query(
    "p13_label_map",
    """select vec_id, case label when 0 then 'Mid-Peak Drop' when 1 then 'Mid-Peak Stable' when 2 then 'Irregular'
                                 when 3 then 'Early-Rise Stable' end as cluster from embeddings""",
)
def p13(i):
    names = F.create_map(*[x for n, name in enumerate(curves.CLUSTER_NAMES) for x in (F.lit(n), F.lit(name))])
    return i.t("embeddings").select("vec_id", F.try_element_at(names, F.col("label")).alias("cluster"))


@query(
    "p15_arith_column",
    """select metric_date, platform, subscribers_gained, subscribers_lost,
              subscribers_gained - subscribers_lost as net_subscribers from channel_daily""",
    "channel_daily",
)
def p15(i):
    return P.daily(i).select("metric_date", "platform", "subscribers_gained", "subscribers_lost", "net_subscribers")


@query(
    "p14_nonzero_filter",
    "with " + P.SHIFT5 + """
    select video_id, livestream_position, round(semantic_shift_5m, 6) as semantic_shift_5m
    from shift5 where semantic_shift_5m <> 0""",
    "embedded_minutes",
)
def p14(i):
    rows = P.shifted(i).filter(F.col("semantic_shift_5m") != 0)
    return rounded(rows.select("video_id", "livestream_position", "semantic_shift_5m"), 6, "semantic_shift_5m")


# ---------------------------------------------------------------- joins


@query(
    "j1_left_combine",
    """with v as (select distinct video_id from stage_video),
       m as (select video_id, count(*) as n_minutes from minute_viewers group by video_id),
       w as (select video_id, sum(like_count) as watched from stage_video where record_source = 'src1' group by video_id)
       select v.video_id, m.n_minutes, cast(w.watched as bigint) as watched
       from v left join m on v.video_id = m.video_id left join w on v.video_id = w.video_id""",
    "stage_video",
    "minute_viewers",
)
def j1(i):
    v = i.v("stage_video").select("video_id").distinct()
    m = i.v("minute_viewers").groupBy("video_id").agg(F.count("*").alias("n_minutes"))
    w = i.v("stage_video").filter("record_source = 'src1'").groupBy("video_id").agg(F.sum("like_count").alias("watched"))
    return v.join(m, "video_id", "left").join(w, "video_id", "left")


@query(
    "j2_left_then_filter",
    """select m.video_id, m.tie from minute_viewers m
       left join (select video_id, max(duration_sec) as d from stage_video group by video_id) s on m.video_id = s.video_id
       where s.d < 5400""",
    "minute_viewers",
    "stage_video",
)
def j2(i):
    m = i.v("minute_viewers").select("video_id", "tie")
    short = i.v("stage_video").groupBy("video_id").agg(F.max("duration_sec").alias("d")).filter("d < 5400")
    return spread_join(m, short.select("video_id"), ["video_id"], "inner", ["tie"])


@query(
    "j3_left_dim",
    """select m.video_id, m.tie, d.video_title, d.video_type from minute_viewers m
       left join dim_video d on m.video_id = d.video_id""",
    "minute_viewers",
    "dim_video",
)
def j3(i):
    dim = i.v("dim_video").select("video_id", "video_title", "video_type")
    return spread_join(i.v("minute_viewers").select("video_id", "tie"), dim, ["video_id"], "left", ["tie"])


@query(
    "j4_left_series",
    "with " + P.FORECAST + """
    select f.ds, f.platform, w.y from frame f left join weeks w on f.ds = w.ds and f.platform = w.platform""",
    "channel_daily",
)
def j4(i):
    weekly = kpi.week_rollup(P.daily(i), ["net_subscribers"]).select(
        F.col("week_commencing_dt").alias("ds"), "platform", F.col("net_subscribers").cast("double").alias("y")
    )
    dates = weekly.select("ds", "platform").unionByName(forecast.future_weeks(weekly, P.UNTIL))
    return dates.join(weekly, ["ds", "platform"], "left")


@query(
    "j5_left_two_scores",
    "with " + P.SHIFT5 + "," + P.SHIFT1 + """
    select a.video_id, a.livestream_position, round(a.semantic_shift_5m, 6) as semantic_shift_5m,
           round(b.semantic_shift_1m, 6) as semantic_shift_1m
    from shift5 a left join shift1 b on a.video_id = b.video_id and a.livestream_position = b.livestream_position""",
    "embedded_minutes",
)
def j5(i):
    rows = P.shifted(i, [5, 1]).select("video_id", "livestream_position", "semantic_shift_5m", "semantic_shift_1m")
    return rounded(rows, 6, "semantic_shift_5m", "semantic_shift_1m")


@query(
    "j6_minute_text",
    "with " + P.CURRENT + "," + P.PIECES.format(src="segments") + """
    select cur.*, b.duration_secs_valid, b.text from cur
    left join buckets b on b.video_id = cur.video_id and b.minute_boundaries_lb = cur.livestream_position""",
    "minute_viewers",
    "segments",
)
def j6(i):
    rows = semantic.minute_text(P.current(i), transcript.transcript_minutes(i.v("segments")))
    return rounded(rows, 6, "duration_secs_valid")


OLD_STAGE = "select distinct video_id from stage_video where load_ts < timestamp '1998-01-01'"


@query(
    "j7_not_exists_key",
    f"""select video_id, tie from stage_video s
        where not exists (select 1 from ({OLD_STAGE}) t where t.video_id = s.video_id)""",
    "stage_video",
)
def j7(i):
    stage = i.v("stage_video").select("video_id", "tie", "load_ts")
    return keep_unseen(stage, stage.filter("load_ts < '1998-01-01'"), ["video_id"], ["tie"]).drop("load_ts")


HASHED = """
    hashed as (select video_id, tie, load_ts, md5(concat_ws('|', title_raw, cast(like_count as varchar))) as hashdiff
               from stage_video)"""


def hashed_stage(i: Input) -> DataFrame:
    stage = i.v("stage_video")
    return stage.select("video_id", "tie", "load_ts", version_hash(stage, ["title_raw", "like_count"]).alias("hashdiff"))


@query(
    "j8_not_exists_version",
    "with " + HASHED + """
    select video_id, tie, hashdiff from hashed h where load_ts >= timestamp '1998-01-01' and not exists (
      select 1 from hashed t where t.load_ts < timestamp '1998-01-01'
        and t.video_id = h.video_id and t.hashdiff = h.hashdiff)""",
    "stage_video",
)
def j8(i):
    rows = hashed_stage(i)
    old, new = rows.filter("load_ts < '1998-01-01'"), rows.filter("load_ts >= '1998-01-01'")
    return keep_unseen(new, old, ["video_id", "hashdiff"], ["tie"]).select("video_id", "tie", "hashdiff")


@query(
    "j9_not_in",
    """select video_id, start_time from segments where video_id not in (
         select distinct video_id from segments where end_time > 200)""",
    "segments",
)
def j9(i):
    s = i.v("segments")
    return keep_unseen(s, s.filter("end_time > 200"), ["video_id"], ["start_time"]).select("video_id", "start_time")


@query(
    "j10_left_isna_anti",
    """select distinct cast(o.o_custkey as varchar) as video_id from orders o
       left join (select distinct conv_id from conversations) c on o.o_custkey = c.conv_id where c.conv_id is null""",
)
def j10(i):
    videos = i.t("orders").select(F.col("o_custkey").cast("string").alias("video_id"))
    return transcripts.missing_transcripts(videos, transcripts.listed_ids(i.spark, P.transcript_folder(i)))


@query(
    "j11_exclude_list",
    """select video_id, tie from minute_viewers where video_id not in (
         select video_id from minute_viewers group by video_id having max(peak_concurrent_viewers) >= 24)""",
    "minute_viewers",
)
def j11(i):
    m = i.v("minute_viewers").select("video_id", "tie", "peak_concurrent_viewers")
    bad = m.groupBy("video_id").agg(F.max("peak_concurrent_viewers").alias("hi")).filter("hi >= 24")
    return keep_unseen(m, bad, ["video_id"], ["tie"]).drop("peak_concurrent_viewers")


@query(
    "j12_lateral_json",
    """select distinct video_id, date_trunc('hour', load_ts) as hour, livestream_position from minute_viewers""",
    "minute_viewers",
)
def j12(i):
    rows = vault.unnest_minutes(P.minute_stage(i))
    return rows.select("video_id", F.date_trunc("hour", "load_ts").cast("timestamp_ntz").alias("hour"), "livestream_position")


@query(
    "j13_name_lookup",
    """select o.o_orderkey, coalesce(trim(s.canonical_name), o.o_orderpriority) as o_orderpriority
       from orders o left join speaker_variants s on o.o_orderpriority = s.original_name""",
    "speaker_variants",
)
def j13(i):
    return lookups.canonical_names(i.t("orders").select("o_orderkey", "o_orderpriority"), speaker_names(i), "o_orderpriority")


# ----------------------------------------------------------- aggregates


@query("a1_group_sum", "select o_custkey, round(sum(o_totalprice), 2) as total from orders group by o_custkey")
def a1(i):
    return rounded(i.t("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")), 2, "total")


@query(
    "a2_string_agg",
    "with " + P.PIECES.format(src="segments") + " select video_id, minute_boundaries_lb, text from buckets",
    "segments",
)
def a2(i):
    return transcript.transcript_minutes(i.v("segments")).select("video_id", "minute_boundaries_lb", "text")


@query("a3_global_max", "select max(o_orderdate) as max_date from orders")
def a3(i):
    return tables.max_date(i.t("orders"), "o_orderdate")


@query(
    "a4_week_rollup",
    """select cast(date_trunc('week', metric_date) as date) as week_commencing_dt, platform,
              cast(sum(views_count) as bigint) as views_count, cast(sum(likes_count) as bigint) as likes_count
       from channel_daily group by 1, 2""",
    "channel_daily",
)
def a4(i):
    return kpi.week_rollup(i.v("channel_daily"), ["views_count", "likes_count"])


@query(
    "a5_month_rollup",
    """select cast(date_trunc('month', metric_date) as date) as month_start_dt, platform,
              cast(sum(views_count) as bigint) as views_count from channel_daily group by 1, 2""",
    "channel_daily",
)
def a5(i):
    return kpi.month_rollup(i.v("channel_daily"), ["views_count"])


@query(
    "a6_multi_agg",
    """select video_id, max(livestream_position) as max_run, count(*) as total_rows,
              round(avg(average_concurrent_viewers), 6) as avg_viewers from minute_viewers group by video_id""",
    "minute_viewers",
)
def a6(i):
    rows = i.v("minute_viewers").groupBy("video_id").agg(
        F.max("livestream_position").alias("max_run"),
        F.count("*").alias("total_rows"),
        F.avg("average_concurrent_viewers").alias("avg_viewers"),
    )
    return rounded(rows, 6, "avg_viewers")


@query(
    "a7_mean_max",
    """select video_id, livestream_position, round(avg(average_concurrent_viewers), 6) as a,
              max(peak_concurrent_viewers) as p from minute_viewers group by 1, 2""",
    "minute_viewers",
)
def a7(i):
    rows = i.v("minute_viewers").groupBy("video_id", "livestream_position").agg(
        F.avg("average_concurrent_viewers").alias("a"), F.max("peak_concurrent_viewers").alias("p")
    )
    return rounded(rows, 6, "a")


@query("a8_distinct", "select distinct o_custkey, o_orderstatus from orders")
def a8(i):
    return i.t("orders").select("o_custkey", "o_orderstatus").distinct()


@query("a9_count_distinct", "select count(distinct user_id) as videos from events")
def a9(i):
    return i.t("events").agg(F.countDistinct("user_id").alias("videos"))


@query(
    "a10_share_per_group",
    """select video_id, average_concurrent_viewers,
              round(count(*) / cast(sum(count(*)) over (partition by video_id) as double), 6) as proportion
       from minute_viewers group by 1, 2""",
    "minute_viewers",
)
def a10(i):
    return rounded(retention.value_share(i.v("minute_viewers"), "video_id", "average_concurrent_viewers"), 6, "proportion")


@query("a11_median", "select median(o_totalprice) as median_price from orders")
def a11(i):
    return exact_median(i.t("orders"), [], "o_totalprice", "median_price", store=False)


@query(
    "a12_mean_std",
    "with " + P.SHIFT5 + """
    select round(avg(semantic_shift_5m), 6) as mean, round(stddev_samp(semantic_shift_5m), 6) as sd
    from shift5 where semantic_shift_5m <> 0""",
    "embedded_minutes",
)
def a12(i):
    scores = P.shifted(i).filter(F.col("semantic_shift_5m") != 0)
    stats = scores.agg(F.avg("semantic_shift_5m").alias("mean"), F.stddev_samp("semantic_shift_5m").alias("sd"))
    return rounded(stats, 6, "mean", "sd")


@query(
    "a13_total_and_ratio",
    """select cast(sum(estimated_watch_minutes) as bigint) as total,
              round(sum(estimated_watch_minutes) / cast(sum(views_count) as double), 6) as ratio from channel_daily""",
    "channel_daily",
)
def a13(i):
    return rounded(kpi.total_and_ratio(i.v("channel_daily"), "estimated_watch_minutes", "views_count"), 6, "ratio")


@query(
    "a14_linear_fit",
    "with " + P.WEEKS + """
    select platform, cast(week_commencing_dt as date) as week_commencing_dt, round(aw, 4) as slope_minutes,
           round(av, 4) as slope_views from lines""",
    "channel_daily",
)
def a14(i):
    metrics = ["estimated_watch_minutes", "views_count"]
    points = kpi.recent_weeks(kpi.week_rollup(P.daily(i), metrics), ["platform"])
    day = F.unix_date("week_commencing_dt")
    fit = points.filter(F.col("point_type") == kpi.ACTUAL).groupBy("platform").agg(
        F.date_add(F.max("week_commencing_dt"), 7).alias("week_commencing_dt"),
        F.regr_slope("estimated_watch_minutes", day).alias("slope_minutes"),
        F.regr_slope("views_count", day).alias("slope_views"),
    )
    return rounded(fit, 4, "slope_minutes", "slope_views")


@query(
    "a15_row_mean",
    "with " + P.FILLED + """
    select video_id, round(avg(average_concurrent_viewers), 6) as avg_viewers from filled group by video_id""",
    "minute_viewers",
)
def a15(i):
    rows = P.filled(i).groupBy("video_id").agg(F.avg("average_concurrent_viewers").alias("avg_viewers"))
    return rounded(rows, 6, "avg_viewers")


@query(
    "a16_median_per_position",
    """select livestream_position, median(peak_concurrent_viewers) as median_peak from minute_viewers group by 1""",
    "minute_viewers",
)
def a16(i):
    return exact_median(i.v("minute_viewers"), ["livestream_position"], "peak_concurrent_viewers", "median_peak", store=False)


@query(
    "a17_half_max_cutoff",
    "with " + P.ENGAGED + """
    select round_even(max(avg_view_duration_mins) / 2, 0) as v_line, round_even(max(engagement_metric) / 2, 0) as h_line
    from engaged""",
    "dim_video",
)
def a17(i):
    rows = engagement.video_engagement(i.v("dim_video"))
    return rows.agg(
        F.bround(F.max("avg_view_duration_mins") / 2, 0).alias("v_line"),
        F.bround(F.max("engagement_metric") / 2, 0).alias("h_line"),
    )


@query("a18_last_wins", "select user_id, arg_max(event_type, event_id) as event_type from events group by user_id")
def a18(i):
    return i.t("events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"))


# -------------------------------------------------------------- windows


@query(
    "w1_latest_per_day",
    """select date_key, load_ts, tie, likes from (
         select *, row_number() over (partition by date_key, cast(load_ts as date) order by load_ts desc, tie desc) as rn
         from stage_day) t where rn = 1""",
    "stage_day",
)
def w1(i):
    return latest_per_day(i.v("stage_day"), "date_key", "load_ts", ["tie"]).select("date_key", "load_ts", "tie", "likes")


@query(
    "w2_latest_per_hash",
    "with " + HASHED + """
    select video_id, hashdiff, load_ts, tie from (
      select *, row_number() over (partition by video_id, hashdiff order by load_ts desc, tie desc) as rn from hashed) t
    where rn = 1""",
    "stage_video",
)
def w2(i):
    return latest_per(hashed_stage(i), ["video_id", "hashdiff"], "load_ts", ["tie"])


@query("w3_latest_per_position", "with " + P.CURRENT + " select * from cur", "minute_viewers")
def w3(i):
    return P.current(i)


@query(
    "w4_diff",
    "with " + P.CURRENT + """
    select video_id, livestream_position, average_concurrent_viewers - lag(average_concurrent_viewers)
             over (partition by video_id order by livestream_position) as diff from cur""",
    "minute_viewers",
)
def w4(i):
    rows = change(P.current(i), ["video_id"], "livestream_position", "average_concurrent_viewers", "diff")
    return rows.select("video_id", "livestream_position", "diff")


@query(
    "w5_next_row",
    "select video_id, start_time, lead(start_time) over (partition by video_id order by start_time) as next_start from segments",
    "segments",
)
def w5(i):
    rows = i.v("segments").select("video_id", "start_time")
    return next_value(rows, ["video_id"], "start_time", "start_time", "next_start", span=3600 * 4)


@query(
    "w6_running_sum",
    "with " + P.FORECAST + " select ds, platform, y, actual_running_sub from totals",
    "channel_daily",
)
def w6(i):
    return P.long_forecast(i).select("ds", "platform", "y", "actual_running_sub")


@query(
    "w6_running_viewers",
    "with " + P.CURRENT + """
    select video_id, livestream_position, sum(average_concurrent_viewers) over (
             partition by video_id order by livestream_position rows between unbounded preceding and current row) as viewer_minutes
    from cur""",
    "minute_viewers",
)
def w6_viewers(i):
    rows = P.current(i).select("video_id", "livestream_position", "average_concurrent_viewers")
    return running_sums(rows, ["video_id"], ["livestream_position"], {"viewer_minutes": "average_concurrent_viewers"}).drop("average_concurrent_viewers")


@query(
    "w7_streak",
    "with " + P.CURRENT + """,
    isles as (select *, sum(case when average_concurrent_viewers > 1 then 0 else 1 end)
                         over (partition by video_id order by livestream_position) as island from cur)
    select video_id, livestream_position, cast(sum(case when average_concurrent_viewers > 1 then 1 else 0 end)
             over (partition by video_id, island order by livestream_position) as bigint) as run from isles""",
    "minute_viewers",
)
def w7(i):
    hit = F.col("average_concurrent_viewers") > 1
    rows = run_length(P.current(i), ["video_id"], "livestream_position", hit, "run")
    return rows.select("video_id", "livestream_position", "run")


@query(
    "w8_trailing_vector_mean",
    "with " + P.SHIFT5.split(", cosines5")[0] + """
    select n.video_id, n.livestream_position, round(m1.m, 6) as first_dim, round(m64.m, 6) as last_dim
    from numbered5 n
    left join means5 m1 on m1.video_id = n.video_id and m1.rn = n.rn and m1.d = 1 and m1.n >= 3
    left join means5 m64 on m64.video_id = n.video_id and m64.rn = n.rn and m64.d = 64 and m64.n >= 3""",
    "embedded_minutes",
)
def w8(i):
    masked = semantic.blank_uncovered(i.v("embedded_minutes"))
    rows = trailing_vectors(masked, ["video_id"], "livestream_position", "embedding", [5], "mean")
    rows = rows.withColumn("mean", F.when(F.col("valid_5") >= 3, F.col("mean_5"))).select(
        "video_id", "livestream_position", F.get("mean", F.lit(0)).alias("first_dim"), F.get("mean", F.lit(63)).alias("last_dim")
    )
    return rounded(rows, 6, "first_dim", "last_dim")


@query(
    "w9_partition_max",
    "select video_id, tie, max(livestream_position) over (partition by video_id) as longest from minute_viewers",
    "minute_viewers",
)
def w9(i):
    rows = i.v("minute_viewers").select("video_id", "livestream_position", "tie")
    return attach_group(rows, ["video_id"], "livestream_position", {"longest": ("max", "livestream_position")}, salts=16).drop(
        "livestream_position"
    )


@query(
    "w10_linear_interpolate",
    "with " + P.FILLED + """
    select video_id, pct, round(average_concurrent_viewers, 6) as average_concurrent_viewers from filled""",
    "minute_viewers",
)
def w10(i):
    return rounded(P.filled(i), 6, "average_concurrent_viewers")


@query(
    "w10_minute_interpolate",
    "with " + P.CURRENT + """,
    known as (select video_id, livestream_position as pos, case when (livestream_position // 60) % 4 = 1 then average_concurrent_viewers end as v from cur),
    sided as (select *, last_value(v ignore nulls) over back as v0, last_value(case when v is not null then pos end ignore nulls) over back as p0,
                     first_value(v ignore nulls) over ahead as v1, first_value(case when v is not null then pos end ignore nulls) over ahead as p1
              from known window back as (partition by video_id order by pos rows between unbounded preceding and current row),
                                ahead as (partition by video_id order by pos rows between current row and unbounded following))
    select video_id, pos as livestream_position, round(coalesce(v, v0 + (v1 - v0) / nullif(p1 - p0, 0) * (pos - p0), v0), 6) as viewers from sided""",
    "minute_viewers",
)
def w10_minutes(i):
    known = F.when(F.expr("livestream_position div 60") % 4 == 1, F.col("average_concurrent_viewers"))
    rows = P.current(i).select("video_id", "livestream_position", known.alias("known"))
    return rounded(fill_linear(rows, ["video_id"], "livestream_position", "known", "viewers").drop("known"), 6, "viewers")


@query(
    "w11_latest_n_window",
    "with " + P.WEEKS + """
    select week_commencing_dt, platform, point_type, cast(v as bigint) as views_count from points""",
    "channel_daily",
)
def w11(i):
    return kpi.recent_weeks(kpi.week_rollup(i.v("channel_daily"), ["views_count"]), ["platform"])


@query(
    "w12_row_minmax",
    "with " + P.NORMED + " select video_id, pct, round(norm, 6) as norm from normed",
    "minute_viewers",
    "dim_video",
)
def w12(i):
    return rounded(P.normed(i).select("video_id", "pct", "norm"), 6, "norm")


@query(
    "w13_global_stats",
    """select event_id, case when value < m - s then 'low' when value > m + s then 'high' else 'mid' end as band
       from events, (select avg(value) as m, stddev_samp(value) as s from events) t""",
)
def w13(i):
    events = i.t("events").select("event_id", "value")
    stats = events.agg(F.struct(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))).scalar()
    low, high = F.col("stats.m") - F.col("stats.s"), F.col("stats.m") + F.col("stats.s")
    band = F.when(F.col("value") < low, "low").when(F.col("value") > high, "high").otherwise("mid")
    return events.withColumn("stats", stats).select("event_id", band.alias("band"))


@query(
    "w14_gap_filter",
    "with " + P.MOVES + """
    select video_id, livestream_position, view_movement from moves where diff is null""",
    "minute_viewers",
)
def w14(i):
    return P.moves(i).filter(F.col("diff").isNull()).select("video_id", "livestream_position", "view_movement")


# ---------------------------------------------------------------- sorts


@query("t1_sort", "select video_id, start_time, end_time from segments order by 1, 2", "segments")
def t1(i):
    return i.v("segments").select("video_id", "start_time", "end_time").orderBy("video_id", "start_time")


@query(
    "t2_sort_in_cte",
    """select video_id, string_agg(text, '' order by start_time, end_time, text) as text from segments
       where text is not null group by video_id""",
    "segments",
)
def t2(i):
    return transcript.full_text(i.v("segments"))


@query(
    "t3_rank_filtered",
    "with " + P.MOVES + """
    select video_id, view_movement, round(proportion, 6) as proportion from (
      select video_id, view_movement,
             count(*) / cast(sum(count(*)) over (partition by video_id) as double) as proportion
      from moves group by 1, 2) t
    where view_movement = 'spike' order by proportion, video_id""",
    "minute_viewers",
)
def t3(i):
    return rounded(retention.movement_share(P.moves(i), "spike"), 6, "proportion")


@query(
    "t4_last_n_months",
    """select month_start_dt, platform, views_count from (
         select *, row_number() over (partition by platform order by month_start_dt desc) as rn from (
           select cast(date_trunc('month', metric_date) as date) as month_start_dt, platform,
                  cast(sum(views_count) as bigint) as views_count from channel_daily group by 1, 2) m) t
       where rn between 2 and 7""",
    "channel_daily",
)
def t4(i):
    months = kpi.month_rollup(i.v("channel_daily"), ["views_count"])
    return newest_n(months, ["platform"], "month_start_dt", 2, 7).drop("rank")


@query(
    "t5_first_last",
    """select user_id, arg_min(value, event_id) as first_value, arg_max(value, event_id) as last_value,
              max(case when back = 7 then value end) as seventh_last
       from (select *, row_number() over (partition by user_id order by event_id desc) as back from events) t
       group by user_id""",
)
def t5(i):
    events = i.t("events").select("user_id", "event_id", "value")
    ends = events.groupBy("user_id").agg(
        F.min_by("value", "event_id").alias("first_value"), F.max_by("value", "event_id").alias("last_value")
    )
    seventh = newest_n(events, ["user_id"], "event_id", 7, 7).select("user_id", F.col("value").alias("seventh_last"))
    return ends.join(seventh, "user_id", "left")


# ----------------------------------------------------------------- sets

BRANCHES = """
    select video_id, start_time, end_time from segments where end_time < 60
    union all select video_id, start_time, end_time from segments where end_time >= 45 and end_time < 120
    union all select video_id, start_time, end_time from segments where end_time >= 100"""


def branches(i: Input) -> DataFrame:
    s = i.v("segments").select("video_id", "start_time", "end_time")
    end = F.col("end_time")
    return s.filter(end < 60).unionByName(s.filter((end >= 45) & (end < 120))).unionByName(s.filter(end >= 100))


@query("u1_union_all", BRANCHES, "segments")
def u1(i):
    return branches(i)


@query("u2_union_distinct", f"select distinct * from ({BRANCHES}) b", "segments")
def u2(i):
    return branches(i).distinct()


@query("u3_append_generated", "with " + P.GAPS + " select video_id, start_time, end_time from filled", "segments")
def u3(i):
    return transcript.fill_gaps(i.v("segments")).drop("text")


@query(
    "u4_append_many",
    "select video_id, start_time, end_time, concat(' ', text) as text from file_segments",
    "file_segments",
)
def u4(i):
    return P.read_back(i)


@query(
    "u5_actual_plus_predicted",
    "with " + P.WEEKS + " select week_commencing_dt, platform, point_type, s as net_subscribers from compared",
    "channel_daily",
)
def u5(i):
    return kpi.weekly_deviation(P.daily(i), "net_subscribers")


# ------------------------------------------------------------ functions


@query(
    "f1_json_path",
    "select o_orderkey, o_orderpriority as title, cast(o_totalprice as varchar) as price from orders",
)
def f1(i):
    doc = F.to_json(
        F.struct(
            F.struct(F.col("o_orderpriority").alias("title")).alias("snippet"),
            F.struct(F.col("o_totalprice").alias("price")).alias("statistics"),
        )
    )
    rows = i.t("orders").select("o_orderkey", doc.alias("doc"))
    return rows.select(
        "o_orderkey",
        F.get_json_object("doc", "$.snippet.title").alias("title"),
        F.get_json_object("doc", "$.statistics.price").alias("price"),
    )


@query(
    "f2_json_array_text",
    """select p_partkey, concat('["', p_brand, '","', p_type, '"]') as topics from part""",
)
def f2(i):
    doc = F.to_json(F.struct(F.struct(F.array("p_brand", "p_type").alias("topicCategories")).alias("topicDetails")))
    parsed = i.t("part").select("p_partkey", F.from_json(doc, VIDEO_DATA).alias("d"))
    return parsed.select("p_partkey", F.col("d.topicDetails.topicCategories").alias("topics"))


@query("f3_json_each", "select event_id, 'k' as key, regexp_extract(props, '([0-9]+)', 1) as value from events")
def f3(i):
    return i.t("events").select("event_id", F.explode(F.from_json("props", "map<string,string>")))


@query(
    "f4_json_build",
    """select o_orderkey, concat('{"id":"', cast(o_orderkey as varchar), '","snippet":{"title":"', o_orderpriority, '"}}') as doc
       from orders""",
)
def f4(i):
    doc = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.struct(F.col("o_orderpriority").alias("title")).alias("snippet")
    )
    return i.t("orders").select("o_orderkey", F.to_json(doc).alias("doc"))


@query(
    "f5_split_part",
    "select tie, split_part(title_raw, '|', 2) as second, split_part(title_raw, '-', 1) as dashed from stage_video",
    "stage_video",
)
def f5(i):
    return i.v("stage_video").select(
        "tie",
        F.split_part("title_raw", F.lit("|"), F.lit(2)).alias("second"),
        F.split_part("title_raw", F.lit("-"), F.lit(1)).alias("dashed"),
    )


@query(
    "f6_trim",
    """select tie, trim(case when title_raw ilike 'session%' or title_raw ilike 'series%' then split_part(title_raw, '|', 2)
                             when title_raw ilike '[luton%' then split_part(title_raw, '-', 1)
                             else split_part(title_raw, '|', 1) end) as title from stage_video""",
    "stage_video",
)
def f6(i):
    return i.v("stage_video").select("tie", text.clean_title(F.col("title_raw")).alias("title"))


@query(
    "f7_concat_ws_md5",
    """select tie, md5(concat_ws('|', cast(comment_count as varchar), cast(like_count as varchar),
                       cast(cast(cast(duration_sec as double) as decimal(20,6)) as varchar))) as hashdiff from stage_video""",
    "stage_video",
)
def f7(i):
    stage = i.v("stage_video").withColumn("duration", F.col("duration_sec").cast("double"))
    return stage.select("tie", version_hash(stage, ["comment_count", "like_count", "duration"]).alias("hashdiff"))


@query(
    "f8_cast_text",
    """select o_orderkey, cast(o_custkey as varchar) as key_text, cast(cast(o_totalprice as decimal(20,6)) as varchar) as price_text,
              cast(o_orderdate as varchar) as date_text from orders""",
)
def f8(i):
    return i.t("orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(20,6)").cast("string").alias("price_text"),
        F.col("o_orderdate").cast("string").alias("date_text"),
    )


@query(
    "f9_cast_strict",
    "select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events",
)
def f9(i):
    return i.t("events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(
    "f10_cast_lenient",
    "select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as double) as a, try_cast(o_orderstatus as double) as b from orders",
)
def f10(i):
    return i.t("orders").select(
        "o_orderkey",
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("double").alias("a"),
        F.col("o_orderstatus").try_cast("double").alias("b"),
    )


@query(
    "f12_fill_null",
    "select tie, coalesce(cast(comment_count as varchar), '') as comments from stage_video",
    "stage_video",
)
def f12(i):
    return i.v("stage_video").select("tie", text.blank_if_null(F.col("comment_count").cast("string")).alias("comments"))


@query(
    "f13_strip_split",
    "select video_id, start_time, end_time from file_segments",
    "file_segments",
)
def f13(i):
    lines = transcripts.segment_lines(i.v("file_segments"))
    return transcripts.parse_lines(lines).select("video_id", "start_time", "end_time")


@query("f14_iso_duration_secs", "select tie, cast(duration_sec as double) as seconds from stage_video", "stage_video")
def f14(i):
    return i.v("stage_video").select("tie", times.iso_duration_seconds(F.col("duration_iso")).alias("seconds"))


@query("f15_to_date", "select event_id, cast(ts as date) as day from events")
def f15(i):
    return i.t("events").select("event_id", F.to_date("ts").alias("day"))


@query("f16_week_start", "select o_orderkey, cast(date_trunc('week', o_orderdate) as date) as week from orders")
def f16(i):
    return i.t("orders").select("o_orderkey", times.week_start(F.col("o_orderdate")).alias("week"))


@query("f17_month_start", "select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month from orders")
def f17(i):
    return i.t("orders").select("o_orderkey", times.month_start(F.col("o_orderdate")).alias("month"))


@query(
    "f18_date_arith",
    """select o_orderkey, cast(o_orderdate + interval 7 day as date) as next_week,
              cast(o_orderdate - interval 7 day as date) as week_before from orders""",
)
def f18(i):
    day = F.to_date("o_orderdate")
    return i.t("orders").select("o_orderkey", F.date_add(day, 7).alias("next_week"), F.date_sub(day, 7).alias("week_before"))


@query("f19_day_ordinal", "select o_orderkey, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as int) as day from orders")
def f19(i):
    return i.t("orders").select("o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("day"))


@query("f20_date_sequence", "with " + P.FORECAST + " select platform, ds from future", "channel_daily")
def f20(i):
    weekly = kpi.week_rollup(i.v("channel_daily"), ["views_count"]).withColumnRenamed("week_commencing_dt", "ds")
    return forecast.future_weeks(weekly, P.UNTIL)


@query(
    "f21_date_format",
    """select o_orderkey, strftime(o_orderdate, '%d %b %Y') as day_text, strftime(o_orderdate, '%b %Y') as month_text from orders""",
)
def f21(i):
    return i.t("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "dd MMM yyyy").alias("day_text"),
        F.date_format("o_orderdate", "MMM yyyy").alias("month_text"),
    )


@query(
    "f22_floor_bucket",
    """select video_id, start_time, cast(floor(start_time/60)*60 as bigint) as lb,
              cast(floor(start_time/60)*60 + 60 as bigint) as ub from segments""",
    "segments",
)
def f22(i):
    lower = times.bucket_start(F.col("start_time"))
    return i.v("segments").select("video_id", "start_time", lower.alias("lb"), (lower + 60).alias("ub"))


@query(
    "f23_bucket_label",
    """select video_id, start_time, concat(cast(cast(floor(start_time/60)*60 as bigint) as varchar), '-',
              cast(cast(floor(start_time/60)*60 + 60 as bigint) as varchar)) as label from segments""",
    "segments",
)
def f23(i):
    lower = times.bucket_start(F.col("start_time"))
    return i.v("segments").select("video_id", "start_time", text.bucket_label(lower, lower + 60).alias("label"))


@query("f24_round_half_even", "select o_orderkey, round_even((o_orderkey % 100) / 8.0, 1) as x from orders")
def f24(i):
    x = (F.col("o_orderkey") % 100) / F.lit(8.0)
    return i.t("orders").select("o_orderkey", F.bround(x, 1).alias("x"))


@query("f25_trunc_int", "select event_id, cast(trunc(value - 250) as bigint) as x from events")
def f25(i):
    return i.t("events").select("event_id", (F.col("value") - 250).cast("long").alias("x"))


@query(
    "f26_safe_ratio",
    """select tie, round(coalesce(cast(like_count as double) / nullif(view_count, 0) - 1, 0), 6) as change from stage_video""",
    "stage_video",
)
def f26(i):
    rows = i.v("stage_video").select("tie", numbers.relative_change(F.col("view_count"), F.col("like_count")).alias("change"))
    return rounded(rows, 6, "change")


@query(
    "f27_plain_ratio",
    "select tie, round(cast(like_count as double) / nullif(view_count, 0), 6) as per_view from stage_video",
    "stage_video",
)
def f27(i):
    rows = i.v("stage_video").select("tie", numbers.ratio(F.col("like_count"), F.col("view_count")).alias("per_view"))
    return rounded(rows, 6, "per_view")


@query(
    "f28_number_format",
    """select o_orderkey, format('{:,}', cast(trunc(o_totalprice) as bigint)) as whole,
              format('{:,.2f}', o_totalprice) as cents,
              concat(cast(cast(round_even(o_orderkey % 7 / 8.0 * 100, 0) as bigint) as varchar), '%') as pct from orders""",
)
def f28(i):
    price = F.col("o_totalprice")
    return i.t("orders").select(
        "o_orderkey",
        numbers.grouped_int(price).alias("whole"),
        numbers.grouped_2dp(price).alias("cents"),
        numbers.percent_text((F.col("o_orderkey") % 7) / F.lit(8.0)).alias("pct"),
    )


@query(
    "f29_percent_position",
    "with " + P.RESAMPLED + """
    select video_id, tie, cast(floor(cast(livestream_position / 60.0 as double) / cast(nullif(longest, 0) as double) * 100) as bigint) as pct
    from placed""",
    "minute_viewers",
)
def f29(i):
    rows = i.v("minute_viewers").select("video_id", "livestream_position", "tie")
    longest = attach_group(
        rows, ["video_id"], "livestream_position", {"longest": ("max", "livestream_position")}, salts=16
    )
    pct = numbers.percent_bucket(F.col("livestream_position"), F.col("longest"))
    return longest.select("video_id", "tie", pct.alias("pct"))


@query(
    "f30_cosine",
    """with dims as (select vec_id, label, unnest(range(1, 65)) as d, unnest(embedding) as x from embeddings),
       firsts as (select label, min(vec_id) as first_id from embeddings group by label)
       select a.vec_id, round(sum(cast(a.x as double) * b.x)
              / (sqrt(sum(cast(a.x as double) * a.x)) * sqrt(sum(cast(b.x as double) * b.x))), 6) + 0.0 as similarity
       from dims a join firsts f on a.label = f.label join dims b on b.vec_id = f.first_id and b.d = a.d
       group by a.vec_id""",
)
def f30(i):
    rows = i.t("embeddings")
    firsts = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    pairs = spread_join(rows, firsts, ["label"], "inner", ["vec_id"])
    return rounded(pairs.select("vec_id", vectors.cosine(F.col("embedding"), F.col("first")).alias("similarity")), 6, "similarity")


@query(
    "f31_vector_mask",
    """select conv_id, turn, case when turn % 5 <> 4 then [conv_id, turn] end as vector from conversations""",
)
def f31(i):
    c = i.t("conversations").withColumn("text", F.when(F.col("turn") % 5 == 4, "").otherwise(F.col("text")))
    vector = F.array("conv_id", "turn")
    return c.select("conv_id", "turn", vectors.unless_blank(F.col("text"), vector).alias("vector"))


@query(
    "f32_low_coverage_blank",
    """select label as video_id, vec_id, case when cast(vec_id%7 as double)/6 < 0.5 then '' else cast(vec_id as varchar) end as text
       from embeddings""",
)
def f32(i):
    e = i.v("embedded_minutes").withColumn("vec_id", (F.col("livestream_position") / 60).cast("long"))
    kept = vectors.text_if_covered(F.col("vec_id").cast("string"), F.col("duration_text_coverage_pct"))
    return e.select("video_id", "vec_id", kept.alias("text"))


@query(
    "f33_url_format",
    "select o_orderkey, concat('https://www.youtube.com/watch?v=', cast(o_orderkey as varchar)) as url from orders",
)
def f33(i):
    return i.t("orders").select("o_orderkey", text.watch_url(F.col("o_orderkey")).alias("url"))


@query(
    "f35_full_text",
    """select video_id, string_agg(text, '' order by start_time, end_time, text) as text from segments
       where text is not null group by video_id""",
    "segments",
)
def f35(i):
    return transcript.full_text(i.v("segments"))
