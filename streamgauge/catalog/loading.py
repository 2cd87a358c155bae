"""Load-pattern keys. The target is what was loaded before a fixed day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.catalog import products as P
from streamgauge.catalog.registry import Input, query
from streamgauge.operators import loads
from streamgauge.plans import transcript, vault
from streamgauge.session import materialize, scratch_path
from streamgauge.sources import buckets, tables

ORDER_CUT = "1998-01-01"
EVENT_CUT = "2024-01-15"


def stage_parts(i: Input) -> tuple[DataFrame, DataFrame]:
    rows = i.v("stage_video").select("video_id", "record_source", "load_ts", "tie")
    return rows.filter(F.col("load_ts") < ORDER_CUT), rows.filter(F.col("load_ts") >= ORDER_CUT)


@query("l1_truncate_reload", f"select video_id, load_ts, tie from stage_video where load_ts >= timestamp '{ORDER_CUT}'", "stage_video")
def l1(i):
    old, new = stage_parts(i)
    path = scratch_path(i.spark, "reloaded")
    tables.write_snapshot(old, path)
    tables.write_snapshot(new, path)
    return tables.read_table(i.spark, path).select("video_id", "load_ts", "tie")


@query("l2_append", "select video_id, load_ts, tie from stage_video", "stage_video")
def l2(i):
    path = scratch_path(i.spark, "appended")
    for part in stage_parts(i):
        tables.append_rows(part, path)
    return tables.read_table(i.spark, path).select("video_id", "load_ts", "tie")


@query(
    "l3_incremental_new_keys",
    f"""with first_load as (
      select video_id, min(load_ts) as load_ts from stage_video where load_ts < timestamp '{ORDER_CUT}' group by video_id
    ), second_load as (
      select video_id, min(load_ts) as load_ts from stage_video where load_ts >= timestamp '{ORDER_CUT}' group by video_id
    )
    select * from first_load union all
    select * from second_load s where not exists (select 1 from first_load f where f.video_id = s.video_id)""",
    "stage_video",
)
def l3(i):
    old, new = stage_parts(i)
    path = scratch_path(i.spark, "hub")
    for part in (old, new):
        tables.append_rows(vault.hub(part, tables.read_table(i.spark, path)), path)
    return tables.read_table(i.spark, path).select("video_id", "load_ts")


@query(
    "l3_new_transcript_videos",
    "with chosen as (select * from segments where video_id not in (select video_id from segments where end_time > 250)), "
    + P.PIECES.format(src="chosen")
    + " select * from buckets",
    "segments",
)
def l3_transcripts(i):
    segments = i.v("segments")
    loaded = transcript.transcript_minutes(segments.filter("end_time > 250"))
    return P.rounded(transcript.transcript_minutes(segments, target=loaded), 6, "duration_secs_valid")


DAY_LOADS = """
    with newest as (
      select *, load_ts < timestamp '{cut}' as is_old,
             row_number() over (partition by date_key, cast(load_ts as date) order by load_ts desc, tie desc) as rn
      from stage_day
    ), hashed as (
      select date_key as date, {metrics}, load_ts, tie, is_old, md5(concat_ws('|', {hashed})) as hashdiff
      from newest where rn = 1
    ), versions as (
      select date, {metrics}, load_ts, hashdiff, is_old from (
        select *, row_number() over (partition by is_old, date, hashdiff order by load_ts desc, tie desc) as r2
        from hashed) t where r2 = 1
    )""".format(cut=EVENT_CUT, metrics=P.DAY_METRICS, hashed=P.DAY_HASHED_TEXT)


def day_parts(i: Input) -> tuple[DataFrame, DataFrame]:
    rows = P.day_stage(i)
    return rows.filter(F.col("load_ts") < EVENT_CUT), rows.filter(F.col("load_ts") >= EVENT_CUT)


NEW_VERSIONS = (
    DAY_LOADS + f"""
    select {P.DAY_METRICS}, date, load_ts, hashdiff from versions v
    where is_old or not exists (select 1 from versions o where o.is_old and o.date = v.date and o.hashdiff = v.hashdiff)"""
)


@query(
    "l4_incremental_new_versions",
    NEW_VERSIONS,
    "stage_day",
)
def l4(i):
    path = scratch_path(i.spark, "fact")
    for part in day_parts(i):
        tables.append_rows(vault.channel_daily(part, tables.read_table(i.spark, path), tie=["tie"]), path)
    return tables.read_table(i.spark, path).select(*P.DAY_COLUMNS)


def bucket_loads(i: Input, load) -> DataFrame:
    """Both batches loaded into a target in buckets, of which a batch reads and writes its own."""
    path = scratch_path(i.spark, "fact_buckets")
    for part in day_parts(i):
        load(materialize(vault.channel_daily(part, tie=["tie"]), "batch"), path)
    return buckets.read_buckets(i.spark, path).select(*P.DAY_COLUMNS)


@query("l4_bucket_versions", NEW_VERSIONS, "stage_day")
def l4_buckets(i):
    return bucket_loads(i, lambda batch, path: buckets.add_new_versions(batch, path, "date", 16))


REPLACED = (
    DAY_LOADS + f"""
    select {P.DAY_METRICS}, date, load_ts, hashdiff from versions v
    where not is_old or date not in (select date from versions where not is_old)"""
)


@query(
    "l5_delete_insert",
    REPLACED,
    "stage_day",
)
def l5(i):
    old, new = (vault.channel_daily(part, tie=["tie"]) for part in day_parts(i))
    return loads.delete_insert(old, new, ["date"]).select(*P.DAY_COLUMNS)


@query("l5_bucket_replace", REPLACED, "stage_day")
def l5_buckets(i):
    return bucket_loads(i, lambda batch, path: buckets.replace_keys(batch, path, ["date"], 16))


@query(
    "l6_lookback_window",
    f"""with days as (select date_key, tie, cast(load_ts as date) as date from stage_day)
    select date_key, tie, date from days
    where date between (select max(date) from days where date < date '{EVENT_CUT}') - 7 and date '2024-01-20'""",
    "stage_day",
)
def l6(i):
    days = i.v("stage_day").select("date_key", "tie", F.to_date("load_ts").alias("date"))
    return loads.lookback(days, days.filter(F.col("date") < EVENT_CUT), "date", "2024-01-20")


@query("l7_hash_versioning", f"{P.DAY_CTES} select * from versions", "stage_day")
def l7(i):
    rows = i.v("stage_day").withColumnRenamed("date_key", "date")
    versions = loads.hash_versions(rows, "date", vault.DAY_HASHED, tie=["tie"])
    return versions.select(*P.DAY_COLUMNS)


@query(
    "l8_first_run_switch",
    f"""select video_id, min(load_ts) as load_ts, true as first_run from stage_video
        where load_ts < timestamp '{ORDER_CUT}' group by video_id
        union all
        select video_id, min(load_ts), false from stage_video s where load_ts >= timestamp '{ORDER_CUT}'
          and video_id not in (select video_id from stage_video where load_ts < timestamp '{ORDER_CUT}')
        group by video_id""",
    "stage_video",
)
def l8(i):
    path = scratch_path(i.spark, "switched")
    for part in stage_parts(i):
        first_run = not tables.has_snapshot(i.spark, path)
        rows = vault.hub(part, tables.read_table(i.spark, path)).withColumn("first_run", F.lit(first_run))
        tables.append_rows(rows, path)
    return tables.read_table(i.spark, path).select("video_id", "load_ts", "first_run")
