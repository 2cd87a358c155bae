"""The domain's tables as views of the generic test tables.

The SQL runs unchanged in Spark and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the generic test tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}
TABLES = list(SCHEMAS)

SQL = {
    "segments": """
        select conv_id as video_id, cast(turn as double)*45 as start_time,
               cast(turn as double)*45 + 10 + cast(length(text)%70 as double) as end_time,
               case when turn%5 = 4 then '' else text end as text
        from {conversations}""",
    # What is left of the segments after a round trip through text files.
    "file_segments": """
        select conv_id as video_id, cast(turn as double)*45 as start_time,
               cast(turn as double)*45 + 10 + cast(length(text)%70 as double) as end_time,
               concat('words ', cast(turn as string), ' of ', role, ']') as text
        from {conversations}""",
    "minute_viewers": """
        select user_id as video_id, cast(regexp_extract(props,'([0-9]+)',1) as int)*60 as livestream_position,
               cast(floor(value/20) as double) as peak_concurrent_viewers,
               cast(floor(value/25) as double) as average_concurrent_viewers,
               ts as load_ts, event_id as tie
        from {events}""",
    "stage_video": """
        select o_custkey as video_id, concat('src', cast(o_orderkey%4 as string)) as record_source,
               o_orderdate as load_ts, o_orderkey as tie,
               case when o_orderkey%8 = 7 then concat('Series ', o_orderstatus, ' | ', o_orderpriority, ' | tail')
                    when o_orderkey%3 = 0 then concat('SESSION 1 | ', o_orderpriority, ' | tail')
                    when o_orderkey%3 = 1 then concat('[Luton] talk ', o_orderstatus, ' - live')
                    else concat(o_orderpriority, ' | tail') end as title_raw,
               case when o_orderkey%5 > 0 then concat('about ', o_orderpriority) end as description,
               case when o_orderkey%4 > 0 then o_orderstatus end as topic,
               cast(o_custkey%9 as string) as category,
               case when o_orderkey%6 > 0 then cast(floor(o_totalprice/1000) as double) end as minutes_watched,
               concat('PT', cast(o_custkey%3 as string), 'H', cast(o_custkey%60 as string), 'M',
                      cast(o_orderkey%2 as string), 'S') as duration_iso,
               (o_custkey%3)*3600 + (o_custkey%60)*60 + o_orderkey%2 as duration_sec,
               o_orderkey%5 as like_count, o_orderkey%2 as view_count,
               case when o_orderkey%7 = 0 then null else o_orderkey%3 end as comment_count
        from {orders}""",
    "stage_day": """
        select user_id as date_key, ts as load_ts, event_id as tie,
               cast(regexp_extract(props,'([0-9]+)',1) as int)%3 as likes,
               cast(regexp_extract(props,'([0-9]+)',1) as int)%2 as views,
               cast(event_id as int)%2 as shares, cast(event_id as int)%3 as comments,
               case when event_id%4 > 0 then cast(event_id as int)%2 end as dislikes,
               cast(user_id as int)%5 as subscribers_lost, cast(user_id as int)%7 as subscribers_gained,
               cast(floor(value/150) as int) as average_view_duration,
               cast(floor(value/200) as double) as average_view_percentage,
               cast(floor(value/100) as double) as estimated_minutes_watched
        from {events}""",
    "channel_daily": """
        select cast(l_shipdate as date) as metric_date, l_returnflag as platform,
               cast(l_quantity as bigint) as subscribers_gained, cast(l_linenumber as bigint) as subscribers_lost,
               cast(l_quantity*10 as bigint) as views_count, cast(l_linenumber*2 as bigint) as likes_count,
               cast(l_linenumber%3 as bigint) as dislikes_count, cast(l_quantity as bigint)%11 as comments_count,
               cast(l_partkey%5 as bigint) as shares_count,
               cast(floor(l_extendedprice) as bigint) as estimated_watch_minutes
        from {lineitem}""",
    "embedded_minutes": """
        select label as video_id, vec_id*60 as livestream_position, embedding,
               cast(vec_id%7 as double)/6 as duration_text_coverage_pct
        from {embeddings}""",
    "dim_video": """
        select p_partkey as video_id, p_name as video_title, p_brand as video_speaker,
               case p_partkey%3 when 0 then 'Livestream' when 1 then 'Luton Livestream' else 'Short' end as video_type,
               p_partkey%11 as video_likes, p_partkey%4 as video_comments, p_partkey%13 as video_views,
               p_partkey%97 as video_estimated_minutes_watched, p_size*60 as video_duration_sec
        from {part}""",
    "speaker_variants": """
        select distinct o_orderpriority as original_name, concat(' ', split_part(o_orderpriority,'-',2)) as canonical_name
        from {orders} where o_orderpriority <> '5-LOW'""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table over the generic tables of ``sf_dir``."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in SQL[name]}
    return spark.sql(SQL[name], **used)


def oracle(body: str, *names: str) -> str:
    """``body`` with the named domain tables put in front as CTEs."""
    plain = {t: t for t in TABLES}
    ctes = ", ".join(f"{n} as ({SQL[n].format(**plain)})" for n in names)
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"
