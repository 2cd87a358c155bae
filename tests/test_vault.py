"""Version detection, incremental loads, snapshots."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from streamgauge import schemas
from streamgauge.operators import loads
from streamgauge.operators.latest import latest_per
from streamgauge.plans import vault
from streamgauge.sources import landing, lookups, tables


def day_rows(spark, items):
    rows = [(date(2024, 1, 1), json.dumps({"likes": likes, "views": 1}), ts) for ts, likes in items]
    return spark.createDataFrame(rows, schemas.STAGE_DAY)


def ts(day, hour=0):
    return datetime(2024, 2, day, hour)


def test_a_hash_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    for day, likes in [(1, 5), (2, 6), (3, 5)]:
        batch = day_rows(spark, [(ts(day), likes)])
        tables.append_rows(vault.channel_daily(batch, tables.read_table(spark, path)), path)
    assert sorted(r.likes for r in tables.read_table(spark, path).collect()) == [5, 6]


def test_second_run_adds_nothing(spark):
    batch = day_rows(spark, [(ts(1), 5), (ts(2), 6), (ts(2, 5), 7)])
    first = vault.channel_daily(batch)
    assert sorted(r.likes for r in first.collect()) == [5, 7]
    assert vault.channel_daily(batch, first).count() == 0


def test_change_detection_records_a_return(spark):
    batch = day_rows(spark, [(ts(1), 5), (ts(2), 6), (ts(3), 5), (ts(4), 5)])
    assert sorted(r.likes for r in vault.channel_daily(batch).collect()) == [5, 6]
    got = vault.channel_daily(batch, detect="change").orderBy("load_ts").collect()
    assert [(r.likes, r.load_ts.day) for r in got] == [(5, 1), (6, 2), (5, 3)]


def test_delete_insert_trace(spark, tmp_path):
    """Loads A, B, C, C, A under a key coarser than the version."""
    path, seen, stage = str(tmp_path / "t"), [], []
    for day, name in enumerate("ABCCA", 1):
        stage.append((1, name, ts(day)))
        rows = spark.createDataFrame(stage, "k int, v string, load_ts timestamp_ntz")
        versions = loads.hash_versions(rows, "k", ["v"])
        target = tables.read_table(spark, path)
        fresh = loads.new_versions(versions, target, "k")
        new = fresh if target is None else loads.delete_insert(target, fresh, ["k"])
        tables.write_snapshot(new, path)
        seen.append({r.v for r in tables.read_table(spark, path).collect()})
    assert seen == [{"A"}, {"B"}, {"A", "C"}, {"B"}, {"C", "A"}]


def video(title="T | x", likes="1", minutes=None, loaded=ts(1), vid="v"):
    data = {
        "id": vid,
        "snippet": {"title": title, "description": "d", "publishedAt": "2024-01-02T03:04:05Z", "categoryId": "22"},
        "contentDetails": {"duration": "PT1H2M3S"},
        "topicDetails": {"topicCategories": ["a", "b"]},
        "statistics": {"likeCount": likes, "viewCount": "34"},
    }
    return (vid, json.dumps(data), minutes, 7.5, "YT", loaded)


def test_details(spark):
    stage = spark.createDataFrame([video()], schemas.STAGE_VIDEO)
    row = vault.sat_details(stage).first()
    assert row.video_title == "T" and row.video_duration_sec == 3723 and row.likes_count == 1
    assert row.video_published_at == datetime(2024, 1, 2, 3, 4, 5)
    assert row.video_topic == '["a","b"]' and row.comment_count is None and row.estimated_minutes_watched == 7.5


def test_raw_title_is_not_hashed(spark):
    stage = spark.createDataFrame([video("T | x"), video("T | y", loaded=ts(2))], schemas.STAGE_VIDEO)
    assert [r.video_title_raw for r in vault.sat_details(stage).collect()] == ["T | y"]


def test_bad_count_is_an_error(spark):
    stage = spark.createDataFrame([video(likes="many")], schemas.STAGE_VIDEO)
    with pytest.raises(Exception):
        vault.sat_details(stage).collect()


def test_minutes(spark):
    m = {"60": {"livestreamPosition": 60, "averageConcurrentViewers": 3.0, "peakConcurrentViewers": 5}, "120": {}}
    stage = spark.createDataFrame(
        [video(minutes=json.dumps(m)), video(vid="w"), video(vid="x", minutes="{}")], schemas.STAGE_VIDEO
    )
    got = {r.livestream_position: (r.peak_concurrent_viewers, r.average_concurrent_viewers) for r in vault.sat_minute_viewers(stage).collect()}
    assert got == {60: (5.0, 3.0), 120: (None, None)}


def test_hub(spark):
    stage = spark.createDataFrame([video(loaded=ts(2)), video(loaded=ts(1)), video(vid=None)], schemas.STAGE_VIDEO)
    assert [(r.video_id, r.load_ts.day) for r in vault.hub(stage).collect()] == [("v", 1)]
    assert vault.hub(stage, per_load=True).count() == 2
    assert vault.hub(stage, vault.hub(stage)).count() == 0


def test_lookback(spark):
    rows = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 29)], "date date")
    loaded = rows.filter(F.col("date") <= "2024-01-15")
    assert [r.date.day for r in loads.lookback(rows, loaded, "date", "2024-01-20").orderBy("date").collect()] == list(range(8, 21))
    assert loads.lookback(rows, None, "date", "2024-01-03", origin="2022-09-16").count() == 3
    assert loads.lookback(rows, loaded.limit(0), "date", "2024-01-03", origin="2022-09-16").count() == 3
    assert loads.lookback(rows, loaded.limit(0), "date", "2024-01-03").count() == 3


def test_stage_loads(spark, tmp_path):
    root, name = str(tmp_path), "sc_yt_video_data"
    with pytest.raises(ValueError, match="action must be truncate or append"):
        tables.load_stage(spark.range(1), root, name, "merge")
    frame = spark.createDataFrame([("v", "{}", 3.0)], "video_id string, video_data string, estimatedminuteswatched double")
    assert tables.read_stage(spark, root, name).count() == 0
    tables.load_stage(frame, root, name, "append")
    tables.load_stage(frame, root, name, "append")
    rows = tables.read_stage(spark, root, name).collect()
    assert len(rows) == 2 and rows[0].load_ts is not None and rows[0].estimatedMinutesWatched == 3.0
    tables.load_stage(frame, root, name, "truncate")
    assert tables.read_stage(spark, root, name).count() == 1
    with pytest.raises(ValueError, match="columns not in the table"):
        tables.load_stage(frame.withColumn("zzz", F.lit(1)), root, name, "append")


def test_reload_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(5), path)
    tables.write_snapshot(tables.read_table(spark, path).filter("id > 2"), path)
    assert tables.read_table(spark, path).count() == 2


def test_publish_layer(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(5), path)
    tables.publish_layer(spark, "layer_under_test", {"numbers": path})
    assert tables.run_query(spark, "select count(*) as n from layer_under_test.numbers").first().n == 5
    spark.sql("drop database layer_under_test cascade")


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_report_rows_last_wins(spark):
    report = ([("day",), ("views",)], [["2024-01-01", "10"], ["2024-01-02", "4"], ["2024-01-01", "12"]])
    reports = spark.createDataFrame([report, ([("day",)], None)], schemas.API_REPORT)
    got = {str(r.date): json.loads(r.date_metrics) for r in landing.day_feed(reports).collect()}
    assert got == {"2024-01-01": {"day": "2024-01-01", "views": "12"}, "2024-01-02": {"day": "2024-01-02", "views": "4"}}
    assert landing.first_row_values(spark.createDataFrame([([], [])], schemas.API_REPORT)).count() == 0


def test_empty_results_keep_their_columns(spark):
    empty = tables.empty_table(spark, schemas.VIDEO_ITEMS)
    got = landing.recent_videos(empty, "2024-01-01")
    assert got.schema == schemas.RECENT_VIDEOS and got.count() == 0


def test_names(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_text("original_name,canonical_name\nAnn B,Ann Bee\nAnn,Ann Bee\nAnn B,Ann Bee\nCy, Cy Dee\n")
    names = lookups.read_speaker_names(spark, str(path))
    assert names.count() == 3
    df = spark.createDataFrame([("Ann",), ("Cy",), ("Zed",)], "speaker string")
    assert {r.speaker for r in lookups.canonical_names(df, names, "speaker").collect()} == {"Ann Bee", "Cy Dee", "Zed"}


def test_later_report_wins_though_shorter(spark):
    names = [("day",), ("views",)]
    old = (names, [["2024-01-02", "1"], ["2024-01-03", "2"], ["2024-01-01", "10"]], "2024-01-05 00:00:00")
    new = (names, [["2024-01-01", "99"]], "2024-01-06 00:00:00")
    reports = spark.createDataFrame([new, old], schemas.API_REPORT.simpleString()[7:-1] + ", landed: string").withColumn("landed", F.col("landed").cast("timestamp"))
    got = {str(r.date): json.loads(r.date_metrics)["views"] for r in landing.day_feed(reports).collect()}
    assert got == {"2024-01-01": "99", "2024-01-02": "1", "2024-01-03": "2"}


def test_feeds_landed_twice_give_one_row(spark):
    videos = spark.createDataFrame([("a", "old", "2024-01-01"), ("a", "new", "2024-01-02")], "video_id string, video_data string, landed string")
    watched = spark.createDataFrame([([], [["a", "5"]], "2"), ([], [["a", "3"]], "3")], "columnHeaders array<struct<name: string>>, rows array<array<string>>, landed string")
    minutes = spark.createDataFrame([("a", "{}")], "video_id string, minute_metrics string")
    got = landing.combine_feeds(videos, minutes, landing.first_row_values(watched)).collect()
    assert [tuple(r) for r in got] == [("a", "new", "{}", 3.0)]
