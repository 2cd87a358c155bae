"""From landed files to published tables, twice."""

import json
from datetime import date

import pytest

from streamgauge import jobs
from streamgauge.sources import tables


def write_lines(folder, docs):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(json.dumps(d) for d in docs))


def item(vid, title, likes, published="2024-03-01T10:00:00Z"):
    return {
        "id": vid,
        "snippet": {"title": title, "description": "d", "publishedAt": published, "categoryId": "1"},
        "contentDetails": {"duration": "PT1H"},
        "statistics": {"likeCount": likes, "viewCount": "9", "commentCount": "1"},
    }


def report(names, rows, **extra):
    return {"columnHeaders": [{"name": n} for n in names], "rows": rows, **extra}


MINUTE = ["livestreamPosition", "averageConcurrentViewers", "peakConcurrentViewers"]


@pytest.fixture
def landed(tmp_path):
    src = tmp_path / "landing"
    write_lines(src / "videos", [{"items": [item("a", "Talk | x", "1"), item("b", "[Luton] T - live", "2", "2023-01-01T00:00:00Z")]}])
    write_lines(src / "minutes", [report(MINUTE, [[60, 3.0, 5], [120, 4.0, 6], [60, 3.5, 7]], video_id="a"), {"columnHeaders": [], "video_id": "b"}])
    write_lines(src / "watched", [report(["video", "estimatedMinutesWatched"], [["a", 77.5]])])
    write_lines(src / "days", [report(["day", "views", "likes"], [["2024-03-01", 10, 1], ["2024-03-02", 11, 2], ["2020-01-01", 5, 5]])])
    (src / "transcripts").mkdir()
    (src / "transcripts" / "a.txt").write_text("[0.00 -> 70.00] hi\n[72.00 -> 80.00] there\n")
    (src / "transcripts" / "b.txt").write_text("[0.00 -> 1.00] old\n")
    return src


def test_end_to_end(spark, landed, tmp_path):
    root, src, today = str(tmp_path / "wh"), str(landed), date(2024, 3, 5)

    def daily(mode="append", reload=False):
        jobs.stage_daily(spark, src, root, mode, today)
        jobs.build_raw_vault(spark, root, reload)

    def rows(path):
        return tables.read_table(spark, f"{root}/{path}").collect()

    daily()
    daily()  # same content again: more staging rows, no new versions
    assert len(rows("stage/sc_yt_video_data")) == 4
    assert {r.video_id for r in rows("rdv/social_content_hub")} == {"a", "b"} and len(rows("rdv/social_content_hub")) == 2
    assert {r.video_id: (r.video_title, r.estimated_minutes_watched) for r in rows("rdv/social_content_sat_details")} == {
        "a": ("Talk", 77.5),
        "b": ("[Luton] T", None),
    }
    minutes = {r.livestream_position: r.peak_concurrent_viewers for r in rows("rdv/social_content_sat_min_viewers")}
    assert minutes == {60: 7.0, 120: 6.0}
    assert {str(r.date): r.views for r in rows("rdv/fct_channel_metrics_daily")} == {"2024-03-01": 10, "2024-03-02": 11}

    write_lines(landed / "videos", [{"items": [item("a", "Talk | x", "50"), item("c", "New", "3")]}])
    daily()
    assert len(rows("rdv/social_content_sat_details")) == 4 and len(rows("rdv/social_content_hub")) == 3
    daily("truncate", reload=True)
    assert {r.video_id: r.likes_count for r in rows("rdv/social_content_sat_details")} == {"a": 50, "c": 3}

    for _ in range(2):
        jobs.stage_weekly(spark, src, root, "append", today)
        jobs.build_business_vault(spark, root)
    got = {r.minute_boundaries_lb: (r.duration_secs_valid, r.text) for r in rows("bdv/fct_video_transcript_segment")}
    assert got == {0: (60.0, " hi"), 60: (18.0, " hi there")}

    jobs.publish(spark, root)
    found = tables.run_query(
        spark,
        """select d.video_title, count(*) as n from rdv.social_content_sat_min_viewers m
           left join rdv.social_content_sat_details d on d.video_id = m.video_id group by 1""",
    ).collect()
    assert [(r.video_title, r.n) for r in found] == [("Talk", 2)]
    for layer in ("stage", "rdv", "bdv"):
        spark.sql(f"drop database {layer} cascade")
