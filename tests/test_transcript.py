"""Transcript plans: hand cases and a brute-force twin."""

import random

import pytest
from pyspark.sql import functions as F

from streamgauge.plans import transcript as T
from streamgauge.sources import transcripts as files
from streamgauge.sources.tables import read_table, write_snapshot

SCHEMA = "video_id string, start_time double, end_time double, text string"


def minutes(spark, rows, **kw):
    out = T.transcript_minutes(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    return {(r.video_id, r.minute_boundaries_lb): (round(r.duration_secs_valid, 9), r.text) for r in out}


@pytest.mark.parametrize(
    "segment, expected",
    [
        ((58.6, 63.8, "a"), {0: (1.4, "a"), 60: (3.8, "a")}),
        ((354.12, 368.08, "a"), {300: (5.88, "a"), 360: (8.08, "a")}),
        ((50.0, 190.0, "a"), {0: (130.0, "a"), 180: (10.0, "a")}),
        ((50.0, 60.0, "a"), {0: (10.0, "a"), 60: (0.0, "a")}),
        ((0.0, 10.0, None), {0: (0.0, None)}),
        ((0.0, 10.0, ""), {0: (0.0, "")}),
    ],
)
def test_bucket_hand_cases(spark, segment, expected):
    got = minutes(spark, [("v", *segment)])
    assert got == {("v", lb): x for lb, x in expected.items()}


def test_cut_at_every_border(spark):
    got = minutes(spark, [("v", 50.0, 190.0, "a")], split="all")
    assert {k[1]: v[0] for k, v in got.items()} == {0: 10, 60: 60, 120: 60, 180: 10}


def test_text_order_and_copies(spark):
    rows = [("v", 5.0, 9.0, "b"), ("v", 1.0, 5.0, "a"), ("v", 1.0, 5.0, "a"), ("v", 9.0, 10.0, None), (None, 1.0, 2.0, "x")]
    assert minutes(spark, rows) == {("v", 0): (8.0, "ab")}
    assert minutes(spark, rows, copies="keep") == {("v", 0): (12.0, "aab")}


def test_only_unseen_videos(spark):
    rows = [("v", 1.0, 5.0, "a"), ("w", 1.0, 5.0, "b")]
    target = T.transcript_minutes(spark.createDataFrame(rows[:1], SCHEMA))
    assert set(minutes(spark, rows, target=target)) == {("w", 0)}


def test_gaps_and_overlaps(spark):
    rows = [("v", 0.0, 4.0, "a"), ("v", 6.0, 9.0, "b"), ("v", 8.0, 10.0, "c"), ("w", 0.0, 1.0, "d")]
    got = sorted((r.start_time, r.end_time, r.text) for r in T.gap_rows(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(4.0, 6.0, ""), (9.0, 8.0, "")]


def brute_gaps(rows):
    out, videos = [], {}
    for r in rows:
        videos.setdefault(r[0], []).append(r)
    for v, items in videos.items():
        items.sort(key=lambda r: (r[1], r[2]))
        for a, b in zip(items, items[1:]):
            if a[2] != b[1]:
                out.append((v, a[2], b[1]))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_gaps_against_loop(spark, seed, monkeypatch):
    rng = random.Random(seed)
    rows = []
    for v, n in [("hot", 300), ("a", 5), ("b", 1)]:
        t = 0.0
        for _ in range(n):
            t += rng.choice([0.0, 30.0, 900.0])
            rows.append((v, t, t + rng.choice([0.0, 10.0, 30.0]), "x"))
    rows += [rows[3]] * 40  # a group of copies
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    monkeypatch.setattr(T, "COPIES_PER_TASK", 7)
    got = sorted((r.video_id, r.start_time, r.end_time) for r in T.gap_rows(df).collect())
    assert got == brute_gaps(rows)


def test_seconds_add_up(spark):
    rng = random.Random(3)
    rows = [("v", s := rng.uniform(0, 900), s + rng.uniform(0, 200), rng.choice([f"a{k}", "", None])) for k in range(200)]
    spoken = sum(e - s for _, s, e, t in rows if t)
    for split in ("once", "all"):
        got = minutes(spark, rows, split=split)
        assert sum(x for x, _ in got.values()) == pytest.approx(spoken)


def test_flat_folder_of_files(spark, tmp_path):
    (tmp_path / "abc-1.txt").write_text("[0.00 -> 4.20] first [x] words\n\n[4.20 -> 9.00]\n", encoding="utf-8")
    (tmp_path / "d_2.txt").write_text("[1.50 -> 2.00] z\n", encoding="utf-8")
    (tmp_path / "other.log").write_text("no", encoding="utf-8")
    got = sorted(tuple(r) for r in files.read_files(spark, str(tmp_path)).collect())
    assert got == [("abc-1", 0.0, 4.2, " first [x] words"), ("abc-1", 4.2, 9.0, None), ("d_2", 1.5, 2.0, " z")]
    assert {r.video_id for r in files.listed_ids(spark, str(tmp_path)).collect()} == {"abc-1", "d_2"}
    videos = spark.createDataFrame([("abc-1",), ("new",)], "video_id string")
    missing = T.missing_transcripts(videos, files.listed_ids(spark, str(tmp_path))).collect()
    assert [r.url for r in missing] == ["https://www.youtube.com/watch?v=new"]


def test_bad_line_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("no time stamps\n", encoding="utf-8")
    with pytest.raises(Exception):
        files.read_files(spark, str(tmp_path)).collect()


def test_rebuild(spark, tmp_path):
    source, table = tmp_path / "txt", str(tmp_path / "table")
    source.mkdir()
    (source / "v.txt").write_text("[0.00 -> 4.00] a\n[6.00 -> 7.00] b\n", encoding="utf-8")
    write_snapshot(spark.createDataFrame([("old", 0.0, 1.0, "x")], SCHEMA), table)
    T.rebuild_transcripts(spark, str(source), table)
    got = sorted((r.video_id, r.start_time, r.text) for r in read_table(spark, table).collect())
    assert got == [("v", 0.0, " a"), ("v", 4.0, ""), ("v", 6.0, " b")]


def test_full_text(spark):
    rows = [("v", 700.0, 701.0, "c"), ("v", 0.0, 1.0, "a"), ("v", 2.0, 3.0, "b"), ("v", 5.0, 6.0, None)]
    assert [r.text for r in T.full_text(spark.createDataFrame(rows, SCHEMA)).collect()] == ["abc"]


def test_coverage(spark):
    rows = [("v", 0.0, 30.0, "a"), ("v", 40.0, 60.0, "b")]
    got = {r.minute_boundaries: (r.text, r.duration_text_coverage_pct) for r in T.transcript_coverage(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["0-60"] == ("ab", pytest.approx(50 / 60))
    assert got["60-120"][0] == "b"


def test_hot_bucket_is_reduced_before_the_shuffle(spark):
    rows = spark.range(20000).select(
        F.lit("v").alias("video_id"), F.lit(1.0).alias("start_time"), F.lit(2.0).alias("end_time"), F.lit("a").alias("text")
    )
    got = T.transcript_minutes(rows).collect()
    assert [(r.duration_secs_valid, r.text) for r in got] == [(1.0, "a")]
    plan = T.transcript_minutes(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_collect_set" in plan
