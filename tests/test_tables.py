"""Loads that are seen whole or not at all, and targets of which a load touches its own buckets only."""

import os
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamgauge import jobs, schemas
from streamgauge.operators.loads import HASH
from streamgauge.sources import buckets, tables, transcripts


def broken(spark, n=20):
    """Rows of which the last one fails while it is written, after others are."""
    return spark.range(n, numPartitions=4).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("died")).cast("long")).alias("id"))


def ids(spark, path):
    return sorted(r.id for r in tables.read_table(spark, path).collect())


def test_a_killed_load_leaves_the_table_unchanged(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        tables.append_rows(broken(spark), path)
    assert tables.read_table(spark, path) is None and not tables.has_snapshot(spark, path)
    tables.append_rows(spark.range(3), path)
    for load in (tables.append_rows, tables.write_snapshot):
        with pytest.raises(PySparkException):
            load(broken(spark), path)
        assert ids(spark, path) == [0, 1, 2]
    tables.append_rows(spark.range(3, 5), path)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and tables.table_state(spark, path) == (0, 2)


def test_a_load_without_its_marker_is_not_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(spark.range(3), path)
    tables.append_rows(spark.range(3, 5), path)
    os.rename(f"{path}/v=0/part=1/_SUCCESS", f"{path}/v=0/part=1/_left")
    assert ids(spark, path) == [0, 1, 2]


def test_the_second_of_two_writers_gets_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(tables.ConcurrentLoad):
        tables.append_rows(spark.range(1), path)
        tables.append_rows(spark.range(1), path, since=None)
    state = tables.table_state(spark, path)
    tables.append_rows(spark.range(1, 2), path, since=state)
    with pytest.raises(tables.ConcurrentLoad):
        tables.append_rows(spark.range(5, 6), path, since=state)
    assert ids(spark, path) == [0, 1]
    tables.write_snapshot(spark.range(9, 10), path)
    with pytest.raises(tables.ConcurrentLoad):
        tables.append_rows(spark.range(5, 6), path, since=(0, 2))
    with pytest.raises(tables.ConcurrentLoad):
        tables.write_snapshot(spark.range(5, 6), path, since=(0, 2))
    assert ids(spark, path) == [9]


def test_a_job_overtaken_by_another_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")

    def slow(target):
        jobs.load_product(spark, path, lambda t: spark.range(2))
        return spark.range(2)

    with pytest.raises(tables.ConcurrentLoad):
        jobs.load_product(spark, path, slow)
    assert ids(spark, path) == [0, 1]


def test_published_views_show_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(spark.range(3), path)
    tables.publish_layer(spark, "layer_of_parts", {"t": path})
    assert spark.table("layer_of_parts.t").columns == ["id"]
    tables.append_rows(spark.range(3, 5), path)
    tables.publish_layer(spark, "layer_of_parts", {"t": path})
    assert spark.sql("select count(*) as n from layer_of_parts.t").first().n == 5
    spark.sql("drop database layer_of_parts cascade")


def test_the_newest_date_comes_from_footers(spark, tmp_path):
    root, name = str(tmp_path), "sc_yt_day_data"
    assert tables.newest_loaded(spark, root, name).first().max_date is None
    days = spark.createDataFrame([(date(2024, 1, d), "{}") for d in (3, 9, 4)] + [(None, "{}")], "date date, date_metrics string").coalesce(1)
    tables.load_stage(days, root, name, "append")
    assert tables.newest_loaded(spark, root, name).first().max_date == date(2024, 1, 9)
    tables.load_stage(days.select(F.date_add("date", 30).alias("date"), "date_metrics"), root, name, "append")
    newest = tables.newest_loaded(spark, root, name)
    assert newest.first().max_date == date(2024, 2, 8)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(date)]" in plan and "ReadSchema: struct<max(date):date>" in plan
    assert "Batched: true" in tables.read_stage(spark, root, name)._jdf.queryExecution().executedPlan().toString()
    tables.load_stage(days.filter("date is null"), root, name, "append")
    assert tables.newest_loaded(spark, root, name).first().max_date == date(2024, 2, 8)
    tables.load_stage(days.filter("false"), root, name, "truncate")
    assert tables.newest_loaded(spark, root, name).first().max_date is None
    assert schemas.STAGE_TABLES[name].fieldNames()[0] == "date"


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def by_bucket(listing):
    out = {}
    for f in listing:
        out.setdefault(int(f.split("_bucket=")[1].split("/")[0]), set()).add(f)
    return out


@pytest.fixture
def versions(spark):
    return spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.md5(F.concat(F.lit("old"), "id")).alias(HASH))


@pytest.mark.parametrize("load", ["versions", "replace"])
def test_a_batch_reads_and_writes_its_buckets_only(spark, tmp_path, versions, load):
    path = str(tmp_path / "t")
    buckets.write_buckets(versions, path, ["k"], 32)
    with pytest.raises(ValueError, match="started"):
        buckets.write_buckets(versions, path, ["k"], 32)
    before = files(path)
    batch = spark.createDataFrame([(7, "new", "x"), (8, "new", "y"), (7, "newer", "z"), (5000, "first", "w")], f"k long, v string, {HASH} string")
    batch = batch.unionByName(versions.filter("k = 9"))
    if load == "versions":
        touched = buckets.add_new_versions(batch, path, "k")
        want = 2000 + 4
    else:
        touched = buckets.replace_keys(batch, path, ["k"])
        want = 2000 - 2 + 4
    assert touched == buckets.touched_buckets(batch, ["k"], 32) and 1 < len(touched) <= 4
    after = files(path)
    changed = by_bucket(set(before) ^ set(after))
    assert sorted(changed) == touched
    assert all(before[f] == after[f] for f in set(before) & set(after))
    rows = buckets.read_buckets(spark, path)
    assert rows.count() == want and rows.columns == ["k", "v", HASH]
    assert sorted(r.v for r in rows.filter("k = 7").collect()) == (["new", "newer", "old"] if load == "versions" else ["new", "newer"])
    assert rows.filter("k = 9").count() == 1
    pruned = buckets.read_buckets(spark, path, touched)
    assert sorted(by_bucket(pruned.inputFiles())) == list(range(32))  # what the folder lists ...
    pruned.collect()
    scan = pruned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == len({f for f in after if int(f.split("_bucket=")[1].split("/")[0]) in touched})  # ... and what is read


def test_loads_into_nothing_and_of_nothing(spark, tmp_path, versions):
    path = str(tmp_path / "t")
    assert buckets.read_buckets(spark, path) is None
    buckets.replace_keys(versions, path, ["k"], 8)
    before = files(path)
    assert buckets.add_new_versions(versions.filter("false"), path, "k") == [] and files(path) == before
    buckets.add_new_versions(versions, path, "k")
    assert buckets.read_buckets(spark, path).count() == 2000


SEGMENTS = "video_id string, start_time double, end_time double, text string"


def test_transcript_files(spark, tmp_path):
    folder = str(tmp_path / "texts")
    rows = [("b", 4.0, 9.0, "more words"), ("a", 0.0, 1.5, "x\r\ny"), ("b", 0.0, 4.2, "first"), ("c-_9", 0.0, 1.0, None)]
    transcripts.write_files(spark.createDataFrame(rows, SEGMENTS).repartition(4), f"file://{folder}")
    assert sorted(os.listdir(folder)) == ["a.txt", "b.txt", "c-_9.txt"]
    assert open(f"{folder}/b.txt").read() == "[0.00 -> 4.20] first\n[4.00 -> 9.00] more words\n"
    got = sorted((r.video_id, r.start_time, r.text) for r in transcripts.read_files(spark, folder).collect())
    assert got == [("a", 0.0, " x y"), ("b", 0.0, " first"), ("b", 4.0, " more words"), ("c-_9", 0.0, " ")]
    transcripts.write_files(spark.createDataFrame([("a", 1.0, 2.0, "again")], SEGMENTS), folder)
    assert open(f"{folder}/a.txt").read() == "[1.00 -> 2.00] again\n" and len(os.listdir(folder)) == 3
    transcripts.write_files(spark.createDataFrame([("z", 1.0, 2.0, "only")], SEGMENTS), folder, "overwrite")
    assert os.listdir(folder) == ["z.txt"]


@pytest.mark.parametrize("bad", ["x/y", "", None, "../up"])
def test_an_aborted_transcript_job_leaves_nothing(spark, tmp_path, bad):
    folder = str(tmp_path / "texts")
    transcripts.write_files(spark.createDataFrame([("kept", 1.0, 2.0, "x")], SEGMENTS), folder)
    rows = [(f"v{i}", 0.0, 1.0, "x") for i in range(50)] + [(bad, 0.0, 1.0, "x")]
    with pytest.raises(PySparkException):
        transcripts.write_files(spark.createDataFrame(rows, SEGMENTS), folder)
    assert os.listdir(folder) == ["kept.txt"]


def test_partitioned_transcripts_need_no_folder_per_video(spark, tmp_path):
    rows = [(f"v{i}", float(k), k + 1.0, "x") for i in range(300) for k in (1, 100_000)]
    odd = [("a b/c%é~+", 1.0, 2.0, "l\nx"), (None, 1.0, 2.0, "n"), (".h", 1.0, 2.0, None), ("_u", 1.0, 2.0, "u")]
    folder = str(tmp_path / "parts")
    transcripts.write_partitioned(spark.createDataFrame(rows + odd, SEGMENTS).repartition(4), folder)
    folders = [f for f in (tmp_path / "parts").rglob("*") if f.is_dir()]
    assert len(folders) < 50 and sum(1 for f in (tmp_path / "parts").rglob("video_id=v*.txt")) == 600
    got = sorted(tuple(r) for r in transcripts.read_partitioned(spark, folder).filter("video_id is not null").collect())
    assert got == sorted([(i, a, b, " x") for i, a, b, _ in rows] + [("a b/c%é~+", 1.0, 2.0, " l x"), (".h", 1.0, 2.0, " "), ("_u", 1.0, 2.0, " u")])
    assert transcripts.read_partitioned(spark, folder).filter("video_id is null").count() == 1
    assert {r.video_id for r in transcripts.listed_ids(spark, folder).collect()} >= {*(f"v{i}" for i in range(300)), "a b/c%é~+", ".h", "_u"}
